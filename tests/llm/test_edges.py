"""Every operator on partitions without a word, clashing column names, repeated rows, ties, a very
long text and empty tables."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kvadrat.llm import (
    decontamination, embedding_join, fill_in_middle, jaccard_join, lexical_search, line_dedup, packing, quality_sampling,
    relative_parse, secret_scan, token_planes, weak_rules,
)
from kvadrat.llm.tokens import tokenizer_path

LONG = " ".join(f"w{i % 9973}" for i in range(200_000))
CLASH = ["__runs", "__id", "__tie", "__cut", "__ratio", "__n", "row", "ratio", "n_grams", "id", "tie", "key", "kept", "runs", "cut", "__copy"]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(i, 0, 0) for i in range(40, 60)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "alpha beta gamma"), (2, None), (2, ""), (3, " \n")], "item_id long, text string")


def operators(spark, labels, bench):
    """name -> what gives one row per document row."""
    byte, word = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
    return {
        "op1": lambda d: token_planes.token_file_index(spark, d, byte),
        "op2": jaccard_join.near_duplicates,
        "op3": relative_parse.parse,
        "op4": lambda d: quality_sampling.classify(d, labels),
        "op5": weak_rules.judge,
        "op6": lambda d: packing.pack(d, word),
        "op7": secret_scan.scan,
        "op9": lambda d: decontamination.contamination(d, bench),
        "op10": lambda d: line_dedup.dedup_lines(d, long_words=50),
        "op11": lambda d: fill_in_middle.restore(fill_in_middle.transform(d)),
    }


NAMES = ["op1", "op2", "op3", "op4", "op5", "op6", "op7", "op9", "op10", "op11"]
WORDLESS = [(1, None), (2, ""), (3, " \n\t "), (4, "\n\n"), (None, None), (4, "\n\n")]


@pytest.mark.parametrize("name", NAMES)
def test_partitions_without_words(spark, labels, bench, name):
    docs = spark.createDataFrame(WORDLESS, "doc_id long, text string").repartition(6)
    assert operators(spark, labels, bench)[name](docs).count() == len(WORDLESS)


@pytest.mark.parametrize("name", NAMES)
def test_very_long_text_and_repeated_rows(spark, labels, bench, name):
    rows = [(1, LONG), (2, "alpha beta gamma"), (2, "alpha beta gamma"), (3, "alpha beta gamma"), (4, LONG)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = operators(spark, labels, bench)[name](docs).collect()
    if name != "op6":  # pieces, not documents
        assert sorted(r["doc_id"] for r in got) == [1, 2, 2, 3, 4]
    by = {r["doc_id"]: r for r in got}
    if name == "op2":
        assert by[4]["component_id"] == 1 and by[3]["component_id"] == 2 and by[1]["n_shingles"] == 9973
    if name == "op3":
        assert by[1]["n_removed"] == 0 and by[4]["n_removed"] == 200_000
    if name == "op11":
        assert by[1]["restored"] == LONG and by[1]["n"] == 200_000
    if name == "op6":
        assert sum(r["length"] for r in got if r["doc_id"] == 1) > 200_000
    if name == "op4":
        assert len({(r["log_weight"], r["kept"]) for r in got if r["doc_id"] == 2}) == 1


@pytest.mark.parametrize("stage", ["quality", "lines", "near_duplicates", "decontaminate"])
def test_clashing_names_and_types(spark, tmp_path, labels, bench, stage):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(i, f"line {i}\nsame one\nsame two\nsame three\n" if i % 2 else None) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", *(F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASH)))
    run = dict(corpus_pipeline.STAGES)[stage]
    out = run(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    kept = out.collect()
    assert kept and all([r[c] for c in CLASH] == [f"x{i}" for i in range(len(CLASH))] for r in kept)
    numbers = docs.withColumn("text", F.col("doc_id").cast("int"))  # a text that is no string
    assert run(spark, numbers, str(tmp_path)).count() > 0


def test_quality_against_brute_force(spark):
    """Models, tilt, weights and the cut of the sample, from dictionaries."""
    rng = np.random.default_rng(5)
    good, bad = [f"g{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choice(good if i % 3 else bad, rng.integers(0, 30)))) for i in range(300)]
    docs += [(300, None), (301, ""), (5, docs[5][1])]
    marked = [(i, int(i % 3 > 0), int(i % 7 == 0)) for i in range(0, 300, 2)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(marked, "doc_id long, quality int, toxic int")
    got = quality_sampling.classify(frame, labels).collect()
    clean = [r[0] for r in spark.createDataFrame([(i,) for i, q, t in marked if q and not t], "doc_id long").where(
        F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 0).collect()]
    other = {i for i, q, t in marked if q and not t} - set(clean)

    def grams(text):
        w = (text or "").split()
        return [[x] for x in w], [[a, b] for a, b in zip(w, w[1:])]

    def model(texts):
        counts = {}
        for t in texts:
            for kind, some in enumerate(grams(t)):
                for g in some:
                    counts[kind, *g] = counts.get((kind, *g), 0) + 1
        return counts

    raw, target = model(t for _, t in docs), model(t for i, t in docs if i in set(clean))
    total = lambda m, kind: sum(v for k, v in m.items() if k[0] == kind)
    share = [total(target, k) / total(raw, k) for k in (0, 1)]
    ratio = lambda g, kind: math.log((target.get((kind, *g), 0) + 8) / (raw[kind, *g] * share[kind] + 8))
    weights = [sum(ratio(g, kind) for kind, some in enumerate(grams(t)) for g in some) for _, t in docs]
    sizes = [sum(map(len, grams(t))) for _, t in docs]
    means = sorted(w / n for (i, _), w, n in zip(docs, weights, sizes) if i in other and n)
    tilt = means[max(1, len(means) - int(0.01 * len(means))) * -1]
    want = sorted((i, n, round(w - tilt * n, 2)) for (i, _), w, n in zip(docs, weights, sizes))
    # n-grams share buckets now and then, so weights agree nearly
    assert [(a, n, pytest.approx(w, abs=0.3)) for a, n, w in want] == sorted((r["doc_id"], r["n_grams"], round(r["log_weight"], 2)) for r in got)
    assert sum(r["kept"] for r in got) == sum(r["log_weight"] >= 0 for r in got)  # no two noises tie here, but for the equal rows
    assert all(r["kept"] for r in got if r["log_weight"] > 12) and not any(r["kept"] for r in got if r["log_weight"] < -12)


def test_ties_at_the_cut_of_the_sample(spark):
    docs = spark.createDataFrame([(1, "a b")] * 5 + [(2, "c d")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["kept"] for r in quality_sampling.classify(docs, none).collect()] == [True] * 6


def test_weak_rules_base_against_brute_force(spark):
    rng = np.random.default_rng(8)
    vocabulary = ["word", "é#x", "a$b", "<i>", "two", "three", "four", "|", "5%"]
    texts = [None, "", "\n \n"] + [
        "".join(str(rng.choice(vocabulary)) + str(rng.choice([" ", "\n", "\t", " \n"])) for _ in range(rng.integers(0, 60))) for _ in range(150)]
    got = {r["doc_id"]: r for r in weak_rules.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, text in enumerate(texts):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        at = {}
        for k in range(len(words) - 4):
            at.setdefault(tuple(words[k : k + 5]), []).append(k)
        repeated = {k + j for places in at.values() if len(places) > 1 for k in places for j in range(5)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        base = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), base)
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want, text
        assert not (base and r["kept"])


def base_spans(text):
    found = []
    for order, (kind, pattern, least, group) in enumerate((
        ("assign", r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 1),
        ("access", r"AKIA[A-Z0-9]+", 20, 0), ("hex", r"[0-9a-f]+", 24, 0))):
        for m in re.finditer(pattern, text):
            if len(m[group]) >= least:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


def test_secret_base_spans_against_brute_force(spark):
    rng = np.random.default_rng(9)
    pieces = ["password=", "Token: ", "api_key = '", "APIKEY:", "secret", " é ", "abc", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "\n", "x.y/z-", "\"", "= ", "deadbeef"]
    texts = [None, ""] + ["".join(rng.choice(pieces, rng.integers(1, 25))) for _ in range(300)]
    rows = secret_scan.scan(spark.createDataFrame(list(enumerate(texts)) + [(7, texts[7])], "doc_id long, text string")).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        want = base_spans(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex")]
        assert set(want) <= set(r["spans"].split(","))  | {""}


def test_novel_secrets_recall(spark):
    """Strings without a base kind's form after sensitive words; nine of ten must be reported, prose and names must not."""
    rng = np.random.default_rng(10)
    alphabet = list("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789_-")
    words = "the quick session handler reads from every configured client and returns values when ready".split()
    prose = lambda n: " ".join(rng.choice(words, n))
    planted = [f"{prose(30)} {rng.choice(['bearer', 'credential', 'authorization'])} {''.join(rng.choice(alphabet, 32))} {prose(20)}" for _ in range(100)]
    clean = [f"{prose(30)} {rng.choice(['bearer', 'credential', 'authorization'])} {prose(20)}" for _ in range(100)]
    rows = secret_scan.scan(spark.createDataFrame(list(enumerate(planted + clean)), "doc_id long, text string")).collect()
    found = {r["doc_id"] for r in rows if r["n_novel"]}
    assert len([i for i in found if i < 100]) >= 90 and not [i for i in found if i >= 100]


def search_by_hand(docs, items, k=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
    rows = [(i, split(t)) for i, t in docs if split(t)]
    total, terms = len(rows), sum(len(w) for _, w in rows)
    df = {}
    for _, w in rows:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for i, w in rows:
            m = 25 + 75 * len(w) * total // terms
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * w.count(t) // (1000 * w.count(t) + 8 * m)) for t in split(text) if t in w)
            if s > 0:
                scores.append((-s, i is not None, i if i is not None else 0, s))
        out += [(item, r, i if some else None, s) for r, (_, some, i, s) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_postings,block_terms", [(250_000, 200_000), (60, 5), (7, 200_000)])
def test_lexical_search(spark, shard_postings, block_terms):
    rng = np.random.default_rng(12)
    vocabulary = ["alpha", "Beta", "gamma", "é1", "Über", "x-y", "z_9", "漢字", "the"]
    texts = ["".join(str(rng.choice(vocabulary)) + str(rng.choice([" ", ", ", "\n"])) for _ in range(rng.integers(0, 40))) for _ in range(120)]
    docs = list(enumerate(texts)) + [(500, None), (501, ""), (502, "..."), (None, "alpha the"), (3, texts[3]), (3, "the the gamma"), (600, "rare " * 50), (601, "rare")]
    items = [(1, "alpha BETA the the"), (2, "rare"), (3, None), (4, ""), (5, "absent words"), (6, "漢字 über é1 gamma"), (None, "z 9 x"), (1, "alpha BETA the the"), (7, " ".join(vocabulary) * 3)]
    frame = spark.createDataFrame([(i, t, "c", 1) for i, t in docs], "doc_id long, text string, term string, shard int")
    index = lexical_search.build(frame, shard_postings=shard_postings)
    got = lexical_search.search(index, spark.createDataFrame(items, "item_id long, text string"), block_terms=block_terms).collect()
    assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=str) == search_by_hand(docs, items)


def test_lexical_search_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "alpha"), (2, "beta")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    none = lambda f: f.where("false")
    assert lexical_search.search(lexical_search.build(none(docs)), items).collect() == []
    assert lexical_search.search(lexical_search.build(docs), none(items)).collect() == []


def test_fill_in_middle(spark):
    rows = [(i, f"w{i} é<  S> q\t\n  z<{i} ") for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \n "), (203, "a <P> b"), (204, "abc <S"), (205, "x y <M"), (None, "x y z"), (206, "  lead é trail  "), (206, "  lead é trail  ")]
    made = fill_in_middle.restore(fill_in_middle.transform(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert len(made) == len(rows) and {r["form"] for r in made} == {"plain", "psm", "spm"}
    texts = dict(rows)
    for r in made:
        text = texts[r["doc_id"]] or ""
        units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
        digits = hashlib.sha256(f"42:{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()
        h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
        a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
        p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        plain = not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50
        form = "plain" if plain else "spm" if h[3] % 100 < 80 else "psm"
        out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
        sizes = (None, None) if plain else (len(p), len(m))
        assert (r["n"], r["form"], r["output"], r["restored"], (r["prefix_chars"], r["middle_chars"])) == (len(units), form, out, text, sizes)


@pytest.mark.parametrize("tile", [4096, 40, 7])
def test_embedding_join(spark, tile):
    rng = np.random.default_rng(1)
    rows = []
    for k in range(40):
        c = rng.standard_normal(20)
        for _ in range(rng.integers(1, 10)):
            v = (c + rng.standard_normal(20) * rng.choice([0.02, 0.1, 0.2])) * rng.uniform(0.1, 9)
            rows.append((len(rows), [float(np.float32(x)) for x in v], k % 3))
    n = len(rows)
    rows += [(900, rows[3][1], rows[3][2]), (901, rows[3][1], rows[3][2]), (901, rows[3][1], rows[3][2]), (902, rows[3][1], None), (903, None, 1),
             (904, [0.0] * 20, 1), (905, [float("nan")] * 20, 1), (906, [None] * 20, 1), (907, [], 1), (None, rows[5][1], rows[5][2]),
             (908, [float("inf")] * 20, 1), (909, [1.0, 2.0], 1), (910, [2.0, 4.0], 1), (911, [3e38] * 20, 1), (912, [1e38] * 20, 1)]
    links = {i: set() for i in range(len(rows))}
    live = [i for i in [*range(n), *range(n, len(rows))] if rows[i][1] and rows[i][2] is not None
            and all(x is not None and math.isfinite(x) for x in rows[i][1]) and any(rows[i][1])]
    unit = {i: np.array(rows[i][1]) / np.linalg.norm(rows[i][1]) for i in live}
    for i in live:
        for j in live:
            if i != j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98:
                links[i].add(j)
    want = []
    for i, (vec_id, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        want.append((vec_id, len(links[i]), least, vec_id == least))
    frame = spark.createDataFrame([(*r, "x", 3) for r in rows], "vec_id long, embedding array<float>, label int, node string, k1 int")
    got = embedding_join.near_duplicates(frame, tile=tile).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and sum(w[1] for w in want) > 500
    assert embedding_join.near_duplicates(frame.where("false")).count() == 0
