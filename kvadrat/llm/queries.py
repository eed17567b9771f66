"""The registered opN_ queries: each reads its whole table and returns the digest columns of
its operator's result, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvadrat.llm import (
    decontamination, embedding_join, fill_in_middle, jaccard_join, lexical_search, line_dedup, packing, quality_sampling,
    relative_parse, secret_scan, token_planes, warc, weak_rules,
)
from kvadrat.llm.common import table
from kvadrat.llm.tokens import tokenizer_path


def op1_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_planes.token_file_index(spark, docs, tokenizer_path("byte_bpe_50k.json"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op3_relative_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = relative_parse.parse(table(spark, sf_dir, "documents"))
    return parsed.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_sampling.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_rules.judge(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op7_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), long_words=line_dedup.LONG_WORDS)
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.restore(fill_in_middle.transform(table(spark, sf_dir, "documents")))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build(table(spark, sf_dir, "documents"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"))


def op13_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_planes": op1_token_planes,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_relative_parse": op3_relative_parse,
    "op4_importance_resampling": op4_importance_resampling,
    "op5_weak_rules": op5_weak_rules,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_secret_novelty": op7_secret_novelty,
    "op8_warc": op8_warc,
    "op9_decontamination": op9_decontamination,
    "op10_line_dedup": op10_line_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_lexical_search": op12_lexical_search,
    "op13_embedding_join": op13_embedding_join,
}

_OP10 = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS j
  FROM documents
), solid AS (
  SELECT doc_id, j, row_number() OVER w AS i, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS s
  FROM lines WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''
  WINDOW w AS (PARTITION BY doc_id ORDER BY j)
), runs AS (
  SELECT doc_id, i, s AS a, lead(s, 1) OVER w AS b, lead(s, 2) OVER w AS c
  FROM solid WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS k FROM runs WHERE c IS NOT NULL
  ) WHERE k > 1
), counted AS (
  SELECT doc_id, i, s AS a, lead(s) OVER w AS b, n AS x, lead(n) OVER w AS y
  FROM (SELECT *, len(regexp_extract_all(s, '[^ \\t\\x0B\\x0C\\r]+')) AS n FROM solid) WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), passages AS (
  SELECT doc_id, i, 1 AS size, a AS p FROM counted WHERE x >= 50
  UNION ALL SELECT doc_id, i, 2, a || chr(10) || b FROM counted WHERE b IS NOT NULL AND x + y >= 50
), later_passages AS (
  SELECT doc_id, i, size FROM (
    SELECT doc_id, i, size, row_number() OVER (PARTITION BY size, p ORDER BY doc_id, i) AS k FROM passages
  ) WHERE k > 1
), gone AS (
  SELECT DISTINCT s.doc_id, s.j
  FROM (SELECT doc_id, i, 3 AS size FROM later UNION ALL FROM later_passages) l
  JOIN solid s ON s.doc_id = l.doc_id AND s.i BETWEEN l.i AND l.i + l.size - 1
)
SELECT l.doc_id,
       count(*) FILTER (WHERE trim(l.line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> '') AS n_lines,
       count(g.j) AS n_removed,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.j) FILTER (WHERE g.j IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.j = l.j
GROUP BY l.doc_id
"""

_OP9 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, w[i : i + 9] AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, i, n, w[i : i + n - 1] AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n)
), hits AS (
  SELECT p.doc_id, p.i, p.n, x.item_id FROM places p JOIN windows x ON x.n = p.n AND x.win = p.win
), hit_words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM words d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN items t USING (doc_id)
"""

_OP11 = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents
), units AS (
  SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         CAST('0x' || substr(s, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(s, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(s, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(s, 25, 8) AS BIGINT) AS h4
  FROM docs
), cuts AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM units
), parts AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(u[b + 1:n], ''), '') AS x
  FROM cuts
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m
                        ELSE '<S>' || x || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

_OP12 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), sizes AS (SELECT r, doc_id, len(w) AS n FROM docs WHERE len(w) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
strata AS (SELECT r, doc_id, 100 - 75 + ((75 * n * docs) // terms) AS m FROM sizes, total),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL
), postings AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), total
), scored AS (
  SELECT item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN strata USING (r)
  GROUP BY item_id, r, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
) WHERE rank <= 10
"""

_OP13 = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y
  FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT r.vec_id, l.y FROM reach r JOIN links l ON r.other = l.x
), degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id) LEFT JOIN degree ON x = vec_id
"""

#: DuckDB says the same where SQL can and whole tables allow it.
ORACLE_SQL: dict[str, str] = {
    "op9_decontamination": _OP9, "op10_line_dedup": _OP10, "op11_fill_in_middle": _OP11, "op12_lexical_search": _OP12,
    "op13_embedding_join": _OP13,
}
