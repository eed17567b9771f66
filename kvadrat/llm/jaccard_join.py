"""Operator 2: near-duplicate documents by a size-aware heavy-light Jaccard join.

A document's set is its distinct word shingles (64-bit hashes). Documents of equal sets are one
class and only its smallest doc_id goes on. One order of all shingles, frequent ones last, gives
each set a prefix such that two sets that link share shingles in their prefixes:

* light: a set of at most ``boundary`` shingles enumerates the 2-subsets of its 2-prefix (its
  n - ceil(t n) + 2 first shingles); two linked light sets share one of them;
* heavy: a larger set, or one that can link with a larger, is found through the inverted lists of
  its 1-prefix (n - ceil(t n) + 1 shingles), and the shared shingles of a pair are counted: with
  fewer than its prefix must share by the required overlap, the pair is dropped.

The boundary is where enumerating subsets costs as much as scanning lists, from the histogram of
set sizes and the mean list length. Lists of at most ``long_list`` sets give their pairs. Longer
lists never do: all members are compared with one pivot; Jaccard distance is a metric, so a pair
can only link if its distances to the pivot differ by at most 1 - t, members linked with the
pivot need no comparison among themselves, and the others go round again with a new pivot. Pairs
left open are bounded once more by the parity bitmaps of the sets, whose differing bits are at
most the shingles that differ, and every pair left is compared exactly. Connected components follow by star contraction.

Links lie within components. The edges found so far count them where all lists of a component are
short. In a component with a member of a long list, where pairs were passed over because they hold
together anyway, all sets are compared in tiles: bands of set size, in which only neighbours can
link, are dealt into blocks, each pair of blocks is one task's matrix product, and only the number
of links of each set leaves it.

Null or empty text, or one without words, has an empty set and is its own component. Rows that
repeat a doc_id are one document with several sets. A null doc_id links with nothing and gets a
null component. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kvadrat.llm.common import Words, grams, id_text, lean, mix, signed, steps, stored

SHINGLE = 5
THRESHOLD = Fraction(3, 4)
LONG_LIST = 64
#: Most shingles that the order treats as frequent. It only sets the order: any order is exact.
MAX_FREQUENT = 300_000
_LIGHT_MOST = 64
_FREQUENT = np.uint64(1 << 62)
_ANY = 1 << 40
#: Most sets, and shingles in all, that a block of a tile is meant to hold.
TILE, TILE_SHINGLES = 1024, 1 << 20
_BITS = [f"bits{i}" for i in range(8)]


class Sets:
    """Shingle sets of the rows of a text column: sorted hashes, ``first`` delimits the rows."""

    def __init__(self, column: pa.Array, shingle: int = SHINGLE):
        words = Words(column, lower=True)
        h = words.hashes()
        n = np.diff(words.first)
        size = np.where(n >= shingle, n - shingle + 1, (n > 0).astype(np.int64))
        row = np.repeat(np.arange(len(n)), size)
        start = words.first[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        full = grams(np.concatenate([h, np.zeros(shingle, np.uint64)]), shingle)
        values = full[start] if len(start) else np.zeros(0, np.uint64)
        for i in np.flatnonzero((n > 0) & (n < shingle)):  # the whole sequence is one shingle
            some = h[words.first[i] : words.first[i + 1]]
            values[np.searchsorted(row, i)] = grams(some, len(some), 0xA24BAED4963EE407)[0] + np.uint64(len(some))
        bounds = np.concatenate([[0], np.cumsum(size)])
        for a, b in zip(bounds[:-1], bounds[1:]):
            values[a:b].sort()
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
        self.values, self.row = values[new], row[new]
        self.first = np.searchsorted(self.row, np.arange(len(n) + 1))
        self.size = np.diff(self.first)


def _need(n, t: Fraction):
    """ceil(t * n) for an integer, an array or a column."""
    if isinstance(n, Column):
        return F.floor((n * t.numerator + (t.denominator - 1)) / F.lit(t.denominator)).cast("long")
    return -(-n * t.numerator // t.denominator)


def _ranked(sets: Sets, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The shingles as ranks, sorted in rows: 62 bits of the hash; frequent ones above all
    others, by their count."""
    ranks = sets.values >> np.uint64(2)
    keys, place = frequent
    if len(keys):
        at = np.minimum(np.searchsorted(keys, sets.values), len(keys) - 1)
        often = keys[at] == sets.values
        ranks[often] = _FREQUENT | place[at[often]]
        for i in np.unique(sets.row[often]):
            ranks[sets.first[i] : sets.first[i + 1]].sort()
    return ranks


def _frequent(rows: DataFrame, shingle: int, at_least: int = 24) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of many documents, sorted, and the place of each by count: counted batch by
    batch, summed up, the most frequent kept."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Sets(step.column("text"), shingle).values for step in steps(batch)]
            if found:
                values, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(values[n > 2])), pa.array(n[n > 2])], names=["shingle", "n"])

    counts = rows.select("text").mapInArrow(lean(count), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= at_least).orderBy(F.desc("n"), "shingle").limit(MAX_FREQUENT).toArrow()
    values = top["shingle"].to_numpy().view(np.uint64)
    order = np.argsort(values)
    return values[order], (len(values) - 1 - order).astype(np.uint64)


def _keys(sets: Sets) -> tuple[np.ndarray, np.ndarray]:
    """128-bit key of each row's set."""
    total = lambda v: np.concatenate([[np.uint64(0)], np.cumsum(v, dtype=np.uint64)])
    out = []
    for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        sums = total(mix(sets.values * np.uint64(salt) + np.uint64(salt >> 7)))
        out.append(signed(mix(sums[sets.first[1:]] - sums[sets.first[:-1]] + sets.size.astype(np.uint64))))
    return out[0], out[1]


def _members(rows: DataFrame, frequent, shingle: int, t: Fraction) -> DataFrame:
    """doc_id, n, k1, k2, last (rank that ends the 1-prefix), for the cost model a 64th of the
    prefix ranks of small sets, drawn by rank from every document, and 512 parity bits."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch):
                sets = Sets(step.column("text"), shingle)
                ranks = _ranked(sets, frequent.value)
                k1, k2 = _keys(sets)
                n = sets.size
                p = n - _need(n, t) + 1
                last = np.zeros(len(n), np.int64)
                some = n > 0
                last[some] = ranks[(sets.first[:-1] + p - 1)[some]].view(np.int64)
                probe = [
                    [int(r) for r in ranks[a : a + k] if r % np.uint64(64) == 0] if m <= _LIGHT_MOST else []
                    for a, k, m in zip(sets.first[:-1], p, n)
                ]
                bits = np.bincount(sets.row * 512 + (mix(sets.values) & np.uint64(511)).astype(np.int64), minlength=512 * len(n)) & 1
                bits = np.packbits(bits.reshape(-1, 512).astype(np.uint8), axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [step.column("doc_id"), pa.array(n), pa.array(k1), pa.array(k2), pa.array(last),
                     pa.array(probe, pa.list_(pa.int64())), *(pa.array(np.ascontiguousarray(b)) for b in bits.T)],
                    names=["doc_id", "n", "k1", "k2", "last", "probe", *_BITS])

    bits = "".join(f", {b} long" for b in _BITS)
    return rows.mapInArrow(lean(make), "doc_id long, n long, k1 long, k2 long, last long, probe array<long>" + bits)


def _prefixes(rows: DataFrame, frequent, shingle: int, t: Fraction) -> DataFrame:
    """doc_id, n, k1, k2 and the 2-prefix of each set, for classes to be made of."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch):
                sets = Sets(step.column("text"), shingle)
                ranks = signed(_ranked(sets, frequent.value))
                k1, k2 = _keys(sets)
                p = np.minimum(sets.size - _need(sets.size, t) + 2, sets.size)
                ends = np.concatenate([[0], np.cumsum(p)])
                at = np.arange(ends[-1]) + np.repeat(sets.first[:-1] - ends[:-1], p)
                prefix = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ranks[at]))
                yield pa.RecordBatch.from_arrays(
                    [step.column("doc_id"), pa.array(sets.size), pa.array(k1), pa.array(k2), prefix],
                    names=["doc_id", "n", "k1", "k2", "prefix"])

    return rows.mapInArrow(lean(make), "doc_id long, n long, k1 long, k2 long, prefix array<long>")


def _boundary(members: DataFrame, t: Fraction) -> int:
    """Largest size of a light set, by cost: subsets made against list entries scanned."""
    small = members.where(F.col("n").between(1, _LIGHT_MOST))
    sizes = {r["n"]: r["c"] for r in small.groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
    lists = small.select(F.explode("probe").alias("r")).groupBy("r").agg(F.count(F.lit(1)).alias("c"))
    c1, c2 = lists.agg(F.sum("c"), F.sum(F.col("c") * F.col("c"))).first()
    scanned = 1 + (c2 / c1 if c1 else 0) / 2

    def cost(b: int) -> float:
        light = sum(c * (p * (p - 1) // 2) for n, c in sizes.items() if n <= b for p in [n - _need(n, t) + 2])
        heavy = sum(c * (n - _need(n, t) + 1) * scanned for n, c in sizes.items() if n > t * b)
        return light + heavy

    return min(range(_LIGHT_MOST + 1), key=cost)


_LISTED = "sig long, doc_id long, n long, light boolean"


def _signatures(classes: DataFrame, boundary: int, t: Fraction) -> DataFrame:
    """One row per entry of an inverted list: subsets of light sets, shingles of heavy ones."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, size = batch.column("doc_id").to_numpy(), batch.column("n").to_numpy()
            lists = batch.column("prefix")
            values = lists.values.to_numpy()
            at = lists.offsets.to_numpy().astype(np.int64)
            heavy = size > t * boundary
            p = np.where(heavy, size - _need(size, t) + 1, 0)
            ends = np.cumsum(p)
            pick = np.arange(int(p.sum())) + np.repeat(at[:-1] - (ends - p), p)
            sig, row, light = [values[pick]], [np.repeat(np.arange(len(size)), p)], [np.zeros(len(pick), bool)]
            for i in np.flatnonzero(size <= boundary):
                r = values[at[i] : at[i + 1]].view(np.uint64)
                a, b = np.triu_indices(len(r), 1)
                sig.append(signed(mix(r[a] * np.uint64(0x9E3779B97F4A7C15) + mix(r[b])) >> np.uint64(2)))
                row.append(np.full(len(a), i))
                light.append(np.ones(len(a), bool))
            row = np.concatenate(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(sig)), pa.array(doc[row]), pa.array(size[row]), pa.array(np.concatenate(light))],
                names=["sig", "doc_id", "n", "light"])

    return classes.select("doc_id", "n", "prefix").mapInArrow(lean(make), _LISTED)


_FOUND = "sig long, a long, b long, n long, light boolean"


def _scan_lists(listed: DataFrame, long_list: int, t: Fraction) -> DataFrame:
    """Reads lists in order: pairs (a, b) of short lists by size; members (a, no b) of long ones."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the list at the end of the last batch, up to long_list + 1 rows
        long = None  # signature of a long list whose first rows are out
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("sig", "doc_id", "n", "light")]
            cols = [np.concatenate(x) for x in zip(held, new)] if held else new
            sig = cols[0]
            starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            size = np.diff(np.concatenate([starts, [len(sig)]]))
            each = np.repeat(size, size)
            flowing = (each > long_list) | (sig == long) if long is not None else each > long_list
            open_ = int(starts[-1])
            if not flowing[open_]:
                held = [c[open_:] for c in cols]
                keep = np.arange(len(sig)) < open_
            else:
                held, long = [], sig[open_]
                keep = np.ones(len(sig), bool)
            yield from _found(cols, starts, size, keep, flowing)
        if held:
            size = np.array([len(held[0])])
            yield from _found(held, np.zeros(1, np.int64), size, np.ones(size[0], bool), np.zeros(size[0], bool))

    def _found(cols, starts, size, keep, flowing) -> Iterator[pa.RecordBatch]:
        sig, doc, n, light = cols
        out = keep & flowing
        if out.any():
            yield rows(sig[out], doc[out], None, n[out], light[out])
        whole = keep[starts] & ~flowing[starts]
        for m in np.unique(size[whole]):
            if m > 1:
                first = starts[whole & (size == m)]
                x, y = np.triu_indices(m, 1)
                for some in np.array_split(first, max(1, len(first) * len(x) // 200_000)):
                    i, j = (some[:, None] + x).ravel(), (some[:, None] + y).ravel()
                    low, high = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
                    ok = (low >= _need(high, t)) & (doc[i] != doc[j])
                    i, j = i[ok], j[ok]
                    yield rows(sig[i], np.minimum(doc[i], doc[j]), np.maximum(doc[i], doc[j]), n[i], light[i])

    def rows(sig, a, b, n, light) -> pa.RecordBatch:
        b = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)
        return pa.RecordBatch.from_arrays([pa.array(sig), pa.array(a), b, pa.array(n), pa.array(light)],
                                          names=["sig", "a", "b", "n", "light"])

    return listed.repartition("sig").sortWithinPartitions("sig").mapInArrow(lean(scan), _FOUND)


def _overlap(sizes: Column, t: Fraction) -> Column:
    """Shared shingles that a link of two sets requires, from the sum of their sizes."""
    return F.ceil(sizes * t.numerator / (t.numerator + t.denominator) - 1e-9)


def _counted(pairs: DataFrame, info: DataFrame, t: Fraction) -> DataFrame:
    """Heavy pairs that share as many listed prefix shingles as a link requires. The prefix that
    ends first lies wholly before the other's end, so all its shared shingles are in both. Ids
    with several sets have no one size or end: their pairs pass without a count."""
    counts = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("m"))
    for side in ("a", "b"):
        mine = info.select(*(F.col(c).alias(c if c == side else f"{c}_{side}") for c in (side, "n", "last", "short", "several")))
        counts = counts.join(mine, side)
    overlap = _overlap(F.col("n_a") + F.col("n_b"), t)
    need_a = F.col("short_a") - (F.col("n_a") - overlap)
    need_b = F.col("short_b") - (F.col("n_b") - overlap)
    need = F.when(F.col("last_a") <= F.col("last_b"), need_a).otherwise(need_b)
    return counts.where((F.col("m") >= need) | F.col("several_a") | F.col("several_b")).select("a", "b")


def _sets_of(rows: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, shingles) of the wanted ids and of a few more: a bitmap of at most 2 MB, by id
    hash, spares hashing most other documents. No join follows that would shuffle the shingles
    to drop the rest: pairs meet only the ids they name. k1, k2 name the class of a set."""
    bits = min(1 << 24, max(1 << 10, 16 * wanted.count()))
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(bits)).cast("int")
    bitmap = np.zeros(bits, bool)
    bitmap[wanted.select(slot.alias("s")).distinct().toArrow()["s"].to_numpy()] = True
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(bitmap))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            batch = batch.filter(pa.array(marked[batch.column("slot").to_numpy()]))
            for step in steps(batch):
                sets = Sets(step.column("text"), shingle)
                lists = pa.ListArray.from_arrays(pa.array(sets.first, pa.int32()), pa.array(signed(sets.values)))
                k1, k2 = _keys(sets)
                yield pa.RecordBatch.from_arrays(
                    [step.column("doc_id"), pa.array(k1), pa.array(k2), lists], names=["doc_id", "k1", "k2", "shingles"])

    made = rows.withColumn("slot", slot).mapInArrow(lean(make), "doc_id long, k1 long, k2 long, shingles array<long>")
    return stored(made, "shingle-sets")


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, both (intersection), either (union) of each pair of ids."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", both.alias("both"), (F.size("sa") + F.size("sb")).alias("sum"))
    return joined.select("a", "b", "both", (F.col("sum") - F.col("both")).alias("either"))


def _linked(t: Fraction) -> Column:
    return F.col("both") * t.denominator >= F.col("either") * t.numerator


def components(edges: DataFrame) -> DataFrame:
    """(doc_id, component): smallest id reachable over the edges (a, b), by alternating large-star
    and small-star; every round is a grouping and a join, and is written."""
    pairs = edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo < hi").distinct()
    pairs, before = stored(pairs, "stars"), None
    while True:
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if state == before:
            return pairs.select(F.col("hi").alias("doc_id"), F.col("lo").alias("component"))
        before = state
        # large star: neighbours above a node go to its smallest neighbour (or itself)
        both = pairs.union(pairs.select("hi", "lo")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).where("lo < hi").distinct()
        # small star: a node and its neighbours below it go to the smallest of them
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(F.col("m").alias("lo"), F.col("lo").alias("hi")).where("lo < hi")
        pairs = stored(small.union(least.select("m", "hi")).distinct(), "stars")


#: Rows of long lists; last: where the set's prefix ends; spare: its prefix shingles in lists of
#: two or more, less the prefix; rank: number of the list among the set's long lists of its kind, light or heavy;
#: several: the id has several sets, so its distance to a pivot and its counts bound nothing.
_LONG = ("sig", "a", "n", "last", "spare", "rank", "several")


def _pivot_rounds(lists: DataFrame, sets: DataFrame, t: Fraction, rounds: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Links with pivots of long lists, and the pairs that the pivots leave open, as functions of
    the lists: (links, [list rows with distances in them])."""
    links, open_ = [], []
    left = lists
    for _ in range(rounds):
        pivots = left.groupBy("sig").agg(F.min("a").alias("pivot"))
        with_pivot = left.join(pivots, "sig")
        pairs = with_pivot.where("a <> pivot").select(F.col("a"), F.col("pivot").alias("b")).distinct()
        near = stored(_similar(pairs, sets), "pivots")
        links.append(near.where(_linked(t)).select("a", "b"))
        far = near.groupBy(F.col("a"), F.col("b").alias("pivot")).agg(
            F.max(F.col("both") / F.col("either")).alias("j"), F.max(_linked(t)).alias("in"))
        judged = stored(
            with_pivot.join(far, ["a", "pivot"], "left").select(
                *_LONG, F.coalesce(1 - F.col("j"), F.lit(0.0)).alias("d"), F.coalesce("in", F.lit(True)).alias("in")),
            "judged")
        open_.append(judged)
        # a member that is out meets the others that are out in the next round
        left = judged.where("not in").select(*_LONG)
        if left.isEmpty():
            return links, open_
    open_.append(left.select(*_LONG, F.lit(0.0).alias("d"), F.lit(None).cast("boolean").alias("in")))
    return links, open_


def _open_pairs(judged: list[DataFrame], comps: DataFrame, info: DataFrame, t: Fraction) -> DataFrame:
    """Pairs of a long list that may link though one is no neighbour of the pivot, and that are
    not in one component already; all rounds in one plan, a list and its round being the key."""
    comp = comps.select(F.col("doc_id").alias("a"), "component")
    rows = _union([j.withColumn("turn", F.lit(i)) for i, j in enumerate(judged)])
    rows = rows.join(comp, "a", "left").withColumn("component", F.coalesce("component", "a"))
    key = ["turn", "sig"]
    mixed = rows.groupBy(key).agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select(key)
    rows = rows.join(mixed, key).join(info.select("a", *_BITS), "a")
    names = ("a", "n", "last", "spare", "rank", "several", "d", "in", "component", *_BITS)
    x = rows.select(*key, *(F.col(c).alias(f"{c}1") for c in names))
    y = rows.select(*key, *(F.col(c).alias(f"{c}2") for c in names))
    sized = (F.least("n1", "n2") * t.denominator >= F.greatest("n1", "n2") * t.numerator)
    reach = F.abs(F.col("d1") - F.col("d2")) <= float(1 - t) + 1e-9
    sides = (F.col("in1") & ~F.col("in2")) | (F.col("in1").isNull() & F.col("in2").isNull() & (F.col("a1") < F.col("a2")))
    # The prefix that ends first must share what the overlap requires, p - (n - overlap), so a
    # pair shows in the first lists of that set already: all but the number required, less one.
    overlap = _overlap(F.col("n1") + F.col("n2"), t)
    enough = F.when(F.col("last1") <= F.col("last2"), F.col("spare1") + F.col("n1") - overlap >= F.col("rank1") - 1).otherwise(
        F.col("spare2") + F.col("n2") - overlap >= F.col("rank2") - 1)
    apart = sum((F.bit_count(F.col(f"{b}1").bitwiseXOR(F.col(f"{b}2"))) for b in _BITS), F.lit(0))
    enough &= F.coalesce(apart, F.lit(0)) <= F.col("n1") + F.col("n2") - 2 * overlap
    bounded = (reach & enough) | F.col("several1") | F.col("several2")
    pairs = x.join(y, key).where(sides & sized & bounded & (F.col("component1") != F.col("component2")))
    return pairs.select(F.least("a1", "a2").alias("a"), F.greatest("a1", "a2").alias("b")).distinct()


def _tile_links(x: list, y: list | None, t: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Links of each set of block ``x`` into ``y`` (None: into ``x`` itself) and back; a block is
    (values, rows, sizes)."""
    other = y or x
    values = np.concatenate([x[0], other[0]])
    _, place = np.unique(values, return_inverse=True)
    px, py = place[: len(x[0])], place[len(x[0]) :]
    cx, cy = (np.bincount(p, minlength=len(values)) for p in (px, py))
    shared = (cx > 0) & (cy > 0) if y else cx > 1
    column = np.cumsum(shared) - 1
    sides = []
    for (_, row, _), p in ((x, px), (other, py)):
        use = shared[p]
        at, row = column[p[use]], row[use]
        order = np.argsort(at, kind="stable")
        sides.append((at[order], row[order]))
    both = np.zeros((len(x[2]), len(other[2])), np.float64)
    for start in range(0, int(shared.sum()), 2048):
        dense = []
        for (at, row), n in zip(sides, both.shape):
            a, b = np.searchsorted(at, [start, start + 2048])
            part = np.zeros((n, 2048), np.float32)
            part[row[a:b], at[a:b] - start] = 1
            dense.append(part)
        both += dense[0] @ dense[1].T
    both = both.astype(np.int64)
    linked = both * t.denominator >= (x[2][:, None] + other[2][None, :] - both) * t.numerator
    if y is None:
        np.fill_diagonal(linked, False)
        return linked.sum(1), np.zeros(0, np.int64)
    return linked.sum(1), linked.sum(0)


def _degrees(classes: DataFrame, sets: DataFrame, t: Fraction, tile: int) -> DataFrame:
    """(k1, k2, n_links) of classes (k1, k2, rep, n, component, m): every two sets of a component
    that can link by size meet in one tile. m is the number of classes of the component."""
    width = float(np.log(t.denominator / t.numerator)) * (1 + 1e-9) if t < 1 else 1.0
    band = F.when(F.col("m") <= tile, 0).otherwise(F.floor(F.log(F.col("n").cast("double")) / width)).cast("int")
    banded = classes.withColumn("band", band)
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(tile), F.sum("n") / F.lit(TILE_SHINGLES))).cast("int")
    dealt = stored(banded.groupBy("component", "band").agg(blocks.alias("g")), "blocks")
    members = banded.join(dealt, ["component", "band"]).withColumn("slot", F.pmod(F.xxhash64("k1", "k2"), F.col("g")).cast("int"))
    members = stored(members.select("component", "band", "slot", "g", "k1", "k2", "rep"), "blocked")
    names = ("component", "k1", "k2", "rep")
    slots, one = F.sequence(F.lit(0), F.col("g") - 1), F.lit(1)
    own = members.select(*names, F.col("band").alias("low"), F.col("band").alias("high"), "slot", F.explode(slots).alias("j"))
    own = own.select(*names, "low", "high", F.least("slot", "j").alias("i"), F.greatest("slot", "j").alias("j"),
                     F.when(F.col("slot") <= F.col("j"), 0).otherwise(1).alias("side"))
    near = lambda by: dealt.select("component", (F.col("band") + by).alias("band"), "g")
    bare = members.drop("g")
    above = bare.join(near(-1), ["component", "band"]).select(
        *names, F.col("band").alias("low"), (F.col("band") + one).alias("high"), F.col("slot").alias("i"), F.explode(slots).alias("j"), F.lit(0).alias("side"))
    below = bare.join(near(1), ["component", "band"]).select(
        *names, (F.col("band") - one).alias("low"), F.col("band").alias("high"), F.explode(slots).alias("i"), F.col("slot").alias("j"), F.lit(1).alias("side"))
    shown = own.union(above).union(below)
    met = shown.join(sets.withColumnRenamed("doc_id", "rep"), ["rep", "k1", "k2"]).drop("rep")

    def compare(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        sides = []
        for s in (0, 1):
            part = table.filter(pa.array(side == s))
            keys = np.stack([part.column(k).to_numpy() for k in ("k1", "k2")], 1)
            keys, first = np.unique(keys, axis=0, return_index=True)  # rows of one text are one set
            lists = part.column("shingles").take(pa.array(first)).combine_chunks()
            size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            sides.append((keys, [lists.flatten().to_numpy(), np.repeat(np.arange(len(size)), size), size]))
        (kx, x), (ky, y) = sides
        within = table.column("low")[0] == table.column("high")[0] and table.column("i")[0] == table.column("j")[0]
        nx, ny = _tile_links(x, None if within else y, t)
        keys, n = (kx, nx) if within else (np.concatenate([kx, ky]), np.concatenate([nx, ny]))
        return pa.table({"k1": keys[:, 0], "k2": keys[:, 1], "n_links": n.astype(np.int64)})

    counted = met.groupBy("component", "low", "high", "i", "j").applyInArrow(compare, "k1 long, k2 long, n_links long")
    return counted.groupBy("k1", "k2").agg(F.sum("n_links").alias("n_links"))


def near_duplicates(
    docs: DataFrame,
    threshold: Fraction = THRESHOLD,
    shingle: int = SHINGLE,
    long_list: int = LONG_LIST,
    rounds: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    tile: int = TILE,
    count_links: bool = True,
) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id, n_links (all other classes whose
    set links with the row's; 0 for a class that links with nothing but its copies; null where
    ``count_links`` is off, for callers that need components alone)."""
    t, spark = threshold, docs.sparkSession
    rows = id_text(docs, id_col, text_col)
    known = rows.where("doc_id IS NOT NULL")
    frequent = spark.sparkContext.broadcast(_frequent(known, shingle))
    members = stored(_members(rows, frequent, shingle, t), "members")
    boundary = _boundary(members, t)
    sized = members.where("n > 0 AND doc_id IS NOT NULL")
    reps = sized.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))

    classes = _prefixes(known, frequent, shingle, t).where("n > 0").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    listed = _signatures(classes, boundary, t)
    # lists of frequent shingles are long anyway: their rows need no grouping to know it
    marked = F.col("sig") >= int(_FREQUENT)
    found = stored(
        _scan_lists(listed.where(~marked), long_list, t).union(
            listed.where(marked).select("sig", F.col("doc_id").alias("a"), F.lit(None).cast("long").alias("b"), "n", "light")),
        "lists")
    long = found.where("b IS NULL").select("sig", "a", "n", "light")
    pairs = found.where("b IS NOT NULL")

    # per class: prefix shingles that lie in short lists
    in_long = long.where("NOT light").groupBy("a").agg(F.count(F.lit(1)).alias("n_long"))
    mine = lambda c: F.max(F.when(F.col("doc_id") == F.col("rep"), F.col(c))).alias(c)
    info = sized.join(reps, ["k1", "k2"]).groupBy(F.col("doc_id").alias("i")).agg(
        mine("n"), mine("last"), F.countDistinct("k1").alias("sets"), *(mine(b) for b in _BITS)).where("n IS NOT NULL")
    heavy = pairs.where("NOT light")
    in_short = heavy.select("a", "sig").union(heavy.select("b", "sig")).distinct().groupBy(F.col("a").alias("s")).agg(
        F.count(F.lit(1)).alias("n_short"))
    prefix = F.col("n") - _need(F.col("n"), t) + 1
    n_long, n_short = F.coalesce("n_long", F.lit(0)), F.coalesce("n_short", F.lit(0))
    info = info.join(in_long, info["i"] == in_long["a"], "left").join(in_short, info["i"] == in_short["s"], "left").select(
        "i", "n", "last",
        *(F.when(F.col("sets") == 1, F.col(b)).alias(b) for b in _BITS),
        (prefix - n_long).alias("short"), (n_long + n_short - prefix).alias("spare"),
        (F.col("sets") > 1).alias("several"))
    info = stored(info.withColumn("a", F.col("i")).withColumnRenamed("i", "b"), "classes")
    candidates = stored(
        _counted(heavy, info, t).union(pairs.where("light").select("a", "b")).distinct(), "candidates")

    wanted = candidates.select(F.col("a").alias("doc_id")).union(candidates.select("b")).union(long.select("a")).distinct()
    sets = _sets_of(known, wanted, shingle)
    members_of = long.join(info.select("a", "last", "spare", "several"), "a").select(
        "sig", "a", "n", "last", "light", "several", F.when(F.col("light"), F.lit(_ANY)).otherwise(F.col("spare")).alias("spare")).distinct()
    # the bound counts heavy lists: subsets of a set that is light too take no rank from them
    members_of = members_of.withColumn("rank", F.row_number().over(Window.partitionBy("a", "light").orderBy("sig"))).drop("light")
    links, judged = _pivot_rounds(members_of, sets, t, rounds)
    links.append(stored(_similar(candidates, sets).where(_linked(t)).select("a", "b"), "links"))
    # an id with several sets holds their classes together
    several = sized.join(reps, ["k1", "k2"]).join(
        sized.groupBy("doc_id").agg(F.countDistinct("k1").alias("c")).where("c > 1").select("doc_id"), "doc_id")
    links.append(several.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    edges = stored(_union(links), "edges")
    comps = components(edges)
    more = _open_pairs(judged, comps, info, t)
    late = stored(_similar(more, sets).where(_linked(t)).select("a", "b"), "late-links")
    if not late.isEmpty():
        edges = edges.union(late)
        # what is joined so far stays joined as stars, so few rounds are left
        comps = components(comps.select(F.col("component").alias("a"), F.col("doc_id").alias("b")).union(late))
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component).alias("component_id")
    if not count_links:
        label = reps.join(comps, reps["rep"] == comps["doc_id"], "left").select("k1", "k2", F.coalesce("component", "rep").alias("component"))
        return members.join(label, ["k1", "k2"], "left").select(
            "doc_id", F.col("n").alias("n_shingles"), component, F.lit(None).cast("long").alias("n_links"))
    edges = edges.select("a", "b").union(edges.select("b", "a")).distinct()
    degree = edges.groupBy(F.col("a").alias("rep")).agg(F.count(F.lit(1)).alias("n_edges"))

    label = reps.join(comps, reps["rep"] == comps["doc_id"], "left").select("k1", "k2", "rep", F.coalesce("component", "rep").alias("component"))
    # ids with several sets: their edges are not those of one set
    several = several.select("k1", "k2").distinct().withColumn("several", F.lit(True))
    label = label.join(several, ["k1", "k2"], "left").join(
        long.select(F.col("a").alias("rep"), F.lit(True).alias("long")).distinct(), "rep", "left")
    label = label.join(degree, "rep", "left")
    label = stored(label, "labels")
    open_ = label.groupBy("component").agg(
        F.count(F.lit(1)).alias("m"), F.max("long").alias("long"), F.max("several").alias("several")
    ).where("m > 1 AND (several OR long AND m > 2)").select("component", "m")
    sizes = sized.groupBy("k1", "k2").agg(F.first("n").alias("n"))
    inside = label.join(open_, "component").join(sizes, ["k1", "k2"]).select("k1", "k2", "rep", "n", "component", "m")
    tiled = _degrees(stored(inside, "inside"), sets, t, tile)
    # a class that no link holds has no row in a tile of its own and no edge but those of its id
    label = label.join(tiled, ["k1", "k2"], "left").select(
        "k1", "k2", "component", F.coalesce("n_links", F.when(F.col("several").isNull(), F.col("n_edges"))).alias("n_links"))
    return members.join(label, ["k1", "k2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component,
        F.when(F.col("n") > 0, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out
