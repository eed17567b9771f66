"""Operator 12: ranked lexical search over a length-stratified index.

Every document is analysed once into its terms and their counts. With the totals of the corpus (N
documents with a term, L terms) its length gives an integer normaliser ``m``; documents of equal
``m`` are a stratum. The index deals documents to shards by hash, of about ``shard_postings``
(document, term) pairs each however large the corpus is; in a shard, a term has its documents
grouped by stratum and, within that, by tf. So one integer division per (stratum, tf) is the impact
of all documents of the group.

A search reads the rows of the terms that the queries have. In each shard, per query, every
stratum has a bound: the sum over terms of the weight times the impact of the term's largest tf
there. Strata are visited from the highest bound down, in ever larger portions, and the visit
ends where the bound falls under the k-th best score so far. The shards' lists of at most k are
merged by a window with a partial top k before the shuffle.

The impact of a term is weight * ((SCALE * tf) div (1000 * tf + 8 * m)); the score sums them over the
query's terms, repeats included, in 64-bit integers. Terms are told apart by 64-bit hashes.

Null and empty texts and texts without a term are no documents (they do not count in N) and, as
queries, find nothing. Every row is a document, so rows equal in id are ranked on their own. A null
doc_id sorts before all others. Query rows equal in id and text are one query; different texts
under one id are ranked each for itself. Scores that tie are ordered by doc_id. Empty tables give
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kvadrat.llm.common import LOWER, Words, id_text, lean, signed, steps, stored

SCALE = 1_000_000_000
SLOPE = 75
#: (document, term) pairs of a shard: what one task of a build or a search holds.
SHARD_POSTINGS = 250_000
#: Terms (with repeats) of the queries that are broadcast at a time.
BLOCK_TERMS = 200_000
_NO_ID = np.iinfo(np.int64).min
_TERM = np.zeros(256, bool)
_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: Every byte that no term has becomes a blank, A-Z become a-z.
_FOLD = np.where(_TERM, LOWER, 32).astype(np.uint8)


class Terms(Words):
    """Terms of a text column, as ``Words`` with every other character as white space."""

    fold = _FOLD


def _analysed(rows: DataFrame, keep: str) -> DataFrame:
    """``keep``, n (terms with repeats), terms and tfs (distinct, parallel) of rows with a term."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch):
                words = Terms(step.column("text"))
                n = np.diff(words.first)
                row = np.repeat(np.arange(len(n)), n)
                hashes = words.hashes()
                order = np.lexsort((hashes, row))
                row, hashes = row[order], hashes[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
                at = np.flatnonzero(new)
                tf = np.diff(np.concatenate([at, [len(row)]])).astype(np.int32)
                some = np.flatnonzero(n)
                ends = pa.array(np.searchsorted(row[at], np.concatenate([some, [len(n)]])), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [step.column(keep).take(pa.array(some)), pa.array(n[some]),
                     pa.ListArray.from_arrays(ends, pa.array(signed(hashes[at]))), pa.ListArray.from_arrays(ends, pa.array(tf))],
                    names=[keep, "n", "terms", "tfs"])

    kind = dict(rows.dtypes)[keep]
    return rows.select(keep, "text").mapInArrow(lean(make), f"{keep} {kind}, n long, terms array<long>, tfs array<int>")


@dataclass
class Index:
    """``postings``: one row per shard and term with the strata, tfs and ends of its groups of
    documents, and the documents of all groups by their number in the shard; and a row per shard
    without a term, whose documents are the ids of those numbers. ``terms``: df of every term."""

    postings: DataFrame
    terms: DataFrame
    n_docs: int
    n_terms: int


def normaliser(n: Column, n_docs: int, n_terms: int, slope: int = SLOPE) -> Column:
    """m of a document of n terms."""
    return F.lit(100 - slope) + F.floor(F.lit(slope).cast("decimal(38,0)") * n * n_docs / max(1, n_terms)).cast("long")


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_postings: int = SHARD_POSTINGS) -> Index:
    """Index of all rows of ``docs``."""
    analysed = stored(_analysed(id_text(docs, id_col, text_col), "doc_id"), "analysed")
    n_docs, n_terms, pairs = analysed.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    shards = max(1, math.ceil(pairs / shard_postings))
    # by row, not by id: rows that share an id spread too
    shard = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int").alias("shard")
    dealt = analysed.select(shard, "doc_id", normaliser(F.col("n"), n_docs, n_terms).alias("m"), "terms", "tfs")
    schema = "shard int, term long, strata array<long>, tfs array<int>, ends array<int>, docs array<long>"
    postings = stored(dealt.groupBy("shard").applyInArrow(_invert, schema), "postings")
    terms = stored(postings.where("term IS NOT NULL").groupBy("term").agg(F.sum(F.size("docs")).alias("df")), "terms")
    return Index(postings, terms, n_docs, n_terms)


def _invert(table: pa.Table) -> pa.Table:
    """The postings of a shard from its documents' terms."""
    lists = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (table.column("terms"), table.column("tfs"))]
    term, tf = (x.flatten().to_numpy() for x in lists)
    size = lists[0].value_lengths().to_numpy()
    m = np.repeat(table.column("m").to_numpy(), size)
    ids = table.column("doc_id").combine_chunks().fill_null(_NO_ID).to_numpy()
    doc = np.repeat(np.arange(len(ids)), size)
    order = np.lexsort((doc, tf, m, term))
    term, tf, m, doc = term[order], tf[order], m[order], doc[order]
    first = np.ones(len(term), bool)
    first[1:] = term[1:] != term[:-1]
    group = first.copy()
    group[1:] |= (m[1:] != m[:-1]) | (tf[1:] != tf[:-1])
    groups, terms = np.flatnonzero(group), np.flatnonzero(first)
    to_groups = np.searchsorted(groups, np.concatenate([terms, [len(term)]]))
    to_docs = np.concatenate([terms, [len(term)]])
    ends = np.concatenate([groups[1:], [len(term)]]) - np.repeat(terms, np.diff(to_groups))
    # the last row has no term and holds the ids
    made = lambda at, values: pa.ListArray.from_arrays(pa.array([*at, len(values)], pa.int32()), pa.array(values))
    return pa.table({
        "shard": pa.array(np.full(len(terms) + 1, table.column("shard")[0].as_py()), pa.int32()),
        "term": pa.concat_arrays([pa.array(term[terms]), pa.nulls(1, pa.int64())]),
        "strata": made(to_groups, m[groups]), "tfs": made(to_groups, tf[groups].astype(np.int32)),
        "ends": made(to_groups, ends.astype(np.int32)), "docs": made(to_docs, np.concatenate([doc, ids])),
    })


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(), column.value_lengths().to_numpy().astype(np.int64)


class _Shard:
    """The groups of a shard's postings, term by term."""

    def __init__(self, table: pa.Table):
        named = table.column("term").is_null()
        self.doc_id = _flat(table.filter(named).column("docs"))[0]
        table = table.filter(pc.invert(named))
        self.term = table.column("term").to_numpy()
        strata, size = _flat(table.column("strata"))
        self.tf = _flat(table.column("tfs"))[0].astype(np.int64)
        ends = _flat(table.column("ends"))[0].astype(np.int64)
        self.doc, n_docs = _flat(table.column("docs"))
        self.m, self.stratum = np.unique(strata, return_inverse=True)
        self.m_of = strata
        order = np.argsort(self.term, kind="stable")
        self.sorted_term = self.term[order]
        group_at, doc_at = np.cumsum(size) - size, np.cumsum(n_docs) - n_docs
        self.first, self.last = group_at[order], (group_at + size)[order]
        end = ends + np.repeat(doc_at, size)
        start = np.empty_like(end)
        start[1:] = end[:-1]
        start[group_at] = doc_at
        self.start, self.size = start, end - start

    def groups(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The groups of a query's terms, the term of each and its impact for the query."""
        at = np.searchsorted(self.sorted_term, terms)
        have = at < len(self.sorted_term)
        have[have] = self.sorted_term[at[have]] == terms[have]
        at, weights = at[have], weights[have]
        size = self.last[at] - self.first[at]
        which = np.repeat(np.arange(len(at)), size)
        group = np.arange(int(size.sum())) + np.repeat(self.first[at] - (np.cumsum(size) - size), size)
        tf = self.tf[group]
        return group, which, weights[which] * ((SCALE * tf) // (1000 * tf + 8 * self.m_of[group]))

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best documents with a score above 0, best first."""
        group, which, impact = self.groups(terms, weights)
        live = impact > 0
        group, which, impact = group[live], which[live], impact[live]
        if not len(group):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        stratum = self.stratum[group]
        # a term's largest impact in a stratum is that of its largest tf there: its last group
        new = np.ones(len(group), bool)
        new[:-1] = (which[1:] != which[:-1]) | (stratum[1:] != stratum[:-1])
        bound = np.zeros(len(self.m), np.int64)
        np.add.at(bound, stratum[new], impact[new])
        visit = np.argsort(-bound, kind="stable")
        visit = visit[bound[visit] > 0]
        place = np.full(len(self.m), len(visit))
        place[visit] = np.arange(len(visit))
        at = place[stratum]
        scores = np.zeros(len(self.doc_id), np.int64)
        done, portion, cut = 0, 8, 1
        while done < len(visit) and bound[visit[done]] >= cut:
            end = min(done + portion, int(np.searchsorted(-bound[visit], -cut, "right")))
            some = np.flatnonzero((at >= done) & (at < end))
            size = self.size[group[some]]
            doc = np.arange(int(size.sum())) + np.repeat(self.start[group[some]] - (np.cumsum(size) - size), size)
            np.add.at(scores, self.doc[doc], np.repeat(impact[some], size))
            if len(scores) >= k:
                cut = max(1, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
            done, portion = end, 2 * portion
        found = np.flatnonzero(scores >= cut)
        order = np.lexsort((self.doc_id[found], -scores[found]))[:k]
        return self.doc_id[found][order], scores[found][order]


def weight(df: Column, n_docs: int) -> Column:
    return F.floor(1000 * F.log((F.lit(2.0) * n_docs + 2) / (2 * df + 1))).cast("long")


def search(index: Index, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The k best documents of each query: item_id, rank (from 1), doc_id, score."""
    spark, kind = items.sparkSession, dict(items.dtypes)[id_col]
    texts = items.select(F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    # a query is named by a number; the table that tells its id is written, so it keeps it
    named = stored(texts.select(F.monotonically_increasing_id().alias("query"), "item_id", "text"), "queries")
    parts = _analysed(named, "query")
    each = parts.select("query", F.inline(F.arrays_zip("terms", "tfs"))).toDF("query", "term", "times")
    weighed = each.join(index.terms, "term").select("query", "term", (F.col("times") * weight(F.col("df"), index.n_docs)).alias("weight"))
    weighed = stored(weighed.where("weight > 0"), "query-terms")
    blocks = max(1, math.ceil(weighed.count() / block_terms))
    found = None
    for block in range(blocks):
        mine = weighed.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block)
        best = _searched(index.postings, mine, k)
        found = best if found is None else found.union(best)
    named_ids = named.select("query", "item_id")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "doc_id"))
    top = found.select("query", "doc_id", "score", rank.alias("rank")).where(F.col("rank") <= k)
    doc_id = F.when(F.col("doc_id") != int(_NO_ID), F.col("doc_id")).alias("doc_id")
    return top.join(named_ids, "query").select(F.col("item_id").cast(kind).alias("item_id"), "rank", doc_id, "score")


def _searched(postings: DataFrame, weighed: DataFrame, k: int) -> DataFrame:
    """query, doc_id, score: the k best of every shard. ``weighed``, bounded by the caller, is broadcast."""
    table = weighed.toArrow()
    query, term, weights = (table[c].to_numpy() for c in ("query", "term", "weight"))
    order = np.argsort(query, kind="stable")
    shared = postings.sparkSession.sparkContext.broadcast((query[order], term[order], weights[order]))
    schema = "query long, doc_id long, score long"

    def best(shard: pa.Table) -> pa.Table:
        query, term, weights = shared.value
        held, out = _Shard(shard), []
        starts = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else []
        for a, b in zip(starts, [*starts[1:], len(query)]):
            doc, score = held.best(term[a:b], weights[a:b], k)
            out.append((np.full(len(doc), query[a]), doc, score))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query", "doc_id", "score"])

    read = postings.join(weighed.select("term").distinct(), "term", "left_semi").unionByName(postings.where("term IS NULL"))
    return read.groupBy("shard").applyInArrow(best, schema)
