"""Operator 10: line dedup by winnowing, in DataFrame functions alone.

The lines of a text are its ``\\n``-split pieces; blank ones take no part, the others are
compared without white space at their ends. Every window of ``min_run`` lines selects its
smallest line hash (the rightmost of equals) as fingerprint, so two equal runs of that length
always select the same fingerprint at the same place of the run. Fingerprints are counted over
the corpus; around those that occur more than once the match is extended to both sides: each
window that selected the fingerprint is compared as a whole, by a 128-bit hash, and every
occurrence but the first, by (doc_id, text hash, place), loses its lines. Longer repeats are
unions of such windows. No pair of occurrences is ever formed, so a line, run or document with
any number of copies costs one row per copy, counted before it is shuffled.

Null text counts as empty; a null doc_id sorts first; rows equal in id and text are one document
(all get its result). Texts with fewer than ``min_run`` lines stay as they are, unless
``long_words`` is given: shorter runs that hold at least so many words then count as windows too,
found by the hash of their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kvadrat.functions.text import let
from kvadrat.llm.common import id_text, row_struct

MIN_RUN = 3
#: Words that make a passage of a run shorter than MIN_RUN.
LONG_WORDS = 50
_BLANKS = " \t\x0b\x0c\r"


def _solid(lines: Column) -> Column:
    """Positions of the lines that are not blank."""
    places = F.transform(lines, lambda x, i: F.when(F.btrim(x, F.lit(_BLANKS)) != "", i))
    return F.filter(places, lambda i: i.isNotNull())


def _solid_lines(text: Column) -> Column:
    """The lines that are not blank, without white space at their ends."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_BLANKS))), lambda x: x != "")


def _fingerprints(text: Column, run: int) -> Column:
    """array<struct<fh, at, windows array<struct<i, k1, k2>>>>: selected places of a text."""

    def of(h: Column) -> Column:
        def window(i: Column) -> Column:
            part = F.slice(h, i + 1, run)
            low = F.array_min(part)
            return F.struct(
                low.alias("fh"),
                (i + run - F.array_position(F.reverse(part), low)).cast("int").alias("at"),
                i.cast("int").alias("i"),
                F.xxhash64(part).alias("k1"),
                F.xxhash64(F.reverse(part), F.lit(run)).alias("k2"),
            )

        places = F.when(F.size(h) >= run, F.sequence(F.lit(0), F.size(h) - run)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, window)

    return let(F.transform(_solid_lines(text), lambda x: F.xxhash64(x)), of)


def _long_windows(text: Column, run: int, words: int) -> Column:
    """array<struct<i, size, k1, k2>>: windows of fewer than ``run`` lines, ``words`` words or more."""

    def of(lines: Column) -> Column:
        def windows(n: Column, size: int) -> Column:
            places = F.when(F.size(n) >= size, F.sequence(F.lit(0), F.size(n) - size)).otherwise(F.array().cast("array<int>"))
            held = lambda i: sum((F.element_at(n, i + 1 + k) for k in range(size)), F.lit(0))

            def window(i: Column) -> Column:
                passage = F.array_join(F.slice(lines, i + 1, size), "\n")
                return F.struct(i.cast("int").alias("i"), F.lit(size).alias("size"),
                                F.xxhash64(passage).alias("k1"), F.xxhash64(F.lit(size), passage).alias("k2"))

            return F.transform(F.filter(places, lambda i: held(i) >= words), window)

        counts = F.transform(lines, lambda x: F.size(F.split(x, f"[{_BLANKS}]+")))
        return let(counts, lambda n: F.concat(*(windows(n, size) for size in range(1, run))))

    return let(_solid_lines(text), of)


def removed_runs(docs: DataFrame, min_run: int = MIN_RUN, long_words: int | None = None) -> DataFrame:
    """(doc_id, tie, runs array<struct<i, size>>): windows of ``min_run`` lines, or fewer with
    ``long_words`` words, by the place of their first line among the lines that are not blank, that
    occur earlier. ``docs`` has doc_id, text, tie."""
    windows = docs.select("doc_id", "tie", F.inline(_fingerprints(F.col("text"), min_run)))
    # several windows select one place: more than one place shows as two place hashes
    place = F.xxhash64("doc_id", "tie", "at")
    often = windows.groupBy("fh").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("fh")
    near = windows.join(often, "fh").select("doc_id", "tie", "i", F.lit(min_run).alias("size"), "k1", "k2")
    if long_words is not None and min_run > 1:
        near = near.union(docs.select("doc_id", "tie", F.inline(_long_windows(F.col("text"), min_run, long_words))))
    first = near.groupBy("k1", "k2").agg(
        F.min(F.struct("doc_id", "tie", "i")).alias("first"), F.count(F.lit(1)).alias("n")
    ).where("n > 1")
    later = near.join(first.drop("n"), ["k1", "k2"]).where(~F.struct("doc_id", "tie", "i").eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "tie").agg(F.collect_set(F.struct("i", "size")).alias("runs"))


def dedup_lines(
    docs: DataFrame, min_run: int = MIN_RUN, id_col: str = "doc_id", text_col: str = "text", long_words: int | None = None
) -> DataFrame:
    """One row per document row: doc_id, n_lines (not blank), n_removed, kept_text."""
    rows = id_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    runs = removed_runs(rows, min_run, long_words).select(
        F.col("doc_id").alias("run_id"), F.col("tie").alias("run_tie"), "runs"
    )
    joined = rows.join(runs, rows["doc_id"].eqNullSafe(runs["run_id"]) & (rows["tie"] == runs["run_tie"]), "left")
    return joined.select("doc_id", F.inline(F.array(_kept(F.col("text"), F.col("runs")))))


def _kept(text: Column, runs: Column) -> Column:
    """struct<n_lines, n_removed, kept_text>."""

    def of(lines: Column) -> Column:
        def cut(solid: Column) -> Column:
            gone = F.array_distinct(F.flatten(F.transform(runs, lambda r: F.slice(solid, r["i"] + 1, r["size"]))))
            left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
            kept = F.array_join(F.transform(left, lambda j: F.element_at(lines, j + 1)), "\n")
            return F.struct(
                F.size(solid).cast("long").alias("n_lines"),
                F.when(runs.isNull(), F.lit(0)).otherwise(F.size(gone)).cast("long").alias("n_removed"),
                F.when(runs.isNull(), text).otherwise(kept).alias("kept_text"),
            )

        return let(_solid(lines), cut)

    return let(F.split(text, "\n"), of)


def without_repeats(
    docs: DataFrame, min_run: int = MIN_RUN, id_col: str = "doc_id", text_col: str = "text", long_words: int | None = None
) -> DataFrame:
    """``docs`` with its later repeated runs of lines cut out of ``text_col``, all columns kept.
    Rows that lose every line go."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    held = docs.select(row_struct(docs), F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("tie"), text.alias("whole"))
    rows = held.select(F.col("id").alias("doc_id"), F.col("whole").alias("text"), "tie")
    runs = removed_runs(rows, min_run, long_words)
    joined = held.join(runs, held["id"].eqNullSafe(runs["doc_id"]) & (held["tie"] == runs["tie"]), "left")
    cut = joined.select("row", "runs", _kept(F.col("whole"), F.col("runs")).alias("cut"))
    left = F.col("runs").isNull() | (F.col("cut.n_removed") < F.col("cut.n_lines"))
    new = F.when(F.col("runs").isNull(), F.col("row")[text_col].cast("string")).otherwise(F.col("cut.kept_text"))
    return cut.where(left).select(*((new if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns))
