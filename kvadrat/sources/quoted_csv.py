"""Quoted CSV whose fields may hold line breaks, read in as many tasks as the file has splits.

A line break ends a record only outside quotes, so a split in the middle of a file cannot tell by
itself where records end. But whether a place lies inside quotes is the parity of the quotes
before it, so:

1. every split counts the quotes of its lines (one narrow aggregate over Spark's own line splits);
2. the running parity over the splits of a file tells each split whether it begins inside quotes;
3. every task walks its lines once with that parity and cuts records at their true ends. What is
   left at the borders of splits, at most two pieces a split, is put together by file.

An escaped quote (two of them) leaves the parity as it is. Quotes inside an unquoted field would
not; a file whose quotes do not pair up is refused by ``records`` and read by one task
instead (``read``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kvadrat.session import ship_package

OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
#: A record, or a piece of one at a border: ``part`` is 0 for a whole record, 1 for the end of one that
#: began in an earlier split, 2 for the beginning of one that ends in a later split, 3 for the middle.
_CUT = "file long, block long, pos long, part int, record string"


class UnpairedQuotes(ValueError):
    """A file has an odd number of quotes."""


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        "value", F.col("_metadata.file_path").alias("path"), F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _parities(lines: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
    """Rank of the file by path, and parity of the quotes before the split, of each split: two
    numbers a split, as the scan itself has one task."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    splits = lines.groupBy("path", "file", "block").agg((F.sum(quotes) % 2).alias("odd")).orderBy("path", "block").collect()
    before, file, rank, parity = {}, None, -1, 0
    for split in [*splits, None]:
        if split is None or split["file"] != file:
            if parity:
                raise UnpairedQuotes("a file has an odd number of quotes")
            file, rank = split and split["file"], rank + 1
        if split:
            before[split["file"], split["block"]] = rank, parity
            parity ^= split["odd"]
    return before


def _text(value: str | None) -> str:
    value = value or ""
    return value[:-1] if value.endswith("\r") else value


def _closed(values: pa.Array, ends: np.ndarray) -> pa.Array:
    """The records that end at ``ends`` after the first, without empty ones. Most are a line each, so they
    stay in Arrow."""
    starts, stops = ends[:-1] + 1, ends[1:]
    if (starts == stops).all():
        found = values.slice(ends[0] + 1, len(starts))
        cut = pc.utf8_slice_codeunits(found, 0, -1)
        found = pc.if_else(pc.ends_with(found, "\r"), cut, found)
    else:
        lines = values.to_pylist()
        found = pa.array([_text("\n".join(lines[i : j + 1])) for i, j in zip(starts.tolist(), stops.tolist())], pa.string())
    return found.filter(pc.not_equal(found, ""))


def records(spark: SparkSession, path: str) -> DataFrame:
    """file (its rank by path), block, pos (order in the block) and record of every record that is not empty."""
    ship_package(spark)
    lines = _lines(spark, path)
    before = spark.sparkContext.broadcast(_parities(lines))

    def cut(batches: Iterator[pa.RecordBatch], borders: bool) -> Iterator[pa.RecordBatch]:
        """Whole records, or else the pieces at ``borders``, in either case numbered alike."""
        now, split, parity, pending, part, pos = None, None, 0, [], 0, 0

        def made(records: pa.Array, first: int, part: int) -> pa.RecordBatch:
            n = len(records)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, split[0], "int64")), pa.array(np.full(n, split[1], "int64")), pa.array(np.arange(first, first + n)),
                 pa.array(np.full(n, part, "int32")), records.cast(pa.string())],
                names=["file", "block", "pos", "part", "record"])

        for batch in batches:
            file, block = (batch.column(c).to_numpy() for c in ("file", "block"))
            change = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
            odd = pc.count_substring(batch.column("value"), '"').to_numpy() & 1
            for a, b in zip([0, *change], [*change, batch.num_rows]):
                if a == b:
                    continue
                if now != (int(file[a]), int(block[a])):
                    if pending and borders:  # goes on in a later split
                        yield made(pa.array(["\n".join(pending)]), pos, part | 2)
                    now = int(file[a]), int(block[a])
                    rank, parity = before.value[now]
                    split, pending, pos = (rank, now[1]), [], 0
                    part = parity  # begins inside a record
                after = (parity + np.cumsum(odd[a:b])) & 1
                parity = int(after[-1])
                values = batch.column("value").slice(a, b - a)
                ends = np.flatnonzero(after == 0)
                if not len(ends):
                    pending += values.to_pylist()
                    continue
                record = _text("\n".join([*pending, *values.slice(0, ends[0] + 1).to_pylist()]))
                if part or record:
                    if borders == (part > 0):
                        yield made(pa.array([record]), pos, part)
                    pos += 1
                found = _closed(values, ends)
                if len(found) and not borders:
                    yield made(found, pos, 0)
                pos += len(found)
                pending, part = values.slice(ends[-1] + 1).to_pylist(), 0
        if pending and borders:
            yield made(pa.array(["\n".join(pending)]), pos, part | 2)

    def pieces(borders: bool) -> DataFrame:
        return lines.select("value", "file", "block").mapInArrow(lambda batches: cut(batches, borders), _CUT)

    whole = pieces(False).drop("part")
    # a piece belongs to the last split before it in which a record began and did not end
    order = Window.partitionBy("file").orderBy("block", "pos")
    began = F.last(F.when(F.col("part") == 2, F.struct("block", "pos")), ignorenulls=True).over(order)
    borders = pieces(True).withColumn("began", began)
    joined = borders.groupBy("file", "began").agg(F.array_sort(F.collect_list(F.struct("block", "pos", "record"))).alias("p"))
    joined = joined.select("file", "began.block", "began.pos", F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"))
    return whole.unionByName(joined.where("record <> ''"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings under the header's names, and ``_ord`` (file, block, position). The result
    is that of Spark's ``multiLine`` reader, which opens each file in one task."""
    reader = spark.read.option("header", True).option("inferSchema", False).options(**OPTIONS)
    whole = reader.csv(path)  # reads a header, no rows
    try:
        found = records(spark, path)
    except UnpairedQuotes:
        order = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                         F.monotonically_increasing_id().alias("pos"))
        return whole.withColumn("_ord", order)
    fields = ", ".join(f"`{c}` string" for c in whole.columns)
    rows = found.where("block > 0 OR pos > 0")  # without each file's header
    # exploded, so that a record is parsed once and not for each column
    parsed = rows.select(F.struct("file", "block", "pos").alias("_ord"), F.inline(F.array(F.from_csv("record", fields, OPTIONS))))
    return parsed.select(*(F.col(f"`{c}`") for c in whole.columns), "_ord")
