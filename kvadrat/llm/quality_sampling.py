"""Operator 4: quality classifier by importance resampling.

Hashed word unigrams and bigrams make two generative models: of the target (labelled texts of
quality 1 that are not toxic: half of them by id hash, at most ``max_labelled``, those with the
smallest hash) and of the raw text (every document). A document's log weight is the sum of log p_target - log
p_raw over its n-grams, less ``tilt`` per n-gram; the tilt is the ``keep_share`` point of the
mean log ratios of the other half, which the models have not seen, so nearly all of them weigh
over one. As many documents as weigh over
one are sampled without replacement by Gumbel top-k: those with the largest log weight /
temperature + Gumbel noise; the noise is a hash of id and text, so a row always gets the same.

Null text or a text without words has log weight 0 and counts as weighing one; a null doc_id is
allowed; equal rows get the same verdict, and all rows that tie at the cut are kept; an empty
table gives an empty result; without any labelled target text every document weighs one and is
kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from kvadrat.llm.common import Words, id_text, lean, mix, steps, stored, unused
from kvadrat.session import ship_package

BUCKETS = 1 << 18
_BLOCK = 1 << 12


def _buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each n-gram, row of each, n-grams per row); bigrams have buckets of their own."""
    words = Words(column)
    h = words.hashes()
    n = np.diff(words.first)
    row = np.repeat(np.arange(len(n)), n)
    pairs = np.flatnonzero(row[:-1] == row[1:]) if len(row) else row
    two = mix(h[pairs] * np.uint64(0x9E3779B97F4A7C15) + h[pairs + 1]) if len(pairs) else h[:0]
    low = np.uint64(BUCKETS - 1)
    buckets = np.concatenate([(h & low).astype(np.int64), (two & low).astype(np.int64) + BUCKETS])
    return buckets, np.concatenate([row, row[pairs]]), n + np.maximum(n - 1, 0)


def _counts(rows: DataFrame, target: np.ndarray) -> np.ndarray:
    """n-gram counts of all rows and of the target ids: each task counts into two vectors of fixed
    size, whose blocks (compressed, for most counts of a task are 0) are summed by block number."""
    shared = rows.sparkSession.sparkContext.broadcast(target)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 2 * BUCKETS), np.int64)
        for batch in batches:
            for step in steps(batch):
                buckets, row, _ = _buckets(step.column("text"))
                total[0] += np.bincount(buckets, minlength=2 * BUCKETS)
                mine = np.isin(step.column("doc_id").to_numpy(zero_copy_only=False), shared.value)
                total[1] += np.bincount(buckets[mine[row]], minlength=2 * BUCKETS)
        yield from _as_blocks(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                sums[block] = sums.get(block, 0) + _unpacked(data)
        if sums:
            yield pa.RecordBatch.from_pydict({"block": pa.array(list(sums), pa.int32()), "counts": [_packed(s) for s in sums.values()]})

    schema = "block int, counts binary"
    summed = rows.mapInArrow(lean(count), schema).repartition("block").mapInArrow(lean(add), schema).toArrow()
    out = np.zeros(4 * BUCKETS, np.int64)
    for block, data in zip(summed["block"].to_pylist(), summed["counts"].to_pylist()):
        out[block * _BLOCK : (block + 1) * _BLOCK] = _unpacked(data)
    return out.reshape(2, -1)


def _as_blocks(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    blocks = total.reshape(-1, _BLOCK)
    some = np.flatnonzero(blocks.any(axis=1))
    if len(some):
        yield pa.RecordBatch.from_pydict({"block": pa.array(some, pa.int32()), "counts": [_packed(blocks[i]) for i in some]})


def _packed(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.int64)


def _ratios(counts: np.ndarray, prior: float = 8.0) -> np.ndarray:
    """log p_target - log p_raw of each bucket, drawn to 0 by ``prior`` n-grams as the raw text
    has them: rare n-grams say little. Unigrams and bigrams are distributions of their own."""
    out = []
    for raw, target in zip(np.split(counts[0], 2), np.split(counts[1], 2)):
        if not target.sum():
            out.append(np.zeros(BUCKETS))
            continue
        expected = raw * (target.sum() / max(1, raw.sum()))
        out.append(np.log((target + prior) / (expected + prior)))
    return np.concatenate(out).astype(np.float32)


def _scored(rows: DataFrame, ratios) -> DataFrame:
    """doc_id, tie, n_grams and the sum of log ratios of each row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch):
                total, n = _sums(step.column("text"), ratios.value)
                yield pa.RecordBatch.from_arrays(
                    [step.column("doc_id"), step.column("tie"), pa.array(n), pa.array(total)],
                    names=["doc_id", "tie", "n_grams", "log_ratio"])

    return rows.mapInArrow(lean(make), "doc_id long, tie long, n_grams long, log_ratio double")


def _sums(column: pa.Array, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    buckets, row, n = _buckets(column)
    # without any n-gram bincount forgets that the weights are floats
    return np.bincount(row, weights=ratios[buckets].astype(float), minlength=len(n)).astype(np.float64).round(6), n


def _noise(*key: Column) -> Column:
    """Gumbel noise from a hash."""
    u = (F.pmod(F.xxhash64(*key), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def kth_largest(values: DataFrame, column: str, k: int, bins: int = 4096) -> float:
    """The exact k-th largest value: histograms of ever narrower ranges, a few counts each."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    while low < high:
        width = (high - low) / bins
        if low + width <= low or high - width >= high:
            inside = values.where(F.col(column).between(low, high)).groupBy(column).count()
            for value, n in inside.orderBy(F.desc(column)).toLocalIterator():
                k -= n
                if k <= 0:
                    return value
        bin_ = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).alias("bin")
        counts = values.where(F.col(column).between(low, high)).groupBy(bin_).agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        for row in sorted(counts, key=lambda r: -r["bin"]):
            if k <= row["n"]:
                low, high = row["low"], row["high"]
                break
            k -= row["n"]
    return low


class Model:
    """Fitted on documents and labels; judges rows one by one."""

    def __init__(self, ratios: np.ndarray, tilt: float, cut: float, temperature: float):
        self.ratios, self.tilt, self.cut, self.temperature = ratios, tilt, cut, temperature

    def log_weight(self, log_ratio: Column, n_grams: Column) -> Column:
        return F.round(log_ratio - self.tilt * n_grams, 6)

    def key(self, log_ratio: Column, n_grams: Column, doc_id: Column, tie: Column) -> Column:
        """What rows are ranked by: log weight over temperature, and Gumbel noise."""
        return self.log_weight(log_ratio, n_grams) / self.temperature + _noise(doc_id, tie)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 50_000, keep_share: float = 0.01, temperature: float = 1.0) -> tuple[Model, DataFrame]:
    """The model, and every document's doc_id, n_grams, log_weight and key."""
    spark = docs.sparkSession
    rows = id_text(docs).withColumn("tie", F.xxhash64("text"))
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))
    target = np.sort(good.where(half == 0).orderBy(F.xxhash64("doc_id")).limit(max_labelled).toArrow()["doc_id"].to_numpy())
    ratios = _ratios(_counts(rows, target))
    scored = stored(_scored(rows, spark.sparkContext.broadcast(ratios)), "scores")
    mean = scored.where("n_grams > 0").join(good.where(half == 1), "doc_id", "left_semi").select((F.col("log_ratio") / F.col("n_grams")).alias("m"))
    n = mean.count()
    tilt = kth_largest(mean, "m", max(1, n - int(keep_share * n))) if n and len(target) else 0.0
    model = Model(ratios, tilt, float("inf"), temperature)
    ratio, n_grams = F.col("log_ratio"), F.col("n_grams")
    keyed = scored.withColumn("log_weight", model.log_weight(ratio, n_grams)).withColumn(
        "key", model.key(ratio, n_grams, F.col("doc_id"), F.col("tie")))
    k = keyed.where("log_weight >= 0").count()
    if k:
        model.cut = kth_largest(keyed, "key", k)
    return model, keyed.withColumn("kept", F.col("key") >= model.cut)


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document row: doc_id, n_grams, log_weight, kept."""
    return fit(docs, labels, **options)[1].select("doc_id", "n_grams", "log_weight", "kept")


def kept_rows(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are sampled, all columns as they are; no row is shuffled. Text of
    another type is judged as its string."""
    ship_package(docs.sparkSession)
    model, _ = fit(docs, labels, **options)
    shared = docs.sparkSession.sparkContext.broadcast(model.ratios)
    names = docs.columns
    text, ratio, n_grams = unused(names, "text", "ratio", "n_grams") if dict(docs.dtypes)["text"] != "string" else ("text", *unused(names, "ratio", "n_grams"))
    if text != "text":
        docs = docs.withColumn(text, F.col("text").cast("string"))
    wide = StructType([*docs.schema.fields, StructField(ratio, DoubleType()), StructField(n_grams, LongType())])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, text):
                total, n = _sums(step.column(text), shared.value)
                yield pa.RecordBatch.from_arrays([*step.columns, pa.array(total), pa.array(n)], names=wide.names)

    weighed = docs.mapInArrow(lean(weigh), wide)
    tie = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    key = model.key(F.col(ratio), F.col(n_grams), F.col("doc_id").cast("long"), tie)
    return weighed.where(key >= model.cut).select(*(F.col(f"`{c}`") for c in names))
