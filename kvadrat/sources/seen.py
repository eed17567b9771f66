"""Store of seen URLs in hash buckets, with a Bloom filter per bucket.

A batch asks which of its URLs were stored by earlier batches. The filters of its buckets answer
"never" for nearly all new ones; only buckets that may hold one are read, and of the URL
files only those folders (``bucket`` is a partition column, so Spark prunes the files). Filters
and URLs are written per batch and bucket in overwrite mode: a replayed batch replaces its own.

A filter is the set of its words that are not zero, as rows (bucket, word, bits); a URL has
``hashes`` bits in its bucket's filter. Building one is an aggregate with ``bit_or``, asking one
an equi-join on (bucket, word): both stay in Spark's own expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvadrat.session import checkpointed
from kvadrat.sources.scan import if_present


@dataclass(frozen=True)
class SeenUrls:
    """``path``: a folder on shared storage. ``buckets``, ``bits`` (of a bucket's filter) and ``hashes`` are
    fixed for the life of a store: about 10 bits per URL of a bucket keep false answers near 1 %,
    and a false answer only costs reading a bucket."""

    spark: SparkSession
    path: str
    buckets: int = 256
    bits: int = 1 << 26
    hashes: int = 4

    def _keyed(self, urls: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64("url"), F.lit(self.buckets)).cast("int")
        return urls.select("url", bucket.alias("bucket"))

    def _bits(self, keyed: DataFrame) -> DataFrame:
        """(url, bucket, word, mask): the bits of every URL in its bucket's filter."""
        places = [F.pmod(F.xxhash64(F.lit(i), F.col("url")), F.lit(self.bits)) for i in range(1, self.hashes + 1)]
        each = keyed.select("url", "bucket", F.explode(F.array(*places)).alias("place"))
        one = F.lit(1).cast("bigint")
        mask = F.call_function("shiftleft", one, F.pmod("place", F.lit(64)).cast("int"))
        return each.select("url", "bucket", F.floor(F.col("place") / 64).cast("int").alias("word"), mask.alias("mask"))

    def _stored(self, what: str, schema: str, before_batch: int, buckets: list[int]) -> DataFrame | None:
        read = lambda: self.spark.read.schema(f"{schema}, batch_id long, bucket int").parquet(f"{self.path}/{what}")
        found = if_present(read)
        if found is None:
            return None
        return found.filter((F.col("batch_id") < before_batch) & F.col("bucket").isin(buckets))

    def urls(self, before_batch: int, buckets: list[int]) -> DataFrame | None:
        """Stored URLs of some buckets: a scan of those folders alone."""
        return self._stored("urls", "url string", before_batch, buckets)

    def add(self, urls: DataFrame, batch_id: int) -> None:
        """Store the URLs of a batch. ``urls`` has a column url; null URLs are not stored."""
        keyed = self._keyed(urls.where("url IS NOT NULL").select("url").distinct())
        # distinct URLs spread evenly over buckets; one file a bucket
        keyed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/urls/batch_id={batch_id}")
        words = self._bits(keyed).groupBy("bucket", "word").agg(F.bit_or("mask").alias("bits"))
        words.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/filters/batch_id={batch_id}")

    def maybe_seen(self, urls: DataFrame, before_batch: int) -> DataFrame | None:
        """(url, bucket) that the filters do not rule out; None where nothing is stored yet."""
        keyed = self._keyed(urls.where("url IS NOT NULL").select("url").distinct())
        touched = [r["bucket"] for r in keyed.select("bucket").distinct().collect()]  # at most ``buckets``
        filters = self._stored("filters", "word int, bits long", before_batch, touched)
        if filters is None:
            return None
        filters = filters.groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
        hits = self._bits(keyed).join(filters, ["bucket", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) != 0)
        # two bits of a URL can fall together, so they are counted as rows, one a hash
        return hits.groupBy("url", "bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == self.hashes).drop("n")

    def fresh(self, rows: DataFrame, before_batch: int) -> DataFrame:
        """``rows`` (with a column url) whose URL no earlier batch has stored."""
        maybe = self.maybe_seen(rows, before_batch)
        if maybe is None:
            return rows
        maybe = checkpointed(maybe)
        buckets = [r["bucket"] for r in maybe.select("bucket").distinct().collect()]
        if not buckets:  # no file of URLs is opened
            return rows
        seen = self.urls(before_batch, buckets).select("url").join(maybe.select("url"), "url", "left_semi")
        return rows.join(seen, "url", "left_anti")
