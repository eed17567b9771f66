"""Structured Streaming jobs.

R1 ingests fetched pages and appends the listings of URLs not stored before; only their pages
are parsed, once, and pages that cannot be parsed go to a side output. The
listing model has no event time, so a ``dropDuplicates`` state would grow without bound;
the default mode therefore checks each micro-batch against a store of seen URLs inside
``foreachBatch`` (``sources.seen``: hash buckets with Bloom filters, so a batch reads the buckets
that may hold one of its URLs and no others; a backfill is added like a batch).
``mode="state"`` keeps the URL set in the state store instead (use the RocksDB provider
for large state). Each batch writes
its own ``batch_id=<n>`` folder in overwrite mode, so a replayed batch replaces its own
output and never duplicates rows (idempotent sink, exactly-once with the checkpoint).

R2 scores a stream of requests with a fitted pipeline; valid rows go to the predictions
sink, rejected rows (with their errors) to a side sink, both per batch and idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kvadrat.operators import extraction as X
from kvadrat.operators import scoring as P
from kvadrat.sources.seen import SeenUrls


def ingest_pages(
    spark: SparkSession,
    pages_stream: DataFrame,
    sink: str,
    checkpoint: str,
    mode: str = "anti_join",
    available_now: bool = True,
    failures: str | None = None,
    seen: str | None = None,
    buckets: int = 256,
):
    """Pages stream -> listings not yet stored (by url) -> append to ``sink``; url and
    error of pages that cannot be parsed go to ``failures`` if it is given, and such pages are
    tried again when they come again. Of a batch's pages with one url, that with the smallest html is
    taken. ``seen`` is the folder of the URL store (default: beside the sink), ``buckets`` its size."""
    if mode == "state":
        q = (
            X.extract_listings(pages_stream.dropDuplicates(["url"]))
            .writeStream.format("parquet")
            .option("path", sink)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
        )
    else:

        def write_batch(batch: DataFrame, batch_id: int) -> None:
            store = SeenUrls(batch.sparkSession, seen or f"{sink.rstrip('/')}-seen", buckets)
            fresh = store.fresh(batch.groupBy("url").agg(F.min("html").alias("html")), batch_id)
            results = X.extract_results(fresh).persist()
            ok, failed = X.split_failures(results)
            ok.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
            store.add(ok, batch_id)  # after the rows: a batch cut off between the two is replayed whole
            if failures is not None:
                failed.write.mode("overwrite").parquet(f"{failures}/batch_id={batch_id}")
            results.unpersist()

        q = pages_stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="30 seconds")
    return q.start()


def score_stream(
    requests_stream: DataFrame,
    pipeline_model,
    predictions_sink: str,
    rejected_sink: str,
    checkpoint: str,
    available_now: bool = True,
):
    """R2: validate + score each micro-batch; two idempotent per-batch outputs."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        scored, rejected = P.score(batch, pipeline_model)
        scored.write.mode("overwrite").parquet(f"{predictions_sink}/batch_id={batch_id}")
        rejected.select("input_id", "errors").write.mode("overwrite").parquet(f"{rejected_sink}/batch_id={batch_id}")
        batch.unpersist()

    q = requests_stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="30 seconds")
    return q.start()
