"""Streaming: R1 skips URLs stored by earlier batches; R2 splits valid and rejected."""

import os
import tempfile

from kvadrat.streaming import jobs

PAGE = "<html><body><h1>{t}</h1></body></html>"


def test_ingest_skips_urls_from_earlier_batches(spark):
    root = tempfile.mkdtemp(prefix="kv-stream-", dir="/tmp")
    src = os.path.join(root, "in")
    schema = "url string, html string"
    spark.createDataFrame([("u1", PAGE.format(t="a")), ("u2", PAGE.format(t="b"))], schema).coalesce(1).write.parquet(
        os.path.join(src, "b1")
    )
    spark.createDataFrame([("u2", PAGE.format(t="b again")), ("u3", PAGE.format(t="c"))], schema).coalesce(1).write.parquet(
        os.path.join(src, "b2")
    )
    stream = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .parquet(src)
    )
    sink = os.path.join(root, "sink")
    q = jobs.ingest_pages(spark, stream, sink, os.path.join(root, "ckpt"))
    q.awaitTermination()
    rows = spark.read.parquet(sink).collect()
    urls = sorted(r["url"] for r in rows)
    assert urls == ["u1", "u2", "u3"]
    assert {r["batch_id"] for r in rows} == {0, 1}
    assert [r["title"] for r in rows if r["url"] == "u2"] == ["b"]  # the first copy stays


def test_scoring_stream_splits_rejected(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    root = tempfile.mkdtemp(prefix="kv-score-", dir="/tmp")
    train = spark.createDataFrame([(float(a), 1000.0 * a) for a in range(20, 80)], "area_m2 double, price_eur double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["area_m2"], outputCol="features"),
                             LinearRegression(labelCol="price_eur")]).fit(train)
    req_schema = ("input_id string, city string, region string, street string, area_m2 string, rooms string, "
                  "heating_type string, parking string, floor string, total_floors string, year_built string, "
                  "is_lux boolean, is_penthouse boolean, is_duplex boolean")
    src = os.path.join(root, "req")
    spark.createDataFrame(
        [("ok", "A", "r", None, "50", None, "h", "p", "1", "3", None, False, False, False),
         ("bad", "", "r", None, "5", None, "h", "p", None, None, None, False, False, False)],
        req_schema,
    ).write.parquet(src)
    stream = spark.readStream.schema(req_schema).parquet(src)
    preds, rej = os.path.join(root, "pred"), os.path.join(root, "rej")
    jobs.score_stream(stream, model, preds, rej, os.path.join(root, "ckpt")).awaitTermination()
    p = spark.read.parquet(preds).collect()
    r = spark.read.parquet(rej).collect()
    assert [x["input_id"] for x in p] == ["ok"] and abs(p[0]["predicted_price_eur"] - 50000.0) < 1e-3
    assert [x["input_id"] for x in r] == ["bad"] and "city je obavezno polje" in r[0]["errors"]


def test_ingest_state_mode_dedups_across_batches(spark):
    root = tempfile.mkdtemp(prefix="kv-state-", dir="/tmp")
    src = os.path.join(root, "in")
    schema = "url string, html string"
    for i, rows in enumerate([[("u1", PAGE.format(t="a"))], [("u1", PAGE.format(t="again")), ("u2", PAGE.format(t="b"))]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(src, f"b{i}"))
    stream = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .parquet(src)
    )
    sink = os.path.join(root, "sink")
    jobs.ingest_pages(spark, stream, sink, os.path.join(root, "ckpt"), mode="state").awaitTermination()
    rows = spark.read.parquet(sink).collect()
    assert sorted(r["url"] for r in rows) == ["u1", "u2"]
    assert [r["title"] for r in rows if r["url"] == "u1"] == ["a"]


def test_seen_store_reads_only_touched_buckets(spark, tmp_path):
    from kvadrat.sources.seen import SeenUrls

    store = SeenUrls(spark, str(tmp_path / "seen"), buckets=16, bits=1 << 12)
    urls = lambda names: spark.createDataFrame([(n, 1) for n in names], "url string, x int")
    first = urls([f"u{i}" for i in range(200)] + ["u1", None])
    assert store.fresh(first, 0).count() == 202  # nothing is stored yet
    store.add(first, 0)
    store.add(urls(["v1", "v2"]), 1)
    again = urls(["u3", "new1", "new2", "v1"])
    assert {r["url"] for r in store.fresh(again, 2).collect()} == {"new1", "new2"}
    assert {r["url"] for r in store.fresh(again, 1).collect()} == {"new1", "new2", "v1"}  # a replay of batch 1
    maybe = [r["bucket"] for r in store.maybe_seen(urls(["u3"]), 2).collect()]
    assert len(maybe) == 1
    some = store.urls(2, maybe)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    # every stored url is found: a filter never says "never" of one
    assert store.fresh(urls([f"u{i}" for i in range(200)]), 2).count() == 0
    store.add(urls(["w"]), 1)  # replaces what batch 1 had stored
    assert {r["url"] for r in store.fresh(urls(["v1", "w"]), 2).collect()} == {"v1"}
