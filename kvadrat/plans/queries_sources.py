"""Registry entries for sources and sinks (S) and the two streaming jobs (R)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kvadrat import schema as S
from kvadrat.plans import frames
from kvadrat.plans.oracle import q
from kvadrat.plans.queries_extract import _FRONTIER_SQL, _frontier
from kvadrat.plans.queries_score import _OLS_SQL, _linear_area
from kvadrat.plans.queries_stats import _re, _rs
from kvadrat.plans.registry import register
from kvadrat.session import checkpoint_dir
from kvadrat.sources import listings as L
from kvadrat.sources import sinks
from kvadrat.plans import testview
from kvadrat.streaming import jobs

_TEXT = [c for c in S.RAW_COLUMNS if c not in S.NUMERIC_RAW_COLUMNS]
_TOKENS = ", ".join("'" + t.replace("'", "''") + "'" for t in S.NA_TOKENS)


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _na_sql(c: str) -> str:
    return f"case when {c} in ({_TOKENS}) then null else {c} end as {c}"


_LOADED_SQL = q("select " + ", ".join(_na_sql(c) if c in _TEXT else c for c in S.RAW_COLUMNS) + " from raw")


@register("s1_load_listings", _LOADED_SQL)
def s1(spark, sf):
    """Listings written as CSV (quoted, multi-line safe) by Spark, then loaded, validated
    and typed by the listings source."""
    path = _scratch(spark, "listings-csv")
    sinks.append_listings(frames.raw(spark, sf, deal=True), path)
    return L.load_listings(spark, path, min_rows=1).select(*S.RAW_COLUMNS)


@register("s2_na_tokens", _LOADED_SQL)
def s2(spark, sf):
    raw = frames.raw(spark, sf)
    return raw.select(*[L.na_to_null(c).alias(c) if c in _TEXT else F.col(c) for c in S.RAW_COLUMNS])


@register(
    "s4_validate_numeric",
    q(
        "select count(*) as rows, "
        + ", ".join(
            f"count_if(cast({c} as varchar) is not null and trim(cast({c} as varchar)) <> '' "
            f"and try_cast(trim(cast({c} as varchar)) as double) is null)::bigint as {c}"
            for c in S.NUMERIC_RAW_COLUMNS
        )
        + " from raw"
    ),
)
def s4(spark, sf):
    return L.numeric_problems(frames.raw(spark, sf))


@register("s6_url_list_io", _FRONTIER_SQL + "select url from frontier")
def s6(spark, sf):
    path = _scratch(spark, "urls")
    frontier = _frontier(spark, sf).withColumn("line", F.struct("stage", "page", "pos"))
    sinks.write_url_list(frontier, path, "line")
    return sinks.read_url_list(spark, path, None, r"^/[A-Za-z]+/?$").select("url")


# --- streaming -------------------------------------------------------------------------


def _stream_table(spark, sf, name: str):
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


@register("r1_stream_ingest", "select url, batch_id from (select distinct url, 0::bigint as batch_id from pages) union all "
          "select distinct url || '?again', 1::bigint from pages")
def r1(spark, sf):
    """Two batches: all pages, then all pages again along with as many under new URLs; of the second
    only those are stored."""
    src, sink, ckpt = _scratch(spark, "r1-in"), _scratch(spark, "r1-sink"), _scratch(spark, "r1-ckpt")
    pages = testview.read_table(spark, sf, "pages").select("url", "html")
    new = pages.select(F.concat("url", F.lit("?again")).alias("url"), "html")
    for batch in (pages, pages.unionByName(new)):
        batch.write.mode("append").parquet(src)
        stream = spark.readStream.schema(pages.schema).parquet(src)
        jobs.ingest_pages(spark, stream, sink, ckpt, buckets=8).awaitTermination()
    return spark.read.parquet(sink).select("url", F.col("batch_id").cast("bigint").alias("batch_id"))


@register(
    "r2_stream_scoring",
    q(
        _OLS_SQL
        + f", scored as (select input_id, greatest(0.0, a + b * area_m2) as p from score_model, ols) "
        f"select input_id, {_re('p', 2)} as predicted_price_eur from scored"
    ),
)
def r2(spark, sf):
    t = {n: spark.read.parquet(f"{sf}/{n}.parquet") for n in ["part", "supplier", "nation", "region"]}
    li = _stream_table(spark, sf, "lineitem")
    joined = (
        li.join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
        .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    )
    requests = joined.select(*[F.expr(e.replace("varchar", "string")).alias(n) for n, e in testview.SCORE_COLUMNS])
    preds, rejected, ckpt = _scratch(spark, "r2-pred"), _scratch(spark, "r2-rej"), _scratch(spark, "r2-ckpt")
    q_ = jobs.score_stream(requests, _linear_area(spark, sf), preds, rejected, ckpt)
    q_.awaitTermination()
    return spark.read.parquet(preds).select("input_id", _rs("predicted_price_eur", 2))


@register("s3_s5_validate_raw", q("select count(*) as rows, 13 as columns, 'price_eur' as target_column from raw"))
def s3_s5(spark, sf):
    """Shape summary of the validated raw listings (missing columns or too few rows raise)."""
    raw = frames.raw(spark, sf)
    summary = L.validate(raw.select(*S.RAW_COLUMNS), min_rows=1)
    return L.numeric_problems(raw).select(
        F.col("rows"), F.lit(summary["columns"]).alias("columns"), F.lit(summary["target_column"]).alias("target_column")
    )


@register("s9_s10_train_and_save")
def s9_s10(spark, sf):
    """Rows-only: train two candidates, save every pipeline and the metadata tables under
    the checkpoint folder, reload the best pipeline and score the test rows with it."""
    from kvadrat.operators import modeling as M
    from kvadrat.plans import training

    out = _scratch(spark, "models")
    specs = [("Baseline - DummyRegressor median", "dummy_median"), ("LinearRegression", "linear_regression")]
    res = training.train_and_save(
        spark, frames.ordered(spark, sf), out, specs, sizes=M.SMALL, order_col=testview.FIRST_ORDER)
    name, best = sinks.load_best(spark, out)
    metrics = spark.read.json(f"{res['metadata_dir']}/metrics")
    labelled = res["model"].filter(F.col(S.TARGET).isNotNull())
    test = M.with_split(labelled).filter("is_test")
    scored = best.transform(test).agg(F.count_if(~F.isnan("prediction")).alias("scored_with_best"))
    return (
        metrics.select("model", "mae", "rmse", "r2", "rank_by_mae")
        .withColumn("is_best", F.col("model") == F.lit(name))
        .crossJoin(F.broadcast(scored))  # one row
    )
