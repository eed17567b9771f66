"""Sinks and small list sources (S6-S10): URL lists, listing appends, failure side output,
run metadata tables and the model store. Everything is written with the DataFrame writer
or Spark ML persistence, so it goes to whatever shared file system the paths name."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvadrat import schema as S
from kvadrat.functions.urls import canonicalize_url
from kvadrat.sources.listings import position_order
from kvadrat.sources.scan import if_present


# --- S6: URL lists ------------------------------------------------------------------


def read_url_list(
    spark: SparkSession, path: str, netloc: str | None = S.BASE_NETLOC, path_pattern: str = S.LISTING_PATH_PATTERN
) -> DataFrame:
    """Lines of a URL list that canonicalize, as (url, line) in file order."""
    lines = spark.read.text(path).select(F.trim("value").alias("raw"), position_order().alias("line"))
    return lines.select(canonicalize_url("raw", netloc, path_pattern).alias("url"), "line").filter(F.col("url").isNotNull())


def write_url_list(urls: DataFrame, path: str, order_col: str = "line") -> None:
    """One URL per line, in ``order_col`` order (range-partitioned sort: part files are in
    order, no single-task sort)."""
    urls.orderBy(order_col).select("url").write.mode("overwrite").text(path)


# --- S7, S8: listing rows and failures ------------------------------------------------


def append_listings(rows: DataFrame, path: str) -> None:
    """Append rows with the fixed 13-column header (each part file carries the header)."""
    rows.select(*S.RAW_COLUMNS).write.mode("append").option("header", True).option("escape", '"').csv(path)


def append_failures(failed: DataFrame, path: str, error_col: str = "error") -> None:
    """``url<TAB>error`` lines for rows that failed."""
    failed.select(F.concat_ws("\t", F.col("url"), F.col(error_col)).alias("value")).write.mode("append").text(path)


# --- S9: run metadata ----------------------------------------------------------------


def json_safe(df: DataFrame) -> DataFrame:
    """NaN becomes null in every floating column (JSON has no NaN)."""
    fixes = {c: F.when(~F.isnan(c), F.col(c)) for c, t in df.dtypes if t in ("double", "float")}
    return df.withColumns(fixes) if fixes else df


def write_run_metadata(tables: dict[str, DataFrame], out_dir: str) -> None:
    """Each metadata table as JSON lines under ``out_dir/<name>``."""
    for name, df in tables.items():
        json_safe(df).write.mode("overwrite").json(f"{out_dir}/{name}")


# --- S10: model store ------------------------------------------------------------------


def save_models(spark: SparkSession, models: dict, best_name: str, out_dir: str) -> DataFrame:
    """Save every fitted pipeline under ``out_dir/models/<key>`` and a registry table
    (model, model_key, path, is_best, registry_order)."""
    rows = []
    for i, (name, (key, pm)) in enumerate(models.items(), 1):
        path = f"{out_dir}/models/{key}"
        pm.write().overwrite().save(path)
        rows.append((name, key, path, name == best_name, i))
    registry = spark.createDataFrame(rows, "model string, model_key string, path string, is_best boolean, registry_order int")
    registry.coalesce(1).write.mode("overwrite").json(f"{out_dir}/registry")
    return registry


def _registry(spark: SparkSession, out_dir: str) -> DataFrame | None:
    schema = "model string, model_key string, path string, is_best boolean, registry_order int"
    return if_present(lambda: spark.read.schema(schema).json(f"{out_dir}/registry"))


def load_best(spark: SparkSession, out_dir: str) -> tuple[str, PipelineModel]:
    """The best saved pipeline; a clear error when training has not run."""
    reg = _registry(spark, out_dir)
    best = reg.filter("is_best").first() if reg is not None else None
    if best is None:
        raise FileNotFoundError(f"Model artifact not found under {out_dir}. Run training first.")
    return best["model"], PipelineModel.load(best["path"])


def load_registry(spark: SparkSession, out_dir: str, default: PipelineModel | None = None, default_name: str = "Sačuvani model") -> dict:
    """All saved pipelines by display name (registry order); falls back to the default."""
    reg = _registry(spark, out_dir)
    rows = reg.orderBy("registry_order").collect() if reg is not None else []
    if rows:
        return {r["model"]: PipelineModel.load(r["path"]) for r in rows}
    return {default_name: default} if default is not None else {}
