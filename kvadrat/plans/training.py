"""Training flow (query lifecycle A): load -> clean -> features -> split -> fit candidates
-> rank -> persist models and metadata tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvadrat.session import checkpointed
from kvadrat import schema as S
from kvadrat.operators import cleaning as C
from kvadrat.operators import features as FE
from kvadrat.operators import modeling as M
from kvadrat.operators import stats as E
from kvadrat.sources import sinks


def prepare_modeling_data(
    raw: DataFrame, current_year: int = S.CURRENT_YEAR, order_col: str | list[str] = C.ORDER_COL
) -> tuple[DataFrame, DataFrame]:
    """(model frame, cleaning summary). The model frame is checkpointed: every candidate
    fit and every statistic reads it, and a lost executor must not recompute the dedup."""
    model_df = checkpointed(FE.add_model_features(C.build_cleaned(raw, order_col=order_col), current_year))
    return model_df, C.cleaning_summary(raw, order_col=order_col)


def ui_options(model_df: DataFrame) -> dict[str, DataFrame]:
    """E17-E19 tables behind the scoring form."""
    return {
        "category_options": E.category_options(model_df),
        "regions_by_city": E.regions_by_city(model_df),
        "numeric_ranges": E.numeric_ranges(model_df),
    }


def train_and_save(
    spark: SparkSession,
    raw: DataFrame,
    out_dir: str,
    specs: list[tuple[str, str]] | None = None,
    sizes: M.Sizes = M.REFERENCE,
    test_size: float = S.TEST_SIZE,
    seed: int = S.RANDOM_STATE,
    parallelism: int = 1,
    order_col: str | list[str] = C.ORDER_COL,
) -> dict:
    """Train every candidate, save all pipelines (best flagged) and the metadata tables. ``model`` of the
    result is the written model frame, so what scores it does not clean the listings again."""
    model_df, summary = prepare_modeling_data(raw, order_col=order_col)
    res = M.train_candidates(model_df, specs, test_size, seed, sizes, parallelism)
    registry = sinks.save_models(spark, res.models, res.best_model_name, out_dir)
    run = spark.createDataFrame(
        [
            (
                res.best_model_name,
                res.best_model_key,
                res.train_rows,
                res.test_rows,
                float(test_size),
                int(seed),
                ",".join(S.model_feature_columns()),
            )
        ],
        "best_model_name string, best_model_key string, train_rows long, test_rows long, test_size double, "
        "random_state int, feature_columns string",
    )
    tables = {"run": run, "metrics": res.metrics, "cleaning_summary": summary, "registry": registry}
    tables.update(ui_options(model_df))
    sinks.write_run_metadata({k: v for k, v in tables.items() if k != "registry"}, f"{out_dir}/metadata")
    return {"model": model_df, "result": res, "registry": registry, "metadata_dir": f"{out_dir}/metadata"}
