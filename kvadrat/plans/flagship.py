"""Flagship query: listings -> composite-key dedup -> quality filter -> regional price
summary of the two largest markets, first 10 regions per city by median (E11 + E12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvadrat.operators import stats as E
from kvadrat.plans import frames


def region_summary(spark: SparkSession, sf_dir: str, min_count: int = 30, approx: bool = False) -> DataFrame:
    # the cleaned stage is read twice (top cities, then their rows): store it once
    cleaned = frames.cleaned_checkpointed(spark, sf_dir)
    summary = E.region_price_summary(cleaned, frames.SUMMARY_TOP_CITIES, min_count=min_count, approx=approx)
    return E.top_n_per_group(summary, "city", [F.col("median").desc(), F.col("region").asc()], 10)
