"""Model feature projection (F1-F12): one narrow projection, no shuffle, no UDF."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kvadrat import schema as S
from kvadrat.functions import features as FX
from kvadrat.functions.floors import parse_floor


def normalize_categories(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """F1 over the categorical columns that are present."""
    columns = [c for c in (columns or S.CATEGORICAL_COLUMNS_TO_NORMALIZE) if c in df.columns]
    return df.withColumns({c: FX.normalize_category(c) for c in columns})


def add_model_features(df: DataFrame, current_year: int = S.CURRENT_YEAR) -> DataFrame:
    """F1 then the nine derived columns; without the flags of the texts on a frame without texts.
    The input frame is left as it was (immutable)."""
    out = normalize_categories(df)
    flags = {}
    if {"title", "description"} & set(df.columns):
        text = FX.listing_text("title", "description")
        flags = {"is_lux": FX.is_lux(text), "is_penthouse": FX.is_penthouse(text), "is_duplex": FX.is_duplex(text)}
    out = out.withColumn("_floors", parse_floor("raw_floor_string"))
    out = out.withColumns(
        {
            "price_per_m2": FX.price_per_m2("price_eur", "area_m2"),
            "floor": F.col("_floors.floor"),
            "total_floors": F.col("_floors.total_floors"),
        }
    ).drop("_floors")
    return out.withColumns(
        {
            "is_last_floor": FX.is_last_floor("floor", "total_floors"),
            "building_age": FX.building_age("year_built", current_year),
            "city_region": FX.city_region("city", "region"),
            **flags,
        }
    )


def feature_contract(df: DataFrame) -> DataFrame:
    """the 15 model inputs in order (never the target or price_per_m2)."""
    return df.select(*S.model_feature_columns())
