"""Standard stages of the listings flow, built lazily from the driver tables.

raw -> deduped (C2+C3) -> cleaned (C4) -> model (F12). Each function returns a lazy plan;
callers that reuse a stage several times persist it themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kvadrat.session import checkpointed
from kvadrat.operators import cleaning as C
from kvadrat.operators import features as FE
from kvadrat.plans import testview

# the regional price summary covers the two largest markets of the data
SUMMARY_TOP_CITIES = 2


def raw(spark: SparkSession, sf_dir: str, deal: bool = False) -> DataFrame:
    return testview.raw_listings(spark, sf_dir, deal)


def ordered(spark: SparkSession, sf_dir: str, deal: bool = False) -> DataFrame:
    """The raw stage for dedup in ``testview.FIRST_ORDER``: the order is columns that the rows hold, so no
    struct of them goes along beside."""
    return raw(spark, sf_dir, deal).drop(C.ORDER_COL)


def deduped(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    return C.dedup_keep_first(ordered(spark, sf_dir), order_col=testview.FIRST_ORDER, columns=columns)


def cleaned(spark: SparkSession, sf_dir: str, columns: list[str] | None = None, deal: bool = False) -> DataFrame:
    return C.build_cleaned(ordered(spark, sf_dir, deal), order_col=testview.FIRST_ORDER, columns=columns)


def sets(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """Values of key columns with their raw and cleaned rows, from one pass over the raw stage."""
    return C.set_counts(raw(spark, sf_dir, deal=True), columns)


def model(spark: SparkSession, sf_dir: str, columns: list[str] | None = None, deal: bool = False) -> DataFrame:
    return FE.add_model_features(cleaned(spark, sf_dir, columns, deal))


#: Without the texts, the widest columns: what the choices of the scoring form need, and the order of copies.
OPTION_COLUMNS = ["area_m2", "price_eur", "city", *testview.FIRST_ORDER]


def cleaned_checkpointed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned stage written once to the checkpoint folder, for queries that read it
    several times (lineage cut: later stages and retries start from the stored copy).
    The model stage is a narrow projection of it: ``FE.add_model_features(...)``."""
    return checkpointed(cleaned(spark, sf_dir))
