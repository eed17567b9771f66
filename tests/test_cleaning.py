"""Cleaning cases: dedup keeps first, incomplete keys kept, inclusive ranges, summary."""

import re

from pyspark.sql import functions as F

from kvadrat import schema as S
from kvadrat.operators import cleaning as C

COLS = "title string, description string, area_m2 double, price_eur double, city string, rooms double, year_built double, _ord long"


def _frame(spark, rows):
    df = spark.createDataFrame(rows, COLS)
    for c in S.RAW_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df


def test_dedup_keeps_first_of_each_key(spark):
    rows = [
        ("Stan A", "Opis", 50.0, 100000.0, "Beograd", 2.0, 2000.0, 1),
        ("Stan A", "Opis", 50.0, 100000.0, "Beograd", 3.0, 2001.0, 2),
        ("Stan B", "Opis", 60.0, 120000.0, "Beograd", 2.0, 2000.0, 3),
    ]
    out = C.dedup_keep_first(_frame(spark, rows)).orderBy("_ord").collect()
    assert len(out) == 2
    assert out[0]["rooms"] == 2.0  # the first copy wins


def test_incomplete_key_rows_are_kept(spark):
    rows = [
        (None, "Opis", 50.0, 100000.0, "Beograd", 2.0, 2000.0, 1),
        ("Jeftin", "Opis", 50.0, 1000.0, "Beograd", 2.0, 2000.0, 2),
    ]
    cleaned = C.build_cleaned(_frame(spark, rows)).collect()
    assert [r["title"] for r in cleaned] == [None]


def test_quality_ranges_are_inclusive_and_optional(spark):
    rows = [
        ("valid", "d", 10.0, 10000.0, "c", None, None, 1),
        ("area", "d", 5.0, 100000.0, "c", 2.0, 2000.0, 2),
        ("price", "d", 50.0, 5000.0, "c", 2.0, 2000.0, 3),
        ("rooms", "d", 50.0, 100000.0, "c", 20.0, 2000.0, 4),
        ("year", "d", 50.0, 100000.0, "c", 2.0, 1700.0, 5),
    ]
    out = [r["title"] for r in C.build_cleaned(_frame(spark, rows)).collect()]
    assert out == ["valid"]


def test_cleaning_summary_counts(spark):
    rows = [
        ("Stan A", "Opis", 50.0, 100000.0, "Beograd", 2.0, 2000.0, 1),
        ("Stan A", "Opis", 50.0, 100000.0, "Beograd", 2.0, 2000.0, 2),
        ("Stan C", "Opis", 50.0, 1000.0, "Beograd", 2.0, 2000.0, 3),
    ]
    s = C.cleaning_summary(_frame(spark, rows)).first().asDict()
    assert s == {
        "raw_rows": 3,
        "complete_key_rows": 3,
        "duplicate_rows": 2,
        "duplicate_groups": 1,
        "rows_removed_if_keeping_first": 1,
        "deduped_rows": 2,
        "cleaned_rows": 1,
        "rows_removed_total": 2,
    }


def test_dedup_is_idempotent_and_partition_independent(spark, sf_dir):
    from kvadrat.plans import frames

    raw = frames.raw(spark, sf_dir)
    once = C.dedup_keep_first(raw)
    twice = C.dedup_keep_first(once)
    assert once.count() == twice.count()
    shuffled = C.dedup_keep_first(raw.repartition(7))
    cols = S.RAW_COLUMNS
    assert once.select(*cols).exceptAll(shuffled.select(*cols)).count() == 0


def test_cleaned_rows_are_in_range(spark, sf_dir):
    from kvadrat.plans import frames

    bad = frames.cleaned(spark, sf_dir).filter(~C.passes_quality())
    assert bad.count() == 0


def test_set_counts_add_up_to_the_two_datasets(spark):
    rows = [("A", "x", 50.0, 90000.0, "N", 2.0, 2000.0, 1)] * 1 + [("A", "x", 50.0, 90000.0, "N", 99.0, 2000.0, 0)]
    rows += [("B", "x", 50.0, 90000.0, "N", 2.0, None, 3), ("B", "x", 50.0, 90000.0, "N", 99.0, None, 4)]
    rows += [(None, "x", 50.0, 90000.0, "N", 2.0, None, 5)] * 3 + [(None, "x", 50.0, 90000.0, "N", 99.0, None, 6), ("C", "x", 5.0, None, None, None, None, 7)]
    df = _frame(spark, rows)
    sets = C.set_counts(df, ["city", "price_eur"])
    got = {(r["city"], r["price_eur"]): (r["raw"], r["cleaned"]) for r in sets.groupBy("city", "price_eur").agg(F.sum("raw").alias("raw"), F.sum("cleaned").alias("cleaned")).collect()}
    assert got == {("N", 90000.0): (8, 4), (None, None): (1, 0)}  # A's first copy fails, B's passes, three incomplete rows pass
    assert C.build_cleaned(df).count() == 4 and C.dedup_keep_first(df).count() == 7
    assert C.exact_duplicates(df, ["title", "rooms", "_ord"]).first()[0] == 2


def test_values_that_hash_alike_in_other_places_are_told_apart(spark):
    df = spark.createDataFrame([(None, "a", 1), ("a", None, 2), (None, None, 3), ("", "a", 4)], "x string, y string, _ord long")
    assert C.exact_duplicates(df, ["x", "y"]).first()[0] == 0


def test_repeated_rows(spark):
    from kvadrat.operators import stats as E

    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 10_000)], "x string, _n long")
    assert {r["x"]: r["count"] for r in E.repeated(df).groupBy("x").count().collect()} == {"a": 1, "b": 3, "c": 10_000}


def test_dedup_carries_each_column_once(spark, sf_dir):
    """The order's columns went along in the row, in its order and beside it."""
    from kvadrat.plans import frames

    key = S.COMPOSITE_KEY
    row = lambda df: re.search(r"min\((.*?)\) AS _first", df._jdf.queryExecution().optimizedPlan().toString())[1]
    whole = row(frames.deduped(spark, sf_dir))
    assert "_ord" not in whole and whole.count("raw_floor_string, ") == 1
    few = frames.deduped(spark, sf_dir, ["rooms", "price_eur"])
    assert few.columns == ["rooms", "price_eur"] and "title, " not in row(few) and "title, " in whole
    rows = [("t", "d", 1.0, 2.0, "c", r, y, o) for r, y, o in [(3.0, 1990.0, 2), (None, 1980.0, 1), (5.0, None, 1)]]
    df = spark.createDataFrame(rows, COLS)
    one = C.dedup_keep_first(df, order_col=["_ord", "rooms"])
    assert [tuple(r) for r in one.collect()] == [rows[1]] and one.columns == df.columns
    assert C.dedup_keep_first(df, key, ["_ord", "rooms"], ["year_built", "_ord"]).collect() == [(1980.0, 1)]
