"""Scoring cases: validation messages, floor labels, prediction frame, price range."""

import pytest
from pyspark.sql import functions as F

from kvadrat.functions.floors import floor_label
from kvadrat.operators import scoring as P

REQ = ("input_id string, city string, region string, street string, area_m2 string, rooms string, heating_type string, "
       "parking string, floor string, total_floors string, year_built string, is_lux boolean, is_penthouse boolean, is_duplex boolean")


def _req(spark, rows):
    return spark.createDataFrame(rows, REQ)


def test_valid_request_frame(spark):
    df = _req(spark, [("1", "Beograd", "Vracar", None, "65", "2.5", "CG", "Da", "3", "6", "2015", True, False, False)])
    v = P.validate_requests(df).first()
    assert v["is_valid"] and v["errors"] == ""
    f = P.prediction_frame(df).first()
    assert (f["floor"], f["total_floors"], f["building_age"], f["is_lux"]) == (3.0, 6.0, 11.0, 1)
    assert f["raw_floor_string"] == "3 / 6"


def test_all_errors_are_reported(spark):
    df = _req(spark, [("1", "", " ", None, "5", "12", "-", None, "9", "4", "1700", False, False, False)])
    errors = P.validate_requests(df).first()["errors"].split("; ")
    assert errors == [
        "city je obavezno polje",
        "region je obavezno polje",
        "parking je obavezno polje",
        "area_m2 mora biti između 10 i 500",
        "rooms mora biti između 0.5 i 10",
        "year_built mora biti između 1800 i 2028",
        "floor ne može biti veći od total_floors",
    ]


def test_unparseable_numbers(spark):
    df = _req(spark, [("1", "a", "b", None, "x", "y", "c", "d", "z", "0", None, False, False, False)])
    errors = P.validate_requests(df).first()["errors"].split("; ")
    assert "area_m2 mora biti broj između 10 i 500" in errors
    assert "rooms mora biti broj između 0.5 i 10" in errors
    assert "floor mora biti broj" in errors


def test_total_zero_above_ground(spark):
    df = _req(spark, [("1", "a", "b", None, "50", None, "c", "d", "0", "0", None, False, False, False),
                      ("2", "a", "b", None, "50", None, "c", "d", "-1", "0", None, False, False, False)])
    out = {r["input_id"]: r["errors"] for r in P.validate_requests(df).collect()}
    assert out == {"1": "", "2": ""}
    df2 = _req(spark, [("3", "a", "b", None, "50", None, "c", "d", "2", "0", None, False, False, False)])
    assert "floor ne može biti veći od total_floors" in P.validate_requests(df2).first()["errors"]


def test_floor_labels(spark):
    df = spark.createDataFrame([(-1.0, 4.0), (0.0, 3.0), (2.5, 6.0), (None, 6.0), (5.0, None)], "f double, t double")
    assert [r[0] for r in df.select(floor_label("f", "t")).collect()] == [
        "Suteren / 4", "Prizemlje / 3", "2.5 / 6", "Nepoznato", "5"]


def test_price_range_and_clamp(spark):
    df = spark.createDataFrame([(100000.0, 12500.0), (5000.0, 12500.0), (100000.0, None), (float("nan"), 1.0)], "p double, m double")
    rows = df.select(P.price_range("p", "m").alias("r"), P.clamp_prediction(F.col("p")).alias("c")).collect()
    assert (rows[0]["r"]["low"], rows[0]["r"]["high"]) == (87500.0, 112500.0)
    assert (rows[1]["r"]["low"], rows[1]["r"]["high"]) == (0.0, 17500.0)
    assert rows[2]["r"] is None
    assert rows[3]["c"] == 0.0


def test_region_options_fallbacks(spark):
    reqs = _req(spark, [("1", "A", "r", None, "50", None, "c", "d", None, None, None, False, False, False),
                        ("2", "B", "r", None, "50", None, "c", "d", None, None, None, False, False, False)])
    rbc = spark.createDataFrame([("A", 0, "x"), ("A", 1, "y")], "city string, pos int, region string")
    out = {(r["city"], r["pos"]): r["region"] for r in P.region_options(reqs, rbc).collect()}
    assert out == {("A", 0): "x", ("A", 1): "y", ("B", 0): "Nepoznato"}
    empty = spark.createDataFrame([], "city string, pos int, region string")
    every = spark.createDataFrame([("z",), ("w",), ("z",), (None,)], "region string")
    out2 = sorted(map(tuple, P.region_options(reqs, empty, every).collect()))
    assert out2 == [("A", 0, "w"), ("A", 1, "z"), ("B", 0, "w"), ("B", 1, "z")]
    for none in (None, every.limit(0)):
        assert sorted(map(tuple, P.region_options(reqs, empty, none).collect())) == [("A", 0, "Nepoznato"), ("B", 0, "Nepoznato")]


def test_strict_mode_fails_the_job(spark):
    import pytest

    df = _req(spark, [("1", "", "b", None, "50", None, "c", "d", None, None, None, False, False, False)])
    with pytest.raises(Exception, match="city je obavezno polje"):
        P.raise_on_invalid(df).collect()


def test_requests_are_dealt_before_they_are_scored(spark, sf_dir):
    """A table of one row group is one task's: its rows are dealt before numbers are parsed."""
    from kvadrat.plans import testview

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = spark.conf.get("spark.kvadrat.scanPartitions", None)
    try:
        spark.conf.unset("spark.kvadrat.scanPartitions")
        requests = testview.score_inputs(spark, sf_dir)
    finally:
        if parts:
            spark.conf.set("spark.kvadrat.scanPartitions", parts)
    plan = P.validate_requests(requests)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey" in plan and f", {n}), REPARTITION_BY_NUM" in plan


@pytest.mark.parametrize("text", ["12", "12.5", "٣", " 7 ", "7\n", "+3", "-2", "1e2", ".5", "5.", "nan", "-Infinity", "", " ", "1d", "0x1", "1_0", "12 a", "1.2.3"])
def test_plain_numbers_parse_as_the_whole_grammar_does(spark, text):
    import re

    want = re.fullmatch(r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*", text) or re.fullmatch(r"(?i)\s*[+-]?(nan|inf|infinity)\s*", text)
    got = spark.createDataFrame([(text,)], "x string").select(P.py_float("x").alias("v"), P._blank("x").alias("b")).first()
    # (digits of other scripts are matched, and no double for Spark)
    assert (got["v"] is not None) == (bool(want) and text != "٣") and got["b"] == (text.strip() == "")
