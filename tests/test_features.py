"""Feature cases: floor grammar, placeholders, derived features, zero area."""

import pytest
from pyspark.sql import functions as F

from kvadrat.functions.floors import parse_floor
from kvadrat.operators import features as FE


@pytest.mark.parametrize(
    "raw,floor,total",
    [
        ("3/5", 3.0, 5.0),
        ("5 / 5", 5.0, 5.0),
        ("Suteren / 4", -1.0, 4.0),
        ("Visoko prizemlje / 3", 0.0, 3.0),
        ("Prizemlje", 0.0, None),
        ("Nepoznato", None, None),
        ("2,5 / 6", 2.5, 6.0),
        ("7", 7.0, None),
        ("  -  ", None, None),
        (None, None, None),
    ],
)
def test_parse_floor(spark, raw, floor, total):
    df = spark.createDataFrame([(raw,)], "raw string")
    r = df.select(parse_floor("raw").alias("f")).first()["f"]
    assert (r["floor"], r["total_floors"]) == (floor, total)


def test_placeholders_become_unknown(spark):
    df = spark.createDataFrame(
        [("", "-", None, "x", "", "-", "-")],
        "city string, region string, street string, heating_type string, parking string, raw_floor_string string, other string",
    )
    r = FE.normalize_categories(df).first()
    assert [r["city"], r["region"], r["street"], r["heating_type"], r["parking"], r["raw_floor_string"]] == [
        "Nepoznato", "Nepoznato", "Nepoznato", "x", "Nepoznato", "Nepoznato"
    ]
    assert r["other"] == "-"


def _listing(spark, rows):
    return spark.createDataFrame(
        rows,
        "title string, description string, area_m2 double, price_eur double, city string, region string, street string, "
        "heating_type string, rooms double, parking string, raw_floor_string string, year_built double, url string",
    )


def test_model_features(spark):
    rows = [
        ("Lux penthouse", "Dupleks stan", 100.0, 250000.0, "Beograd", "Vracar", "Ulica", "CG", 3.0, "Da", "5 / 5", 2016.0, "u1"),
        ("Stan", "Obican", 50.0, 100000.0, "Novi Sad", "-", None, "-", 2.0, "", "Prizemlje", None, "u2"),
    ]
    src = _listing(spark, rows)
    out = FE.add_model_features(src).orderBy("url").collect()
    a, b = out
    assert (a["price_per_m2"], b["price_per_m2"]) == (2500.0, 2000.0)
    assert (a["building_age"], b["building_age"]) == (10.0, None)
    assert (a["is_last_floor"], b["is_last_floor"]) == (1.0, None)
    assert (a["is_lux"], a["is_penthouse"], a["is_duplex"]) == (1, 1, 1)
    assert (b["is_lux"], b["is_penthouse"], b["is_duplex"]) == (0, 0, 0)
    assert b["city_region"] == "Novi Sad | Nepoznato"
    assert "price_per_m2" not in src.columns  # source unchanged


def test_zero_area_gives_null_price_per_m2(spark):
    src = _listing(spark, [("t", "d", 0.0, 100000.0, "c", "r", "s", "h", 1.0, "p", "1/2", 2000.0, "u")])
    assert FE.add_model_features(src).first()["price_per_m2"] is None


def test_word_flags_need_whole_words(spark):
    src = _listing(spark, [("luxury", "duplexx penthouses", 50.0, 1.0, "c", "r", "s", "h", 1.0, "p", "1", 2000.0, "u")])
    r = FE.add_model_features(src).first()
    assert (r["is_lux"], r["is_penthouse"], r["is_duplex"]) == (0, 0, 0)


def test_feature_projection_has_no_python_udf(spark, sf_dir):
    from kvadrat.plans import frames

    plan = frames.model(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
