"""Statistics core: distributed exact quantiles and ranks against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kvadrat.operators import stats as E


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.integers(0, 40, 3000).astype(float), rng.normal(size=1000) * 1e5, [np.nan, np.nan]])
    grp = np.where(np.arange(len(vals)) < 3300, "hot", "cold")  # one group holds most rows
    rows = [(g, None if np.isnan(v) else float(v)) for g, v in zip(grp, vals)]
    return spark.createDataFrame(rows, "g string, v double"), grp, vals


def test_exact_quantiles_match_numpy_bit_for_bit(skewed):
    df, grp, vals = skewed
    qs = [0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]
    got = {r["g"]: r for r in E.exact_quantiles(df, "v", qs, ["g"]).collect()}
    for g in ["hot", "cold"]:
        x = vals[(grp == g) & ~np.isnan(vals)]
        assert got[g]["n"] == len(x)
        assert [got[g][f"q{i}"] for i in range(len(qs))] == list(np.quantile(x, qs))


def test_value_ranks_average_ties(spark):
    df = spark.createDataFrame([(v,) for v in [3.0, 1.0, 3.0, 2.0, 3.0, None]], "v double")
    out = {r["v"]: (r["rows_below"], r["ties"], r["avg_rank"]) for r in E.value_ranks(df, "v").collect()}
    assert out == {1.0: (0, 1, 1.0), 2.0: (1, 1, 2.0), 3.0: (2, 3, 4.0)}


def test_spearman_matches_rank_correlation(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 20, 500).astype(float)
    b = a * 3 + rng.normal(size=500) * 10
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "area_m2 double, price_eur double")

    def avg_rank(x):
        order = np.argsort(x, kind="mergesort")
        ranks = np.empty(len(x))
        ranks[order] = np.arange(1, len(x) + 1)
        for v in np.unique(x):
            ranks[x == v] = ranks[x == v].mean()
        return ranks

    expected = np.corrcoef(avg_rank(a), avg_rank(b))[0, 1]
    assert E.spearman(df).first()["spearman"] == pytest.approx(expected, rel=1e-12)


def test_approx_paths_run(skewed, spark):
    df, _, _ = skewed
    d = E.describe(df.withColumnRenamed("v", "price_eur"), ["price_eur"], approx=True).first()
    assert d["count"] == 4000 and d["p50"] is not None
    cities = df.withColumnRenamed("g", "city").withColumn("region", F.lit("r")).withColumnRenamed("v", "price_eur")
    rows = E.region_price_summary(cities, 2, min_count=1, approx=True).collect()
    assert {r["city"] for r in rows} == {"hot", "cold"}


def test_histogram_last_bin_is_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]], "x double")
    h = {r["bin"]: r["count"] for r in E.histogram(df, "x", bins=5).collect()}
    assert h == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(5)
    for x in [np.round(rng.lognormal(10, 1, 2000), 2), rng.integers(0, 500, 2000).astype(float) * 0.1]:
        counts, edges = np.histogram(x, bins=45)
        df = spark.createDataFrame([(float(v),) for v in x], "x double")
        got = {r["bin"]: r for r in E.histogram(df, "x", 45).collect()}
        assert [got[i]["count"] if i in got else 0 for i in range(45)] == list(counts)
        assert all(got[i]["bin_lo"] == edges[i] and got[i]["bin_hi"] == edges[i + 1] for i in got)
