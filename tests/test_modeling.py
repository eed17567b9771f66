"""Modeling cases: metrics, ranking, preprocessing, ridge vs closed form, factory."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from kvadrat import schema as S
from kvadrat.operators import modeling as M


def test_regression_metrics(spark):
    preds = spark.createDataFrame([("m", 100000.0, 110000.0), ("m", 150000.0, 140000.0), ("m", 200000.0, 210000.0)], "model string, y double, p double")
    r = M.regression_metrics(preds).first()
    assert r["mae"] == pytest.approx(10000.0)
    assert r["rmse"] == pytest.approx(10000.0)
    assert r["r2"] == pytest.approx(0.94)


def test_rank_models(spark):
    m = spark.createDataFrame([("GB", 12000.0), ("RF", 20000.0), ("LR", 10000.0)], "model string, mae double")
    out = [(r["model"], r["rank_by_mae"]) for r in M.rank_models(m).orderBy("rank_by_mae").collect()]
    assert out == [("LR", 1), ("GB", 2), ("RF", 3)]


def test_check_metrics_rejects_empty(spark):
    preds = spark.createDataFrame([], "model string, y double, p double")
    with pytest.raises(ValueError, match="at least one prediction"):
        M.check_metrics(M.regression_metrics(preds))
    with pytest.raises(ValueError, match="at least one prediction"):
        M.rank_models(M.regression_metrics(preds))
    some = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, None)], "model string, y double, p double")
    with pytest.raises(ValueError, match="same length"):
        M.check_metrics(M.regression_metrics(some))
    with pytest.raises(ValueError, match="at least one prediction"):
        M.check_metrics(M.regression_metrics(some.limit(1)), ["a", "b"])


def test_wide_ridge_matches_closed_form(spark):
    """5,000 one-hot features, beyond the normal equations."""
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(6)
    width, n = 5000, 400
    hot = rng.integers(0, 60, (n, 2)) * np.array([1, 83])
    y = rng.normal(size=n) * 5 + hot[:, 0] % 7 * 3 + 20
    x = np.zeros((n, width))
    for i, h in enumerate(hot):
        x[i, h] = 1
    rows = [(Vectors.sparse(width, sorted({int(a): 1.0 for a in h}.items())), float(t)) for h, t in zip(hot, y)]
    model = M.RidgeRegressor(alpha=1.0, labelCol="y").fit(spark.createDataFrame(rows, ["features", "y"]))
    xc, yc = x - x.mean(0), y - y.mean()
    w = xc.T @ np.linalg.solve(xc @ xc.T + np.eye(n), yc)  # the dual form: n unknowns, not 5,000
    assert np.abs(model.coefficients.toArray() - w).max() < 2e-3
    assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ w, abs=1e-2)


def _exact(spark, rows, size=0.2):
    df = spark.createDataFrame(rows, "url string, title string, v double")
    for c in M.SPLIT_KEY:
        if c not in df.columns:
            df = df.withColumn(c, F.lit("x"))
    return M.with_split(df.repartition(5), size, exact=True)


def test_exact_split_size_with_planted_ties(spark):
    same = [("u", "t", 1.0)] * 700 + [("u", "t", float(i)) for i in range(150)] + [(f"u{i}", "t", 0.0) for i in range(153)]
    for size in (0.2, 0.5, 0.001, 1.0):
        counts = {r["is_test"]: r["count"] for r in _exact(spark, same, size).groupBy("is_test").count().collect()}
        assert counts.get(True, 0) == int(np.ceil(1003 * size)) and sum(counts.values()) == 1003
    empty = _exact(spark, same, 0.2).limit(0).drop("is_test")
    assert M.with_split(empty, exact=True).count() == 0


def test_exact_split_takes_the_smallest_hashes(spark):
    out = _exact(spark, [(f"u{i}", "t", 0.0) for i in range(500)]).withColumn("h", F.substring(M.E.row_hash(M.SPLIT_KEY), 1, 15)).collect()
    ranked = sorted(out, key=lambda r: r["h"])
    assert [r["is_test"] for r in ranked] == [True] * 100 + [False] * 400


def _model_rows(spark, cities):
    rows = []
    for i, c in enumerate(cities):
        rows.append((float(40 + 7 * i), float(1 + i % 4), float(i % 6), 6.0, float(i % 6 == 5), 1990.0 + i, 36.0 - i,
                     i % 2, 0, 0, c, f"r{i % 3}", f"{c} | r{i % 3}", "CG" if i % 2 else None, "Da", 50000.0 + 2500.0 * i))
    return spark.createDataFrame(
        rows,
        "area_m2 double, rooms double, floor double, total_floors double, is_last_floor double, year_built double, "
        "building_age double, is_lux int, is_penthouse int, is_duplex int, city string, region string, city_region string, "
        "heating_type string, parking string, price_eur double",
    )


def test_preprocessor_no_missing_and_unseen_is_zero(spark):
    train = _model_rows(spark, [f"c{i % 8}" for i in range(12)])
    test = _model_rows(spark, ["unseen", "c1"]).withColumn("rooms", F.lit(None).cast("double"))
    pm = M.build_preprocessor().fit(train)
    arr = pm.transform(test).select(vector_to_array("features").alias("a"), "city__ohe").collect()
    for r in arr:
        assert not any(np.isnan(r["a"]))
    assert arr[0]["city__ohe"].numNonzeros() == 0
    assert arr[1]["city__ohe"].numNonzeros() == 1


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 3))
    y = x @ np.array([3.0, -2.0, 1.0]) + 5 + rng.normal(size=60)
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense(r), float(t)) for r, t in zip(x, y)], ["features", "label"])
    model = M.RidgeRegressor(alpha=1.0, labelCol="label").fit(df)
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + np.eye(3), xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), w, atol=1e-4)


def test_every_model_key_builds_and_unknown_fails():
    for _, key in S.DEFAULT_MODEL_CANDIDATES:
        assert M.build_model_pipeline(key, M.SMALL).getStages()
    with pytest.raises(ValueError, match="Supported models"):
        M.build_model_pipeline("nope")


def test_small_training_run_beats_median(spark):
    train = _model_rows(spark, [f"c{i % 8}" for i in range(40)])
    specs = [("Baseline", "dummy_median"), ("LinearRegression", "linear_regression"), ("GB", "gradient_boosting_log_target")]
    model_df = train.withColumns({c: F.lit("x") for c in ["title", "description", "url", "street", "raw_floor_string"]})
    res = M.train_candidates(model_df, specs, sizes=M.SMALL, test_size=0.3)
    metrics = {r["model"]: r for r in res.metrics.collect()}
    assert metrics["LinearRegression"]["mae"] < metrics["Baseline"]["mae"]
    assert all(np.isfinite(r["mae"]) for r in metrics.values())


def test_split_is_disjoint_complete_and_stable(spark, sf_dir):
    from kvadrat.plans import frames

    m = frames.model(spark, sf_dir)
    a = M.with_split(m)
    b = M.with_split(m.repartition(5))
    n = m.count()
    assert a.filter("is_test").count() + a.filter("not is_test").count() == n
    assert a.filter("is_test").count() == b.filter("is_test").count()
    exact = M.with_split(m, exact=True)
    k = int(np.ceil(n * 0.2))
    assert exact.filter("is_test").count() == k


def test_candidates_are_scored_in_one_pass(spark):
    train = _model_rows(spark, [f"c{i % 5}" for i in range(60)]).withColumn("_row", F.monotonically_increasing_id().cast("string"))
    specs = [("a", "dummy_median"), ("b", "linear_regression"), ("c", "ridge_regression_log_target"), ("d", "catboost"), ("e", "ridge_regression")]
    fitted = M.fit_candidates(train, specs, M.SMALL)
    assert fitted["b"][1].stages[0] is fitted["e"][1].stages[0]  # one preprocessing
    test = _model_rows(spark, ["c1", "unseen", "c3"]).withColumn("_row", F.col("city"))
    at_once = M.predictions_at_once(fitted, test, ["_row"])
    want = {(r["model"], r["_row"]): (r["y"], r["p"]) for r in M.predictions_long(fitted, test, ["_row"]).collect()}
    got = {(r["model"], r["_row"]): (r["y"], r["p"]) for r in at_once.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want) and len(got) == 15
    plan = at_once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and "Union" not in plan
    with pytest.raises(ValueError, match="Unknown model"):
        M.fit_candidates(train, [("x", "nothing")])


def test_training_writes_only_what_fits_read_and_cleans_once(spark, sf_dir, monkeypatch):
    """the order of copies goes along once, and the split holds no texts."""
    from kvadrat.operators import modeling
    from kvadrat.plans import registry, training

    written = []
    keep = lambda df, f=modeling.checkpointed: (written.append(df), f(df))[1]
    monkeypatch.setattr(modeling, "checkpointed", keep)
    monkeypatch.setattr(training, "checkpointed", keep)
    rows = registry.queries()["s9_s10_train_and_save"](spark, sf_dir)
    model, split = written[0], next(df for df in written if "is_test" in df.columns)
    assert "_ord" not in model.columns and not {"title", "description", "url", "street"} & set(split.columns)
    plans = [p for p in (df._jdf.queryExecution().executedPlan().toString() for df in written) if "lineitem.parquet" in p]
    assert len(plans) == 1 and "lineitem.parquet" not in rows._jdf.queryExecution().executedPlan().toString()
