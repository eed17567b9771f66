"""The compact booster grows the trees of Spark's own."""

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from kvadrat import schema as S
from kvadrat.operators import boosting as B
from kvadrat.operators import modeling as M

COLUMNS = (", ".join(f"{c} double" for c in S.MODEL_NUMERIC_FEATURES) + ", "
           + ", ".join(f"{c} string" for c in S.MODEL_CATEGORICAL_FEATURES) + f", {S.TARGET} double")


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(900):
        city, region, area, year = int(rng.integers(0, 9)), int(rng.integers(0, 4)), float(rng.integers(20, 200)), float(rng.integers(1950, 2010))
        price = area * 900 * (1 + 0.2 * city) + 3000 * region + float(rng.normal()) * 8000
        rows.append((area, float(rng.integers(1, 6)), float(rng.integers(0, 9)), 9.0, float(rng.integers(0, 2)), year if rng.random() > 0.1 else None,
                     2026 - year, float(rng.random() < 0.1), 0.0, 1.0, f"c{city}", f"r{region}", f"c{city} | r{region}",
                     "CG" if rng.random() < 0.5 else None, "Da", price))
    return spark.createDataFrame(rows + rows[:50], COLUMNS).repartition(3).cache()


CASES = [
    (True, dict(maxIter=5, maxDepth=3, minInstancesPerNode=2, lossType="squared", stepSize=0.06)),
    (True, dict(maxIter=4, maxDepth=5, minInstancesPerNode=20, maxBins=255, lossType="squared", stepSize=0.08)),
    (False, dict(maxIter=6, maxDepth=6, maxBins=40, lossType="absolute", stepSize=0.05)),
]


@pytest.mark.parametrize("one_hot,given", CASES)
def test_predictions_are_those_of_spark(spark, train, monkeypatch, one_hot, given):
    rows = M.build_preprocessor(one_hot=one_hot, scale=one_hot).fit(train).transform(train).cache()
    given = dict(featuresCol="features", labelCol=S.TARGET, predictionCol="prediction", seed=42, **given)
    want = GBTRegressor(**given).fit(rows)
    predicted = lambda model: np.array([r[0] for r in model.transform(rows).select("prediction").collect()])
    texts = []
    for most, at_driver in ((1 << 19, 1 << 26), (0, 1 << 26), (0, 0)):  # in one task, a job a pass, splits found by tasks
        monkeypatch.setattr(B, "TASK_ROWS", most)
        monkeypatch.setattr(B, "DRIVER_BYTES", at_driver)
        monkeypatch.setattr(B, "CHECKPOINT_ROUNDS", 2)
        got = B.CompactGBTRegressor(**given).on(M.NUMBERS, M.INDEXED, one_hot).fit(rows)
        assert predicted(got) == pytest.approx(predicted(want), rel=1e-9)
        assert got.totalNumNodes == want.totalNumNodes and got.treeWeights == want.treeWeights and got.numFeatures == want.numFeatures
        texts.append(got.toDebugString.split("\n", 1)[1])
        stats = lambda m: [r for t in m.trees for r in [t._call_java("rootNode").impurity(), t._call_java("rootNode").gain()]]
        assert stats(got) == pytest.approx(stats(want), rel=1e-9, abs=1e-6)
    assert len(set(texts)) == 1


def test_a_row_is_one_code_a_column(spark, train):
    """Not a number for each one-hot feature."""
    rows = M.build_preprocessor().fit(train).transform(train)
    booster = B.CompactGBTRegressor(labelCol=S.TARGET).on(M.NUMBERS, M.INDEXED, True)
    fields, n = booster._fields(rows)
    assert n == 950 and len(fields) == len(S.MODEL_NUMERIC_FEATURES + S.MODEL_CATEGORICAL_FEATURES)
    blocks = [b for part in booster._blocks(rows, fields, 4).collect() for b in part]
    assert sum(c.nbytes for c, _ in blocks) == 950 * len(fields) and sum(len(y) for _, y in blocks) == 950


def test_a_model_of_a_booster_is_kept(spark, train, tmp_path):
    from pyspark.ml import PipelineModel

    sizes = M.Sizes(xgb_iter=3)
    fitted = M.build_model_pipeline("xgboost_log_target", sizes).fit(train)
    fitted.save(str(tmp_path / "m"))
    score = lambda m: sorted(r[0] for r in m.transform(train).select("prediction").collect())
    assert score(PipelineModel.load(str(tmp_path / "m"))) == score(fitted)
    median = train.agg(F.median(S.TARGET)).first()[0]
    error = lambda p: train.select(F.avg(F.abs(p - F.col(S.TARGET)))).first()[0]
    assert fitted.transform(train).select(F.avg(F.abs(F.col("prediction") - F.col(S.TARGET)))).first()[0] < error(F.lit(median))


def test_thresholds_lie_between_values_and_share_the_rows(spark):
    v, n = np.array([0.0, 1.0, 4.0]), np.array([5, 1, 2])
    assert B.thresholds(v, v, n, 31) == [0.5, 2.5]
    v = np.arange(1000.0)
    assert np.diff(B.thresholds(v, v, np.ones(1000), 9)) == pytest.approx([100] * 8, abs=1.5)
    assert B.thresholds(np.array([3.0]), np.array([3.0]), np.array([9]), 31) == []


def test_many_values_are_counted_in_groups(spark, monkeypatch):
    df = spark.range(5000).selectExpr("(id - 2500) / 7D as a", "id % 3 as b")
    want = B._value_counts(df, ["a", "b"])
    monkeypatch.setattr(B, "MOST_VALUES", 1000)
    low, high, n = B._value_counts(df, ["a", "b"])[0]
    assert len(want[0][0]) == 5000 and len(low) < 5000 and n.sum() == 5000 and (low[1:] > high[:-1]).all()
    assert [list(x) for x in B._value_counts(df, ["a", "b"])[1]] == [[0, 1, 2], [0, 1, 2], [1667, 1667, 1666]]
