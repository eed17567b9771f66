"""Target statistics of categories against a walk over the rows."""

import random

import pytest
from pyspark.sql import functions as F

from kvadrat.operators import target_statistics as T


def rows(n=600, seed=3):
    r = random.Random(seed)
    out = []
    for i in range(n):
        city = "hot" if r.random() < 0.6 else r.choice(["a", "b", "c", None])
        out.append((f"{r.getrandbits(60):015x}", city, r.choice(["x", "y"]), round(r.uniform(1, 99), 3)))
    return out


SCHEMA = "_row string, city string, kind string, y double"


def test_ordered_statistics_see_earlier_rows_only(spark):
    data = rows()
    prior = sum(d[3] for d in data) / len(data)
    want, seen = {}, {}
    for key, city, kind, y in sorted(data):
        for column, label in (("city", city or "Nepoznato"), ("kind", kind)):
            s, n = seen.get((column, label), (0.0, 0))
            want[key, column] = (s + prior) / (n + 1)
            seen[column, label] = s + y, n + 1
    df = spark.createDataFrame(data, SCHEMA).repartition(7)
    out = T.ordered_target_statistics(df, ["city", "kind"], "y", "_row")
    got = {(r["_row"], r["column_name"]): r["encoded"] for r in out.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(v, rel=1e-12) for k, v in want.items())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(column_name" in plan and "Python" not in plan
    # the hot category lies in several ranges
    sums = T.prefix_sums(df.select("_row", "city", "y"), ["city"], "_row", "y")
    assert sums.where("city = 'hot'").select(F.spark_partition_id()).distinct().count() > 1


def test_statistics_of_unseen_labels_are_the_prior(spark):
    train = spark.createDataFrame([("1", "a", "x", 10.0), ("2", "a", "y", 20.0), ("3", None, "x", 60.0)], SCHEMA)
    test = spark.createDataFrame([("7", "a", "z", 0.0), ("8", None, "x", 0.0), ("8", None, "x", 0.0)], SCHEMA)
    got = sorted(map(tuple, T.target_statistics(train, test, ["city", "kind"], "y", "_row").collect()))
    assert got == [("7", "city", 20.0), ("7", "kind", 30.0), ("8", "city", 45.0), ("8", "city", 45.0),
                   ("8", "kind", pytest.approx(100 / 3)), ("8", "kind", pytest.approx(100 / 3))]


def test_empty_frames(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert T.ordered_target_statistics(none, ["city"], "y", "_row").count() == 0
    assert T.target_statistics(none, none, ["city"], "y", "_row").count() == 0


def test_rows_equal_in_order_follow_each_other_by_value_and_rows_are_shuffled_once(spark):
    data = [("0a", "x", "u", 5.0), ("0a", "x", "u", 9.0), ("0a", "x", "u", 1.0), ("ff", "x", "u", 2.0), (None, "x", "u", 3.0)]
    for parts in (1, 3, 5):
        df = spark.createDataFrame(data, SCHEMA).repartition(parts)
        sums = T.prefix_sums(df, ["city"], "_row", "y")
        got = sorted((r["y"], r["before_n"], r["before_sum"]) for r in sums.collect())
        assert got == [(1.0, 3, 17.0), (2.0, 4, 18.0), (3.0, 0, 0.0), (5.0, 2, 12.0), (9.0, 1, 3.0)]
    plan = T.prefix_sums(spark.createDataFrame(data, SCHEMA), ["city"], "_row", "y")._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "rangepartitioning" in line and "_row" in line]


def test_a_row_is_shuffled_once_for_all_its_columns(spark):
    """rows are taken apart after the shuffle by range, which the window needs none beside."""
    df = spark.createDataFrame(rows(), SCHEMA)
    plan = T.ordered_target_statistics(df, ["city", "kind"], "y", "_row")._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(_p" in line]
    assert len(dealt) == 1 and plan.index("Window") < plan.index("Exchange hashpartitioning(_p") and "Join" not in plan.replace("BroadcastNestedLoopJoin", "")
    generate = plan.index("Generate explode")
    assert generate < plan.index("Exchange hashpartitioning(_p")  # above it in the tree
