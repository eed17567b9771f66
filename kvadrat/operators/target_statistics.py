"""Target statistics of categories (M13): numbers instead of indexed labels.

A category's statistic is the mean label of its rows, drawn to the mean of all rows by ``weight``
rows: (sum + weight * prior) / (count + weight). A training row must not see its own label, so rows
are put in a fixed random order (a hash) and each one's statistic is taken from the rows before
it in its category. All columns are encoded in one pass in long form, and no list of labels, however
long, is held by the driver or by a task.

Running sums by category are prefix sums over ranges of the order: each range of a category is summed,
and offsets are joined back, so a category that holds a third of all rows lies in many ranges. (A window over a category alone would gather it in one task.)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kvadrat import schema as S


def _long(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """(keep.., column_name, label); missing labels are one label of their own."""
    items = [F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c).cast("string"), F.lit(S.UNKNOWN)).alias("label")) for c in columns]
    return df.select(*keep, F.explode(F.array(*items)).alias("_s")).select(*keep, "_s.*")


def prefix_sums(df: DataFrame, group_cols: list[str], order_col: str, value_col: str) -> DataFrame:
    """``df`` with ``before_sum`` and ``before_n``: sum and count of ``value_col`` over the rows of the
    group that come before the row. ``order_col`` is text spread like a hash; rows equal in it follow each
    other by value, the largest first.

    A range is a prefix of the order, so it is known without dealing or sampling rows: ranges are summed
    by partial aggregation, running sums over them (a row per group and range, dealt by range of groups)
    are joined, and rows are shuffled once, for that join and the window alike."""
    g = list(group_cols)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    digits = next(k for k in range(1, 16) if 16**k >= n)  # a range for each task, in the largest group too
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in g])  # rows of no group are left out
    ranged = df.filter(known).withColumn("_p", F.coalesce(F.substring(order_col, 1, digits), F.lit("")))
    totals = ranged.groupBy(*g, "_p").agg(F.sum(value_col).alias("_s"), F.count(value_col).alias("_n"))
    over = Window.partitionBy(*g).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = totals.repartitionByRange(n, *g).select(
        *g, "_p", F.coalesce(F.sum("_s").over(over), F.lit(0.0)).alias("_s0"), F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_n0"))
    before = Window.partitionBy(*g, "_p").orderBy(F.col(order_col), F.col(value_col).desc()).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.repartition(n, *g, "_p").join(offsets, [*g, "_p"], "left").withColumns({
        "before_n": F.col("_n0") + F.count(value_col).over(before),
        "before_sum": F.col("_s0") + F.coalesce(F.sum(value_col).over(before), F.lit(0.0)),
    })
    return rows.drop("_p", "_s0", "_n0")


def _drawn(total, count, weight: float):
    return (total + weight * F.col("_prior")) / (count + weight)


def ordered_target_statistics(
    train: DataFrame, columns: list[str], label: str, order_col: str, weight: float = 1.0
) -> DataFrame:
    """(order_col, column_name, encoded) of every training row, from the rows before it in
    ``order_col`` (a hash that is unique to the row). As in ``prefix_sums``, but a row is shuffled once for all its
    columns, by its range alone, and only then taken apart; the sums before a range come with them as a row that is
    first in its category."""
    n = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    digits = next(k for k in range(1, 16) if 16**k >= 4 * n)  # several ranges a task
    p = F.coalesce(F.substring(order_col, 1, digits), F.lit("")).alias("_p")
    rows = train.select(F.col(order_col), p, *columns, F.col(label).cast("double").alias("_y"))
    g = ["column_name", "label"]
    totals = _long(rows, columns, ["_p", "_y"]).groupBy(*g, "_p").agg(F.sum("_y").alias("_s"), F.count("_y").alias("_n"))
    over = Window.partitionBy(*g).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = totals.repartitionByRange(n, *g).select(*g, "_p", F.sum("_s").over(over).alias("_s0"), F.sum("_n").over(over).alias("_n0"))
    dealt = rows.unionByName(offsets.filter("_n0 is not null"), allowMissingColumns=True).repartition(n, "_p")
    item = lambda name, value: F.struct(name.alias("column_name"), value.alias("label"))
    own = F.array(*[item(F.lit(c), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(S.UNKNOWN))) for c in columns])
    sums = F.col("column_name").isNotNull()
    parted = dealt.select(
        order_col, "_p", "_y", "_s0", "_n0", sums.alias("_sums"),
        F.explode(F.when(sums, F.array(item(F.col("column_name"), F.col("label")))).otherwise(own)).alias("_i"),
    ).select(order_col, "_p", "_y", "_s0", "_n0", "_sums", "_i.*")
    before = Window.partitionBy(*g, "_p").orderBy(F.col("_sums").desc(), F.col(order_col), F.col("_y").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum(F.coalesce("_s0", "_y")).over(before), F.lit(0.0))
    count = F.coalesce(F.sum(F.coalesce("_n0", F.col("_y").isNotNull().cast("long"))).over(before), F.lit(0))
    prior = train.agg(F.avg(label).alias("_prior"))  # one row
    encoded = parted.select(order_col, "column_name", "_sums", total.alias("_before"), count.alias("_count")).filter("not _sums")
    encoded = encoded.crossJoin(F.broadcast(prior))
    return encoded.select(order_col, "column_name", _drawn(F.col("_before"), F.col("_count"), weight).alias("encoded"))


def target_statistics(
    train: DataFrame, rows: DataFrame, columns: list[str], label: str, id_col: str, weight: float = 1.0
) -> DataFrame:
    """(id_col, column_name, encoded) of ``rows`` from all training rows; a label that training has not
    seen gets the prior. The labels' table is joined by label, of any size."""
    y = F.col(label).cast("double").alias("_y")
    table = _long(train.select(*columns, y), columns, ["_y"]).groupBy("column_name", "label").agg(
        F.sum("_y").alias("_s"), F.count("_y").alias("_n"))
    prior = train.agg(F.avg(label).alias("_prior"))  # one row
    joined = _long(rows.select(id_col, *columns), columns, [id_col]).join(table, ["column_name", "label"], "left")
    encoded = _drawn(F.coalesce("_s", F.lit(0.0)), F.coalesce("_n", F.lit(0)), weight)
    return joined.crossJoin(F.broadcast(prior)).select(id_col, "column_name", encoded.alias("encoded"))
