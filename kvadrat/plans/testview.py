"""Listings view over the driver's TPC-H-like tables.

The driver tables hold no property listings, so the test bridge derives one listing per
``lineitem`` row (joined to part, supplier, nation, region) with injected nulls,
placeholders, odd floor strings and duplicate copies. The column expressions are plain
SQL that Spark and DuckDB evaluate identically, so the same text feeds both the Spark
operators and the DuckDB oracle; the view grows linearly with ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvadrat import schema as S

# fixed values: column expressions of the listings view (shared by Spark and DuckDB)
VIEW_COLUMNS: list[tuple[str, str]] = [
    ("listing_key", "cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar)"),
    ("title", "case when l_orderkey % 97 = 0 then null else p_name end"),
    (
        "description",
        "case when l_partkey % 11 = 0 then 'Lux stan' when l_partkey % 13 = 0 then 'penthaus duplex' "
        "when l_partkey % 17 = 0 then null else p_type end",
    ),
    ("area_m2", "case when l_orderkey % 89 = 0 then null else l_quantity * 11 end"),
    ("price_eur", "case when l_orderkey % 83 = 0 then null else l_extendedprice * 2 end"),
    ("city", "case when l_suppkey % 23 = 0 then '-' else n_name end"),
    ("region", "case when l_suppkey % 29 = 0 then '' when l_suppkey % 31 = 0 then null else r_name end"),
    ("street", "case when l_suppkey % 7 = 0 then null else s_name end"),
    ("heating_type", "case when l_partkey % 19 = 0 then '-' else p_type end"),
    ("rooms", "case when p_size % 9 = 0 then null else cast(p_size as double) / 4 end"),
    ("parking", "case when l_returnflag = 'N' then '' else l_returnflag end"),
    (
        "raw_floor_string",
        "case when l_linenumber = 1 then 'Suteren / ' || cast(p_size % 9 as varchar) "
        "when l_linenumber = 2 then 'Visoko prizemlje' "
        "when l_linenumber = 3 then cast(l_linenumber as varchar) || ',5 / ' || cast(p_size % 9 as varchar) "
        "when l_linenumber = 4 then cast(p_size % 12 as varchar) "
        "when l_linenumber = 5 then '-' "
        "else cast(p_size % 9 as varchar) || '/' || cast(l_linenumber as varchar) end",
    ),
    (
        "year_built",
        "case when l_orderkey % 5 = 0 then null else cast(year(l_shipdate) as double) "
        "+ case when l_orderkey % 101 = 0 then 40 else 0 end end",
    ),
    ("url", "'https://example.test/' || cast(l_orderkey as varchar) || '/' || cast(l_linenumber as varchar)"),
]

DUPLICATE_RULE = "area_m2 >= 500 or price_eur < 20000"

# order that decides which copy is "first" among rows sharing the composite key
FIRST_ORDER = ["url", "heating_type", "rooms", "parking", "raw_floor_string", "year_built", "region", "street"]

_JOIN_SQL = (
    "lineitem join part on l_partkey = p_partkey "
    "join supplier on l_suppkey = s_suppkey "
    "join nation on s_nationkey = n_nationkey "
    "join region on n_regionkey = r_regionkey"
)


def listings_sql() -> str:
    """DuckDB CTE body defining ``listings`` (base rows plus injected duplicates)."""
    cols = ",\n    ".join(f"{expr} as {name}" for name, expr in VIEW_COLUMNS)
    names = ", ".join(n for n, _ in VIEW_COLUMNS)
    dup_names = ", ".join("url || '?dup' as url" if n == "url" else n for n, _ in VIEW_COLUMNS)
    return (
        f"listings_base as (select\n    {cols}\n  from {_JOIN_SQL}),\n"
        f"listings as (select {names} from listings_base union all "
        f"select {dup_names} from listings_base where {DUPLICATE_RULE})"
    )


#: The fact tables and their keys.
_FACTS = {
    "lineitem": ["l_orderkey", "l_linenumber"],
    "pages": ["page_id"],
    "orders": ["o_orderkey"],
    "documents": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its file is one row group, so one task; ``spark.kvadrat.scanPartitions``
    (unset by default, set by the local script session) deals the fact tables' rows to so many, in
    turn: no shuffle by key that plans of the operators would show as one of theirs."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    parts = spark.conf.get("spark.kvadrat.scanPartitions", None)
    return df.repartition(int(parts)) if parts and name in _FACTS else df


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Short rows dealt by key to as many tasks as the session shuffles into, before costly columns are made
    of them: a table of one row group is one task's, and all that follows in its stage would be too."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _dealt_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), *_FACTS["lineitem"])


def listings_base(spark: SparkSession, sf_dir: str, deal: bool = False) -> DataFrame:
    """One listing per lineitem row. Dimension tables join on their keys; Catalyst picks
    broadcast for the ones under ``spark.sql.autoBroadcastJoinThreshold`` and sort-merge
    otherwise, so a growing ``part`` or ``supplier`` never gets force-broadcast. ``deal``: the rows are
    dealt before listings are made of them, for queries that spend their time there."""
    t = {n: read_table(spark, sf_dir, n) for n in ["part", "supplier", "nation", "region"]}
    t["lineitem"] = _dealt_lineitem(spark, sf_dir) if deal else read_table(spark, sf_dir, "lineitem")
    joined = (
        t["lineitem"]
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
        .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select(*[F.expr(expr.replace("varchar", "string")).alias(name) for name, expr in VIEW_COLUMNS])


def with_first_order(df: DataFrame) -> DataFrame:
    """Attach ``_ord``: the struct that ranks copies of a key (ascending, nulls first)."""
    return df.withColumn("_ord", F.struct(*[F.col(c) for c in FIRST_ORDER]))


def listings(spark: SparkSession, sf_dir: str, deal: bool = False) -> DataFrame:
    """Base rows plus the injected near-copies (same content, different URL)."""
    base = listings_base(spark, sf_dir, deal)
    # one scan and one join: each row is emitted once, plus a '?dup' copy when the rule holds
    copies = F.when(F.expr(DUPLICATE_RULE), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = base.withColumn("_copy", F.explode(copies))
    rows = rows.withColumn("url", F.when(F.col("_copy"), F.concat(F.col("url"), F.lit("?dup"))).otherwise(F.col("url")))
    return with_first_order(rows.drop("_copy"))


def raw_listings(spark: SparkSession, sf_dir: str, deal: bool = False) -> DataFrame:
    """The 13 raw columns plus ``_ord`` (listing_key dropped: copies differ only there)."""
    return listings(spark, sf_dir, deal).select(*S.RAW_COLUMNS, "_ord")


# fixed values: score-request view (string inputs, as a form would send them)
SCORE_COLUMNS: list[tuple[str, str]] = [
    ("input_id", "cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) || '-' || cast(l_partkey as varchar)"),
    ("city", dict(VIEW_COLUMNS)["city"]),
    ("region", dict(VIEW_COLUMNS)["region"]),
    ("street", dict(VIEW_COLUMNS)["street"]),
    ("area_m2", f"cast({dict(VIEW_COLUMNS)['area_m2']} as varchar)"),
    ("rooms", f"cast({dict(VIEW_COLUMNS)['rooms']} as varchar)"),
    ("heating_type", dict(VIEW_COLUMNS)["heating_type"]),
    ("parking", dict(VIEW_COLUMNS)["parking"]),
    ("floor", "cast(l_linenumber as varchar)"),
    ("total_floors", "cast(p_size % 9 as varchar)"),
    ("year_built", f"cast({dict(VIEW_COLUMNS)['year_built']} as varchar)"),
    ("is_lux", "l_partkey % 11 = 0"),
    ("is_penthouse", "l_partkey % 13 = 0"),
    ("is_duplex", "l_partkey % 3 = 0"),
]


def score_inputs_sql() -> str:
    cols = ",\n    ".join(f"{expr} as {name}" for name, expr in SCORE_COLUMNS)
    return f"score_input as (select\n    {cols}\n  from {_JOIN_SQL})"


def score_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scoring request per lineitem row, every field a string (or boolean flag)."""
    t = {n: read_table(spark, sf_dir, n) for n in ["part", "supplier", "nation", "region"]}
    joined = (
        _dealt_lineitem(spark, sf_dir)
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
        .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select(*[F.expr(expr.replace("varchar", "string")).alias(name) for name, expr in SCORE_COLUMNS])
