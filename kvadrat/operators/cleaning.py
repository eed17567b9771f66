"""Cleaning operators (C1-C11): composite-key dedup, quality filter and their summaries.

"First" copy of a key is the one with the smallest ``_ord`` (the loader attaches it from
the file position; the test view from its stated column order). Keys are wide (title and
description), so rows are grouped by a 128-bit digest of the key: partial aggregation sorts and
hashes two longs, the shuffle is dealt by them, and a key holding a third of all rows is
reduced to one candidate per map task before it. A third digest is checked in every group, so two
keys that share a digest fail the query rather than lose a row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kvadrat import schema as S

ORDER_COL = "_ord"


def complete_key(key: list[str] | None = None) -> Column:
    key = key or S.COMPOSITE_KEY
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])


def split_by_key(df: DataFrame, key: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with every key field present, rows missing any)."""
    ok = complete_key(key)
    return df.filter(ok), df.filter(~ok)


DIGEST = ["_d1", "_d2"]


def key_digest(columns: list[str], present: Column | None = None) -> dict[str, Column]:
    """``_d1``, ``_d2`` (what rows are grouped by) and ``_d3`` (what a group is checked by): hashes
    of the columns in different orders. A null hashes as a mark of its own; rows that are not
    ``present`` all have the digest null."""
    marked = [F.struct(F.col(c).isNull(), F.col(c)) for c in columns]
    orders = {"_d1": marked, "_d2": [F.lit(2), *marked[::-1]], "_d3": [F.lit(3), *marked[1:], *marked[:1]]}
    return {n: F.xxhash64(*o) if present is None else F.when(present, F.xxhash64(*o)) for n, o in orders.items()}


def _checked(value: Column) -> Column:
    """``value`` if all rows of a digest group have one key."""
    same = F.min("_d3").eqNullSafe(F.max("_d3"))
    return F.when(same, value).otherwise(F.raise_error(F.lit("two keys share a digest")).cast("bigint"))


def _order(order_col: str | list[str]) -> list[str]:
    return [order_col] if isinstance(order_col, str) else order_col


def _first_per_key(
    df: DataFrame, key: list[str], order_col: str | list[str], alone: Column | None = None, columns: list[str] | None = None
) -> DataFrame:
    """The first row of each key. Rows that stand ``alone`` have a digest of their own, a number that
    no other row has, so they pass the same aggregate as groups of one. The order leads the row that is
    carried, so it goes along once, and so do its columns if it is given as a list; with ``columns``
    no others are carried."""
    digests = key_digest(key)
    if alone is not None:
        number = F.monotonically_increasing_id()
        own = {"_d1": number, "_d2": F.lit(-1), "_d3": F.lit(0)}
        digests = {n: F.when(alone, own[n]).otherwise(d) for n, d in digests.items()}
        digests["_alone"] = alone
    columns = columns or df.columns
    row = F.struct(*[F.col(c) for c in dict.fromkeys([*_order(order_col), *columns])])
    group = [n for n in digests if n != "_d3"]
    first = df.withColumns(digests).groupBy(*group).agg(
        F.min(row).alias("_first"), _checked(F.count(F.lit(1))).alias("_copies"))
    return first.filter(F.col("_copies") > 0).select(*[F.col(f"_first.{c}").alias(c) for c in columns])


def dedup_keep_first(
    df: DataFrame, key: list[str] | None = None, order_col: str | list[str] = ORDER_COL, columns: list[str] | None = None
) -> DataFrame:
    """C2 + C3: one row per complete key (the first copy) and every incomplete-key row, from one
    scan and one aggregate. ``columns``: those of the result, where not all are wanted."""
    key = key or S.COMPOSITE_KEY
    return _first_per_key(df, key, order_col, ~complete_key(key), columns)


def quality_rules() -> dict[str, Column]:
    """C4 rules, inclusive; rooms and year may be missing, area and price may not."""
    return {
        "area_m2": F.col("area_m2").between(*S.AREA_RANGE),
        "price_eur": F.col("price_eur").between(*S.PRICE_RANGE),
        "rooms": F.col("rooms").isNull() | F.col("rooms").between(*S.ROOMS_RANGE),
        "year_built": F.col("year_built").isNull() | F.col("year_built").between(*S.YEAR_RANGE),
    }


def passes_quality() -> Column:
    return F.coalesce(reduce(lambda a, b: a & b, quality_rules().values()), F.lit(False))


def quality_filter(df: DataFrame) -> DataFrame:
    """C4 on an already deduplicated frame."""
    return df.filter(passes_quality())


def build_cleaned(
    df: DataFrame, key: list[str] | None = None, order_col: str | list[str] = ORDER_COL, columns: list[str] | None = None
) -> DataFrame:
    """Dedup then quality filter. The rules on key columns hold for all copies or for none, so rows
    that fail them go before the shuffle; rooms and year depend on the chosen copy. ``columns``: those of
    the result, where not all are wanted; the columns of the rules must be among them."""
    key = key or S.COMPOSITE_KEY
    early = [F.coalesce(r, F.lit(False)) for c, r in quality_rules().items() if c in key]
    return quality_filter(dedup_keep_first(df.filter(reduce(lambda a, b: a & b, early, F.lit(True))), key, order_col, columns))


def set_counts(
    df: DataFrame, columns: list[str], key: list[str] | None = None, order_col: str = ORDER_COL
) -> DataFrame:
    """Raw against cleaned in one pass: distinct values of ``columns`` (columns of the key, so all
    copies of a listing share them) with ``raw`` and ``cleaned``, the rows that hold them before and
    after dedup and the quality filter. A value may show in several rows; their counts add up."""
    key = key or S.COMPOSITE_KEY
    if not set(columns) <= set(key):
        raise ValueError(f"only key columns have one value in all copies: {', '.join(sorted(set(columns) - set(key)))}")
    ok = complete_key(key)
    carried = list(dict.fromkeys([*columns, "area_m2", "price_eur"]))
    rows = df.select(*carried, "rooms", "year_built", order_col, ok.alias("_complete"), *(c.alias(n) for n, c in key_digest(key, ok).items()))
    # the values follow from a digest; without one they are the group
    groups = rows.groupBy(*DIGEST, "_complete", *carried).agg(
        _checked(F.count(F.lit(1))).alias("raw"),
        F.min_by(F.struct("rooms", "year_built"), F.col(order_col)).alias("_first"),
        F.count_if(passes_quality()).alias("_pass"),
    )
    first = groups.select(*carried, "_complete", "raw", "_pass", "_first.rooms", "_first.year_built")
    cleaned = F.when(F.col("_complete"), passes_quality().cast("bigint")).otherwise(F.col("_pass"))
    return first.select(*columns, "raw", cleaned.alias("cleaned"))


def cleaning_summary(df: DataFrame, key: list[str] | None = None, order_col: str | list[str] = ORDER_COL) -> DataFrame:
    """The eight counts as one row, from one scan and one aggregate.

    Incomplete-key rows all fall into one group (null digest, ``_complete`` false); only
    counts are taken from it and partial aggregation keeps that group map-side.
    """
    key = key or S.COMPOSITE_KEY
    ok = complete_key(key)
    # of the key, only what the rules read goes along
    carried = ["area_m2", "price_eur", "rooms", "year_built"]
    order = F.struct(*order_col) if isinstance(order_col, list) else F.col(order_col)
    groups = df.select(*carried, order.alias(ORDER_COL), ok.alias("_complete"), *(c.alias(n) for n, c in key_digest(key, ok).items()))
    groups = groups.groupBy(*DIGEST, "_complete").agg(
        _checked(F.count(F.lit(1))).alias("n"),
        F.min_by(F.struct(*carried), F.col(ORDER_COL)).alias("_first"),
        F.count_if(passes_quality()).alias("n_pass"),
    )
    first_ok = F.coalesce(
        F.col("_first.area_m2").between(*S.AREA_RANGE)
        & F.col("_first.price_eur").between(*S.PRICE_RANGE)
        & (F.col("_first.rooms").isNull() | F.col("_first.rooms").between(*S.ROOMS_RANGE))
        & (F.col("_first.year_built").isNull() | F.col("_first.year_built").between(*S.YEAR_RANGE)),
        F.lit(False),
    )
    c = F.col("_complete")
    n = F.col("n")
    totals = groups.agg(
        F.sum("n").alias("raw_rows"),
        F.coalesce(F.sum(F.when(c, n)), F.lit(0)).alias("complete_key_rows"),
        F.coalesce(F.sum(F.when(c & (n > 1), n)), F.lit(0)).alias("duplicate_rows"),
        F.count_if(c & (n > 1)).alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(c, n - 1)), F.lit(0)).alias("rows_removed_if_keeping_first"),
        F.count_if(c).alias("_groups"),
        F.coalesce(F.sum(F.when(~c, n)), F.lit(0)).alias("_incomplete"),
        F.count_if(c & first_ok).alias("_clean_complete"),
        F.coalesce(F.sum(F.when(~c, F.col("n_pass"))), F.lit(0)).alias("_clean_incomplete"),
    )
    return totals.select(
        F.coalesce(F.col("raw_rows"), F.lit(0)).cast("bigint").alias("raw_rows"),
        F.col("complete_key_rows").cast("bigint").alias("complete_key_rows"),
        F.col("duplicate_rows").cast("bigint").alias("duplicate_rows"),
        F.col("duplicate_groups").cast("bigint").alias("duplicate_groups"),
        F.col("rows_removed_if_keeping_first").cast("bigint").alias("rows_removed_if_keeping_first"),
        (F.col("_groups") + F.col("_incomplete")).cast("bigint").alias("deduped_rows"),
        (F.col("_clean_complete") + F.col("_clean_incomplete")).cast("bigint").alias("cleaned_rows"),
        (
            F.coalesce(F.col("raw_rows"), F.lit(0)) - F.col("_clean_complete") - F.col("_clean_incomplete")
        ).cast("bigint").alias("rows_removed_total"),
    )


RULE_LABELS = {
    "area_m2": "area_m2 outside 10-500 or missing",
    "price_eur": "price_eur outside 10000-1000000 or missing",
    "rooms": "rooms outside 0.5-10",
    "year_built": "year_built outside 1800-2028",
    "all": "removed after dedup",
}


def rule_violations(deduped: DataFrame) -> DataFrame:
    """Rows failing each rule, and rows failing any, in one aggregate + unpivot."""
    rules = quality_rules()
    aggs = [F.count_if(~F.coalesce(r, F.lit(False))).alias(n) for n, r in rules.items()]
    aggs.append(F.count_if(~passes_quality()).alias("all"))
    wide = deduped.agg(*aggs)
    names = list(rules) + ["all"]
    stacked = wide.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("rule_no"), F.lit(RULE_LABELS[n]).alias("rule"), F.col(n).alias("rows"))
                    for i, n in enumerate(names, 1)
                ]
            )
        ).alias("r")
    )
    return stacked.select("r.rule_no", "r.rule", F.col("r.rows").cast("bigint").alias("rows"))


def violation_examples(
    df: DataFrame,
    n: int = 10,
    key: list[str] | None = None,
    order_col: str | list[str] = ORDER_COL,
    columns: list[str] | None = None,
) -> DataFrame:
    """First ``n`` deduplicated rows that fail the quality rules (dedup order: kept
    complete-key rows by first position, then incomplete-key rows; the key columns break
    ties of the position so the pick is deterministic). A bounded top-k."""
    key = key or S.COMPOSITE_KEY
    columns = columns or ["title", "area_m2", "price_eur", "rooms", "year_built", "city", "url"]
    read = dict.fromkeys([*columns, *quality_rules(), *_order(order_col), *key])
    deduped = dedup_keep_first(df, key, order_col, list(read))
    rejected = deduped.filter(~passes_quality())
    order = [(~complete_key(key)).asc(), *[F.col(c).asc_nulls_first() for c in _order(order_col)]]
    order += [F.col(k).asc_nulls_first() for k in key]
    return rejected.orderBy(*order).limit(n).select(*columns)


def stage_table(df: DataFrame, key: list[str] | None = None, order_col: str = ORDER_COL) -> DataFrame:
    """Rows at each stage and the drop from the previous stage (lag over 3 rows)."""
    summary = cleaning_summary(df, key, order_col)
    stages = summary.select(
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("stage_no"), F.lit("raw").alias("stage"), F.col("raw_rows").alias("rows")),
                F.struct(F.lit(2).alias("stage_no"), F.lit("deduped").alias("stage"), F.col("deduped_rows").alias("rows")),
                F.struct(F.lit(3).alias("stage_no"), F.lit("cleaned").alias("stage"), F.col("cleaned_rows").alias("rows")),
            )
        ).alias("s")
    ).select("s.*")
    from pyspark.sql import Window

    w = Window.orderBy("stage_no")  # three rows: a single-partition window is harmless here
    return stages.withColumn(
        "removed_from_previous", F.coalesce(F.lag("rows").over(w) - F.col("rows"), F.lit(0)).cast("bigint")
    )


def top_duplicate_groups(df: DataFrame, n: int = 10, key: list[str] | None = None) -> DataFrame:
    """The ``n`` most repeated complete keys (ties by key, ascending)."""
    key = key or S.COMPOSITE_KEY
    complete, _ = split_by_key(df, key)
    counts = complete.withColumns(key_digest(key)).groupBy(*DIGEST).agg(
        F.min(F.struct(*key)).alias("_key"), _checked(F.count(F.lit(1))).alias("copies"))
    counts = counts.filter(F.col("copies") > 1).select("_key.*", "copies")
    return counts.orderBy(F.col("copies").desc(), *[F.col(k).asc() for k in key]).limit(n)


def exact_duplicates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Fully identical rows beyond the first (nulls equal). Rows are counted by digest alone:
    a hash aggregate of fixed width, whatever the columns hold."""
    per_row = df.select(*(c.alias(n) for n, c in key_digest(columns or S.RAW_COLUMNS).items()))
    per_row = per_row.groupBy(*DIGEST).agg(_checked(F.count(F.lit(1))).alias("n"))
    return per_row.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("exact_duplicate_rows"))


def duplicate_urls(df: DataFrame, url: str = "url") -> DataFrame:
    """C11: repeated URLs beyond the first; missing URLs count as equal to each other."""
    per_url = df.groupBy(url).agg(F.count(F.lit(1)).alias("n"))
    return per_url.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_url_rows"))
