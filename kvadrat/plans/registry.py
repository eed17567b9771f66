"""Query registry: one Spark callable and (where SQL can say it) one DuckDB oracle per
operator of the survey's inventory. ``__spark_entry__`` only re-exports these.

Every query reads the driver tables at ``sf_dir`` (or frames Spark derives from them) in
full; limits appear only where a top-k is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvadrat import schema as S
from kvadrat.operators import cleaning as C
from kvadrat.operators import stats as E
from kvadrat.plans import frames
from kvadrat.plans import testview
from kvadrat.plans.oracle import COMPLETE, KEY, QUALITY, RAW, RULE_AREA, RULE_PRICE, RULE_ROOMS, RULE_YEAR, q

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return deco


#: Groups of queries, the quickest first; those without SQL follow them all.
_GROUPS = "xscfeprm"


def _in_order(names) -> list[str]:
    return sorted(names, key=lambda n: (n not in _ORACLES, _GROUPS.index(n[0])))


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {n: _QUERIES[n] for n in _in_order(_QUERIES)}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {n: _ORACLES[n] for n in _in_order(_ORACLES)}


def _load_all() -> None:
    # modules that register further queries on import
    import importlib

    for mod in ["queries_stats", "queries_model", "queries_score", "queries_extract", "queries_pages", "queries_sources"]:
        try:
            importlib.import_module(f"kvadrat.plans.{mod}")
        except ModuleNotFoundError as exc:
            if exc.name != f"kvadrat.plans.{mod}":
                raise


ROUND6 = 6


def _r(c: str, d: int = ROUND6):
    return E.round_even(F.col(c), d).alias(c)


# ---------------------------------------------------------------------------
# C: cleaning
# ---------------------------------------------------------------------------


@register(
    "c1_split_by_key",
    q(f"select {RAW}, ({COMPLETE}) as key_complete from raw"),
)
def c1(spark, sf):
    raw = frames.raw(spark, sf)
    return raw.select(*S.RAW_COLUMNS, C.complete_key().alias("key_complete"))


@register("c2_dedup_keep_first", q(f"select {RAW} from deduped where _complete"))
def c2(spark, sf):
    complete, _ = C.split_by_key(frames.raw(spark, sf))
    return C._first_per_key(complete, S.COMPOSITE_KEY, C.ORDER_COL).select(*S.RAW_COLUMNS)


@register("c3_concat_deduped", q(f"select {RAW} from deduped"))
def c3(spark, sf):
    return frames.deduped(spark, sf).select(*S.RAW_COLUMNS)


@register("c4_quality_filter", q(f"select {RAW} from cleaned"))
def c4(spark, sf):
    return frames.cleaned(spark, sf).select(*S.RAW_COLUMNS)


_SUMMARY_SQL = q(
    f"""
, grp as (select {KEY}, count(*) as n from raw where {COMPLETE} group by {KEY})
select
  (select count(*) from raw) as raw_rows,
  (select count(*) from raw where {COMPLETE}) as complete_key_rows,
  (select coalesce(sum(n), 0) from grp where n > 1)::bigint as duplicate_rows,
  (select count(*) from grp where n > 1) as duplicate_groups,
  (select coalesce(sum(n - 1), 0) from grp)::bigint as rows_removed_if_keeping_first,
  (select count(*) from deduped) as deduped_rows,
  (select count(*) from cleaned) as cleaned_rows,
  (select count(*) from raw) - (select count(*) from cleaned) as rows_removed_total
"""
)


@register("c5_cleaning_summary", _SUMMARY_SQL)
def c5(spark, sf):
    return C.cleaning_summary(frames.raw(spark, sf))


@register(
    "c6_rule_violations",
    q(
        f"""
select * from (
  select 1 as rule_no, '{C.RULE_LABELS["area_m2"]}' as rule, count_if(not {RULE_AREA})::bigint as rows from deduped
  union all select 2, '{C.RULE_LABELS["price_eur"]}', count_if(not {RULE_PRICE})::bigint from deduped
  union all select 3, '{C.RULE_LABELS["rooms"]}', count_if(not {RULE_ROOMS})::bigint from deduped
  union all select 4, '{C.RULE_LABELS["year_built"]}', count_if(not {RULE_YEAR})::bigint from deduped
  union all select 5, '{C.RULE_LABELS["all"]}', count_if(not {QUALITY})::bigint from deduped)
"""
    ),
)
def c6(spark, sf):
    return C.rule_violations(frames.deduped(spark, sf, list(C.quality_rules())))


@register(
    "c7_violation_examples",
    q(
        f"""
select title, area_m2, price_eur, rooms, year_built, city, url from deduped
where not {QUALITY}
order by _complete desc, {", ".join(f"_o_{c} asc nulls first" for c in testview.FIRST_ORDER)},
         {", ".join(f"{k} asc nulls first" for k in S.COMPOSITE_KEY)}
limit 10
"""
    ),
)
def c7(spark, sf):
    return C.violation_examples(frames.ordered(spark, sf), 10, order_col=testview.FIRST_ORDER)


@register(
    "c8_stage_table",
    q(
        """
, s as (select 1 as stage_no, 'raw' as stage, (select count(*) from raw) as rows
        union all select 2, 'deduped', (select count(*) from deduped)
        union all select 3, 'cleaned', (select count(*) from cleaned))
select stage_no, stage, rows, coalesce(lag(rows) over (order by stage_no) - rows, 0) as removed_from_previous from s
"""
    ),
)
def c8(spark, sf):
    return C.stage_table(frames.raw(spark, sf))


@register(
    "c9_top_duplicate_groups",
    q(
        f"""
select {KEY}, count(*) as copies from raw where {COMPLETE} group by {KEY} having count(*) > 1
order by copies desc, {", ".join(f"{k} asc" for k in S.COMPOSITE_KEY)} limit 10
"""
    ),
)
def c9(spark, sf):
    return C.top_duplicate_groups(frames.raw(spark, sf))


@register(
    "c10_exact_duplicates",
    q(f"select coalesce(sum(n - 1), 0)::bigint as exact_duplicate_rows from (select count(*) as n from raw group by {RAW})"),
)
def c10(spark, sf):
    return C.exact_duplicates(frames.raw(spark, sf))


@register(
    "c11_duplicate_urls",
    q("select coalesce(sum(n - 1), 0)::bigint as duplicate_url_rows from (select count(*) as n from raw group by url)"),
)
def c11(spark, sf):
    return C.duplicate_urls(frames.raw(spark, sf))
