"""Registry entries for the feature projections (F) and statistics (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kvadrat.session import checkpointed
from kvadrat import schema as S
from kvadrat.functions.floors import total_floors_text
from kvadrat.operators import features as FE
from kvadrat.operators import stats as E
from kvadrat.plans import flagship, frames
from kvadrat.plans.oracle import q, qc
from kvadrat.plans.registry import register
from kvadrat.plans import testview

R6 = 6


def _re(expr: str, d: int = R6) -> str:
    """DuckDB mirror of ``round_even`` (numpy-style half-to-even on the scaled value)."""
    return f"round_even(({expr}) * {10**d}.0, 0) / {10**d}.0"


def _rs(c, d: int = R6):
    return E.round_even(F.col(c), d).alias(c)


MODEL_OUT = S.RAW_COLUMNS + [
    "price_per_m2",
    "floor",
    "total_floors",
    "is_last_floor",
    "building_age",
    "city_region",
    "is_lux",
    "is_penthouse",
    "is_duplex",
]

# ---------------------------------------------------------------------------
# F: features
# ---------------------------------------------------------------------------


@register(
    "f1_normalize_categories",
    q(f"select {', '.join(S.CATEGORICAL_COLUMNS_TO_NORMALIZE)}, url from norm"),
)
def f1(spark, sf):
    return FE.normalize_categories(frames.cleaned(spark, sf)).select(*S.CATEGORICAL_COLUMNS_TO_NORMALIZE, "url")


@register("f2_price_per_m2", q("select price_eur, area_m2, price_per_m2 from model"))
def f2(spark, sf):
    return frames.model(spark, sf).select("price_eur", "area_m2", "price_per_m2")


@register("f3_total_floors_text", q("select raw_floor_string, _total as total_from_text from parsed"))
def f3(spark, sf):
    m = FE.normalize_categories(frames.cleaned(spark, sf))
    return m.select("raw_floor_string", total_floors_text("raw_floor_string").alias("total_from_text"))


@register("f4_parse_floor", q("select raw_floor_string, floor, total_floors from model"))
def f4(spark, sf):
    return frames.model(spark, sf).select("raw_floor_string", "floor", "total_floors")


@register("f5_is_last_floor", q("select floor, total_floors, is_last_floor from model"))
def f5(spark, sf):
    return frames.model(spark, sf).select("floor", "total_floors", "is_last_floor")


@register("f6_building_age", q("select year_built, building_age from model"))
def f6(spark, sf):
    return frames.model(spark, sf).select("year_built", "building_age")


@register("f7_city_region", q("select city, region, city_region from model"))
def f7(spark, sf):
    return frames.model(spark, sf).select("city", "region", "city_region")


@register("f8_f10_text_flags", q("select title, description, is_lux, is_penthouse, is_duplex from model"))
def f8_10(spark, sf):
    return frames.model(spark, sf).select("title", "description", "is_lux", "is_penthouse", "is_duplex")


@register("f11_feature_contract", q(f"select {', '.join(S.model_feature_columns())} from model"))
def f11(spark, sf):
    return FE.feature_contract(frames.model(spark, sf))


@register("f12_add_model_features", q(f"select {', '.join(MODEL_OUT)} from model"))
def f12(spark, sf):
    return frames.model(spark, sf).select(*MODEL_OUT)


# ---------------------------------------------------------------------------
# E: statistics
# ---------------------------------------------------------------------------


def _missing_sql() -> str:
    parts = [
        f"select '{c}' as column_name, count_if({c} is null)::bigint as missing_count, "
        f"{_re(f'count_if({c} is null)::double / count(*) * 100.0', 2)} as missing_pct from raw"
        for c in S.RAW_COLUMNS
    ]
    return q(" union all ".join(parts))


@register("e1_missing_table", _missing_sql())
def e1(spark, sf):
    return E.missing_table(frames.raw(spark, sf), S.RAW_COLUMNS)


def _describe_sql(columns, pcts, names, source="raw", digits=2) -> str:
    parts = []
    for c in columns:
        qs = ", ".join(f"{_re(qc(c, p), digits)} as {n}" for p, n in zip(pcts, names))
        parts.append(
            f"select '{c}' as column_name, count({c}) as count, {_re(f'avg({c})', digits)} as mean, "
            f"{_re(f'stddev_samp({c})', digits)} as std, {_re(f'min({c})', digits)} as min, {qs}, "
            f"{_re(f'max({c})', digits)} as max from {source}"
        )
    return " union all ".join(parts)


@register(
    "e2_describe",
    q(_describe_sql(S.NUMERIC_RAW_COLUMNS, E.DESCRIBE_PERCENTILES, ["p1", "p5", "p50", "p95", "p99"])),
)
def e2(spark, sf):
    return E.describe(frames.raw(spark, sf), S.NUMERIC_RAW_COLUMNS)


_CLIP_SQL = """
, b as (select """ + qc("price_eur", 0.99) + " as pu, " + qc("area_m2", 0.99) + """ as au from raw),
series as (
  select 'raw_price_k' as series, least(price_eur, pu) / 1000 as value from raw, b where price_eur is not null
  union all select 'cleaned_price_k', least(price_eur, pu) / 1000 from cleaned, b where price_eur is not null
  union all select 'raw_area', least(area_m2, au) from raw, b where area_m2 is not null
  union all select 'cleaned_area', least(area_m2, au) from cleaned, b where area_m2 is not null)
"""


def _clip_series(spark, sf):
    """(series, value, _n): raw and cleaned values clipped at the raw p99, from one pass over the
    listings, whose narrow counts are written once; both bounds are one ranking."""
    sets = checkpointed(frames.sets(spark, sf, ["price_eur", "area_m2"]))
    raw = sets.select("price_eur", "area_m2", F.col("raw").alias("_n"))
    bounds = E.exact_quantiles(E.stacked(raw, ["price_eur", "area_m2"], keep=["_n"]), "value", [0.99], ["column_name"])
    series = [("raw_price_k", "price_eur", "raw", 1000.0), ("cleaned_price_k", "price_eur", "cleaned", 1000.0),
              ("raw_area", "area_m2", "raw", 1.0), ("cleaned_area", "area_m2", "cleaned", 1.0)]
    each = F.explode(F.array(*[
        F.struct(F.lit(name).alias("series"), F.lit(col).alias("column_name"), F.col(col).alias("value"), F.col(n).alias("_n"), F.lit(scale).alias("scale"))
        for name, col, n, scale in series]))
    rows = sets.select(each.alias("s")).select("s.*").filter("_n > 0 AND value IS NOT NULL")
    clipped = rows.join(F.broadcast(bounds.select("column_name", "q0")), "column_name")  # two rows
    return clipped.select("series", (F.least("value", "q0") / F.col("scale")).alias("value"), "_n")


@register("e3_clip_at_quantile", q(_CLIP_SQL + f"select series, {_re('value')} as value from series"))
def e3(spark, sf):
    s = E.repeated(_clip_series(spark, sf))
    return s.select("series", _rs("value"))


@register(
    "e4_histogram45",
    q(
        _CLIP_SQL
        + f"""
, rng as (select series, case when min(value) = max(value) then min(value) - 0.5 else min(value) end as lo,
                 case when min(value) = max(value) then max(value) + 0.5 else max(value) end as hi
          from series group by series),
raw_bin as (select s.series, value, lo, hi, least(floor((value - lo) / (hi - lo) * 45.0::double), 44)::int as r
            from series s join rng using (series)),
down as (select *, case when value < (case when r = 45 then hi else r * ((hi - lo) / 45) + lo end) then r - 1 else r end as d
         from raw_bin),
binned as (select series, lo, hi,
             case when value >= (case when d + 1 = 45 then hi else (d + 1) * ((hi - lo) / 45) + lo end) and d <> 44
                  then d + 1 else d end as bin
           from down)
select series, bin, {_re('case when bin = 45 then hi else bin * ((hi - lo) / 45) + lo end')} as bin_lo,
       {_re('case when bin + 1 = 45 then hi else (bin + 1) * ((hi - lo) / 45) + lo end')} as bin_hi,
       count(*) as count
from binned group by series, bin, lo, hi
"""
    ),
)
def e4(spark, sf):
    h = E.histogram(_clip_series(spark, sf), "value", 45, group_cols=["series"])
    return h.select("series", "bin", _rs("bin_lo"), _rs("bin_hi"), "count")


@register(
    "e5_value_counts_top",
    q(
        """
select * from (select 'raw' as stage, city, count(*) as n from raw where city is not null group by city
               order by n desc, city limit 10)
union all
select * from (select 'cleaned' as stage, city, count(*) as n from cleaned where city is not null group by city
               order by n desc, city limit 10)
"""
    ),
)
def e5(spark, sf):
    return E.set_value_counts_top(frames.sets(spark, sf, ["city"]), "city")


@register(
    "e6_before_after_counts",
    q(
        """
, a as (select city, count(*) as raw_rows from raw where city is not null group by city),
c as (select city, count(*) as cleaned_rows from cleaned where city is not null group by city)
select coalesce(a.city, c.city) as city, coalesce(raw_rows, 0) as raw_rows, coalesce(cleaned_rows, 0) as cleaned_rows,
       coalesce(raw_rows, 0) - coalesce(cleaned_rows, 0) as removed
from a full outer join c on a.city = c.city
order by raw_rows desc, city limit 10
"""
    ),
)
def e6(spark, sf):
    return E.set_before_after(frames.sets(spark, sf, ["city"]), "city")


@register(
    "e7_category_share",
    q(
        f"""
, c as (select city, count(*) as n from cleaned where city is not null group by city)
select city, {_re('n::double / (select sum(n) from c) * 100.0', 2)} as share_pct, n from c order by n desc, city limit 15
"""
    ),
)
def e7(spark, sf):
    return E.category_share(frames.cleaned(spark, sf), "city", 15)


_TOP8_SQL = """
, top8 as (select city from cleaned where city is not null group by city order by count(*) desc, city limit 8),
sub as (select * from model where city in (select city from top8))
"""


@register(
    "e8_top_k_semi_join",
    q(_TOP8_SQL + "select city, region, area_m2, price_eur, price_per_m2 from sub"),
)
def e8(spark, sf):
    cleaned = frames.cleaned_checkpointed(spark, sf)
    sub = E.top_k_semi_join(FE.add_model_features(cleaned), cleaned, "city", 8)
    return sub.select("city", "region", "area_m2", "price_eur", "price_per_m2")


def _clip98(spark, sf):
    # the ranking uses raw cleaned city labels, the rows are the (normalized) model stage
    cleaned = frames.cleaned_checkpointed(spark, sf)
    sub = E.top_k_semi_join(FE.add_model_features(cleaned), cleaned, "city", 8)
    return E.clip_upper(sub.select("city", "price_per_m2"), "price_per_m2", 0.98).withColumnRenamed(
        "price_per_m2_clipped", "price_per_m2_plot"
    )


_CLIP98_SQL = _TOP8_SQL + """
, p as (select """ + qc("price_per_m2", 0.98) + """ as u from sub),
plot as (select city, price_per_m2, case when price_per_m2 is null then null else least(price_per_m2, u) end as price_per_m2_plot
         from sub, p)
"""


@register("e9_clip98", q(_CLIP98_SQL + f"select city, price_per_m2, {_re('price_per_m2_plot')} as price_per_m2_plot from plot"))
def e9(spark, sf):
    return _clip98(spark, sf).select("city", "price_per_m2", _rs("price_per_m2_plot"))


@register(
    "e10_box_stats",
    q(
        _CLIP98_SQL
        + f"""
, d as (select city, price_per_m2_plot as x from plot where price_per_m2_plot is not null),
qq as (select city, {qc('x', 0.25)} as q1, {qc('x', 0.5)} as median, {qc('x', 0.75)} as q3 from d group by city)
select city, count(*) as n, {_re('q1')} as q1, {_re('median')} as median, {_re('q3')} as q3, {_re('q3 - q1')} as iqr,
  {_re('min(case when x >= q1 - 1.5 * (q3 - q1) and x <= q3 + 1.5 * (q3 - q1) then x end)')} as whisker_low,
  {_re('max(case when x >= q1 - 1.5 * (q3 - q1) and x <= q3 + 1.5 * (q3 - q1) then x end)')} as whisker_high,
  count_if(not (x >= q1 - 1.5 * (q3 - q1) and x <= q3 + 1.5 * (q3 - q1)))::bigint as n_outliers
from d join qq using (city) group by city, q1, median, q3
"""
    ),
)
def e10(spark, sf):
    b = E.box_stats(_clip98(spark, sf), "price_per_m2_plot", "city")
    return b.select("city", "n", *[_rs(c) for c in ["q1", "median", "q3", "iqr", "whisker_low", "whisker_high"]], "n_outliers")


_REGION_SQL = f"""
, rs as (select city, region, count(price_eur) as listings,
    {_re(qc('price_eur', 0.05), 0)} as p05, {_re(qc('price_eur', 0.25), 0)} as p25,
    {_re(qc('price_eur', 0.5), 0)} as median, {_re(qc('price_eur', 0.75), 0)} as p75,
    {_re(qc('price_eur', 0.95), 0)} as p95
  from cleaned where city in (select city from cleaned where city is not null group by city
                              order by count(*) desc, city limit {frames.SUMMARY_TOP_CITIES})
    and region is not null
  group by city, region having count(price_eur) >= 30)
"""


@register("e11_region_price_summary", q(_REGION_SQL + "select * from rs"))
def e11(spark, sf):
    return E.region_price_summary(frames.cleaned_checkpointed(spark, sf), frames.SUMMARY_TOP_CITIES)


@register(
    "e12_top_n_per_group",
    q(
        _REGION_SQL
        + "select city, region, listings, p05, p25, median, p75, p95 from "
        "(select *, row_number() over (partition by city order by median desc, region asc) as rn from rs) where rn <= 10"
    ),
)
def e12(spark, sf):
    return flagship.region_summary(spark, sf)


@register(
    "e13_pearson",
    q(
        f"""
select 'raw' as dataset, {_re('corr(area_m2, price_eur)')} as pearson from raw
union all select 'cleaned', {_re('corr(area_m2, price_eur)')} from cleaned
"""
    ),
)
def e13(spark, sf):
    rows = E.by_dataset(frames.sets(spark, sf, ["area_m2", "price_eur"]))
    return E.repeated(rows).groupBy("dataset").agg(E.pearson("area_m2", "price_eur").alias("pearson")).select("dataset", _rs("pearson"))


def _spearman_sql(src: str) -> str:
    return f"""(select corr(ra, rb) from (
   select rank() over (order by area_m2) + (count(*) over (partition by area_m2) - 1) / 2.0 as ra,
          rank() over (order by price_eur) + (count(*) over (partition by price_eur) - 1) / 2.0 as rb
   from {src} where area_m2 is not null and price_eur is not null))"""


@register(
    "e14_spearman",
    q(
        f"""
select 'raw' as dataset, {_re(_spearman_sql('raw'))} as spearman
union all select 'cleaned', {_re(_spearman_sql('cleaned'))}
"""
    ),
)
def e14(spark, sf):
    rows = E.by_dataset(frames.sets(spark, sf, ["area_m2", "price_eur"]))
    return E.spearman(rows, group_cols=["dataset"]).select("dataset", _rs("spearman"))


def _corr_sql() -> str:
    cols = E.CORR_COLUMNS
    parts = []
    for a in cols:
        for b in cols:
            v = f"corr({a}, {b})"
            parts.append(
                f"select '{a}' as col_a, '{b}' as col_b, {_re(f'case when isnan({v}) then null else {v} end')} as corr from model"
            )
    return " union all ".join(parts)


@register("e15_corr_matrix", q(_corr_sql()))
def e15(spark, sf):
    return E.corr_matrix(frames.model(spark, sf))


_SAMPLE_OUT = E.SAMPLE_KEY + ["area_m2", "price_eur", "rooms", "year_built"]


def _hash_sql(cols) -> str:
    parts = " || ".join(f"'|' || coalesce({c}, '~')" for c in cols)
    return f"md5('{S.RANDOM_STATE}' || {parts})"


@register(
    "e16_seeded_sample",
    q(
        f"select {', '.join(_SAMPLE_OUT)} from raw order by {_hash_sql(E.SAMPLE_KEY)}, "
        "area_m2 nulls first, price_eur nulls first, rooms nulls first, year_built nulls first limit 3000"
    ),
)
def e16(spark, sf):
    ties = ["area_m2", "price_eur", "rooms", "year_built"]
    return E.seeded_sample(frames.raw(spark, sf), 3000, tie_break=ties).select(*_SAMPLE_OUT)


@register(
    "e17_category_options",
    q(
        " union all ".join(
            f"select distinct '{c}' as option_set, {c} as label from model where {c} is not null"
            for c in ["city", "region", "heating_type", "parking"]
        )
    ),
)
def e17(spark, sf):
    return E.category_options(frames.model(spark, sf))


@register(
    "e18_regions_by_city",
    q(
        """
select city, (row_number() over (partition by city order by region) - 1)::int as pos, region
from (select distinct city, region from model where city is not null and region is not null)
"""
    ),
)
def e18(spark, sf):
    return E.regions_by_city(frames.model(spark, sf))


@register(
    "e19_numeric_ranges",
    q(
        " union all ".join(
            f"select '{c}' as column_name, min({c})::double as min, {qc(c, 0.5)}::double as median, "
            f"max({c})::double as max from model"
            for c in ["area_m2", "rooms", "year_built", "price_eur"]
        )
    ),
)
def e19(spark, sf):
    return E.numeric_ranges(frames.model(spark, sf))


_TYPES = " ".join(f"when '{duck}' then '{name}'" for duck, name in (("VARCHAR", "string"), ("DOUBLE", "double")))
_DTYPES = ", ".join(f"case typeof(any_value({c})) {_TYPES} else typeof(any_value({c})) end as {c}" for c in S.RAW_COLUMNS)


@register(
    "e20_shape_summary",
    q(
        f", n as (select count(*) as n_rows, {_DTYPES} from raw) "
        + " union all ".join(
            f"select {i} as ordinal, '{c}' as column_name, {c} as data_type, n_rows, {len(S.RAW_COLUMNS)} as n_columns from n"
            for i, c in enumerate(S.RAW_COLUMNS, 1)
        )
    ),
)
def e20(spark, sf):
    return E.shape_summary(frames.raw(spark, sf))


@register(
    "e20_first_rows",
    q(f"select {', '.join(S.RAW_COLUMNS)} from raw order by {', '.join(f'{c} asc nulls first' for c in testview.FIRST_ORDER)} limit 5"),
)
def e20_head(spark, sf):
    return E.first_rows(frames.raw(spark, sf)).select(*S.RAW_COLUMNS)
