"""Registry entries for scoring (P). The model scored with is the one-feature least
squares fit of ``queries_model`` so DuckDB can reproduce every prediction."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from kvadrat import schema as S
from kvadrat.functions.floors import floor_label
from kvadrat.operators import modeling as M
from kvadrat.operators import scoring as P
from kvadrat.operators import stats as E
from kvadrat.plans import frames
from kvadrat.plans.oracle import feature_ctes, q
from kvadrat.plans.queries_model import _METRICS_SQL, _PRED_SQL, _fit_two_models, _split, _two_model_predictions
from kvadrat.plans.queries_stats import _re, _rs
from kvadrat.plans.registry import register
from kvadrat.plans import testview

_WS = r"'^\s+|\s+$'"


def _strip_sql(c: str) -> str:
    return f"regexp_replace({c}, {_WS}, '', 'g')"


def _pyfloat_sql(c: str) -> str:
    return (
        f"case when regexp_full_match({c}, '\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*') "
        f"or regexp_full_match(lower({c}), '\\s*[+-]?(nan|inf|infinity)\\s*') then try_cast(trim({c}) as double) end"
    )


def _given_sql(c: str) -> str:
    return f"({c} is not null and {c} <> '')"


def _errors_sql() -> str:
    parts = [f"case when {f} is null or {_strip_sql(f)} = '' then '{f} je obavezno polje' end" for f in P.REQUIRED_FIELDS]
    a = _pyfloat_sql("area_m2")
    parts.append(
        f"case when {a} is null then 'area_m2 mora biti broj između 10 i 500' "
        f"when not ({a} between 10 and 500) then 'area_m2 mora biti između 10 i 500' end"
    )
    for f, lo, hi, number_msg in [
        ("rooms", "0.5", "10", "rooms mora biti broj između 0.5 i 10"),
        ("year_built", "1800", "2028", "year_built mora biti broj između 1800 i 2028"),
        ("floor", "-5", "200", "floor mora biti broj"),
        ("total_floors", "0", "200", "total_floors mora biti broj"),
    ]:
        v = _pyfloat_sql(f)
        parts.append(
            f"case when {_given_sql(f)} and {v} is null then '{number_msg}' "
            f"when {_given_sql(f)} and not ({v} between {lo} and {hi}) then '{f} mora biti između {lo} i {hi}' end"
        )
    fl, tot = _pyfloat_sql("floor"), _pyfloat_sql("total_floors")
    both = f"{_given_sql('floor')} and {_given_sql('total_floors')} and {fl} is not null and {tot} is not null"
    parts.append(f"case when {both} and {fl} > {tot} then '{P.MSG_FLOOR_ABOVE_TOTAL}' end")
    parts.append(f"case when {both} and {tot} = 0 and {fl} > 0 then '{P.MSG_TOTAL_ZERO}' end")
    return "concat_ws('; ', " + ", ".join(parts) + ")"


def _label_sql(x: str) -> str:
    return f"case when {x} = floor({x}) then cast(cast(floor({x}) as bigint) as varchar) else cast({x} as varchar) end"


def _floor_label_sql(f: str, t: str) -> str:
    head = f"case when {f} < 0 then 'Suteren' when {f} = 0 then 'Prizemlje' else {_label_sql(f)} end"
    return f"case when {f} is null then 'Nepoznato' when {t} is null then {head} else {head} || ' / ' || {_label_sql(t)} end"


def _opt_sql(c: str) -> str:
    return f"case when {_given_sql(c)} then {_pyfloat_sql(c)} end"


def _text_sql(c: str, missing: str) -> str:
    return f"case when {c} is null then '{missing}' when {_strip_sql(c)} = '' then 'Nepoznato' else {_strip_sql(c)} end"


_KEEP = "input_id, " + ", ".join(S.RAW_COLUMNS) + ", _req_is_lux, _req_is_penthouse, _req_is_duplex"

SCORE_SQL = f""",
{testview.score_inputs_sql()},
checked as (select *, {_errors_sql()} as errors from score_input),
valid as (select * from checked where errors = ''),
score_listing as (select input_id,
   '{P.PREDICTION_TITLE}' as title,
   case when concat_ws(' ', case when is_lux then 'lux' end, case when is_penthouse then 'penthouse' end,
                       case when is_duplex then 'duplex' end) = '' then '{P.PREDICTION_DESCRIPTION}'
        else concat_ws(' ', case when is_lux then 'lux' end, case when is_penthouse then 'penthouse' end,
                       case when is_duplex then 'duplex' end) end as description,
   {_pyfloat_sql('area_m2')} as area_m2, null::double as price_eur,
   {_text_sql('city', 'Nepoznato')} as city, {_text_sql('region', 'Nepoznato')} as region,
   {_text_sql('street', 'None')} as street, {_text_sql('heating_type', 'Nepoznato')} as heating_type,
   {_opt_sql('rooms')} as rooms, {_text_sql('parking', 'Nepoznato')} as parking,
   {_floor_label_sql(_opt_sql('floor'), _opt_sql('total_floors'))} as raw_floor_string,
   {_opt_sql('year_built')} as year_built, '' as url,
   coalesce(is_lux, false)::int as _req_is_lux, coalesce(is_penthouse, false)::int as _req_is_penthouse,
   coalesce(is_duplex, false)::int as _req_is_duplex
 from valid),
{feature_ctes("score_listing", "score_model", _KEEP, "s_")}
"""


@register("p1_validate_inputs", q(SCORE_SQL + "select input_id, errors, errors = '' as is_valid from checked"))
def p1(spark, sf):
    v = P.validate_requests(testview.score_inputs(spark, sf))
    return v.select("input_id", "errors", "is_valid")


@register(
    "p2_floor_label",
    q(SCORE_SQL + f"select floor, total_floors, {_floor_label_sql(_opt_sql('floor'), _opt_sql('total_floors'))} as raw_floor_string from valid"),
)
def p2(spark, sf):
    v = P.validate_requests(testview.score_inputs(spark, sf)).filter("is_valid")
    lbl = floor_label(P._optional_float("floor"), P._optional_float("total_floors"))
    return v.select("floor", "total_floors", lbl.alias("raw_floor_string"))


_P3_OUT = ["input_id"] + S.model_feature_columns()


@register(
    "p3_prediction_frame",
    q(
        SCORE_SQL
        + "select input_id, "
        + ", ".join(
            f"_req_{c} as {c}" if c in S.TEXT_FLAG_COLUMNS else c for c in S.model_feature_columns()
        )
        + " from score_model"
    ),
)
def p3(spark, sf):
    v = P.validate_requests(testview.score_inputs(spark, sf)).filter("is_valid")
    return P.prediction_frame(v).select(*_P3_OUT)


def _linear_area(spark, sf, split=None):
    split = _split(spark, sf) if split is None else split
    train = split.filter(~F.col("is_test"))
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=["area_m2"], outputCol="features"),
            LinearRegression(labelCol=S.TARGET, regParam=0.0, solver="normal", standardization=False),
        ]
    ).fit(train)


_OLS_SQL = _PRED_SQL + _METRICS_SQL + SCORE_SQL.replace(",\n", ",\n", 1)


@register(
    "p4_predict_price",
    q(_OLS_SQL + f", scored as (select input_id, greatest(0.0, a + b * area_m2) as p from score_model, ols) "
      f"select input_id, {_re('p', 2)} as predicted_price_eur from scored"),
)
def p4(spark, sf):
    out, _ = P.score(testview.score_inputs(spark, sf), _linear_area(spark, sf))
    return out.select("input_id", _rs("predicted_price_eur", 2))


@register(
    "p5_price_range",
    q(
        _OLS_SQL
        + ", scored as (select input_id, greatest(0.0, a + b * area_m2) as p from score_model, ols), "
        "m as (select mae from metrics where model = 'linear_area') "
        f"select input_id, {_re('greatest(0.0, p - mae)', 2)} as price_low, {_re('p + mae', 2)} as price_high from scored, m"
    ),
)
def p5(spark, sf):
    split, fitted = _fit_two_models(spark, sf)  # one fit serves the metrics and the scoring
    metrics = M.regression_metrics(_two_model_predictions(spark, sf, split, fitted))
    out, _ = P.score(testview.score_inputs(spark, sf), fitted["linear_area"], metrics, "linear_area")
    return out.select(
        "input_id",
        E.round_even(F.col("price_range.low"), 2).alias("price_low"),
        E.round_even(F.col("price_range.high"), 2).alias("price_high"),
    )


@register(
    "p6_model_lookup",
    q(
        _PRED_SQL
        + _METRICS_SQL
        + ", mranked as (select model, mae, (row_number() over (order by mae, model))::int as rank_by_mae from metrics), "
        "registry as (select 'linear_area' as model, 1 as registry_order union all select 'dummy_median', 2 "
        "union all select 'saved_best', 3) "
        f"select r.model, {_re('mae', 2)} as mae, rank_by_mae, "
        "(row_number() over (order by rank_by_mae asc nulls last, registry_order))::int as position "
        "from registry r left join mranked k on r.model = k.model"
    ),
)
def p6(spark, sf):
    metrics = M.rank_models(M.regression_metrics(_two_model_predictions(spark, sf)))
    registry = spark.createDataFrame(
        [("linear_area", 1), ("dummy_median", 2), ("saved_best", 3)], "model string, registry_order int"
    )
    out = P.model_lookup(registry, metrics)
    return out.select("model", _rs("mae", 2), "rank_by_mae", "position")


@register(
    "p7_options_fallback",
    q(
        SCORE_SQL
        + """, rbc as (select distinct city, region from model where city is not null and region is not null),
cities as (select distinct city from score_input),
opts as (select c.city, r.region from cities c join rbc r on c.city = r.city
         union all
         select c.city, 'Nepoznato' from cities c where not exists (select 1 from rbc r where r.city = c.city))
select city, (row_number() over (partition by city order by region) - 1)::int as pos, region from opts"""
    ),
)
def p7(spark, sf):
    rbc = E.regions_by_city(frames.model(spark, sf, frames.OPTION_COLUMNS))
    return P.region_options(testview.score_inputs(spark, sf), rbc)


@register(
    "p7_options_all_regions",
    q(
        SCORE_SQL
        + """, every as (select region, (row_number() over (order by region) - 1)::int as pos
          from (select distinct region from model where region is not null))
select city, pos, region from (select distinct city from score_input where city is not null), every"""
    ),
)
def p7_all(spark, sf):
    """No map of regions by city: every region is a choice."""
    model = frames.model(spark, sf, frames.OPTION_COLUMNS)
    none = E.regions_by_city(model.select("city", "region").limit(0))
    return P.region_options(testview.score_inputs(spark, sf).filter("city IS NOT NULL"), none, model.select("region"))
