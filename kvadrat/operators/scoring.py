"""Batch / stream scoring of property requests.

A request row carries strings as a form sends them. ``validate_requests`` collects every
problem of a row into ``errors`` (all rules, not the first), ``prediction_frame`` rebuilds
the listing row the model was trained on (same F12 code: no train/serve skew), and
``score`` predicts, clamps at zero and attaches an MAE-wide price range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kvadrat import schema as S
from kvadrat.session import checkpointed
from kvadrat.functions.floors import floor_label
from kvadrat.functions.text import let, strip
from kvadrat.operators.features import add_model_features

# fixed values: validation messages
MSG_REQUIRED = "{field} je obavezno polje"
MSG_RANGE = "{field} mora biti između {lo} i {hi}"
MSG_RANGE_NUMBER = "{field} mora biti broj između {lo} i {hi}"
MSG_NUMBER = "{field} mora biti broj"
MSG_FLOOR_ABOVE_TOTAL = "floor ne može biti veći od total_floors"
MSG_TOTAL_ZERO = "total_floors mora biti veći od nule za stan iznad prizemlja"
REQUIRED_FIELDS = ["city", "region", "heating_type", "parking"]
PREDICTION_TITLE = "Procena nekretnine"
PREDICTION_DESCRIPTION = "Korisnički unos za procenu cene"
FLAG_WORDS = [("is_lux", "lux"), ("is_penthouse", "penthouse"), ("is_duplex", "duplex")]

# what Python's float() accepts (besides nan/inf spellings)
_FLOAT_TEXT = r"(?U)^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_SPECIAL_TEXT = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"
# most of what forms send: a part of _FLOAT_TEXT that costs a fraction of it
_PLAIN_NUMBER = r"^[0-9]+(?:\.[0-9]+)?$"


def _fmt(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else str(x)


def py_float(c: Column | str) -> Column:
    """Number a form field parses to, or null when it does not parse."""
    x = F.col(c) if isinstance(c, str) else c
    ok = x.rlike(_PLAIN_NUMBER) | x.rlike(_FLOAT_TEXT) | x.rlike(_SPECIAL_TEXT)
    return F.when(ok, F.trim(x).try_cast("double"))


def _given(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


def _blank(c: str) -> Column:
    """White space only: as ``strip(c) == ""``, but a text is read up to its first other character."""
    return ~F.col(c).rlike(r"(?U)\S")


_NUMBERS = ["area_m2", "rooms", "year_built", "floor", "total_floors"]


def validation_errors() -> Column:
    """Array of every problem with the request (empty when it is valid). The rules use each number
    many times; it is parsed once."""
    return let(F.struct(*[py_float(f).alias(f) for f in _NUMBERS]), _problems)


def _problems(numbers: Column) -> Column:
    checks: list[Column] = []
    for f in REQUIRED_FIELDS:
        checks.append(F.when(F.col(f).isNull() | _blank(f), F.lit(MSG_REQUIRED.format(field=f))))
    area = numbers["area_m2"]
    lo, hi = S.AREA_RANGE
    checks.append(
        F.when(area.isNull(), F.lit(MSG_RANGE_NUMBER.format(field="area_m2", lo=_fmt(lo), hi=_fmt(hi)))).when(
            ~area.between(lo, hi), F.lit(MSG_RANGE.format(field="area_m2", lo=_fmt(lo), hi=_fmt(hi)))
        )
    )
    for f, (lo, hi), bad_number in [
        ("rooms", S.ROOMS_RANGE, MSG_RANGE_NUMBER),
        ("year_built", S.YEAR_RANGE, MSG_RANGE_NUMBER),
        ("floor", S.FLOOR_RANGE, MSG_NUMBER),
        ("total_floors", S.TOTAL_FLOORS_RANGE, MSG_NUMBER),
    ]:
        v = numbers[f]
        checks.append(
            F.when(_given(f) & v.isNull(), F.lit(bad_number.format(field=f, lo=_fmt(lo), hi=_fmt(hi)))).when(
                _given(f) & ~v.between(lo, hi), F.lit(MSG_RANGE.format(field=f, lo=_fmt(lo), hi=_fmt(hi)))
            )
        )
    fl, tot = numbers["floor"], numbers["total_floors"]
    both = _given("floor") & _given("total_floors") & fl.isNotNull() & tot.isNotNull()
    checks.append(F.when(both & (fl > tot), F.lit(MSG_FLOOR_ABOVE_TOTAL)))
    checks.append(F.when(both & (tot == 0) & (fl > 0), F.lit(MSG_TOTAL_ZERO)))
    return F.array_compact(F.array(*checks))


def validate_requests(df: DataFrame) -> DataFrame:
    """Add ``errors`` ('; '-joined, '' when valid) and ``is_valid``."""
    errs = validation_errors()
    return df.withColumn("_errs", errs).withColumns(
        {"errors": F.array_join("_errs", "; "), "is_valid": F.size("_errs") == 0}
    ).drop("_errs")


def raise_on_invalid(df: DataFrame) -> DataFrame:
    """Strict mode: the job fails on the first invalid request, naming its problems."""
    v = validate_requests(df)
    # a filter (not a dropped column, which the optimizer would prune) carries the check
    fail = F.when(~F.col("is_valid"), F.raise_error(F.concat(F.lit("Invalid property input: "), F.col("errors"))))
    return v.filter(fail.isNull())


def _text_or_unknown(c: str, missing_as: str) -> Column:
    return F.when(F.col(c).isNull(), F.lit(missing_as)).otherwise(
        F.when(_blank(c), F.lit(S.UNKNOWN)).otherwise(strip(c))
    )


def _optional_float(c: str) -> Column:
    return F.when(_given(c), py_float(c))


def prediction_frame(requests: DataFrame, current_year: int = S.CURRENT_YEAR, keep: list[str] | None = None) -> DataFrame:
    """Listing-shaped rows for valid requests, F12 features, flags from the request.

    A present-but-missing street becomes the text 'None', as the form code did; a missing
    street is not a model input."""
    keep = keep or ["input_id"]
    words = [F.when(F.coalesce(F.col(flag), F.lit(False)), F.lit(w)) for flag, w in FLAG_WORDS]
    description = F.concat_ws(" ", *words)
    listing = requests.select(
        *keep,
        F.lit(PREDICTION_TITLE).alias("title"),
        F.when(description == "", F.lit(PREDICTION_DESCRIPTION)).otherwise(description).alias("description"),
        py_float("area_m2").alias("area_m2"),
        F.lit(None).cast("double").alias("price_eur"),
        _text_or_unknown("city", S.UNKNOWN).alias("city"),
        _text_or_unknown("region", S.UNKNOWN).alias("region"),
        _text_or_unknown("street", "None").alias("street"),
        _text_or_unknown("heating_type", S.UNKNOWN).alias("heating_type"),
        _optional_float("rooms").alias("rooms"),
        _text_or_unknown("parking", S.UNKNOWN).alias("parking"),
        floor_label(_optional_float("floor"), _optional_float("total_floors")).alias("raw_floor_string"),
        _optional_float("year_built").alias("year_built"),
        F.lit("").alias("url"),
        *[F.coalesce(F.col(flag), F.lit(False)).cast("int").alias(f"_req_{flag}") for flag, _ in FLAG_WORDS],
    )
    feats = add_model_features(listing, current_year)
    return feats.withColumns({flag: F.col(f"_req_{flag}") for flag, _ in FLAG_WORDS}).drop(
        *[f"_req_{flag}" for flag, _ in FLAG_WORDS]
    )


def clamp_prediction(c: Column | str = "prediction") -> Column:
    """Non-negative price; NaN counts as 0 (``greatest`` alone would keep NaN)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.greatest(F.lit(0.0), F.nanvl(x.cast("double"), F.lit(0.0)))


def price_range(pred: Column | str, mae: Column | str) -> Column:
    """P5: struct(low, high) = (max(0, p - mae), p + mae), null when MAE is unknown."""
    p = F.col(pred) if isinstance(pred, str) else pred
    m = F.col(mae) if isinstance(mae, str) else mae
    return F.when(
        m.isNotNull() & ~F.isnan(m),
        F.struct(F.greatest(F.lit(0.0), p - m).alias("low"), (p + m).alias("high")),
    )


def score(
    requests: DataFrame,
    pipeline_model,
    metrics: DataFrame | None = None,
    model_name: str | None = None,
    current_year: int = S.CURRENT_YEAR,
) -> tuple[DataFrame, DataFrame]:
    """(scored valid requests, rejected requests with their errors).

    ``metrics`` has one row per trained model, so the MAE lookup joins a frame bounded by
    the number of candidates and is broadcast."""
    checked = validate_requests(requests)
    valid = checked.filter("is_valid").drop("errors", "is_valid")
    rejected = checked.filter(~F.col("is_valid"))
    frame = prediction_frame(valid, current_year)
    scored = pipeline_model.transform(frame).withColumn("predicted_price_eur", clamp_prediction("prediction"))
    out = scored.select("input_id", "predicted_price_eur")
    if metrics is not None and model_name is not None:
        mae = metrics.filter(F.col("model") == model_name).select(F.col("mae").alias("_mae"))
        out = out.crossJoin(F.broadcast(mae.limit(1)))
        out = out.withColumn("price_range", price_range("predicted_price_eur", "_mae")).drop("_mae")
    return out, rejected


def model_lookup(registry: DataFrame, metrics: DataFrame) -> DataFrame:
    """Registry names ordered by MAE rank, unranked names after them in registry order;
    each with its MAE (null when unranked). Both frames hold one row per model."""
    j = registry.join(F.broadcast(metrics.select("model", "mae", "rank_by_mae")), "model", "left")
    w = Window.orderBy(F.col("rank_by_mae").asc_nulls_last(), F.col("registry_order").asc())
    return j.withColumn("position", F.row_number().over(w)).select("model", "mae", "rank_by_mae", "position")


def region_options(requests: DataFrame, regions_by_city: DataFrame, all_regions: DataFrame | None = None) -> DataFrame:
    """Region choices per requested city: that city's regions; else 'Nepoznato' when a
    per-city map exists; else every region; else 'Nepoznato'. Long form (city, pos, region), from a map
    in long form; no list of regions is collected. The map and the regions are read several times: their
    distinct rows are written once, so the listings behind them are cleaned once."""
    regions_by_city = checkpointed(regions_by_city)
    cities = requests.select("city").distinct()
    mapped = cities.join(regions_by_city, "city")
    rest = cities.join(regions_by_city.select("city").distinct(), "city", "left_anti")
    unknown = rest.select("city", F.lit(0).alias("pos"), F.lit(S.UNKNOWN).alias("region"))
    if not regions_by_city.isEmpty() or all_regions is None:
        return mapped.unionByName(unknown)
    every = checkpointed(all_regions.where("region IS NOT NULL").select("region").distinct())
    if every.isEmpty():
        return unknown
    # every region for every city is the result asked for, one row per choice
    return rest.crossJoin(_numbered(every)).select("city", "pos", "region")


def _numbered(regions: DataFrame) -> DataFrame:
    """pos (from 0, by name) of distinct regions."""
    from kvadrat.operators import stats as E

    ranges, totals = E.value_ranges(regions, "region", [])
    return E.ranked(ranges.join(totals, "_p"), "region", []).select(F.col("_first").cast("int").alias("pos"), "region")
