"""Per-row model features as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kvadrat import schema as S
from kvadrat.functions.text import _col, word_flag


def normalize_category(c: Column | str) -> Column:
    """exact '-' or '' or null becomes 'Nepoznato' (no trimming)."""
    x = _col(c)
    return F.when(x.isNull() | x.isin(*S.PLACEHOLDERS), F.lit(S.UNKNOWN)).otherwise(x)


def price_per_m2(price: Column | str = "price_eur", area: Column | str = "area_m2") -> Column:
    """price / area rounded to cents half-to-even; null when area is null or 0."""
    p, a = _col(price), _col(area)
    return F.when(a != 0, F.rint(F.try_divide(p, a) * 100) / 100)


def is_last_floor(floor: Column | str = "floor", total: Column | str = "total_floors") -> Column:
    """1.0 when floor equals total, 0.0 otherwise, null when either is unknown."""
    return (_col(floor) == _col(total)).cast("double")


def building_age(year_built: Column | str = "year_built", current_year: int = S.CURRENT_YEAR) -> Column:
    """years since construction (negative for planned buildings)."""
    return F.lit(float(current_year)) - _col(year_built)


def city_region(city: Column | str = "city", region: Column | str = "region") -> Column:
    """'city | region'."""
    return F.concat_ws(" | ", _col(city), _col(region))


def listing_text(title: Column | str = "title", description: Column | str = "description") -> Column:
    return F.lower(F.concat(F.coalesce(_col(title), F.lit("")), F.lit(" "), F.coalesce(_col(description), F.lit(""))))


def is_lux(text: Column) -> Column:
    """F8."""
    return word_flag(text, S.LUX_WORDS)


def is_penthouse(text: Column) -> Column:
    """F9."""
    return word_flag(text, S.PENTHOUSE_WORDS)


def is_duplex(text: Column) -> Column:
    """F10."""
    return word_flag(text, S.DUPLEX_WORDS)
