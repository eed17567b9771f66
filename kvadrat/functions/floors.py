"""Floor grammar (F3, F4) and the inverse label used when scoring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kvadrat import schema as S
from kvadrat.functions.text import _col, let, strip

_NUM = r"(-?\d+(?:[.,]\d+)?)"


def _to_double(text: Column) -> Column:
    return (F.replace(F.when(text != "", text), F.lit(","), F.lit("."))).try_cast("double")


def total_floors_text(c: Column | str) -> Column:
    """first number after a '/', decimal comma allowed; null when there is none."""
    return _to_double(F.regexp_extract(_col(c), r"(?U)/\s*" + _NUM, 1))


def parse_floor(c: Column | str) -> Column:
    """struct(floor, total_floors) from strings like '3/5', 'Suteren / 4', '2,5 / 6', '7'.

    Evaluated on the stripped lower-case text, first rule wins: blank / 'nepoznato' / '-'
    give nulls; 'suteren' gives -1 and 'prizemlje' 0 (both keep the total after '/');
    'a / b' anywhere gives (a, b); a lone number n gives (n, null); anything else nulls.
    """
    return let(F.lower(strip(_col(c))), _parse_lowered)


def _parse_lowered(raw: Column) -> Column:
    total = total_floors_text(raw)
    pair = r"(?U)" + _NUM + r"\s*/\s*" + _NUM
    has_pair = raw.rlike(pair)
    lone = raw.rlike(r"(?U)^" + _NUM + "$")
    null = F.lit(None).cast("double")
    unknown = raw.isNull() | raw.isin("", S.UNKNOWN.lower(), "-")
    floor = (
        F.when(unknown, null)
        .when(raw.contains("suteren"), F.lit(-1.0))
        .when(raw.contains("prizemlje"), F.lit(0.0))
        .when(has_pair, _to_double(F.regexp_extract(raw, pair, 1)))
        .when(lone, _to_double(raw))
    )
    total_out = (
        F.when(unknown, null)
        .when(raw.contains("suteren") | raw.contains("prizemlje"), total)
        .when(has_pair, _to_double(F.regexp_extract(raw, pair, 2)))
    )
    return F.struct(floor.alias("floor"), total_out.alias("total_floors"))


def _number_label(x: Column) -> Column:
    """Whole numbers without '.0'; others as their shortest double text."""
    return F.when(x == F.floor(x), F.floor(x).cast("bigint").cast("string")).otherwise(x.cast("string"))


def floor_label(floor: Column | str, total: Column | str) -> Column:
    """Raw floor text for a (floor, total) pair: 'Suteren / 4', 'Prizemlje / 3', '2.5 / 6'."""
    f, t = _col(floor), _col(total)
    label = (
        F.when(f < 0, F.lit("Suteren")).when(f == 0, F.lit("Prizemlje")).otherwise(_number_label(f))
    )
    with_total = F.when(t.isNull(), label).otherwise(F.concat(label, F.lit(" / "), _number_label(t)))
    return F.when(f.isNull(), F.lit(S.UNKNOWN)).otherwise(with_total)
