"""Text column functions (JVM-side expressions, no UDFs).

Java regexes treat ``\\s``/``\\d``/``\\b`` as ASCII unless ``(?U)`` is set; every pattern
here that must behave like Unicode-aware text handling carries that flag.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kvadrat import schema as S


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and refer to it several times inside ``body``.

    Expressions that use their input many times (the number and URL grammars) would
    otherwise copy the whole input expression into every branch."""
    return F.get(F.transform(F.array(value), body), 0)


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` only removes spaces)."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def clean_text(c: Column | str) -> Column:
    """Whitespace runs become one space, ends stripped; null becomes ''."""
    collapsed = F.regexp_replace(_col(c), r"(?U)\s+", " ")
    return F.coalesce(strip(collapsed), F.lit(""))


def normalize_key(c: Column | str) -> Column:
    """Clean, map Cyrillic look-alike letters to Latin, lower-case."""
    return F.lower(F.translate(clean_text(c), S.CYRILLIC_FROM, S.CYRILLIC_TO))


def blank_to_null(c: Column | str) -> Column:
    return F.when(_col(c) != "", _col(c))


def first_present(*cols: Column | str) -> Column:
    """First value that is neither null nor ''; '' when none is."""
    return F.coalesce(*[blank_to_null(c) for c in cols], F.lit(""))


def capitalize(c: Column | str) -> Column:
    """Upper-case the first character and lower-case the rest (``initcap`` works per word)."""
    x = _col(c)
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 30)))


def word_flag(text: Column, words: list[str]) -> Column:
    """1 when any of ``words`` appears as a whole word in ``text``, else 0."""
    pattern = r"(?U)\b(?:" + "|".join(words) + r")\b"
    return F.coalesce(text.rlike(pattern), F.lit(False)).cast("int")
