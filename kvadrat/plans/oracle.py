"""DuckDB SQL mirrors of the listings stages, used as the correctness oracle.

Each query in the registry is checked against one of these statements. They restate the
operator semantics in plain SQL over the same parquet tables (the driver registers them
as views), independently of the Spark code path.
"""

from __future__ import annotations

from kvadrat import schema as S
from kvadrat.plans import testview

RAW = ", ".join(S.RAW_COLUMNS)
KEY = ", ".join(S.COMPOSITE_KEY)
COMPLETE = " and ".join(f"{k} is not null" for k in S.COMPOSITE_KEY)
FIRST = ", ".join(f"{c} asc nulls first" for c in testview.FIRST_ORDER)
RULE_AREA = "coalesce(area_m2 between 10 and 500, false)"
RULE_PRICE = "coalesce(price_eur between 10000 and 1000000, false)"
RULE_ROOMS = "coalesce(rooms is null or rooms between 0.5 and 10, false)"
RULE_YEAR = "coalesce(year_built is null or year_built between 1800 and 2028, false)"
QUALITY = f"({RULE_AREA} and {RULE_PRICE} and {RULE_ROOMS} and {RULE_YEAR})"
NUM = r"(-?\d+(?:[.,]\d+)?)"


def _norm(c: str) -> str:
    return f"case when {c} is null or {c} in ('-', '') then 'Nepoznato' else {c} end as {c}"


def _flag(words: list[str]) -> str:
    return f"coalesce(regexp_matches(_text, '\\b(?:{'|'.join(words)})\\b'), false)::int"


def feature_ctes(src: str, out: str = "model", keep: str = RAW, p: str = "") -> str:
    """CTEs turning ``src`` (raw listing columns) into ``out`` with the F1-F12 columns."""
    norm_cols = ", ".join(
        _norm(c) if c in S.CATEGORICAL_COLUMNS_TO_NORMALIZE else c for c in keep.split(", ")
    )
    pair = NUM + r"\s*/\s*" + NUM
    return f"""{p}norm as (select {norm_cols},
                lower(regexp_replace(raw_floor_string, '^\\s+|\\s+$', '', 'g')) as _raw,
                lower(coalesce(title, '') || ' ' || coalesce(description, '')) as _text
         from {src}),
{p}parsed as (select *,
  try_cast(replace(nullif(regexp_extract(_raw, '/\\s*{NUM}', 1), ''), ',', '.') as double) as _total,
  case when _raw is null or _raw in ('', 'nepoznato', '-') then null
       when contains(_raw, 'suteren') then -1.0
       when contains(_raw, 'prizemlje') then 0.0
       when regexp_matches(_raw, '{pair}') then try_cast(replace(regexp_extract(_raw, '{pair}', 1), ',', '.') as double)
       when regexp_full_match(_raw, '{NUM}') then try_cast(replace(_raw, ',', '.') as double)
  end as floor,
  case when _raw is null or _raw in ('', 'nepoznato', '-') then null
       when contains(_raw, 'suteren') or contains(_raw, 'prizemlje') then
            try_cast(replace(nullif(regexp_extract(_raw, '/\\s*{NUM}', 1), ''), ',', '.') as double)
       when regexp_matches(_raw, '{pair}') then try_cast(replace(regexp_extract(_raw, '{pair}', 2), ',', '.') as double)
  end as total_floors
  from {p}norm),
{out} as (select {keep},
  case when area_m2 <> 0 then round_even(price_eur / area_m2 * 100, 0) / 100 end as price_per_m2,
  floor, total_floors,
  case when floor is null or total_floors is null then null when floor = total_floors then 1.0::double else 0.0::double end as is_last_floor,
  2026.0 - year_built as building_age,
  city || ' | ' || region as city_region,
  {_flag(S.LUX_WORDS)} as is_lux,
  {_flag(S.PENTHOUSE_WORDS)} as is_penthouse,
  {_flag(S.DUPLEX_WORDS)} as is_duplex
  from {p}parsed)"""


def stages() -> str:
    """CTEs: listings, raw, ranked, deduped, cleaned, norm, parsed, model."""
    return f"""with {testview.listings_sql()},
raw as (select {RAW} from listings),
ranked as (select {RAW}, row_number() over (partition by {KEY} order by {FIRST}) as _rn
           from raw where {COMPLETE}),
deduped as (select {RAW}, true as _complete, {", ".join(f"{c} as _o_{c}" for c in testview.FIRST_ORDER)}
            from ranked where _rn = 1
            union all
            select {RAW}, false as _complete, {", ".join(f"{c} as _o_{c}" for c in testview.FIRST_ORDER)}
            from raw where not ({COMPLETE})),
cleaned as (select {RAW} from deduped where {QUALITY}),
{feature_ctes("cleaned")}
"""


def qc(x: str, q: float | str) -> str:
    """Exact quantile with numpy's linear interpolation (DuckDB's ``quantile_cont``
    interpolates with a different float formula and can differ in the last bit)."""
    lst = f"list_sort(list({x}) filter (where {x} is not null))"
    pos = f"(({q}) * (len({lst}) - 1))"
    a = f"{lst}[floor({pos})::bigint + 1]"
    b = f"{lst}[ceil({pos})::bigint + 1]"
    t = f"({pos} - floor({pos}))"
    return f"(case when {t} < 0.5 then {a} + ({b} - {a}) * {t} else {b} - ({b} - {a}) * (1 - {t}) end)"


def q(body: str) -> str:
    return stages() + body
