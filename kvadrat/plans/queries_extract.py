"""Registry entries for page extraction and frontier planning (X), over ``pages`` and
number texts derived from ``lineitem`` prices."""

from __future__ import annotations

from pyspark.sql import functions as F

from kvadrat.functions import numbers as N
from kvadrat.functions import text as TX
from kvadrat.functions import urls as U
from kvadrat.operators import extraction as X
from kvadrat.plans import frames
from kvadrat.plans.oracle import q
from kvadrat.plans.registry import register
from kvadrat.plans.testview import read_table

_WS = r"'^\s+|\s+$'"


def _clean_sql(c: str) -> str:
    return f"coalesce(regexp_replace(regexp_replace({c}, '\\s+', ' ', 'g'), {_WS}, '', 'g'), '')"


# page title text: raw inner text of <title>
_TITLE_RE = r"(?s)<title>(.*?)</title>"


def _titles(spark, sf):
    pages = read_table(spark, sf, "pages")
    return pages.select("page_id", F.regexp_extract("html", _TITLE_RE, 1).alias("raw_title"))


@register(
    "x3_clean_text",
    f"select page_id, {_clean_sql('t')} as title from (select page_id, regexp_extract(html, '<title>(.*?)</title>', 1) as t from pages)",
)
def x3(spark, sf):
    return _titles(spark, sf).select("page_id", TX.clean_text("raw_title").alias("title"))


@register(
    "x4_normalize_key",
    f"select page_id, lower(translate({_clean_sql('t')}, 'аејкмопстхАЕЈКМОПСТХ', 'aejkmopsthaejkmopsth')) as key "
    "from (select page_id, regexp_extract(html, '<title>(.*?)</title>', 1) as t from pages)",
)
def x4(spark, sf):
    return _titles(spark, sf).select("page_id", TX.normalize_key("raw_title").alias("key"))


# number texts written with both separator conventions, derived from lineitem prices
_NUMBER_TEXTS_SQL = """
with nt as (
  select l_orderkey, l_linenumber, cast(l_extendedprice as varchar) as t1,
         replace(cast(l_extendedprice as varchar), '.', ',') as t2,
         replace(format('{:,}', floor(l_extendedprice)::bigint), ',', '.') as t3,
         replace(format('{:,}', floor(l_extendedprice)::bigint), ',', '.') || ',' || split_part(cast(l_extendedprice as varchar), '.', 2) as t4,
         format('{:,}', floor(l_extendedprice)::bigint) || '.' || split_part(cast(l_extendedprice as varchar), '.', 2) as t5,
         cast(l_quantity as varchar) || ' m²' as t6
  from lineitem),
texts as (
  select l_orderkey, l_linenumber, 1 as variant, t1 as txt from nt
  union all select l_orderkey, l_linenumber, 2, t2 from nt
  union all select l_orderkey, l_linenumber, 3, t3 from nt
  union all select l_orderkey, l_linenumber, 4, t4 from nt
  union all select l_orderkey, l_linenumber, 5, t5 from nt
  union all select l_orderkey, l_linenumber, 6, t6 from nt)
"""


def _number_texts(spark, sf):
    li = read_table(spark, sf, "lineitem")
    t1 = F.col("l_extendedprice").cast("string")
    grouped = F.format_number(F.floor("l_extendedprice"), 0)
    dec = F.split_part(t1, F.lit("."), F.lit(2))
    variants = [
        t1,
        F.replace(t1, F.lit("."), F.lit(",")),
        F.replace(grouped, F.lit(","), F.lit(".")),
        F.concat(F.replace(grouped, F.lit(","), F.lit(".")), F.lit(","), dec),
        F.concat(grouped, F.lit("."), dec),
        F.concat(F.col("l_quantity").cast("string"), F.lit(" m²")),
    ]
    arr = F.array(*[F.struct(F.lit(i + 1).alias("variant"), v.alias("txt")) for i, v in enumerate(variants)])
    return li.select("l_orderkey", "l_linenumber", F.explode(arr).alias("t")).select("l_orderkey", "l_linenumber", "t.*")


def _norm_number_sql(x: str) -> str:
    v = f"regexp_replace({x}, '\\s+', '', 'g')"
    dots = f"(length({v}) - length(replace({v}, '.', '')))"
    commas = f"(length({v}) - length(replace({v}, ',', '')))"

    def many(ch):
        parts = f"string_split({v}, '{ch}')"
        return (
            f"case when len(list_filter(list_slice({parts}, 2, len({parts})), lambda p: length(p) <> 3)) = 0 "
            f"then replace({v}, '{ch}', '') "
            f"else array_to_string(list_slice({parts}, 1, len({parts}) - 1), '') || '.' || {parts}[len({parts})] end"
        )

    def single(ch, keep):
        left, right = f"split_part({v}, '{ch}', 1)", f"split_part({v}, '{ch}', 2)"
        dec = v if keep else f"{left} || '.' || {right}"
        return f"case when length({right}) = 3 and length(ltrim({left}, '-')) <= 3 then {left} || {right} else {dec} end"

    both = (
        f"case when regexp_matches({v}, '\\.[^,]*$') then replace({v}, ',', '') "
        f"else replace(replace({v}, '.', ''), ',', '.') end"
    )
    return (
        f"case when {v} is null then null when {v} = '' then '' "
        f"when {dots} > 0 and {commas} > 0 then {both} "
        f"when {dots} > 1 then {many('.')} when {commas} > 1 then {many(',')} "
        f"when {dots} = 1 then {single('.', True)} when {commas} = 1 then {single(',', False)} else {v} end"
    )


def _safe_float_sql(x: str) -> str:
    tok = f"nullif(regexp_extract({_clean_sql(x)}, '-?\\d[\\d.,\\s]*', 0), '')"
    return f"try_cast(nullif({_norm_number_sql(tok)}, '') as double)"


@register(
    "x5_normalize_number",
    _NUMBER_TEXTS_SQL + f"select l_orderkey, l_linenumber, variant, txt, {_norm_number_sql('txt')} as normalized from texts",
)
def x5(spark, sf):
    t = _number_texts(spark, sf)
    return t.select("l_orderkey", "l_linenumber", "variant", "txt", N.normalize_number("txt").alias("normalized"))


@register(
    "x6_safe_float",
    _NUMBER_TEXTS_SQL + f"select l_orderkey, l_linenumber, variant, {_safe_float_sql('txt')} as value from texts",
)
def x6(spark, sf):
    t = _number_texts(spark, sf)
    return t.select("l_orderkey", "l_linenumber", "variant", N.safe_float("txt").alias("value"))


def _price_sql(x: str) -> str:
    raw = f"nullif(regexp_extract({_clean_sql(x)}, '(?i)([\\d.\\s]+)\\s*(?:EUR|€)', 1), '')"
    return _safe_float_sql(f"replace(replace({raw}, '.', ''), ' ', '')")


@register(
    "x7_parse_price_text",
    _NUMBER_TEXTS_SQL
    + f"select l_orderkey, l_linenumber, variant, {_price_sql(chr(39) + 'Cena: ' + chr(39) + ' || txt || ' + chr(39) + ' EUR' + chr(39))} as price from texts",
)
def x7(spark, sf):
    t = _number_texts(spark, sf)
    return t.select(
        "l_orderkey", "l_linenumber", "variant", N.parse_price_text(F.concat(F.lit("Cena: "), "txt", F.lit(" EUR"))).alias("price")
    )


_URI = U.URI.replace("'", "''")


def _part_sql(u: str, g: int) -> str:
    return f"regexp_extract({u}, '{_URI}', {g})"


@register(
    "x9_comparable_url",
    "select page_id, 'https://' || case when "
    + _part_sql("trim(url)", 4)
    + " = '' then 'www.nekretnine.rs' else "
    + _part_sql("trim(url)", 4)
    + " end || regexp_replace("
    + _part_sql("trim(url)", 5)
    + ", '/+$', '') || '/' as comparable from pages",
)
def x9(spark, sf):
    pages = read_table(spark, sf, "pages")
    return pages.select("page_id", U.comparable_url("url").alias("comparable"))


# relaxed listing-path rule for arbitrary pages: a language folder and a numeric id
PAGE_PATH_PATTERN = r"^/[a-z]{2}/[0-9]+(\.html)?/?$"


def _canon_sql(u: str, base: str, pattern: str) -> str:
    scheme, host, path = _part_sql(u, 2), _part_sql(u, 4), _part_sql(u, 5)
    rhost = f"case when {host} <> '' then {host} when {scheme} = '' then {base} else '' end"
    rpath = f"case when {scheme} = '' and {host} = '' and not starts_with({path}, '/') then '/' || {path} else {path} end"
    fpath = f"case when ends_with({rpath}, '/') then {rpath} else {rpath} || '/' end"
    return (
        f"case when {u} is not null and {u} <> '' and regexp_matches({rpath}, '{pattern}') and ({rhost}) <> '' "
        f"then 'https://' || ({rhost}) || {fpath} end"
    )


@register(
    "x15_canonicalize_url",
    f"select page_id, {_canon_sql('trim(url)', chr(39) + 'www.nekretnine.rs' + chr(39), PAGE_PATH_PATTERN)} as canonical from pages",
)
def x15(spark, sf):
    pages = read_table(spark, sf, "pages")
    return pages.select("page_id", U.canonicalize_url("url", None, PAGE_PATH_PATTERN).alias("canonical"))


# page navigation links stand in for offer cards on the given pages
NAV_CARDS = "nav li"
NAV_LINKS = ["a[href]"]
NAV_PATH_PATTERN = r"^/[A-Za-z]+/?$"

_LINKS_SQL = f"""
with p as (select page_id, url as page_url, regexp_extract(url, '{_URI}', 4) as host,
                  regexp_extract_all(html, '<li><a href="([^"]*)"', 1) as hrefs from pages),
raw_links as (select page_id, page_url, host, unnest(hrefs) as href, unnest(range(len(hrefs))) as pos from p),
canon as (select page_id, page_url, pos, {_canon_sql('trim(href)', 'host', NAV_PATH_PATTERN)} as url from raw_links),
links as (select page_id, page_url, url, min(pos)::int as pos from canon where url is not null group by page_id, page_url, url)
"""


def _nav_links(spark, sf):
    """(page_id, page_url, url, pos) of the canonical navigation links of every page."""
    return X.explode_links(read_table(spark, sf, "pages"), NAV_CARDS, NAV_LINKS, None, NAV_PATH_PATTERN, keep=["page_id"], own_host=True)


@register("x16_explode_links", _LINKS_SQL + "select page_id, page_url, url, pos from links")
def x16(spark, sf):
    return _nav_links(spark, sf).select("page_id", "page_url", "url", "pos")


_FRONTIER_SQL = _LINKS_SQL + f""",
cand as (select regexp_extract(page_url, '/([a-z]{{2}})/', 1) as stage, page_id as page, pos, url from links),
seen as (select distinct {_canon_sql('trim(url)', "'www.nekretnine.rs'", NAV_PATH_PATTERN)} as url from pages),
firsts as (select url, stage, page, pos,
                  row_number() over (partition by url order by stage, page, pos) as rn from cand),
frontier as (select url, stage, page, pos from firsts where rn = 1 and url not in (select url from seen where url is not null))
"""


def _frontier(spark, sf):
    links = _nav_links(spark, sf)
    cand = links.select(
        F.regexp_extract("page_url", "/([a-z]{2})/", 1).alias("stage"), F.col("page_id").alias("page"), "pos", "url"
    )
    pages = read_table(spark, sf, "pages")
    seen = pages.select(U.canonicalize_url("url", None, NAV_PATH_PATTERN).alias("url")).filter(F.col("url").isNotNull())
    return X.frontier_union(cand, seen, ["stage", "page", "pos"])


@register("x17_frontier_union", _FRONTIER_SQL + "select url, stage, page, pos from frontier")
def x17(spark, sf):
    return _frontier(spark, sf)


@register(
    "x18_resume_anti_join",
    _LINKS_SQL
    + """, lines as (select url, page_id * 100000 + pos as line from links),
firsts as (select url, min(line) as line from lines where trim(url) <> '' group by url)
select url, line from firsts where url not in (select trim(url) from pages)""",
)
def x18(spark, sf):
    lines = _nav_links(spark, sf).select("url", (F.col("page_id") * 100000 + F.col("pos")).alias("line"))
    return X.resume_anti_join(lines, read_table(spark, sf, "pages").select("url"), "line")


def _visible_text_sql(c: str) -> str:
    x = c
    for tag in ("script", "style", "template"):
        x = f"regexp_replace({x}, '(?is)<{tag}\\b.*?</{tag}\\s*>', ' ', 'g')"
    x = f"regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g')"
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


_TEXT_SQL = _visible_text_sql("html")


@register(
    "x19_total_count",
    "select page_id, try_cast(replace(nullif(regexp_extract(" + _TEXT_SQL + ", '(?i)([0-9.]+)\\s+oglasa', 1), ''), '.', '') as bigint) "
    "as total from pages",
)
def x19(spark, sf):
    """Listing total from the page's visible text (script/style bodies and tags removed)."""
    pages = read_table(spark, sf, "pages")
    return pages.select("page_id", U.total_count(U.html_text("html")).alias("total"))


def _page_sql(u: str, n: str) -> str:
    clean = f"regexp_replace(regexp_replace({u}, '/+$', '') || '/', 'stranica/[0-9]+/?$', '')"
    return f"case when {n} = 1 then {clean} else regexp_replace({clean}, '[^/]*$', '') || 'stranica/' || cast({n} as varchar) || '/' end"


@register(
    "x21_page_url",
    f"select page_id, n as page, {_page_sql('url', 'n')} as page_url from pages, (select unnest([1, 2, 3]) as n)",
)
def x21(spark, sf):
    pages = read_table(spark, sf, "pages")
    x = pages.select("page_id", "url", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("page"))
    return x.select("page_id", "page", U.build_page_url("url", "page").alias("page_url"))


@register(
    "x22_page_jobs",
    "select url as source_name, n::int as page, "
    + _page_sql("url", "n")
    + " as url from (select url, greatest(1, ceil(length(html) / 50.0)::int) as np from pages), "
    "lateral (select unnest(generate_series(2, np)) as n) where np >= 2",
)
def x22(spark, sf):
    pages = read_table(spark, sf, "pages")
    sources = pages.select(F.col("url").alias("source_name"), F.col("url").alias("source_url"), F.length("html").alias("total"))
    return X.page_jobs(sources)


@register(
    "x24_coverage",
    _FRONTIER_SQL
    + """, per as (select stage, count(*) as added from frontier group by stage),
tot as (select count(distinct url) as observed from cand)
select stage, added, (sum(added) over (order by stage rows between unbounded preceding and current row))::bigint as unique_total,
  sum(added) over (order by stage rows between unbounded preceding and current row)::double / observed as coverage,
  sum(added) over (order by stage rows between unbounded preceding and current row) >= observed as stop_after
from per, tot""",
)
def x24(spark, sf):
    observed = _nav_links(spark, sf).agg(F.count_distinct("url").alias("observed"))
    return X.coverage(_frontier(spark, sf), observed).select("stage", "added", "unique_total", "coverage", "stop_after")


@register("x1_extract_listings")
def x1(spark, sf):
    return X.extract_listings(read_table(spark, sf, "pages"))


@register(
    "x12_first_present",
    q("select region, city, coalesce(nullif(region, ''), nullif(city, ''), '') as region_or_city from raw"),
)
def x12(spark, sf):
    raw = frames.raw(spark, sf)
    return raw.select("region", "city", TX.first_present("region", "city").alias("region_or_city"))


# --- pieces of X1 on their own (rows-only: the given pages carry no listing markup) ----


def _parts(spark, sf):
    return X.page_parts(read_table(spark, sf, "pages"))


@register("x2_detail_maps")
def x2(spark, sf):
    p = _parts(spark, sf)
    main, amen = X.detail_entries(F.col("parts.main_items")), X.detail_entries(F.col("parts.amenity_items"))
    return p.select("url", main.alias("main_details"), amen.alias("amenities"), X.amenity_flags(F.col("parts.amenity_items")).alias("amenity_list"))


@register("x8_json_ld_offers")
def x8(spark, sf):
    return _parts(spark, sf).select("url", F.posexplode_outer("parts.offers").alias("pos", "offer"))


@register("x10_offer_price")
def x10(spark, sf):
    p = _parts(spark, sf)
    return p.select("url", X.page_price(F.col("parts.offers"), F.col("parts.price_texts"), F.col("url")).alias("price_eur"))


@register("x11_location_parts")
def x11(spark, sf):
    p = _parts(spark, sf)
    loc = F.col("parts.location_items")
    return p.select("url", *[X.location_part(loc, i).alias(n) for i, n in [(2, "city"), (3, "region"), (4, "street")]])


@register("x13_x14_parking_floor")
def x13_14(spark, sf):
    p = _parts(spark, sf)
    m, a = X.detail_entries(F.col("parts.main_items")), X.detail_entries(F.col("parts.amenity_items"))
    flags = X.amenity_flags(F.col("parts.amenity_items"))
    return p.select("url", X.parking_value(m, a, flags).alias("parking"), X.floor_value(m, a).alias("raw_floor_string"))


@register("x20_filter_links")
def x20(spark, sf):
    return X.filter_links(read_table(spark, sf, "pages"), "Grad")
