"""Registry entries for page extraction over the listing and index pages of
``plans/pageview``. The oracles compute the expected values from the source columns a page
was written from; they never read the markup."""

from __future__ import annotations

from pyspark.sql import functions as F

from kvadrat import schema as S
from kvadrat.functions import text as TX
from kvadrat.functions import urls as U
from kvadrat.operators import extraction as X
from kvadrat.plans.registry import register
from kvadrat.sources import listings as L
from kvadrat.plans import pageview
from kvadrat.plans.testview import read_table


def _area(k: str = "k") -> str:
    return f"(20 + {k} % 180)"


# what a page's details come to, by the same remainders as in ``pageview.LISTING_SOURCE``
_EXPECTED = f"""with {pageview.listing_source_sql()},
expected as (select *,
  coalesce(h1, '') as title, coalesce(about, '') as description,
  case when k % 12 = 0 then 77.5 when k % 6 = 1 then {_area()} + 0.25 when k % 6 = 2 then {_area()} + 0.5
       when k % 6 = 3 then {_area()} when k % 6 = 4 then 1000 + {_area()} end::double as area_m2,
  case when k % 10 in (1, 4) then (whole || '.' || cents)::double when k % 10 <> 6 then whole::double end as price_eur,
  case when n_loc >= 2 then l_city else 'Nepoznato' end as city,
  case when n_loc >= 3 then l_region else 'Nepoznato' end as region,
  case when n_loc >= 4 then l_street else 'Nepoznato' end as street,
  coalesce(m_heat, a_heat, 'Nepoznato') as heating_type,
  case k % 5 when 0 then 1.5 + k % 7 when 1 then 1 + k % 3 when 3 then 1 + k % 7 end::double as rooms,
  case k % 7 when 0 then 'Da' when 1 then 'Ulica' when 2 then 'Spoljno parking mesto'
    when 3 then 'Garaza u zgradi' when 5 then 'Slobodan parking' else 'Nepoznato' end as parking,
  case k % 11 when 0 then '3 / 5' when 1 then '2 / 7' when 2 then '4' when 3 then 'Nepoznato' when 4 then 'Suteren'
    when 5 then 'Nepoznato' when 6 then 'visoko prizemlje / 6' else cast(k % 20 as varchar) end as raw_floor_string,
  try_cast(rtrim(a_year, '.') as double) as year_built
  from listing_source)
"""


def _pages(spark, sf):
    return pageview.listing_pages(spark, sf)


@register("x1_listing_pages", _EXPECTED + f"select {', '.join(S.RAW_COLUMNS)} from expected")
def x1(spark, sf):
    return X.extract_listings(_pages(spark, sf))


_MAIN = [("m_area", S.KEY_AREA), ("m_rooms", S.KEY_ROOMS_MAIN), ("m_heat", S.KEY_HEATING), ("m_park", S.KEY_PARKING),
         ("m_floor", S.KEY_FLOOR_MAIN), ("m_year", S.KEY_YEAR)]
_AMENITIES = [("a_area", S.KEY_AREA), ("a_rooms", S.KEY_ROOMS_AMENITY), ("a_heat", S.KEY_HEATING), ("a_park", S.KEY_PARKING),
              ("a_floor", S.KEY_FLOOR_AMENITY), ("a_total", S.KEY_TOTAL_FLOORS), ("a_year", S.KEY_YEAR)]


@register(
    "x2_listing_details",
    _EXPECTED
    + f"select url, {', '.join(c for c, _ in _MAIN + _AMENITIES)}, "
    "'lift' || coalesce('|' || flag_key, '') || '|terasa' as amenity_list from expected",
)
def x2(spark, sf):
    parts = X.page_parts(_pages(spark, sf), ["main_items", "amenity_items"])
    main, amen = X.detail_entries(F.col("parts.main_items")), X.detail_entries(F.col("parts.amenity_items"))
    p = parts.select("url", main.alias("main"), amen.alias("amen"), X.amenity_flags(F.col("parts.amenity_items")).alias("flags"))
    return p.select(
        "url",
        *[X.lookup(F.col("main"), key).alias(c) for c, key in _MAIN],
        *[X.lookup(F.col("amen"), key).alias(c) for c, key in _AMENITIES],
        F.array_join("flags", "|").alias("amenity_list"),
    )


def _offer(by: str, pos: int, url: str, price: str, spec: str = "null", has_spec: str = "false") -> str:
    return f"select url, {pos} as pos, {url} as offer_url, {price} as price, {spec} as spec_price, {has_spec} as has_spec from expected where k % 10 = {by}"


_OTHER_SQL = f"'{pageview._OTHER}'"


@register(
    "x8_listing_offers",
    _EXPECTED
    + " union all ".join(
        [
            _offer("0", 0, _OTHER_SQL, "'1'"),
            _offer("0", 1, "substr(url, 1, length(url) - 1) || '?a=1'", "whole"),
            _offer("1", 0, "url", "'0'"),
            _offer("1", 1, "'/x/'", "null", "grouped || ',' || cents", "true"),
            _offer("2", 0, _OTHER_SQL, "'7'"),
            _offer("2", 1, "'/stambeni-objekti/drugi/'", "whole"),
            _offer("4", 0, "null", "whole || ',' || cents"),
            _offer("7", 0, "url", "whole", "'0'", "true"),
            _offer("8", 0, "url", "'-5'"),
            _offer("9", 0, "null", "whole || ' EUR'"),
        ]
    ),
)
def x8(spark, sf):
    offers = X.page_parts(_pages(spark, sf), ["offers"]).select("url", F.posexplode("parts.offers").alias("pos", "o"))
    return offers.select("url", "pos", F.col("o.url").alias("offer_url"), "o.price", "o.spec_price", "o.has_spec")


@register("x10_listing_price", _EXPECTED + "select url, price_eur from expected")
def x10(spark, sf):
    p = X.page_parts(_pages(spark, sf), ["offers", "price_texts"])
    return p.select("url", X.page_price(F.col("parts.offers"), F.col("parts.price_texts"), F.col("url")).alias("price_eur"))


@register("x11_listing_location", _EXPECTED + "select url, city, region, street from expected")
def x11(spark, sf):
    p = X.page_parts(_pages(spark, sf), ["location_items"])
    loc = F.col("parts.location_items")
    return p.select("url", *[X.location_part(loc, i).alias(n) for i, n in [(2, "city"), (3, "region"), (4, "street")]])


@register("x13_x14_listing_parking_floor", _EXPECTED + "select url, parking, raw_floor_string from expected")
def x13_14(spark, sf):
    p = X.page_parts(_pages(spark, sf), ["main_items", "amenity_items"])
    main, amen = X.detail_entries(F.col("parts.main_items")), X.detail_entries(F.col("parts.amenity_items"))
    # a step of its own, so that the lists are made once and not for each lookup
    p = p.select("url", main.alias("main"), amen.alias("amen"), X.amenity_flags(F.col("parts.amenity_items")).alias("flags"))
    m, a = F.col("main"), F.col("amen")
    return p.select("url", X.parking_value(m, a, F.col("flags")).alias("parking"), X.floor_value(m, a).alias("raw_floor_string"))


_INDEX = f"with {pageview.index_source_sql()}\n"


@register(
    "x16_index_offer_links",
    _INDEX
    + f"""select url as page_url, pos, '{S.BASE_HOST}' || link || '/' as url from (
  select url, 0 as pos, '/stanovi/a/Nk' || k as link from index_source
  union all select url, 1, '/b/NkB_' || k from index_source
  union all select url, 6, '/Nk-rel' || k from index_source)""",
)
def x16(spark, sf):
    return X.explode_links(pageview.index_pages(spark, sf)).select("page_url", "pos", "url")


@register("x19_index_total_count", _INDEX + "select url, total::bigint as total from index_source")
def x19(spark, sf):
    return pageview.index_pages(spark, sf).select("url", U.total_count(U.html_text("html")).alias("total"))


@register(
    "x20_index_filter_links",
    _INDEX
    + f"""select url as page_url, pos, name, '{S.BASE_HOST}' || link as url from (
  select url, 0 as pos, city as name, '/grad/' || k || '/' as link from index_source
  union all select url, 2, 'Nis', '/grad/nis/' from index_source
  union all select url, 3, 'Opstina', '/opstina/' || k || '/' from index_source)""",
)
def x20(spark, sf):
    return X.filter_links(pageview.index_pages(spark, sf), "Grad")


# --- whole texts of documents ---------------------------------------------------------------

_SPACE = r"[\t-\r\x{85}\p{Z}]"


def _clean_sql(c: str) -> str:
    return f"coalesce(regexp_replace(regexp_replace({c}, '{_SPACE}+', ' ', 'g'), '^ | $', '', 'g'), '')"


@register("x3_clean_documents", f"select doc_id, md5({_clean_sql('text')}) as clean_md5, length({_clean_sql('text')})::int as n_chars from documents")
def x3(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", TX.clean_text("text").alias("t"))
    return docs.select("doc_id", F.md5("t").alias("clean_md5"), F.length("t").alias("n_chars"))


# Latin letters written as Cyrillic look-alikes, for the key to map back
_TO_CYRILLIC = ("aejkoptx", "аејкорта")


@register(
    "x4_normalize_documents",
    f"select doc_id, md5(lower(translate({_clean_sql('t')}, '{S.CYRILLIC_FROM}', '{S.CYRILLIC_TO}'))) as key_md5 "
    f"from (select doc_id, translate(text, '{_TO_CYRILLIC[0]}', '{_TO_CYRILLIC[1]}') as t from documents)",
)
def x4(spark, sf):
    docs = read_table(spark, sf, "documents")
    return docs.select("doc_id", F.md5(TX.normalize_key(F.translate("text", *_TO_CYRILLIC))).alias("key_md5"))


@register(
    "s4_text_numbers",
    f"with {pageview.listing_source_sql()} select count(*) as rows, "
    "count_if(m_area is not null)::bigint as area_m2, 0::bigint as price_eur, "
    "count_if(k % 5 in (0, 4))::bigint as rooms, count_if(a_year = 'nije poznata')::bigint as year_built from listing_source",
)
def s4(spark, sf):
    """Numbers as the pages write them: units, decimal commas and words do not parse."""
    src = pageview.listing_source(spark, sf)
    return L.numeric_problems(
        src.select(F.col("m_area").alias("area_m2"), F.col("whole").alias("price_eur"), F.col("m_rooms").alias("rooms"), F.col("a_year").alias("year_built"))
    )
