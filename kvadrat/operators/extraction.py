"""Listing extraction and crawl-frontier planning as bulk jobs over a ``pages(url, html)``
table (X1-X24).

The only Python on the hot path is the DOM step (``mapInArrow``, only ``url`` and ``html``
projected): it returns raw text pieces per page. Every rule that interprets them -- detail maps, number grammar, offer-price precedence, URL rules, dedup,
arrival order -- is a Catalyst expression, join or aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kvadrat import schema as S
from kvadrat.functions import html as H
from kvadrat.functions.numbers import parse_price_text, safe_float
from kvadrat.functions.text import capitalize, clean_text, first_present, let, normalize_key, strip
from kvadrat.functions.urls import build_page_url, canonicalize_url, comparable_url, page_count, uri_part
from kvadrat.session import ship_package

OFFER = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("url_text", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("spec_price", T.StringType()),
        T.StructField("has_spec", T.BooleanType()),
    ]
)
PARTS = T.StructType(
    [
        T.StructField("h1", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("main_items", T.ArrayType(T.StringType())),
        T.StructField("amenity_items", T.ArrayType(T.StringType())),
        T.StructField("location_items", T.ArrayType(T.StringType())),
        T.StructField("offers", T.ArrayType(OFFER)),
        T.StructField("price_texts", T.ArrayType(T.StringType())),
    ]
)


_TEXTS = pa.list_(pa.string())
_ARROW_OFFER = pa.struct({"url": pa.string(), "url_text": pa.string(), "price": pa.string(), "spec_price": pa.string(), "has_spec": pa.bool_()})
_ARROW_PARTS = pa.struct({
    "h1": pa.string(), "description": pa.string(), "main_items": _TEXTS, "amenity_items": _TEXTS, "location_items": _TEXTS,
    "offers": pa.list_(_ARROW_OFFER), "price_texts": _TEXTS})


def _parts_batches(batches: Iterator[pa.RecordBatch], wanted: list[str] | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_parts_or_error(h, wanted) for h in batch.column("html").to_pylist()]
        parts = pa.array([p for p, _ in found], _ARROW_PARTS)
        errors = pa.array([e for _, e in found], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("url"), parts, errors], ["url", "parts", "error"])


def _parts_or_error(html: str | None, wanted: list[str] | None = None) -> tuple[dict | None, str | None]:
    try:
        return H.listing_parts(html, wanted), None
    except Exception as error:  # noqa: BLE001 - one bad page is one error row, not a failed job
        return None, f"{type(error).__name__}: {error}"


def page_parts(pages: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """Arrow DOM step: (url, parts struct, error). Only url and html cross into Python. ``wanted``: the
    parts that are read later, where not all are; the others are null."""
    schema = T.StructType([T.StructField("url", T.StringType()), T.StructField("parts", PARTS), T.StructField("error", T.StringType())])
    ship_package(pages.sparkSession)
    return pages.select("url", "html").mapInArrow(lambda batches: _parts_batches(batches, wanted), schema)


# ---------------------------------------------------------------------------
# Detail lists
# ---------------------------------------------------------------------------


def detail_entries(items: Column) -> Column:
    """X2: 'key: value' items -> array<struct<k, v>> (split on the first ':')."""
    cleaned = F.transform(items, lambda t: clean_text(t))
    with_colon = F.filter(cleaned, lambda t: t.contains(":"))
    return F.transform(
        with_colon,
        lambda t: F.struct(
            normalize_key(F.substring_index(t, ":", 1)).alias("k"),
            clean_text(F.substring(t, F.instr(t, ":") + 1, 1 << 30)).alias("v"),
        ),
    )


def lookup(entries: Column, key: str) -> Column:
    """Value of ``key``; when repeated the last one wins (as a dict built in order)."""
    return F.try_element_at(F.filter(entries, lambda e: e["k"] == key), F.lit(-1))["v"]


def amenity_flags(items: Column) -> Column:
    """Colon-less, non-empty amenity items, normalized."""
    cleaned = F.transform(items, lambda t: clean_text(t))
    return F.transform(F.filter(cleaned, lambda t: ~t.contains(":") & (t != "")), lambda t: normalize_key(t))


# ---------------------------------------------------------------------------
# Offer price
# ---------------------------------------------------------------------------


def offer_price(o: Column) -> Column:
    """X10 per offer: specification price if > 0, else price if > 0, else null."""
    spec = safe_float(o["spec_price"])
    plain = safe_float(o["price"])
    return F.when(spec > 0, spec).when(plain > 0, plain)


def page_price(offers: Column, price_texts: Column, page_url: Column) -> Column:
    """URL-matching offer (only when the page URL is known), then an offer with a
    specification or a listing-section URL, then any offer, then the text selectors."""
    expected = comparable_url(page_url)
    priced = F.filter(
        F.transform(
            offers,
            lambda o: F.struct(
                offer_price(o).alias("p"),
                comparable_url(o["url"]).alias("cmp"),
                (F.coalesce(o["has_spec"], F.lit(False)) | F.coalesce(o["url_text"], F.lit("")).contains("/stambeni-objekti/")).alias("pref"),
            ),
        ),
        lambda o: o["p"].isNotNull(),
    )

    def first(found, pred):
        return F.try_element_at(F.filter(found, pred), F.lit(1))["p"]

    def chosen(found):  # the offers are read once for all three
        by_url = let(expected, lambda e: F.when(e != "", first(found, lambda o: o["cmp"] == e)))
        return F.coalesce(by_url, first(found, lambda o: o["pref"]), F.try_element_at(found, F.lit(1))["p"])

    texts = F.filter(F.transform(price_texts, lambda t: parse_price_text(t)), lambda p: p.isNotNull())
    return F.coalesce(F.when(F.size(offers) > 0, let(priced, chosen)), F.try_element_at(texts, F.lit(1)))


# ---------------------------------------------------------------------------
# extract_listings
# ---------------------------------------------------------------------------


def _or_unknown(c: Column) -> Column:
    return F.when(c.isNotNull() & (c != ""), c).otherwise(F.lit(S.UNKNOWN))


def parking_value(main: Column, amen: Column, flags: Column) -> Column:
    """Main detail, then amenity detail, else first amenity naming a parking kind
    (capitalized), else unknown."""
    direct = F.coalesce(*[F.nullif(lookup(entries, S.KEY_PARKING), F.lit("")) for entries in (main, amen)])
    matches = F.filter(flags, lambda t: F.exists(F.array(*[F.lit(k) for k in S.PARKING_KEYWORDS]), lambda k: t.contains(k)))
    return F.coalesce(direct, F.nullif(capitalize(F.try_element_at(matches, F.lit(1))), F.lit("")), F.lit(S.UNKNOWN))


def floor_value(main: Column, amen: Column) -> Column:
    """X14: 'sprat' detail, else 'spratnost / ukupan broj spratova', else 'spratnost'."""
    f = lookup(amen, S.KEY_FLOOR_AMENITY)
    t = lookup(amen, S.KEY_TOTAL_FLOORS)
    has_f, has_t = f.isNotNull() & (f != ""), t.isNotNull() & (t != "")
    composed = F.when(has_f & has_t, F.concat(f, F.lit(" / "), t)).when(has_f, f)
    main_floor = lookup(main, S.KEY_FLOOR_MAIN)
    return _or_unknown(F.when(main_floor.isNotNull() & (main_floor != ""), main_floor).otherwise(composed))


def location_part(items: Column, i: int) -> Column:
    """X11: list item ``i`` (0-based) of the location list, when the list is long enough."""
    cleaned = F.transform(items, lambda t: clean_text(t))
    return F.when(F.size(cleaned) > i, F.get(cleaned, i)).otherwise(F.lit(S.UNKNOWN))


def extract_listings(pages: DataFrame) -> DataFrame:
    """pages(url, html) -> the 13 listing columns (numbers as double, null when blank) of
    the pages that can be parsed."""
    return split_failures(extract_results(pages))[0]


def extract_results(pages: DataFrame) -> DataFrame:
    """X1 with ``error``: what kept a page from being parsed (S8), null for a listing."""
    p = page_parts(pages)
    main = detail_entries(F.col("parts.main_items"))
    amen = detail_entries(F.col("parts.amenity_items"))
    p = p.select("url", "parts", "error", main.alias("_main"), amen.alias("_amen"), amenity_flags(F.col("parts.amenity_items")).alias("_flags"))
    m, a = F.col("_main"), F.col("_amen")
    heating = first_present(lookup(m, S.KEY_HEATING), lookup(a, S.KEY_HEATING))
    return p.select(
        clean_text(F.col("parts.h1")).alias("title"),
        clean_text(F.col("parts.description")).alias("description"),
        safe_float(first_present(lookup(m, S.KEY_AREA), lookup(a, S.KEY_AREA))).alias("area_m2"),
        page_price(F.col("parts.offers"), F.col("parts.price_texts"), F.col("url")).alias("price_eur"),
        location_part(F.col("parts.location_items"), 2).alias("city"),
        location_part(F.col("parts.location_items"), 3).alias("region"),
        location_part(F.col("parts.location_items"), 4).alias("street"),
        _or_unknown(heating).alias("heating_type"),
        safe_float(first_present(lookup(m, S.KEY_ROOMS_MAIN), lookup(a, S.KEY_ROOMS_AMENITY))).alias("rooms"),
        parking_value(m, a, F.col("_flags")).alias("parking"),
        floor_value(m, a).alias("raw_floor_string"),
        safe_float(lookup(a, S.KEY_YEAR)).alias("year_built"),
        F.col("url"),
        F.col("error"),
    )


def split_failures(results: DataFrame, error_col: str = "error") -> tuple[DataFrame, DataFrame]:
    """(rows without error, url + error of failed rows)."""
    ok = results.filter(F.col(error_col).isNull()).drop(error_col)
    bad = results.filter(F.col(error_col).isNotNull()).select("url", error_col)
    return ok, bad


# ---------------------------------------------------------------------------
# Links from index pages
# ---------------------------------------------------------------------------

OFFER_CARDS = ".advert-list .row.offer"
OFFER_LINKS = ["h2.offer-title a[href]", "a[href]"]


def explode_links(
    pages: DataFrame,
    card_selector: str = OFFER_CARDS,
    link_selectors: list[str] | None = None,
    netloc: str | None = S.BASE_NETLOC,
    path_pattern: str = S.LISTING_PATH_PATTERN,
    keep: list[str] | None = None,
    own_host: bool = False,
) -> DataFrame:
    """(page url, pos, canonical url) of offer links, first occurrence per page only.

    DOM step in Arrow batches; canonicalization and the order-preserving in-page distinct
    (min position per (page, url)) are Catalyst. ``keep`` columns tell pages apart besides their URL;
    with ``own_host`` links are made absolute by the page's host and any host is taken."""
    link_selectors, keep = link_selectors or OFFER_LINKS, keep or []
    kinds = dict(pages.dtypes)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            hrefs = pa.array([H.card_links(h, card_selector, link_selectors) for h in batch.column("html").to_pylist()], _TEXTS)
            names = [*keep, "url"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), hrefs], [*names, "hrefs"])

    ship_package(pages.sparkSession)
    fields = "".join(f"`{c}` {kinds[c]}, " for c in keep)
    raw = pages.select(*keep, "url", "html").mapInArrow(batches, f"{fields}url string, hrefs array<string>")
    links = raw.select(*keep, F.col("url").alias("page_url"), F.posexplode("hrefs").alias("pos", "href"))
    if own_host:
        url = canonicalize_url("href", None, path_pattern, uri_part(F.col("page_url"), "netloc"))
    else:
        url = canonicalize_url("href", netloc, path_pattern)
    canon = links.select(*keep, "page_url", "pos", url.alias("url")).filter(F.col("url").isNotNull())
    return canon.groupBy(*keep, "page_url", "url").agg(F.min("pos").alias("pos"))


def filter_links(pages: DataFrame, heading_text: str, base_host: str = S.BASE_HOST) -> DataFrame:
    """(page url, pos, name, absolute url) of the first matching filter group,
    distinct by absolute url keeping the first."""

    kind = pa.list_(pa.struct({"name": pa.string(), "href": pa.string()}))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = [H.filter_group_links(h, heading_text) for h in batch.column("html").to_pylist()]
            links = pa.array([[{"name": n, "href": u} for n, u in page] for page in found], kind)
            yield pa.RecordBatch.from_arrays([batch.column("url"), links], ["url", "links"])

    ship_package(pages.sparkSession)
    raw = pages.select("url", "html").mapInArrow(batches, "url string, links array<struct<name:string,href:string>>")
    x = raw.select(F.col("url").alias("page_url"), F.posexplode("links").alias("pos", "l"))
    href = F.col("l.href")
    absolute = F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), href).when(
        href.startswith("//"), F.concat(F.lit("https:"), href)
    ).when(href.startswith("/"), F.concat(F.lit(base_host), href)).otherwise(F.concat(F.lit(base_host + "/"), href))
    x = x.select("page_url", "pos", F.col("l.name").alias("name"), absolute.alias("url"))
    first = x.groupBy("page_url", "url").agg(F.min_by("name", "pos").alias("name"), F.min("pos").alias("pos"))
    return first.select("page_url", "pos", "name", "url")


# ---------------------------------------------------------------------------
# Frontier planning
# ---------------------------------------------------------------------------


def frontier_union(candidates: DataFrame, seen: DataFrame | None = None, order_cols: list[str] | None = None) -> DataFrame:
    """Canonical candidate URLs not seen before, each once, at its first arrival.

    ``candidates`` has ``url`` plus the arrival-order columns; ``seen`` has ``url``. The
    first arrival is a ``min_by`` aggregate per URL (partial aggregation absorbs a URL
    repeated across a third of all pages), the anti join removes known URLs."""
    order_cols = order_cols or ["stage", "source", "page", "pos"]
    c = candidates.filter(F.col("url").isNotNull())
    first = c.groupBy("url").agg(F.min(F.struct(*order_cols)).alias("_first"))
    if seen is not None:
        first = first.join(seen.select("url").distinct(), "url", "left_anti")
    return first.select("url", *[F.col(f"_first.{o}").alias(o) for o in order_cols])


def added_per_stage(frontier: DataFrame, stage_col: str = "stage") -> DataFrame:
    """Count added per stage and running unique total (bounded: one row per stage)."""
    per = frontier.groupBy(stage_col).agg(F.count(F.lit(1)).alias("added"))
    w = Window.orderBy(stage_col).rowsBetween(Window.unboundedPreceding, 0)
    return per.withColumn("unique_total", F.sum("added").over(w))


def resume_anti_join(urls: DataFrame, scraped: DataFrame, order_col: str = "line", limit: int = 0) -> DataFrame:
    """URLs still to fetch: stripped, not blank, not already scraped, first copy only
    (by ``order_col``), optionally the first ``limit`` of them."""
    u = urls.select(strip("url").alias("url"), order_col).filter(F.col("url") != "")
    s = scraped.select(strip("url").alias("url")).filter(F.col("url") != "").distinct()
    first = u.groupBy("url").agg(F.min(order_col).alias(order_col))
    todo = first.join(s, "url", "left_anti")
    if limit > 0:
        todo = todo.orderBy(order_col).limit(limit)
    return todo


def page_jobs(sources: DataFrame, total_col: str = "total", cap: int | None = None) -> DataFrame:
    """One row per extra page (2..n) of each source, all of them unless ``cap`` is given;
    ``sequence`` only when n >= 2 (``sequence(2, 1)`` would count down)."""
    n = page_count(total_col, cap)
    jobs = sources.withColumn("_n", n).filter(F.col("_n") >= 2)
    jobs = jobs.withColumn("page", F.explode(F.sequence(F.lit(2), F.col("_n"))))
    return jobs.select("source_name", "page", build_page_url("source_url", "page").alias("url"))


def partition_sources(spark, kind: str, ranges: list[str], base_host: str = S.BASE_HOST) -> DataFrame:
    """Filter-partition sources (name, url) for one kind and its value ranges."""
    rows = [(f"{kind}:{v}", base_host + S.PARTITION_PATH.format(kind=kind, value=v)) for v in ranges]
    return spark.createDataFrame(rows, "source_name string, source_url string")


def coverage(frontier: DataFrame, observed_total: DataFrame | int, stage_col: str = "stage") -> DataFrame:
    """Unique URLs added per stage, running total, coverage of the observed total and
    ``stop_after`` once the running total reaches it. ``observed_total`` is a number or a
    one-row frame with column ``observed`` (broadcast: one row)."""
    per = added_per_stage(frontier, stage_col)
    if isinstance(observed_total, int):
        per = per.withColumn("observed", F.lit(observed_total))
    else:
        per = per.crossJoin(F.broadcast(observed_total.select("observed")))
    return per.withColumns(
        {
            "coverage": F.try_divide(F.col("unique_total").cast("double"), F.col("observed").cast("double")),
            "stop_after": F.coalesce(F.col("unique_total") >= F.col("observed"), F.lit(False)),
        }
    )
