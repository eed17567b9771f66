"""Extraction cases: number grammar, URLs, index/filter pages, full listing page."""

import pytest
from pyspark.sql import functions as F

from kvadrat.functions import numbers as N
from kvadrat.functions import urls as U
from kvadrat.operators import extraction as X


@pytest.mark.parametrize(
    "text,expected",
    [("1.234", "1234"), ("342.85", "342.85"), ("1.234,5", "1234.5"), ("1,234.5", "1234.5"),
     ("1.234.567", "1234567"), ("0,123", "0123"), ("12,5", "12.5"), ("1.2.3", "12.3"), ("-1.234", "-1234"), ("", "")],
)
def test_normalize_number(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(N.normalize_number("t")).first()[0] == expected


@pytest.mark.parametrize(
    "text,expected",
    [("Povrsina oko 71.25 kvm", 71.25), ("118 kvm", 118.0), ("nema", None), ("1 234,5 EUR", 1234.5)],
)
def test_safe_float(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(N.safe_float("t")).first()[0] == expected


def test_parse_price_text_quirk(spark):
    df = spark.createDataFrame([("Cena: 120.000 EUR",), ("1.234,56 EUR",), ("bez cene",)], "t string")
    assert [r[0] for r in df.select(N.parse_price_text("t")).collect()] == [120000.0, 56.0, None]


BASE = "https://www.nekretnine.rs"


@pytest.mark.parametrize(
    "href,expected",
    [
        ("/stambeni-objekti/stanovi/dvosoban-kod-parka/Nk7Qz09/?ref=mail&x=2#mapa", BASE + "/stambeni-objekti/stanovi/dvosoban-kod-parka/Nk7Qz09/"),
        (BASE + "/stambeni-objekti/stanovi/garsonjera/Nk00W", BASE + "/stambeni-objekti/stanovi/garsonjera/Nk00W/"),
        ("https://other.example/stan/NkX1/", None),
        ("/stambeni-objekti/stanovi/lista/", None),
        ("", None),
    ],
)
def test_canonicalize_url(spark, href, expected):
    df = spark.createDataFrame([(href,)], "h string")
    assert df.select(U.canonicalize_url("h")).first()[0] == expected


def test_page_url(spark):
    base = BASE + "/stambeni-objekti/stanovi/izdavanje-prodaja/prodaja/grad/beograd/lista/po-stranici/20/"
    df = spark.createDataFrame([(base,), (base + "stranica/4/",)], "u string")
    r = df.select(U.build_page_url("u", 1).alias("p1"), U.build_page_url("u", 2).alias("p2")).collect()
    assert r[0]["p1"] == base and r[0]["p2"] == base + "stranica/2/"
    assert r[1]["p1"] == base and r[1]["p2"] == base + "stranica/2/"


def test_comparable_url(spark):
    df = spark.createDataFrame([("http://www.nekretnine.rs/a/b//?x=1",), ("/a/b",), ("",)], "u string")
    assert [r[0] for r in df.select(U.comparable_url("u")).collect()] == [
        "https://www.nekretnine.rs/a/b/", "https://www.nekretnine.rs/a/b/", ""]


def card(href=None, title=True):
    link = f'<a class="t" href="{href}">oglas</a>' if href else "<span>bez veze</span>"
    return f'<section class="offer wide row"><p>{"<h2 class=offer-title>" + link + "</h2>" if title else link}</p></section>'


def group(name, *links):
    items = "".join(f'<span><a data-url="{u}"> {n} </a></span>' for n, u in links)
    return f'<div class="filtergroup"><h5 class="heading">Izbor: {name}</h5>{items}</div>'


def test_explode_links_keeps_cards_in_order(spark):
    cards = [card("/kuce/vila/NkV7/", title=False), card(), card("/kuce/salas/NkS3"), card("/kuce/vila/NkV7/#mapa"),
             card("/kuce/lista/strana/"), card("http://drugde.example/kuce/NkQ1/"), card("//www.nekretnine.rs/kuce/koliba/NkK5/?a=b")]
    html = '<main><div class="advert-list">' + "".join(cards) + "</div>" + card("/kuce/van-liste/NkO8/") + "</main>"
    pages = spark.createDataFrame([("p", html), ("q", None)], "url string, html string")
    out = [(r["page_url"], r["pos"], r["url"]) for r in X.explode_links(pages).orderBy("pos").collect()]
    assert out == [("p", 0, BASE + "/kuce/vila/NkV7/"), ("p", 2, BASE + "/kuce/salas/NkS3/"), ("p", 6, BASE + "/kuce/koliba/NkK5/")]


def test_filter_links_first_matching_group(spark):
    html = group("sprat", ("Prvi", "/sprat/1/")) + group("OPSTINA", ("Zemun", "/o/zemun/"), ("prazno", " "), ("Liman", "/o/liman/")) + group("opstina", ("Kasnije", "/o/x/"))
    pages = spark.createDataFrame([("p", html)], "url string, html string")
    out = [(r["name"], r["url"]) for r in X.filter_links(pages, "opstina").orderBy("pos").collect()]
    assert out == [("Zemun", BASE + "/o/zemun/"), ("Liman", BASE + "/o/liman/")]


def details(name, items):
    return f'<article class="property__{name}"><ul>' + "".join(f"<li> {i} </li>" for i in items) + "</ul></article>"


def listing(title, text, main, amenities, places, *blocks):
    ld = "".join(f'<script type="application/ld+json">{b}</script>' for b in blocks)
    return (f'<div class="cms-content-inner"><p>{text}</p></div>' + details("location", places) + details("amenities", amenities)
            + details("main-details", main) + f"<h1>\n{title}\n</h1>" + ld)


def test_extract_listing(spark):
    url = BASE + "/kuce/vila-na-bregu/NkHill42/"
    html = listing(
        "Vila <i>na bregu</i>", "Pogled na reku.", ["Kvadratura: 187,5 m²", "Ukupno soba: 6", "Uknjiženo: Da"],
        ["Grejanje: Podno", "Spratnost: Prizemlje", "Ukupan brој spratova: 2", "Godina izgradnje: 1987"],
        ["RS", "Srem", "Irig", "Vrdnik", "Lipa 4"],
        '{"broken": ', '[{"@type": ["Thing", "Offer"], "url": "' + BASE + '/kuce/druga/NkOther1/", "price": 1}]',
        '{"@graph": [{"@type": "Offer", "url": "' + url + '?src=ld", "price": {"amount": "264500.00"}}]}')
    r = X.extract_listings(spark.createDataFrame([(url, html)], "url string, html string")).first().asDict()
    assert (r["title"], r["description"], r["url"]) == ("Vila na bregu", "Pogled na reku.", url)
    assert (r["price_eur"], r["area_m2"], r["year_built"]) == (264500.0, 187.5, 1987.0)
    assert (r["city"], r["region"], r["street"]) == ("Irig", "Vrdnik", "Lipa 4")
    assert (r["heating_type"], r["raw_floor_string"]) == ("Podno", "Prizemlje / 2")


def test_deep_page_is_read_and_bad_page_is_an_error_row(spark):
    from kvadrat.functions import html as H

    deep = "<div>" * 5000 + "<h1>dno</h1>"
    assert H.listing_parts(deep)["h1"] == "dno"
    bad = '<h1>x</h1><script type="application/ld+json">' + "[" * 200_000 + "</script>"
    pages = spark.createDataFrame([("deep", deep), ("bad", bad), ("none", None)], "url string, html string")
    ok, failed = X.split_failures(X.extract_results(pages))
    assert {r["url"]: r["title"] for r in ok.collect()} == {"deep": "dno", "none": ""}
    assert [(r["url"], r["error"].split(":")[0]) for r in failed.collect()] == [("bad", "RecursionError")]


def test_page_jobs_have_no_cap_unless_given(spark):
    src = spark.createDataFrame([("a", "https://h/x/", 100_000)], "source_name string, source_url string, total int")
    assert X.page_jobs(src).count() == 100_000 // 50 - 1
    assert X.page_jobs(src, cap=10).count() == 9


def test_text_price_fallback_and_parking_keyword(spark):
    html = """<html><body><h1>T</h1><div class="sticky-price">Cena 85.000 €</div>
    <div class="property__amenities"><ul><li>Terasa</li><li>Garazno mesto</li></ul></div></body></html>"""
    pages = spark.createDataFrame([("", html)], "url string, html string")
    r = X.extract_listings(pages).first()
    assert r["price_eur"] == 85000.0
    assert r["parking"] == "Garazno mesto"
    assert r["city"] == "Nepoznato" and r["raw_floor_string"] == "Nepoznato"


def test_page_jobs_and_frontier(spark):
    src = spark.createDataFrame([("a", "https://h/x/", 120), ("b", "https://h/y/", None), ("c", "https://h/z/", 10)],
                                "source_name string, source_url string, total int")
    jobs = X.page_jobs(src, "total", cap=4)
    counts = {r["source_name"]: r["count"] for r in jobs.groupBy("source_name").count().collect()}
    assert counts == {"a": 2, "b": 3}
    cand = spark.createDataFrame([("u1", 1, 0), ("u2", 1, 1), ("u1", 2, 0), ("u3", 2, 1)], "url string, page int, pos int")
    seen = spark.createDataFrame([("u3",)], "url string")
    fr = X.frontier_union(cand, seen, ["page", "pos"]).orderBy("page", "pos").collect()
    assert [(r["url"], r["page"]) for r in fr] == [("u1", 1), ("u2", 1)]


def test_partition_sources(spark):
    from kvadrat import schema as S

    price = X.partition_sources(spark, "cena", S.PRICE_RANGES).collect()
    area = X.partition_sources(spark, "kvadratura", S.AREA_RANGES).collect()
    assert (len(price), len(area)) == (9, 10)
    assert price[0]["source_name"] == "cena:0_50000"
    assert price[0]["source_url"] == BASE + "/stambeni-objekti/stanovi/izdavanje-prodaja/prodaja/cena/0_50000/lista/po-stranici/20/"


def test_resume_anti_join_with_limit(spark):
    urls = spark.createDataFrame([(" u1 ", 1), ("u2", 2), ("", 3), ("u1", 4), ("u3", 5), ("u4", 6)], "url string, line int")
    scraped = spark.createDataFrame([("u2",)], "url string")
    todo = [r["url"] for r in X.resume_anti_join(urls, scraped, "line").orderBy("line").collect()]
    assert todo == ["u1", "u3", "u4"]
    limited = [r["url"] for r in X.resume_anti_join(urls, scraped, "line", limit=2).orderBy("line").collect()]
    assert limited == ["u1", "u3"]


def test_failure_side_output(spark):
    import os
    import tempfile

    from kvadrat.sources import sinks

    results = spark.createDataFrame([("u1", "ok", None), ("u2", None, "HTTP 404")], "url string, title string, error string")
    ok, bad = X.split_failures(results)
    assert [r["url"] for r in ok.collect()] == ["u1"]
    out = os.path.join(tempfile.mkdtemp(prefix="kv-fail-", dir="/tmp"), "failed")
    sinks.append_failures(bad, out)
    assert [r["value"] for r in spark.read.text(out).collect()] == ["u2\tHTTP 404"]


def test_total_count_reads_visible_text(spark):
    html = ('<html><head><script>var n = "99 oglasa";</script></head>'
            '<body><div class="count">Pronađeno <b>12.345</b> oglasa</div></body></html>')
    df = spark.createDataFrame([(html,), ("<p>nema</p>",)], "html string")
    assert [r[0] for r in df.select(U.total_count(U.html_text("html"))).collect()] == [12345, None]


def test_pages_are_dealt_before_they_are_parsed(spark, tmp_path):
    """A table of one row group would be one task, and so would parsing its pages (F2-F8, F16)."""
    from kvadrat.plans import pageview

    one = lambda rows, kind, name: spark.createDataFrame(rows, kind).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    one([(i, 0, 1000.5 + i, "O", "1-URGENT", None) for i in range(400)],
        "o_orderkey long, o_custkey long, o_totalprice double, o_orderstatus string, o_orderpriority string, o_orderdate timestamp", "orders")
    one([(i, f"C{i}", 0, "X") for i in range(400)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string", "customer")
    one([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int", "nation")
    one([(0, "R")], "r_regionkey int, r_name string", "region")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = spark.conf.get("spark.kvadrat.scanPartitions")
    spark.conf.unset("spark.kvadrat.scanPartitions")
    try:
        for pages in (pageview.listing_pages(spark, str(tmp_path)), pageview.index_pages(spark, str(tmp_path))):
            tasks = pages.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
            assert len(tasks) == n and sum(r["count"] for r in tasks) == 400
    finally:
        spark.conf.set("spark.kvadrat.scanPartitions", dealt)


def test_page_lists_are_made_once_and_only_read_parts_are_picked(spark, sf_dir):
    """Each lookup made the detail lists for itself, and every query picked all parts of a page."""
    from kvadrat.functions import html as H
    from kvadrat.plans import registry

    page = '<h1>T</h1><div class="property__location"><ul><li>a</li></ul></div><h4>1 EUR</h4>'
    assert H.listing_parts(page, ["location_items"]) == {"location_items": ["a"]}
    whole = H.listing_parts(page)
    assert list(whole) == ["h1", "description", "main_items", "amenity_items", "location_items", "offers", "price_texts"]
    pages = spark.createDataFrame([("u", page)], "url string, html string")
    parts = X.page_parts(pages, ["location_items"]).first()["parts"]
    assert parts["location_items"] == ["a"] and parts["h1"] is None and parts["price_texts"] is None
    queries = registry.queries()
    plan = lambda name: queries[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    # a list is cleaned for its keys, and once more for the flags
    assert plan("x13_x14_listing_parking_floor").count("transform(parts") <= 3
    assert plan("x10_listing_price").count("transform(parts") <= 2


def test_page_price_of_no_offers_and_of_offers_without_a_price(spark):
    offer = "struct<url:string,url_text:string,price:string,spec_price:string,has_spec:boolean>"
    rows = [(None, None), ([], ["1.200 EUR"]), ([("u", "u", "0", None, False)], ["x", "7 EUR"]),
            ([("https://a.b/z/", "", "5", None, None), ("https://a.b/c/", "", "6", None, None)], ["7 EUR"]), ([(None, "", "4", "8", True)], [])]
    df = spark.createDataFrame(rows, f"offers array<{offer}>, texts array<string>")
    found = df.select(X.page_price(F.col("offers"), F.col("texts"), F.lit("https://a.b/c/"))).collect()
    assert [r[0] for r in found] == [None, 1200.0, 7.0, 6.0, 8.0]


@pytest.mark.parametrize("page", [
    '<!DOCTYPE html>\n<div class="a  b" id="x">A &amp; B<br><p hidden>c</p></i></div >tail &lt;',
    '<script type="t">if (a &amp; b) {}</script><STYLE>p{}</STYLE><Li>1<li>2</ul>',
    "", "no markup", "<p>a<p>b</div></p>",
])
def test_plain_markup_gives_the_tree_of_the_parser(page):
    from kvadrat.functions import html as H

    def dump(node):
        return node if isinstance(node, str) else (node.tag, node.attrs, [dump(c) for c in node.children])

    slow = H._Builder()
    slow.feed(page)
    slow.close()
    assert dump(H._plain_tree(page)) == dump(slow.tree.root)
    assert {k: [dump(n) for n in v] for k, v in H.parse(page).index.items()} == {
        k: [dump(n) for n in v] for k, v in slow.tree.root.index.items()}


@pytest.mark.parametrize("page", ["<p><!-- c --></p>", "a < b <p>", '<a href="?a&b">', "<a href=x>", "<script>'<p>'</script>", "<script>x", "<br/>"])
def test_other_markup_goes_through_the_parser(page):
    from kvadrat.functions import html as H

    assert H._plain_tree(page) is None and H.parse(page) is not None
