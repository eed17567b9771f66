"""URL rules as column expressions.

URLs are split with the generic URI regex of RFC 3986 (appendix B), which both Spark and
DuckDB evaluate, instead of ``parse_url`` (which rejects many real-world hrefs).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kvadrat import schema as S
from kvadrat.functions.text import _col, let, strip

URI = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?"


def uri_part(c: Column, part: str) -> Column:
    group = {"scheme": 2, "netloc": 4, "path": 5, "query": 7, "fragment": 9}[part]
    return F.regexp_extract(c, URI, group)


def comparable_url(c: Column | str, default_netloc: str = S.BASE_NETLOC) -> Column:
    """Https, host (default when absent), path with exactly one trailing '/', no
    query or fragment; '' for a missing or empty value."""
    def body(u: Column) -> Column:
        netloc = uri_part(u, "netloc")
        path = F.regexp_replace(uri_part(u, "path"), "/+$", "")
        out = F.concat(F.lit("https://"), F.when(netloc == "", F.lit(default_netloc)).otherwise(netloc), path, F.lit("/"))
        return F.when(u.isNull() | (u == ""), F.lit("")).otherwise(out)

    return let(strip(_col(c)), body)


def canonicalize_url(
    c: Column | str,
    netloc: str | None = S.BASE_NETLOC,
    path_pattern: str = S.LISTING_PATH_PATTERN,
    base_netloc: str | Column = S.BASE_NETLOC,
) -> Column:
    """Resolve against the base host, reject other hosts, require the listing path
    rule, force one trailing '/', drop query and fragment; null when rejected.

    ``netloc=None`` keeps each URL's own host (used to run the rule on arbitrary pages)."""
    base = F.lit(base_netloc) if isinstance(base_netloc, str) else base_netloc
    parts = F.struct(
        *[F.regexp_extract(strip(_col(c)), URI, g).alias(n) for n, g in [("scheme", 2), ("netloc", 4), ("path", 5)]],
        strip(_col(c)).alias("u"),
    )
    return let(parts, lambda p: _canonical(p, netloc, path_pattern, base))


def _canonical(p: Column, netloc: str | None, path_pattern: str, base: Column) -> Column:
    u, scheme, host, path = p["u"], p["scheme"], p["netloc"], p["path"]
    resolved_host = F.when(host != "", host).when(scheme == "", base).otherwise(F.lit(""))
    resolved_path = F.when((scheme == "") & (host == "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
    final_path = F.when(resolved_path.endswith("/"), resolved_path).otherwise(F.concat(resolved_path, F.lit("/")))
    ok = resolved_path.rlike(path_pattern)
    if netloc is not None:
        ok = ok & ((resolved_host == "") | (resolved_host == netloc))
        out_host = F.lit(netloc)
    else:
        ok = ok & (resolved_host != "")
        out_host = resolved_host
    return F.when(u.isNotNull() & (u != "") & ok, F.concat(F.lit("https://"), out_host, final_path))


def strip_page_suffix(c: Column | str) -> Column:
    """One trailing '/', then drop a final 'stranica/N/'."""
    base = F.concat(F.regexp_replace(_col(c), "/+$", ""), F.lit("/"))
    return F.regexp_replace(base, r"stranica/\d+/?$", "")


def build_page_url(c: Column | str, page: Column | str | int) -> Column:
    """Page 1 is the clean base; page n appends 'stranica/n/' relative to it."""
    p = F.lit(page) if isinstance(page, int) else _col(page)
    clean = strip_page_suffix(c)
    directory = F.regexp_replace(clean, "[^/]*$", "")
    return F.when(p == 1, clean).otherwise(F.concat(directory, F.lit("stranica/"), p.cast("string"), F.lit("/")))


def html_text(c: Column | str) -> Column:
    """Visible text of an HTML document for regex rules: script/style bodies and tags
    become spaces, whitespace runs collapse."""
    no_code = _col(c)
    for tag in ("script", "style", "template"):
        no_code = F.regexp_replace(no_code, rf"(?is)<{tag}\b.*?</{tag}\s*>", " ")
    no_tags = F.regexp_replace(no_code, r"(?s)<[^>]*>", " ")
    return F.trim(F.regexp_replace(no_tags, r"(?U)\s+", " "))


def total_count(text: Column | str, word: str = "oglasa") -> Column:
    """X19: '<number> <word>' (any case) as an integer; dots are thousands marks."""
    num = F.regexp_extract(_col(text), r"(?iU)([\d.]+)\s+" + word, 1)
    return F.replace(F.when(num != "", num), F.lit("."), F.lit("")).try_cast("bigint")


def page_count(
    total: Column | str, cap: int | None = None, page_size: int = S.PAGE_SIZE, unknown: int = S.DEFAULT_MAX_PAGES_PER_SOURCE
) -> Column:
    """Pages to visit: max(1, ceil(total / page_size)), no more than ``cap`` if one is
    given; of a source whose total is unknown, ``cap`` or else ``unknown`` pages are tried."""
    t = _col(total)
    pages = F.greatest(F.lit(1), F.ceil(t / F.lit(float(page_size))).cast("int"))
    if cap is None:
        return F.when(t.isNull(), F.lit(unknown)).otherwise(pages)
    return F.when(t.isNull(), F.lit(cap)).otherwise(F.least(pages, F.lit(cap)))
