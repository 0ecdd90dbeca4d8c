"""Frontier, link discovery and page content over stored pages.

A site is data: one profile row per source host says how to find links, which
URLs are detail pages, and which selectors hold the title and the content.
Link extraction of the plain ``a[href]`` form, URL canonicalisation, the
same-site and detail-path rules, first-occurrence and the per-index cap are
native expressions; selector-based title/content/link forms run in one
``mapInPandas`` or ``mapInArrow`` pass per page (no group is ever gathered).
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urljoin, urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from lodestar.constants import MAX_LINKS_PER_INDEX, MIN_CONTENT_CHARS

HOST_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^@/?#]*@)?([^/?#:]+)"
PATH_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
# The first attribute named href of an anchor tag, its value quoted or not;
# other attributes are skipped whole, so ``data-href`` is no href.
HREF_RE = (r"(?i)<a(?:\s+[^\s=>\"'/]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?)*?"
           r"\s+href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
# What holds no links: comments, scripts and styles.
DEAD_RE = r"(?is)<!--.*?-->|<script[\s>].*?</script\s*>|<style[\s>].*?</style\s*>"

# Defaults of a site profile, made for plain article pages.  What a real site
# needs is data: one profile row per host, supplied by the user.
GENERIC_CATEGORIES = ["scholarships", "fellowships", "internships", "grants"]
GENERIC_INDEX_PAGES = 2
EXCLUDED_PREFIXES = ["category", "tag", "page", "author", "about", "contact", "privacy", "search", "feed"]
TITLE_SELECTORS = ["article h1", "h1"]
CONTENT_SELECTORS = ["article"]
STRIP_SELECTORS = ["script", "style", "nav", "footer", "form", "iframe", ".ad"]
FALLBACK_SELECTORS = ["main", "body"]
FALLBACK_STRIP = STRIP_SELECTORS

_TEXTS = "array<string>"
# Profile columns and what a missing column or value means.
PROFILE_DEFAULTS = {
    "base_url": ("string", None), "domain": ("string", None), "categories": (_TEXTS, None), "index_pages": ("int", GENERIC_INDEX_PAGES),
    "page_form": ("string", "folder"), "link_rule": ("string", "any"), "link_arg": ("string", None), "canonical": ("string", "drop_ref"),
    "detail_rule": ("string", "single_segment"), "excluded_prefixes": (_TEXTS, EXCLUDED_PREFIXES), "max_links": ("int", MAX_LINKS_PER_INDEX),
    "title_scope": ("string", None), "title_selectors": (_TEXTS, TITLE_SELECTORS), "content_selectors": (_TEXTS, CONTENT_SELECTORS),
    "strip_selectors": (_TEXTS, STRIP_SELECTORS), "fallback_selectors": (_TEXTS, FALLBACK_SELECTORS), "fallback_strip": (_TEXTS, FALLBACK_STRIP),
}


def with_defaults(profiles: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Profiles with every profile column; ``domain`` is the host if none is given."""
    return profiles.select("source_site", *_defaulted(profiles, cols or list(PROFILE_DEFAULTS)))


def host(url) -> Column:
    u = F.col(url) if isinstance(url, str) else url
    return F.lower(F.regexp_extract(u, HOST_RE, 1))


def path(url) -> Column:
    u = F.col(url) if isinstance(url, str) else url
    return F.regexp_extract(u, PATH_RE, 1)


def site_profiles(pages: DataFrame) -> DataFrame:
    """One generic profile per source host found in ``pages``."""
    found = (pages.select(host("url").alias("source_site"), F.regexp_extract("url", r"^([A-Za-z]+)://", 1).alias("scheme"))
             .groupBy("source_site").agg(F.min("scheme").alias("scheme"))
             .select("source_site", F.concat("scheme", F.lit("://"), "source_site").alias("base_url"),
                     F.array(*[F.lit(f"/category/{c}/") for c in GENERIC_CATEGORIES]).alias("categories")))
    return with_defaults(found)


def seed_urls(profiles: DataFrame) -> DataFrame:
    """H1: the index pages of every category path.  Page 1 is the path itself;
    a later page N is, by ``page_form``: ``folder`` path + page/N/, ``plain``
    path + /page/N, ``query`` path + ?page=N."""
    c = with_defaults(profiles, ["base_url", "index_pages", "categories", "page_form"]).select(
        "source_site", "base_url", "index_pages", "page_form", F.posexplode("categories").alias("cat_pos", "category"))
    c = c.withColumn("cat_pos", F.col("cat_pos").cast("bigint"))
    p = c.select("*", F.explode(F.sequence(F.lit(1), F.col("index_pages").cast("bigint"))).alias("page_no"))
    first, n = F.concat("base_url", "category"), F.col("page_no").cast("string")
    bare = F.rtrim(first, F.lit("/"))
    later = (F.when(F.col("page_form") == "query", F.concat(first, F.lit("?page="), n))
             .when(F.col("page_form") == "plain", F.concat(bare, F.lit("/page/"), n))
             .otherwise(F.concat(bare, F.lit("/page/"), n, F.lit("/"))))
    return p.select("source_site", "cat_pos", "page_no", F.when(F.col("page_no") == 1, first).otherwise(later).alias("url"))


def _decoded(value: Column) -> Column:
    """An attribute value: outer quotes off, the common entities decoded."""
    v = F.regexp_replace(value, r"^[\"']|[\"']$", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&#38;", "&"), ("&amp;", "&")):
        v = F.replace(v, F.lit(entity), F.lit(char))
    return v


def hrefs(html) -> Column:
    """H2 (``a[href]`` form): the hrefs of all anchors, in document order."""
    h = F.col(html) if isinstance(html, str) else html
    return F.transform(F.regexp_extract_all(F.regexp_replace(h, DEAD_RE, " "), F.lit(HREF_RE), F.lit(1)), _decoded)


def extract_links(pages: DataFrame) -> DataFrame:
    """H2 (``a[href]`` form): the page's columns but its html, with position
    and href of every link."""
    keep = [c for c in pages.columns if c != "html"]
    return (pages.select(*keep, F.posexplode(hrefs("html")).alias("position", "href"))
            .withColumn("position", F.col("position").cast("bigint")))


_FORBIDDEN_HOST = set(" \t\n\r#%/:<>?@[\\]^|")
_DEFAULT_PORT = {"http": 80, "https": 443}


def _resolve(base: str, href: str):
    """Absolute url as a WHATWG-style parser would serialise it: scheme and
    host lower-cased, default port dropped, empty path → '/', spaces and
    non-ASCII percent-encoded; unparsable input (bad host, bad port,
    non-http scheme) → None."""
    from urllib.parse import quote
    if href is None or base is None:
        return None
    try:
        u = urljoin(base, href.strip(" \t\n\r\f"))
        parts = urlsplit(u)
        scheme = parts.scheme.lower()
        host = parts.hostname
        if scheme not in ("http", "https") or not host or any(c in _FORBIDDEN_HOST for c in host):
            return None
        port = parts.port            # raises ValueError on a bad port
        netloc = host.lower() if port in (None, _DEFAULT_PORT[scheme]) else f"{host.lower()}:{port}"
        if parts.username is not None:
            cred = parts.username + (f":{parts.password}" if parts.password is not None else "")
            netloc = f"{cred}@{netloc}"
        path = quote(parts.path or "/", safe="/%:@!$&'()*+,;=-._~")
        query = quote(parts.query, safe="/%:@!$&'()*+,;=-._~?")
        frag = quote(parts.fragment, safe="/%:@!$&'()*+,;=-._~?#")
        out = f"{scheme}://{netloc}{path}"
        if "?" in u.split("#", 1)[0]:      # an empty query is kept as '?'
            out += f"?{query}"
        if "#" in u:
            out += f"#{frag}"
        return out
    except ValueError:
        return None


@pandas_udf(StringType())
def resolve_url_udf(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([_resolve(b, h) for b, h in zip(base, href)], dtype=object)


def resolve_url(links: DataFrame, base: str = "url", href: str = "href") -> DataFrame:
    """H3: absolute url from href + page url; malformed → row dropped."""
    return links.withColumn("link", resolve_url_udf(F.col(base), F.col(href))).where(F.col("link").isNotNull())


def canonical_drop_ref(u) -> Column:
    """H4 variant 1: delete every ``ref`` query parameter (fragment kept)."""
    u = F.col(u) if isinstance(u, str) else u
    fragment = F.regexp_extract(u, r"(#.*)$", 1)
    bare = F.regexp_replace(u, r"#.*$", "")
    kept = F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"),
                    lambda p: (F.substring_index(p, "=", 1) != "ref") & (p != ""))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.when(F.contains(bare, F.lit("?")), F.concat(F.substring_index(bare, "?", 1), query, fragment)).otherwise(u)


def canonical_drop_query(u) -> Column:
    """H4 variant 2: drop the whole query (fragment kept)."""
    u = F.col(u) if isinstance(u, str) else u
    return F.regexp_replace(u, r"\?[^#]*", "")


def canonical_trailing_slash(u) -> Column:
    """H4 variant 3: append '/' unless present."""
    u = F.col(u) if isinstance(u, str) else u
    return F.when(u.endswith("/"), u).otherwise(F.concat(u, F.lit("/")))


def same_site(u, domain) -> Column:
    """H5: host contains the domain (substring)."""
    d = F.col(domain) if isinstance(domain, str) else domain
    return F.contains(host(u), F.lower(d))


def detail_date_path(u) -> Column:
    """H6: …/yyyy/mm/dd/slug/ as the whole path, and nothing behind it."""
    u = F.col(u) if isinstance(u, str) else u
    return u.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/[0-9]{4}/[0-9]{2}/[0-9]{2}/[^/?#]+/?$")


def detail_numeric_path(u) -> Column:
    """H6: …/digits/slug/ as the whole path, and nothing behind it."""
    u = F.col(u) if isinstance(u, str) else u
    return u.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/[0-9]+/[^/?#]+/?$")


def detail_single_segment(u, excluded=EXCLUDED_PREFIXES) -> Column:
    """H6: one path segment that doesn't start with an excluded prefix."""
    segs = F.filter(F.split(path(u), "/"), lambda x: x != "")
    first = F.lower(F.get(segs, 0))
    prefixes = F.array(*[F.lit(x) for x in excluded]) if isinstance(excluded, list) else excluded
    return (F.size(segs) == 1) & ~F.exists(prefixes, lambda p: first.startswith(p))


def distinct_links(links: DataFrame, key: str = "page_id", link: str = "link") -> DataFrame:
    """H7: first occurrence of a url per index page (position kept)."""
    return links.groupBy(key, link).agg(F.min("position").alias("position"))


def cap_links(links: DataFrame, n: int | str = MAX_LINKS_PER_INDEX, key: str = "page_id") -> DataFrame:
    """H8: the first ``n`` links by position per index page (``n``: a number,
    or the column that holds it), with ``found`` counted before the cap."""
    # ``found`` is a partial-aggregated count per page; the cap is a pure
    # rank filter, which Spark pre-limits per map partition (WindowGroupLimit),
    # so even one enormous index page ships at most n rows per partition.
    found = links.groupBy(key).agg(F.count(F.lit(1)).alias("found"))
    w = Window.partitionBy(key).orderBy("position")
    top = links.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= (F.col(n) if isinstance(n, str) else n)).drop("_rn")
    return top.join(found, key)


def canonical(u, variant) -> Column:
    """H4 chosen per row by the profile's ``canonical`` column."""
    v = F.col(variant) if isinstance(variant, str) else variant
    return (F.when(v == "drop_query", canonical_drop_query(u))
            .when(v == "trailing_slash", canonical_trailing_slash(u))
            .when(v == "drop_ref", canonical_drop_ref(u))
            .otherwise(F.col(u) if isinstance(u, str) else u))


def is_detail(u, rule, excluded=EXCLUDED_PREFIXES) -> Column:
    """H6 chosen per row by the profile's ``detail_rule`` column."""
    r = F.col(rule) if isinstance(rule, str) else rule
    return (F.when(r == "date_path", detail_date_path(u))
            .when(r == "numeric_path", detail_numeric_path(u))
            .when(r == "single_segment", F.coalesce(detail_single_segment(u, excluded), F.lit(False)))
            .otherwise(F.lit(True)))


def detail_links(pages: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    """H2→H8 driven by the site profile of each page's host: links of the
    profile's form (``a[href]`` natively, selector forms in the parser pass),
    resolved, canonicalised, kept when on the profile's domain and a detail
    url, first occurrence per index page, capped at the profile's
    ``max_links`` (default 50) with ``found`` counted before the cap.  Pages
    of hosts without a profile take the defaults."""
    base = pages.select("page_id", "url", "html").withColumn("source_site", host("url"))
    cols = ["domain", "link_rule", "link_arg", "canonical", "detail_rule", "excluded_prefixes", "max_links"]
    if profiles is None:
        profiles = site_profiles(pages)
    prof = profiles.select("source_site", *[c for c in cols if c in profiles.columns])
    known = base.join(prof, "source_site", "left")
    every = known.select("page_id", "url", "html", *_defaulted(known, cols))
    native = extract_links(every.where(F.col("link_rule") == "any"))
    other = _selector_hrefs(every.where(F.col("link_rule") != "any"))
    raw = resolve_url(native.unionByName(other)).withColumn("link", canonical("link", "canonical"))
    keep = raw.where(same_site("link", F.col("domain")) & is_detail("link", "detail_rule", F.col("excluded_prefixes")))
    first = keep.groupBy("page_id", "link").agg(F.min("position").alias("position"), F.max("max_links").alias("max_links"))
    return cap_links(first, "max_links").drop("max_links")


def _defaulted(df: DataFrame, names: list[str]) -> list[Column]:
    out = []
    for name in names:
        kind, value = PROFILE_DEFAULTS[name]
        default = F.array(*[F.lit(x) for x in value]) if isinstance(value, list) else F.lit(value)
        default = F.col("source_site") if name == "domain" else default.cast(kind)
        out.append(F.coalesce(F.col(name).cast(kind), default).alias(name) if name in df.columns else default.alias(name))
    return out


def _link_pass(cols: list[str]):
    def run(it):
        from lodestar.functions import htmlparse as hp
        for pdf in it:
            rows, pos, found = [], [], []
            for row, (doc, rule, arg) in enumerate(zip(pdf["html"], pdf["link_rule"], pdf["link_arg"])):
                page = hp.Page(doc or "")
                got = (hp.heading_links(page, arg) if rule == "heading_link" else hp.links_under(page, arg) if rule == "under"
                       else hp.all_links(page))
                rows += [row] * len(got)
                pos += range(len(got))
                found += got
            out = pdf[cols].iloc[rows].reset_index(drop=True)
            yield out.assign(position=pd.Series(pos, dtype="int64"), href=pd.Series(found, dtype=object))
    return run


def _selector_hrefs(pages: DataFrame) -> DataFrame:
    """H2 (parser forms) of pages that carry ``link_rule`` and ``link_arg``."""
    cols = [c for c in pages.columns if c != "html"]
    schema = T.StructType([pages.schema[c] for c in cols] + [T.StructField("position", T.LongType()), T.StructField("href", T.StringType())])
    return pages.mapInPandas(_link_pass(cols), schema)


def selector_links(pages: DataFrame, profiles: DataFrame) -> DataFrame:
    """H2 (selector forms): per the page's site profile — ``heading_link``
    (anchors containing the heading, e.g. ``a:has(h3)``), ``under``
    (anchors inside a container selector, e.g. ``article.l-post h2``) or
    ``any`` (every ``a[href]``).  The profile table is one row per site."""
    prof = profiles.select("source_site", *[c for c in ("link_rule", "link_arg") if c in profiles.columns])
    p = pages.select("page_id", "html", host("url").alias("source_site")).join(prof, "source_site", "left")
    p = p.select("page_id", "html", *_defaulted(p, ["link_rule", "link_arg"]))
    return _selector_hrefs(p).select("page_id", "position", "href")


_CONTENT = ["title_scope", "title_selectors", "content_selectors", "strip_selectors", "fallback_selectors", "fallback_strip"]


RUN_BYTES = 1 << 22     # of markup read at a time; of the other pages of a batch a worker holds the Arrow bytes only


def _content_pass(isolate: bool):
    def read(html, arg, scope, title, content, strip, fallback, fallback_strip):
        from lodestar.functions import htmlparse as hp
        if isolate:     # a faulty profile fails every page alike, whatever the page holds
            for selector in [*filter(None, (scope, arg)), *title, *content, *strip, *fallback, *fallback_strip]:
                hp.check_selector(selector)
        page = hp.Page(html or "")
        return (hp.page_title(page, list(title), scope),
                hp.main_content(page, list(content), list(strip), list(fallback), list(fallback_strip)), page.error, None)

    def one(args):
        try:
            return read(*args)
        except Exception as e:
            if not isolate:
                raise
            return None, None, None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("html")), 0).to_numpy().astype(np.int64))
            lo = 0
            while lo < len(batch):
                hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + RUN_BYTES, side="right")))
                part = batch.slice(lo, hi - lo)
                rows = [one(args) for args in zip(*[part.column(c).to_pylist() for c in ("html", "link_arg", *_CONTENT)])]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), *[pa.array(c, pa.string()) for c in zip(*rows)]],
                                                 names=["page_id", "url", "title", "content", "parse_error", "failure"])
                lo = hi
    return run


def page_content(pages: DataFrame, profiles: DataFrame | None = None, isolate: bool = False) -> DataFrame:
    """(page_id, url, title, content, parse_error) by the profile of
    the page's host: the title of its title selectors (inside ``title_scope``
    first, if there is one), then og:title; the content of the first matching
    container with boilerplate cut out, else of the fallback containers.
    ``parse_error`` tells that the markup could not be read to its end.

    A page that raises (its profile holds a selector of an unknown form, say)
    ends the job; with ``isolate`` it is a row without title and content whose
    further column ``failure`` holds the error."""
    p = pages.select("page_id", "url", "html", host("url").alias("source_site"))
    cols = [*_CONTENT, "link_arg"]
    if profiles is not None:
        p = p.join(profiles.select("source_site", *[c for c in cols if c in profiles.columns]), "source_site", "left")
    out = p.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", *_defaulted(p, cols)).mapInArrow(
        _content_pass(isolate), "page_id long, url string, title string, content string, parse_error string, failure string")
    return out if isolate else out.drop("failure")


def text_length(html) -> Column:
    from lodestar.functions.text import js_trim
    h = F.col(html) if isinstance(html, str) else html
    return F.length(js_trim(F.regexp_replace(h, "<[^>]*>", "")))


def min_text(df: DataFrame, col: str = "content", n: int = MIN_CONTENT_CHARS) -> DataFrame:
    """Keep pages whose content, tags removed and trimmed, has ≥ 100 chars."""
    return df.where(text_length(col) >= n)


def scraped_pages(pages: DataFrame, as_of: str | None = None, profiles: DataFrame | None = None, isolate: bool = False) -> DataFrame:
    """S1 + H9–H12: the page records that enter extraction (page_id, url,
    title, content, parse_error, scraped_at); with ``isolate`` also the pages
    that raised, told by ``failure``."""
    from lodestar.constants import AS_OF
    from lodestar.sources.views import as_of_ts
    c = page_content(pages, profiles, isolate)
    whole = F.col("title").isNotNull() & F.col("content").isNotNull() & (text_length("content") >= MIN_CONTENT_CHARS)
    c = c.where(whole | F.col("failure").isNotNull() if isolate else whole)
    return c.withColumn("scraped_at", as_of_ts(as_of or AS_OF))


def run_status(found_errors: Column, scraped: Column) -> Column:
    return (F.when((found_errors > 0) & (scraped > 0), "partial")
            .when(found_errors > 0, "failed").otherwise("success"))


def scrape_stats(pages: DataFrame, kept: DataFrame | None = None, profiles: DataFrame | None = None) -> DataFrame:
    """Per source host — found (detail links before the cap, one number
    per index page), scraped (pages kept), errors (pages without html, and
    pages whose markup could not be read to its end) and the run status.
    ``kept`` may pass the already computed S1 records so pages are parsed once."""
    site = host("url").alias("source_site")
    base = pages.select("page_id", "url", "html")
    links = detail_links(base, profiles)
    per_page = links.groupBy("page_id").agg(F.max("found").alias("found"))
    found = base.select("page_id", site).join(per_page, "page_id").groupBy("source_site").agg(F.sum("found").alias("found"))
    rows = kept if kept is not None else scraped_pages(base, None, profiles)
    scraped = rows.groupBy(site).agg(F.count(F.lit(1)).alias("scraped"), F.count("parse_error").alias("broken"))
    errs = base.groupBy(site).agg(F.count_if(F.col("html").isNull() | (F.length("html") == 0)).alias("empty"))
    out = errs.join(found, "source_site", "left").join(scraped, "source_site", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    out = out.select("source_site", zero("found").alias("found"), zero("scraped").alias("scraped"),
                     (F.col("empty") + zero("broken")).alias("errors"))
    return out.withColumn("status", run_status(F.col("errors"), F.col("scraped")))
