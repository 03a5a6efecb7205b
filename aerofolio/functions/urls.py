"""URL expressions, all JVM-side. ``parse_url`` is not used: it throws under ANSI mode on
URLs the portal's pages do contain."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .html import let
from .text import blank_to_null, strip

# Fixed value: the generic URL split of RFC 3986, appendix B (authority, path, query, fragment).
PARTS = r"(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
# Links that are never rewritten.
INELIGIBLE = r"^(?:#|mailto:|tel:)"


def host(url: Column) -> Column:
    return F.regexp_extract(url, PARTS, 1)


def path(url: Column) -> Column:
    return F.regexp_extract(url, PARTS, 2)


def query(url: Column) -> Column:
    return F.regexp_extract(url, PARTS, 3)


def fragment(url: Column) -> Column:
    return F.regexp_extract(url, PARTS, 4)


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, SCHEME, 1))


def path_key(url: Column) -> Column:
    """The path without trailing slashes, ``/`` for the front page."""
    return F.coalesce(blank_to_null(F.rtrim(path(url), F.lit("/"))), F.lit("/"))


def eligible(href: Column) -> Column:
    """P12, on the stripped href."""
    return (href != "") & ~href.rlike(INELIGIBLE)


def internal(url: Column, internal_hosts: list[str] | Column) -> Column:
    """P13. ``internal_hosts`` is a list, or an array column when each row has its own site."""
    if isinstance(internal_hosts, Column):
        known = F.array_contains(internal_hosts, host(url))
    else:
        known = host(url).isin(internal_hosts)
    return known | ((host(url) == "") & ~url.startswith("#"))


def unquote(text: Column) -> Column:
    """Percent-decoding that keeps ``+`` and leaves malformed escapes as they are."""
    safe = F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(F.replace(safe, F.lit("+"), F.lit("%2B"))), text)


def docname(kind: Column, slug: Column, date: Column) -> Column:
    """``pages/slug`` or ``news/date-slug``."""
    return F.when(kind == "page", F.concat(F.lit("pages/"), slug)).otherwise(
        F.concat(F.lit("news/"), F.substring(date, 1, 10), F.lit("-"), slug)
    )


def folder(name: Column) -> Column:
    """Everything before the last slash, or blank."""
    return F.when(name.contains("/"), F.regexp_replace(name, r"/[^/]*\z", "")).otherwise(F.lit(""))


def relative(source: Column, target: Column) -> Column:
    """Relative file path from one document name to another."""
    here = folder(source)
    up = F.when(here == "", F.lit("")).otherwise(F.repeat(F.lit("../"), F.size(F.split(here, "/"))))
    leaf = F.concat(F.substring_index(target, "/", -1), F.lit(".md"))
    return F.when(here == folder(target), leaf).otherwise(F.concat(up, target, F.lit(".md")))


def _without_dots(target: Column) -> Column:
    """A path as the standard join leaves it: rooted, dot segments resolved."""
    segments = F.split(target, "/")
    last = F.element_at(segments, -1)
    # inner blanks go from relative paths only
    inner = F.filter(F.slice(segments, 1, F.size(segments) - 1), lambda s: s != "")
    full = F.when(target.startswith("/"), segments).otherwise(F.concat(F.array(F.lit("")), inner, F.array(last)))
    kept = F.aggregate(
        full,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done)
        .otherwise(F.concat(done, F.array(s))),
    )
    joined = F.array_join(kept, "/")
    return F.concat(
        F.when(joined.startswith("/"), F.lit("")).otherwise(F.lit("/")),
        joined,
        F.when(last.isin(".", "..") & ~joined.endswith("/") & (joined != ""), F.lit("/")).otherwise(F.lit("")),
    )


def absolutise(site: Column | str, href: Column) -> Column:
    """Join ``href`` to a site given as ``scheme://host``; absolute URLs stay."""
    site = F.lit(site) if isinstance(site, str) else site

    def join(local: Column) -> Column:
        target = path(local)
        dotted = target.rlike(r"(^|/)\.\.?(/|$)") | target.contains("//") | ~target.startswith("/")
        whole = F.when(target == "", F.lit("")).when(dotted, _without_dots(target)).otherwise(target)
        return F.when(host(local) != "", F.concat(scheme(site), F.lit(":"), local)).otherwise(
            F.concat(site, whole, F.regexp_extract(local, r"(?s)^[^?#]*(.*)$", 1))
        )

    same = (scheme(href) == scheme(site)) & (host(href) == "")
    return (
        F.when(href == "", site)
        .when(href.contains("://"), href)
        .when((scheme(href) != "") & ~same, href)
        .otherwise(let(F.when(same, F.regexp_replace(href, SCHEME, "")).otherwise(href), join))
    )


def query_parameter(url: Column, name: str) -> Column:
    """First non-blank value of a query parameter, decoded (``+`` is a space); else null."""
    raw = blank_to_null(F.regexp_extract(query(url), rf"(?:^|&){name}=([^&]+)", 1))
    return unquote(F.replace(raw, F.lit("+"), F.lit(" ")))


def pdf_target(src: Column, site: Column | str, name: str = "file") -> Column:
    """P25: the document behind a PDF viewer's URL."""
    site = F.lit(site) if isinstance(site, str) else site
    target = query_parameter(src, name)
    return F.coalesce(F.when(target.startswith("/"), F.concat(site, target)).otherwise(target), src)


def dashboard_label(url: Column) -> Column:
    """``workbook / view`` out of a dashboard path."""
    parts = F.filter(F.split(path(url), "/"), lambda p: (p != "") & (p != "views"))
    last, before = F.try_element_at(parts, F.lit(-1)), F.try_element_at(parts, F.lit(-2))
    return F.coalesce(F.concat(before, F.lit(" / "), last), last, F.lit("dashboard"))


def legacy_dashboard_url(host_url: Column, name: Column) -> Column:
    """View URL of an old-style embed; null when either part is blank."""
    base = blank_to_null(F.rtrim(unquote(F.coalesce(host_url, F.lit(""))), F.lit("/")))
    return F.concat(base, F.lit("/views/"), blank_to_null(name))


# What may stand in an image's file name, and the name of an image without one.
ASSET_OTHER, ASSET_DEFAULT = r"[^A-Za-z0-9._-]+", "image.png"


def asset_name(url: Column) -> Column:
    """File name for an image URL."""
    leaf = unquote(F.substring_index(path(url), "/", -1))
    return F.coalesce(blank_to_null(F.regexp_replace(leaf, ASSET_OTHER, "_")), F.lit(ASSET_DEFAULT))


def browser_host(url: Column) -> Column:
    """Host as a browser compares it: lower case, no user, no default port."""
    bare = F.lower(F.regexp_replace(host(url), r"^.*@", ""))
    return (
        F.when(scheme(url) == "http", F.regexp_replace(bare, r":80$", ""))
        .when(scheme(url) == "https", F.regexp_replace(bare, r":443$", ""))
        .otherwise(bare)
    )


def link_class(href: Column, page_url: Column) -> Column:
    """None / pdf / external / same-site, as the portal's browser script tells them apart."""
    bare = strip(href)
    own = scheme(bare)
    full = F.when(own != "", bare).when(
        bare.startswith("//"), F.concat(scheme(page_url), F.lit(":"), bare)
    )
    web = (own == "") | own.isin("http", "https")
    away = (own != "") | bare.startswith("//")
    return (
        F.when(bare.isNull() | (bare == "") | bare.startswith("#"), F.lit("none"))
        .when(F.lower(path(bare)).endswith(".pdf"), F.lit("pdf"))
        .when(~web, F.lit("none"))
        .when(away & (browser_host(full) != browser_host(page_url)), F.lit("external"))
        .otherwise(F.lit("same_site"))
    )
