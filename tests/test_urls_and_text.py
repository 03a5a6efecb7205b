from urllib.parse import urljoin, urlsplit

import pytest
from pyspark.sql import functions as F

from aerofolio.functions import text as tx, urls

SITE = "https://portal.example"
URLS = [
    "/news/#x", "/", "?a=1", "#top", "mailto:x@y", "//h/x", "https://s.example/p/?q=1#f", "foo/bar", "", "javascript:void(0)",
    "a b", "http://h/p?bad=|x", "HTTP://H.example:80/A//B/", "/a/../b/./c", "../x", "x/..", "./", "///x", "1http://x", "https:foo",
    "a//b/c", "/a//b/../c", "?x=1#y?z", "http://h?x#y",
]


@pytest.mark.parametrize("url", URLS)
def test_split_matches_the_standard_library(one, url):
    got = one(lambda c: F.array(urls.host(c), urls.path(c), urls.query(c), urls.fragment(c)), url)
    want = urlsplit(url)
    assert got == [want.netloc, want.path, want.query, want.fragment]


@pytest.mark.parametrize("url", [u for u in URLS if u not in ("///x",)])
def test_absolutise_matches_the_standard_join(one, url):
    want = url if "://" in url else urljoin(SITE, url)
    assert one(lambda c: urls.absolutise(SITE, c), url) == want


@pytest.mark.parametrize("url,key", [("/a/b//", "/a/b"), ("https://h", "/"), ("https://h/", "/"), ("?x=1", "/"), ("/x?y#z", "/x")])
def test_path_key(one, url, key):
    assert one(urls.path_key, url) == key


@pytest.mark.parametrize("href,ok", [("", False), ("#a", False), ("mailto:a@b", False), ("tel:1", False), ("/x", True), ("x#y", True)])
def test_eligible(one, href, ok):
    assert one(urls.eligible, href) is ok


@pytest.mark.parametrize("url,inside", [("/x", True), ("#x", False), ("https://s.example/x", True), ("https://o.example", False), ("mailto:a", True)])
def test_internal(one, url, inside):
    assert one(lambda c: urls.internal(c, ["s.example"]), url) is inside


@pytest.mark.parametrize("raw,want", [("a+b%20c", "a+b c"), ("100%zz%41", "100%zzA"), ("%C3%A9", "é"), ("", "")])
def test_unquote(one, raw, want):
    assert one(urls.unquote, raw) == want


@pytest.mark.parametrize("here,there,want", [
    ("pages/a", "pages/b", "b.md"), ("pages/a", "news/b", "../news/b.md"), ("index", "pages/b", "pages/b.md"),
    ("a/b/c", "x/y", "../../x/y.md"), ("pages/a", "index", "../index.md"), ("index", "other", "other.md"),
])
def test_relative(one, here, there, want):
    assert one(urls.relative, here, there) == want


@pytest.mark.parametrize("src,want", [
    ("/v?file=%2Fup%2Fa.pdf&x=1", SITE + "/up/a.pdf"), ("/v?x=1", "/v?x=1"), ("/v?file=", "/v?file="),
    ("/v?file=&file=b+c.pdf", "b c.pdf"), ("/v?file=https%3A%2F%2Fo%2Fa%2Bb.pdf#p", "https://o/a+b.pdf"), ("/v?nofile=a", "/v?nofile=a"),
])
def test_pdf_target(one, src, want):
    assert one(lambda c: urls.pdf_target(c, SITE), src) == want


@pytest.mark.parametrize("url,want", [
    ("https://t/views/Book/View?x=1", "Book / View"), ("https://t/views/Only", "Only"), ("https://t/views/", "dashboard"), ("", "dashboard"),
    ("https://t/a//b/views/c", "b / c"),
])
def test_dashboard_label(one, url, want):
    assert one(urls.dashboard_label, url) == want


@pytest.mark.parametrize("host,name,want", [
    ("https%3A%2F%2Ft%2F", "W/V", "https://t/views/W/V"), ("", "W", None), ("https%3A%2F%2Ft", "", None), ("a+b%zz/", "n", "a+b%zz/views/n"),
])
def test_legacy_dashboard(one, host, name, want):
    assert one(urls.legacy_dashboard_url, host, name) == want


@pytest.mark.parametrize("url,want", [
    ("https://h/a/b%20c.png?x", "b_c.png"), ("https://h/a/", "image.png"), ("/x/é!.png", "_.png"), ("https://h", "image.png"),
])
def test_asset_name(one, url, want):
    assert one(urls.asset_name, url) == want


@pytest.mark.parametrize("href,want", [
    ("a.PDF", "pdf"), ("https://p.example/x.pdf?y", "pdf"), ("mailto:a@b", "none"), ("https://o.example/", "external"), ("#x", "none"),
    ("", "none"), ("https://P.example:443/x", "same_site"), ("//o.example/x", "external"), ("sub/x", "same_site"), ("http://p.example/x", "same_site"),
])
def test_link_class(one, href, want):
    assert one(lambda c: urls.link_class(c, F.lit("https://p.example/page")), href) == want


@pytest.mark.parametrize("raw,want", [
    ("a  \nb", "a\nb"), ("a\n\n\n\nb", "a\n\nb"), ("a \nb", "a \nb"), ("  a\x1f", "a"), ("a\t\n \n\n\nb", "a\n\nb"),
])
def test_clean_markdown(one, raw, want):
    assert one(tx.clean_markdown, raw) == want


@pytest.mark.parametrize("raw,want", [
    ("# a\n### b", "## a\n#### b"), ("### a\n#### b", "## a\n### b"), ("no heading", "no heading"), ("## a", "## a"),
    ("# a\n###### b", "## a\n###### b"), ("```\n# code\n```\n## b", "```\n## code\n```\n### b"), ("#x\n### y", "#x\n## y"), ("#  x\n### y", "#  x\n## y"),
    ("#  x\n### y", "#  x\n## y"),
])
def test_normalise_headings(one, raw, want):
    got = one(tx.normalise_headings, raw)
    assert got == want
    assert one(tx.normalise_headings, got) == got


def test_upsert_block(one):
    def put(text, block="<s>new<e>"):
        return one(lambda t, b: tx.upsert_block(t, b, "<s>", "<e>"), text, block)

    assert put("a<s>old<e>z") == "a<s>new<e>z"
    assert put("text \n\n") == "text\n\n<s>new<e>\n"
    assert put("only <s> start") == "only <s> start\n\n<s>new<e>\n"
    # the end marker stands only before the start marker: what follows the start marker is lost
    assert put("a<e>b<s>c") == "a<e>b<s>new<e>"
    for text in ("a<s>old<e>z", "plain", ""):
        assert put(put(text)) == put(text)


def test_render_document(one):
    page = one(lambda t, u: tx.render_document(t, u, F.lit("post"), F.lit("2024-01-02T03"), F.lit("body")), "T", "u")
    assert page == "# T\n\n*Published: 2024-01-02*  \n*Source: [u](u)*\n\nbody\n"
