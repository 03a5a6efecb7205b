import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aerofolio.functions import html
from aerofolio.functions.html import Selector, plain_text, text_of
from aerofolio.operators import content as ct, corpus
from aerofolio.plans import catalog

SITE = "https://portal.example"
ENTRY = '<html><body><article><div class="x entry-content">{}</div></article></body></html>'


def pages(spark, *bodies, wrap=ENTRY):
    rows = [(i, f"u{i}", None if b is None else wrap.format(b) if wrap else b) for i, b in enumerate(bodies)]
    return ct.prepared(ct.extract(ct.parsed(spark.createDataFrame(rows, "page_id long, url string, html string"))), SITE)


def bodies(spark, *html):
    return [r.body for r in ct.with_markdown(pages(spark, *html), SITE).orderBy("page_id").collect()]


def rows(df):
    return [tuple(r) for r in df.orderBy("page_id", "pos").collect()]


def test_selectors_in_order(spark):
    inner = '<div class="entry-content">e</div>'
    got = pages(
        spark,
        f'{inner}<div data-elementor-type="wp-post">b</div><div data-elementor-type="wp-page">a</div>',
        f'{inner}<div data-elementor-type="wp-post">b</div>',
        f'<article>{inner}</article><main id="main"><div><p class="entry-content">m</p></div></main>',
        f'<article>{inner}</article>', inner, "<main>none</main>", None, wrap=None,
    )
    names = [r.matched_selector for r in got.orderBy("page_id").collect()]
    assert names == [*ct.SELECTORS, None, None]


def test_embeds(spark):
    html = (
        '<object class="tableauViz a"><param name="name" value="x"><param name="name" value="W/V"><param name="host_url" value="https%3A%2F%2Ft%2F"></object>'
        '<tableau-viz></tableau-viz><tableau-viz src="https://t/views/B/C?x"></tableau-viz><object class="tableauViz"></object>'
        '<iframe src="/pdfjs-viewer-shortcode?file=%2Fup%2Fa.pdf"></iframe><iframe></iframe><iframe src="x/y"></iframe><iframe src="https://o/" title="T"></iframe>'
        '<iframe src="/pdfjs-viewer-shortcode?file=/up/"></iframe>'
    )
    assert rows(ct.embed_rows(pages(spark, html))) == [
        (0, 0, "pdf", "Open the PDF: a.pdf", SITE + "/up/a.pdf"),
        (0, 1, "frame", "Open the embedded content", SITE + "/x/y"),
        (0, 2, "frame", "T", "https://o/"),
        (0, 3, "pdf", "Open the PDF: Open PDF", SITE + "/up/"),
        (0, 4, "dashboard", "Open the interactive dashboard: dashboard", ""),
        (0, 5, "dashboard", "Open the interactive dashboard: B / C", "https://t/views/B/C?x"),
        (0, 6, "legacy_dashboard", "Open the interactive dashboard: W / V", "https://t/views/W/V"),
    ]


FLIP = '<div data-widget_type="flip-box.default">{}</div>'


def test_widgets(spark):
    html = (
        FLIP.format('<p class="elementor-flip-box__layer__description">D <b>d</b></p><h3 class="elementor-flip-box__layer__title"> T </h3>'
                    '<a class="b elementor-flip-box__back" href="/go">x</a><div class="elementor-flip-box__image"><img alt="A" src="i.png"></div>')
        + '<div data-widget_type="divider.default">noise <a href="/n">n</a></div>' + FLIP.format("")
        + '<div data-widget_type="button.default"><a href="/b"> </a></div><div data-widget_type="button.default"><a><i>Go</i></a></div>'
        + '<div data-widget_type="button.default"><a> </a></div><div data-widget_type="button.default">none</div>'
    )
    assert [r[2:] for r in rows(ct.widget_rows(pages(spark, html)))] == [
        ("image", 0, "A", "i.png"), ("heading", 3, "T", "/go"), ("paragraph", 0, "D d", None), ("heading", 3, "Untitled", None),
        ("link", 0, "/b", "/b"), ("link", 0, "Go", ""), ("link", 0, "link", ""),
    ]


def test_images_and_collisions(spark):
    html = (
        '<img data-src="/a/p.png" src="data:x" alt="L"><img src="data:y"><img><img src="https://o/b/p.png"><noscript><img src="/no.png"></noscript>'
        '<a href="#pdfjs-viewer-skip"><img src="/no2.png"></a><div data-widget_type="spacer.default"><img src="/no3.png"></div>'
    )
    found = ct.image_rows(pages(spark, html), SITE)
    assert [r[2:] for r in rows(found)] == [(SITE + "/a/p.png", "p.png", "L"), ("https://o/b/p.png", "p.png", "")]
    assert [tuple(r) for r in ct.name_collisions(found).collect()] == [("p.png", 2)]


def test_links(spark):
    assert [r[2:] for r in rows(ct.link_rows(pages(spark, '<a href=" /x ">a <b>b</b></a><a>no</a><a href="">e</a>')))] == [("/x", "a b"), ("", "e")]


def test_pruning(spark):
    html = "<div><p> <span></span></p></div><p>text<em> </em></p><section><br></section><div><a></a></div><u>\n</u>"
    got = {r.tag: r.n_pruned for r in ct.prune_rows(pages(spark, html)).collect()}
    assert got == {"div": 1, "p": 1, "span": 1, "em": 1, "u": 1}


MARKDOWN = [
    ("<em>a <i>b</i></em>", "*a b*"),
    ("<b>a</b><strong> b </strong>c", "**a** **b** c"),
    ("x<b></b><i> </i>y", "x y"),
    ("<h2>A</h2>text<h3>B<br>b</h3>", "## A\n\ntext\n\n### B b"),
    ("<h1></h1><p>a<br>b</p>", "a\nb"),
    ("<ul><li>a<ul><li>b</ul><li><p>c</p></ul>", "- a\n  - b\n- c"),
    ("<ol><li>a</li><li>b</li></ol>", "1. a\n2. b"),
    ("<table><tr><th>a<th>b</tr><tr><td>1<td><p>2</p></tr></table>", "| a | b |\n| --- | --- |\n| 1 | 2 |"),
    ("<pre>a\n   b</pre>", "```\na\n   b\n```"),
    ("<blockquote><p>q</p></blockquote>z", "> q\n\nz"),
    ("a &amp; b &lt;c&gt; <u>_u_</u> *s*", "a & b <c> _u_ *s*"),
    ("<a href='/x'> y </a>, <a href='http://z'>http://z</a>, <a href='/q'></a>.", "[y](/x) , <http://z>, ."),
    ("<script>x</script><style>y</style><!-- c --><p>t</p><p><b>open<p>next", "t\n\n**open**\n\nnext"),
    ("<p>a<p data-x='>'>b", "a\n\nb"),
    ("<iframe src='/f' title='T'></iframe>", f"*{ct.FRAME_NOTE}*\n\n[T]({SITE}/f)"),
    ("<a href='#pdfjs-viewer-skip'>skip</a>", ""),
    # any depth of empty markup
    ("<p>x<b><i><a href='u'> </a></i></b>y</p>", "x y"),
    ("<p>x<b><i><s><b><em><a href='u'><del></del></a></em></b></s></i></b>y</p>", "xy"),
    ("<p>a <s></s><del> </del>b <s>c</s></p>", "a b ~~c~~"),
    ("<p>a<b> <i> <s> b</s> </i> </b>c</p>", "a ***~~b~~*** c"),
    # items of several lines
    ("<ul><li><p>one</p><p>two</p></li><li>three<br>four</li></ul><p>end</p>", "- one\n\n  two\n- three\n  four\n\nend"),
    ("<ol><li><strong>Add</strong><br>This ensures</li><li>b</li></ol>", "1. **Add**\n   This ensures\n2. b"),
    ("<ul><li>a<pre>x\n  y</pre></li><li>b</li></ul>", "- a\n\n  ```\n  x\n    y\n  ```\n- b"),
    ("<ul><li>a<ol><li>b<br>c</li></ol>tail</li></ul>", "- a\n  1. b\n     c\n  tail"),
    ("<ol start='9'><li>a</li><li>b<p>c</p></li></ol>", "9. a\n10. b\n\n    c"),
    ("<ul><li></li><li>b</li></ul>x", "-\n- b\n\nx"),
    # quotes
    ("<blockquote><p>a</p><p>b<br>c</p></blockquote>", "> a\n>\n> b\n> c"),
    ("z<blockquote><h2>H</h2><ul><li>a<li>b</ul></blockquote><p>y", "z\n\n> ## H\n>\n> - a\n> - b\n\ny"),
    ("<blockquote>a<blockquote>b</blockquote>c</blockquote>", "> a\n>\n> > b\n>\n> c"),
    ("<ul><li>a<blockquote>q<br>r</blockquote></li></ul>", "- a\n\n  > q\n  > r"),
    # tables and links
    ("<table><tr><th colspan=2>a</tr><tr><td>1<td>2</tr></table>", "| a | |\n| --- | --- |\n| 1 | 2 |"),
    ("<a href='/x' title='T \"q\"'>y</a> <a href='/z' title='T'>/z</a>", '[y](/x "T \\"q\\"") [/z](/z "T")'),
]


def test_markdown(spark):
    got = bodies(spark, *[html for html, _ in MARKDOWN])
    for (html, want), body in zip(MARKDOWN, got):
        assert body == want, html


#: Untidy markup, and the tree that the exporter's parser builds of it, shown by what it becomes.
UNTIDY = [
    # a paragraph ends bold, italics and the like before it, and they are not opened again
    ("<b>one<p>two</b>three</p>", "**one**\n\ntwothree"),
    ("<p>a<b>x<p>y</b>z", "a**x**\n\nyz"),
    ("<i>one<p>two</i></p>three", "*one*\n\ntwo\n\nthree"),
    # other inline elements go around the paragraph, and end with it open
    ("<em><p>x</em>y</p>z", "*x*\n\nyz"),
    ("<span><p>x</span>y</p>z", "x\n\nyz"),
    # an end looks past lighter elements only
    ("<i>one<div>two</i>three</div>four</i>five", "*one\n\ntwothree\n\nfour*five"),
    ("<div>a</div></div><p>b</p></section></b>c", "a"),
    ("<div><p>a</section></b>b</div>c", "ab\n\nc"),
    # links
    ("<a href=/1>x<a href=/2>y</a> z", "[x](/1)[y](/2) z"),
    ("<p><a href=/1>x<p>y</a>", "[x\n\ny](/1)"),
    ("<div><a href=/1>x</div>y", "[x](/1)\n\ny"),
    # lists, cells and headings left open
    ("<ul><li>a<p>b<li>c</ul>d", "- a\n\n  b\n- c\n\nd"),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>d", "- a\n  - b\n- c\n\nd"),
    ("<table><tr><td><b>a<td>b<tr><td>c<td>d</table>e", "| **a** | b |\n| --- | --- |\n| c | d |\n\ne"),
    # blocks without anything are no breaks; what holds a line break is
    ("a<p></p>b<div> <span></span><section></section></div>c", "ab c"),
    ("a<p><br></p>b", "a\n\nb"),
    ("<h2>A<p>b", "## A\n\nb"),
    ("<p>a<h2>B</h2>c", "a\n\n## B\n\nc"),
    ("<p>a</p></p>b", "a\n\nb"),
    ("<p>a<section>b</section>c</p>d", "a\n\nb\n\nc\n\nd"),
    # text within a table but in no cell stays where it stands
    ("<table>t<tr><td>a</td></tr></table>", "t\n| a |\n| --- |"),
]


def test_untidy_markup(spark):
    got = bodies(spark, *[html for html, _ in UNTIDY])
    wrong = [(html, want, body) for (html, want), body in zip(UNTIDY, got) if body != want]
    assert not wrong


SELECTED = [
    ("div p", "<p>0</p><div><em><p>1</p></em></div>", "1"),
    ("div > p", "<div><em><p>0</p></em><p>1</p></div>", "1"),
    ("div>em>p, h1", "<div><p>0</p><em><p>1</p></em></div><h1>2</h1>", "1"),
    ("h1, div em p", "<p>0</p><h1>1</h1><div><em><p>2</p></em></div>", "1"),
    ("em div p", "<div><em><p>0</p></em></div><em><div><p>1</p></div></em>", "1"),
    ("#a.b.c", "<p id=a class=b>0</p><p id=a class='c x b'>1</p>", "1"),
    ("*[lang] [data-k='v w']", "<p data-k='v w'>0</p><div lang><p data-k=v>0</p><p data-k='v w'>1</p></div>", "1"),
    (".x .x .y", "<div class=x><p class=y>0</p><div class=x><p class=y>1</p></div></div>", "1"),
    ("DIV.x", "<div class=X>0</div><DIV class=x>1</DIV>", "1"),
    ("article .none", "<article><p class=nones>0</p></article>", None),
]


def test_selectors_as_text(spark):
    for selector, html, want in SELECTED:
        df = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
        got = ct.extract(ct.parsed(df, selectors=["h9", selector]), ["h9", selector]).select("matched_selector", text_of(F.col("content")).alias("t")).first()
        assert tuple(got) == ((selector, want) if want else (None, None)), selector


@pytest.mark.parametrize("text", ["", "> p", "a +b", "a[", "p:first", "a,,b"])
def test_what_is_no_selector_is_refused(text):
    with pytest.raises(ValueError):
        Selector(text)


def test_wide_and_deep_pages_are_whole(spark):
    wide = "".join(f"<p>line {i}</p>" for i in range(5000))
    deep = "<div>" * 300 + "core" + "</div>" * 300
    got = bodies(spark, wide, deep)
    assert got[0].split("\n\n") == [f"line {i}" for i in range(5000)]
    assert got[1] == "core"


def test_placeholder(spark):
    df = spark.createDataFrame([(1, None), (2, " \n "), (3, "x")], "id int, body string")
    got = corpus.with_placeholder(df, "body", F.lit("notice")).orderBy("id").collect()
    assert [(r.body, r.note) for r in got] == [("notice", "no content container found"), ("notice", "empty document"), ("x", None)]


def test_plain_title(one):
    assert one(corpus.plain_title, "A &amp;<b> B</b> \n &#8211; C") == "A & B – C"
    assert one(plain_text, "x<script>y</script>") == "x"


def test_events_are_handed_on_in_bounded_parts():
    """Whatever the pages of a batch hold, a task keeps a bounded number of events; parts have all pages in order, null ones too."""
    page = "<p>" + "<b>x</b>" * 100 + "</p>"
    batch = pa.array([None] + [page, None, "", "<i>y"] * 200 + [None] * 3)
    parts = list(html.event_parser().func(iter([batch, batch.slice(0, 2), batch.slice(0, 0)])))
    assert len(parts) > 2 and max(len(p.flatten()) for p in parts) < html.HELD + 302
    got = [events for p in parts for events in p.to_pylist()]
    want = {None: 0, page: 302, "": 0, "<i>y": 3}
    given = batch.to_pylist() + batch.to_pylist()[:2]
    assert [None if events is None else len(events) for events in got] == [None if h is None else want[h] for h in given]
    assert all([e["i"] for e in events] == list(range(len(events))) and all(events[e["j"]]["j"] == e["i"] for e in events) for events in got if events)


@pytest.mark.parametrize("name", ["p85_nested_emphasis", "p86_markdown_blocks", "p86_untidy_markup"])
def test_rows_of_one_row_group_are_dealt_to_all_slots(spark, tmp_path, name):
    rows = [(i, f"n{i}", "b", "t", 1) for i in range(64)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    got = catalog.QUERIES[name](spark, str(tmp_path))
    sizes = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert got.count() == 64 and len(sizes) >= 4 * spark.sparkContext.defaultParallelism and max(r["count"] for r in sizes) <= 8
