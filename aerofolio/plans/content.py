"""Page-content queries. The given pages carry few constructs, so most queries run on pages derived
from them in Spark: each derived page is written around the given page's own URL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text as tx, urls
from ..functions.html import first, inside, is_open, let, text_of
from ..operators import content as ct, corpus, links as lk
from ..session import dealt, settle, spread
from ..sources.files import table
from .base import query
from .portal import DOCS, PARTS, SITE, as_docs, page_docs

ARTICLE = ["article"]


def _decoded(x: str) -> str:
    for entity, c in (("&quot;", "chr(34)"), ("&#x27;", "chr(39)"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&amp;", "'&'")):
        x = f"replace({x}, '{entity}', {c})"
    return x


# ``head`` as an attribute has it, ``title`` as text; ``own`` are the article's blocks as Markdown
BASE = f"""base AS (SELECT *, trim(head, ' ' || chr(10) || chr(9) || chr(13)) AS title FROM (SELECT * EXCLUDE (html), {PARTS}, {_decoded("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")} AS head,
  list_filter(list_transform(regexp_extract_all(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '(?s)<(?:h1|p)>.*?(?:</h1>|</p>|<br>)', 0),
    lambda b: struct_pack(md := CASE WHEN b LIKE '<h1>%' THEN '## ' WHEN b LIKE '<p><b>%' THEN '**' ELSE '' END, tail := CASE WHEN b LIKE '<p><b>%' THEN '**' ELSE '' END,
      t := trim(regexp_replace({_decoded("regexp_replace(b, '<[^>]*>', '', 'g')")}, '[ \t\r\n]+', ' ', 'g')))), lambda x: x.t <> '') AS own FROM pages))"""


def derived(spark, d) -> DataFrame:
    """One page per given page, in the container its host ending calls for; some have none."""
    u = F.col("url")
    p, h = urls.path(u), urls.host(u)

    def c(*parts):
        return F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in parts])

    opening = (
        F.when(u.endswith("#top"), F.lit("<main><div>"))
        .when(h.endswith(".com"), F.lit('<section><div data-elementor-type="wp-page">'))
        .when(h.endswith(".net"), F.lit('<main id="main"><div class="entry-content">'))
        .otherwise(F.lit('<article><div class="a entry-content b">'))
    )
    # the given page's heading and article stand among the constructs
    head = F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1)
    own = F.regexp_extract("html", "(?s)<article>(.*)</article>", 1)
    body = c(
        '<h1>', head, '</h1><div> <span></span><p>', h, ' <b>bold <strong>in</strong> </b>end</p></div><style>x{}</style>',
        '<iframe src="/x/pdfjs-viewer-shortcode/v.html?file=', p, '.pdf&amp;z=1"></iframe><iframe></iframe>',
        '<iframe src="/embed', p, '" title="', head, '"></iframe><iframe src="https://', h, '/e"></iframe>',
        '<tableau-viz src="https://', h, '/views/Book', p, '"></tableau-viz>',
        '<object class="x tableauViz"><param name="host_url" value="https%3A%2F%2F', h, '%2F"><param name="name" value="W', p, '"></object>',
        '<object class="tableauViz"><param name="name" value="lost"></object>',
        '<div data-widget_type="spacer.default"><a href="/gone">gone</a><img src="/gone.png"></div>',
        '<div data-widget_type="flip-box.default"><div class="elementor-flip-box__image"><img src="/up', p, '.png"></div>',
        '<h3 class="elementor-flip-box__layer__title">', head, '</h3><a class="elementor-flip-box__back" href="', p,
        '"><div class="elementor-flip-box__layer__description">About ', h, '</div></a></div>',
        '<div data-widget_type="button.default"><a href="/go', p, '"><span>Push</span></a></div>',
        '<div data-widget_type="button.default"><span>no link</span></div>',
        '<p><a href="#pdfjs-viewer-skip">skip</a><img data-src="', u, '/pic.jpg" src="data:x" alt="', head, '"><img src="data:y"></p>',
        '<noscript><img src="/none.png"></noscript><img src="/a/', h, '/pic.jpg"><div class="own">', own, '</div>',
    )
    html = c("<html><body><nav><a href='/n'>n</a></nav>", opening, body, "</div></main></body></html>")
    return spread(table(spark, d, "pages").select("page_id", "url", "html")).select("page_id", "url", html.alias("html"))


def prepared(spark, d) -> DataFrame:
    return ct.prepared(ct.extract(ct.parsed(derived(spark, d))), SITE)


SELECTED = """CASE WHEN url LIKE '%#top' THEN NULL WHEN host LIKE '%.com' THEN 'div[data-elementor-type="wp-page"]'
  WHEN host LIKE '%.net' THEN 'main#main .entry-content' ELSE 'article .entry-content' END"""
KEPT = f"{BASE}, kept AS (SELECT * FROM base WHERE url NOT LIKE '%#top')"


@query("p80_content_selector", f"WITH {BASE} SELECT page_id, {SELECTED} AS matched_selector, CASE WHEN url NOT LIKE '%#top' THEN title END AS heading FROM base")
def p80(spark, d):
    """With the text of the first heading in the container."""
    found = ct.extract(ct.parsed(derived(spark, d)))
    content = F.col("content")
    heading = let(first(content, lambda e: is_open(e, "h1")), lambda h: F.when(h.isNotNull(), text_of(inside(content, h))))
    return found.select("page_id", "matched_selector", heading.alias("heading"))


@query("p80_content_article", r"""WITH t AS (SELECT page_id, string_split(regexp_replace(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<[^>]*>', chr(1), 'g'), chr(1)) AS parts FROM pages),
  s AS (SELECT page_id, array_to_string(list_filter(list_transform(parts, lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> ''), ' ') AS t FROM t)
  SELECT page_id, replace(replace(t, '&quot;', chr(34)), '&amp;', '&') AS content FROM s""")
def p80_article(spark, d):
    found = ct.extract(ct.parsed(spread(table(spark, d, "pages")), selectors=ARTICLE), ARTICLE)
    return found.select("page_id", text_of(F.col("content")).alias("content"))


@query("p81_embeds", f"""WITH {KEPT} SELECT page_id, pos, CASE pos WHEN 0 THEN 'pdf' WHEN 1 THEN 'frame' WHEN 2 THEN 'frame' WHEN 3 THEN 'dashboard' ELSE 'legacy_dashboard' END AS kind,
  CASE pos WHEN 0 THEN 'Open the PDF: ' || string_split(path || '.pdf', '/')[-1] WHEN 1 THEN coalesce(nullif(head, ''), 'Open the embedded content') WHEN 2 THEN 'Open the embedded content'
   ELSE 'Open the interactive dashboard: ' || CASE WHEN len(string_split(rtrim(path, '/'), '/')) < 3 THEN '' ELSE
     CASE WHEN pos = 4 AND len(string_split(rtrim(path, '/'), '/')) < 3 THEN 'W' ELSE split_part(path, '/', 2) || ' / ' || split_part(path, '/', 3) END END END AS label,
  CASE pos WHEN 0 THEN '{SITE}' || path || '.pdf' WHEN 1 THEN '{SITE}/embed' || path WHEN 2 THEN 'https://' || host || '/e'
   WHEN 3 THEN 'https://' || host || '/views/Book' || path ELSE 'https://' || host || '/views/W' || path END AS href
  FROM kept, (SELECT unnest(range(5)) AS pos)""")
def p81(spark, d):
    return ct.embed_rows(prepared(spark, d))


@query("p82_widgets", f"""WITH {KEPT} SELECT page_id, pos, ['image', 'heading', 'paragraph', 'link'][pos + 1] AS type, CASE pos WHEN 1 THEN 3 ELSE 0 END AS level,
  CASE pos WHEN 2 THEN 'About ' || host WHEN 3 THEN 'Push' ELSE title END AS text,
  CASE pos WHEN 0 THEN '/up' || path || '.png' WHEN 1 THEN path WHEN 3 THEN '/go' || path END AS href
  FROM kept, (SELECT unnest(range(4)) AS pos)""")
def p82(spark, d):
    return ct.widget_rows(prepared(spark, d))


IMAGES = f"""images AS (SELECT page_id, pos, CASE pos WHEN 0 THEN '{SITE}/up' || path || '.png' WHEN 1 THEN url || '/pic.jpg' ELSE '{SITE}/a/' || host || '/pic.jpg' END AS url,
  CASE pos WHEN 0 THEN CASE WHEN path LIKE '%/' THEN '.png' ELSE split_part(path, '/', 3) || '.png' END
    WHEN 1 THEN CASE WHEN contains(url, '?') THEN CASE WHEN path LIKE '%/' THEN 'image.png' ELSE split_part(path, '/', 3) END ELSE 'pic.jpg' END ELSE 'pic.jpg' END AS name,
  CASE pos WHEN 0 THEN title WHEN 1 THEN head ELSE '' END AS alt FROM kept, (SELECT unnest(range(3)) AS pos))"""


@query("p83_images", f"WITH {KEPT}, {IMAGES} SELECT page_id, pos, url, name, alt FROM images")
def p83(spark, d):
    return ct.image_rows(prepared(spark, d), SITE)


@query("p83_image_collisions", f"WITH {KEPT}, {IMAGES} SELECT name, COUNT(DISTINCT url) AS n_urls FROM images GROUP BY name HAVING COUNT(DISTINCT url) > 1")
def p83_collisions(spark, d):
    return ct.name_collisions(ct.image_rows(prepared(spark, d), SITE))


@query("p84_links", r"""SELECT page_id, unnest(range(len(h))) AS pos, unnest(h) AS href FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS h FROM pages)""")
def p84(spark, d):
    return ct.link_rows(ct.parsed(table(spark, d, "pages"), only_links=True), "events", with_text=False)


def _part(spark, d) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")


def with_body(rows: DataFrame) -> DataFrame:
    """Pages given as ``(doc_id, html)`` to ``(doc_id, body)``."""
    parsed = ct.extract(ct.parsed(rows, carry=["doc_id"], selectors=ARTICLE), ARTICLE)
    return ct.with_markdown(ct.prepared(parsed, SITE), SITE).select("doc_id", "body")


@query("p85_nested_emphasis", "SELECT p_partkey AS doc_id, '*' || p_name || ' (' || p_brand || ')* **' || p_type || '** ' || p_size AS body FROM part")
def p85(spark, d):
    html = F.concat(
        F.lit("<article><p><em>"), "p_name", F.lit(" <i>(<em>"), "p_brand", F.lit("</em>)</i> </em><b><strong>"), "p_type",
        F.lit(" </strong></b>"), F.col("p_size").cast("string"), F.lit("<u></u><b> </b></p></article>"),
    )
    return with_body(dealt(_part(spark, d)).select(F.col("p_partkey").alias("doc_id"), html.alias("html")))


@query("p86_markdown", r"""WITH l AS (SELECT doc_id, source, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '[ \t\r\n]+', ' ', 'g'))), lambda x: x <> '') AS ls FROM documents)
  SELECT doc_id, '## ' || source || chr(10) || chr(10) || '- [' || source || '](/s/' || source || ')' || chr(10) || '  - ![](https://portal.example/i.png)' || chr(10) || chr(10) ||
  '| k | v |' || chr(10) || '| --- | --- |' || chr(10) || '| id | ' || doc_id || ' |' || chr(10) || chr(10) || array_to_string(ls, chr(10) || chr(10)) AS body FROM l""")
def p86(spark, d):
    """Whole document texts as pages: a heading, a nested list, a table, one paragraph per line."""
    safe = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    html = F.concat(
        F.lit("<article><h1>"), "source", F.lit("</h1><ul><li><a href='/s/"), "source", F.lit("'> "), "source",
        F.lit(" </a><ul><li><img src='i.png'></ul></ul><table><tr><th>k<th>v</tr><tr><td>id</td><td> "), F.col("doc_id").cast("string"),
        F.lit("</td></tr></table><p>"), F.replace(safe, F.lit("\n"), F.lit("</p>\n<p>")), F.lit("</p></article>"),
    )
    return with_body(spread(table(spark, d, "documents").select("doc_id", "source", "text")).select("doc_id", html.alias("html")))


@query("p86_markdown_blocks", r"""SELECT p_partkey AS doc_id, array_to_string(['3. ' || p_name, '', '   ' || p_brand, '4. ' || p_type, '   x', '', '> ' || p_name, '>', '> ' || p_brand, '> ' || p_type, '',
  '| ' || p_name || ' | |', '| --- | --- |', '| 1 | ' || p_brand || ' |', '', '[' || p_name || '](/x "' || p_type || '")', '', '- a', '', '  ```', '  ' || p_brand, '   y', '  ```', '- b', '  - c'], chr(10)) AS body FROM part""")
def p86_blocks(spark, d):
    """Items and quotes of several lines, list starts, spans, titles, code in items, empty markup."""
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    html = F.concat(
        F.lit('<article><ol start="3"><li><p>'), name, F.lit("</p><p>"), brand, F.lit("</p></li><li>"), kind, F.lit("<br>x</li></ol><blockquote><p>"), name, F.lit("</p><p>"), brand,
        F.lit("<br>"), kind, F.lit('</p></blockquote><table><tr><th colspan="2">'), name, F.lit("</tr><tr><td>1<td>"), brand, F.lit('</tr></table><p><a href="/x" title="'), kind, F.lit('">'), name,
        F.lit("</a><s></s><b><i><a href='u'> </a></i></b></p><ul><li>a<pre>"), brand, F.lit("\n y</pre></li><li>b<ul><li>c</ul></ul></article>"),
    )
    return with_body(dealt(_part(spark, d)).select(F.col("p_partkey").alias("doc_id"), html.alias("html")))


@query("p80_selector_lists", r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS ws FROM documents)
  SELECT doc_id, CASE WHEN len(ws) % 3 = 0 THEN 'section > div.lead, aside.box' WHEN len(ws) % 3 = 1 THEN 'div[data-k="b"] p#x.y' END AS matched_selector,
    CASE len(ws) % 3 WHEN 0 THEN coalesce(ws[1], '') WHEN 1 THEN coalesce(ws[2], '') END AS content FROM w""")
def p80_lists(spark, d):
    """Selectors that the caller writes: children, descendants, attributes, classes, lists; some documents have a near miss only."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    one, two = (F.coalesce(F.get(words, i), F.lit("")) for i in (0, 1))
    n = F.coalesce(F.size(words), F.lit(0)) % 3
    html = F.when(n == 0, F.concat(F.lit("<section><em><div class=lead>no</div></em><div class='a lead'>"), one, F.lit("</div></section>"))).when(
        n == 1, F.concat(F.lit("<p id=x class=y>no</p><div data-k=c><p id=x class=y>no</p></div><div data-k='b'><span><p class='z y' id=x>"), two, F.lit("</p></span></div>"))).otherwise(
        F.lit("<section><em><div class=lead>no</div></em></section><aside class=boxes>no</aside>"))
    chosen = ["section > div.lead, aside.box", 'div[data-k="b"] p#x.y']
    rows = spread(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", html.alias("html"))
    found = ct.extract(ct.parsed(rows, carry=["doc_id"], selectors=chosen), chosen)
    return found.select("doc_id", "matched_selector", F.when(F.col("content").isNotNull(), text_of(F.col("content"))).alias("content"))


@query("p86_untidy_markup", r"""SELECT p_partkey AS doc_id, array_to_string(['**' || p_name || '**', '', p_brand || ' ' || p_type, '', '[' || p_name || '](/a)[' || p_brand || '](/b)', '',
  '*' || p_type || '*', '', '*in ' || p_brand || '* end', '', '- ' || p_name, '- ' || p_brand || ' **b**', '', '| **' || p_name || '** | ' || p_brand || ' |', '| --- | --- |', '| ' || p_type || ' | |', '', 'after'], chr(10)) AS body FROM part""")
def p86_untidy(spark, d):
    """Markup as pages have it: emphasis over a paragraph's end, links left open, stray ends, cells and items left open."""
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    html = F.concat(
        F.lit("<article><b>"), name, F.lit("<p>"), brand, F.lit("</b> "), kind, F.lit("</p></p></section><p><a href=/a>"), name, F.lit("<a href='/b'>"), brand,
        F.lit("</a></p><em><p>"), kind, F.lit("</em></p><div><i>in "), brand, F.lit("</i></u> end</div></span><ul><li><p>"), name, F.lit("<li>"), brand,
        F.lit(" <b>b</b></ul><table><tr><th><b>"), name, F.lit("<th>"), brand, F.lit("<tr><td>"), kind, F.lit("<td><b></table></b>after</article>"),
    )
    return with_body(dealt(_part(spark, d)).select(F.col("p_partkey").alias("doc_id"), html.alias("html")))


def export(spark, d) -> DataFrame:
    """All steps in order: parse, embeds and widgets, images, links rewritten by join, Markdown, page.

    Pages are parsed once; their drafts are settled, since both the link join and the texts come from them.
    """
    pages = ct.parsed(as_docs(derived(spark, d), "html"), carry=["page_id", "url", "docname", "kind", "slug", "date"])
    ready = ct.prepared(ct.extract(pages), SITE)
    drafts = settle(ct.drafted(ready, SITE, ct.static_picture(F.lit("../"), SITE)))
    targets = lk.link_map(page_docs(spark, d))
    found = lk.resolve(ct.hrefs(drafts, "page_id", "docname"), targets, SITE, []).select("page_id", "href", "resolved")
    linked = drafts.join(ct.href_targets(found, "page_id"), "page_id", "left")
    bodies = ct.finished(linked, "targets")
    notice = F.concat(F.lit("No content of its own: "), "url")
    kept = corpus.with_placeholder(bodies, "body", notice)
    page = tx.render_document(F.col("slug"), F.col("url"), F.col("kind"), F.col("date"), F.col("body"))
    return kept.select("page_id", "docname", "note", page.alias("page"))


_NL = "chr(10)"
_P = "chr(10) || chr(10)"


def _rel(target: str) -> str:
    return (f"CASE WHEN split_part(docname, '/', 1) = split_part({target}, '/', 1) THEN split_part({target}, '/', 2) "
            f"ELSE '../' || {target} END || '.md'")


@query("p86_export_documents", f"""WITH {BASE}, docs AS (SELECT *, CASE WHEN url LIKE 'https:%' THEN 'pages/doc' || page_id ELSE 'news/2024-05-06-doc' || page_id END AS docname FROM base),
  map AS (SELECT rtrim(path, '/') AS k, arg_max(docname, page_id) AS target FROM docs GROUP BY 1),
  own AS (SELECT docs.*, target FROM docs LEFT JOIN map ON k = rtrim(path, '/')),
  leaf AS (SELECT *, CASE WHEN path LIKE '%/' THEN '' ELSE split_part(path, '/', 3) END AS l FROM own),
  parts AS (SELECT *, '## ' || regexp_replace(title, ' +', ' ', 'g') || {_P} || host || ' **bold in** end' || {_P} ||
    '*This document is embedded in a PDF viewer on the original site.*' || {_P} || '[Open the PDF: ' || l || '.pdf]({SITE}' || path || '.pdf)' || {_P} ||
    '*This content is embedded in a frame on the original site.*' || {_P} || '[' || trim(regexp_replace(head, ' +', ' ', 'g')) || ']({SITE}/embed' || path || ')' || {_P} ||
    '*This content is embedded in a frame on the original site.*' || {_P} || '[Open the embedded content](https://' || host || '/e)' || {_P} ||
    '*This Tableau dashboard is embedded on the original site.*' || {_P} || '[Open the interactive dashboard: ' || split_part(path, '/', 2) || ' / ' || split_part(path, '/', 3) || '](https://' || host || '/views/Book' || path || ')' || {_P} ||
    '*This Tableau dashboard is embedded on the original site.*' || {_P} || '[Open the interactive dashboard: ' || split_part(path, '/', 2) || ' / ' || split_part(path, '/', 3) || '](https://' || host || '/views/W' || path || ')' || {_P} ||
    '![' || title || '](../_static/images/' || l || '.png)' || {_P} || '#### [' || title || '](' || {_rel('target')} || ')' || {_P} || 'About ' || host || {_P} ||
    '[Push]({SITE}/go' || path || ')' || {_P} || '![' || regexp_replace(head, '[[:space:]]+', ' ', 'g') || '](../_static/images/' || CASE WHEN contains(url, '?') THEN CASE WHEN l = '' THEN 'image.png' ELSE l END ELSE 'pic.jpg' END || ')' || {_P} ||
    '![](../_static/images/pic.jpg)' || array_to_string(list_transform(own, lambda x: {_P} || x.md || x.t || x.tail), '') AS body FROM leaf)
  SELECT page_id, docname, CASE WHEN url LIKE '%#top' THEN 'no content container found' END AS note,
  '# doc' || page_id || {_P} || CASE WHEN docname LIKE 'news/%' THEN '*Published: 2024-05-06*  ' || {_NL} ELSE '' END || '*Source: [' || url || '](' || url || ')*' || {_P} ||
  CASE WHEN url LIKE '%#top' THEN 'No content of its own: ' || url ELSE body END || {_NL} AS page FROM parts""")
def p86_export(spark, d):
    return export(spark, d)


@query("p53_conversion_report", f"""WITH {DOCS}, kinds AS (SELECT * FROM (VALUES ('pdf', 1), ('frame', 2), ('dashboard', 1), ('legacy_dashboard', 1)) t(kind, n))
  SELECT docname, kinds.kind, CAST(n AS BIGINT) AS n FROM docs, kinds WHERE url NOT LIKE '%#top' UNION ALL SELECT docname, 'empty', 1 FROM docs WHERE url LIKE '%#top'""")
def p53(spark, d):
    """Notes on every embed of every page, and on pages that have no content."""
    pages = ct.parsed(as_docs(derived(spark, d), "html"), carry=["page_id", "url", "docname"])
    ready = ct.prepared(ct.extract(pages), SITE)
    bodies = ct.finished(ct.drafted(ready, SITE, keep=("embeds",)))
    return corpus.report_counts(corpus.notes(corpus.with_placeholder(bodies, "body", F.lit("nothing here"))))


@query("p53_notes_of_own_embeds", r"""WITH n AS (SELECT page_id, len(regexp_extract_all(html, '<p\b')) AS ps, len(regexp_extract_all(html, '<a\b')) AS links, len(regexp_extract_all(html, '<h[1-6]\b')) AS heads FROM pages)
  SELECT CAST(page_id AS VARCHAR) AS docname, kind, CAST(c AS BIGINT) AS n FROM (SELECT page_id, 'frame' AS kind, ps AS c FROM n UNION ALL SELECT page_id, 'pdf', links FROM n UNION ALL SELECT page_id, 'dashboard', heads FROM n) WHERE c > 0
  UNION ALL SELECT CAST(page_id AS VARCHAR), 'empty', 1 FROM n WHERE ps + links + heads = 0""")
def p53_own(spark, d):
    """A frame for each of the given page's paragraphs, a viewer for each link, a dashboard for each heading."""
    marks = F.regexp_extract_all("html", F.lit(r"<(p|a|h[1-6])\b"), F.lit(1))
    put = F.transform(marks, lambda m: F.when(m == "p", F.lit("<iframe src='/f'></iframe>")).when(m == "a", F.lit("<iframe src='/pdfjs-viewer-shortcode?file=/x.pdf'></iframe>")).otherwise(F.lit("<tableau-viz src='/v'></tableau-viz>")))
    html = F.concat(F.lit('<div class="entry-content">'), F.array_join(put, "<p></p>"), F.lit("</div>"))
    rows = spread(table(spark, d, "pages").select("page_id", "url", "html")).select(F.col("page_id").cast("string").alias("docname"), html.alias("html"))
    ready = ct.prepared(ct.extract(ct.parsed(rows, carry=["docname"])), SITE)
    bodies = ct.finished(ct.drafted(ready, SITE, keep=("embeds",)))
    return corpus.report_counts(corpus.notes(corpus.with_placeholder(bodies, "body", F.lit("nothing here"))))


@query("p87_pruned_nodes", r"""WITH t AS (SELECT page_id, regexp_extract_all(html, '<[ap]\b') AS tags FROM pages),
  n AS (SELECT page_id, len(list_filter(tags, lambda x: x = '<p')) AS ps, len(list_filter(tags, lambda x: x = '<a')) AS links FROM t)
  SELECT page_id, 'p' AS tag, ps AS n_pruned FROM n WHERE ps > 0 UNION ALL SELECT page_id, 'span', links FROM n WHERE links > 0 UNION ALL SELECT page_id, 'u', links FROM n WHERE links > 0""")
def p87(spark, d):
    """An empty paragraph for each of the given page's paragraphs, and empty and kept marks for each of its links."""
    marks = F.regexp_extract_all("html", F.lit("<[ap]\\b"), F.lit(0))
    put = F.transform(marks, lambda m: F.when(m == "<p", F.lit("<p> <br-less></br-less></p>")).otherwise(F.lit("<span> <u></u></span><span><img src='/k.png'></span><em>kept</em>")))
    html = F.concat(F.lit('<div class="entry-content">'), F.array_join(put, "\n"), F.lit("</div>"))
    rows = spread(table(spark, d, "pages").select("page_id", "url", "html")).select("page_id", "url", html.alias("html"))
    return ct.prune_rows(ct.prepared(ct.extract(ct.parsed(rows)), SITE))
