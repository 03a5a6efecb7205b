"""Page-corpus and catalogue queries. The given tables stand in for landed pages, lists and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text as tx, urls
from ..operators import catalogue as cat, corpus, links as lk, ordered
from ..operators import content
from ..operators.deadlines import deadline_status
from ..session import fresh_path, spread
from ..sources import files
from ..sources.files import table
from .base import query

SITE = "https://portal.example"


def as_docs(pages: DataFrame, *more: str) -> DataFrame:
    """Every page as a document: https pages are pages, the others posts."""
    kind = F.when(F.col("url").startswith("https:"), F.lit("page")).otherwise(F.lit("post"))
    return pages.select(
        "page_id", "url", kind.alias("kind"), F.concat(F.lit("doc"), "page_id").alias("slug"),
        F.lit("2024-05-06T07:08:09").alias("date"), F.col("page_id").alias("pos"), *more,
    ).withColumn("docname", urls.docname(F.col("kind"), F.col("slug"), F.col("date")))


def page_docs(spark, d) -> DataFrame:
    return as_docs(table(spark, d, "pages"))


DOCS = """docs AS (SELECT page_id, url, CASE WHEN url LIKE 'https:%' THEN 'page' ELSE 'post' END AS kind,
  CASE WHEN url LIKE 'https:%' THEN 'pages/doc' || page_id ELSE 'news/2024-05-06-doc' || page_id END AS docname,
  page_id AS pos FROM pages)"""
PARTS = r"""regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path"""


def hrefs(spark, d) -> DataFrame:
    """Ten kinds of href per page, each built from the page's own URL."""
    u = F.col("url")
    kinds = [
        u, F.concat(u, F.lit("/more")), urls.path(u), F.concat(F.lit("more"), urls.path(u)),
        F.concat(F.lit("#s"), "page_id"), F.concat(F.lit("mailto:a@"), urls.host(u)),
        F.concat(F.lit(" /news/?p="), "page_id", F.lit("#n ")), F.concat(F.lit("a/../b"), "page_id"),
        F.concat(F.lit("//"), urls.host(u), F.lit("/files/x.PDF")), F.concat(F.lit("?page="), "page_id"),
    ]
    return page_docs(spark, d).select("page_id", "docname", "url", F.posexplode(F.array(*kinds)).alias("n", "href"))


HREFS = f"""base AS (SELECT *, {PARTS} FROM docs), hrefs AS (SELECT page_id, docname, url, host, path, n - 1 AS n,
  CASE n WHEN 1 THEN url WHEN 2 THEN url || '/more' WHEN 3 THEN path WHEN 4 THEN 'more' || path WHEN 5 THEN '#s' || page_id
  WHEN 6 THEN 'mailto:a@' || host WHEN 7 THEN ' /news/?p=' || page_id || '#n ' WHEN 8 THEN 'a/../b' || page_id
  WHEN 9 THEN '//' || host || '/files/x.PDF' ELSE '?page=' || page_id END AS href
  FROM base, (SELECT unnest(range(1, 11)) AS n))"""


def internal_hosts(spark, d, ending=".com"):
    """Array column: the link's own host counts as internal when it ends so."""
    own = urls.host(F.col("url"))
    return F.when(own.endswith(ending), F.array(own)).otherwise(F.array().cast("array<string>"))


# ---------------------------------------------------------------- 2.1 sources and sinks


@query("p01_collections", """SELECT CAST(doc_id AS VARCHAR) AS kind, pos, doc_id * 10 + pos AS id, 's' || doc_id || '-' || pos AS slug,
  source AS title, lang AS date, len(cats) AS n_categories FROM (SELECT *, [1, 2] AS cats, unnest(CASE WHEN lang = 'en'
  THEN [0, 1, 2, 3, 4] ELSE [0, 1, 2] END) AS pos FROM documents)""")
def p01(spark, d):
    """Four landed batches per document; the second is full for one language and short for the others."""

    def item(pos):
        return F.struct(
            (F.col("doc_id") * 10 + pos).alias("id"), F.concat(F.lit("s"), "doc_id", F.lit(f"-{pos}")).alias("slug"),
            F.struct(F.col("source").alias("rendered")).alias("title"), F.lit("u").alias("link"),
            F.col("lang").alias("date"), F.col("lang").alias("modified"), F.array(F.lit(1), F.lit(2)).alias("categories"),
        )

    full = F.to_json(F.array(item(0), item(1)))
    second = F.when(F.col("lang") == "en", F.to_json(F.array(item(2), item(3)))).otherwise(F.to_json(F.array(item(2))))
    batches = table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("kind"),
        F.posexplode(F.array(full, second, F.to_json(F.array(item(4))), F.lit('{"code": "no more"}'))).alias("n", "body"),
    ).withColumn("page_no", F.col("n") + 1)
    return corpus.paged_items(batches, size=2).select(
        "kind", "pos", "id", "slug", F.col("title.rendered").alias("title"), "date", F.size("categories").alias("n_categories")
    )


def catalogue_texts(spark, d) -> DataFrame:
    """One five-column Markdown table per order."""
    key, group = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    return spread(table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")).select(
        key.alias("source"),
        F.concat_ws(
            "\n",
            F.lit("Text before | the table"),
            F.lit("| Serial number | Box | Name | Previously | Link |"),
            F.lit("|---|---|---|---|---|"),
            F.concat(F.lit("| "), key, F.lit(" | **"), "o_orderpriority", F.lit("** | **Order   "), key, F.lit("** | "),
                     group, F.lit(" | <http://a.example/"), key, F.lit("> |")),
            F.concat(F.lit("| "), key, F.lit("a |  | Old viewer (Discontinued) | | [open](https://b.example/"), key, F.lit(") |")),
            F.concat(F.lit("| "), key, F.lit("b | Group "), group, F.lit(" | no link | | none |")),
            F.lit("| too | few | cells |"),
            F.concat(F.lit("| "), key, F.lit("c | | Last | **was here** | see <https://c.example/"), key, F.lit("> |")),
        ).alias("value"),
    )


APPS = """apps AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS source, 3 AS pos, CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS box,
    'Order ' || o_orderkey AS name, false AS discontinued, o_orderstatus AS previously, 'http://a.example/' || o_orderkey AS url FROM orders
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 4, o_orderkey || 'a', o_orderpriority, 'Old viewer (Discontinued)', true, '',
    'https://b.example/' || o_orderkey FROM orders
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 7, o_orderkey || 'c', 'Group ' || o_orderstatus, 'Last', false, 'was here',
    'https://c.example/' || o_orderkey FROM orders)"""


@query("p02_markdown_table", """SELECT CAST(o_orderkey AS VARCHAR) AS source, pos, o_orderkey || CASE pos WHEN 3 THEN '' WHEN 4 THEN 'a'
  WHEN 5 THEN 'b' ELSE 'c' END AS id, 5 AS n_cells FROM orders, (SELECT unnest([3, 4, 5, 7]) AS pos)""")
def p02(spark, d):
    return cat.table_rows(catalogue_texts(spark, d)).select(
        "source", "pos", F.col("cells")[0].alias("id"), F.size("cells").alias("n_cells")
    )


def part_apps(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(
        F.concat(F.col("p_partkey").cast("string"), F.lit("a")).alias("id"), F.col("p_brand").alias("box"),
        F.col("p_name").alias("name"), (F.col("p_size") < 10).alias("discontinued"), F.col("p_type").alias("previously"),
        F.concat(F.lit("https://apps.example/"), F.col("p_partkey").cast("string")).alias("url"),
    )


PART_APPS = """SELECT p_partkey || 'a' AS id, p_brand AS box, p_name AS name, p_size < 10 AS discontinued,
  p_type AS previously, 'https://apps.example/' || p_partkey AS url FROM part"""


@query("p03_read_catalogue", PART_APPS)
def p03(spark, d):
    path = fresh_path(spark, "catalogue-arrays")
    part_apps(spark, d).select(F.to_json(F.array(F.struct("*"))).alias("value")).write.text(path)
    return files.read_catalogue(spark, path, one_array_per_file=False)


@query("p03_array_files", PART_APPS)
def p03_files(spark, d):
    """Each file one array over several lines, a file for each brand."""
    path = fresh_path(spark, "catalogue-files")
    arrays = part_apps(spark, d).groupBy("box").agg(F.to_json(F.collect_list(F.struct("*"))).alias("value"))
    lines = arrays.select(F.regexp_replace("value", r"\},\{", "},\n{").alias("value"), F.regexp_replace("box", "#", "").alias("brand"))
    lines.write.partitionBy("brand").text(path)
    return files.read_catalogue(spark, f"{path}/*")


@query("p04_write_catalogue", PART_APPS)
def p04(spark, d):
    path = fresh_path(spark, "catalogue")
    files.write_catalogue(part_apps(spark, d), path)
    return files.read_catalogue(spark, path, one_array_per_file=False)


def text_docs(spark, d) -> DataFrame:
    kind = F.when(F.col("lang") == "en", F.lit("page")).otherwise(F.lit("post"))
    slug = F.concat("source", F.lit("-"), F.col("doc_id").cast("string"))
    return table(spark, d, "documents").select(
        "doc_id", urls.docname(kind, slug, F.lit("2024-02-03T00:00:00")).alias("docname"), F.col("text").alias("body")
    )


TEXT_DOCS = """SELECT doc_id, CASE WHEN lang = 'en' THEN 'pages' ELSE 'news' END AS folder,
  CASE WHEN lang = 'en' THEN '' ELSE '2024-02-03-' END || source || '-' || doc_id || '.md' AS file_name, text AS body FROM documents"""


@query("p05_document_sink", TEXT_DOCS)
def p05(spark, d):
    path = fresh_path(spark, "documents")
    files.write_documents(text_docs(spark, d), path)
    return files.read_documents(spark, path).select("doc_id", "folder", "file_name", "body")


@query("p05_document_files", f"WITH {DOCS} SELECT docname || '.md' AS name, html AS body FROM docs JOIN pages USING (page_id) WHERE html <> ''")
def p05_files(spark, d):
    """A file for every page, read back; files without a byte are there, but no reader's."""
    path = fresh_path(spark, "files")
    files.write_document_files(as_docs(table(spark, d, "pages"), "html"), path, "html")
    return files.read_document_files(spark, path)


@query("p06_full_refresh", f"SELECT folder, COUNT(*) AS n FROM ({TEXT_DOCS}) WHERE folder = 'pages' GROUP BY folder")
def p06(spark, d):
    path = fresh_path(spark, "documents")
    docs = text_docs(spark, d)
    files.write_documents(docs, path)
    files.write_documents(docs.where(F.col("docname").startswith("pages/")), path)
    return files.read_documents(spark, path).groupBy("folder").agg(F.count("*").alias("n"))


@query("p07_block_upsert", """WITH t AS (SELECT page_id, url, CASE WHEN url LIKE '%#top' THEN replace(html, '</article>', '  ') ELSE html END AS h,
    '<article>[' || url || ']</article>' AS b FROM pages)
  SELECT page_id, CASE WHEN url NOT LIKE 'https:%' THEN h
    WHEN contains(h, '<article>') AND contains(h, '</article>') THEN left(h, strpos(h, '<article>') - 1) || b ||
      substr(h, strpos(h, '</article>') + 10)
    ELSE rtrim(h) || chr(10) || chr(10) || b || chr(10) END AS text FROM t""")
def p07(spark, d):
    p = table(spark, d, "pages")
    text = F.when(F.col("url").endswith("#top"), F.replace("html", F.lit("</article>"), F.lit("  "))).otherwise(F.col("html"))
    texts = p.select(F.col("page_id").alias("slug"), text.alias("text"))
    blocks = p.where(F.col("url").startswith("https:")).select(
        F.col("page_id").alias("slug"), F.concat(F.lit("<article>["), "url", F.lit("]</article>")).alias("block")
    )
    return cat.upsert_blocks(texts, blocks, "<article>", "</article>").withColumnRenamed("slug", "page_id")


def doc_apps(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")


@query("p08_presence", "SELECT d.doc_id, lang, l.doc_id IS NOT NULL AS has_thumbnail FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id")
def p08(spark, d):
    return cat.with_presence(doc_apps(spark, d), table(spark, d, "labels"), "doc_id").select("doc_id", "lang", "has_thumbnail")


# ---------------------------------------------------------------- 2.2 filters


@query("p10_skip_reason", """SELECT doc_id, CASE WHEN lang <> 'en' THEN NULL WHEN source IN ('src1', 'src2') THEN 'scratch page'
  WHEN source = 'src3' THEN 'replaced by index' END AS skip_reason FROM documents""")
def p10(spark, d):
    kind = F.when(F.col("lang") == "en", F.lit("page")).otherwise(F.lit("post"))
    reason = corpus.skip_reason(kind, F.col("source"), drafts=["src1", "src2"], replaced=["src3"])
    return doc_apps(spark, d).select("doc_id", reason.alias("skip_reason"))


@query("p10_skipped_pages", """SELECT source || doc_id AS slug, CASE WHEN source IN ('src1', 'src2') THEN 'scratch page' ELSE 'replaced by index' END AS reason
  FROM documents WHERE lang = 'en' AND source IN ('src1', 'src2', 'src3')""")
def p10_skipped(spark, d):
    """The list of pages left out, apart from the conversion report."""
    kind = F.when(F.col("lang") == "en", F.lit("page")).otherwise(F.lit("post"))
    reason = corpus.skip_reason(kind, F.col("source"), drafts=["src1", "src2"], replaced=["src3"])
    return corpus.skipped(table(spark, d, "documents").withColumn("slug", F.concat("source", F.col("doc_id").cast("string"))), reason)


@query("p11_chosen_ids", "SELECT p_partkey, p_brand FROM part WHERE p_brand IN ('Brand#2', 'Brand#17')")
def p11(spark, d):
    rows = table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("id"))
    return cat.chosen(rows, ["Brand#2", "Brand#17"]).withColumnRenamed("id", "p_brand")


@query("p12_link_eligibility", f"WITH {DOCS}, {HREFS} SELECT page_id, href FROM hrefs WHERE n NOT IN (4, 5)")
def p12(spark, d):
    return hrefs(spark, d).where(urls.eligible(tx.strip(F.col("href")))).select("page_id", "href")


@query("p13_internal_url", f"""WITH {DOCS}, {HREFS} SELECT page_id, n, CASE WHEN n IN (0, 1, 8) THEN host LIKE '%.com'
  ELSE n <> 4 END AS is_internal FROM hrefs""")
def p13(spark, d):
    href = tx.strip(F.col("href"))
    return hrefs(spark, d).select("page_id", "n", urls.internal(href, internal_hosts(spark, d)).alias("is_internal"))


def captures(spark, d) -> DataFrame:
    return doc_apps(spark, d).select(
        F.col("doc_id").alias("id"), "source", F.when(F.col("source") != "src7", F.col("n_chars")).alias("bytes"),
        (F.col("source") == "src5").alias("timed_out"), (F.col("n_chars") * 3).alias("thumbnail_bytes"),
    )


STATUS = """status AS (SELECT doc_id AS id, source, source <> 'src5' AND source <> 'src7' AND n_chars >= 500 AS ok,
  CASE WHEN source = 'src5' THEN 'timed out' WHEN source = 'src7' OR n_chars < 500 THEN 'no image produced'
  ELSE (n_chars // 1024) || ' KB' END AS message,
  source <> 'src5' AND source <> 'src7' AND n_chars >= 500 AND n_chars * 3 < 2000 AS blank FROM documents)"""


def capture_status(spark, d):
    return cat.capture_status(captures(spark, d), least=500, least_thumbnail=2000)


@query("p14_capture_flags", f"WITH {STATUS} SELECT id, ok, message, blank FROM status")
def p14(spark, d):
    return capture_status(spark, d).select("id", "ok", "message", "blank")


@query("p15_empty_documents", """SELECT doc_id, CASE source WHEN 'src1' THEN 'no content container found' WHEN 'src2' THEN 'empty document' END AS note,
  CASE WHEN source IN ('src1', 'src2') THEN 'See ' || doc_id ELSE text END AS body FROM documents""")
def p15(spark, d):
    docs = table(spark, d, "documents").select(
        "doc_id",
        F.when(F.col("source") == "src2", F.lit(" \n\t ")).when(F.col("source") != "src1", F.col("text")).alias("body"),
    )
    return corpus.with_placeholder(docs, "body", F.concat(F.lit("See "), F.col("doc_id").cast("string")))


# ---------------------------------------------------------------- 2.3 scalar projections


@query("p20_url_split", r"""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
  CASE WHEN contains(url, '#') THEN substr(url, strpos(url, '#') + 1) ELSE '' END AS fragment FROM pages""")
def p20(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", urls.host(u).alias("host"), urls.path(u).alias("path"), urls.fragment(u).alias("fragment"))


@query("p21_path_key", f"""SELECT page_id, CASE WHEN rtrim(path, '/') = '' THEN '/' ELSE rtrim(path, '/') END AS path_key
  FROM (SELECT page_id, {PARTS} FROM pages)""")
def p21(spark, d):
    return table(spark, d, "pages").select("page_id", urls.path_key(F.col("url")).alias("path_key"))


@query("p22_docname", f"WITH {DOCS} SELECT page_id, docname FROM docs")
def p22(spark, d):
    return page_docs(spark, d).select("page_id", "docname")


@query("p23_relative_path", f"""WITH {DOCS} SELECT page_id, CASE WHEN docname LIKE 'news/%' THEN 'index.md' ELSE '../news/index.md' END AS to_news,
  CASE WHEN docname LIKE 'news/%' THEN '../pages/x.md' ELSE 'x.md' END AS to_page, docname || '.md' AS from_root FROM docs""")
def p23(spark, d):
    here = F.col("docname")
    return page_docs(spark, d).select(
        "page_id", urls.relative(here, F.lit("news/index")).alias("to_news"),
        urls.relative(here, F.lit("pages/x")).alias("to_page"), urls.relative(F.lit("index"), here).alias("from_root"),
    )


@query("p24_title_flatten", "SELECT p_partkey, p_name || ' & ' || p_brand || ' (' || p_type || ')' AS title FROM part")
def p24(spark, d):
    raw = F.concat(F.lit("<b>"), "p_name", F.lit("</b> &amp;\n <i>"), "p_brand", F.lit(" </i>&#40;<u>"))
    raw = F.concat(F.replace(raw, F.lit("&#40;<u>"), F.lit(" ")), F.lit("&#40;"), "p_type", F.lit(")<br>"))
    return table(spark, d, "part").select("p_partkey", corpus.plain_title(raw).alias("title"))


@query("p25_pdf_target", f"""SELECT page_id, CASE WHEN page_id IS NULL THEN NULL ELSE '{SITE}' || path || ' a+b.pdf' END AS target,
  CASE WHEN contains(url, 'page=') THEN regexp_extract(url, '[?&]page=([^&#]*)', 1) ELSE url END AS page
  FROM (SELECT page_id, url, {PARTS} FROM pages)""")
def p25(spark, d):
    u = F.col("url")
    viewer = F.concat(F.lit("/v/viewer.html?x=1&file="), F.replace(urls.path(u), F.lit("/"), F.lit("%2F")), F.lit("+a%2Bb.pdf&y=2"))
    return table(spark, d, "pages").select(
        "page_id", urls.pdf_target(viewer, SITE).alias("target"), urls.pdf_target(u, SITE, "page").alias("page")
    )


@query("p26_dashboard_label", f"""SELECT page_id, split_part(rtrim(path, '/'), '/', 2) || ' / ' || split_part(rtrim(path, '/'), '/', 3) AS label,
  split_part(rtrim(path, '/'), '/', 3) AS single, 'dashboard' AS bare FROM (SELECT page_id, {PARTS} FROM pages)""")
def p26(spark, d):
    u = F.col("url")
    leaf = F.element_at(F.split(F.rtrim(urls.path(u), F.lit("/")), "/"), -1)
    return table(spark, d, "pages").select(
        "page_id", urls.dashboard_label(u).alias("label"),
        urls.dashboard_label(F.concat(F.lit("https://h.example/views/"), leaf)).alias("single"),
        urls.dashboard_label(F.concat(F.lit("https://"), urls.host(u), F.lit("//views/"))).alias("bare"),
    )


@query("p27_legacy_dashboard", f"""SELECT page_id, CASE WHEN url LIKE '%#top' THEN NULL ELSE 'https://' || host || '/a+b/views/w' || path END AS target
  FROM (SELECT page_id, url, {PARTS} FROM pages)""")
def p27(spark, d):
    u = F.col("url")
    name = F.when(~u.endswith("#top"), F.concat(F.lit("w"), urls.path(u))).otherwise(F.lit(""))
    base = F.concat(F.lit("https%3A%2F%2F"), urls.host(u), F.lit("%2Fa+b%2F"))
    return table(spark, d, "pages").select("page_id", urls.legacy_dashboard_url(base, name).alias("target"))


@query("p28_asset_name", f"""SELECT page_id, CASE WHEN split_part(path, '/', 4) = '' AND path LIKE '%/' THEN 'image.png' ELSE split_part(path, '/', 3) END AS name,
  split_part(rtrim(path, '/'), '/', 3) || '_x.v1.png' AS spaced FROM (SELECT page_id, {PARTS} FROM pages)""")
def p28(spark, d):
    u = F.col("url")
    spaced = F.concat(F.rtrim(urls.path(u), F.lit("/")), F.lit("%20%C3%A9%20x.v1.png?q=1"))
    return table(spark, d, "pages").select("page_id", urls.asset_name(u).alias("name"), urls.asset_name(spaced).alias("spaced"))


@query("p29_absolute_url", f"""WITH {DOCS}, {HREFS} SELECT page_id, n, CASE n WHEN 0 THEN href WHEN 1 THEN href WHEN 2 THEN '{SITE}' || href
  WHEN 3 THEN '{SITE}/' || rtrim(href, '/') || CASE WHEN href LIKE '%/' THEN '/' ELSE '' END
  WHEN 5 THEN href WHEN 6 THEN '{SITE}' || trim(href) WHEN 7 THEN '{SITE}/b' || page_id WHEN 8 THEN 'https:' || href
  ELSE '{SITE}' || href END AS url FROM hrefs""")
def p29(spark, d):
    return hrefs(spark, d).select("page_id", "n", urls.absolutise(SITE, tx.strip(F.col("href"))).alias("url"))


@query("p30_link_class", f"""WITH {DOCS}, {HREFS} SELECT page_id, n, CASE WHEN n IN (4, 5) THEN 'none' WHEN n = 8 THEN 'pdf'
  WHEN n IN (0, 1) AND host <> 'blog.tionsh.example.net' THEN 'external' ELSE 'same_site' END AS link_class FROM hrefs""")
def p30(spark, d):
    page = F.lit("https://blog.tionsh.example.net/start")
    return hrefs(spark, d).select("page_id", "n", urls.link_class(F.col("href"), page).alias("link_class"))


@query("p31_deadline_status", """WITH t AS (SELECT o_orderkey, date_diff('second', TIMESTAMP '1998-01-01 06:30:00', o_orderdate) AS s FROM orders)
  SELECT o_orderkey, CASE WHEN s <= 0 THEN 'red' WHEN s // 86400 >= 60 THEN 'green' WHEN s // 86400 >= 30 THEN 'orange' ELSE 'red' END AS light,
  s <= 0 AS all_red, CASE WHEN s <= 0 THEN 'Reporting deadline has passed.'
  ELSE (s // 86400) || ' days and ' || ((s % 86400) // 3600) || ' hours' END AS label FROM t""")
def p31(spark, d):
    status = deadline_status(F.col("o_orderdate"), F.lit("1998-01-01 06:30:00").cast("timestamp_ntz"))
    return table(spark, d, "orders").select("o_orderkey", status.alias("s")).select("o_orderkey", "s.*")


@query("p32_catalogue_cleanup", "SELECT p_partkey, p_name || ' ' || p_brand AS name, p_type LIKE '%ECO%' AS discontinued FROM part")
def p32(spark, d):
    tail = F.when(F.col("p_type").contains("ECO"), F.lit("DisContinued")).otherwise(F.lit("current"))
    raw = F.concat(F.lit(" **"), "p_name", F.lit("**  \t "), "p_brand", F.lit(" "))
    return table(spark, d, "part").select(
        "p_partkey", cat.clean_name(raw).alias("name"), cat.is_discontinued(F.concat(raw, tail)).alias("discontinued")
    )


@query("p33_catalogue_applications", f"WITH {APPS} SELECT * FROM apps")
def p33(spark, d):
    return cat.applications(catalogue_texts(spark, d))


HEADED = """headed AS (SELECT doc_id, CASE lang WHEN 'en' THEN '### ' WHEN 'fr' THEN '## ' ELSE '#### ' END || source || chr(10) ||
  replace(text, chr(10), chr(10) || CASE lang WHEN 'en' THEN '# ' WHEN 'fr' THEN '### ' ELSE '###### ' END) AS body FROM documents)"""


@query("p34_heading_levels", HEADED.join(["WITH ", r""", lowest AS (SELECT *, list_min(list_transform(regexp_extract_all(body, '(?m)^(#{1,6}) \S', 1),
  lambda x: length(x))) AS low FROM headed)
  SELECT doc_id, array_to_string(list_transform(string_split(body, chr(10)), lambda x: CASE WHEN regexp_matches(x, '^#{1,6} \S')
  THEN repeat('#', greatest(2, least(6, length(regexp_extract(x, '^#+')) + 2 - low))) || substr(x, length(regexp_extract(x, '^#+')) + 1)
  ELSE x END), chr(10)) AS body FROM lowest"""]))
def p34(spark, d):
    def marks(en, fr, other):
        return F.when(F.col("lang") == "en", F.lit(en)).when(F.col("lang") == "fr", F.lit(fr)).otherwise(F.lit(other))

    lines = F.replace("text", F.lit("\n"), F.concat(F.lit("\n"), marks("# ", "### ", "###### ")))
    body = F.concat(marks("### ", "## ", "#### "), "source", F.lit("\n"), lines)
    docs = table(spark, d, "documents").select("doc_id", body.alias("raw"))
    return docs.select("doc_id", tx.normalise_headings(F.col("raw")).alias("body"))


@query("p35_text_cleanup", r"""SELECT doc_id, trim(text, chr(32) || chr(10) || chr(9) || chr(13)) || chr(10) || chr(10) || source || chr(32) || chr(10) || 'x' AS body FROM
  (SELECT doc_id, source, replace(regexp_replace(regexp_replace(text, '[ \t]+\n', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), chr(160), ' ') AS text FROM documents)""")
def p35(spark, d):
    raw = F.concat(F.lit(" \n "), tx.strip(F.col("text")), F.lit("  \t\n\n\n\n"), "source", F.lit(" \nx\n"))
    return table(spark, d, "documents").select("doc_id", tx.clean_markdown(raw).alias("body"))


@query("p36_page_render", """SELECT doc_id, '# ' || source || chr(10) || chr(10) || CASE WHEN lang = 'en' THEN '' ELSE '*Published: 2024-02-03*  ' || chr(10) END ||
  '*Source: [u/' || doc_id || '](u/' || doc_id || ')*' || chr(10) || chr(10) || text || chr(10) AS page FROM documents""")
def p36(spark, d):
    kind = F.when(F.col("lang") == "en", F.lit("page")).otherwise(F.lit("post"))
    url = F.concat(F.lit("u/"), F.col("doc_id").cast("string"))
    page = tx.render_document(F.col("source"), url, kind, F.lit("2024-02-03T01:02:03"), F.col("text"))
    return table(spark, d, "documents").select("doc_id", page.alias("page"))


# ---------------------------------------------------------------- 2.4 joins


RESOLVED = f"""map AS (SELECT k, docname AS target FROM (SELECT CASE WHEN rtrim(path, '/') = '' THEN '/' ELSE rtrim(path, '/') END AS k, docname,
    row_number() OVER (PARTITION BY CASE WHEN rtrim(path, '/') = '' THEN '/' ELSE rtrim(path, '/') END ORDER BY pos DESC) AS rn FROM base) WHERE rn = 1),
  keyed AS (SELECT *, CASE WHEN n IN (4, 5) OR (n IN (0, 1, 8) AND host NOT LIKE '%.com') THEN NULL
    WHEN n = 6 THEN '/news' WHEN n = 9 THEN '/'
    ELSE rtrim(regexp_extract(href, '^(?:[a-z]+:)?(?://[^/?#]*)?([^?#]*)', 1), '/') END AS k,
    CASE WHEN contains(trim(href), '#') THEN '#' || split_part(trim(href), '#', 2) ELSE '' END AS f FROM hrefs),
  hits AS (SELECT keyed.*, target, CASE WHEN n IN (4, 5) THEN 'not_eligible' WHEN keyed.k IS NULL THEN 'external' WHEN keyed.k = '/news' THEN 'news_index'
    WHEN target IS NOT NULL THEN 'document' WHEN n IN (2, 6) THEN 'site_absolute' WHEN n IN (3, 7, 9) THEN 'joined' ELSE 'kept' END AS outcome
    FROM keyed LEFT JOIN map ON keyed.k = map.k),
  resolved AS (SELECT page_id, n, outcome, CASE outcome WHEN 'news_index' THEN CASE WHEN docname LIKE 'news/%' THEN 'index.md' ELSE '../news/index.md' END || f
    WHEN 'document' THEN CASE WHEN split_part(docname, '/', 1) = split_part(target, '/', 1) THEN split_part(target, '/', 2) ELSE '../' || target END || '.md' || f
    WHEN 'site_absolute' THEN '{SITE}' || trim(href)
    WHEN 'joined' THEN CASE n WHEN 3 THEN '{SITE}/' || href WHEN 7 THEN '{SITE}/b' || page_id ELSE '{SITE}' || href END
    ELSE href END AS resolved FROM hits)"""


def resolved_links(spark, d) -> DataFrame:
    return lk.resolve(hrefs(spark, d), lk.link_map(page_docs(spark, d)), SITE, internal_hosts(spark, d))


@query("p40_link_resolution", f"WITH {DOCS}, {HREFS}, {RESOLVED} SELECT page_id, n, outcome, resolved FROM resolved")
def p40(spark, d):
    return resolved_links(spark, d).select("page_id", "n", "outcome", "resolved")


FRONT = RESOLVED.replace("WHERE rn = 1),", "WHERE rn = 1 AND k <> '/' UNION ALL SELECT '/', docname FROM docs WHERE page_id = 7),", 1)


@query("p40_front_page", f"WITH {DOCS}, {HREFS}, {FRONT} SELECT page_id, n, outcome, resolved FROM resolved")
def p40_front(spark, d):
    """With a document that answers for the site's root."""
    links = lk.resolve(hrefs(spark, d), lk.link_map(page_docs(spark, d), front_slug="doc7"), SITE, internal_hosts(spark, d))
    return links.select("page_id", "n", "outcome", "resolved")


@query("p40_link_outcomes", f"""WITH {DOCS}, all_links AS (SELECT p.page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages p),
  parts AS (SELECT *, {PARTS} FROM docs), keys AS (SELECT DISTINCT rtrim(path, '/') AS k FROM parts)
  SELECT CASE WHEN k IS NULL THEN 'site_absolute' ELSE 'document' END AS outcome, COUNT(*) AS n_links
  FROM all_links LEFT JOIN keys ON rtrim(href, '/') = k GROUP BY 1""")
def p40_outcomes(spark, d):
    """Every link of every page, through the parser, to its outcome."""
    pages = as_docs(table(spark, d, "pages").select("page_id", "url", "html"), "html")
    found = content.link_rows(content.parsed(pages, carry=["docname"], only_links=True), "events", "docname", with_text=False)
    return lk.outcome_counts(lk.resolve(found, lk.link_map(page_docs(spark, d)), SITE, []))


@query("p41_missing_assets", "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def p41(spark, d):
    return cat.missing(doc_apps(spark, d), table(spark, d, "labels"), "doc_id").select("doc_id", "source")


@query("p42_present_count", "SELECT COUNT(*) AS n FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def p42(spark, d):
    return cat.present(doc_apps(spark, d), table(spark, d, "labels"), "doc_id").agg(F.count("*").alias("n"))


@query("p43_category_names", """WITH i AS (SELECT c_custkey, unnest([c_nationkey, c_nationkey + 7, 20 - c_nationkey]) AS id,
    unnest([1, 2, 3]) AS ix FROM customer)
  SELECT c_custkey, string_agg(coalesce(n_name, CAST(id AS VARCHAR)), '|' ORDER BY ix) AS categories FROM i LEFT JOIN nation ON n_nationkey = id GROUP BY c_custkey""")
def p43(spark, d):
    k = F.col("c_nationkey")
    rows = table(spark, d, "customer").select("c_custkey", F.array(k, k + 7, 20 - k).alias("ids"))
    names = table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return corpus.named_ids(rows, "ids", names, "names").select("c_custkey", F.array_join("names", "|").alias("categories"))


@query("p44_group_pairing", """SELECT n_name AS box, lower(n_name) AS slug, coalesce(s.n, 0) AS n,
  CASE WHEN s.n IS NULL THEN 'no applications' WHEN c.k IS NULL THEN 'no page' END AS skip_reason FROM nation
  LEFT JOIN (SELECT s_nationkey AS k, COUNT(*) AS n FROM supplier GROUP BY 1) s ON s.k = n_nationkey AND n_nationkey % 5 <> 3
  LEFT JOIN (SELECT DISTINCT c_nationkey AS k FROM customer) c ON c.k = n_nationkey AND n_nationkey % 4 <> 1""")
def p44(spark, d):
    nation = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("box"), F.lower("n_name").alias("slug"))
    apps = table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    pages = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    # some groups and pages go by another name than the one they are looked for under
    box = F.when(F.col("n_nationkey") % 5 == 3, F.concat(F.lit("old "), "box")).otherwise(F.col("box"))
    slug = F.when(F.col("n_nationkey") % 4 == 1, F.concat(F.lit("old-"), "slug")).otherwise(F.col("slug"))
    return cat.page_pairing(nation.select("box", "slug"), apps.select(box.alias("box")), pages.select(slug.alias("slug")))


SECTIONS = [("Start", ["page 3", "page 1", "page none"]), ("Viewers", ["viewers/index", "page 20"]), ("Reference", ["page 8", "page 7"])]
SECTION_ROWS = """(1, 'Start', 1, 'page 3', false), (1, 'Start', 2, 'page 1', false), (1, 'Start', 3, 'page none', false),
  (2, 'Viewers', 1, 'viewers/index', true), (2, 'Viewers', 2, 'page 20', false), (3, 'Reference', 1, 'page 8', false), (3, 'Reference', 2, 'page 7', false)"""


@query("p45_section_placement", f"""WITH s(section_ord, caption, ord, slug, pinned) AS (VALUES {SECTION_ROWS}),
  have AS (SELECT DISTINCT 'page ' || p_partkey AS slug FROM part)
  SELECT section_ord, caption, CAST(ord AS BIGINT) AS ord, slug FROM s WHERE pinned OR slug IN (SELECT slug FROM have)
  UNION ALL SELECT 3, 'Reference', 2 + row_number() OVER (ORDER BY slug), slug FROM have WHERE slug NOT IN (SELECT slug FROM s)""")
def p45(spark, d):
    have = table(spark, d, "part").select(F.concat(F.lit("page "), F.col("p_partkey").cast("string")).alias("slug"))
    return corpus.place_in_sections(have, SECTIONS, "Reference", {"viewers/index"})


COPIES = """f AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS folder, l_linestatus || CASE WHEN l_quantity < 25 THEN ' ' || CAST(l_linenumber AS VARCHAR) ELSE '' END || '.md' AS name,
  l_linestatus || '.md' AS original, l_quantity < 25 AS numbered FROM lineitem)"""


@query("p46_numbered_copies", f"WITH {COPIES} SELECT folder, name, original FROM f WHERE numbered AND (folder, original) IN (SELECT folder, name FROM f)")
def p46(spark, d):
    mark = F.when(F.col("l_quantity") < 25, F.concat(F.lit(" "), F.col("l_linenumber").cast("string"))).otherwise(F.lit(""))
    listing = table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("folder"), F.concat("l_linestatus", mark, F.lit(".md")).alias("name")
    ).distinct()
    return corpus.numbered_copies(listing)


# ---------------------------------------------------------------- 2.5 aggregations


@query("p50_group_counts", "SELECT p_brand AS box, COUNT(*) AS n FROM part GROUP BY 1")
def p50(spark, d):
    return cat.group_sizes(part_apps(spark, d))


@query("p50_catalogue_totals", "SELECT COUNT(*) AS n, COUNT(DISTINCT p_brand) AS n_groups FROM part")
def p50_totals(spark, d):
    return cat.catalogue_totals(part_apps(spark, d))


@query("p51_gallery", """WITH g AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand DESC) AS group_ord FROM (SELECT DISTINCT p_brand FROM part))
  SELECT group_ord, part.p_brand AS box, row_number() OVER (PARTITION BY part.p_brand ORDER BY p_partkey) AS member_ord, p_name AS name,
  COUNT(*) OVER (PARTITION BY part.p_brand) AS n FROM part JOIN g ON part.p_brand = g.p_brand""")
def p51(spark, d):
    apps = part_apps(spark, d).withColumn("pos", F.regexp_extract("id", r"\d+", 0).cast("long"))
    brands = apps.select("box").distinct()
    groups = corpus.row_numbers(brands, [], ["box desc"], "group_ord").withColumn("slug", F.lower("box"))
    return cat.gallery(apps, groups).select("group_ord", "box", "member_ord", "name", "n")


@query("p52_capture_summary", f"""WITH {STATUS} SELECT source, COUNT(*) FILTER (ok) AS captured, COUNT(*) AS total, COUNT(*) FILTER (NOT ok) AS failed,
  COUNT(*) FILTER (blank) AS blank FROM status GROUP BY source""")
def p52(spark, d):
    return cat.capture_summary(capture_status(spark, d), ["source"])


@query("p52_capture_problems", f"""WITH {STATUS} SELECT CASE WHEN NOT ok THEN 'failure' ELSE 'blank' END AS problem, id, message FROM status WHERE NOT ok OR blank""")
def p52_problems(spark, d):
    return cat.capture_problems(capture_status(spark, d))


# ---------------------------------------------------------------- 2.6 to 2.8 windows, order, sets


@query("p60_fill_forward", """SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS box FROM conversations""")
def p60(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", F.col("text")).alias("cell"))
    return ordered.fill_forward(rows, ["conv_id"], ["turn"], "cell", "box").select("conv_id", "turn", "box")


@query("p61_last_wins", f"""WITH {DOCS}, base AS (SELECT *, {PARTS} FROM docs) SELECT path_key, docname FROM (SELECT rtrim(path, '/') AS path_key, docname,
  row_number() OVER (PARTITION BY rtrim(path, '/') ORDER BY pos DESC) AS rn FROM base) WHERE rn = 1""")
def p61(spark, d):
    keyed = page_docs(spark, d).withColumn("path_key", urls.path_key(F.col("url")))
    return corpus.last_wins(keyed, "path_key", "pos", "docname")


@query("p70_newest_first", "SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS ord FROM orders")
def p70(spark, d):
    return corpus.newest_first(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey")


@query("p71_alphabetical", "SELECT slug, row_number() OVER (ORDER BY slug) AS ord FROM (SELECT DISTINCT p_name || ' ' || p_partkey AS slug FROM part)")
def p71(spark, d):
    slugs = table(spark, d, "part").select(F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("slug")).distinct()
    return corpus.alphabetical(slugs)


@query("p75_union_documents", """SELECT 'page' AS kind, c_custkey AS id, c_name AS slug, 'pages/' || c_name AS docname, c_mktsegment AS category FROM customer
  UNION ALL SELECT 'post', s_suppkey, s_name, 'news/2024-01-02-' || s_name, NULL FROM supplier""")
def p75(spark, d):
    pages = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("slug"), F.col("c_mktsegment").alias("category"), F.lit("2024-01-02T").alias("date"))
    posts = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("slug"), F.lit("2024-01-02T").alias("date"))
    return corpus.documents(pages, posts).select("kind", "id", "slug", "docname", "category")


@query("p76_set_difference", "SELECT doc_id AS slug FROM documents EXCEPT SELECT doc_id FROM labels")
def p76(spark, d):
    have = table(spark, d, "documents").select(F.col("doc_id").alias("slug"))
    return corpus.leftovers(have, table(spark, d, "labels").select(F.col("doc_id").alias("slug")))
