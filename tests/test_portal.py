import datetime as dt
import json
import os

import pytest
from pyspark.sql import Row, functions as F

from aerofolio.operators import catalogue as cat, content, corpus, links as lk
from aerofolio.operators.deadlines import deadline_status
from aerofolio.session import fresh_path
from aerofolio.sources import document_files, files, versions

SITE = "https://portal.example"


def item(n, **more):
    return {"id": n, "slug": f"s{n}", "title": {"rendered": f"T&amp;{n}"}, "link": f"{SITE}/s{n}/", "date": "2024-01-02T03:04:05",
            "modified": "m", "categories": [1, 99], **more}


def test_collections_end_at_the_first_short_or_bad_batch(spark, tmp_path):
    batches = {
        ("pages", 1): [item(1), item(2)], ("pages", 2): [item(3)], ("pages", 3): [item(4), item(5)],
        ("posts", 1): [item(6), item(7)], ("posts", 2): {"code": "end"}, ("posts", 3): [item(8), item(9)],
        ("empty", 1): [],
    }
    for (kind, n), body in batches.items():
        (tmp_path / f"{kind}-{n}.json").write_text(json.dumps(body, indent=1))
    got = corpus.paged_items(files.read_batches(spark, str(tmp_path)), size=2)
    assert sorted((r.kind, r.pos, r.id) for r in got.collect()) == [
        ("pages", 0, 1), ("pages", 1, 2), ("pages", 2, 3), ("posts", 0, 6), ("posts", 1, 7)
    ]
    assert got.first().title.rendered.startswith("T&amp;")


def test_skip_reason(spark):
    df = spark.createDataFrame([("page", "test"), ("page", "news"), ("page", "a"), ("post", "test"), ("post", "news")], "kind string, slug string")
    def reasons(**k):
        return [r[0] for r in df.select(corpus.skip_reason(F.col("kind"), F.col("slug"), **k)).collect()]

    assert reasons() == ["scratch page", "replaced by index", None, None, None]
    assert reasons(include_drafts=True) == [None, "replaced by index", None, None, None]


def test_category_names_of_repeated_keys(spark):
    df = spark.createDataFrame([(1, [1, 2]), (1, [3]), (1, [3])], "d int, ids array<bigint>")
    names = spark.createDataFrame([(1, "one")], "id long, name string")
    got = sorted(r.names for r in corpus.named_ids(df, "ids", names, "names").collect())
    assert got == [["3"], ["3"], ["one", "2"]]


def test_link_targets_of_repeated_keys(spark):
    rows = spark.createDataFrame([(1, "/a", "x.md"), (1, "/a", "x.md"), (1, "/b", "y.md")], "page_id long, href string, resolved string")
    assert content.href_targets(rows, "page_id").first().targets == {"/a": "x.md", "/b": "y.md"}


def test_positions_of_long_batches(spark):
    item = '{{"id": {}, "slug": "s"}}'
    bodies = ["[" + ",".join(item.format(i) for i in ids) + "]" for ids in ([1, 2, 3], [4, 5], [6])]
    df = spark.createDataFrame([("pages", i + 1, b) for i, b in enumerate(bodies)], "kind string, page_no int, body string")
    got = sorted((r.pos, r.id) for r in corpus.paged_items(df, size=2).collect())
    assert [i for _, i in got] == [1, 2, 3, 4, 5, 6] and len({p for p, _ in got}) == 6


def test_unknown_timeouts_count_as_none(spark):
    df = spark.createDataFrame([("a", 9000, None, 20000), ("b", None, None, None), ("c", 9000, True, None)], "id string, bytes long, timed_out boolean, thumbnail_bytes long")
    status = cat.capture_status(df)
    assert {r.id: (r.ok, r.message) for r in status.collect()} == {"a": (True, "8 KB"), "b": (False, "no image produced"), "c": (False, "timed out")}
    assert tuple(cat.capture_summary(status).first()) == (1, 3, 2, 0)


def test_groups_carried_down(spark):
    text = "\n".join(["| a1 | | first | | <http://u/1> |", "| 2 | G | x | | <http://u/2> |", "| 3 | | no link | | none |", "| 4 | | y | | <http://u/4> |", "| 5 | **H** | no link | | |", "| 6 | | z | | <http://u/6> |"])
    df = spark.createDataFrame([("s", text), ("none", "no table"), ("null", None)], "source string, value string")
    assert [(r.id, r.box) for r in cat.applications(df).orderBy("pos").collect()] == [("a1", ""), ("2", "G"), ("4", "G"), ("6", "H")]


def test_category_names_keep_order(spark):
    df = spark.createDataFrame([(1, [3, 9, 1, 3]), (2, []), (3, None)], "d int, ids array<bigint>")
    names = spark.createDataFrame([(1, "a"), (3, "c")], "id long, name string")
    got = {r.d: r.names for r in corpus.named_ids(df, "ids", names, "names").collect()}
    assert got == {1: ["c", "9", "a", "c"], 2: [], 3: []}


def test_link_resolution(spark):
    docs = spark.createDataFrame(
        [(0, f"{SITE}/a/", "pages/a", "a"), (1, f"{SITE}/b", "news/b", "b"), (2, "https://other/a", "pages/a2", "a2"),
         (3, f"{SITE}/", "pages/root", "root"), (4, f"{SITE}/hello/", "pages/hello", "hello")], "pos long, url string, docname string, slug string")
    targets = lk.link_map(docs, "hello")
    assert {r.path_key: r.target for r in targets.collect()} == {
        "/a": "pages/a2", "/b": "news/b", "/": "pages/hello", "/hello": "pages/hello"}
    cases = {
        "/a": ("document", "a2.md"), " /a/?x=1#f ": ("document", "a2.md#f"), f"{SITE}/b#z": ("document", "../news/b.md#z"),
        "/": ("document", "hello.md"), "?x=1": ("document", "hello.md"), "/news/#x": ("news_index", "../news/index.md#x"),
        "#top": ("not_eligible", "#top"), "mailto:a@b": ("not_eligible", "mailto:a@b"), "tel:1": ("not_eligible", "tel:1"), "": ("not_eligible", ""),
        "//h/x": ("external", "//h/x"), "https://o.example/a": ("external", "https://o.example/a"), f"{SITE}/zip.zip?y": ("kept", f"{SITE}/zip.zip?y"),
        "/zip.zip?y#z": ("site_absolute", f"{SITE}/zip.zip?y#z"), "foo/bar": ("joined", f"{SITE}/foo/bar"), "javascript:x": ("joined", "javascript:x"),
        "https://stage.example/a": ("document", "a2.md"), "https://stage.example/no": ("kept", "https://stage.example/no"),
    }
    links = spark.createDataFrame([(h, "pages/me") for h in cases], "href string, docname string")
    got = lk.resolve(links, targets, SITE, ["portal.example", "stage.example"])
    assert {r.href: (r.outcome, r.resolved) for r in got.collect()} == cases


CATALOGUE = """Intro
| Serial number | Box | Name | Was | Link |
| --- | --- | --- | --- | --- |
| 1 | **Tables** | **Big   one** | old | <https://a.example/1> |
|:--:|:--:|:--:|:--:|:--:|
| 3a |  | Second, DISCONTINUED | **x** | [go](https://a.example/3a) |
| few | cells |
| 9 | Other | no url | | text |
| 71a | | Third | | see [x](ftp://no) or <http://b.example/> |
| 4 | Last | cut | https://c.example |
| 5 |  | D | | | more |
"""


def test_catalogue(spark):
    texts = spark.createDataFrame([("f", CATALOGUE), ("g", "| 1 | | N | | <http://x> |")], "source string, value string")
    got = [tuple(r)[2:] for r in cat.applications(texts).orderBy("source", "pos").collect()]
    # the aligned separator passes as a row and becomes the group of the rows under it
    assert got == [
        ("1", "Tables", "Big one", False, "old", "https://a.example/1"),
        ("3a", ":--:", "Second, DISCONTINUED", True, "x", "https://a.example/3a"),
        ("71a", "Other", "Third", False, "", "http://b.example/"),
        ("1", "", "N", False, "", "http://x"),
    ]
    titled = spark.createDataFrame([("h", '| 1 | B | N | | [go](https://a.example "title") |')], "source string, value string")
    assert cat.applications(titled).count() == 0


def test_catalogue_files(spark, tmp_path):
    rows = [{"id": "3a", "box": "B", "name": "N", "discontinued": True, "previously": "", "url": "u"}, {"id": "10", "box": "C", "name": "M",
             "discontinued": False, "previously": "p", "url": "v"}]
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=1))
    apps = files.read_catalogue(spark, str(tmp_path / "a.json"))
    assert {r.id for r in apps.collect()} == {"3a", "10"}
    out = fresh_path(spark, "apps")
    files.write_catalogue(apps, out)
    assert [r.id for r in files.read_catalogue(spark, out, one_array_per_file=False).orderBy("id").collect()] == ["10", "3a"]


def test_captures(spark):
    df = spark.createDataFrame(
        [("a", 4999, False, 20000), ("b", 5000, False, 11999), ("c", 5001, False, 12000), ("d", 9000, True, None), ("e", None, False, None)],
        "id string, bytes long, timed_out boolean, thumbnail_bytes long")
    status = cat.capture_status(df)
    got = {r.id: (r.ok, r.message, r.blank) for r in status.collect()}
    assert got == {"a": (False, "no image produced", False), "b": (True, "4 KB", True), "c": (True, "4 KB", False),
                   "d": (False, "timed out", False), "e": (False, "no image produced", False)}
    assert {r.id for r in cat.capture_status(df, strict=True).where("ok").collect()} == {"c"}
    assert tuple(cat.capture_summary(status).first()) == (2, 5, 3, 1)
    assert {(r.problem, r.id) for r in cat.capture_problems(status).collect()} == {("failure", "a"), ("failure", "d"), ("failure", "e"), ("blank", "b")}


def test_numbered_copies(spark):
    names = [("p", "a.md"), ("p", "a 2.md"), ("p", "b 12.md"), ("q", "a 3.md"), ("p", "a 2"), ("p", "a  4.md"), ("p", "a 2.tar.gz")]
    got = corpus.numbered_copies(spark.createDataFrame(names, "folder string, name string"))
    assert [tuple(r) for r in got.collect()] == [("p", "a 2.md", "a.md")]


def test_sections_hold_each_page_once(spark):
    pages = spark.createDataFrame([("b",), ("a",), ("z",), ("m",), ("a",)], "slug string")
    sections = [("Start", ["z", "gone"]), ("Ref", ["index", "m"])]
    got = corpus.place_in_sections(pages, sections, "Ref", {"index"}).orderBy("section_ord", "ord").collect()
    assert [(r.caption, r.slug) for r in got] == [("Start", "z"), ("Ref", "index"), ("Ref", "m"), ("Ref", "a"), ("Ref", "b")]


def test_newest_first_keeps_source_order_of_equal_dates(spark):
    df = spark.createDataFrame([("2024", 0), ("2025", 1), ("2024", 2)], "date string, pos int")
    assert {r.pos: r.ord for r in corpus.newest_first(df, "date", "pos").collect()} == {1: 1, 0: 2, 2: 3}


def test_gallery_and_pairing(spark):
    apps = spark.createDataFrame([("1", "X", 0), ("2", "Y", 1), ("3", "X", 2), ("4", "lost", 3)], "id string, box string, pos int")
    groups = spark.createDataFrame([("Y", "y", 1), ("X", "x", 2), ("Z", "z", 3)], "box string, slug string, group_ord int")
    got = cat.gallery(apps, groups).orderBy("group_ord", "member_ord").collect()
    assert [(r.box, r.member_ord, r.id, r.n) for r in got] == [("Y", 1, "2", 1), ("X", 1, "1", 2), ("X", 2, "3", 2)]
    pages = spark.createDataFrame([("x",), ("z",)], "slug string")
    pairing = {r.box: (r.n, r.skip_reason) for r in cat.page_pairing(groups, apps, pages).collect()}
    assert pairing == {"X": (2, None), "Y": (1, "no page"), "Z": (0, "no applications")}


@pytest.mark.parametrize("left,want", [
    (0, ("red", True, "Reporting deadline has passed.")), (1, ("red", False, "0 days and 0 hours")), (30 * 86400, ("orange", False, "30 days and 0 hours")),
    (30 * 86400 - 1, ("red", False, "29 days and 23 hours")), (60 * 86400, ("green", False, "60 days and 0 hours")),
    (60 * 86400 - 1, ("orange", False, "59 days and 23 hours")), (-5, ("red", True, "Reporting deadline has passed.")),
])
def test_deadlines(spark, left, want):
    now = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(now + dt.timedelta(seconds=left), now)], "due timestamp_ntz, now timestamp_ntz")
    assert tuple(df.select(deadline_status(F.col("due"), F.col("now"))).first()[0]) == want


def failing(spark, rows, schema):
    """Rows of which the last one, met after the others have been written, ends its task."""
    good = spark.createDataFrame(rows, schema)
    bad = spark.range(1).select(*[F.expr(f"cast(if(id = 0, raise_error('killed'), null) as {f.dataType.simpleString()})").alias(f.name) for f in good.schema])
    return good.coalesce(1).unionByName(bad)


def test_refresh_clears_folders_without_new_rows(spark):
    path = fresh_path(spark, "docs")
    docs = spark.createDataFrame([("pages/a", "x"), ("news/b", "y")], "docname string, body string")
    files.write_documents(docs, path)
    assert files.read_documents(spark, path).count() == 2
    files.write_documents(docs.where("docname like 'news/%'"), path)
    assert [(r.folder, r.file_name) for r in files.read_documents(spark, path).collect()] == [("news", "b.md")]


def test_a_refresh_that_dies_leaves_the_old_rows(spark):
    path, schema = fresh_path(spark, "docs"), "docname string, body string"
    files.write_documents(spark.createDataFrame([("pages/a", "old")], schema), path)
    open_reader = files.read_documents(spark, path)
    with pytest.raises(Exception, match="killed"):
        files.write_documents(failing(spark, [("pages/a", "new")], schema), path)
    assert [r.body for r in files.read_documents(spark, path).collect()] == ["old"]
    for body in ("new", "newer"):
        files.write_documents(spark.createDataFrame([("pages/a", body)], schema), path)
        if body == "new":  # a reader that began before goes on with its version
            assert [r.body for r in open_reader.collect()] == ["old"]
    assert [r.body for r in files.read_documents(spark, path).collect()] == ["newer"]
    # what is left: the log and the folders of the last two versions
    table = versions.Table(spark, path)
    assert len(table.numbers()) == 2 and len([f for f in os.listdir(path) if not f.startswith(("_", "."))]) == 2
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path + "-none")


def test_two_writers_do_not_make_one_version(spark, monkeypatch):
    path = fresh_path(spark, "docs")
    table = versions.Table(spark, path)
    assert table.commit(["a"]) == 1
    monkeypatch.setattr(versions.Table, "numbers", lambda self: [])
    with pytest.raises(RuntimeError, match="another writer"):
        table.commit(["b"])


def test_a_file_for_every_document(spark):
    path, schema = fresh_path(spark, "files"), "docname string, body string"
    docs = [("pages/x", "a\r\nb \n"), ("news/2024-ä +%20", "é\u2028"), ("news/empty", None), ("top", "t")]
    files.write_document_files(spark.createDataFrame(docs, schema), path)
    folder = files.document_folder(spark, path)
    found = {os.path.relpath(os.path.join(at, f), folder): open(os.path.join(at, f), "rb").read() for at, _, names in os.walk(folder) for f in names if f.endswith(".md")}
    assert found == {f"{n}.md": (b or "").encode() for n, b in docs}
    assert {(r.name, r.body) for r in files.read_document_files(spark, path).collect()} == {(f"{n}.md", b) for n, b in docs if b}
    # a second set of files replaces the first; one that dies doesn't
    with pytest.raises(Exception, match="killed"):
        files.write_document_files(failing(spark, [("pages/z", "z")], schema), path)
    assert files.document_folder(spark, path) == folder
    files.write_document_files(spark.createDataFrame([("pages/y", "y")], schema), path)
    assert [r.name for r in files.read_document_files(spark, path).collect()] == ["pages/y.md"]
    for name in ("../x", "a//b", "/x", ".x", "a/_b", None):
        with pytest.raises(Exception, match="not a file name|null"):
            files.write_document_files(spark.createDataFrame([(name, "x")], schema), path)
    assert [r.name for r in files.read_document_files(spark, path).collect()] == ["pages/y.md"]


def test_repeated_attempts_leave_one_file(tmp_path):
    """A task whose attempt is run twice, and one that broke off before its file was whole."""
    writer = document_files._Writer(str(tmp_path))
    rows = [Row(name="pages/x.md", body="text"), Row(name="pages/y.md", body="more")]
    done = [writer.write(iter(rows)), writer.write(iter(rows))]

    def broken():
        yield rows[0]
        raise OSError("lost")

    with pytest.raises(OSError):
        writer.write(broken())
    writer.commit([done[0], None])
    assert sorted(os.listdir(tmp_path / "pages")) == ["x.md", "y.md"] and (tmp_path / "pages/x.md").read_bytes() == b"text"
    assert (tmp_path / "_SUCCESS").read_text() == "2 files, 8 bytes\n"
    writer.abort([])
    assert os.listdir(tmp_path) == []
