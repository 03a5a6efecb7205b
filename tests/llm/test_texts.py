"""The text operators against plain versions, on odd rows and on the test tables."""

import os
import struct

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aerofolio.llm import decontaminate, html_text, language_models, licences, mixing, quality, simhash, substrings, tokens
from aerofolio.llm.components import components

FOLDER = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=brute.key)


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_components_of_paths_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 180)] + [(200, 201), (201, 202), (202, 200), (7, 7), (None, 3), (3, None)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "src long, dst long")).collect()))
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 180)} | {i: 200 for i in (200, 201, 202)}
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


@pytest.mark.parametrize("block", [7, 1 << 20])
def test_words(texts, monkeypatch, block):
    import pyarrow as pa

    monkeypatch.setattr(tokens, "BLOCK", block)
    texts = texts if block > 7 else texts[:60]
    column = pa.array([t for _, t in texts], pa.string()).slice(3)
    for limit in (1, 50, 1 << 20):
        for lo, hi, data, bounds in tokens.pieces(column, limit):
            for table, plain in ((tokens.PLAIN, brute.spaced), (tokens.ALNUM_LOWER, brute.alnum)):
                words = tokens.Words(data, bounds, table)
                want = [plain(t) for t in column.slice(lo, hi - lo).to_pylist()]
                assert [words.text(i, i + 1).decode() for i in range(len(words))] == [w for x in want for w in x]
                assert words.counts.tolist() == [len(x) for x in want]
                seen = dict(zip((w for x in want for w in x), words.hashes().tolist()))
                assert len(set(seen.values())) == len(seen)
                text, ends = words.joined()
                assert [text[a:b].decode() for a, b in zip(ends, ends[1:])] == ["".join(w + " " for w in x) for x in want]


@pytest.mark.parametrize("distance, pairs", [(2, 4096), (2, 1), (3, 1), (0, 4096)])
def test_simhash(spark, texts, monkeypatch, distance, pairs):
    monkeypatch.setattr(simhash, "PAIRS", pairs)
    got = simhash.near_duplicates(brute.extra(spark, texts, "doc_id long, text string"), 3, distance)
    assert sorted(((r.id, r.fp & (1 << 64) - 1, r.component) for r in got.collect()), key=brute.key) == brute.simhash(texts, 3, distance)


def test_simhash_thresholds_are_unequal_where_that_is_cheaper():
    cost = [{-1: 0, 0: 5, 1: 6, 2: 90}, {-1: 0, 0: 1, 1: 50, 2: 99}, {-1: 0, 0: 40, 1: 60, 2: 99}]
    assert simhash.allocate(cost, 2) == [1, 0, -1]
    assert simhash.allocate(cost, 0) == [-1, 0, -1]


def test_simhash_keeps_one_of_each(spark, texts):
    df = brute.extra(spark, texts, "doc_id long, text string")
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    groups = {(f, c) for _, f, c in brute.simhash(texts)}
    ids = [r.doc_id for r in kept.collect()]
    assert {c for _, c in groups} <= set(ids) and len(ids) >= len({c for _, c in groups})
    assert simhash.near_duplicates(df.limit(0)).count() == 0


@tables
def test_simhash_on_documents(spark):
    rows = [tuple(r) for r in documents(spark).select("doc_id", "text").collect()]
    got = simhash.near_duplicates(documents(spark))
    assert sorted(((r.id, r.fp & (1 << 64) - 1, r.component) for r in got.collect()), key=brute.key) == brute.simhash(rows)


@pytest.mark.parametrize("least, per_shard", [(1, 1 << 20), (64, 1 << 20), (3, 50)])
def test_substrings(spark, texts, monkeypatch, least, per_shard):
    monkeypatch.setattr(substrings, "LEAST", least)
    monkeypatch.setattr(substrings, "PER_SHARD", per_shard)
    df = brute.extra(spark, texts, "doc_id long, text string")
    got = substrings.remove_repeats(df, 4, with_text=True)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute.repeats(texts, 4)
    assert got.where("n_removed = 0").select("doc_id", "kept").exceptAll(df.select("doc_id", "text")).count() == 0
    assert {"id", "component", "key"} <= set(got.columns) and substrings.remove_repeats(df.limit(0)).count() == 0


def test_a_shard_sends_a_window_once_however_many_documents_have_it():
    passage = " ".join(f"w{i}" for i in range(40))
    docs = pa.table({"id": pa.array(range(500), pa.int64()), "text": pa.array([f"{passage} a{i}" for i in range(500)])})
    sent = substrings._send(13, 1)((pa.scalar(7),), docs)
    shard, n, k = struct.unpack_from("<qqq", sent["body"][0].as_py())
    assert len(sent) == 1 and shard == 7 and k == 28 + 500 and n == 500
    got = substrings._judge((pa.scalar(0),), pa.concat_tables([sent, substrings._send(13, 1)((pa.scalar(8),), docs.slice(400))]))
    # of the second shard the passage and its documents' own windows are compared with the first; equal ids don't repeat each other
    assert got["shard"].to_pylist() == [8] and np.unpackbits(np.frombuffer(got["answer"][0].as_py(), np.uint8, offset=16)).sum() == 28


def test_a_hot_passage(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{passage} x{i} y{i}" if i % 3 == 0 else " ".join(f"{i}z{k}" for k in range(15))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(substrings.remove_repeats(df), "doc_id", "n_words", "n_removed", "kept_sha256") == brute.repeats(rows, 13)


@tables
def test_substrings_on_documents(spark):
    rows = [tuple(r) for r in documents(spark).select("doc_id", "text").collect()]
    assert rows_of(substrings.remove_repeats(documents(spark)), "doc_id", "n_words", "n_removed", "kept_sha256") == brute.repeats(rows, 13)


ITEMS = [(1, "a b C é a"), (1, "b b"), (2, None), (None, "é é é"), (3, "..."), (12, "c"), (4, "a b c é a")]


@pytest.mark.parametrize("block", [4, 4 << 20])
def test_contamination(spark, texts, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    df = brute.extra(spark, texts, "doc_id long, text string")
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    found = decontaminate.contamination(df, items, 4)
    assert rows_of(found, *names) == brute.contamination(texts, ITEMS, 4)
    clean = decontaminate.clean(df, items, size=4)
    assert clean.columns == df.columns and clean.count() == found.where("not contaminated").count()
    assert not decontaminate.contamination(df, items.limit(0)).where("n_hit > 0").count()
    assert decontaminate.contamination(df.limit(0), items).count() == 0


def test_a_passage_that_many_items_share_costs_no_more(spark):
    """A passage of 60 words in 1,600 items, and in one item: the same windows, searched for as often, found as fast."""
    import time

    passage = " ".join(f"w{i}" for i in range(60))
    docs = [f"{passage} tail {i}" for i in range(300)]
    took = {}
    for k in (1, 1600):
        p = decontaminate.Patterns([f"{passage} item{i}" for i in range(k)] + ["short one"], [f"i{i}" for i in range(k)] + [None], 13)
        assert sum(len(x.first) for x in p.searches) == 48 + k + 1 and max(map(len, p.lists)) == k
        (_, _, data, bounds), = tokens.pieces(pa.array(docs))
        words = tokens.Words(data, bounds, tokens.ALNUM_LOWER)
        start = time.perf_counter()
        found = p.found(words)
        took[k] = time.perf_counter() - start
        assert len(found[0]) == 48 * 300
    assert took[1600] < 3 * took[1] + 0.2


@tables
def test_contamination_on_documents(spark):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    rows = [tuple(r) for r in documents(spark).select("doc_id", "text").collect()]
    got = decontaminate.contamination(documents(spark), items)
    assert rows_of(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == brute.contamination(rows, [tuple(r) for r in items.collect()], 13)


PHRASES = {"a b": "ab", "b": "b", "c é a": "cea", "a": "a"}


def test_licence_phrases(spark, texts):
    df = brute.extra(spark, texts, "doc_id long, text string")
    assert rows_of(licences.scan(df, phrases=PHRASES), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == brute.phrases(texts, PHRASES)
    assert licences.scan(df.limit(0)).count() == 0


def test_licence_spans(spark):
    notice = licences.NOTICES["mit"][2].split()
    changed = " ".join(["Intro."] + notice[:20] + ["some", "thing"] + notice[22:40] + notice[41:] + ["end"])
    rows = {r.doc_id: r for r in licences.scan(spark.createDataFrame([(1, changed), (2, " ".join(notice[:30])), (3, "no notice, all rights reserved"), (4, None)], "doc_id long, text string")).collect()}
    assert rows[1].labels == "mit" and rows[1].base_labels == "" and 0.9 < rows[1].score < 1 and rows[1].spans[0].first == 1
    assert rows[2].labels == "" and rows[2].score == 0
    assert rows[3].labels == "reserved" and rows[3].score == 1 and rows[4].score == 0 and rows[4].first_word is None


def test_automaton_knows_every_run():
    texts = [[0, 1, 0, 0, 1], [1, 0, 0], [2], [0, 1, 2, 0, 1]]
    a = licences.Automaton(texts)
    for t in texts:
        for i in range(len(t)):
            for j in range(i + 1, len(t) + 1):
                want = {(k, e) for k, x in enumerate(texts) for e in range(j - i, len(x) + 1) if x[e - (j - i) : e] == t[i:j]}
                assert set(a.ends[a.find(t[i:j])]) == want and len(a.ends[a.find(t[i:j])]) == len(want)


@pytest.mark.parametrize("hot, flush, sample", [(1 << 16, 1 << 20, 1 << 30), (3, 30, 1 << 30), (0, 1 << 20, 1)])
def test_losses(spark, texts, monkeypatch, hot, flush, sample):
    """However many words and pairs are counted apart, none of them included."""
    monkeypatch.setattr(language_models, "FLUSH", flush)
    monkeypatch.setattr(language_models, "SAMPLE", sample)
    df = brute.extra(spark, texts, "doc_id long, text string")
    for target in ({1, 2, 8}, set(), {1, 2, 3, 4, 5, 6, 7, 8, 9, 20, 100}):
        ids = spark.createDataFrame([(i,) for i in [*target, *target]] + [(None,)], "doc_id long")
        got = sorted((tuple(r) for r in language_models.cross_entropy_difference(df, ids, hot).collect()), key=lambda r: (str(r[0]), r[1:]))
        got, want = (sorted(((str(r[0]), r[1], round(r[2], 6)) for r in x)) for x in (got, brute.losses(texts, target)))
        assert [r[:2] for r in got] == [r[:2] for r in want] and all(abs(a[2] - b[2]) < 2e-6 for a, b in zip(got, want))
    assert language_models.cross_entropy_difference(df.limit(0), ids).count() == 0


def test_every_rare_word_counts(spark):
    """More words than are counted apart, each in two texts of one kind: texts of the target's words score below the others."""
    rows = [(i, " ".join(f"{'good' if i % 2 else 'bad'}{(i // 4) * 40 + k}" for k in range(40))) for i in range(400)]
    ids = spark.createDataFrame([(i,) for i in range(1, 400, 4)], "doc_id long")
    got = {r["id"]: r["score"] for r in language_models.cross_entropy_difference(spark.createDataFrame(rows, "doc_id long, text string"), ids, hot=100).collect()}
    assert max(got[i] for i in range(3, 400, 4)) < min(got[i] for i in range(0, 400, 2))


def test_mix(spark, texts):
    df = brute.extra(spark, [(i, t, None if i is None else f"s{i % 4}") for i, t in texts], "doc_id long, text string, source string")
    rows = mixing.rated(df).collect()
    sizes = {}
    for r in rows:
        assert r["size"] == len(brute.spaced(r["text"]))
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    target = {r["source"]: r["target"] for r in rows}
    assert abs(sum(target.values()) - 1.5 * sum(sizes.values())) < 1e-6
    weights = dict(zip(sorted(target, key=lambda s: (s is None, s)), [5, 2, 1, 5, 2]))
    level = max(target[s] / weights[s] for s in target)
    for s, t in target.items():
        assert abs(t - min(2 * sizes[s], level * weights[s])) < 1e-6
    assert all(r["copies"] in (int(r["target"] / r["source_size"]), int(r["target"] / r["source_size"]) + 1) for r in rows if r["source_size"])
    mix = mixing.mixed(df)
    assert mix.columns == [*df.columns, "copy"] and mix.count() == sum(r["copies"] for r in rows)
    assert mixing.rated(df.limit(0)).count() == 0 and sorted(map(str, mixing.rated(df).collect())) == sorted(map(str, rows))


def test_quality(spark):
    good = [(i, f"Plain words stand here, number {i}, and go on in a calm way. " * 8) for i in range(0, 400, 2)]
    bad = [(i, f"### $$$ {i} BUY!!! *** && %%% " * 12) for i in range(1, 400, 2)]
    docs = brute.extra(spark, good + bad + [(1000, None), (1001, ""), (None, "text"), (1000, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(400)] + [(0, 1), (1, 1), (None, 1), (5000, 0), (2, None)], "doc_id long, quality int")
    model = quality.train(docs, labels, sample=100)
    rows = quality.scored(docs, model).collect()
    assert len(rows) == 404 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 400]
    assert len(held) > 60 and all(r["predicted"] == 1 - r["doc_id"] % 2 for r in held)
    assert len({r["score"] for r in rows if r["doc_id"] in (1000, 1001)}) == 1
    nothing = quality.train(docs, labels.limit(0))
    assert not nothing.fitted and {r["score"] for r in quality.scored(docs, nothing).collect()} == {0.5}
    assert not quality.train(docs, labels.where("quality = 1")).fitted
    assert quality.scored(docs.limit(0), model).count() == 0


def test_quality_scores_equal_a_plain_version(spark):
    """Scores from features computed plainly with the same dictionaries, of very long texts too."""

    rng = __import__("random").Random(1)
    rows = [(i, " ".join(rng.choice(["calm", "words", "go", "on"] if i % 2 else ["###", "BUY", "now", "go"]) for _ in range(rng.choice([1, 5, 90, 900])))) for i in range(300)]
    rows += [(301, "calm words go on " * 40000), (302, "### BUY now " * 30000), (303, None), (304, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    model = quality.train(docs, labels, sample=1000, blocks=4)
    got = {r["doc_id"]: r["score"] for r in quality.scored(docs, model).collect()}
    for i, text in rows:
        assert abs(got[i] - brute.compressed_score(text or "", model)) < 1e-12
    assert model.fitted and got[301] > 0.9 > 0.1 > got[302]


def test_quality_fit_is_flat_at_its_weights():
    import numpy as np

    rng = np.random.default_rng(2)
    x, y, w = rng.normal(size=(200, 5)), rng.integers(0, 2, 200), rng.random(200) + 0.5
    beta, mean, spread = quality._logistic(x, y, w)

    def loss(b):
        z = np.c_[np.ones(200), (x - mean) / spread] @ b
        return (w * (np.logaddexp(0, z) - y * z)).sum() + 0.5e-2 * (b @ b)

    assert all(loss(beta) <= loss(beta + d) for d in np.r_[np.eye(6), -np.eye(6)] * 1e-3)


def test_quality_learns_nothing_from_held_out_rows(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * 9) for i in range(80)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    other = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.train(docs, x) for x in (labels, other))
    assert a.good == b.good and a.bad == b.bad and (a.weights == b.weights).all()


PAGES = {
    "<p>a<p>b  c\n d": "a\n\nb c d",
    "<nav><ul><li><a href=1>Home</a></ul></nav><div class='ad'>Buy this, now.</div><article><h1>T &amp; U</h1><p><b>One.<br>Two<p>Three<script>x='<p>'</script></article><footer>f</footer>": "T & U\n\nOne. Two\n\nThree",
    "<header><h1>Site</h1></header><main><h1>T</h1><p>Body, text.</p><ul><li>i<li>j</ul><section id=comments><p>Nice post, really.</section></main>": "T\n\nBody, text.\n\ni\n\nj",
    "<article><header><h1>Head</h1></header><p>para</p><article><p>reply</p></article><form>q<p>w</form><div class='share-bar'>s</div>tail</article>": "Head\n\npara\n\ntail",
    "<div id=content><h2>H</h2><p>Prose, prose. Prose.</p><p>Short.</p></div><div class=sidebar><p>Side, text.</p></div>": "H\n\nProse, prose. Prose.\n\nShort.",
    "": "", "no markup": "no markup", "<style>p{}": "", "1 < 2 &lt; 3": "1 < 2 < 3",
}


def test_pages(spark):
    rows = [(i, "u", h) for i, h in enumerate(PAGES)] + [(None, None, None), (1, "u", "x" * 300000)]
    got = html_text.extract(brute.extra(spark, rows, "page_id long, url string, html string")).collect()
    assert [r["text"] for r in got[: len(PAGES)]] == list(PAGES.values())
    assert [(r["text"], r["n_chars"]) for r in got[len(PAGES) :]] == [("", 0), ("x" * 300000, 300000)]


PROSE = "<p>Prose goes on, and on. It ends.</p>"
NAMED = {
    f"<article>{PROSE}<h2 id='how-to-share-code'>Share</h2>{PROSE}<section id=related-work data-id=menu title='a class=ad'>{PROSE}</section><p class=notice>Note.</p></article>": 5,
    f"<article class='post comments-open'>{PROSE}</article>": 1,
    f"<div class='layout has-sidebar'><article>{PROSE}{PROSE}</article></div>": 2,
    f"<body><form action=x><nav><a href=1>Home</a></nav><div>{PROSE * 3}</div></form></body>": 3,
    f"<div class=sidebar>{PROSE * 3}</div><footer>f</footer>": 3,
    # what stands in the article but isn't of it, by the names of its container
    f"<article>{PROSE * 8}<div class='related-posts'><p>Another, post.</p></div><section class='post-comments'>{PROSE}</section><div class=ad-slot>Buy.</div><div id=cookie-policy-banner>{PROSE}</div></article>": 8,
    f"<article>{PROSE * 8}<article><p>Nice, this.</p></article><article>{PROSE}</article></article>": 8,
    # an article within an article that is nearly all of it
    f"<article><h1>T</h1><article>{PROSE * 10}</article></article>": 11,
    f"<article>{PROSE}<p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math>, and on.</p></article>": 2,
}


def test_formulas_are_text():
    assert html_text.main_text("<article><p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math>, and on.</p></article>") == "So x=1, and on."


def test_names_of_elements_do_not_remove_the_article():
    assert [html_text.main_text(h).count("\n\n") + 1 if html_text.main_text(h) else 0 for h in NAMED] == list(NAMED.values())


SPREAD_OUT = {
    f"<div id=content><div class=intro>{PROSE}</div><div class=body>{PROSE * 40}</div><div class=end>{PROSE}</div></div>": 42,
    f"<div><div>{PROSE}</div><div><div>{PROSE}</div><div>{PROSE * 12}</div></div></div>": 14,
    f"<div><p>Before, it.</p></div><main>{PROSE * 40}</main>": 40,
}


def test_the_walk_loses_no_selected_text():
    assert [html_text.main_text(h).count("\n\n") + 1 for h in SPREAD_OUT] == list(SPREAD_OUT.values())


@tables
def test_pages_of_the_test_table(spark):
    """Each page's article, cut out and stripped by hand."""
    import html
    import re

    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r["page_id"]] == "\n\n".join(x for x in parts if x)
