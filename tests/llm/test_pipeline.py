import os

import brute
import pytest

import corpus_pipeline as cp
from aerofolio.llm import quality, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def test_stages(spark, tmp_path):
    """Each stage against the plain version of its operator, on all that the stage before kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    columns = docs.columns
    for i, (name, stage) in enumerate(cp.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()}
        rows = [(r["doc_id"], r["text"]) for r in before.values()]
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(i)))
        after = spark.read.parquet(str(tmp_path / str(i)))
        got = {r["doc_id"]: r for r in after.collect()}
        assert after.columns == (columns if i < len(cp.STAGES) - 1 else [*columns, "copy"]), name
        if i == 0:
            model = quality.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
            assert set(got) == {r["doc_id"] for r in quality.scored(docs, model).where("predicted = 1").collect()}
        if i == 1:
            assert set(got) == {c for _, _, c in brute.simhash(rows)} and after.count() == len(got)
        if i == 2:
            assert set(got) == set(before)
            for d, n, gone, _ in brute.repeats(rows, 13):
                assert len(brute.spaced(got[d]["text"])) == n - gone
                assert got[d] == before[d] if not gone else got[d]["n_chars"] == len(got[d]["text"])
        if i == 3:
            assert set(got) == {r[0] for r in brute.contamination(rows, items, 13) if not r[-1]}
        if i == 4:
            assert set(got) <= set(before) and all(r["copy"] in (0, 1) for r in after.collect())
        docs = after


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES} and set(queries.QUERIES) | {"pipeline"} <= set(names)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    from scripts.check_oracle import check, connect

    text, _ = check(spark, connect(FOLDER), FOLDER, name)
    assert text.startswith("equal"), text


@pytest.mark.parametrize("name, columns", [
    ("op1_embedding_near_dedup", "vec_id n_links component_id kept recall"), ("op2_html_extraction", "page_id url text n_chars"),
    ("op3_simhash_near_dedup", "doc_id fingerprint component_id"), ("op4_benchmark_decontamination", "doc_id n_words n_hit n_items items_sha256 contaminated"),
    ("op5_lm_scoring", "doc_id n_words score"), ("op6_substring_dedup", "doc_id n_words n_removed kept_sha256"),
    ("op7_warc_archives", "page_id payload_bytes payload_digest record_type refers_to problem"), ("op8_mixing_sources", "doc_id size source_size target taken"),
    ("op9_licence_scan", "doc_id n_words n_base first_word last_word base_labels labels score"), ("op10_quality_classifier", "doc_id held_out score predicted"),
    ("op12_token_counts", "doc_id n_bytes n_tokens over_limit"), ("op13_merkle_manifest", "doc_id leaf subroot root proof_sha256 folded_root verified")])
def test_every_row_comes_back(spark, name, columns):
    source = {"op1": "embeddings", "op2": "pages", "op7": "pages"}.get(name.split("_")[0], "documents")
    df = queries.QUERIES[name](spark, FOLDER)
    assert df.columns == columns.split() and df.count() == spark.read.parquet(f"{FOLDER}/{source}.parquet").count()


def tables(spark, folder, rows, marks, items, extra=""):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long" + extra).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_odd_rows_go_through_every_stage(spark, texts, tmp_path):
    """Null and repeated ids, repeated rows, empty and long texts, a column that clashes with results; without labels nothing is rejected."""
    rows = [(i, t, None if k % 7 == 0 else "en", None if k % 5 == 0 else f"s{k % 3}", len(t or ""), k % 2 == 0) for k, (i, t) in enumerate(texts)]
    tables(spark, tmp_path, rows + rows[:9], [], [(1, "a b c"), (None, None)], ", kept boolean")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = cp.good_quality(spark, docs, str(tmp_path))
    assert kept.count() == len(rows) + 9
    unique = cp.near_deduplicated(spark, kept, str(tmp_path))
    prints = sorted(brute.fingerprint(r["text"], 3) for r in unique.collect())
    assert all((a ^ b).bit_count() > 2 for i, a in enumerate(prints) for b in prints[:i]) and unique.columns == docs.columns
    assert {brute.fingerprint(r[1], 3) for r in rows} >= set(prints)
    cut = cp.without_repeats(spark, unique, str(tmp_path))
    assert cut.count() == unique.count()
    clean = cp.decontaminated(spark, cut, str(tmp_path))
    assert clean.columns == docs.columns and clean.count() <= cut.count()
    mixed = cp.run(spark, str(tmp_path))
    assert mixed.columns == [*docs.columns, "copy"]


def test_empty_tables_go_through(spark, tmp_path):
    tables(spark, tmp_path, [], [], [])
    assert cp.run(spark, str(tmp_path)).collect() == []


def test_documents_without_a_length_go_through(spark, tmp_path):
    tables(spark, tmp_path, [(1, "a b", "en", "s", 3), (2, "c d e", "en", "s", 5)], [(1, 1, 0)], [])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").drop("n_chars")
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
    assert sorted(r["doc_id"] for r in docs.collect()) == [1, 2] and docs.columns == ["doc_id", "text", "lang", "source"]
