import random
import tracemalloc
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
import zstandard

from aerofolio.llm import neighbours, warc


def odd_vectors():
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.standard_normal(3)]) for i in range(200)]
    return rows + [
        (None, [1.0, 0.0, 0.0]), (None, [2.0, 0.0, 0.0]), (5, [1.0, 0.0, 0.0]), (7, None), (8, [0.0, 0.0, 0.0]), (9, [1.0, None, 0.0]), (10, [float("nan"), 1.0, 1.0]),
        (11, []), (12, [1.0, 2.0]), (13, [2.0, 4.0]), (14, [1e300, 1e300]), (None, [float("inf"), 0.0])]


def test_links_between_vectors(spark):
    rows = odd_vectors()
    df = brute.extra(spark, rows, "vec_id long, embedding array<double>")
    got = neighbours.near_duplicates(df).collect()
    assert sorted((tuple(r)[:4] for r in got), key=brute.key) == brute.vectors(rows)
    assert neighbours.near_duplicates(df.limit(0)).count() == 0


def test_dense_group_larger_than_lists_and_blocks(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(16)
    rows = [(i, [float(x) for x in centre + 0.05 * rng.standard_normal(16)]) for i in range(400)] + [(1000 + i, [float(x) for x in rng.standard_normal(16)]) for i in range(1200)]
    got = neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((tuple(r)[:4] for r in got), key=brute.key) == brute.vectors(rows)
    assert got[0]["recall"] >= 0.99


def test_groups_larger_than_lists_that_link_across(spark):
    """Lists hold their own cluster only; in the second pair of clusters but few of the members link across."""
    rng = np.random.default_rng(5)
    rows = []
    for cosine in (0.97, 0.945):
        a, b = np.linalg.qr(rng.standard_normal((64, 2)))[0].T
        for centre in (a, cosine * a + np.sqrt(1 - cosine**2) * b):
            rows += [centre + 0.0125 * rng.standard_normal(64) for _ in range(200)]
    rows += list(rng.standard_normal((400, 64)))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    got = neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want = brute.vectors(rows)
    assert {c for i, _, c, _ in want if i < 800} == {0, 400} and 0 < sum(k >= 200 for i, k, _, _ in want if 400 <= i < 800) < 400
    assert sorted((tuple(r)[:4] for r in got), key=brute.key) == want


@pytest.mark.parametrize("width", [64, 4096, 8192])
def test_bytes_of_wide_vectors_keep_the_margin(width):
    rng = np.random.default_rng(6)
    a = rng.standard_normal((8, width))
    x = np.concatenate([a, 0.95 * a + np.sqrt(1 - 0.95**2) * rng.standard_normal((8, width))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = pa.array(range(16))
    batch = pa.RecordBatch.from_arrays([ids, pa.array([r.tobytes() for r in x], pa.binary()), ids], names=["id", "unit", "group"])
    small = next(neighbours._leaves(1, 0, 1)(iter([batch])))["small"]
    assert np.abs(neighbours._similar(small) - x @ x.T).max() < neighbours.MARGIN


def outlying(rng, n, width, share):
    """Pairs at cosine 0.951 whose first component holds a share of the energy."""
    rows = []
    for _ in range(n):
        a, b = rng.standard_normal((2, width))
        a[0] = b[0] = 0
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rest = (0.951 - share) / (1 - share)
        for v in (a, rest * a + np.sqrt(1 - rest**2) * b):
            v = np.sqrt(1 - share) * v
            v[0] = np.sqrt(share)
            rows.append(v)
    return rows


@pytest.mark.parametrize("share", [0.0, 0.3, 0.6, 0.9])
def test_bytes_of_vectors_with_an_outlying_component_keep_the_margin(share):
    x = np.array(outlying(np.random.default_rng(7), 10, 8224, share))
    ids = pa.array(range(20))
    batch = pa.RecordBatch.from_arrays([ids, pa.array([r.tobytes() for r in x], pa.binary()), ids], names=["id", "unit", "group"])
    small = next(neighbours._leaves(1, 0, 1)(iter([batch])))["small"]
    assert np.abs(neighbours._similar(small) - x @ x.T).max() < neighbours.MARGIN / 4


def test_links_of_vectors_with_an_outlying_component(spark):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(outlying(np.random.default_rng(8), 30, 8224, 0.3) + outlying(np.random.default_rng(9), 30, 8224, 0.6))]
    got = neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((tuple(r)[:4] for r in got), key=brute.key) == brute.vectors(rows) and sum(r["n_links"] for r in got) >= 120


def test_a_search_that_stays_below_its_target_ends_with_an_error(spark, monkeypatch):
    """Leaves of two vectors and no rounds: links are missed however often the lists are made longer."""
    rng = np.random.default_rng(10)
    rows = [(i, [float(x) for x in rng.standard_normal(3)]) for i in range(400)]
    monkeypatch.setattr(neighbours, "_descend", lambda graph, *rest: graph.limit(3))
    with pytest.raises(RuntimeError, match="links of the sampled vectors"):
        neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), longer=1)


COLUMNS = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
PAGES = [
    (5, "u", "abc"), (3, "u\r\n x: y%41é", "abc"), (3, "z", "abc"), (None, "q", "abc"), (None, None, None), (7, None, ""), (8, "", ""), (9, "x", "é" * 100000),
    (10, "x", "é" * 100000), (11, "b", "P*M\x18\x00\x00\x00\x00 (µ/ý"), (-4, "n", "neg"),
]


def test_audit_holds_a_part_of_a_batch_at_a_time():
    """Cosines of a batch of 10,000 vectors with a sample of 2,048 would take 164 MB, and as much again to count by copies."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((10_000, 4))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    units, copies = pa.array([r.tobytes() for r in x] + [x[0, :2].tobytes()], pa.binary()), np.arange(10_001) % 3 + 1
    batch = pa.RecordBatch.from_arrays([pa.array(range(10_001)), units, pa.array(copies)], names=["id", "unit", "copies"])

    class Sample:
        value = (np.arange(2048), [r.tobytes() for r in x[:2048]])

    tracemalloc.start()
    got = [r for b in neighbours._audit(Sample, 0.95)(iter([batch])) for r in b.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    linked = x[:2048] @ x.T >= 0.95
    linked[range(2048), range(2048)] = False
    want = (linked * copies[:10_000]).sum(1)
    assert {r["id"]: r["n"] for r in got} == {i: n for i, n in enumerate(want.tolist()) if n}
    assert peak < 60e6


@pytest.mark.parametrize("least, size", [(0, 1 << 20), (4, 100), (0, 1)])
def test_archives_come_back_whole(spark, least, size):
    df = brute.extra(spark, PAGES, "page_id long, url string, html string")
    got = warc.archived(df, min_bytes=least, archive_bytes=size)
    assert Counter(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in got.select(COLUMNS).collect()) == brute.archived(PAGES, least)
    assert got.where("problem is not null").count() == 0


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archived(df).count() == 0


def archive(records, dictionary=b"", **options):
    d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    z = zstandard.ZstdCompressor(dict_data=d, **options)
    return (warc.lead_frame(dictionary) if dictionary else b"") + b"".join(z.compress(r) for r in records)


def test_reader_takes_dictionaries_checksums_and_compressed_dictionaries():
    texts = [("<html><p>page %d and some text that repeats</p>" % random.Random(i).randint(0, 999)).encode() * 3 for i in range(300)]
    records = [warc.record(i, "http://h/", t, None, "2024-01-01T00:00:00Z") for i, t in enumerate(texts)]
    d = zstandard.train_dictionary(2048, records).as_bytes()
    packed = zstandard.ZstdCompressor().compress(d)
    plain = archive(records, d, write_checksum=True)
    for data in (plain, warc.lead_frame(packed) + plain[8 + len(d) :], archive(records)):
        got = list(warc.read_archive(data))
        assert [r["payload"] for r in got] == texts and not any(r["problem"] for r in got)


def test_reader_says_what_is_wrong():
    good = warc.record(1, "http://h/", b"payload", None, "2024-01-01T00:00:00Z")
    broken = [good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"payload", b"another payload", 1), good.replace(b"payload\r\n\r\n", b"paylOad\r\n\r\n"), good[:-4], good.replace(b"WARC-Date", b"X-Date"), b"", b"\xff\xfe"]
    got = list(warc.read_archive(archive([*broken, good])))
    assert all(r["problem"] and r["page_id"] is None for r in got[:-1]) and len(got) == len(broken) + 1
    assert got[-1]["payload"] == b"payload" and got[-1]["problem"] is None
    cut = list(warc.read_archive(archive([good, good])[:-3]))
    assert [bool(r["problem"]) for r in cut] == [False, True]
    assert [r["problem"] for r in warc.read_archive(b"no zstandard")] == ["no frame at byte 0"]
