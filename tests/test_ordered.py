"""Exact ordered computations against brute force, with one key holding most rows and many slices."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from aerofolio.operators import ordered as o


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    keys = ["hot"] * 700 + [f"k{i % 40}" for i in range(300)] + [None] * 20
    return [(k, i, rnd.choice([None, None, None, f"v{i}"]), rnd.randrange(12) / 4) for i, k in enumerate(keys)]


@pytest.fixture(scope="module")
def table(spark, rows):
    mixed = rows[:]
    random.Random(5).shuffle(mixed)
    return spark.createDataFrame(mixed, "k string, n int, v string, x double").repartition(5)


def groups(rows):
    out = defaultdict(list)
    for r in rows:
        out[r[0]].append(r)
    return out


@pytest.mark.parametrize("slices", [1, 13])
def test_fill_forward(table, rows, slices):
    got = {r.n: r.f for r in o.fill_forward(table, ["k"], ["n"], "v", "f", slices).collect()}
    want = {}
    for members in groups(rows).values():
        last = None
        for _, n, v, _ in members:
            last = v if v is not None else last
            want[n] = last
    assert got == want


@pytest.mark.parametrize("slices", [1, 13])
def test_row_numbers(table, rows, slices):
    got = {r.n: r.i for r in o.row_numbers(table, ["k"], ["x desc", "n"], "i", slices).collect()}
    want = {}
    for members in groups(rows).values():
        for i, r in enumerate(sorted(members, key=lambda r: (-r[3], r[1])), 1):
            want[r[1]] = i
    assert got == want


def test_row_numbers_over_everything(table, rows):
    got = sorted((r.n, r.i) for r in o.row_numbers(table, [], ["n"], "i", 9).collect())
    assert got == [(n, n + 1) for n in range(len(rows))]


@pytest.mark.parametrize("descending", [True, False])
def test_ranks(table, rows, descending):
    got = {r.n: (r.r, r.d) for r in o.ranks(table, ["k"], "x", descending, "r", "d").collect()}
    for members in groups(rows).values():
        for r in members:
            before = [m[3] for m in members if (m[3] > r[3] if descending else m[3] < r[3])]
            assert got[r[1]] == (len(before) + 1, len(set(before)) + 1)


def test_quantiles(table, rows):
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = {r.k: r for r in o.quantiles(table, ["k"], "x", probs).collect()}
    for k, members in groups(rows).items():
        xs = sorted(r[3] for r in members)
        for name, p in probs.items():
            at = (len(xs) - 1) * p
            lo, hi = xs[int(at)], xs[min(int(at) + 1, len(xs) - 1)]
            assert got[k][name] == pytest.approx(lo + (hi - lo) * (at - int(at)))


def test_latest(table, rows):
    got = {r.k: r.n for r in o.latest(table, ["k"], ["x", "n"]).collect()}
    assert got == {k: max(m, key=lambda r: (r[3], r[1]))[1] for k, m in groups(rows).items()}


def test_text_order_with_nulls_and_ties(spark):
    values = ["b", None, "a", "c", "a", "", "é", None, "b"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "s string, i int")
    up = sorted(range(len(values)), key=lambda i: (values[i] is not None, (values[i] or "").encode(), i))
    down = sorted(range(len(values)), key=lambda i: (values[i] is None, [-b for b in (values[i] or "").encode()] + [1], i))
    for order, want in ((["s", "i"], up), (["s desc", "i"], down)):
        got = {r.i: r.n for r in o.row_numbers(df, [], order, "n", 4).collect()}
        assert [i for i, _ in sorted(got.items(), key=lambda x: x[1])] == want, order


def test_no_rows(spark):
    none = spark.createDataFrame([], "k string, n int, v string")
    assert o.row_numbers(none, ["k"], ["n"], "i").count() == 0 and o.fill_forward(none, ["k"], ["n"], "v", "f").count() == 0


def exchanges(df):
    """Of whole rows: what is carried from slice to slice is aggregated before it moves."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange hashpartitioning" in line or "Exchange range" in line for line in text.splitlines())


def test_one_exchange_of_rows_and_no_write(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(2000).selectExpr("id % 3 as k", "id as n", "repeat('x', 50) as pad").write.parquet(path)
    df = spark.read.parquet(path)
    plan = o.row_numbers(df, ["k"], ["n desc"], "i", 6)
    # leaves of the plan, not its text, in which Spark shortens long folder names
    lists = spark._jvm.scala.jdk.javaapi.CollectionConverters
    scans = [list(leaf.requiredSchema().fieldNames()) for leaf in lists.asJava(plan._jdf.queryExecution().sparkPlan().collectLeaves())]
    assert len(scans) > 1 and sum("pad" in columns for columns in scans) == 1
    assert all(f.startswith(f"file://{path}/") for f in plan.inputFiles())
    # the window's own exchange; two more move the aggregated states
    assert exchanges(plan) == 3
    assert sorted(r.i for r in plan.where("k = 1").collect()) == list(range(1, 668))
