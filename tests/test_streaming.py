"""Each streaming job against its batch twin, with the feed landing in several batches."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from aerofolio.operators.air import observations as air
from aerofolio.operators.ordered import latest
from aerofolio.session import fresh_path
from aerofolio.sources import versions
from aerofolio.streaming import feed as fd

SCHEMA = "sampling_point long, pollutant string, ts timestamp_ntz, conc double, event_id long"


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def land(spark, folder, name, rows):
    """One file per delivery; the reader takes older files first."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


@pytest.fixture
def landed(spark, tmp_path):
    def read():
        return fd.landed(spark, f"{tmp_path}/*", spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)

    return tmp_path, read


def test_latest_values_over_batches_and_restart(spark, landed):
    folder, read = landed
    out, state = fresh_path(spark, "out"), fresh_path(spark, "state")

    def run():
        changes = fd.latest_per_key(read(), ["sampling_point", "pollutant"], "event_id", out, state)
        return changes, {(r.sampling_point, r.pollutant): (r.event_id, r.conc) for r in fd.current(changes, ["sampling_point", "pollutant"], "event_id").collect()}

    land(spark, folder, "a", [(1, "x", at(i), float(i), i) for i in range(50)] + [(2, "x", at(3), 3.0, 900)])
    land(spark, folder, "b", [(1, "x", at(10), -1.0, 901), (2, "x", at(3), 4.0, 902), (1, "y", at(0), 0.5, 903)])
    _, got = run()
    assert got == {(1, "x"): (49, 49.0), (2, "x"): (902, 4.0), (1, "y"): (903, 0.5)}
    land(spark, folder, "c", [(1, "x", at(60), 60.0, 904), (2, "x", at(1), 1.0, 905)])
    changes, got = run()
    assert got == {(1, "x"): (904, 60.0), (2, "x"): (902, 4.0), (1, "y"): (903, 0.5)}
    # what a restart finds is what the batches before have left: one row per batch and key
    assert changes.groupBy("sampling_point", "pollutant", "event_id").count().where("count > 1").count() == 0


def test_latest_values_equal_the_batch_twin(spark, landed):
    """Null and equal times, NaN and null values, null ties, keys in several batches."""
    folder, read = landed
    nan = float("nan")
    parts = [
        [(1, "x", None, 1.0, 1), (1, "x", at(2), 2.0, 2), (2, "x", at(1), nan, 3), (3, "x", None, 9.0, 4)],
        [(1, "x", None, 5.0, 5), (2, "x", at(1), 4.0, None), (4, "x", at(7), None, 6), (4, "x", at(7), 1.0, 7)],
        [(1, "x", at(1), 7.0, 8), (2, "x", at(0), 1.0, 9), (5, "y", at(3), nan, 10)],
    ]
    for name, rows in zip("abc", parts):
        land(spark, folder, name, rows)
    keys = ["sampling_point", "pollutant"]
    got = fd.current(fd.latest_per_key(read(), keys, "event_id", fresh_path(spark, "twin")), keys, "event_id")
    twin = latest(spark.createDataFrame([r for p in parts for r in p], SCHEMA).where("ts is not null"), keys, ["ts", "event_id"])
    shown = lambda df: sorted(str((r.sampling_point, r.pollutant, r.conc, r.event_id)) for r in df.collect())
    assert shown(got) == shown(twin) and len(shown(got)) == 4


def test_repeated_deliveries(spark, landed):
    folder, read = landed
    rows = [(1, "x", at(i), float(i), i) for i in range(20)]
    land(spark, folder, "a", rows)
    land(spark, folder, "b", rows[10:] + [(1, "x", at(20), 20.0, 20)])
    got = fd.appended(fd.once_delivered(read(), ["event_id"], "2 hours"))
    assert sorted(r.event_id for r in got.collect()) == list(range(21))


def test_windows_match_the_batch_result_and_drop_late_rows(spark, landed):
    folder, read = landed
    rows = [(1, "x", at(i * 7), float(i), i) for i in range(60)]
    land(spark, folder, "a", rows)
    # Spark drops late rows by the watermark of the batch before, so the late row comes one batch later
    land(spark, folder, "b", [(1, "x", at(424), 1.0, 1000)])
    land(spark, folder, "c", [(1, "x", at(2), 1000.0, 999), (1, "x", at(425), 1.0, 1001)])
    got = {r.window_start: (r.n, r["mean"]) for r in fd.appended(fd.window_means(read(), ["pollutant"], "conc", "10 minutes", "1 hour")).collect()}
    batch = (
        spark.createDataFrame(rows, SCHEMA).groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"), F.avg("conc").alias("m"))
        .where(F.col("w.end") <= F.lit(at(415))).select("w.start", "n", "m")
    )
    assert got == {r.start: (r.n, pytest.approx(r.m)) for r in batch.collect()}


def test_sessions(spark, landed):
    folder, read = landed
    land(spark, folder, "a", [(1, "x", at(m), 1.0, m) for m in (0, 5, 10, 100, 105)] + [(2, "x", at(500), 1.0, 500)])
    got = fd.appended(fd.sessions(read(), ["sampling_point"], "10 minutes", "30 minutes"))
    assert sorted((r.session_start, r.session_end, r.n) for r in got.collect()) == [(at(0), at(40), 3), (at(100), at(135), 2)]


def test_reading_the_latest_values_touches_one_folder(spark, landed, monkeypatch):
    """Fifty batches, with merges on the way; a second run without a checkpoint of its own goes on where the first one ended."""
    folder, read = landed
    monkeypatch.setattr(fd, "CHANGES", 5)
    out, keys = fresh_path(spark, "out"), ["sampling_point", "pollutant"]
    for n in range(50):
        land(spark, folder, f"{n:02d}", [(n % 3, "x", at(n), float(n), n)])
    changes = fd.latest_per_key(read(), keys, "event_id", out)
    table = versions.Table(spark, out)
    assert len(table.state()["folders"]) == 1 and changes.count() == 3
    assert {os.path.dirname(f) for f in changes.inputFiles()} == {f"file://{p}" if p.startswith("/") else p for p in table.paths()}
    assert len([f for f in os.listdir(out) if not f.startswith(("_", "."))]) <= 7  # no folder of a version that is gone
    # the landed files may be gone by the next run
    before = {tuple(r) for r in fd.current(changes, keys, "event_id").collect()}
    for n in range(49):
        shutil.rmtree(f"{folder}/{n:02d}")
    land(spark, folder, "new", [(7, "x", at(99), 1.0, 99)])
    after = {tuple(r) for r in fd.current(fd.latest_per_key(read(), keys, "event_id", out), keys, "event_id").collect()}
    assert before < after and len(after) == 4


def test_keys_that_fell_silent_expire(spark, landed):
    folder, read = landed
    land(spark, folder, "a", [(1, "x", at(0), 1.0, 1), (2, "x", at(200), 2.0, 2)])
    land(spark, folder, "b", [(3, "x", at(190), 3.0, 3)])
    keys = ["sampling_point", "pollutant"]
    got = fd.latest_per_key(read(), keys, "event_id", fresh_path(spark, "out"), expire="2 hours")
    assert sorted(r.sampling_point for r in got.collect()) == [2, 3]


def test_a_batch_that_is_run_again_changes_nothing(spark, landed):
    """As after a loss between a batch's table and the stream's own log: the same rows under another checkpoint."""
    folder, read = landed
    out, keys = fresh_path(spark, "out"), ["sampling_point", "pollutant"]
    land(spark, folder, "a", [(1, "x", at(0), 1.0, 1), (1, "x", at(5), 2.0, 2)])
    got = [sorted(map(tuple, fd.current(fd.latest_per_key(read(), keys, "event_id", out, fresh_path(spark, "again")), keys, "event_id").collect())) for _ in range(2)]
    assert got[0] == got[1] and len(got[0]) == 1


def test_means_and_sessions_of_files_that_land_twice(spark, landed, tmp_path_factory):
    """In different batches; the results are those of files that land once."""
    rows = [[(1 + i % 2, "x", at(30 * b + i), float(i), 100 * b + i) for i in range(30)] for b in range(5)]
    end = [(1, "x", at(1000), 0.0, 999)]

    def results(order, name):
        folder = tmp_path_factory.mktemp(name)
        for n, part in enumerate(order):
            land(spark, folder, f"{n:02d}", part)
        feed = lambda: fd.once_delivered(fd.landed(spark, f"{folder}/*", spark.createDataFrame([], SCHEMA).schema, files_per_batch=1), ["event_id"], "90 minutes")
        means = fd.appended(fd.window_means(feed(), ["pollutant"], "conc", None, "20 minutes"))
        spells = fd.appended(fd.sessions(feed(), ["sampling_point"], None, "15 minutes"))
        return sorted(map(tuple, means.collect())), sorted(map(tuple, spells.collect()))

    once = results([*rows, end, end], "once")
    twice = results([rows[0], rows[1], rows[0], rows[2], rows[1], rows[3], rows[2], rows[3], rows[4], rows[4], end, end], "twice")
    assert once == twice and len(once[0]) == 8 and len(once[1]) == 2


def test_preferred_rows_in_any_order_of_arrival(spark, landed, tmp_path_factory):
    """After the last batch as the batch operator has it, whichever flow lands first; before its time is over an unvalidated row waits."""
    provisional = [(1, "x", at(i), float(i), i) for i in range(40)]
    validated = [(1, "x", at(i), 100.0 + i, i) for i in range(0, 40, 3)] + [(2, "x", at(5), 7.0, 5)]
    end = [(9, "x", at(500), 0.0, 500)]
    schema = spark.createDataFrame([], SCHEMA).schema
    want = air.preferred(spark.createDataFrame(validated, SCHEMA), spark.createDataFrame(provisional, SCHEMA), ["sampling_point", "pollutant", "ts"], "event_id")
    want = sorted((r.sampling_point, r.ts, r.conc, r.flow) for r in want.collect())
    for name, first, second in (("a", "p", "v"), ("b", "v", "p")):
        folders = {k: tmp_path_factory.mktemp(name + k) for k in "pv"}
        rows = {"p": provisional, "v": validated}
        state, out = fresh_path(spark, "state"), fresh_path(spark, "out")

        def run():
            feeds = [fd.landed(spark, f"{folders[k]}/*", schema, files_per_batch=1) for k in "vp"]
            got = fd.appended(fd.preferred(*feeds, ["sampling_point", "pollutant"], "1 hour"), out, state)
            return sorted((r.sampling_point, r.ts, r.conc, r.flow) for r in got.where("sampling_point < 9").collect())

        land(spark, folders[first], "0", rows[first])
        land(spark, folders[second], "0", rows[second][:1])
        assert all(r[3] == "validated" for r in run())
        land(spark, folders[second], "1", rows[second][1:])
        for n in "23":
            for k in "pv":
                land(spark, folders[k], n, [(9, "x", at(500 + int(n)), 0.0, 500)])
        assert run() == want


def test_no_row_is_lost_for_being_late(spark, landed):
    """Rows in time and late rows are all that landed; means of those in time are what the stream of all of them gives."""
    folder, read = landed
    parts = [[(1, "x", at(i * 9), float(i), i) for i in range(40)], [(1, "x", at(424), 1.0, 1000), (1, "x", None, 5.0, 1002)],
             [(1, "x", at(2), 1000.0, 999), (1, "x", at(415), 2.0, 998), (1, "x", at(425), 1.0, 1001)], [(1, "x", at(700), 0.0, 1003)]]
    for name, rows in zip("abcd", parts):
        land(spark, folder, name, rows)
    out = fresh_path(spark, "parted")
    good, late = fd.parted(read(), "10 minutes", "1 hour", out)
    assert {r.event_id for r in late.collect()} == {999, 1002} and {r.event_id for r in good.collect()} == {r[4] for p in parts for r in p} - {999, 1002}
    state = versions.Table(spark, out).state()
    assert (state["n"], state["n_late"]) == (good.count() + 2, 2)
    emitted = fd.appended(fd.window_means(read(), ["pollutant"], "conc", "10 minutes", "1 hour"))
    batch = good.groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n")).where(F.col("w.end") <= F.lit(at(690)))
    assert {(r.window_start, r.n) for r in emitted.collect()} == {(r.w.start, r.n) for r in batch.collect()}
    # nothing new, then one more file: nothing is dealt twice
    good, late = fd.parted(read(), "10 minutes", "1 hour", out)
    land(spark, folder, "e", [(1, "x", at(3), 0.0, 1004)])
    good, late = fd.parted(read(), "10 minutes", "1 hour", out)
    assert late.count() == 3 and good.count() == state["n"] - 2
