"""Streaming queries: the events file as a landed provisional feed, run until all of it is processed.

Windows still open when the feed ends are not emitted in append mode, so the SQL leaves them out too.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import exact_sum
from ..session import fresh_path
from ..sources.files import table
from ..streaming import feed as fd
from .base import OBS, dsum, mean, query

KEYS = ["sampling_point", "pollutant"]


def feed(spark, d):
    rows = fd.landed(spark, d, table(spark, d, "events").schema, "events.parquet")
    return rows.select(
        F.col("user_id").alias("sampling_point"), F.col("event_type").alias("pollutant"), "ts", F.col("value").alias("conc"), "event_id"
    )


def ntz(df, *names):
    for n in names:
        df = df.withColumn(n, F.col(n).cast("timestamp_ntz"))
    return df


@query("a70_file_drop_feed", f"WITH {OBS} SELECT sampling_point, pollutant, ts, conc, event_id FROM obs")
def a70(spark, d):
    return ntz(fd.appended(feed(spark, d)), "ts")


@query("a71_latest_values", f"""WITH {OBS} SELECT sampling_point, pollutant, ts, event_id, conc FROM (SELECT *, row_number() OVER (PARTITION BY sampling_point, pollutant
  ORDER BY ts DESC, event_id DESC) AS rn FROM obs) WHERE rn = 1""")
def a71(spark, d):
    changes = fd.latest_per_key(feed(spark, d), KEYS, "event_id", fresh_path(spark, "latest"))
    return ntz(fd.current(changes, KEYS, "event_id"), "ts")


@query("a72_deduplicated_feed", f"WITH {OBS} SELECT sampling_point, pollutant, ts, conc, event_id FROM obs")
def a72(spark, d):
    """Everything is delivered twice."""
    twice = feed(spark, d).unionByName(feed(spark, d))
    return ntz(fd.appended(fd.once_delivered(twice, ["event_id"], "2 hours")), "ts")


CLOSED = "(SELECT MAX(ts) - INTERVAL 2 HOUR FROM obs)"


@query("a73_daily_means", f"""WITH {OBS}, w AS (SELECT pollutant, conc, date_trunc('day', ts)::TIMESTAMP AS window_start FROM obs)
  SELECT pollutant, window_start, COUNT(conc) AS n, {mean('conc')} AS mean FROM w GROUP BY pollutant, window_start HAVING window_start + INTERVAL 1 DAY <= {CLOSED}""")
def a73(spark, d):
    means = fd.window_means(feed(spark, d), ["pollutant"], "conc", "2 hours", "1 day")
    return ntz(fd.appended(means), "window_start").drop("window_end")


@query("a73_means_once_delivered", f"""WITH {OBS}, w AS (SELECT pollutant, conc, date_trunc('day', ts)::TIMESTAMP AS window_start FROM obs)
  SELECT pollutant, window_start, COUNT(conc) AS n, {mean('conc')} AS mean FROM w GROUP BY pollutant, window_start HAVING window_start + INTERVAL 1 DAY <= {CLOSED}""")
def a73_once(spark, d):
    """Everything is delivered twice and counts once: two stateful steps in one stream."""
    once = fd.once_delivered(feed(spark, d).unionByName(feed(spark, d)), ["event_id"], "2 hours")
    return ntz(fd.appended(fd.window_means(once, ["pollutant"], "conc", None, "1 day")), "window_start").drop("window_end")


@query("a73_late_rows", f"""WITH {OBS}, m AS (SELECT MAX(ts) FILTER (event_id % 3 = 0) AS m1, MAX(ts) FILTER (event_id % 3 < 2) AS m2 FROM obs),
  l AS (SELECT pollutant, conc, coalesce(date_trunc('day', ts) + INTERVAL 1 DAY <= CASE event_id % 3 WHEN 1 THEN m1 WHEN 2 THEN m2 END - INTERVAL 2 HOUR, FALSE) AS late FROM obs, m)
  SELECT pollutant, late, COUNT(*) AS n, {dsum('conc')} AS total FROM l GROUP BY pollutant, late""")
def a73_late(spark, d):
    """The table lands in three parts, one after another; rows for days that are over by then are kept apart."""
    landing, path, schema = fresh_path(spark, "landing"), fresh_path(spark, "parted"), table(spark, d, "events").schema
    for part in range(3):
        table(spark, d, "events").where(F.pmod("event_id", F.lit(3)) == part).write.parquet(f"{landing}/{part}")
        rows = fd.landed(spark, f"{landing}/*", schema).select(F.col("event_type").alias("pollutant"), "ts", F.col("value").alias("conc"))
        sides = fd.parted(rows, "2 hours", "1 day", path)
    both = sides[0].withColumn("late", F.lit(False)).unionByName(sides[1].withColumn("late", F.lit(True)))
    return both.groupBy("pollutant", "late").agg(F.count("*").alias("n"), exact_sum(F.col("conc")).alias("total"))


@query("a73_sliding_means", f"""WITH {OBS}, w AS (SELECT pollutant, conc, date_trunc('hour', ts)::TIMESTAMP - to_hours(h) AS window_start FROM obs, (SELECT unnest(range(24)) AS h))
  SELECT pollutant, window_start, COUNT(conc) AS n, {mean('conc')} AS mean FROM w GROUP BY ALL HAVING window_start + INTERVAL 1 DAY <= {CLOSED}""")
def a73_sliding(spark, d):
    means = fd.window_means(feed(spark, d), ["pollutant"], "conc", "2 hours", "1 day", "1 hour")
    return ntz(fd.appended(means), "window_start").drop("window_end")


@query("a74_silence_sessions", f"""WITH {OBS}, m AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY sampling_point ORDER BY ts) < INTERVAL 8 HOUR THEN 0 ELSE 1 END AS starts FROM obs),
  g AS (SELECT *, SUM(starts) OVER (PARTITION BY sampling_point ORDER BY ts ROWS UNBOUNDED PRECEDING) AS nth FROM m)
  SELECT sampling_point, MIN(ts) AS session_start, MAX(ts) + INTERVAL 8 HOUR AS session_end, COUNT(*) AS n FROM g GROUP BY sampling_point, nth
  HAVING MAX(ts) + INTERVAL 8 HOUR <= {CLOSED}""")
def a74(spark, d):
    spells = fd.sessions(feed(spark, d), ["sampling_point"], "2 hours", "8 hours")
    return ntz(fd.appended(spells), "session_start", "session_end")


@query("a74_sessions_once_delivered", f"""WITH {OBS}, m AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY sampling_point ORDER BY ts) < INTERVAL 8 HOUR THEN 0 ELSE 1 END AS starts FROM obs),
  g AS (SELECT *, SUM(starts) OVER (PARTITION BY sampling_point ORDER BY ts ROWS UNBOUNDED PRECEDING) AS nth FROM m)
  SELECT sampling_point, MIN(ts) AS session_start, MAX(ts) + INTERVAL 8 HOUR AS session_end, COUNT(*) AS n FROM g GROUP BY sampling_point, nth
  HAVING MAX(ts) + INTERVAL 8 HOUR <= {CLOSED}""")
def a74_once(spark, d):
    """As a73_means_once_delivered, for sessions."""
    once = fd.once_delivered(feed(spark, d).unionByName(feed(spark, d)), ["event_id"], "2 hours")
    return ntz(fd.appended(fd.sessions(once, ["sampling_point"], None, "8 hours")), "session_start", "session_end")


@query("a66_preferred_on_the_feed", f"""WITH {OBS}, w AS (SELECT (SELECT MAX(ts) FROM obs) AS p, (SELECT MAX(ts) FROM obs WHERE flag >= 50) AS v)
  SELECT event_id, sampling_point, ts, CASE WHEN flag >= 50 THEN conc + 1 ELSE conc END AS conc, CASE WHEN flag >= 50 THEN 'validated' ELSE 'provisional' END AS flow FROM obs, w
  WHERE flag >= 50 OR ts < least(p, v) - INTERVAL 2 HOUR""")
def a66_feed(spark, d):
    """Every event is provisional, those with a high flag are validated too; what still waits for its validated row when the feed ends isn't out yet."""
    flag = F.get_json_object("props", "$.k").cast("int")
    rows = fd.landed(spark, d, table(spark, d, "events").schema, "events.parquet").select("event_id", F.col("user_id").alias("sampling_point"), "ts", F.col("value").alias("conc"), flag.alias("flag"))
    firm = rows.where("flag >= 50").withColumn("conc", F.col("conc") + 1)
    return ntz(fd.appended(fd.preferred(firm.drop("flag"), rows.drop("flag"), ["event_id"], "2 hours")), "ts")
