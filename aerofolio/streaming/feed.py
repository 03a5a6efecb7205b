"""The provisional feed as a stream of landed files.

Runs use ``availableNow``: everything that has landed is processed, then the
query stops; started again on the same checkpoint it goes on from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..functions.numbers import exact_sum
from ..operators.ordered import latest
from ..session import fresh_path
from ..sources import versions


def landed(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet",
           files_per_batch: int | None = None) -> DataFrame:
    """File-drop source. Event time becomes TIMESTAMP, which watermarks require."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(folder)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def once_delivered(feed: DataFrame, keys: list[str], delay: str) -> DataFrame:
    """Repeated deliveries of a key within the delay are dropped."""
    return feed.withWatermark("ts", delay).dropDuplicatesWithinWatermark(keys)


def _marked(feed: DataFrame, delay: str | None) -> DataFrame:
    """With a watermark of its own, or, without a delay, with the one that an earlier step of the stream has set."""
    return feed.withWatermark("ts", delay) if delay else feed


def window_means(feed: DataFrame, keys: list[str], value: str, delay: str | None, length: str,
                 slide: str | None = None) -> DataFrame:
    """Means per tumbling or sliding window; rows later than the delay are dropped.

    ``delay`` is None for a feed that ``once_delivered`` has marked already: then repeated deliveries count once, in one stream.
    """
    span = F.window("ts", length, slide) if slide else F.window("ts", length)
    return (
        _marked(feed, delay)
        .groupBy(*keys, span.alias("span"))
        .agg(F.count(value).alias("n"), exact_sum(F.col(value)).alias("_sum"))
        .select(
            *keys,
            F.col("span.start").alias("window_start"),
            F.col("span.end").alias("window_end"),
            "n",
            (F.col("_sum") / F.col("n")).alias("mean"),
        )
    )


def sessions(feed: DataFrame, keys: list[str], delay: str | None, gap: str) -> DataFrame:
    """Spells of reporting per key, ended by a silence of ``gap``; ``delay`` as for ``window_means``.

    With ``spark.sql.sessionWindow.merge.sessions.in.local.partition``, which the session's owner sets, sessions are
    merged inside each input task before the shuffle, and a busy sampling point travels as sessions and not as rows.
    """
    return (
        _marked(feed, delay)
        .groupBy(*keys, F.session_window("ts", gap).alias("span"))
        .agg(F.count("*").alias("n"))
        .select(
            *keys, F.col("span.start").alias("session_start"), F.col("span.end").alias("session_end"), "n"
        )
    )


def preferred(validated: DataFrame, provisional: DataFrame, keys: list[str], delay: str) -> DataFrame:
    """A66 on the feed: a provisional row stands until its validated one arrives, or until ``delay`` has passed without one.

    Rows meet by ``keys`` and ``ts``. A pair comes out as soon as both are there, whichever was first; a row without a partner
    when the watermarks of both flows have passed its time. Within ``delay`` a flow's repeated deliveries count once. Both flows have the same columns.
    ``flow`` says where the row is from.
    """
    rest = [c for c in provisional.columns if c not in (*keys, "ts")]
    sides = []
    for mark, rows in (("v", validated), ("p", provisional)):
        once = rows.withWatermark("ts", delay).dropDuplicatesWithinWatermark([*keys, "ts"])
        sides.append(once.select(*[F.col(c).alias(f"{mark}_{c}") for c in (*keys, "ts", *rest)]))
    same = [F.col(f"v_{k}") == F.col(f"p_{k}") for k in (*keys, "ts")]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    both = sides[0].join(sides[1], cond, "full_outer")
    firm = F.col("v_ts").isNotNull()
    return both.select(
        *[F.when(firm, F.col(f"v_{c}")).otherwise(F.col(f"p_{c}")).alias(c) for c in provisional.columns],
        F.when(firm, F.lit("validated")).otherwise(F.lit("provisional")).alias("flow"),
    )


#: Folders of changes that a table of latest rows may have before they are merged into one.
CHANGES = 8


def latest_per_key(feed: DataFrame, keys: list[str], tie: str, path: str, checkpoint: str | None = None, expire: str | None = None) -> DataFrame:
    """Run the feed to the end of what has landed, keeping the latest row per key as a versioned table at ``path``.

    A batch is reduced by the same mergeable aggregate as a table and becomes one more folder of the table; when there are more than
    ``CHANGES``, and at the end of a run, they are merged into one. So reading costs what the keys need and not all that
    ever landed. A batch that is run again adds rows that lose or tie with themselves. With ``expire``, an interval, merging drops
    keys whose latest row is older than the newest of all by more. The stream's place is kept with the table unless ``checkpoint`` says otherwise.
    """
    spark = feed.sparkSession
    table = versions.Table(spark, path)

    def rows_of(folders: list[str]) -> DataFrame:
        return spark.read.schema(feed.schema).parquet(*[f"{table.path}/{f}" for f in folders])

    def merged(folders: list[str]) -> list[str]:
        rows, name = latest(rows_of(folders), keys, ["ts", tie]), table.fresh("latest")
        if expire:
            newest = rows_of(folders).agg(F.max("ts")).first()[0]
            rows = rows.where(F.col("ts") >= F.lit(newest) - F.expr(f"interval {expire}"))
        rows.write.parquet(f"{table.path}/{name}")
        return [name]

    def keep(rows: DataFrame, batch: int) -> None:
        name = table.fresh("batch")
        latest(rows.where(F.col("ts").isNotNull()), keys, ["ts", tie]).write.parquet(f"{table.path}/{name}")
        folders = [*table.state()["folders"], name]
        table.commit(merged(folders) if len(folders) > CHANGES else folders)

    query = feed.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint or f"{table.path}/_feed").trigger(availableNow=True).start()
    query.awaitTermination()
    folders = table.state()["folders"]
    if len(folders) > 1:
        table.commit(merged(folders))
    folders = table.state()["folders"]
    return rows_of(folders) if folders else spark.createDataFrame([], feed.schema)


def current(changes: DataFrame, keys: list[str], tie: str) -> DataFrame:
    """The newest row per key of what ``latest_per_key`` has written. Rows without a time are never the latest."""
    return latest(changes.where(F.col("ts").isNotNull()), keys, ["ts", tie])


def _micros(interval: str) -> Column:
    return F.expr(f"unix_micros(timestamp_micros(0) + interval {interval})")


def parted(feed: DataFrame, delay: str, length: str, path: str, checkpoint: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Run the feed to the end of what has landed, dealing its rows into ``(in time, late)``; none is lost.

    A row is late if its window of ``length`` had ended ``delay`` before the newest row of the batches before, which is when such a window
    has come out of ``window_means`` and rows for it are dropped. Rows without a time are late. Each batch is written in one pass, which
    also observes how many rows there were and the newest time; the version that names its folder notes both, and which batches of which stream
    it has, so a batch that is run again is left out. Counts of all rows and of late ones are in ``versions.Table(spark, path).state()``.
    """
    spark = feed.sparkSession
    table = versions.Table(spark, path)
    checkpoint = checkpoint or f"{table.path}/_feed"

    def deal(rows: DataFrame, batch: int) -> None:
        had = table.state()
        if had.get("stream") == checkpoint and had["batch"] >= batch:
            return
        newest, own = had.get("newest"), F.unix_micros("ts")
        late = F.col("ts").isNull()
        if newest is not None:
            # Spark keeps watermarks in milliseconds
            late = late | (own - F.pmod(own, _micros(length)) + _micros(length) <= F.lit(newest // 1000 * 1000) - _micros(delay))
        # a folder named like a partition, so that the one inside it is found
        name, seen = f"batch={table.fresh('b')}", Observation()
        counted = rows.withColumn("late", late).observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col("late")).alias("n_late"), F.max(own).alias("newest"))
        counted.write.partitionBy("late").parquet(f"{table.path}/{name}")
        got = seen.get
        newest = max((t for t in (newest, got["newest"]) if t is not None), default=None)
        table.commit([*had["folders"], name], stream=checkpoint, batch=batch, newest=newest, n=had.get("n", 0) + got["n"], n_late=had.get("n_late", 0) + got["n_late"])

    query = feed.writeStream.foreachBatch(deal).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    paths = table.paths()
    whole = T.StructType([*feed.schema.fields, T.StructField("late", T.BooleanType())])
    rows = spark.read.schema(whole).option("basePath", table.path).parquet(*paths) if paths else spark.createDataFrame([], whole)
    return tuple(rows.where(F.col("late") == late).select(*feed.columns) for late in (False, True))


def appended(stream: DataFrame, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run an append-mode stream to the end of what has landed; result as a written table."""
    spark = stream.sparkSession
    path = path or fresh_path(spark, "feed")
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint or fresh_path(spark, "feed-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
