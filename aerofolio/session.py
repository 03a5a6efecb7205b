"""Session settings, the shared work folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "aerofolio") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one disk, may fall
    back to a temporary folder of this machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="aerofolio-")
        sc.setCheckpointDir(named)
    return named


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared work folder; below ``spark.aerofolio.run`` there, if the caller names a run, to be removed as a whole."""
    run = spark.conf.get("spark.aerofolio.run", None)
    return f"{work_dir(spark)}/{f'{run}/' if run else ''}{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written rows.

    Used where a later step must see the same rows and the same partition
    numbers even if an executor is lost and stages are run again. A table is
    written rather than a checkpoint: later steps read only the columns they
    need, and joins see its true size.
    """
    path = fresh_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """As many tasks as the session's ``spark.aerofolio.spread`` says, for costly per-row work on a plain scan; else as it is.

    For files of few row groups, as in tests and the bench; tables at scale have more row groups than there are slots.
    Nothing but the caller decides on the shuffle that it costs.
    """
    tasks = scan.sparkSession.conf.get("spark.aerofolio.spread", None)
    return scan.repartition(int(tasks)) if tasks else scan


#: Tasks per slot that rows are dealt to where work per row outweighs the row.
TASKS_PER_SLOT = 4


def dealt(rows: DataFrame) -> DataFrame:
    """Narrow rows in equal parts for every slot, for work per row that takes far longer than sending the row; else few row groups would be few tasks.

    The parts are as many as ``spark.aerofolio.spread`` says, or, without it, grow with the slots and ``spark.sql.shuffle.partitions``.
    """
    spark = rows.sparkSession
    tasks = spark.conf.get("spark.aerofolio.spread", None)
    return rows.repartition(int(tasks) if tasks else max(TASKS_PER_SLOT * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
