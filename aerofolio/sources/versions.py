"""Tables that are replaced as a whole: readers see the old version or the new one, never half of one.

A version is a folder (or some) below the table's own; which ones count is said by the newest file in ``_versions``. That file is
written last, under another name, and renamed; a job that dies before leaves the table as it was. Folders that no
kept version names are removed by the next writer. One writer at a time; any number of readers.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

LOG = "_versions"


class Table:
    """The versions of the table at ``path``, on whatever file system Spark finds there."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, name: str) -> list[str]:
        at = self._at(name)
        return [f.getPath().getName() for f in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def numbers(self) -> list[int]:
        return sorted(int(n) for n in self._names(LOG) if n.isdigit())

    def state(self, number: int | None = None) -> dict:
        """What a version says: its ``folders`` and whatever else its writer noted; empty before the first one."""
        had = self.numbers()
        if not had:
            return {"number": 0, "folders": []}
        number = number or had[-1]
        stream = self.fs.open(self._at(f"{LOG}/{number:020d}"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {"number": number, **json.loads(text)}

    def fresh(self, label: str = "part") -> str:
        """Name of a new folder of the table; nothing reads it before a version names it."""
        return f"{label}-{uuid.uuid4().hex}"

    def commit(self, folders: list[str], keep: int = 2, **notes) -> int:
        """Make these folders the table, then remove what the last ``keep`` versions don't name."""
        number = (self.numbers() or [0])[-1] + 1
        draft, final = self._at(f"{LOG}/.{uuid.uuid4().hex}"), self._at(f"{LOG}/{number:020d}")
        out = self.fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps({"folders": folders, **notes}).encode()))
        finally:
            out.close()
        if self.fs.exists(final) or not self.fs.rename(draft, final):
            self.fs.delete(draft, False)
            raise RuntimeError(f"another writer has made version {number} of {self.path}")
        self.clear(keep)
        return number

    def clear(self, keep: int = 2) -> None:
        """Remove versions but the last ``keep``, and folders that none of these names."""
        had = self.numbers()
        named = {f for n in had[-keep:] for f in self.state(n)["folders"]}
        for n in had[:-keep]:
            self.fs.delete(self._at(f"{LOG}/{n:020d}"), False)
        for name in self._names(""):
            if name not in named and not name.startswith(("_", ".")):
                self.fs.delete(self._at(name), True)

    def paths(self) -> list[str]:
        return [f"{self.path}/{f}" for f in self.state()["folders"]]


def replace(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), keep: int = 2) -> int:
    """Write ``df`` as the next version of the table at ``path``; its number."""
    table = Table(df.sparkSession, path)
    name = table.fresh()
    df.write.partitionBy(*partition_by).parquet(f"{table.path}/{name}") if partition_by else df.write.parquet(f"{table.path}/{name}")
    return table.commit([name], keep)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The newest version; an error if there is none."""
    paths = Table(spark, path).paths()
    if not paths:
        raise FileNotFoundError(f"no version of a table at {path}")
    return spark.read.parquet(*paths)
