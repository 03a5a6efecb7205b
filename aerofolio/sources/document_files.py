"""A Spark data source that writes one text file per row: ``df.write.format("document_files").mode("append").save(path)``.

Rows are ``(name, body)``; ``pages/x.md`` becomes that file below ``path`` with the bytes of ``body``. A task writes each file under
a name of its own attempt and renames it when it is whole, so a repeated attempt leaves one file with the same bytes, and
the driver hears of counts only, never of names. If the job fails, all that it wrote below ``path`` is removed: write into a new folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

NAME = "document_files"
#: Marks a folder whose job ended well.
DONE = "_SUCCESS"


@dataclass
class Written(WriterCommitMessage):
    files: int
    bytes: int


def checked(name: str | None) -> str:
    """A file name below the folder; what would leave it, or hide the file, is refused."""
    parts = (name or "").split("/")
    if any(p in ("", ".", "..") or p.startswith(("_", ".")) or "\x00" in p for p in parts):
        raise ValueError(f"not a file name: {name!r}")
    return "/".join(parts)


class _Writer(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path

    def _open(self):
        """The file system and the folder's path in it; without a scheme, or with ``file:``, a folder that all executors have mounted."""
        from pyarrow import fs

        if "://" in self.path and not self.path.startswith("file:"):
            return fs.FileSystem.from_uri(self.path)
        return fs.LocalFileSystem(), "/" + self.path.removeprefix("file:").lstrip("/")

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        system, root = self._open()
        attempt, made, files, size = uuid.uuid4().hex, set(), 0, 0
        for row in iterator:
            name, body = checked(row["name"]), (row["body"] or "").encode()
            folder, _, leaf = f"{root}/{name}".rpartition("/")
            if folder not in made:
                system.create_dir(folder, recursive=True)
                made.add(folder)
            draft = f"{folder}/.{leaf}.{attempt}"
            with system.open_output_stream(draft) as out:
                out.write(body)
            system.move(draft, f"{folder}/{leaf}")
            files, size = files + 1, size + len(body)
        return Written(files, size)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = self._open()
        system.create_dir(root, recursive=True)
        done = [m for m in messages if m is not None]
        with system.open_output_stream(f"{root}/{DONE}") as out:
            out.write(f"{sum(m.files for m in done)} files, {sum(m.bytes for m in done)} bytes\n".encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        system, root = self._open()
        if system.get_file_info(root).type == fs.FileType.Directory:
            system.delete_dir_contents(root)


class DocumentFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "name string, body string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("write into a new folder")
        if set(schema.names) != {"name", "body"}:
            raise ValueError("rows are (name, body)")
        path = self.options.get("path")
        if not path:
            raise ValueError("a path is needed")
        return _Writer(path.rstrip("/"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DocumentFiles)
