"""Landed files in, result files out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import document_files, versions

APPLICATION = "id string, box string, name string, discontinued boolean, previously string, url string"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Landed collection responses, one file per request, named ``kind-number.json``."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)-(\d+)\.json$", 1)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)-(\d+)\.json$", 2)
    return (
        spark.read.text(folder, wholetext=True)
        .select(name.alias("kind"), F.try_to_number(number, F.lit("9999999999")).cast("int").alias("page_no"),
                F.col("value").alias("body"))
        .where(F.col("kind") != "")
    )


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Whole text files as ``(source, value)``."""
    return spark.read.text(folder, wholetext=True).select(
        F.col("_metadata.file_path").alias("source"), "value"
    )


def read_catalogue(spark: SparkSession, path: str, one_array_per_file: bool = True) -> DataFrame:
    """P03. Ids such as ``3a`` stay text, so the schema is given, never inferred."""
    return spark.read.schema(APPLICATION).json(path, multiLine=one_array_per_file)


def write_catalogue(apps: DataFrame, path: str) -> None:
    """One JSON object per line, files and lines in id order."""
    apps.orderBy("id").write.mode("overwrite").json(path)


def write_documents(docs: DataFrame, path: str) -> None:
    """One row per document, foldered by kind, as the next version of the table at ``path``.

    Until the version is whole and named, readers go on seeing the one before; folders without new rows are then gone.
    """
    rows = docs.withColumn("folder", F.split("docname", "/")[0]).withColumn("file_name", F.concat(F.substring_index("docname", "/", -1), F.lit(".md")))
    versions.replace(rows, path, ("folder",))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the documents."""
    return versions.read(spark, path)


def write_document_files(docs: DataFrame, path: str, body: str = "body") -> None:
    """A file of its own for every document, ``docname`` with ``.md``; the set of files is replaced as a whole.

    Documents of one name are written over each other, the last one in no given order staying: names are the caller's to keep apart.
    """
    spark = docs.sparkSession
    document_files.register(spark)
    table = versions.Table(spark, path)
    name = table.fresh("files")
    rows = docs.select(F.concat("docname", F.lit(".md")).alias("name"), F.coalesce(F.col(body), F.lit("")).alias("body"))
    rows.write.format(document_files.NAME).mode("append").save(f"{table.path}/{name}")
    table.commit([name])


def document_folder(spark: SparkSession, path: str) -> str:
    """Where the files of the newest version are."""
    return versions.Table(spark, path).paths()[-1]


def read_document_files(spark: SparkSession, path: str) -> DataFrame:
    """The files of the newest version as ``(name, body)``. Spark's readers pass over files without a byte, so empty documents aren't among them."""
    folder = document_folder(spark, path)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").load(folder)
    # the path as it is, not as a URL
    at = F.substring_index("path", f"/{folder.rpartition('/')[2]}/", -1)
    return found.select(at.alias("name"), F.decode("content", "UTF-8").alias("body"))


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Files below a folder as ``(folder, name, bytes)``; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    parts = F.split("path", "/")
    return found.select(
        F.element_at(parts, -2).alias("folder"), F.element_at(parts, -1).alias("name"),
        F.col("length").alias("bytes"),
    )


def register_flows(flows: dict[str, DataFrame], preliminary: dict[str, DataFrame] | None = None) -> None:
    """One view per reporting flow, e.g. ``flow_b``; preliminary rows are added with a mark."""
    preliminary = preliminary or {}
    for name, rows in flows.items():
        view = rows.withColumn("is_preliminary", F.lit(False))
        if name in preliminary:
            early = preliminary[name].withColumn("is_preliminary", F.lit(True))
            view = view.unionByName(early, allowMissingColumns=True)
        view.createOrReplaceTempView(f"flow_{name.lower()}")


def ask(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """A query over the registered views (or over frames passed by name)."""
    return spark.sql(sql, **views) if views else spark.sql(sql)


def file_stem(column: Column) -> Column:
    return F.regexp_replace(column, r"\.[^.]+$", "")
