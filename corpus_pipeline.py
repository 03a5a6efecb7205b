"""From raw documents to a training mix: five stages, each a Parquet table that the next one reads.

A stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of ``docs``. Null and empty texts are texts without
words: one score, the fingerprint zero, nothing to remove, no hit. A null id is a document of its own and larger than any other in the comparison
of repeats; rows that are repeated are near-duplicates of each other, of which one stays, the choice among rows equal in all columns making no difference.
Extra columns go through unchanged, ``n_chars`` need not be there, and an empty table gives an empty one at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from aerofolio.llm import decontaminate, mixing, quality, simhash, substrings
from aerofolio.session import fresh_path
from aerofolio.sources.files import table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of the input, doesn't reject; all where it found nothing to learn from."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    if not model.fitted:
        return docs
    return quality.scored(docs, model, keep_text=True).where("predicted = 1").select(*docs.columns)


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs, shingle=3, distance=2)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand in earlier documents; ``n_chars`` follows the text."""
    cut = substrings.remove_repeats(docs, size=13, with_text=True)
    if "n_chars" in docs.columns:
        counted = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, counted).otherwise(F.col("n_chars")))
    return cut.withColumn("text", F.col("kept")).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in benchmark items."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), size=13, one_in=20)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every copy a row, numbered by ``copy``."""
    return mixing.mixed(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", near_deduplicated),
    ("substring dedup", without_repeats),
    ("benchmark decontamination", decontaminated),
    ("mixing sources", mixed_sources),
]

#: Trained models, fingerprints and components aren't SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = fresh_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
