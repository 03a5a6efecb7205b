"""Compression classifier: zstandard dictionaries of good and bad text, and a calibrated size difference as score."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from ..session import settle

#: Bytes that are compressed at once. A dictionary counts at a block's beginning, so whole texts are cut into short blocks.
BLOCK = 512
LEVEL = 3


def held_out(ident: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2, F.lit(False))


def _blocks(text: bytes) -> list[memoryview]:
    view = memoryview(text)
    return [view[i : i + BLOCK] for i in range(0, len(text), BLOCK)]


def dictionary(blocks: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the blocks themselves where they are too few to train on."""
    samples = [b for b in blocks if len(b) >= 8]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class Sizes:
    """What whole texts compress to with either dictionary, as features of the score."""

    def __init__(self, good: bytes, bad: bytes):
        self.pair = []
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw)
            if raw:
                d.precompute_compress(level=LEVEL)
            self.pair.append(zstandard.ZstdCompressor(dict_data=d if raw else None, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False))

    def features(self, text: bytes) -> tuple[float, float, float, float, float]:
        """Normalised difference of the sizes of the whole text; its extremes over the blocks; bytes per byte; log length.

        The first is the classifier's own. The extremes tell a text with one stretch of junk from one that is a little odd throughout; plain
        compressibility and length say how far a difference can be trusted: one of few bytes, or of repeated lines, means little.
        """
        if not text:
            return 0.0, 0.0, 0.0, 0.0, 0.0
        blocks = _blocks(text)
        g, b = (np.array([len(c.compress(x)) for x in blocks], float) for c in self.pair)
        each = (b - g) / (b + g)
        return float((b.sum() - g.sum()) / (b.sum() + g.sum())), float(each.min()), float(each.max()), float(g.sum() / len(text)), float(np.log1p(len(text)))


class Model:
    """Dictionaries and a logistic calibration, all as plain values that can be sent to the executors.

    A feature outside the range that the calibration saw counts as the nearest one in it, so that a text far longer than any
    labelled one is not judged by its length. ``fitted`` is false where there weren't rows of both labels to learn from.
    """

    def __init__(self, good: bytes, bad: bytes, weights: np.ndarray, mean: np.ndarray, spread: np.ndarray, seen: tuple[np.ndarray, np.ndarray] | None = None):
        self.good, self.bad, self.weights, self.mean, self.spread = good, bad, weights, mean, spread
        self.fitted, self.seen = seen is not None, seen or (np.zeros(5), np.zeros(5))

    def score(self, features: np.ndarray) -> np.ndarray:
        z = np.c_[np.ones(len(features)), (np.clip(features, *self.seen) - self.mean) / self.spread] @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mean, spread = x.mean(0), x.std(0) + 1e-9
    xs, beta = np.c_[np.ones(len(x)), (x - mean) / spread], np.zeros(x.shape[1] + 1)
    ridge = np.eye(len(beta)) * 1e-2
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(xs @ beta, -500, 500)))
        step = np.linalg.solve(xs.T @ (xs * (w * p * (1 - p))[:, None]) + ridge, xs.T @ (w * (p - y)) + ridge @ beta)
        beta = beta - step
        if np.abs(step).max() < 1e-10:
            break
    return beta, mean, spread


def _spread_blocks(text: Column, most: int) -> Column:
    """At most ``most`` blocks, evenly spread over the whole text."""
    raw = text.cast("binary")
    there = F.ceil(F.octet_length(text) / F.lit(BLOCK))
    taken = F.least(there, F.lit(most))
    return F.transform(F.sequence(F.lit(0).cast("long"), taken - 1), lambda k: F.substring(raw, (F.floor(k * there / taken) * BLOCK + 1).cast("int"), F.lit(BLOCK)))


def _features(sent):
    @F.arrow_udf("array<double>")
    def features(texts: pa.Array) -> pa.Array:
        sizes = Sizes(*sent.value)
        return pa.array([sizes.features(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in texts], pa.list_(pa.float64()))

    return features


def train(docs: DataFrame, labels: DataFrame, sample: int = 1500, blocks: int = 32, dict_size: int = 1 << 16, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fit on a bounded sample of the labelled rows that aren't held out.

    Of each label the texts of at most ``sample`` ids, the first by a hash of the id, and of at most ``2 * sample`` rows in all where ids repeat;
    texts of any length. Half of the rows train the dictionaries (of ``dict_size`` bytes), on at most ``blocks`` blocks of 512 bytes spread over
    the whole of each text; the other half calibrates the score on its whole texts, of which only the features come to the driver, weighted to the
    shares of the labels in all labelled rows. Ids with a null or with two different labels teach nothing. Without rows of both labels every
    text gets the share of label 1 as its score (0.5 if there are no labels), and the model says that it isn't ``fitted``.
    """
    spark, ident = docs.sparkSession, F.col(id_col)
    known = labels.where(ident.isNotNull()).groupBy(ident.alias("id")).agg(F.min(label_col).alias("y"), F.max(label_col).alias("other")).where("y = other and y in (0, 1)")
    known = known.where(~held_out(F.col("id"))).select("id", "y")
    there = docs.select(ident.alias("id")).distinct()
    known = known.join(there, "id", "left_semi")
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    picked = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample)
        picked = part if picked is None else picked.union(part)
    texts = docs.select(ident.alias("id"), F.col(text_col).alias("text")).where(F.octet_length("text") > 0).join(F.broadcast(picked), "id")
    texts = texts.withColumn("h", F.xxhash64("text")).dropDuplicates(["id", "h"]).orderBy(F.xxhash64("id", "h"), "id", "h").limit(2 * sample)
    texts = settle(texts.withColumn("teach", F.pmod(F.xxhash64("h", "id"), F.lit(2)) == 0))
    taught: dict[int, list[bytes]] = {0: [], 1: []}
    for r in texts.where("teach").select("y", "id", "h", _spread_blocks(F.col("text"), blocks).alias("cut")).orderBy("id", "h").collect():
        taught[r["y"]] += [bytes(b) for b in r["cut"]]
    prior = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
    rest = {r["y"]: r["count"] for r in texts.where("not teach").groupBy("y").count().collect()}
    if not all(taught[y] and rest.get(y) for y in (0, 1)):
        p = min(max(prior, 1e-6), 1 - 1e-6)
        return Model(b"", b"", np.array([np.log(p / (1 - p)), 0, 0, 0, 0, 0]), np.zeros(5), np.ones(5))
    good, bad = (dictionary(taught[y], dict_size) for y in (1, 0))
    sent = spark.sparkContext.broadcast((good, bad))
    rows = texts.where("not teach").select("y", "id", "h", _features(sent)("text").alias("x")).orderBy("id", "h").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows])
    w = np.array([counts[v] / (y == v).sum() for v in y])
    return Model(good, bad, *_logistic(x, y, w * len(w) / w.sum()), seen=(x.min(0), x.max(0)))


def _score(sent):
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        model = sent.value
        sizes = Sizes(model.good, model.bad)
        found = np.array([sizes.features(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in texts]).reshape(-1, 5)
        return pa.array(model.score(found), pa.float64())

    return score


def scored(docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """The rows of ``docs`` with ``held_out, score, predicted``; the score reads the text alone, which goes to Python and doesn't come back.

    Null and empty texts score alike. Repeated rows come back as they are, an empty table gives none. Columns of ``docs`` named as a result are replaced.
    """
    results = ["held_out", "score", "predicted"]
    others = [F.col(c) for c in docs.columns if c not in results and (keep_text or c != text_col)]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*others, held_out(F.col(id_col)).alias("held_out"), _score(sent)(F.col(text_col)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
