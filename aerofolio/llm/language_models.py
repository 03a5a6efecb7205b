"""Cross-entropy difference: bigram models of target and background text, matched in size, over all words of the corpus.

The target is the rows with a label, the background all others; the background's counts are scaled to the target's total, so both models have
one total, one smoothing and one vocabulary: every word and pair that either has, however many there are. The loss of a word after the one
before it is the pair's less the first word's, mixed with the word's own, so a text's loss is a sum over its words and pairs, each
of which needs nothing but its own two counts. A text isn't scored by its own counts: they are taken off those of its side.

Words and pairs travel, once a text each with their number, to buckets by their hash, packed in arrays; a bucket has every text that holds its
words and pairs, so it has their counts, and answers with what they add to each text. Those that many texts hold, as a bounded sample of texts tells, are
counted in a table of bounded size and scored where the text is, so that no bucket is hot; this only decides on the way that counts take.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import settle
from .tokens import MIX_A, MIX_B, PLAIN_LOWER, Words, mixed, pieces

#: Entries a task holds before it sends them on; mean entries of a bucket; mean bytes of text of a shard; entries weighed at once.
FLUSH, PER_BUCKET, PER_SHARD, WEIGHED = 1 << 19, 1 << 20, 8 << 20, 1 << 16
LEAST = 64
#: Bytes of text of the sample that tells which words and pairs are common.
SAMPLE = 32 << 20
#: Ids to be broadcast at most; more are joined by a shuffle.
FEW_IDS = 2_000_000
#: Losses are added as whole multiples of this, so sums don't depend on their order.
UNIT = 2.0**-32
# Fixed value: what stands for the end of a text, as a word's hash.
END = np.uint64(0x94D049BB133111EB)


def _keys(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """64-bit key of each word, and of each word with the next one or with the end of its text.

    Two of all words and pairs whose keys are equal count together; of a thousand million, less than one pair is to be expected.
    """
    h = words.hashes()
    after = np.append(h[1:], END)
    after[words.first[1:][words.counts > 0] - 1] = END
    return mixed(h ^ MIX_A), mixed(h * MIX_B + mixed(after))


def _entries(words: Words, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, key, times and kind (1: a pair) of every different word and pair of each row, rows in order."""
    row = np.repeat(np.arange(rows), words.counts)
    out = []
    for kind, key in enumerate(_keys(words)):
        order = np.lexsort((key, row))
        r, k = row[order], key[order]
        first = np.flatnonzero((np.diff(r, prepend=-1) != 0) | np.append(True, k[1:] != k[:-1])[: len(k)])
        out.append((r[first], k[first], np.diff(np.append(first, len(k))), np.full(len(first), kind)))
    r, k, t, kind = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(r, kind="stable")
    return r[order], k[order], t[order], kind[order]


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of a task's sample each word and pair is."""
    for b in batches:
        for lo, hi, data, bounds in pieces(b.column(0)):
            _, key, _, _ = _entries(Words(data, bounds, PLAIN_LOWER), hi - lo)
            key, n = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["key", "n"])


def _count(sent):
    """Per task: how often each common key is in the background and in the target; key null: words of either."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = sent.value
        table, total = np.zeros((2, len(hot)), np.int64), [0, 0]
        for b in batches:
            flags = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, data, bounds in pieces(b.column(0)):
                words = Words(data, bounds, PLAIN_LOWER)
                side = np.repeat(flags[lo:hi], words.counts)
                for s in (0, 1):
                    total[s] += int((side == s).sum())
                if not len(hot):
                    continue
                for key in _keys(words):
                    at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
                    there = hot[at] == key
                    for s in (0, 1):
                        table[s] += np.bincount(at[there & (side == s)], minlength=len(hot))
        some = np.flatnonzero(table.sum(0))
        keys = pa.concat_arrays([pa.array(hot[some].view(np.int64)), pa.nulls(1, pa.int64())])
        yield pa.RecordBatch.from_arrays([keys, *(pa.array(np.append(table[s][some], total[s])) for s in (0, 1))], names=["key", "n_b", "n_t"])

    return run


class Gain:
    """What an occurrence adds to a text's score, in units."""

    def __init__(self, totals: tuple[int, int], weight: float, add: float):
        background, target = totals
        self.scale = target / background if background else 0.0
        self.weight, self.add, self.none = weight, add, not target

    def __call__(self, n_b: np.ndarray, n_t: np.ndarray, own: np.ndarray, in_target: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Loss in the target's model less loss in the background's, times the weight of words or pairs; a text's ``own`` number is left out."""
        if self.none:
            return np.zeros(len(own), np.int64)
        b = self.scale * (n_b - np.where(in_target, 0, own)) + self.add
        t = n_t - np.where(in_target, own, 0) + self.add
        each = np.log(b / t) * np.where(kind == 1, self.weight, 1 - 2 * self.weight)
        return np.rint(each / UNIT).astype(np.int64)


def _send(sent, buckets: int):
    """Rows ``(bucket, body)``: runs of one text's words and pairs, or what texts have got already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, n_b, n_t, gain = sent.value
        held, count, rows = [], 0, 0

        def flush() -> pa.RecordBatch:
            texts, shards, flags, row, key, times, own, n_words = (np.concatenate(x) for x in zip(*held))
            bucket = ((mixed(key ^ MIX_B) >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
            row, key, times, bucket = row[order], key[order], times[order], bucket[order]
            begin = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(bucket, prepend=-1) != 0))
            length = np.diff(np.append(begin, len(key)))
            cut = np.flatnonzero(np.diff(bucket[begin], prepend=-1))
            # what texts have so far goes through a bucket of its own choice
            out_b, out = [int(texts[0] % np.uint64(buckets))], [struct.pack("<qq", -1, len(texts)) + texts.tobytes() + shards.astype(np.int32).tobytes() + own.tobytes() + n_words.tobytes()]
            for lo, hi in zip(cut, np.append(cut[1:], len(begin))):
                mine, upto = row[begin[lo:hi]], begin[hi] if hi < len(begin) else len(key)
                out_b.append(int(bucket[begin[lo]]))
                out.append(struct.pack("<qq", hi - lo, upto - begin[lo]) + texts[mine].tobytes() + (shards[mine] * 2 + flags[mine]).astype(np.int32).tobytes() + length[lo:hi].astype(np.int32).tobytes()
                           + key[begin[lo] : upto].tobytes() + times[begin[lo] : upto].astype(np.uint32).tobytes())
            return pa.RecordBatch.from_arrays([pa.array(out_b, pa.int64()), pa.array(out, pa.binary())], names=["bucket", "body"])

        for b in batches:
            all_texts, all_shards = b.column(2).to_numpy().view(np.uint64), b.column(3).to_numpy().astype(np.int64)
            flags = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, data, bounds in pieces(b.column(0)):
                words = Words(data, bounds, PLAIN_LOWER)
                row, key, times, kind = _entries(words, hi - lo)
                own, far = np.zeros(hi - lo, np.int64), np.ones(len(key), bool)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
                    near = np.flatnonzero(hot[at] == key)
                    far[near] = False
                    at, n, k = at[near], times[near], kind[near]
                    np.add.at(own, row[near], gain(n_b[at], n_t[at], n, flags[lo:hi][row[near]] == 1, k) * n)
                held.append((all_texts[lo:hi], all_shards[lo:hi], flags[lo:hi], row[far] + rows, key[far], times[far] * 2 + kind[far], own, words.counts.astype(np.int64)))
                rows += hi - lo
                count += int(far.sum()) + hi - lo
                if count >= FLUSH:
                    yield flush()
                    held, count, rows = [], 0, 0
        if held:
            yield flush()

    return run


def _answer(sent):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        gain = sent.value[3]
        parts, out_s, out = [], [], []
        for body in (x.as_buffer() for x in group["body"]):
            n, k = struct.unpack_from("<qq", body)
            kinds = ((np.uint64, k), (np.int32, k), (np.int64, k), (np.int64, k)) if n < 0 else ((np.uint64, n), (np.int32, n), (np.int32, n), (np.uint64, k), (np.uint32, k))
            at, got = 16, []
            for t, m in kinds:
                got.append(np.frombuffer(body, t, m, at))
                at += m * np.dtype(t).itemsize
            if n < 0:
                _to_shards(got[1], (got[0], got[2], got[3]), 1, out_s, out)
            elif k:
                parts.append(got)
        if parts:
            texts, shards, length, keys, times = (np.concatenate(x) for x in zip(*parts))
            parts.clear()
            target = np.repeat(shards & 1, length) == 1
            distinct, at = np.unique(keys, return_inverse=True)
            del keys
            n_t = np.bincount(at, weights=(times >> 1) * target, minlength=len(distinct))
            n_b = np.bincount(at, weights=times >> 1, minlength=len(distinct)) - n_t
            each = np.empty(len(at), np.int64)
            for lo in range(0, len(at), WEIGHED):
                some = slice(lo, lo + WEIGHED)
                n = (times[some] >> 1).astype(np.int64)
                each[some] = gain(n_b[at[some]], n_t[at[some]], n, target[some], times[some] & 1) * n
            _to_shards(shards >> 1, (texts, np.add.reduceat(each, np.cumsum(length) - length)), 0, out_s, out)
        return pa.table({"shard": pa.array(out_s, pa.int32()), "answer": pa.array(out, pa.binary())})

    return run


def _to_shards(shards: np.ndarray, columns: tuple[np.ndarray, ...], kind: int, out_s: list, out: list) -> None:
    order = np.argsort(shards, kind="stable")
    cut = np.flatnonzero(np.diff(shards[order], prepend=-1))
    for lo, hi in zip(cut, np.append(cut[1:], len(order))):
        out_s.append(int(shards[order[lo]]))
        out.append(struct.pack("<qq", kind, hi - lo) + b"".join(c[order[lo:hi]].tobytes() for c in columns))


def _add_up(key: tuple, group: pa.Table) -> pa.Table:
    own, got = [], []
    for a in (x.as_buffer() for x in group["answer"]):
        kind, n = struct.unpack_from("<qq", a)
        (own if kind else got).append([np.frombuffer(a, t, n, 16 + 8 * n * i) for i, t in enumerate((np.uint64, np.int64, np.int64)[: 3 if kind else 2])])
    keys, total, n_words = (np.concatenate(x) for x in zip(*own))
    # equal rows share a key and have equal sums
    distinct, at, rows = np.unique(keys, return_inverse=True, return_counts=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, at, total)
    for k, s in got:
        np.add.at(sums, np.searchsorted(distinct, k), s)
    n = np.zeros(len(distinct), np.int64)
    n[at] = n_words
    score = np.where(n > 0, sums / rows * UNIT / np.maximum(n, 1), 0.0)
    return pa.table({"key": pa.array(distinct.view(np.int64)), "n_words": pa.array(n), "score": pa.array(score)})


def _columns(few: DataFrame) -> list[np.ndarray]:
    """A small table of longs on the driver, as columns of numbers rather than as rows of objects."""
    t = few.toArrow()
    return [c.combine_chunks().to_numpy(zero_copy_only=False) for c in t.columns]


def cross_entropy_difference(docs: DataFrame, targets: DataFrame, hot: int = 1 << 16, weight: float = 0.7, add: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, score)`` for every row of ``docs``.

    ``score`` is the mean, over a text's words, of the loss in the target's model less the loss in the background's (natural logarithm): the lower, the more
    like the target. The target is the rows whose id is in ``targets(id)``, the background the others. Words are runs without ASCII white space, A-Z lower-cased.
    A word or pair (a word and the next, or the end of the text) that occurs n times in the target and m times in the background has the shares n + ``add`` and
    m * s + ``add`` of the models' common total, s being the target's words per word of the background; the text's own occurrences are not among n and m.
    A word's loss is ``weight`` times that of its pair given its first word, and ``1 - weight`` times its own. No word is left out, and other texts bear on
    a score by their counts alone. ``hot`` words and pairs at most are counted apart, without any difference in the result.

    Null and empty texts have 0 words and score 0. Repeated rows come back as often as they came, each counted. A null id is in no target. Without target rows all
    scores are 0; without background its counts are 0. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ids = settle(targets.select(F.col(targets.columns[0]).alias("_id")).where("_id is not null").distinct().withColumn("target", F.lit(True)))
    few = ids.count() <= FEW_IDS
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    rows = rows.join(F.broadcast(ids) if few else ids, "_id", "left").select("_id", "text", F.coalesce("target", F.lit(False)).alias("target"))
    if not few:
        rows = settle(rows)
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets, shards = max(LEAST, size // 6 // PER_BUCKET), max(LEAST, size // PER_SHARD)

    key = F.xxhash64("_id", "text")
    # by a hash of the row, so copies of a text are sampled each for itself
    part = rows.where(F.pmod(F.xxhash64("text", "_id"), F.lit(1 << 20)) < F.lit(int(min(1.0, SAMPLE / max(size, 1)) * (1 << 20)))).select("text")
    common = part.mapInArrow(_common, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "key").limit(hot)
    names = np.sort(_columns(common.select("key"))[0].astype(np.int64).view(np.uint64))
    counts = rows.select("text", "target").mapInArrow(_count(spark.sparkContext.broadcast(names)), "key long, n_b long, n_t long").groupBy("key").agg(F.sum("n_b").alias("n_b"), F.sum("n_t").alias("n_t"))
    counts = settle(counts)
    totals = counts.where("key is null").select("n_b", "n_t").first()
    found, n_b, n_t = _columns(counts.where("key is not null"))
    found = found.astype(np.int64).view(np.uint64)
    order = np.argsort(found)
    sent = spark.sparkContext.broadcast((found[order], n_b[order], n_t[order], Gain(tuple(totals) if totals else (0, 0), weight, add)))

    keyed = rows.select("text", "target", key.alias("key"), F.pmod(F.hash("_id", "text"), F.lit(shards)).cast("int").alias("shard"))
    sums = keyed.mapInArrow(_send(sent, buckets), "bucket long, body binary").groupBy("bucket").applyInArrow(_answer(sent), "shard int, answer binary")
    scores = sums.groupBy("shard").applyInArrow(_add_up, "key long, n_words long, score double")
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("key")).join(settle(scores), "key").select("id", "n_words", "score")
