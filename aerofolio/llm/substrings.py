"""Substring dedup: Rabin-Karp hashes of all fixed-length token windows, counted in Spark, merged into removal intervals.

The windows are far more than the rows, so they travel as packed arrays. Documents are dealt to shards, and a shard sends each
of its different windows once, with the smallest id that it has there, to a bucket by hash. A bucket, which gets all windows of its hashes, answers
each shard with one bit per window: whether another shard has a smaller id. The shard, whose rows are still there, lists its
windows again, takes the answers and what repeats within itself, merges the marks of a document into maximal intervals, and cuts its
words. Buckets and shards grow in number with the input, not in size. Documents, however many are alike, spread over all shards, and a
window that a third of them share reaches its bucket once for each shard of some 8 MB of text, however often it stands there.
"""

from __future__ import annotations

import struct
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .tokens import MIX_A, OTHER_BASE, PLAIN, Words, mixed, pieces, window_hashes

#: Mean windows of a bucket; mean bytes of text of a shard.
PER_BUCKET, PER_SHARD = 2 << 20, 8 << 20
#: Least buckets and shards, so that small inputs spread over the cluster too.
LEAST = 64
NO_ID = np.iinfo(np.int64).max


def _windows(words: Words, size: int, buckets: int) -> tuple[np.ndarray, ...]:
    """First word, 64-bit key, bucket and row of each window; the bucket comes from a hash with another base, over words mixed anew."""
    first, n = words.windows(size)
    h = words.hashes()
    keys = window_hashes(h, first, size)
    bucket = (window_hashes(mixed(h ^ MIX_A), first, size, OTHER_BASE) >> np.uint64(33)) % np.uint64(buckets)
    return first, keys, bucket.astype(np.int64), np.repeat(np.arange(len(n)), n)


def _in_order(bucket: np.ndarray) -> np.ndarray:
    """A stable order by bucket."""
    return np.argsort(bucket.astype(np.uint16) if len(bucket) and bucket.max() < 1 << 16 else bucket, kind="stable")


class Shard:
    """The different windows of some documents, in an order that depends on the documents alone: by bucket, smallest id, key."""

    def __init__(self, ids: np.ndarray, texts: pa.ChunkedArray, size: int, buckets: int):
        found = []
        for lo, hi, data, bounds in pieces(texts):
            _, keys, bucket, row = _windows(Words(data, bounds, PLAIN), size, buckets)
            found.append((keys, bucket, ids[lo:hi][row]))
        keys, bucket, owner = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, t) for t in (np.uint64, np.int64, np.int64))
        order = np.argsort(keys)
        order = order[_in_order(bucket[order])]
        keys, bucket, self.owner = keys[order], bucket[order], owner[order]
        begin = np.flatnonzero(np.append(True, (np.diff(keys) != 0) | (np.diff(bucket) != 0))) if len(keys) else np.zeros(0, np.int64)
        self.window, self.times = order, np.diff(np.append(begin, len(keys)))
        least = np.minimum.reduceat(self.owner, begin) if len(begin) else self.owner
        place = np.argsort(least, kind="stable")
        self.place = place[_in_order(bucket[begin][place])]
        self.least = least
        self.keys, self.bucket, self.ids = keys[begin][self.place], bucket[begin][self.place], least[self.place]
        self.cut = np.append(np.flatnonzero(np.diff(self.bucket, prepend=-1)), len(self.bucket))

    def repeated(self, elsewhere: np.ndarray) -> np.ndarray:
        """Of each window, in text order: whether a smaller id has it, in this shard or (a bit for each different window) in another."""
        other = np.empty(len(elsewhere), bool)
        other[self.place] = elsewhere
        marks = np.empty(len(self.window), bool)
        marks[self.window] = np.repeat(other, self.times) | (self.owner > np.repeat(self.least, self.times))
        return marks


def _send(size: int, buckets: int):
    """One row for each bucket: the shard, its smallest ids there, how many windows each has, and their keys."""

    def run(key: tuple, docs: pa.Table) -> pa.Table:
        s = Shard(docs["id"].to_numpy(), docs["text"], size, buckets)
        out = []
        for lo, hi in zip(s.cut[:-1], s.cut[1:]):
            begin = np.append(np.flatnonzero(np.append(True, np.diff(s.ids[lo:hi]) != 0)), hi - lo)
            out.append(struct.pack("<qqq", key[0].as_py(), len(begin) - 1, hi - lo) + s.ids[lo:hi][begin[:-1]].tobytes() + np.diff(begin).astype(np.int32).tobytes() + s.keys[lo:hi].tobytes())
        return pa.table({"bucket": pa.array(s.bucket[s.cut[:-1]], pa.int64()), "body": pa.array(out, pa.binary())})

    return run


def _judge(key: tuple, group: pa.Table) -> pa.Table:
    """One bucket: of each shard's windows, in the order they came, whether another shard has a smaller id; shards without one get no answer."""
    shards, sizes, parts = [], [], []
    for body in (x.as_buffer() for x in group["body"]):
        shard, n, k = struct.unpack_from("<qqq", body)
        ids, times = np.frombuffer(body, np.int64, n, 24), np.frombuffer(body, np.int32, n, 24 + 8 * n)
        parts.append((np.repeat(ids, times), np.frombuffer(body, np.uint64, k, 24 + 12 * n)))
        shards.append(shard)
        sizes.append(k)
    ids, keys = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys)
    begin = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0))
    least = np.repeat(np.minimum.reduceat(ids[order], begin), np.diff(np.append(begin, len(keys))))
    marks = np.empty(len(keys), bool)
    marks[order] = ids[order] > least
    out_s, out, at = [], [], 0
    for shard, k in zip(shards, sizes):
        if marks[at : at + k].any():
            out_s.append(shard)
            out.append(struct.pack("<qq", key[0].as_py(), k) + np.packbits(marks[at : at + k]).tobytes())
        at += k
    return pa.table({"shard": pa.array(out_s, pa.int32()), "answer": pa.array(out, pa.binary())})


def _cut(size: int, buckets: int, with_text: bool):
    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        s = Shard(docs["id"].to_numpy(), docs["text"], size, buckets)
        elsewhere = np.zeros(len(s.keys), bool)
        for a in (x.as_buffer() for x in answers["answer"]):
            bucket, k = struct.unpack_from("<qq", a)
            at = int(np.searchsorted(s.bucket, bucket))
            if int(np.searchsorted(s.bucket, bucket, side="right")) - at != k:
                raise ValueError("rows changed while they were read: a shard's windows aren't those that it sent")
            elsewhere[at : at + k] = np.unpackbits(np.frombuffer(a, np.uint8, offset=16), count=k)
        marks = s.repeated(elsewhere)
        del s
        out = {"n_words": [], "n_removed": [], "kept_sha256": [], **{"kept": [] for _ in range(with_text)}}
        done = 0
        for lo, hi, data, bounds in pieces(docs["text"]):
            words = Words(data, bounds, PLAIN)
            first, _ = words.windows(size)
            marked = first[marks[done : done + len(first)]]
            done += len(first)
            # maximal intervals: overlapping and touching windows merge where the running count is above zero
            step = np.zeros(len(words) + 1, np.int32)
            np.add.at(step, marked, 1)
            np.add.at(step, marked + size, -1)
            keep = np.cumsum(step[:-1]) == 0
            text, ends = words.joined(keep)
            kept = [text[s : max(s, e - 1)] for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
            removed = np.diff(np.concatenate([[0], np.cumsum(~keep)])[words.first])
            out["n_words"].append(pa.array(words.counts))
            out["n_removed"].append(pa.array(removed))
            out["kept_sha256"].append(pa.array([sha256(t).hexdigest() for t in kept]))
            if with_text:
                # a text that lost nothing stays as it was, its white space too
                raw = docs["text"].slice(lo, hi - lo).to_pylist()
                out["kept"].append(pa.array([t if not r else k.decode("utf-8", "replace") for t, r, k in zip(raw, removed, kept)], pa.string()))
        rest = docs.drop_columns(["text", "id", "shard"])
        kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "kept": pa.string()}
        return pa.table([*rest.columns, *[pa.chunked_array(v, kinds[k]) for k, v in out.items()]], names=[*rest.column_names, *out])

    return run


def remove_repeats(docs: DataFrame, size: int = 13, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """The rows of ``docs`` (but the text) with ``n_words, n_removed, kept_sha256`` and, if asked for, ``kept``.

    A word (a run without ASCII white space) is removed if a window of ``size`` words covers it whose words also
    start in a row with a smaller id; windows are judged on the input. ``kept_sha256`` is of the kept words joined by
    a space; ``kept`` is the text itself if nothing is removed, else these joined words. Null text: no words (``kept`` null). Rows with
    equal ids don't remove from each other. A null id counts as larger than all others. Repeated rows, empty texts and empty
    tables are fine. Columns named as a result are replaced. Ids are integers.

    Windows count as equal if 64 bits of the key and the bucket's number, a hash of its own, are; the number of buckets grows with the
    input, so at 10**13 windows in five million buckets less than one pair of different windows is to be expected to meet. Words are
    64-bit hashes in both.
    """
    results = ["n_words", "n_removed", "kept_sha256", *["kept"] * with_text]
    size_of = docs.agg(F.sum(F.octet_length(text_col)), F.count("*")).first()
    total = int(size_of[0] or 0)
    buckets, shards = max(LEAST, total // 6 // PER_BUCKET), max(LEAST, total // PER_SHARD)
    ident, text = F.coalesce(F.col(id_col).cast("long"), F.lit(int(NO_ID))), F.col(text_col)
    shard = F.pmod(F.xxhash64(ident, text), F.lit(shards)).cast("int")
    others = [c for c in docs.columns if c not in (*results, text_col)]
    # other columns under names of their own, so that none clashes
    fields = [docs.schema[c] for c in others]
    plain = docs.select(ident.alias("id"), shard.alias("shard"), text.alias("text"), F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)]).alias("rest"))
    plain = plain.select("id", "shard", "text", *[F.col(f"rest.c{i}").alias(f"c{i}") for i in range(len(others))])
    # of the same rows by shard as the cut reads, so they are exchanged once
    sent = plain.groupBy("shard").applyInArrow(_send(size, buckets), "bucket long, body binary")
    answers = sent.groupBy("bucket").applyInArrow(_judge, "shard int, answer binary")
    found = [T.StructField(c, T.LongType() if c.startswith("n_") else T.StringType()) for c in results]
    schema = T.StructType([*(T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)), *found])
    cut = plain.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(_cut(size, buckets, with_text), schema)
    return cut.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(others)], *results)
