"""Benchmark decontamination by Wu-Manber search over words.

The patterns are the windows of the benchmark's items. All windows of one length are searched together: a table over
blocks of two words says how far the end of the window may jump without passing an occurrence; where it
says zero, the bucket of the block's full hash lists the windows that end so, their first block is compared, and
the words themselves are compared last. Many stretches of a batch are walked at once, as numpy lanes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import settle
from .tokens import ALNUM_LOWER, MIX_A, Words, mixed, pieces, runs

#: Bytes of benchmark text searched for at once; more text means more blocks, each a pass of its own.
BLOCK_BYTES = 4 << 20
LANE = 512
#: Passes that run in one stage before the rows are written.
CHAIN = 4


def _blocks(h: np.ndarray, end: np.ndarray, width: int) -> np.ndarray:
    """Hash of the block of ``width`` words that ends at each of ``end``."""
    return mixed(h[end] + (h[end - 1] * MIX_A if width == 2 else np.uint64(0)))


class Search:
    """Wu-Manber tables for all windows of ``length`` words, each given by its first word in ``words``."""

    def __init__(self, h: np.ndarray, first: np.ndarray, length: int):
        self.length, self.width = length, min(2, length)
        bits = int(np.clip(np.ceil(np.log2(16 * len(first) * length + 1)), 12, 24))
        self.mask = np.uint64((1 << bits) - 1)
        self.shift = np.full(1 << bits, length - self.width + 1, np.uint16)
        for j in range(self.width - 1, length):  # later blocks allow shorter jumps, so they overwrite
            self.shift[(_blocks(h, first + j, self.width) & self.mask).astype(np.int64)] = length - 1 - j
        suffix = _blocks(h, first + length - 1, self.width)
        order = np.argsort(suffix, kind="stable")
        self.first, self.suffix = first[order], suffix[order]
        self.prefix = _blocks(h, self.first + self.width - 1, self.width)

    def candidates(self, h: np.ndarray) -> np.ndarray:
        """Ends of windows where the shift table says zero."""
        n, zero = len(h), []
        pos = np.arange(self.length - 1, n, LANE)
        stop = np.minimum(pos + LANE, n)
        while len(pos):
            jump = self.shift[(_blocks(h, pos, self.width) & self.mask).astype(np.int64)].astype(np.int64)
            zero.append(pos[jump == 0])
            pos = pos + np.maximum(jump, 1)
            on = pos < stop
            pos, stop = pos[on], stop[on]
        return np.sort(np.concatenate(zero)) if zero else pos

    def occurrences(self, h: np.ndarray, words: Words, row: np.ndarray, own: np.ndarray, texts: Words) -> tuple[np.ndarray, np.ndarray]:
        """``(first word of the text, first word of the pattern)`` for every occurrence."""
        end = self.candidates(h)
        start = end - self.length + 1
        inside = row[start] == row[end]  # within one row
        start, end = start[inside], end[inside]
        block = _blocks(h, end, self.width)
        lo, hi = np.searchsorted(self.suffix, block), np.searchsorted(self.suffix, block, side="right")
        start, end = np.repeat(start, hi - lo), np.repeat(end, hi - lo)
        pattern = runs(lo, hi - lo)
        same = _blocks(h, start + self.width - 1, self.width) == self.prefix[pattern]
        start, first = start[same], self.first[pattern[same]]
        for j in range(self.length):
            same = h[start + j] == own[first + j]
            start, first = start[same], first[same]
        # the last word on it has the text itself: a stretch is put together once, and one window at most is equal to it
        keep, text, at = np.ones(len(start), bool), b"", -1
        for i, (s, f) in enumerate(zip(start.tolist(), first.tolist())):
            if s != at:
                text, at = words.text(s, s + self.length), s
            keep[i] = text == texts.text(f, f + self.length)
        return start[keep], first[keep]


class Patterns:
    """The different windows of some items, ``size`` words each, or the whole item if it has fewer; and which items have each.

    A window that many items share is one pattern. Windows with the same items share one list of them, numbered, so what a document costs
    doesn't depend on how many items have its passages.
    """

    def __init__(self, texts: list[str], ids: list[str | None], size: int):
        whole = pa.array(texts, pa.string())
        (_, _, data, bounds), = pieces(whole, 1 << 40) if texts else [(0, 0, np.zeros(0, np.uint8), np.zeros(1, np.int64))]
        self.words, self.h = (w := Words(data, bounds, ALNUM_LOWER)), w.hashes()
        n, start = self.words.counts, self.words.first[:-1]
        self.searches = []
        #: Of a pattern's first word: the number of its list of items. The lists: ids, sorted, without those that have none.
        self.list_of, self.lists = np.zeros(len(self.words), np.int32), []
        numbers: dict[tuple[int, ...], int] = {}
        for length in np.unique(np.minimum(n[n > 0], size)).tolist():
            rows = np.flatnonzero(np.minimum(n, size) == length)
            having: dict[bytes, list[int]] = {}
            for row in rows.tolist():
                for f in range(start[row], start[row] + n[row] - length + 1):
                    had = having.setdefault(self.words.text(f, f + length), [f])
                    if had[-1] != row or len(had) == 1:  # rows in order, so a row that is there is the last one
                        had.append(row)
            for first, *items in having.values():
                if (number := numbers.get(tuple(items))) is None:
                    number = numbers[tuple(items)] = len(self.lists)
                    self.lists.append(sorted({ids[i] for i in items} - {None}))
                self.list_of[first] = number
            self.searches.append(Search(self.h, np.array([x[0] for x in having.values()], np.int64), length))

    def found(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, length and list of items of every occurrence in ``words``."""
        h, row = words.hashes(), np.repeat(np.arange(len(words.counts)), words.counts)
        out = [(s, np.full(len(s), x.length), self.list_of[f]) for x in self.searches for s, f in [x.occurrences(h, words, row, self.h, self.words)]]
        if not out:
            return (np.zeros(0, np.int64),) * 3
        a, b, c = zip(*out)
        return np.concatenate(a), np.concatenate(b), np.concatenate(c)


def _pass(patterns):
    """Adds what one block of items hits to ``spans`` (pairs of first and end word, merged) and ``items``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = patterns.value
        for b in batches:
            at = b.schema.get_field_index("text")
            n_words, n_hit, spans, items = [], [], [], []
            had_spans, had_items = b.column(at + 1), b.column(at + 2)
            for lo, hi, data, bounds in pieces(b.column(at)):
                words = Words(data, bounds, ALNUM_LOWER)
                start, length, of = p.found(words)
                row = np.searchsorted(words.first, start, side="right") - 1
                step = np.zeros(len(words) + 1, np.int32)
                np.add.at(step, start, 1)
                np.add.at(step, start + length, -1)
                for i in range(lo, hi):
                    if (s := had_spans[i].as_py()) is not None:
                        old = np.frombuffer(s, np.int64).reshape(-1, 2) + words.first[i - lo]
                        np.add.at(step, old[:, 0], 1)
                        np.add.at(step, old[:, 1], -1)
                hit = np.cumsum(step[:-1]) > 0
                n_words += words.counts.tolist()
                n_hit += np.diff(np.concatenate([[0], np.cumsum(hit)])[words.first]).tolist()
                pair = np.unique(np.stack([row, of]), axis=1) if len(row) else np.zeros((2, 0), int)
                cut = np.searchsorted(pair[0], np.arange(hi - lo + 1))
                for i in range(hi - lo):
                    mine = {x for j in pair[1, cut[i] : cut[i + 1]].tolist() for x in p.lists[j]} | set(had_items[lo + i].as_py() or ())
                    items.append(sorted(mine))
                    own = hit[words.first[i] : words.first[i + 1]].astype(np.int8)
                    edge = np.flatnonzero(np.diff(own, prepend=0, append=0))
                    spans.append(edge.astype(np.int64).tobytes() if len(edge) else None)
            cols = [b.column(j) for j in range(at + 1)] + [pa.array(spans, pa.binary()), pa.array(items, pa.list_(pa.string())), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64())]
            names = b.schema.names[: at + 1] + ["spans", "items", "n_words", "n_hit"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def contamination(docs: DataFrame, items: DataFrame, size: int = 13, one_in: int = 20, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", keep_text: bool = False) -> DataFrame:
    """The rows of ``docs`` with ``n_words, n_hit, n_items, items, spans, items_sha256, contaminated``.

    A-Z are lower-cased; words are runs of ASCII letters, digits and all characters outside ASCII. A window is ``size``
    consecutive words of an item, or the whole item if it has fewer; a word of a document within an occurrence of a window is hit.
    ``contaminated``: some word is hit and the hit words are at least one in ``one_in``. ``spans``: pairs of first and end word of the hit
    stretches, as packed 64-bit integers (null if none). Null texts have no words. An item without an id is searched for but
    not listed; an id that stands on several rows counts once. Empty tables and repeated rows are fine; columns of ``docs`` named as a result are replaced.

    The items are searched for in blocks of a bounded size, chosen by their hash, so what is sent to the executors at once is bounded.
    """
    results = ["n_words", "n_hit", "n_items", "items", "spans", "items_sha256", "contaminated"]
    others = [c for c in docs.columns if c not in results]
    named = items.where(F.col(item_text).isNotNull()).select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text"))
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(total // BLOCK_BYTES) + 1
    state = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others) if keep_text or c != text_col], F.col(text_col).alias("text"), F.lit(None).cast("binary").alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    if not keep_text:
        others = [c for c in others if c != text_col]
        state = state.toDF(*[f"c{i}" for i in range(len(others))], "text", "spans", "items")
    kind = T.StructType([*state.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType())])
    spark = docs.sparkSession
    for k in range(blocks):
        rows = named.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).collect()
        sent = spark.sparkContext.broadcast(Patterns([r["text"] for r in rows], [r["id"] for r in rows], size))
        if k:
            state = state.drop("n_words", "n_hit")
            state = settle(state) if k % CHAIN == 0 else state
        state = state.mapInArrow(_pass(sent), kind)
    out = state.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(others)], "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "spans",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), ((F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words"))).alias("contaminated"))
    return out


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, with the columns of ``docs``."""
    return contamination(docs, items, keep_text=True, **options).where("not contaminated").select(*docs.columns)
