"""How filters interact: truth-table words of surviving subsets, counted by carry-save positional popcounts.

A document's failures are five bits. Its word has a bit for each of the 32 subsets of the filters, set if the document
survives that subset; the sums of the words, bit by bit, are the survivors of every subset. All orders of the filters
follow from those 32 counts of a part: what is left after a step is what survives the subset applied so far.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import settle
from .tokens import runs

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
EVERY = SUBSETS - 1
#: Word of each failure mask: bit s is set if the mask and subset s have no filter in common.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & m) for m in range(SUBSETS)], np.uint32)
#: Rows of counts held by a task before they are sent on, and bytes of a text that are split at once.
HELD, BLOCK = 1 << 12, 1 << 20

_CAPITALS, _MARKS, _INSIDE = bytes(range(65, 91)), b"#$%&*|", bytes(range(0x80, 0xC0))
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def word_counts(text: bytes) -> tuple[int, int]:
    """Words and different words; a long text is split block by block, at white space."""
    if len(text) <= BLOCK:
        words = text.split()
        return len(words), len(set(words))
    n, seen, at = 0, set(), 0
    while at < len(text):
        end = _SPACE.search(text, at + BLOCK)
        to = end.end() if end else len(text)
        words = text[at:to].split()
        n, at = n + len(words), to
        seen.update(words)
    return n, len(seen)


def failures(text: bytes) -> int:
    """Bits of the filters that look at one text alone (A to D)."""
    words, different = word_counts(text)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    chars = len(text.translate(None, _INSIDE))
    marked = len(text) != len(text.translate(None, _MARKS))
    return (words < 50) | (100 * different < 65 * words) << 1 | (100 * capitals > 5 * chars) << 2 | marked << 3


def positional_counts(words: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """How often each of the 32 bits is set among the words of each group, as ``groups x 32``.

    Full adders take three words of one weight and give a sum and a carry of twice the weight, for all 32 bits at once;
    a weight is done when one word of a group is left, and only these are taken apart into bits.
    """
    out = np.zeros((groups, 32), np.int64)
    order = np.argsort(group, kind="stable")
    words, sizes, weight = words[order], np.bincount(group, minlength=groups), 0
    while len(words):
        carried, carriers = [], []
        while sizes.max() > 1:
            first, third = np.cumsum(sizes) - sizes, -(-sizes // 3)
            at = 3 * runs(np.zeros_like(third), third) + np.repeat(first, third)
            stop = np.repeat(first + sizes, third)
            a, b, c = (np.where(at + k < stop, words[np.minimum(at + k, len(words) - 1)], np.uint32(0)) for k in range(3))
            carried.append((a & b) | (c & (a ^ b)))
            carriers.append(np.repeat(np.arange(groups), third))
            words, sizes = a ^ b ^ c, third
        out[sizes > 0] += ((words[:, None] >> np.arange(32, dtype=np.uint32)) & np.uint32(1)).astype(np.int64) << weight
        if not carried:
            break
        of = np.concatenate(carriers)
        order = np.argsort(of, kind="stable")
        words, sizes, weight = np.concatenate(carried)[order], np.bincount(of, minlength=groups), weight + 1
    return out


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [failures(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 1)), pa.array(found, pa.int32())], names=[*b.schema.names[:-1], "mask"])


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, int], np.ndarray] = {}

    def out() -> pa.RecordBatch:
        kinds, counts = list(held), list(held.values())
        return pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in kinds], pa.string()), pa.array([k for _, k in kinds], pa.int32()), pa.array([c.tolist() for c in counts], pa.list_(pa.int64()))],
            names=["part", "marks", "survivors"])

    for b in batches:
        if not b.num_rows:
            continue
        parts = b.column("part").dictionary_encode()
        names = parts.dictionary.to_pylist()
        group = np.asarray(parts.indices).astype(np.int64) * 4 + np.asarray(b.column("marks"))
        there, group = np.unique(group, return_inverse=True)
        counts = positional_counts(WORDS[np.asarray(b.column("mask"))], group, len(there))
        for key, c in zip(there.tolist(), counts):
            name = (names[key // 4], key % 4)
            held[name] = held[name] + c if name in held else c
        if len(held) > HELD:
            yield out()
            held.clear()
    if held:
        yield out()


def masked(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Of each document its ``part``, failure ``mask`` and ``marks`` (1: labelled good, 2: labelled toxic).

    Copies are found by the SHA-256 of the text: the least id of each text is joined back by text and id together, so a
    text that a third of the rows share is no hot key. Of the narrow rows this makes, a written table is used twice; texts are read once.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("sha"), text.alias("text"))
    kind = T.StructType([*rows.schema.fields[:-1], T.StructField("mask", T.IntegerType())])
    facts = settle(rows.mapInArrow(_masks, kind))
    first = facts.groupBy("sha").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 2).otherwise(0)).alias("toxic"))
    marks = (F.coalesce("good", F.lit(0)) + F.coalesce("toxic", F.lit(0))).cast("int")
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    joined = facts.join(first, ["sha", "id"], "left").join(known, "id", "left")
    return joined.select("id", "part", (F.col("mask") + F.when(copy, 16).otherwise(0)).cast("int").alias("mask"), marks.alias("marks"))


def survivors(masks: DataFrame) -> DataFrame:
    """Per part an array of 32: of every subset, ``kept`` documents that survive it, and of these the ``good`` and the ``toxic``."""
    kind = T.StructType([T.StructField("part", T.StringType()), T.StructField("marks", T.IntegerType()), T.StructField("survivors", T.ArrayType(T.LongType()))])
    counted = masks.select("part", "mask", "marks").mapInArrow(_survivors, kind).select("part", "marks", F.posexplode("survivors").alias("subset", "n"))

    def those(bit: int) -> Column:
        return F.sum(F.when(F.col("marks").bitwiseAND(bit) != 0, F.col("n")).otherwise(0))

    each = counted.groupBy("part", "subset").agg(F.sum("n").alias("kept"), those(1).alias("good"), those(2).alias("toxic"))
    return each.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("subset", "kept", "good", "toxic"))).alias("of"))


def _steps() -> str:
    """All orders of the filters, step by step: the subset applied before, and the filter."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for i, f in enumerate(order):
            out.append({"filter_order": "".join(FILTERS[k] for k in order), "step": i + 1, "before": before, "f": f})
            before |= 1 << f
    return json.dumps(out)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Per part, order of the five filters and step: what the step keeps and removes, and what its filter does in any order.

    A null text is empty, a null part the empty string. A null id is no smaller id, and is never a copy of one; rows of one
    id with one text are no copies of each other. A document is good or toxic if any of its labels says so. Repeated rows count each. An empty table gives no rows.
    """
    steps = F.from_json(F.lit(_steps()), "array<struct<filter_order:string,step:int,before:int,f:int>>")
    rows = survivors(masked(docs, labels, id_col, text_col, part_col)).select("part", "of", F.explode(steps).alias("at"))
    own = F.call_function("shiftleft", F.lit(1), F.col("at.f"))

    def of(subset: Column, what: str = "kept") -> Column:
        return F.get("of", subset)[what]

    before, after = F.col("at.before"), F.col("at.before").bitwiseOR(own)
    removed = of(before) - of(after)
    rest = len(FILTERS) - 1
    worth = F.lit(0).cast("long")
    for f in range(len(FILTERS)):
        mine = [(s, factorial(s.bit_count()) * factorial(rest - s.bit_count())) for s in range(SUBSETS) if not s >> f & 1]
        total = sum(((of(F.lit(s)) - of(F.lit(s | 1 << f))) * F.lit(w) for s, w in mine), F.lit(0).cast("long"))
        worth = F.when(F.col("at.f") == f, total).otherwise(worth)
    return rows.select(
        "part", "at.filter_order", "at.step", of(after).alias("kept"), removed.alias("removed"), (of(F.lit(0)) - of(own) - removed).alias("redundant"),
        (of(F.lit(EVERY) - own) - of(F.lit(EVERY))).alias("unique_fails"), (of(before, "good") - of(after, "good")).alias("good_lost"),
        (of(before, "toxic") - of(after, "toxic")).alias("toxic_lost"), worth.alias("shapley"))
