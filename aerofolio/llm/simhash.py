"""SimHash near-duplicates: fingerprints, then links within a bit distance by the generalised pigeonhole principle.

If the bits are cut into partitions with thresholds ``t_1 .. t_m`` and the sum of all ``t_i + 1`` is the distance
plus one, two fingerprints within the distance differ by at most ``t_i`` bits in some partition i. Bits that agree
often are put into one partition; the thresholds are unequal and come from a dynamic programme on the number
of candidates that each would bring, estimated from counts over all fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb, inf

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import settle
from .components import components
from .tokens import PLAIN_LOWER, Words, pieces, runs

BITS = 64
#: A bucket that would give more pairs than this is linked through common neighbours instead of pair by pair.
PAIRS = 4096


def _fingerprints(size: int):
    def one_column(column: pa.Array) -> np.ndarray:
        parts = []
        for lo, hi, data, bounds in pieces(column):
            words = Words(data, bounds, PLAIN_LOWER)
            text, _ = words.joined()
            n_words = words.counts
            to = np.cumsum(words.end - words.start + 1) - 1  # ends of words in the joined text, space left out
            at = np.concatenate([[0], to + 1])
            n = np.where(n_words > 0, np.maximum(n_words - size + 1, 1), 0)
            first = runs(words.first[:-1], n)
            last = first + np.repeat(np.minimum(n_words, size), n) - 1
            ones = np.zeros((hi - lo, BITS), np.int64)
            row = np.repeat(np.arange(hi - lo), n)
            for i in range(0, len(first), 1 << 16):
                s, e, r = at[first[i : i + (1 << 16)]], to[last[i : i + (1 << 16)]], row[i : i + (1 << 16)]
                h = np.fromiter((xxhash.xxh64_intdigest(text[x:y], 42) for x, y in zip(s.tolist(), e.tolist())), np.uint64, len(s))
                bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                cut = np.flatnonzero(np.diff(r, prepend=-1))
                ones[r[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int32)
            most = 2 * ones > n[:, None]
            parts.append(np.packbits(most, axis=1, bitorder="little").view(np.int64).ravel())
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(one_column(b.column(1)))], names=["id", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp)``: bit i of the long ``fp`` is set if it is set in over half of the shingles' hashes.

    A-Z are lower-cased, words are runs without ASCII white space, a shingle is ``shingle`` words joined by a space
    (of fewer words, all of them), its hash XXH64 with seed 42. No words, or null text: 0.
    """
    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_fingerprints(shingle), f"id {kind}, fp long")


# ---------------------------------------------------------------- partitions and thresholds


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros((BITS, BITS)), 0
    for b in batches:
        fp = b.column(0).to_numpy().view(np.uint8).reshape(-1, 8)
        x = np.unpackbits(fp, axis=1, bitorder="little").astype(np.float32)
        total += x.T @ x
        n += len(x)
    if n:
        i, j = np.nonzero(np.ones((BITS, BITS), bool))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel().astype(np.int64)), pa.array(np.full(len(i), n))], names=["i", "j", "both", "n"])


def bit_partitions(both: np.ndarray, n: int, m: int) -> list[list[int]]:
    """Cut the bits into ``m`` groups of about equal size, each grown by the bit most correlated with those it has."""
    p = np.diag(both) / n
    cov = both / n - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, groups = set(range(BITS)), []
    for k in range(m):
        size = len(left) // (m - k)
        rest = sorted(left)
        group = [max(rest, key=lambda b: (corr[b, rest].sum(), -b))]
        left.discard(group[0])
        while len(group) < size:
            nxt = max(sorted(left), key=lambda b: (corr[b, group].sum(), -b))
            group.append(nxt)
            left.discard(nxt)
        groups.append(sorted(group))
    return groups


def allocate(cost: list[dict[int, float]], distance: int) -> list[int]:
    """Thresholds (-1: not probed) of least total cost with ``sum(t + 1) == distance + 1``, by dynamic programming."""
    best: list[tuple[float, list[int]]] = [(0.0, [])] + [(inf, [])] * (distance + 1)
    for c in cost:
        best = [
            min(((best[k - t - 1][0] + c[t], [*best[k - t - 1][1], t]) for t in range(-1, k)), key=lambda x: (x[0], x[1]))
            for k in range(distance + 2)
        ]
    return best[-1][1]


def _masked(groups: list[list[int]]) -> list[int]:
    signed = [sum(1 << b for b in g) for g in groups]
    return [x - (1 << 64) if x >> 63 else x for x in signed]


def plan(fps: DataFrame, distance: int) -> tuple[list[list[int]], list[int]]:
    """Partitions and thresholds for distinct fingerprints ``fps(fp)``.

    For each number of partitions up to ``distance + 1``: pairs that agree on a whole partition are counted over
    all fingerprints; pairs that differ by e bits there are estimated from these and the bits' frequencies.
    The dynamic programme gives the thresholds, the cheapest cut wins. Only the 64 x 64 counts of set bits and one count a
    partition come to the driver.
    """
    seen = fps.mapInArrow(_agreement, "i long, j long, both long, n long").groupBy("i", "j").agg(F.sum("both").alias("both"), F.sum("n").alias("n")).collect()
    n = seen[0]["n"] if seen else 0
    if n < 2:
        return [list(range(BITS))], [distance]
    both = np.zeros((BITS, BITS))
    for r in seen:
        both[r["i"], r["j"]] = r["both"]
    p = np.diag(both) / n
    agree = np.clip(p * p + (1 - p) * (1 - p), 1e-9, 1 - 1e-9)
    cuts = [bit_partitions(both, n, m) for m in range(1, distance + 2)]
    masks = [x for g in cuts for x in _masked(g)]
    keys = fps.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(x)).alias("v")) for i, x in enumerate(masks)])).alias("k")).select("k.*")
    exact = {r["i"]: r["pairs"] for r in keys.groupBy("i", "v").agg(F.count("*").cast("double").alias("c")).groupBy("i").agg(F.sum(F.col("c") * F.col("c")).alias("pairs")).collect()}
    best, at = (inf, [], []), 0
    for groups in cuts:
        cost = []
        for g in groups:
            odds = np.zeros(distance + 1)
            odds[0] = 1
            for b in g:  # chances of exactly e differing bits, relative to none
                odds[1:] += odds[:-1] * (1 - agree[b]) / agree[b]
            near = np.cumsum(odds)
            probes = np.cumsum([comb(len(g), e) for e in range(distance + 1)])
            cost.append({-1: 0.0} | {e: exact[at] * near[e] + n * float(probes[e]) for e in range(distance + 1)})
            at += 1
        t = allocate(cost, distance)
        total = sum(c[x] for c, x in zip(cost, t))
        if total < best[0]:
            best = (total, groups, t)
    return best[1], best[2]


def _flips(bits: list[int], most: int) -> list[int]:
    """All masks of at most ``most`` of the bits, as signed longs."""
    return [x for k in range(most + 1) for c in combinations(bits, k) for x in _masked([list(c)])]


def _xored(masks: list[int]):
    if masks == [0]:
        return F.array(F.col("fp"))
    return F.transform(F.array(*[F.lit(x) for x in masks]), lambda x: F.col("fp").bitwiseXOR(x))


def links(fps: DataFrame, distance: int) -> DataFrame:
    """``(src, dst)``: links between distinct fingerprints ``fps(fp)`` that connect just those within ``distance`` bits.

    Every fingerprint probes, in each partition, the keys within its threshold. Where a key has few members, all
    pairs are verified by their bit distance. Members of a crowded key are linked through common neighbours:
    two of them are within d bits if and only if some value lies within floor(d/2) bits of one and ceil(d/2)
    of the other, so each member names those values, and each value links who named it; the work grows with the
    members, not with their pairs, and no link of a pair is lost.
    """
    groups, thresholds = plan(fps, distance)
    probed = [(i, m, g, t) for i, (m, g, t) in enumerate(zip(_masked(groups), groups, thresholds)) if t >= 0]
    rows = [
        fps.select("fp", F.explode(_xored(_flips(g, t))).alias("near")).select(
            F.lit(i).alias("i"), F.col("near").bitwiseAND(F.lit(m)).alias("v"), "fp",
            (F.col("near").bitwiseAND(F.lit(m)) == F.col("fp").bitwiseAND(F.lit(m))).alias("own"))
        for i, m, g, t in probed
    ]
    keyed = rows[0]
    for r in rows[1:]:
        keyed = keyed.union(r)
    keyed = settle(keyed)
    size = keyed.groupBy("i", "v").agg(F.count("*").alias("n"), F.sum(F.col("own").cast("long")).alias("n_own"))
    size = settle(size.where("n > 1 and n_own > 0").select("i", "v", (F.col("n") * F.col("n_own") > PAIRS).alias("crowded")))
    met = settle(keyed.join(size, ["i", "v"]))
    few = met.where("not crowded")
    left = few.where("own").select("i", "v", F.col("fp").alias("src"))
    pairs = (
        left.join(few.select("i", "v", F.col("fp").alias("dst")), ["i", "v"])
        .where((F.col("src") != F.col("dst")) & (F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= distance)).select("src", "dst")
    )
    crowd = met.where("crowded").select("fp").distinct()
    inner, outer = distance // 2, distance - distance // 2
    named = crowd.select("fp", F.explode(_xored(_flips(list(range(BITS)), outer))).alias("mid"))
    named = named.withColumn("close", F.bit_count(F.col("fp").bitwiseXOR(F.col("mid"))) <= inner)
    # no closer one: the value links nobody; else all who named it are within reach of that one
    hub = named.groupBy("mid").agg(F.min(F.when(F.col("close"), F.col("fp"))).alias("hub"), F.min("fp").alias("lo"), F.max("fp").alias("hi"))
    hub = hub.where("hub is not null and lo != hi").select("mid", "hub")
    through = named.select("mid", "fp").join(hub, "mid").where("fp != hub").select(F.col("fp").alias("src"), F.col("hub").alias("dst"))
    return pairs.union(through.distinct())


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp, component)`` for every row of ``docs``; component is the smallest id reachable by links.

    Fingerprints within ``distance`` bits are linked; equal ones are one vertex, so copies cost nothing, and the
    fingerprint 0 of texts without words links like any other. Repeated rows come back as often as they came. A
    null id is never the smallest: its row gets the component of its group, or null if no row there has an id. Other columns
    are ignored; an empty table gives no rows.
    """
    prints = settle(fingerprints(docs, shingle, id_col, text_col))
    classes = settle(prints.groupBy("fp").agg(F.min("id").alias("least")))
    found = components(links(classes.select("fp"), distance)).select(F.col("id").alias("fp"), F.col("component").alias("root"))
    rooted = settle(classes.join(settle(found), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    smallest = settle(rooted.groupBy("root").agg(F.min("least").alias("component")))
    named = settle(rooted.join(smallest, "root").select("fp", "component"))
    return prints.join(named, "fp").select("id", "fp", "component")


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the row with the smallest id stays.

    Of rows with that id, the one with the smallest hash over all columns stays, once; a group in which no row has an id keeps
    one row too.
    """
    rows = docs.withColumn("_row", F.xxhash64(*docs.columns))
    found = near_duplicates(docs.select(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(*docs.columns).alias("row")).alias("_id"), F.col(text_col).alias("_text")), shingle, distance, "_id", "_text")
    stays = settle(found.where("id = component").select(F.col("id.id").alias("_keep"), F.col("id.row").alias("_row")).distinct())
    joined = rows.join(stays, (rows[id_col].eqNullSafe(stays["_keep"])) & (rows["_row"] == stays["_row"])).drop(stays["_row"])
    return joined.dropDuplicates(["_keep", "_row"]).select(*docs.columns)
