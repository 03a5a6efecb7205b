"""Near-duplicate embeddings by NN-descent.

A graph of each vector's nearest neighbours starts from leaves of random hyperplanes and is refined: the neighbours of one vector
(and those that have it as neighbour) meet, compare themselves, and keep who is nearer than the last of their list, until no
link is new. Lists that hold nothing but links are saturated and may hide more, so they are enlarged to all members of their
group of links, which is compared in blocks; and their vectors search again, among those of other groups only, until no two
groups are found linked. A bounded sample is compared with all vectors; while the links found for it fall
short, lists are made longer, new leaves are added and the descent goes on; if that doesn't help, the job ends with an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import settle
from .components import components

#: Rows of a leaf and of a block; proposals, and sums of groups, that a task holds before it sends them on; cosines that the audit holds at once.
LEAF, BLOCK_ROWS, PROPOSALS, SUMS, CELLS = 1024, 128, 1 << 18, 1024, 1 << 20
#: Members of one group that a search between groups begins from, about; its rounds at most, and the share of entries that changed when it ends.
ENVOYS, ACROSS_ROUNDS, ACROSS_SETTLED = 64, 16, 0.01
#: Compared with one byte for each component of the rotated vectors, cosines are off by less than this: no component stands out after the rotation, so rounding
#: moves a vector by less than a hundredth of its length.
MARGIN = 0.02
GRAPH = "id long, to long, sim float, fresh boolean"


def _unit(x: np.ndarray) -> np.ndarray | None:
    x = np.asarray(x, np.float64)
    if not len(x) or not np.isfinite(x).all():
        return None
    top = np.abs(x).max()
    if top == 0:
        return None
    x = x / top  # else very large or small components overflow in the norm
    return x / np.sqrt(x @ x) + 0.0


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, unit)``: the unit vector's bytes as doubles, null if the vector links with nothing."""
    for b in batches:
        out = []
        for v in b.column(1):
            if not v.is_valid or v.values.null_count:
                out.append(None)
                continue
            u = _unit(v.values.to_numpy(zero_copy_only=False))
            out.append(u.tobytes() if u is not None else None)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["id", "unit"])


def _matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    """Rows of equal length as a matrix."""
    return np.stack([np.frombuffer(x.as_buffer(), kind) for x in column])


def _by_length(column: pa.Array) -> list[np.ndarray]:
    """Row numbers by the length of the vector: vectors of different lengths are never compared."""
    n = np.array([x.as_buffer().size for x in column])
    return [np.flatnonzero(n == k) for k in np.unique(n)]


def _rotated(x: np.ndarray) -> np.ndarray:
    """Rows turned by random signs and a Hadamard transform, filled up to a power of two; this keeps cosines and spreads what single components hold."""
    rows, width = x.shape
    n = 1 << (width - 1).bit_length()
    y = np.zeros((rows, n))
    y[:, :width] = x * np.random.default_rng(width).choice([-1.0, 1.0], width)
    step = 1
    while step < n:
        pairs = y.reshape(rows, n // (2 * step), 2, step)
        y = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, n)
        step *= 2
    return y


def _leaves(rounds: int, levels: int, seed: int):
    """Each vector ``(id, unit, group)`` once a round, with its side of some random hyperplanes, its place along another direction, and its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows in _by_length(b.column(1)):
                x, ids, groups = _matrix(b.column(1).take(pa.array(rows))), b.column(0).take(pa.array(rows)), b.column(2).take(pa.array(rows))
                turned = _rotated(x)
                small = pa.array([r.tobytes() for r in np.rint(turned * (127 / np.abs(turned).max(1, keepdims=True))).astype(np.int8)], pa.binary())
                for r in range(rounds):
                    g = np.random.default_rng([seed, r, x.shape[1]]).standard_normal((x.shape[1], levels + 1))
                    p = x @ g
                    code = (p[:, :levels] > 0) @ (1 << np.arange(levels, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [ids, groups, small, pa.array(np.full(len(x), r * (1 << 20) + x.shape[1])), pa.array(code), pa.array(p[:, levels])], names=["id", "group", "small", "tree", "code", "along"])

    return run


def _similar(column: pa.Array) -> np.ndarray:
    x = _matrix(column, np.int8).astype(np.float32)
    x /= np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)
    return x @ x.T


def _leaf_neighbours(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def near(t: pa.Table) -> pa.RecordBatch:
            sim = _similar(t["small"].combine_chunks())
            ids, group = t["id"].to_numpy(), t["group"].to_numpy()
            sim[group[:, None] == group[None, :]] = -2
            k = min(size, len(sim) - 1)
            top = np.argpartition(-sim, k - 1, axis=1)[:, :k]
            near = np.take_along_axis(sim, top, 1)
            a, b = np.nonzero(near > -2)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids[a]), pa.array(ids[top[a, b]]), pa.array(near[a, b]), pa.array(np.ones(len(a), bool))], names=["id", "to", "sim", "fresh"])

        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = pa.concat_tables([held, t]) if held is not None else t
            while len(held) >= 2 * LEAF:
                part, held = held.slice(0, LEAF), held.slice(LEAF)
                yield from _per_tree(part, near)
        if held is not None and len(held):
            for at in range(0, len(held), LEAF):
                yield from _per_tree(held.slice(at, LEAF), near)

    return run


def _per_tree(t: pa.Table, near) -> Iterator[pa.RecordBatch]:
    """A leaf at the border of two rounds is cut there."""
    cut = np.flatnonzero(np.diff(t["tree"].to_numpy(), prepend=-1))
    for lo, hi in zip(cut, np.append(cut[1:], len(t))):
        if hi - lo > 1:
            yield near(t.slice(lo, hi - lo))


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of rows that come sorted by ``keys``, some at a time, with where they begin."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        held = pa.concat_tables([held, t]) if held is not None else t
        k = np.stack([held[c].to_numpy() for c in keys])
        begin = np.flatnonzero(np.append(True, (np.diff(k) != 0).any(0)))
        if len(begin) > 1:
            yield held.slice(0, begin[-1]).combine_chunks(), begin[:-1]
            held = held.slice(begin[-1])
    if held is not None and len(held):
        k = np.stack([held[c].to_numpy() for c in keys])
        yield held.combine_chunks(), np.flatnonzero(np.append(True, (np.diff(k) != 0).any(0)))


def _nearest(i: np.ndarray, to: np.ndarray, sim: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Each pair once, and of each ``i`` its ``size`` nearest."""
    order = np.lexsort((-sim, to, i))
    i, to, sim = i[order], to[order], sim[order]
    once = (np.diff(i, prepend=-1) != 0) | (np.diff(to, prepend=-1) != 0)
    i, to, sim = i[once], to[once], sim[once]
    order = np.lexsort((to, -sim, i))
    i, to, sim = i[order], to[order], sim[order]
    begin = np.flatnonzero(np.diff(i, prepend=-1))
    keep = np.arange(len(i)) - np.repeat(begin, np.diff(np.append(begin, len(i)))) < size
    return i[keep], to[keep], sim[keep]


def _local_join(size: int):
    """Members around one vector compare themselves, but those of one group; a pair without a fresh member has met before.

    A task cuts what it proposes to each vector to the length of its list before it sends it.
    """

    def sent(out: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        a, b, s = _nearest(*(np.concatenate(x) for x in zip(*out)), size)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s, pa.float32()), pa.array(np.ones(len(a), bool))], names=["id", "to", "sim", "fresh"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, ...]] = []
        held = 0
        for t, begin in _grouped(batches, ["around"]):
            ids, group, fresh, last = (t[c].to_numpy() for c in ("id", "group", "fresh", "last"))
            raw = t["small"].combine_chunks() if isinstance(t["small"], pa.ChunkedArray) else t["small"]
            for lo, hi in zip(begin, np.append(begin[1:], len(ids))):
                if hi - lo < 2 or not fresh[lo:hi].any():
                    continue
                i, g, f, w = ids[lo:hi], group[lo:hi], fresh[lo:hi], last[lo:hi]
                sim = _similar(raw.slice(lo, hi - lo))
                better = (f[:, None] | f[None, :]) & (g[:, None] != g[None, :]) & (sim > w[:, None])
                if hi - lo > size:  # no list has room for more
                    sim = np.where(better, sim, -2)
                    top = np.argpartition(-sim, size - 1, axis=1)[:, :size]
                    a, k = np.nonzero(np.take_along_axis(better, top, 1))
                    b = top[a, k]
                else:
                    a, b = np.nonzero(better)
                if len(a):
                    out.append((i[a], i[b], sim[a, b]))
                    held += len(a)
                if held >= PROPOSALS:
                    yield sent(out)
                    out, held = [], 0
        if out:
            yield sent(out)

    return run


def _top(edges: DataFrame, size: int, least: float) -> DataFrame:
    """The ``size`` nearest of each id, with the list's number of links and what is needed to enter it; an entry that was there before is fresh no more."""
    once = edges.repartition("id").groupBy("id", "to").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    lists = once.groupBy("id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("sim")).alias("far"), "to", "fresh"))), 1, size).alias("l"))
    far = F.when(F.size("l") < size, F.lit(-2.0)).otherwise(-F.element_at("l", -1)["far"]).cast("float")
    links = F.size(F.filter("l", lambda e: -e["far"] >= least))
    out = lists.select("id", far.alias("last"), links.alias("links"), F.posexplode("l").alias("place", "e"))
    return out.select("id", "e.to", (-F.col("e.far")).cast("float").alias("sim"), "e.fresh", "place", "last", "links")


def _new_links(graph: DataFrame, size: int, least: float) -> tuple[int, int]:
    """Links and new links in lists that aren't saturated; the others are enlarged to whole groups anyhow, whatever changes in them."""
    r = graph.where((F.col("links") < size) & (F.col("sim") >= least)).agg(F.count("*").alias("links"), F.count_if("fresh").alias("new")).first()
    return r["links"], r["new"]


def _descend(graph: DataFrame, small: DataFrame, size: int, least: float, rounds: int, settled: float, walk: DataFrame | None = None) -> DataFrame:
    """Rounds of neighbours-of-neighbours joins, until no more than ``settled`` of the links of at least ``least`` are new.

    With ``walk(id, to)``, the links within groups, ``graph`` holds entries between groups: the walk leads to nearer
    ones but enters no list, and entries of any nearness count as links do, since a nearer one may lie behind each.
    """
    for k in range(rounds):
        nodes = graph.where("place = 0").select("id", "last")
        known = small.join(nodes, "id", "left").select("id", "group", "small", F.coalesce("last", F.lit(-2.0).cast("float")).alias("last"))
        # who has very many that list it meets a part of them, another one each round, so no group grows with its fame
        ways = graph.select("id", "to", "fresh")
        if walk is not None:
            ways = ways.union(walk.select("id", "to", F.lit(False)))
        fame = ways.groupBy("to").agg(F.count("*").alias("fame"))
        back = ways.join(fame, "to").where(F.pmod(F.xxhash64("id", "to", F.lit(k)), F.lit(1 << 30)) < F.lit(float(1 << 30)) * size / F.col("fame"))
        around = ways.select(F.col("id").alias("around"), F.col("to").alias("id"), "fresh").union(back.select(F.col("to").alias("around"), "id", "fresh"))
        met = around.groupBy("around", "id").agg(F.max("fresh").alias("fresh"))
        fields = met.join(known, "id").select("around", "id", "group", "fresh", "last", "small")
        found = fields.repartition("around").sortWithinPartitions("around").mapInArrow(_local_join(size), GRAPH)
        graph = settle(_top(graph.select("id", "to", "sim", F.lit(False).alias("fresh")).union(found), size, least))
        links, new = _new_links(graph, size, least) if walk is None else graph.agg(F.count("*"), F.count_if("fresh")).first()
        if new <= settled * links:
            break
    return graph


def _start(vectors: DataFrame, trees: int, size: int, least: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """``(id, group, small)`` of all ``vectors(id, unit, group)``, and the first lists, from leaves of random hyperplanes."""
    n = vectors.count()
    levels = max(0, int(np.ceil(np.log2(max(n, 1) / (LEAF / 2)))))
    leaves = settle(vectors.select("id", "unit", "group").mapInArrow(_leaves(trees, min(levels, 40), seed), "id long, group long, small binary, tree long, code long, along double"))
    parts = max(1, trees * n // (8 * LEAF))
    sorted_leaves = leaves.repartitionByRange(parts, "tree", "code", "along").sortWithinPartitions("tree", "code", "along")
    return leaves.where(F.col("tree") < 1 << 20).select("id", "group", "small"), settle(_top(sorted_leaves.mapInArrow(_leaf_neighbours(size), GRAPH), size, least))


def _across(graph: DataFrame, classes: DataFrame, small: DataFrame, size: int, least: float, trees: int, seed: int) -> DataFrame:
    """``(id, component)``: groups by the graph's links, and by those between its groups that saturated lists had no room for.

    A link is in the list of one of its ends unless both lists are saturated. So only vectors with saturated lists search
    again, for their nearest outside of their group: from some envoys of each group, along the lists of all. Groups found
    linked are one, whose members look further, until no link is found.
    """
    near = graph.where(F.col("sim") >= least)
    edges = settle(near.select(F.col("id").alias("src"), F.col("to").alias("dst")))
    full = graph.where((F.col("place") == 0) & (F.col("links") >= size)).select("id")
    walk = settle(near.join(full, "id").join(full.withColumnRenamed("id", "to"), "to").select("id", "to"))
    while True:
        groups = settle(components(edges))
        mine = settle(full.join(groups, "id").select("id", F.col("component").alias("group")))
        sizes = settle(mine.groupBy("group").agg(F.count("*").alias("size")))
        if sizes.limit(2).count() < 2:
            return groups
        envoy = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < F.lit(float(1 << 30)) * ENVOYS / F.col("size")
        envoys = settle(mine.join(sizes, "group").where(envoy).join(classes.select("id", "unit"), "id").select("id", "unit", "group"))
        _, first = _start(envoys, trees, size, least, seed)
        bytes_of = settle(small.select("id", "small").join(mine, "id").select("id", "group", "small"))
        found = _descend(first, bytes_of, size, least, ACROSS_ROUNDS, ACROSS_SETTLED, walk).where(F.col("sim") >= least)
        found = settle(found.select(F.col("id").alias("src"), F.col("to").alias("dst")))
        if found.isEmpty():
            return groups
        edges = settle(edges.union(found))


def _count_links(threshold: float):
    """Exact cosines within one pair of blocks: each member's links there, and a link to the smallest member it is connected with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, begin in _grouped(batches, ["group", "a", "b"]):
            a, b, block, ids, copies = (t[c].to_numpy() for c in ("a", "b", "block", "id", "copies"))
            units = t["unit"].combine_chunks() if isinstance(t["unit"], pa.ChunkedArray) else t["unit"]
            out = []
            for lo, hi in zip(begin, np.append(begin[1:], len(ids))):
                for rows in _by_length(units.slice(lo, hi - lo)):
                    x, at = _matrix(units.take(pa.array(rows + lo))), rows + lo
                    linked = x @ x.T >= threshold
                    np.fill_diagonal(linked, False)
                    if a[lo] != b[lo]:  # pairs within one block are counted where it meets itself
                        linked &= block[at][:, None] != block[at][None, :]
                    root = ids[at].copy()
                    while True:
                        least = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(1))
                        if (least == root).all():
                            break
                        root = least
                    out.append((ids[at], linked @ copies[at], root))
            if out:
                i, n, r = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(n), pa.array(r)], names=["id", "n", "root"])

    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(group, total)`` of the unit vectors ``(group, unit)`` that a task has."""
    held: dict[int, np.ndarray] = {}

    def sent() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([x.tobytes() for x in held.values()], pa.binary())], names=["group", "total"])

    for b in batches:
        groups = b.column(0).to_numpy()
        for g in np.unique(groups):
            total = _matrix(b.column(1).take(pa.array(np.flatnonzero(groups == g)))).sum(0)
            held[int(g)] = held[int(g)] + total if int(g) in held else total
        if len(held) >= SUMS:
            yield sent()
            held.clear()
    if held:
        yield sent()


def _total(key: tuple, sums: pa.Table) -> pa.Table:
    return pa.table({"group": pa.array([key[0].as_py()], pa.int64()), "total": pa.array([_matrix(sums["total"].combine_chunks()).sum(0).tobytes()], pa.binary())})


def _cores(threshold: float):
    """Whether a member ``(id, unit, total)`` is so near to its group's centre that it is linked with all that are as near."""
    half = (np.arccos(threshold) - 1e-6) / 2  # rounding stays far below this

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            core = np.zeros(len(b), bool)
            for rows in _by_length(b.column(1)):
                x, c = (_matrix(b.column(k).take(pa.array(rows))) for k in (1, 2))
                core[rows] = (x * c).sum(1) > np.cos(half) * np.sqrt((c * c).sum(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(core)], names=["id", "core"])

    return run


def _links(groups: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """``(id, n, root)`` parts of exact links, from all members of each of the groups ``(id, component)``.

    Members of one group meet in blocks, but not the core with itself: two vectors that are both within half of the
    threshold's angle from the group's centre are linked, so the links of a core are its size, counted without a pair.
    """
    sizes = settle(groups.groupBy("component").agg(F.count("*").alias("size")))
    members = groups.join(sizes, "component").select("id", F.col("component").alias("group"), (F.col("size") > BLOCK_ROWS).alias("many"))
    members = settle(members.join(classes.select("id", "unit", "copies"), "id"))
    large = members.where("many").select("id", "group", "unit")
    centres = settle(large.select("group", "unit").mapInArrow(_sums, "group long, total binary").groupBy("group").applyInArrow(_total, "group long, total binary"))
    cores = settle(large.join(centres, "group").select("id", "unit", "total").mapInArrow(_cores(threshold), "id long, core boolean").where("core").select("id"))
    members = members.join(cores.withColumn("core", F.lit(True)), "id", "left").withColumn("core", F.coalesce("core", F.lit(False)))
    of_core = F.when(F.col("core"), F.col("copies")).otherwise(0)
    facts = members.groupBy("group").agg(
        F.ceil(F.count_if(~F.col("core")) / BLOCK_ROWS).alias("outer"), F.ceil(F.count_if("core") / BLOCK_ROWS).alias("inner"),
        F.sum(of_core).alias("total"), F.min(F.when(F.col("core"), F.col("id"))).alias("first"))
    members = settle(members.join(settle(facts), "group"))
    # blocks of the core are numbered after the others
    block = F.when(F.col("core"), F.col("outer") + F.pmod(F.xxhash64("id"), F.col("inner"))).otherwise(F.pmod(F.xxhash64("id"), F.col("outer")))
    meets = F.when(F.col("core"), F.col("outer")).otherwise(F.col("outer") + F.col("inner"))
    rows = members.where(meets > 0).select("*", block.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), meets - 1)).alias("other"))
    rows = rows.select("group", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "id", "copies", "unit")
    rows = rows.repartition("group", "a", "b").sortWithinPartitions("group", "a", "b")
    met = rows.mapInArrow(_count_links(threshold), "id long, n long, root long")
    within = members.where("core").select("id", (F.col("total") - F.col("copies")).alias("n"), F.col("first").alias("root"))
    return settle(met.union(within))


def _audit(sample, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, units = sample.value
        size = np.array([len(u) for u in units])
        step = max(1, CELLS // max(1, len(ids)))
        for b in batches:
            mine, copies = b.column(0).to_numpy(), b.column(2).to_numpy()
            for rows in _by_length(b.column(1)):
                same = np.flatnonzero(size == b.column(1)[rows[0]].as_buffer().size)
                if not len(same):
                    continue
                s, n = np.stack([np.frombuffer(units[i], np.float64) for i in same]), np.zeros(len(same), np.int64)
                # a batch against the whole sample is too much to hold
                for part in np.split(rows, range(step, len(rows), step)):
                    linked = (s @ _matrix(b.column(1).take(pa.array(part))).T >= threshold) & (ids[same][:, None] != mine[part][None, :])
                    a, k = np.nonzero(linked)
                    np.add.at(n, a, copies[part][k])
                yield pa.RecordBatch.from_arrays([pa.array(ids[same][n > 0]), pa.array(n[n > 0])], names=["id", "n"])

    return run


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.95, size: int = 12, trees: int = 4, rounds: int = 6, settled: float = 0.0, recall: float = 0.99, sample: int = 2048,
    longer: int = 3, seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``(id, n_links, component, kept, recall)`` for every row of ``vectors``.

    Rows are linked if their cosine, in doubles, is at least ``threshold``. A null or zero vector, one with null or non-finite components, and
    one of another length link with nothing. Equal directions are one vertex that counts as many rows as it has, so repeated rows link with each other. ``component`` is the
    smallest id reachable, ``kept`` whether it is the row's own; a null id is never the smallest (``component`` null if no
    row there has an id), and is not kept. All links returned are exact; links may be missed, and ``recall`` is the share of their links that
    was found for the vectors of a sample, ``sample`` of them taken by hash and compared with all, on average over those that have links. Lists of ``size`` and the
    ``rounds`` double up to ``longer`` times while it is below ``recall``; an error ends the job if it still is then. Other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)[id_col]
    rows = settle(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(_normalised, f"id {kind}, unit binary"))
    classes = rows.where("unit is not null").groupBy("unit").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    classes = settle(classes.withColumn("id", F.monotonically_increasing_id()))
    near = threshold - MARGIN
    small, graph = _start(classes.withColumn("group", F.col("id")), trees, size, near, seed)
    # ids are chosen first: every task sends its own smallest, and they are small
    ids = [r["id"] for r in classes.select("id").orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample).collect()]
    picked = sorted(classes.where(F.col("id").isin(ids)).select("id", "unit").collect()) if ids else []
    sent = spark.sparkContext.broadcast((np.array([r["id"] for r in picked], np.int64), [bytes(r["unit"]) for r in picked]))
    truth = {r["id"]: r["n"] for r in classes.select("id", "unit", "copies").mapInArrow(_audit(sent, threshold), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()}
    for k in range(longer + 1):
        if k:
            # longer lists, all of whose entries meet again, and leaves of other hyperplanes
            _, more = _start(classes.withColumn("group", F.col("id")), trees, size << k, near, seed + k)
            entries = ("id", "to", "sim", F.lit(True).alias("fresh"))
            graph = settle(_top(graph.select(*entries).union(more.select(*entries)), size << k, near))
        graph = _descend(graph, small, size << k, near, rounds << k, settled)
        parts_found = _links(_across(graph, classes, small, size << k, near, trees, seed + k), classes, threshold)
        counts = settle(parts_found.groupBy("id").agg(F.sum("n").alias("n")))
        got = {r["id"]: r["n"] for r in counts.where(F.col("id").isin(list(truth)) & (F.col("n") > 0)).collect()} if truth else {}
        # of each sampled vector by itself: a large group can't hide what is missing elsewhere
        reached = sum(got.get(i, 0) / n for i, n in truth.items()) / len(truth) if truth else 1.0
        if reached >= recall:
            break
    else:
        raise RuntimeError(f"links of the sampled vectors found: {reached:.4f}, less than {recall}; longer lists, more trees or rounds are needed")
    found = components(parts_found.select(F.col("id").alias("src"), F.col("root").alias("dst")))
    grouped = settle(classes.select("id", "least", "copies").join(settle(found), "id", "left").withColumn("component", F.coalesce("component", "id")))
    least = settle(grouped.groupBy("component").agg(F.min("least").alias("smallest")))
    named = settle(grouped.join(least, "component").select("id", "smallest"))
    facts = classes.select("id", "unit", "copies").join(named, "id").join(counts, "id", "left")
    facts = settle(facts.select(F.col("unit"), (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("links"), "smallest"))
    out = rows.where("unit is not null").join(facts, "unit").select("id", F.col("links").alias("n_links"), F.col("smallest").alias("component"))
    out = out.union(rows.where("unit is null").select("id", F.lit(0).cast("long"), "id"))
    return out.select("id", "n_links", "component", F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"), F.lit(float(reached)).alias("recall"))
