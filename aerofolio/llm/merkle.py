"""A manifest of a table as Merkle trees, and proofs of all its rows by octopus multiproofs.

Rows of a key are the leaves of its tree, eight children to a node; the roots of the keys are the leaves of one more tree.
Leaves are dealt in blocks of 4,096 that stand below one node. A block knows all nodes below that one; the union of what
the proofs of its rows need besides is the brothers of that node and of those above it. A block asks for these once, by
coordinate, whole runs of brothers at a time, works out the nodes that its rows share, and expands the single proofs by itself.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..operators.ordered import row_numbers
from ..session import settle

#: Children of a node as a power of two, and blocks that ask one copy of a run.
BITS, ASKING = 3, 512
#: Levels of the tree over the keys stand above all levels of a key.
ABOVE = 1000


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` leaves until one node is left."""
    h = 0
    while n > 1:
        n, h = -(-n >> BITS), h + 1
    return h


def _height(n: Column) -> Column:
    """As ``height``: eight to the power of it is the first that isn't below ``n``."""
    steps = F.sequence(F.lit(0), F.lit(20))
    return F.aggregate(steps, F.lit(0), lambda h, k: F.when(F.call_function("shiftleft", F.lit(1).cast("long"), k * BITS) < n, k + 1).otherwise(h))


def climb(nodes: list[str], levels: int) -> list[list[str]]:
    """``nodes`` and the levels above them, ``levels`` of them; runs of eight, the last one of fewer."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([digest("".join(below[i : i + (1 << BITS)])) for i in range(0, len(below), 1 << BITS)])
    return out


def _field(value: Column, text: bool = True) -> Column:
    value = value if text else value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaves(docs: DataFrame, id_col: str = "doc_id", key_col: str = "lang") -> DataFrame:
    """``id, key, leaf, changed``: of each row the digest, and, where the row is tampered with, that of what it became."""
    ident = F.col(id_col)
    tampered = F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 3 == 0, F.lit(False))
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def leaf(text: Column) -> Column:
        parts = [_field(ident, False), _field(F.col("source").cast("string")), _field(F.col("lang").cast("string")), _field(F.col("n_chars"), False), _field(text)]
        return F.sha2(F.concat(*parts), 256)

    # the empty key is the null one, which stands before all others
    key = F.when(F.col(key_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(key_col).cast("string")))
    return docs.select(ident.alias("id"), key.alias("key"), leaf(F.col("text")).alias("leaf"), F.when(tampered, leaf(lowered)).alias("changed"))


def _block_nodes(tall: int):
    """Nodes of one group of neighbours that stand below one node ``tall`` levels up, as far as their tree goes."""

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group.column("idx").to_pylist(), group.column("digest").to_pylist()))
        key, n, level = (group.column(c)[0].as_py() for c in ("key", "n", "level"))
        out = []
        for k, nodes in enumerate(climb([d for _, d in rows], min(tall, height(n) - level))):
            first = rows[0][0] >> (BITS * k)
            out += [(key, n, level + k, first + i, d) for i, d in enumerate(nodes)] if k else []
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string()))], names=NODE.names)

    return run


NODE = T.StructType([T.StructField("key", T.StringType()), T.StructField("n", T.LongType()), T.StructField("level", T.IntegerType()), T.StructField("idx", T.LongType()), T.StructField("digest", T.StringType())])


def _upper(rows: DataFrame, base: int, tall: int) -> DataFrame:
    """Nodes ``key, n, level, idx, digest`` from level ``base`` to the roots. ``rows``: ``key, n, pos, leaf``, every leaf.

    ``tall`` levels at a time: with four, the rows that a round reads are a 4,096th of those that the one before read.
    """
    most = rows.agg(F.max("n")).first()[0] or 0
    at = rows.select("key", "n", F.lit(0).alias("level"), F.col("pos").alias("idx"), F.col("leaf").alias("digest"))
    found, level = at.where(F.lit(base == 0)), 0
    while True:
        if level >= height(most):
            # trees that end below the base keep their root for the tree above
            break
        new = settle(at.groupBy("key", F.shiftright("idx", BITS * tall).alias("block")).applyInArrow(_block_nodes(tall), NODE))
        found = found.unionByName(new.where((F.col("level") >= base) | (F.col("level") == _height(F.col("n")))))
        level += tall
        at = new.where(F.col("level") == level)
    return found


def _copies(covered: Column) -> Column:
    """Copies of a run that so many blocks ask for, so that none is asked by more than ``ASKING``."""
    return F.greatest(F.lit(1), F.ceil(covered / F.lit(ASKING)).cast("long"))


def _runs(nodes: DataFrame) -> DataFrame:
    """Runs of brothers: ``key, level, parent, run``."""
    return nodes.groupBy("key", "n", "level", F.shiftright("idx", BITS).alias("parent")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))), lambda x: x["digest"]).alias("run"))


def _fetched(units: DataFrame, nodes: DataFrame, base: int) -> DataFrame:
    """The nodes that units lack: of ``key, unit, n`` the runs ``level, run, own`` on each level from ``base`` to below the root.

    A unit is a node of level ``base``. What it lacks is one run a level, with its own ancestor in place ``own``. Runs high up are asked
    by many units; they stand in as many copies as their level asks for, and a unit asks one of them.
    """
    level, unit = F.col("level"), F.col("unit")
    there = F.shiftright(F.col("n") - 1, BITS * base) + 1
    covered = F.least(F.expr(f"shiftleft(1L, {BITS} * (level + 1 - {base}))"), there)
    # the last level above which there is nothing is the root's own
    asked = units.select("key", "unit", "n", F.explode(F.filter(F.sequence(F.lit(base), F.lit(20)), lambda k: k < _height(F.col("n")))).alias("level"))
    asked = asked.withColumn("place", F.expr(f"shiftright(unit, {BITS} * (level - {base}))")).withColumn("parent", F.shiftright("place", BITS))
    asked = asked.withColumn("copy", F.pmod(unit, _copies(covered)))
    offered = _runs(nodes.where((level >= base) & (level < _height(F.col("n"))))).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), _copies(covered) - 1))).drop("n")
    return asked.join(offered, ["key", "level", "parent", "copy"]).select("key", "unit", "level", "run", F.col("place").bitwiseAND((1 << BITS) - 1).cast("int").alias("own"))


def _expand(tall: int):
    """All proofs of a block from its leaves and the fetched runs."""

    def run(rows: pa.Table, outside: pa.Table) -> pa.Table:
        got = sorted(zip(rows.column("pos").to_pylist(), rows.column("id").to_pylist(), rows.column("leaf").to_pylist(), rows.column("changed").to_pylist()), key=lambda r: r[0])
        inner = climb([r[2] for r in got], min(tall, height(rows.column("n")[0].as_py())))
        fetched = sorted(zip(outside.column("level").to_pylist(), outside.column("run").to_pylist(), outside.column("own").to_pylist()))
        sides = [(level, "".join(run[:own]), "".join(run[own + 1 :])) for level, run, own in fetched]
        subroot = inner[-1][0]
        for _, left, right in (s for s in sides if s[0] < ABOVE):
            subroot = digest(left + subroot + right)
        root = subroot
        for _, left, right in (s for s in sides if s[0] >= ABOVE):
            root = digest(left + root + right)
        tail, out = "".join(left + right for _, left, right in sides).encode(), []
        for i, (_, ident, leaf, changed) in enumerate(got):
            proof, now = sha256(), changed or leaf
            for k, nodes in enumerate(inner[:-1]):
                place = i >> (BITS * k)
                first = place >> BITS << BITS
                left, right = "".join(nodes[first:place]), "".join(nodes[place + 1 : first + (1 << BITS)])
                proof.update((left + right).encode())
                now = digest(left + now + right)
            proof.update(tail)
            for _, left, right in sides:
                now = digest(left + now + right)
            out.append((ident, leaf, subroot, root, proof.hexdigest(), now, now == root))
        kinds = [rows.schema.field("id").type, *[pa.string()] * 5, pa.bool_()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=RESULT)

    return run


RESULT = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def manifest(docs: DataFrame, id_col: str = "doc_id", key_col: str = "lang", tall: int = 4) -> DataFrame:
    """Of every row its leaf, the roots above it, the digest of its proof, and the root that the proof gives for the row as it is now.

    Leaves of a key stand in order of id, nulls first, and of leaf among equal ids; rows equal in all fields have equal leaves, and
    which comes first makes no difference. Nulls are fields of their own; a null key comes before all others. A row with a null id is never tampered with.
    Other columns are left alone. An empty table gives no rows. A block has ``8 ** tall`` leaves.
    """
    found = settle(leaves(docs, id_col, key_col))
    placed = row_numbers(found, ["key"], ["id", "leaf"], "nr").withColumn("pos", F.col("nr") - 1).drop("nr")
    placed = settle(placed.withColumn("block", F.shiftright("pos", BITS * tall)))
    sizes = settle(placed.groupBy("key").agg(F.count("*").alias("n")))
    blocks = settle(placed.groupBy("key", F.col("block").alias("unit")).agg(F.count("*").alias("rows")).join(sizes, "key"))
    # a block's own rows count the leaves of its key: the join is by block, so no key is hot
    rows = placed.join(blocks.select("key", F.col("unit").alias("block"), "n"), ["key", "block"])
    nodes = settle(_upper(rows, tall, tall))
    lone = rows.where("n = 1").select("key", F.col("leaf").alias("digest"))
    roots = nodes.where(F.col("level") == _height(F.col("n"))).select("key", "digest").unionByName(lone)
    top = settle(row_numbers(settle(roots), [], ["key"], "nr").select("key", "digest", (F.col("nr") - 1).alias("pos")))
    keys = top.count()
    over = top.select(F.lit("").alias("key"), F.lit(keys).cast("long").alias("n"), "pos", F.col("digest").alias("leaf"))
    ways = _fetched(top.select(F.lit("").alias("key"), F.col("pos").alias("unit"), F.lit(keys).cast("long").alias("n")), _upper(over, 0, tall), 0)
    ways = ways.join(top.select(F.col("pos").alias("unit"), F.col("key").alias("of")), "unit").groupBy("of").agg(F.collect_list(F.struct((F.col("level") + ABOVE).alias("level"), "run", "own")).alias("way"))
    # the way from a key's root to the top is asked by all its blocks: again in copies
    there = F.shiftright(F.col("n") - 1, BITS * tall) + 1
    offered = ways.join(sizes.withColumnRenamed("key", "of"), "of").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), _copies(there) - 1))).select(F.col("of").alias("key"), "copy", "way")
    above = blocks.withColumn("copy", F.pmod("unit", _copies(there))).join(offered, ["key", "copy"]).select("key", "unit", F.inline("way"))
    outside = _fetched(blocks, nodes, tall).unionByName(above.select("key", "unit", "level", "run", "own"))
    kind = T.StructType([T.StructField(c, found.schema["id"].dataType if c == "id" else T.BooleanType() if c == "verified" else T.StringType()) for c in RESULT])
    left = rows.select("key", F.col("block").alias("unit"), "n", "pos", "id", "leaf", "changed").groupBy("key", "unit")
    proved = left.cogroup(outside.groupBy("key", "unit")).applyInArrow(_expand(tall), kind)
    return proved.withColumnRenamed("id", id_col)
