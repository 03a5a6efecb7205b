"""Exact ordered computations that never put one whole group into one task.

Spark runs a window over ``partitionBy(key)`` in one task per key. Here a key may hold a third
of all rows, so rows are cut into slices of the order of (keys, order columns): a large key spans many slices, each slice is
windowed on its own, and at most one row per slice carries a state on to the next.

A row's slice is a function of its own values and some bounds, sampled once; so nothing need be written to keep it,
a task that runs again finds the same slice, and the only exchange of whole rows is the window's own. The
input is read for its size, for the sample, for the carried states (keys, order and value only) and for
the result: settle it first if it is costly to compute.

Order columns are names, followed by `` desc`` where the order descends. Nulls come first, or last where it descends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import settle

SLICE = "_slice"
#: Sampled rows for each slice.
SAMPLED = 50


def match(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` (null keys match), keeping the left names only."""
    other = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return left.join(other, cond, how).drop(*[f"_r_{k}" for k in keys])


def with_carry(part: DataFrame, carry: DataFrame, keys: list[str], state: str) -> DataFrame:
    """Join to each slice's rows the state its key brings from earlier slices; null where there is none.

    Slices follow each other in key order, so only a slice's first key can
    come from an earlier slice: what is joined has at most one row per slice,
    however many keys there are, and is broadcast on that ground. The rows
    themselves do not move again.
    """
    return match(part, F.broadcast(carry.where(F.col(state).isNotNull())), [*keys, SLICE])


def _parts(order: list[str]) -> list[tuple[str, bool]]:
    return [(o.removesuffix(" desc"), o.endswith(" desc")) for o in order]


def _sorting(order: list[str]) -> list[Column]:
    return [F.desc(c) if down else F.asc(c) for c, down in _parts(order)]


def _reached(bound: Column, by: list[tuple[str, bool]]) -> Column:
    """Whether the row stands at or after ``bound``."""
    out = F.lit(True)
    for i, (c, down) in reversed(list(enumerate(by))):
        at, row = bound[f"c{i}"], F.col(c)
        if down:
            before = F.coalesce(at > row, at.isNotNull() & row.isNull())
        else:
            before = F.coalesce(at < row, at.isNull() & row.isNotNull())
        out = before | (at.eqNullSafe(row) & out)
    return out


def sliced(df: DataFrame, keys: list[str], order: list[str], slices: int | None = None) -> DataFrame:
    """Rows with the number of their slice of the order of (keys, order); about equally many rows in each.

    Bounds come from a sample of a fixed size for each slice, and are part of the expression. Equal rows fall
    into one slice.
    """
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [(k, False) for k in keys] + _parts(order)
    narrow = df.select(*[c for c, _ in by])
    n = narrow.count() if slices > 1 else 0
    if n < 2:
        return df.withColumn(SLICE, F.lit(0))
    sample = narrow.sample(min(1.0, SAMPLED * slices / n), seed=1).orderBy(*_sorting([*keys, *order])).collect()
    rows = list(dict.fromkeys(tuple(sample[i * len(sample) // slices]) for i in range(1, slices))) if sample else []
    if not rows:
        return df.withColumn(SLICE, F.lit(0))
    kinds = [narrow.schema[c].dataType for c, _ in by]
    bounds = F.array(*[F.struct(*[F.lit(v).cast(t).alias(f"c{i}") for i, (v, t) in enumerate(zip(r, kinds))]) for r in rows])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(rows).bit_length()))])

    def advance(at: Column, step: Column) -> Column:
        # a binary search: go on by the step if the bound there is reached
        ahead = (at + step <= len(rows)) & _reached(F.get(bounds, at + step - 1), by)
        return F.when(ahead, at + step).otherwise(at)

    return df.withColumn(SLICE, F.aggregate(steps, F.lit(0), advance))


def running_sum(
    df: DataFrame, keys: list[str], order: list[str], value: str, name: str, slices: int | None = None
) -> DataFrame:
    """Adds ``name``: sum of ``value`` over the rows of the key up to and including this one.

    The order must be total within a key.
    """
    cut = sliced(df, keys, order, slices)
    before = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    # one row per (key, slice): the state reached before that slice
    carry = (
        cut.groupBy(*keys, SLICE)
        .agg(F.sum(value).alias("_n"))
        .withColumn("_before", F.sum("_n").over(before))
        .drop("_n")
    )
    inside = W.partitionBy(*keys, SLICE).orderBy(*_sorting(order)).rowsBetween(W.unboundedPreceding, 0)
    part = cut.withColumn("_inside", F.sum(value).over(inside))
    out = with_carry(part, carry, keys, "_before")
    total = F.col("_inside") + F.coalesce("_before", F.lit(0))
    return out.withColumn(name, total).drop("_inside", "_before", SLICE)


def row_numbers(
    df: DataFrame, keys: list[str], order: list[str], name: str, slices: int | None = None
) -> DataFrame:
    """``row_number`` over a total order."""
    ones = df.withColumn("_one", F.lit(1).cast("long"))
    return running_sum(ones, keys, order, "_one", name, slices).drop("_one")


def ranks(
    df: DataFrame,
    keys: list[str],
    by: str,
    descending: bool = False,
    rank: str | None = "rank",
    dense: str | None = None,
) -> DataFrame:
    """``rank`` and ``dense_rank`` of ``by`` within ``keys``.

    Ties are counted before anything is ordered, so a value shared by many
    rows travels as one row; the ranks are then joined back to the rows.
    The rows are settled first, as what they come from, an aggregation often,
    would else run once for the levels and once more for the join.
    """
    df = settle(df)
    levels = settle(df.groupBy(*keys, by).agg(F.count("*").alias("_rows")).withColumn("_one", F.lit(1).cast("long")))
    order = [f"{by} desc" if descending else by]
    cut = sliced(levels, keys, order)
    before = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    steps = cut.groupBy(*keys, SLICE).agg(F.sum("_rows").alias("_n"), F.count("*").alias("_d"))
    carry = steps.select(
        *keys,
        SLICE,
        F.sum("_n").over(before).alias("_n_before"),
        F.sum("_d").over(before).alias("_d_before"),
    )
    inside = W.partitionBy(*keys, SLICE).orderBy(*_sorting(order)).rowsBetween(W.unboundedPreceding, 0)
    part = cut.withColumn("_n_in", F.sum("_rows").over(inside)).withColumn("_d_in", F.sum("_one").over(inside))
    placed = with_carry(part, carry, keys, "_n_before")
    cols = []
    if rank:
        cols.append((F.coalesce("_n_before", F.lit(0)) + F.col("_n_in") - F.col("_rows") + 1).alias(rank))
    if dense:
        cols.append((F.coalesce("_d_before", F.lit(0)) + F.col("_d_in")).alias(dense))
    return match(df, placed.select(*keys, by, *cols), [*keys, by])


def fill_forward(
    df: DataFrame, keys: list[str], order: list[str], value: str, name: str, slices: int | None = None
) -> DataFrame:
    """Adds ``name``: the last non-null ``value`` of the key at or above this row; the order is ascending.

    What is carried into a slice is where the last value before it stands, not the value; the value, which may be
    of any size, is then joined from the slices' last values by a join that Catalyst plans by their size.
    """
    if any(down for _, down in _parts(order)):
        raise ValueError("filled in ascending order only")
    cut = sliced(df, keys, order, slices)
    inside = W.partitionBy(*keys, SLICE).orderBy(*_sorting(order)).rowsBetween(W.unboundedPreceding, 0)
    part = cut.withColumn("_inside", F.last(value, ignorenulls=True).over(inside))
    known = cut.where(F.col(value).isNotNull())
    before = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    held = cut.groupBy(*keys, SLICE).agg(F.max(F.when(F.col(value).isNotNull(), F.col(SLICE))).alias("_own"))
    # of a slice's first key at most: the slice its last value is from
    carry = held.withColumn("_from", F.last("_own", ignorenulls=True).over(before)).drop("_own")
    place = F.struct(*[F.col(o) for o in order])
    needed = carry.where("_from is not null").select(*keys, F.col("_from").alias(SLICE)).distinct()
    last = match(known.groupBy(*keys, SLICE).agg(F.max_by(value, place).alias("_before")), needed, [*keys, SLICE], "left_semi")
    out = with_carry(part, carry, keys, "_from")
    # rows that need nothing get a slice that none has, spread so that they don't meet in one task
    nowhere = -1 - F.pmod(F.xxhash64(*[o for o in order]), F.lit(1 << 20)).cast("int")
    out = out.withColumn("_from", F.coalesce(F.when(F.col("_inside").isNull(), F.col("_from")), nowhere))
    out = match(out, last.withColumnRenamed(SLICE, "_from"), [*keys, "_from"])
    return out.withColumn(name, F.coalesce("_inside", "_before")).drop("_inside", "_before", "_from", SLICE)


def quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact quantiles by linear interpolation, one column per entry of ``probs``.

    Equal values are counted first; a key is never gathered in one task. A
    key without values gets nulls.
    """
    # a null value counts for nothing, but its row keeps the key
    counted = settle(df.groupBy(*keys, value).agg(F.count(value).alias("_rows")))
    placed = running_sum(counted, keys, [value], "_rows", "_upto")
    total = placed.groupBy(*keys).agg(F.max("_upto").alias("_total"))
    spots = match(placed, total, keys, "inner")
    first, last = F.col("_upto") - F.col("_rows"), F.col("_upto") - 1
    aggregates = []
    for name, p in probs.items():
        at = (F.col("_total") - 1) * F.lit(p)
        for side, spot in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            hit = F.when((first <= spot) & (spot <= last), F.col(value))
            aggregates.append(F.max(hit).alias(f"_{name}_{side}"))
    found = spots.groupBy(*keys).agg(F.max("_total").alias("_total"), *aggregates)
    out = []
    for name, p in probs.items():
        at = (F.col("_total") - 1) * F.lit(p)
        part = at - F.floor(at)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * part).alias(name))
    return found.select(*keys, *out)


def latest(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """The whole row with the greatest ``by`` per key, as a mergeable aggregate (no sort, no window)."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.max_by(row, F.struct(*by)).alias("_row")).select("_row.*")
