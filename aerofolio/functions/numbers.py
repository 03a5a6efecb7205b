"""Number expressions. Sums of doubles depend on the order in which tasks finish; these go
through decimals, so a re-run after a lost executor gives the same digits."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Range and scale of the exact part of a sum: 16 digits before the point and 12 after it.
EXACT = "decimal(28,12)"


def exact(value: Column, kind: str = EXACT) -> Column:
    """``value`` as a decimal; null where ``kind`` can't hold it or would lose a small value's digits."""
    held = value.cast("double")
    scale = int(kind.rstrip(")").split(",")[1])
    fits = (held == 0) | (F.abs(held) >= F.lit(10.0 ** (6 - scale)))
    return F.when(fits, held.try_cast(kind))


def inexact(value: Column, kind: str = EXACT) -> Column:
    """``value`` where ``exact`` doesn't hold it: NaN, infinite, very large and very small ones."""
    held = value.cast("double")
    return F.when(held.isNotNull() & exact(value, kind).isNull(), held)


def total(decimals: Column, doubles: Column) -> Column:
    """A sum as a double, out of the sums of its exact and its inexact part; null if both are."""
    return F.coalesce(decimals.cast("double") + doubles, decimals.cast("double"), doubles)


def exact_sum(value: Column, kind: str = EXACT) -> Column:
    """Sum of a column of doubles, the same whatever the order of rows.

    Values that ``kind`` can't hold are added as doubles, so a NaN or an infinity gives what it gives in any
    sum, and only these values' last digits can depend on the order. Null over no values.
    """
    return total(F.sum(exact(value, kind)), F.sum(inexact(value, kind)))


def exact_mean(value: Column, kind: str = EXACT) -> Column:
    """Mean over the values that aren't null; all of these are both summed and counted."""
    return exact_sum(value, kind) / F.count(value)
