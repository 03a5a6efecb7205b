"""Deadline status."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAY, HOUR = 86_400_000, 3_600_000
# Days from which the light is green or orange, and the closing text.
GREEN, ORANGE = 60, 30
PASSED = "Reporting deadline has passed."


def deadline_status(due: Column, now: Column) -> Column:
    """Struct of light, all_red and label for a deadline seen from ``now``."""
    left = F.unix_millis(due.cast("timestamp")) - F.unix_millis(now.cast("timestamp"))
    days, hours = F.floor(left / DAY), F.floor((left % DAY) / HOUR)
    passed = left <= 0
    light = (
        F.when(passed, F.lit("red"))
        .when(days >= GREEN, F.lit("green"))
        .when(days >= ORANGE, F.lit("orange"))
        .otherwise(F.lit("red"))
    )
    label = F.when(passed, F.lit(PASSED)).otherwise(
        F.concat(days.cast("string"), F.lit(" days and "), hours.cast("string"), F.lit(" hours"))
    )
    return F.struct(light.alias("light"), passed.alias("all_red"), label.alias("label"))
