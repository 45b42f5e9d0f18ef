"""Expressions on race results: names, flags, lap times, ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FINISHED_STATUS = 1
PODIUM_PLACES = 3


def full_name(first: Column, last: Column) -> Column:
    """NULL when either part is missing (so not concat_ws)."""
    return F.concat(first, F.lit(" "), last)


def definitely(condition: Column) -> Column:
    """Two-valued condition: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def result_flags(finish: Column, grid: Column, points: Column, status: Column) -> dict[str, Column]:
    return {
        "is_win": definitely(finish == 1),
        "is_podium": definitely(finish <= PODIUM_PLACES),
        "is_pole": definitely(grid == 1),
        "is_scoring": definitely(points > 0),
        "is_finished": definitely(status == FINISHED_STATUS),
    }


def lap_time_ms(text: Column) -> Column:
    """'2:41.007' to 161007; NULL when the text is not minutes:seconds."""
    parts = F.split(text, ":")
    minutes = F.get(parts, F.lit(0)).try_cast("long")
    seconds = F.get(parts, F.lit(1)).try_cast("decimal(8,3)")
    valid = (F.size(parts) == 2) & (minutes >= 0) & (seconds >= 0) & (seconds < 60)
    # Minutes beyond the range of a long are as malformed as letters.
    return F.when(valid, F.try_add(F.try_multiply(minutes, F.lit(60000)), (seconds * 1000).cast("long")))


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole as double; NULL when the whole is 0."""
    return F.try_divide(part.cast("double") * 100.0, whole.cast("double"))


def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))
