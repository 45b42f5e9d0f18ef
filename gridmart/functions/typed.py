"""Text cells to declared types, never failing: a bad value is NULL and reported."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import Field
from .dates import iso_date
from .results import lap_time_ms

_TIME_OF_DAY = r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d$"


def whole_number(text: Column, target: str) -> Column:
    """Integer text, or integer text written as a float ('44.0'), which no cast takes as it is."""
    without_zeros = F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))
    return F.when(text.contains("."), without_zeros).otherwise(text).try_cast(target)


def typed_value(text: Column, field: Field) -> Column:
    """The cell in the declared type; NULL when malformed or out of range; long text is cut.

    Clear null tokens first: they are frequent, and a failed parse costs far more than the
    comparison.
    """
    if field.kind in ("int", "long"):
        return whole_number(text, "bigint" if field.kind == "long" else "int")
    if field.kind == "date":
        return iso_date(text)
    if field.kind == "lap":
        return lap_time_ms(text)
    if field.kind == "time":
        return F.when(text.rlike(_TIME_OF_DAY), text)
    if field.kind == "text":
        return F.substring(text, 1, field.length) if field.length else text
    return text.try_cast(field.kind)


def is_lost(text: Column, value: Column) -> Column:
    """The cell had a value, but not one of its type."""
    return value.isNull() & text.isNotNull()


def issue_of(text: Column, value: Column, field: Field) -> tuple[str, Column] | None:
    """What can go wrong with a cell of this field, and whether it did."""
    if field.kind != "text":
        return "nulled", is_lost(text, value)
    if field.length:
        return "cut", F.length(text) > field.length
    return None


def collect_issues(issues: dict[str, tuple[str, Column]]) -> Column:
    """All issues of a row as an array of 'column:action', NULL when there are none."""
    if not issues:
        return F.lit(None).cast("array<string>")
    labels = [F.when(found, F.lit(f"{name}:{action}")) for name, (action, found) in issues.items()]
    # concat_ws skips NULLs inside generated code; array_compact would not.
    joined = F.concat_ws(" ", *labels)
    return F.when(joined != "", F.split(joined, " "))
