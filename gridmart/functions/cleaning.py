"""Null tokens of the delimited sources."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Whole-cell, case-sensitive texts that mean "no value".
NULL_TOKENS = (
    "\\N", "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


_TOKEN_LIST = ", ".join(f"r'{token}'" for token in NULL_TOKENS)


def null_if_token(name: str) -> Column:
    """NULL when the whole cell is a null token, otherwise the cell unchanged."""
    # As SQL text: one call to the JVM per column instead of one per token.
    return F.expr(f"CASE WHEN `{name}` NOT IN ({_TOKEN_LIST}) THEN `{name}` END")


def null_if_nan(number: Column) -> Column:
    """NULL for NaN; only needed for floating-point inputs that did not come from text."""
    return F.when(~F.isnan(number), number)


def blank_null_tokens(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Apply :func:`null_if_token` to the named columns (default: every text column)."""
    names = list(columns) if columns is not None else [n for n, t in df.dtypes if t == "string"]
    return df.withColumns({name: null_if_token(name) for name in names})
