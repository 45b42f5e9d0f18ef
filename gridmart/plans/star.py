"""A loaded star: five dimensions and the fact, wherever they live."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame


Columns = tuple[str, ...]


@dataclass(frozen=True)
class Star:
    """Access to the star's tables by name and wanted columns.

    The wanted columns are passed on, so that a source that derives a table joins only what
    those columns need; a written table is simply pruned.
    """

    dimensions: Mapping[str, Callable[[Columns], DataFrame]]
    fact_columns: Callable[[Columns], DataFrame]
    #: Rows of a table for counting only, where a source has a cheaper way to them.
    countable: Callable[[str], DataFrame] | None = None

    def dim(self, name: str, *columns: str) -> DataFrame:
        return self.dimensions[name](columns).select(*columns)

    def fact(self, *columns: str) -> DataFrame:
        """The fact's named columns; ``year`` (of the race date) is always available."""
        return self.fact_columns(columns).select(*columns)
