"""Parent lookups as joins, with orphans kept and counted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def mark_parent(df: DataFrame, parent_keys: DataFrame | Column, column: str, marker: str) -> DataFrame:
    """Add a boolean: does ``column`` exist in the (unique) one-column ``parent_keys``?

    Where the parent is made from the very rows that refer to it, ``parent_keys`` may be the
    condition under which it holds a row; that needs no join.
    """
    if isinstance(parent_keys, Column):
        return df.withColumn(marker, F.coalesce(parent_keys, F.lit(False)))
    keys = parent_keys.toDF("_parent_key").withColumn(marker, F.lit(True))
    joined = df.join(keys, df[column] == keys["_parent_key"], "left").drop("_parent_key")
    return joined.withColumn(marker, F.coalesce(F.col(marker), F.lit(False)))


def orphan_counts(child: DataFrame, checks: Sequence[tuple[str, str]],
                  parents: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of ``child`` without a parent, per check (column, parent table), in one pass.

    Rows are counted per (check, key) first, so hot keys shrink to one row per task before
    any shuffle, and the join to the parents runs on unique keys.
    """
    names = [name for _, name in checks]
    pairs = [
        F.struct(F.lit(name).alias("check"), F.col(column).cast("long").alias("key"))
        for column, name in checks
    ]
    key_counts = (
        child.select(F.explode(F.array(*pairs)).alias("pair"))
        .groupBy("pair.check", "pair.key").agg(F.count("*").alias("n"))
    )
    known = None
    for name in names:
        keys = parents[name].toDF("key").select(F.lit(name).alias("check"), F.col("key").cast("long"))
        known = keys if known is None else known.unionByName(keys)
    found = known.withColumn("found", F.lit(True))
    orphan = key_counts.join(found, ["check", "key"], "left").where(F.col("found").isNull())
    # A global aggregate, so that a check without any orphan still reports 0.
    totals = orphan.agg(*[
        F.coalesce(F.sum(F.when(F.col("check") == name, F.col("n"))), F.lit(0)).alias(name)
        for name in names
    ])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check"), F.col(name).cast("long").alias("orphans"))
        for name in names
    ])))
