"""Primary-key rules: one row per key, the first one wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_rows(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key by ``order``.

    ``row_number() = 1`` lets Spark drop all but one row per key in each task before the
    shuffle, so a key that holds a large share of the rows sends one row per task.
    """
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def repeated_keys(df: DataFrame, key: Sequence[str], order: str, first: str) -> DataFrame:
    """Keys that more than one row has, each with the order of its first row.

    Counts and minima are partial aggregates: a key that holds a large share of the rows
    sends one row per task, and keys that are not repeated end here.
    """
    counts = df.groupBy(*key).agg(F.count("*").alias("_n"), F.min(order).alias(first))
    return counts.where("_n > 1").drop("_n")


def mark_first(df: DataFrame, candidates: DataFrame, key: Sequence[str], order: str, marker: str) -> DataFrame:
    """Add a boolean: is no candidate of the row's key before it?

    ``candidates`` has the key and order of the rows that compete; ``order`` must be unique
    per row. Rows meet only the list of repeated keys, which is short in sound data: Spark
    can broadcast it, or split a hot key of the rows in a join of two shuffles.
    """
    names = [f"_repeated_{name}" for name in key]
    repeated = repeated_keys(candidates, key, order, "_first").toDF(*names, "_first")
    same = [df[name] == repeated[other] for name, other in zip(key, names)]
    marked = df.join(repeated, same, "left")
    return marked.withColumn(marker, F.col("_first").isNull() | (F.col(order) <= F.col("_first"))).drop(*names, "_first")
