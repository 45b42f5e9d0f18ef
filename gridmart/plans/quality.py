"""Checks on a loaded star."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookups import orphan_counts
from ..schemas import FACT_RACE_RESULT, LOAD_ORDER
from .star import Star


def table_counts(star: Star) -> DataFrame:
    """Rows of the five dimensions and the fact."""
    counts = None
    for spec in LOAD_ORDER:
        if star.countable is not None:
            rows = star.countable(spec.name)
        else:
            rows = star.fact("race_id") if spec is FACT_RACE_RESULT else star.dim(spec.name, *spec.key)
        line = rows.agg(F.count("*").alias("n_rows")).select(F.lit(spec.name).alias("table_name"), "n_rows")
        counts = line if counts is None else counts.unionByName(line)
    return counts


def orphan_checks(star: Star) -> DataFrame:
    """Fact rows without a parent, one line per foreign key; all must be 0."""
    fks = FACT_RACE_RESULT.foreign_keys
    fact = star.fact(*[fk.column for fk in fks])
    parents = {fk.parent: star.dim(fk.parent, fk.column) for fk in fks}
    lines = orphan_counts(fact, [(fk.column, fk.parent) for fk in fks], parents)
    return lines.select("check", "orphans", (F.col("orphans") == 0).alias("passed"))


def race_circuit_orphans(races: DataFrame, circuits: DataFrame) -> DataFrame:
    """Races whose circuit is unknown, counted before the load."""
    return (
        races.join(circuits.select("circuit_id"), "circuit_id", "left_anti")
        .agg(F.count("*").alias("orphans"))
    )


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def quality_metrics(star: Star) -> DataFrame:
    """Totals of the fact and its flags, in one pass."""
    fact = star.fact("is_win", "is_podium", "is_pole", "is_scoring", "is_finished")
    return fact.agg(
        F.count("*").alias("total"),
        _count(F.col("is_win")).alias("wins"),
        _count(F.col("is_podium")).alias("podiums"),
        _count(F.col("is_pole")).alias("poles"),
        _count(F.col("is_scoring")).alias("scoring"),
        _count(F.col("is_finished")).alias("finished"),
    )


def flag_coherence(star: Star) -> DataFrame:
    """Wins that are not podiums; must be 0."""
    fact = star.fact("is_win", "is_podium")
    return fact.agg(_count(F.col("is_win") & ~F.col("is_podium")).alias("wins_without_podium"))


#: What a fact row's flags count for, by the bit that holds each flag.
_FLAGS = ("is_win", "is_podium", "is_pole", "is_scoring", "is_finished")


def integrity_report(star: Star) -> DataFrame:
    """Everything that is checked after a load, from one scan of the fact and one of each dimension:
    rows of the six tables, orphans of the five foreign keys, totals of the flags, and wins that are no
    podiums. ``passed`` is NULL where there is nothing to pass.

    A fact row is taken as six (table, key) pairs: its foreign keys, and its flags as one number. They
    are counted inside the tasks, so that the flags are 32 lines at most and a hot key is one line per
    task; the join to the dimensions' keys then runs on unique keys on both sides.
    """
    fks, fact_name = FACT_RACE_RESULT.foreign_keys, FACT_RACE_RESULT.name
    fact = star.fact(*[fk.column for fk in fks], *_FLAGS)
    bits = F.lit(0).cast("long")
    for i, flag in enumerate(_FLAGS):
        bits = bits + F.col(flag).cast("long") * (1 << i)
    pairs = [F.struct(F.lit(fk.parent).alias("name"), F.col(fk.column).cast("long").alias("key")) for fk in fks]
    pairs.append(F.struct(F.lit(fact_name).alias("name"), bits.alias("key")))
    counts = fact.select(F.inline(F.array(*pairs))).groupBy("name", "key").agg(F.count("*").alias("n"))
    known = None
    for fk in fks:
        keys = star.dim(fk.parent, fk.column).select(F.lit(fk.parent).alias("name"), F.col(fk.column).cast("long").alias("key"))
        known = keys if known is None else known.unionByName(keys)
    both = counts.join(known.withColumn("found", F.lit(1).cast("long")), ["name", "key"], "full_outer")

    def total(amount: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(amount))), F.lit(0)).cast("long")

    def flagged(*flags: str, without: str | None = None) -> Column:
        on = F.col("name") == fact_name
        for flag in flags:
            on = on & (F.expr(f"key & {1 << _FLAGS.index(flag)}") != 0)
        return on & (F.expr(f"key & {1 << _FLAGS.index(without)}") == 0) if without else on

    lines = [("rows", spec.name, total("found", F.col("name") == spec.name)) for spec in LOAD_ORDER[:-1]]
    lines.append(("rows", fact_name, total("n", flagged())))
    lines += [("orphans", fk.parent, total("n", (F.col("name") == fk.parent) & F.col("found").isNull())) for fk in fks]
    lines += [("flags", flag, total("n", flagged(flag))) for flag in _FLAGS]
    lines.append(("coherence", "wins_without_podium", total("n", flagged("is_win", without="is_podium"))))
    totals = both.agg(*[amount.alias(f"_{i}") for i, (_, _, amount) in enumerate(lines)])
    must_be_none = ("orphans", "coherence")
    return totals.select(F.inline(F.array(*[
        F.struct(
            F.lit(section).alias("section"), F.lit(name).alias("name"), F.col(f"_{i}").alias("n_rows"),
            (F.col(f"_{i}") == 0 if section in must_be_none else F.lit(None).cast("boolean")).alias("passed"))
        for i, (section, name, _) in enumerate(lines)
    ])))


def star_denormalized(star: Star) -> DataFrame:
    """The fact with the names of all its dimensions."""
    driver = star.dim("dim_driver", "driver_id", "full_name").withColumnRenamed("full_name", "driver_name")
    constructor = star.dim("dim_constructor", "constructor_id", "name").withColumnRenamed("name", "constructor_name")
    circuit = star.dim("dim_circuit", "circuit_id", "name", "country").withColumnRenamed("name", "circuit_name")
    race = star.dim("dim_race", "race_id", "name", "round").withColumnRenamed("name", "race_name")
    date = star.dim("dim_date", "date_id", "date", "decade", "weekday_name")
    fact = star.fact(
        "race_id", "driver_id", "constructor_id", "circuit_id", "date_id",
        "points", "finish_pos", "grid_pos", "is_win",
    )
    return (
        fact.join(driver, "driver_id").join(constructor, "constructor_id")
        .join(circuit, "circuit_id").join(race, "race_id").join(date, "date_id")
    )
