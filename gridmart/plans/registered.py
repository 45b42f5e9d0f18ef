"""The named queries: every operator and question, run on the trade tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import blank_null_tokens
from ..functions.results import lap_time_ms
from ..operators.keys import first_rows
from ..operators.profile import QUARTILES, profile_columns, sample_rows
from ..schemas import (
    DIM_CIRCUIT, DIM_CONSTRUCTOR, DIM_DATE, DIM_DRIVER, DIM_RACE, DIM_STATUS,
    FACT_RACE_RESULT, LOAD_ORDER, TableSpec,
)
from ..sources import trade_tables as trade
from ..sources.text import ORDER
from . import analytics, quality
from .annotate import (
    REASON, SOURCE_KEY, accepted, accepted_keys, accepted_rows, annotate, annotate_dimension, annotate_fact, cast_report,
    date_dimension, observed_outcomes, outcome_counts, outcomes_of, race_lookup, rejected, typed_results, typed_rows,
)
from .star import Star

Query = Callable[[SparkSession, str], DataFrame]


class _Tables:
    """Source rows of the trade tables under the load rules.

    ``incomplete`` leaves some parents out of the dimensions (drivers in debt, constructors
    above 20, African circuits, Sundays) and takes circuits and dates from some races, so that
    results without a parent exist.
    """

    def __init__(self, spark: SparkSession, folder: str, flawed: bool = False, incomplete: bool = False):
        self.spark, self.folder, self.flawed, self.incomplete = spark, folder, flawed, incomplete

    def _keep(self, rows: DataFrame, condition: Column) -> DataFrame:
        return rows.where(condition) if self.incomplete else rows

    def raw(self, spec: TableSpec) -> DataFrame:
        if spec is FACT_RACE_RESULT:
            return trade.raw_results(self.spark, self.folder, self.flawed)
        if spec is DIM_RACE:
            return trade.raw_races(self.spark, self.folder, self.incomplete)
        read = {
            DIM_DRIVER.name: trade.raw_drivers, DIM_CONSTRUCTOR.name: trade.raw_constructors,
            DIM_CIRCUIT.name: trade.raw_circuits, DIM_STATUS.name: trade.raw_status,
        }[spec.name]
        rows = read(self.spark, self.folder)
        if spec is DIM_DRIVER:
            rows = self._keep(rows, F.col("url") != "N/A")
        if spec is DIM_CONSTRUCTOR:
            rows = self._keep(rows, F.col("constructorId").cast("int") <= 20)
        if spec is DIM_CIRCUIT:
            rows = self._keep(rows, F.col("country") != "AFRICA")
        return rows

    def typed(self, spec: TableSpec) -> DataFrame:
        return typed_rows(self.raw(spec), spec)

    def results(self) -> DataFrame:
        return typed_results(self.raw(FACT_RACE_RESULT))

    def _parents(self, spec: TableSpec) -> dict[str, DataFrame]:
        return {DIM_CIRCUIT.name: self.keys(DIM_CIRCUIT)} if spec is DIM_RACE else {}

    def dimension(self, spec: TableSpec) -> DataFrame:
        """A dimension with the verdict of each source row."""
        return annotate_dimension(self.typed(spec), spec, self._parents(spec))

    def accepted(self, spec: TableSpec) -> DataFrame:
        return accepted_rows(self.typed(spec), spec, self._parents(spec))

    def dates(self) -> DataFrame:
        raw = trade.raw_races(self.spark, self.folder, self.incomplete, with_circuit=False)
        return self._keep(date_dimension(typed_rows(raw, DIM_RACE)), F.col("weekday_name") != "Domingo")

    def keys(self, spec: TableSpec) -> DataFrame:
        return accepted_keys(typed_rows(self.raw(spec), spec.only_required()), spec, self._parents(spec))

    def _fact_parents(self) -> tuple[DataFrame, dict[str, DataFrame | Column]]:
        races = race_lookup(self.typed(DIM_RACE), self.keys(DIM_CIRCUIT))
        # The dates are those of the very races that the lookup holds.
        weekday = F.dayofweek(F.to_date(F.col("date_id").cast("string"), "yyyyMMdd"))
        known_date = weekday != 1 if self.incomplete else F.lit(True)
        parents = {DIM_DRIVER.name: self.keys(DIM_DRIVER), DIM_CONSTRUCTOR.name: self.keys(DIM_CONSTRUCTOR),
                   DIM_DATE.name: F.col("date_id").isNotNull() & known_date}
        return races, parents

    def fact(self, broken: bool = True) -> DataFrame:
        """The fact with the verdict of each source row."""
        races, parents = self._fact_parents()
        return annotate_fact(self.results(), races, parents, broken)


class _KeptTables(_Tables):
    """The same rules on the columns that decide about a row, read and typed once and kept on the
    executors for all tables that need them (a lost executor's rows are read again)."""

    def __init__(self, *args, **options):
        super().__init__(*args, **options)
        self._kept: dict[str, DataFrame] = {}

    def typed(self, spec: TableSpec) -> DataFrame:
        if spec.name not in self._kept:
            deciding = replace(spec, fields=tuple(f for f in spec.fields if f.name in (*spec.required, "date")))
            self._kept[spec.name] = typed_rows(self.raw(spec), deciding).persist(StorageLevel.MEMORY_AND_DISK)
        return self._kept[spec.name]

    def keys(self, spec: TableSpec) -> DataFrame:
        return accepted_keys(self.typed(spec), spec, self._parents(spec))

    def dates(self) -> DataFrame:
        return self._keep(date_dimension(self.typed(DIM_RACE)), F.col("weekday_name") != "Domingo")

    def verdicts(self, spec: TableSpec) -> DataFrame:
        """One row per source row: why it is rejected, or NULL."""
        if spec is DIM_DATE:
            return self.dates().select(F.lit(None).cast("string").alias(REASON))
        if spec is not FACT_RACE_RESULT:
            return annotate(self.typed(spec), spec, self._parents(spec)).select(REASON)
        races, parents = self._fact_parents()
        return annotate(self.typed(spec), spec, parents, races).select(REASON)

    def forget(self) -> None:
        for rows in self._kept.values():
            rows.unpersist()


def _dimension(spec: TableSpec) -> Query:
    return lambda spark, folder: _Tables(spark, folder).accepted(spec)


def _null_token_clean(spark: SparkSession, folder: str) -> DataFrame:
    return blank_null_tokens(trade.raw_results(spark, folder, flawed=True)).drop(ORDER)


def _typed_cast_report(spark: SparkSession, folder: str) -> DataFrame:
    tables = _Tables(spark, folder, flawed=True)
    report = cast_report(tables.raw(FACT_RACE_RESULT), FACT_RACE_RESULT)
    for spec in (DIM_DRIVER, DIM_CONSTRUCTOR, DIM_CIRCUIT, DIM_RACE):
        report = report.unionByName(cast_report(tables.raw(spec), spec))
    return report


def _critical_null_filter(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["race_id", "driver_id", "constructor_id"]
    return _Tables(spark, folder, flawed=True).results().dropna(subset=keys).select(*keys, "points")


def _dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return _Tables(spark, folder).dates()


def _fact_lookup_left(spark: SparkSession, folder: str) -> DataFrame:
    """Results with the circuit and date of their race, where orders in progress are no races."""
    tables = _Tables(spark, folder)
    started = trade.raw_races(spark, folder).where("state <> 'P'")
    races = race_lookup(typed_rows(started, DIM_RACE), tables.keys(DIM_CIRCUIT))
    return tables.results().join(races, "race_id", "left").select(
        "race_id", "driver_id", "circuit_id", "date_id")


def _fact_race_result(spark: SparkSession, folder: str) -> DataFrame:
    return accepted(_Tables(spark, folder).fact(broken=False), FACT_RACE_RESULT)


def _lap_time_to_ms(spark: SparkSession, folder: str) -> DataFrame:
    raw = trade.raw_results(spark, folder, with_constructor=False)
    return raw.select("raceId", "driverId", "fastestLapTime", lap_time_ms(F.col("fastestLapTime")).alias("best_lap_ms"))


def _pk_dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    items = trade.read(spark, folder, "lineitem")
    return first_rows(items, ["l_orderkey", "l_suppkey"], trade.RESULT_ORDER).select(
        "l_orderkey", "l_suppkey", *trade.RESULT_ORDER)


def _pk_rejects(spark: SparkSession, folder: str) -> DataFrame:
    rows = rejected(_Tables(spark, folder).fact(broken=False)).where(F.col(REASON) == "duplicate_key")
    return rows.select("race_id", "driver_id", "constructor_id", "finish_pos", "grid_pos", REASON)


def _fk_validate(spark: SparkSession, folder: str) -> DataFrame:
    """Results per outcome when some parents are missing."""
    return outcome_counts(_Tables(spark, folder, incomplete=True).fact(), FACT_RACE_RESULT.name)


def _fk_rejects(spark: SparkSession, folder: str) -> DataFrame:
    rows = rejected(_Tables(spark, folder, flawed=True, incomplete=True).fact())
    return rows.where(F.col(REASON) != "duplicate_key").select(
        "race_id", "driver_id", "constructor_id", "circuit_id", "date_id", SOURCE_KEY, REASON)


def _load_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per table and outcome, observed while the verdicts pass by, as in a load."""
    tables = _KeptTables(spark, folder, flawed=True, incomplete=True)
    lines = []
    try:
        for spec in LOAD_ORDER:
            rows, observation = observed_outcomes(tables.verdicts(spec), spec)
            rows.write.format("noop").mode("overwrite").save()
            lines += [(spec.name, outcome, n) for outcome, n in outcomes_of(observation).items() if outcome != "extracted"]
    finally:
        tables.forget()
    return spark.createDataFrame(lines, "table_name string, outcome string, n_rows long")


def _incomplete_star(spark: SparkSession, folder: str) -> Star:
    """The fact of the whole star with dimensions that lack some rows."""
    star = trade.trade_star(spark, folder)
    in_debt = trade.read(spark, folder, "supplier").where("s_acctbal < 0")
    kept = {
        "dim_driver": lambda rows: rows.join(in_debt, F.col("driver_id") == F.col("s_suppkey"), "left_anti"),
        "dim_constructor": lambda rows: rows.where("constructor_id <= 20"),
        "dim_circuit": lambda rows: rows.where("country <> 'AFRICA'"),
        "dim_date": lambda rows: rows.where("weekday_name <> 'Domingo'"),
    }
    dimensions = {
        name: (lambda columns, name=name: kept[name](star.dimensions[name](columns))) for name in kept
    }
    dimensions["dim_race"] = star.dimensions["dim_race"]
    return Star(dimensions, star.fact_columns)


def _orphan_checks(spark: SparkSession, folder: str) -> DataFrame:
    return quality.orphan_checks(_incomplete_star(spark, folder))


def _integrity_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.integrity_report(_incomplete_star(spark, folder))


def _race_circuit_orphans(spark: SparkSession, folder: str) -> DataFrame:
    star = trade.trade_star(spark, folder)
    circuits = star.dim("dim_circuit", "circuit_id", "country").where("country <> 'AFRICA'")
    return quality.race_circuit_orphans(star.dim("dim_race", "race_id", "circuit_id"), circuits)


def _profile_table(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = blank_null_tokens(trade.raw_results(spark, folder)).drop(ORDER)
    profile = profile_columns(cleaned, exact=True)
    return profile.withColumns({name: F.round(name, 4) for name in ("avg", "stddev", *QUARTILES)})


def _profile_sample(spark: SparkSession, folder: str) -> DataFrame:
    """The first rows of the cleaned drivers, as the profile shows them."""
    cleaned = blank_null_tokens(trade.raw_drivers(spark, folder)).drop(ORDER)
    return sample_rows(cleaned, 5, F.col("driverId").cast("long"))


def _pit_trend(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.pit_trend(trade.trade_star(spark, folder), trade.trade_pit_stops(spark, folder))


def _driver_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.driver_by_year(trade.trade_star(spark, folder), "Supplier 000000007")


def _driver_by_year_weekends(spark: SparkSession, folder: str) -> DataFrame:
    """Results on weekends of the years 1995 to 1997."""
    when = F.col("is_weekend") & F.col("year").between(1995, 1997)
    return analytics.driver_by_year(trade.trade_star(spark, folder), when=when)


def _on_star(question: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, folder: question(trade.trade_star(spark, folder))


QUERIES: dict[str, Query] = {
    "null_token_clean": _null_token_clean,
    "typed_cast_report": _typed_cast_report,
    "critical_null_filter": _critical_null_filter,
    "dim_driver": _dimension(DIM_DRIVER),
    "dim_constructor": _dimension(DIM_CONSTRUCTOR),
    "dim_circuit": _dimension(DIM_CIRCUIT),
    "dim_date": _dim_date,
    "dim_race": _dimension(DIM_RACE),
    "dim_status": _dimension(DIM_STATUS),
    "fact_lookup_left": _fact_lookup_left,
    "fact_race_result": _fact_race_result,
    "lap_time_to_ms": _lap_time_to_ms,
    "pk_dedup_first": _pk_dedup_first,
    "pk_rejects": _pk_rejects,
    "fk_validate": _fk_validate,
    "fk_rejects": _fk_rejects,
    "load_report": _load_report,
    "table_counts": _on_star(quality.table_counts),
    "orphan_checks": _orphan_checks,
    "race_circuit_orphans": _race_circuit_orphans,
    "integrity_report": _integrity_report,
    "quality_metrics": _on_star(quality.quality_metrics),
    "flag_coherence": _on_star(quality.flag_coherence),
    "profile_table": _profile_table,
    "profile_sample": _profile_sample,
    "star_denormalized": _on_star(quality.star_denormalized),
    "top_drivers": _on_star(analytics.top_drivers),
    "driver_by_year": _driver_by_year,
    "driver_by_year_weekends": _driver_by_year_weekends,
    "driver_by_year_all": _on_star(analytics.driver_by_year),
    "pole_to_win_pct": _on_star(analytics.pole_to_win_pct),
    "q01_champions": _on_star(analytics.champions),
    "q02_decade_dominance": _on_star(analytics.decade_dominance),
    "q03_year_winners": _on_star(analytics.year_winners),
    "q05_top_poles": _on_star(analytics.top_poles),
    "q06_circuit_drivers": _on_star(analytics.circuit_drivers),
    "q08_pole_conversion": _on_star(analytics.pole_conversion),
    "q09_points_per_race": _on_star(analytics.points_per_race),
    "q10_one_two": _on_star(analytics.one_two),
    "q11_circuit_teams": _on_star(analytics.circuit_teams),
    "q12_pit_trend": _pit_trend,
    "q13_season_form": _on_star(analytics.season_form),
    "q14_outside_top_k": _on_star(analytics.outside_top_k),
}
