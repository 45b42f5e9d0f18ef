"""The full load into a folder of Parquet tables, and reading it back.

Each load writes a new run folder and becomes visible only when every table and check has
passed, by creating the file of the next version. Nothing that readers see is overwritten.

    <warehouse>/runs/<run id>/staging/<table>/     typed source rows, in file order
    <warehouse>/runs/<run id>/tables/<table>/outcome=accepted|rejected/[year=...]/
    <warehouse>/published/v<version>.json          run id and rows per table and outcome
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import year_of_key
from ..functions.typed import typed_value
from ..schemas import (
    DIM_CIRCUIT, DIM_CONSTRUCTOR, DIM_DATE, DIM_DRIVER, DIM_RACE, DIM_STATUS,
    FACT_RACE_RESULT, PIT_STOP_FIELDS, SPECS, TableSpec,
)
from ..sources.text import BAD_LINE, ORDER, read_text_table
from .annotate import (
    ISSUES, REASON, SOURCE_KEY, annotate_dimension, annotate_fact, date_dimension, issue_counts,
    observed_outcomes, outcome_counts, outcomes_of, race_lookup, typed_results, typed_rows,
)
from .published import entry, latest, publish, versions
from .quality import integrity_report
from .star import Star

OUTCOME, ACCEPTED, REJECTED = "outcome", "accepted", "rejected"

_VERDICT = T.StructType([
    T.StructField(REASON, T.StringType()),
    T.StructField(ISSUES, T.ArrayType(T.StringType())),
    T.StructField(SOURCE_KEY, T.StringType()),
    T.StructField(BAD_LINE, T.StringType()),
    T.StructField(ORDER, T.StructType([
        T.StructField("file", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("row", T.LongType()),
    ])),
])


class LoadFailed(RuntimeError):
    """A check on the written tables failed; the run was not published."""


def _folders(spec: TableSpec) -> list[str]:
    return [OUTCOME, *spec.partition_by]


def _stored_schema(spec: TableSpec) -> T.StructType:
    """Declared, so that a table without any row can be read too."""
    folders = [T.StructField(OUTCOME, T.StringType())]
    folders += [T.StructField(name, T.IntegerType()) for name in spec.partition_by]
    return T.StructType([*spec.schema.fields, *_VERDICT.fields, *folders])


@dataclass(frozen=True)
class Run:
    """Tables of one load run."""

    spark: SparkSession
    path: str
    #: Rows per table and outcome, as counted by the jobs that wrote them.
    counts: dict[str, dict[str, int]] = field(default_factory=dict, compare=False)

    @property
    def run_id(self) -> str:
        return self.path.rstrip("/").rsplit("/", 1)[-1]

    def accepted_path(self, name: str) -> str:
        return f"{self.path}/tables/{name}/{OUTCOME}={ACCEPTED}"

    def annotated(self, name: str) -> DataFrame:
        """Accepted and rejected rows with their verdict."""
        return self.spark.read.schema(_stored_schema(SPECS[name])).parquet(f"{self.path}/tables/{name}")

    def table(self, name: str) -> DataFrame:
        """Accepted rows; only their folder is read."""
        spec = SPECS[name]
        return self.annotated(name).where(F.col(OUTCOME) == ACCEPTED).select(*spec.columns, *spec.partition_by)

    def rejects(self, name: str) -> DataFrame:
        return self.annotated(name).where(F.col(OUTCOME) == REJECTED).drop(OUTCOME)

    def keys(self, name: str) -> DataFrame:
        return self.table(name).select(*SPECS[name].key)

    def star(self) -> Star:
        dims = [s.name for s in SPECS.values() if s is not FACT_RACE_RESULT]
        return Star(
            {name: (lambda columns, name=name: self.table(name)) for name in dims},
            lambda columns: self.table(FACT_RACE_RESULT.name),
            self._countable,
        )

    def _countable(self, name: str) -> DataFrame:
        """Accepted rows by the reader that counts from footers, where the load has noted any."""
        if not self.counts.get(name, {}).get("accepted"):
            return self.table(name)
        with _settings(self.spark, {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text"}):
            return self.spark.read.schema(SPECS[name].schema).parquet(self.accepted_path(name))

    def observed_report(self) -> DataFrame:
        """Rows per table and outcome, from the counts of the load: no table is read."""
        lines = [(name, outcome, n) for name, found in self.counts.items() for outcome, n in found.items()]
        return self.spark.createDataFrame(lines, "table_name string, outcome string, n_rows long")

    def load_report(self, *names: str) -> DataFrame:
        """Rows per table and outcome."""
        return _stacked([outcome_counts(self.annotated(name), name) for name in names])

    def issue_report(self, *names: str) -> DataFrame:
        """Cells nulled or cut, per table and column."""
        return _stacked([issue_counts(self.annotated(name), name) for name in names])


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for the plans made inside the block."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _stacked(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def _stage(typed: DataFrame, run: Run, name: str, buckets: int | None = None) -> DataFrame:
    """Write typed source rows once and read them back.

    The key rules read these rows twice. A written copy is parsed once, is pruned to the key
    columns the first time, and fixes each row's place in its file, which a second scan of
    text files could number differently when the cluster has grown in between.

    With ``buckets`` the copy is dealt into files by race, which the catalog knows: joins and key rules
    on the race then read it as it lies. ``rebalance`` deals rows like the buckets, so that a task
    writes few of them, but splits a race that holds many rows.
    """
    path = f"{run.path}/staging/{name}"
    if not buckets:
        typed.write.mode("errorifexists").parquet(path)
        return run.spark.read.schema(typed.schema).parquet(path)
    table = _bucket_table(run, name)
    (
        typed.hint("rebalance", buckets, "race_id").write.mode("errorifexists")
        .bucketBy(buckets, "race_id").sortBy("race_id").option("path", path).saveAsTable(table)
    )
    return run.spark.table(table)


def _bucket_table(run: Run, name: str) -> str:
    return f"staged_{name}_{run.run_id}"


def _write(frame: DataFrame, spec: TableSpec, run: Run) -> None:
    """Write accepted and rejected rows in one job, in well-sized files, and note how many there are.

    ``rebalance`` groups rows by output folder, so that tasks do not each write a small file
    per folder, and splits the folders that hold many rows. The sort inside the tasks extends
    the one that a write into folders needs anyway.
    """
    is_rejected = F.col(REASON).isNotNull()
    frame = frame.withColumns({
        OUTCOME: F.when(is_rejected, F.lit(REJECTED)).otherwise(F.lit(ACCEPTED)),
        # Only a rejected row has to be found again in its file.
        ORDER: F.when(is_rejected, F.col(ORDER)),
    })
    if "year" in spec.partition_by:
        frame = frame.withColumn("year", year_of_key(F.col("date_id")))
    folders = _folders(spec)
    counted, observation = observed_outcomes(frame.hint("rebalance", *folders), spec)
    (
        counted.sortWithinPartitions(*folders, *spec.sort_by)
        .write.mode("errorifexists").partitionBy(*folders).parquet(f"{run.path}/tables/{spec.name}")
    )
    run.counts[spec.name] = outcomes_of(observation)


def _without_verdict(frame: DataFrame) -> DataFrame:
    """Generated rows: accepted, with no source row behind them."""
    return frame.withColumns({f.name: F.lit(None).cast(f.dataType) for f in _VERDICT.fields})


def check(run: Run) -> None:
    """Raise when a check on the written tables fails."""
    failed = integrity_report(run.star()).where("not passed").collect()
    if failed:
        raise LoadFailed(f"{FACT_RACE_RESULT.name}: {failed}")


def load(spark: SparkSession, source: str, warehouse: str, with_status: bool = False,
         multiline: bool = False, race_buckets: int | None = None) -> Run:
    """Read the source files, write all tables, check them, publish the run.

    Dimensions are written first: the fact's key checks read the written keys, whose known
    size lets Spark choose between a broadcast and a shuffled join. ``multiline`` allows line
    breaks inside quotes, at the price that a file is read by one task.

    ``race_buckets`` stages races and results in so many buckets by race. The race join and the key rule
    of the fact then need no shuffle, but a bucket is read by one task: leave it out where single races
    hold a large share of the results.

    Of loads that ran at the same time one is published; the others end with
    :class:`~gridmart.plans.published.PublishConflict`. Their runs are complete, can be opened by id, and
    can be published later with :func:`publish_run`.
    """
    after = max(versions(spark, warehouse), default=0)
    run = Run(spark, f"{warehouse}/runs/{uuid.uuid4().hex}")

    def raw(name: str) -> DataFrame:
        return read_text_table(spark, f"{source}/{name}.csv", multiline, keep_tokens=True)

    def staged(name: str, spec: TableSpec, buckets: int | None = None) -> DataFrame:
        return _stage(typed_rows(raw(name), spec), run, name, buckets)

    plain = [(DIM_DRIVER, "drivers"), (DIM_CONSTRUCTOR, "constructors"), (DIM_CIRCUIT, "circuits")]
    if with_status:
        plain.append((DIM_STATUS, "status"))
    for spec, name in plain:
        _write(annotate_dimension(staged(name, spec), spec), spec, run)
    try:
        races = staged("races", DIM_RACE, race_buckets)
        _write(_without_verdict(date_dimension(races)), DIM_DATE, run)
        circuits = run.keys(DIM_CIRCUIT.name)
        _write(annotate_dimension(races, DIM_RACE, {DIM_CIRCUIT.name: circuits}), DIM_RACE, run)

        results = _stage(typed_results(raw("results")), run, "results", race_buckets)
        _write_fact(results, races, run, bool(race_buckets))
    finally:
        if race_buckets:
            for name in ("races", "results"):
                spark.sql(f"DROP TABLE IF EXISTS {_bucket_table(run, name)}")

    check(run)
    publish(spark, warehouse, run.run_id, after, {"counts": run.counts})
    return run


def fact_rows(results: DataFrame, races: DataFrame, run: Run) -> DataFrame:
    """Staged results with their verdict, checked against the dimensions that the run has written."""
    parents = {name: run.keys(name) for name in (DIM_DRIVER.name, DIM_CONSTRUCTOR.name, DIM_DATE.name)}
    return annotate_fact(results, race_lookup(races, run.keys(DIM_CIRCUIT.name)), parents)


#: Rows that lie together by race are together by race and driver too.
BY_RACE = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def _write_fact(results: DataFrame, races: DataFrame, run: Run, by_race: bool) -> None:
    with _settings(run.spark, BY_RACE if by_race else {}):
        _write(fact_rows(results, races, run), FACT_RACE_RESULT, run)


def publish_run(run: Run, warehouse: str) -> int:
    """Publish a complete run as the newest version, over whatever is there; its number."""
    check(run)
    after = max(versions(run.spark, warehouse), default=0)
    return publish(run.spark, warehouse, run.run_id, after, {"counts": run.counts})


def read_pit_stops(spark: SparkSession, path: str) -> DataFrame:
    """Typed pit stops, which no table of the star holds; a malformed line has no values."""
    rows = read_text_table(spark, path)
    sound = F.col(BAD_LINE).isNull()
    return rows.select(
        *[F.when(sound, typed_value(F.col(f.source), f)).alias(f.name) for f in PIT_STOP_FIELDS], BAD_LINE)


def open_warehouse(spark: SparkSession, warehouse: str, version: int | None = None, run_id: str | None = None) -> Run:
    """The run published last, that of a version, or any complete run by its id."""
    if run_id is not None:
        return Run(spark, f"{warehouse}/runs/{run_id}")
    found = latest(spark, warehouse) if version is None else entry(spark, warehouse, version)
    if found is None:
        raise FileNotFoundError(f"nothing is published in {warehouse}")
    return Run(spark, f"{warehouse}/runs/{found['run_id']}", found["counts"])
