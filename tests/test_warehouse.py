"""What a load leaves behind: counts, versions, catalog tables, and the plans that read them."""

import json
import subprocess
import sys
import textwrap
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_load import FILES, write_files

from gridmart.plans import analytics, quality
from gridmart.plans.annotate import reject_reasons
from gridmart.plans.catalog import catalog_star, create_tables
from gridmart.plans.published import PublishConflict, entry, latest, publish, versions
from gridmart.plans.warehouse import BY_RACE, _settings, _stage, fact_rows, load, open_warehouse, publish_run
from gridmart.schemas import FACT_RACE_RESULT, LOAD_ORDER, SPECS

ROOT = Path(__file__).resolve().parent.parent


def plan_of(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture(scope="module")
def warehouse(tmp_path_factory):
    return tmp_path_factory.mktemp("warehouse")


@pytest.fixture(scope="module")
def run(spark, warehouse):
    return load(spark, write_files(warehouse / "source"), str(warehouse / "w"), with_status=True)


# ---- counts ----------------------------------------------------------------------------


def by_outcome(frame):
    return {(r.table_name, r.outcome): r.n_rows for r in frame.collect()}


def test_observed_counts_are_those_of_the_tables(run):
    names = [*[s.name for s in LOAD_ORDER], "dim_status"]
    observed = by_outcome(run.observed_report())
    extracted = {name: n for (name, outcome), n in observed.items() if outcome == "extracted"}
    assert {k: n for k, n in observed.items() if k[1] != "extracted"} == by_outcome(run.load_report(*names))
    assert extracted["fact_race_result"] == 17 and extracted["dim_driver"] == 8
    for name in names:
        assert sum(n for (table, outcome), n in observed.items() if table == name and outcome != "extracted") == extracted[name]


def test_the_report_reads_no_table(run):
    assert "FileScan" not in plan_of(run.observed_report()) and "Scan parquet" not in plan_of(run.observed_report())


def test_every_reason_is_counted(run):
    for spec in SPECS.values():
        found = {r.reject_reason for r in run.rejects(spec.name).select("reject_reason").distinct().collect()}
        assert found <= set(reject_reasons(spec))


def test_counts_of_an_empty_source(spark, tmp_path):
    files = {name: text.splitlines()[0] + "\n" for name, text in FILES.items()}
    empty = load(spark, write_files(tmp_path / "source", files), str(tmp_path / "w"))
    assert {name: found["extracted"] for name, found in empty.counts.items()} == {s.name: 0 for s in LOAD_ORDER}
    assert {r.n_rows for r in quality.table_counts(empty.star()).collect()} == {0}
    assert all(r.n_rows == 0 and r.passed is not False for r in quality.integrity_report(empty.star()).collect())


def test_a_task_that_is_tried_again_counts_once(tmp_path):
    """In a session of its own, because this one gives up after a task's first failure."""
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {str(ROOT)!r})
        from pyspark import TaskContext
        from pyspark.sql import functions as F
        from gridmart.plans.annotate import observed_outcomes, outcomes_of
        from gridmart.schemas import DIM_DRIVER
        from gridmart.session import build_session
        spark = build_session("again", "local[4,3]", 4)
        spark.sparkContext.setLogLevel("OFF")
        def flaky(batches):
            for batch in batches:
                yield batch
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("first try")
        rows = spark.range(1000).selectExpr("id", "if(id % 10 = 0, 'bad_key', null) as reject_reason")
        rows = rows.repartition(4).mapInArrow(flaky, rows.schema)
        counted, observation = observed_outcomes(rows, DIM_DRIVER)
        counted.write.parquet({str(tmp_path / "out")!r})
        print("counts", outcomes_of(observation))
    """)
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    assert "counts {'extracted': 1000, 'accepted': 900, 'bad_key': 100}" in done.stdout, done.stderr[-2000:]


# ---- versions --------------------------------------------------------------------------


def test_of_two_loads_at_once_one_is_published(spark, tmp_path):
    source, warehouse = write_files(tmp_path / "source"), str(tmp_path / "w")

    def one(_):
        try:
            return load(spark, source, warehouse), None
        except PublishConflict as conflict:
            return None, conflict

    with ThreadPoolExecutor(2) as both:
        results = list(both.map(one, range(2)))
    winners = [run for run, _ in results if run]
    assert len(winners) == 1 and versions(spark, warehouse) == [1]
    assert open_warehouse(spark, warehouse) == winners[0]
    # The other run is complete: it can be read by its id, and published over the winner.
    ids = {p.name for p in (tmp_path / "w" / "runs").iterdir()}
    other = open_warehouse(spark, warehouse, run_id=(ids - {winners[0].run_id}).pop())
    for spec in LOAD_ORDER:
        assert sorted(map(str, other.table(spec.name).collect())) == sorted(map(str, winners[0].table(spec.name).collect()))
    assert publish_run(other, warehouse) == 2
    assert open_warehouse(spark, warehouse) == other and open_warehouse(spark, warehouse, version=1) == winners[0]


def test_many_writers_of_one_version(spark, tmp_path):
    def one(i):
        try:
            return publish(spark, str(tmp_path), f"run{i}", 0, {"counts": {}})
        except PublishConflict:
            return None

    with ThreadPoolExecutor(8) as all_at_once:
        results = list(all_at_once.map(one, range(24)))
    assert [r for r in results if r] == [1] and versions(spark, str(tmp_path)) == [1]
    assert entry(spark, str(tmp_path), 1)["run_id"] == f"run{results.index(1)}"
    assert not [p for p in (tmp_path / "published").iterdir() if "draft" in p.name]
    with pytest.raises(PublishConflict):
        publish(spark, str(tmp_path), "late", 0, {})
    assert publish(spark, str(tmp_path), "next", 1, {}) == 2


def test_a_version_without_content_is_passed_over(spark, tmp_path):
    publish(spark, str(tmp_path), "good", 0, {})
    (tmp_path / "published" / "v0000000002.json").touch()
    assert latest(spark, str(tmp_path))["run_id"] == "good"
    assert publish(spark, str(tmp_path), "next", 2, {}) == 3


def test_a_version_says_what_was_loaded(spark, run, warehouse):
    text = (warehouse / "w" / "published" / "v0000000001.json").read_text()
    assert json.loads(text) == {"version": 1, "run_id": run.run_id, "counts": run.counts}
    assert by_outcome(open_warehouse(spark, str(warehouse / "w")).observed_report()) == by_outcome(run.observed_report())


def test_nothing_published(spark, tmp_path):
    assert versions(spark, str(tmp_path / "none")) == []
    with pytest.raises(FileNotFoundError):
        open_warehouse(spark, str(tmp_path / "none"))


# ---- checks ----------------------------------------------------------------------------


def test_integrity_report(run):
    star = run.star()
    got = {(r.section, r.name): (r.n_rows, r.passed) for r in quality.integrity_report(star).collect()}
    counts = {("rows", r.table_name): (r.n_rows, None) for r in quality.table_counts(star).collect()}
    orphans = {("orphans", r["check"]): (r.orphans, r.passed) for r in quality.orphan_checks(star).collect()}
    totals = quality.quality_metrics(star).first().asDict()
    flags = {("flags", f"is_{name}"): (totals[metric], None) for name, metric in (
        ("win", "wins"), ("podium", "podiums"), ("pole", "poles"), ("scoring", "scoring"), ("finished", "finished"))}
    coherence = {("coherence", "wins_without_podium"): (quality.flag_coherence(star).first()[0], True)}
    assert got == counts | orphans | flags | coherence


def test_integrity_report_finds_faults(spark, run):
    from gridmart.plans.star import Star
    star = run.star()
    fact = star.fact_columns(()).withColumn("is_podium", F.lit(False)).withColumn(
        "driver_id", F.when(F.col("race_id") == 900, F.lit(-1).cast("long")).otherwise(F.col("driver_id")))
    got = {(r.section, r.name): (r.n_rows, r.passed) for r in quality.integrity_report(
        Star(star.dimensions, lambda columns: fact)).collect()}
    assert got["orphans", "dim_driver"] == (3, False) and got["coherence", "wins_without_podium"][1] is False
    assert got["orphans", "dim_race"] == (0, True)


def test_integrity_report_scans_each_table_once(run):
    plan = plan_of(quality.integrity_report(run.star()))
    for name in (s.name for s in LOAD_ORDER):
        assert sum(f"/tables/{name}" in line for line in plan.splitlines() if "Location" in line) == 1, name


# ---- plans on a loaded star ------------------------------------------------------------


def test_counts_come_from_footers(run):
    plan = plan_of(quality.table_counts(run.star()))
    assert plan.count("PushedAggregation: [COUNT(*)]") == len(LOAD_ORDER)
    assert "_id" not in "".join(line for line in plan.splitlines() if "ReadSchema" in line)
    assert {r.table_name: r.n_rows for r in quality.table_counts(run.star()).collect()} == {
        s.name: run.counts[s.name]["accepted"] for s in LOAD_ORDER}


def test_dates_prune_the_years_of_the_fact(spark, run):
    question = analytics.driver_by_year(run.star(), when=F.col("month") == 6)
    fact = next(part for part in plan_of(question).split("\n\n") if "/tables/fact_race_result" in part)
    assert "dynamicpruning" in fact.split("PartitionFilters:")[1].splitlines()[0]
    assert [(r.year, r.driver_id, r.races) for r in question.collect()] == [(2031, 501, 2), (2031, 502, 2), (2031, 503, 1)]


@pytest.fixture(scope="module")
def larger(spark, tmp_path_factory):
    """3,000 results of 300 races in 12 years."""
    base = tmp_path_factory.mktemp("larger")
    races, results = [FILES["races"].splitlines()[0]], [FILES["results"].splitlines()[0]]
    for race in range(300):
        races.append(f"{race},{2000 + race % 12},{race},{61 + race % 2},Prize number {race},{2000 + race % 12}-06-{race % 28 + 1:02d},15:30:00,u{race}")
        for place in range(10):
            driver = (501, 502, 503)[place] if place < 3 else 500 + place
            results.append(f"{len(results)},{race},{driver},31,7,{place},{place + 1},1,{10 - place},44,z,{race * 1000 + place},21,1,2:03.250,188.125,1")
    drivers = FILES["drivers"] + "".join(f"{d},d{d},1,D{d % 10},N{d},S{d},1990-01-01,Coastal,u\n" for d in range(506, 510))
    files = dict(FILES, races="\n".join(races) + "\n", results="\n".join(results) + "\n", drivers=drivers)
    source = write_files(base / "source", files)
    return source, load(spark, source, str(base / "w"))


def test_statistics_change_the_plan(spark, larger):
    """A filter that leaves few races makes them a broadcast, once their values are known."""
    _, run = larger
    with _settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "1000"}):
        plans, rows = {}, {}
        for statistics in (False, True):
            name = f"star_{statistics}".lower()
            create_tables(run, name, statistics)
            star = catalog_star(spark, name)
            races = star.dim("dim_race", "race_id", "round", "name").where("round < 5")
            joined = star.fact("race_id", "driver_id", "points").join(races, "race_id")
            plans[statistics], rows[statistics] = plan_of(joined, "simple"), sorted(map(tuple, joined.collect()))
        assert "SortMergeJoin" in plans[False] and "BroadcastHashJoin" not in plans[False]
        assert "BroadcastHashJoin" in plans[True] and "SortMergeJoin" not in plans[True]
        assert rows[False] == rows[True] and len(rows[True]) == 40


def test_catalog_tables_are_the_runs_tables(spark, run):
    create_tables(run, "loaded", with_status=True)
    star = catalog_star(spark, "loaded")
    for spec in SPECS.values():
        table = star.fact_columns(()) if spec is FACT_RACE_RESULT else star.dim(spec.name, *spec.columns)
        assert sorted(map(str, table.select(*spec.columns).collect())) == sorted(
            map(str, run.table(spec.name).select(*spec.columns).collect()))
    assert [(r.driver_id, r.wins) for r in analytics.top_drivers(star, 1).collect()] == [(501, 2)]
    statistics = spark.sql("DESCRIBE EXTENDED loaded.fact_race_result").where("col_name = 'Statistics'").first().data_type
    assert statistics.endswith("6 rows")


def test_buckets_by_race_need_no_shuffle(spark, larger):
    """Neither for the race join nor for the key rule, where both sides are too large to broadcast."""
    source, run = larger
    exchanges = {}
    for buckets in (None, 4):
        staged = {name: _stage(spark.read.parquet(f"{run.path}/staging/{name}"), open_warehouse(
            spark, str(Path(run.path).parent / f"plan{buckets}"), run_id=f"b{buckets}"), name, buckets) for name in ("races", "results")}
        sizes = {"spark.sql.autoBroadcastJoinThreshold": "10000", "spark.sql.adaptive.enabled": "false"}
        with _settings(spark, sizes | (BY_RACE if buckets else {})):
            plan = plan_of(fact_rows(staged["results"], staged["races"], run), "simple")
        exchanges[buckets] = [line for line in plan.splitlines() if "Exchange hashpartitioning(race_id" in line
                              or "Exchange hashpartitioning(_repeated_race_id" in line]
        assert plan.count("SortMergeJoin") >= 2
        for name in staged if buckets else ():
            spark.sql(f"DROP TABLE staged_{name}_b{buckets}")
    assert len(exchanges[None]) >= 3 and exchanges[4] == []


def test_buckets_give_the_same_tables(spark, run, larger, tmp_path):
    for source, plain in ((write_files(tmp_path / "source"), run), larger):
        bucketed = load(spark, source, str(tmp_path / f"w{len(source)}"), race_buckets=3)
        for spec in LOAD_ORDER:
            assert sorted(map(str, bucketed.annotated(spec.name).drop("_order", "_bad_line").collect())) == sorted(
                map(str, plain.annotated(spec.name).drop("_order", "_bad_line").collect())), spec.name
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("staged_")]
