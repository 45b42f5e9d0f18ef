"""The full load on small files that break every rule once."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridmart.plans import analytics, quality
from gridmart.plans.warehouse import load, open_warehouse
from gridmart.schemas import LOAD_ORDER, SPECS

FILES = {
    "drivers": '''driverId,driverRef,number,code,forename,surname,dob,nationality,url
501,quill,7.0,QUI,Ines,"Quill, ""IQ""",1990-11-30,Coastal,http://d/501
502,tarn,63,TARNER,Oskar,Tarn,1992-02-29,Inland,http://d/502
503,solo,\\N,N/A,\\N,Mononym,some day,None,\\N
x50,bad,8,BAD,Bad,Key,1991-05-05,Coastal,u
\\N,null,8,NUL,Null,Key,1991-05-05,Coastal,u
502,again,9,AGN,Second,Tarn,1991-05-05,Coastal,u
504,short
505,long,5,LON,''' + "F" * 100 + "," + "S" * 100 + ''',1993-03-13,Coastal,u
''',
    "constructors": '''constructorId,constructorRef,name,nationality,url
31,kestrel,Kestrel,Coastal,u
32,ibex,Ibex,Inland,u
''',
    "circuits": '''circuitId,circuitRef,name,location,country,lat,lng,alt,url
61,quay,Muelle Añil,Río Hondo,Coastland,-7.75,18.5,4,"http://c/61,62"
62,ridge,Ridgeway,Upper Ridge,Inlandia,48.25,west,\\N,u
''',
    "races": '''raceId,year,round,circuitId,name,date,time,url
900,2031,1,61,Quay Prize,2031-06-07,15:30:00,u
901,2031,2,62,Ridge Prize,2031-06-09,\\N,u
902,2031,3,699,Nowhere Prize,2031-06-11,15:30:00,u
903,2031,4,\\N,Homeless Prize,2031-06-13,15:30:00,u
904,2031,5,61,Undated Prize,\\N,24:10:00,u
900,2031,6,62,Quay Prize again,2031-10-10,15:30:00,u
905,2031,7,699,First copy unknown,2031-07-01,15:30:00,u
905,2031,7,61,Second copy good,2031-07-02,15:30:00,u
906,2031,8,62,Oddly dated Prize,07/03/2031,15:30:00,u
''',
    "results": '''resultId,raceId,driverId,constructorId,number,grid,position,positionText,points,laps,time,milliseconds,fastestLap,rank,fastestLapTime,fastestLapSpeed,statusId
1,900,501,31,7,1,1,1,12.0,44,z,4100500,21,1,2:03.250,188.125,1
2,900,502,31,63,0,2,2,9,44,z,4107250,33,2,slow,999999.5,11
3,901,501,399,7,3,1,1,12,30,z,1,1,1,2:00.0,180,1
4,901,501,32,7,12,1,1,13,30,z,2,1,1,2:00.0,180,1
5,901,501,32,7,1,1,1,14,30,z,3,1,1,2:00.0,180,1
6,901,577,32,7,1,3,3,6,30,z,3,1,1,2:00.0,180,1
7,902,501,31,7,1,1,1,12,30,z,3,1,1,2:00.0,180,1
8,903,501,31,7,1,1,1,12,30,z,3,1,1,2:00.0,180,1
9,904,501,31,7,1,1,1,12,30,z,3,1,1,2:00.0,180,1
10,999,501,31,7,1,1,1,12,30,z,3,1,1,2:00.0,180,1
11,\\N,501,31,7,1,1,1,12,30,z,3,1,1,2:00.0,180,1
12,900,x50,31,7,1,1,1,12,30,z,3,1,1,2:00.0,180,1
13,900,503,32,\\N,\\N,\\N,R,\\N,0,\\N,\\N,\\N,\\N,\\N,\\N,\\N
14,905,503,32,8,4,4,4,0.5,30,z,3,1,1,153722867280914:01.0,180,1
15,901,502,32,63
16,906,502,32,63,1,1,1,12,30,z,3,1,1,9223372036854775807:01.000,180,1
17,901,502,32,63,5,6,6,1,30,z,3,1,1,9223372036854775807:01.000,180,1
''',
    "status": "statusId,status\n1,Finished\n11,+1 Lap\n11,twice\n",
}


def write_files(folder, files=FILES):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)


def rows_of(run, name):
    return sorted(map(tuple, run.table(name).collect()), key=str)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("load")
    return load(spark, write_files(base / "source"), str(base / "warehouse"), with_status=True)


def outcomes(run, name):
    return {r.outcome: r.n_rows for r in run.load_report(name).collect()}


def test_drivers(run):
    got = {r.driver_id: r for r in run.table("dim_driver").collect()}
    assert set(got) == {501, 502, 503, 505}
    assert got[501].last_name == 'Quill, "IQ"' and got[501].full_name == 'Ines Quill, "IQ"'
    assert got[501].number == 7 and got[501].birth_date == dt.date(1990, 11, 30)
    assert got[502].code == "TAR" and got[502].first_name == "Oskar"
    assert got[503].full_name is None and got[503].birth_date is None and got[503].code is None
    assert got[505].full_name == "F" * 100 + " " + "S" * 99
    assert outcomes(run, "dim_driver") == {
        "accepted": 4, "bad_key": 1, "null_key": 1, "duplicate_key": 1, "malformed_row": 1}


def test_rejects_say_what_and_where(run):
    rejects = {r.reject_reason: r for r in run.rejects("dim_driver").collect()}
    assert rejects["bad_key"].source_key == "x50"
    assert rejects["malformed_row"]["_bad_line"] == "504,short"
    assert rejects["duplicate_key"].first_name == "Second"
    assert rejects["duplicate_key"]["_order"].file.endswith("drivers.csv")


def test_circuits(run):
    got = {r.circuit_id: r for r in run.table("dim_circuit").collect()}
    assert got[61].location == "Río Hondo" and got[61].lat == Decimal("-7.750000") and got[61].url == "http://c/61,62"
    assert got[62].lng is None and got[62].altitude is None


def test_races(run):
    got = {r.race_id: r for r in run.table("dim_race").collect()}
    assert set(got) == {900, 901, 904, 905, 906}
    assert got[900].name == "Quay Prize" and got[900].start_time == "15:30:00"
    assert got[905].name == "Second copy good"
    assert got[904].date is None and got[904].start_time is None
    assert outcomes(run, "dim_race") == {"accepted": 5, "missing_circuit": 2, "null_key": 1, "duplicate_key": 1}


def test_dates_come_from_all_races(run):
    assert {r.date_id for r in run.table("dim_date").collect()} == {
        20310607, 20310609, 20310611, 20310613, 20311010, 20310701, 20310702}


def test_status(run):
    assert rows_of(run, "dim_status") == [(1, "Finished"), (11, "+1 Lap")]


def test_fact(run):
    got = {(r.race_id, r.driver_id): r for r in run.table("fact_race_result").collect()}
    assert set(got) == {(900, 501), (900, 502), (900, 503), (901, 501), (901, 502), (905, 503)}
    winner = got[900, 501]
    assert (winner.circuit_id, winner.date_id, winner.year) == (61, 20310607, 2031)
    assert (winner.best_lap_ms, winner.avg_speed, winner.time_ms) == (123250, Decimal("188.13"), 4100500)
    assert winner.is_win and winner.is_podium and winner.is_pole and winner.is_scoring and winner.is_finished
    second = got[900, 502]
    assert second.best_lap_ms is None and second.avg_speed is None
    assert not second.is_win and second.is_podium and not second.is_pole and not second.is_finished
    retired = got[900, 503]
    assert retired.finish_pos is None
    assert [retired.is_win, retired.is_podium, retired.is_pole, retired.is_scoring, retired.is_finished] == [False] * 5
    # The first copy has an unknown constructor, so the second one holds the key.
    assert got[901, 501].points == Decimal("13.00")
    # The race's first copy has an unknown circuit, so the second one gives circuit and date.
    assert (got[905, 503].circuit_id, got[905, 503].date_id) == (61, 20310702)
    # More minutes than a long can count in milliseconds.
    assert got[905, 503].best_lap_ms is None and got[901, 502].best_lap_ms is None


def test_fact_rejects(run):
    reasons = {r["_order"].row: r.reject_reason for r in run.rejects("fact_race_result").collect()}
    assert reasons == {
        2: "missing_constructor", 4: "duplicate_key", 5: "missing_driver", 6: "missing_race",
        7: "race_without_circuit", 8: "race_without_date", 9: "missing_race", 10: "null_key", 11: "bad_key",
        14: "malformed_row", 15: "race_with_bad_date"}


def test_every_source_row_has_one_outcome(run):
    for name, source in (("dim_driver", "drivers"), ("dim_race", "races"), ("fact_race_result", "results")):
        extracted = len(FILES[source].strip().splitlines()) - 1
        assert sum(outcomes(run, name).values()) == extracted


def test_issue_report(run):
    got = {(r.table_name, r.column_name, r.action): r.n_rows
           for r in run.issue_report("dim_driver", "dim_circuit", "dim_race", "fact_race_result").collect()}
    assert got["dim_driver", "code", "cut"] == 1
    assert got["dim_driver", "full_name", "cut"] == 1
    assert got["dim_race", "date", "nulled"] == 1
    assert got["dim_driver", "birth_date", "nulled"] == 1
    assert got["dim_circuit", "lng", "nulled"] == 1
    assert got["dim_race", "start_time", "nulled"] == 1
    assert got["fact_race_result", "avg_speed", "nulled"] == 1
    assert got["fact_race_result", "best_lap_ms", "nulled"] == 4


def test_keys_are_unique_and_parents_exist(run):
    for spec in SPECS.values():
        assert run.keys(spec.name).groupBy(*spec.key).count().where("count > 1").isEmpty()
    assert all(r.orphans == 0 and r.passed for r in quality.orphan_checks(run.star()).collect())
    assert quality.flag_coherence(run.star()).first()[0] == 0
    counts = {r.table_name: r.n_rows for r in quality.table_counts(run.star()).collect()}
    assert counts["fact_race_result"] == 6 and counts["dim_driver"] == 4


def test_declared_types(run):
    for spec in SPECS.values():
        got = dict(run.table(spec.name).dtypes)
        for field in spec.schema.fields:
            assert got[field.name] == field.dataType.simpleString()


def test_year_filter_prunes_folders(spark, run):
    df = run.table("fact_race_result").where("year = 2031")
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "isnotnull(year" in plan.split("PartitionFilters:")[1].splitlines()[0]


def test_questions_on_the_loaded_star(run):
    star = run.star()
    assert [(r.driver_id, r.wins) for r in analytics.top_drivers(star, 1).collect()] == [(501, 2)]
    assert analytics.pole_to_win_pct(star).first()[0] == 50.0
    assert analytics.outside_top_k(star).first()[0] == 1
    assert [(r.constructor_id, r.one_twos) for r in analytics.one_two(star).collect()] == [(31, 1)]


def test_loading_twice_gives_the_same_tables(spark, run, tmp_path):
    source, warehouse = write_files(tmp_path / "source"), str(tmp_path / "warehouse")
    first = load(spark, source, warehouse)
    assert open_warehouse(spark, warehouse).path == first.path
    second = load(spark, source, warehouse)
    assert open_warehouse(spark, warehouse).path == second.path
    for spec in LOAD_ORDER:
        assert rows_of(first, spec.name) == rows_of(second, spec.name) == rows_of(run, spec.name)


def test_column_order_does_not_matter(spark, run, tmp_path):
    lines = [line.split(",") for line in FILES["results"].strip().splitlines()]
    whole = [line for line in lines if len(line) == len(lines[0])]
    order = list(range(len(lines[0])))
    random.Random(1).shuffle(order)
    files = dict(FILES, results="\n".join(",".join(line[i] for i in order) for line in whole) + "\n")
    moved = load(spark, write_files(tmp_path / "source", files), str(tmp_path / "warehouse"))
    assert rows_of(moved, "fact_race_result") == rows_of(run, "fact_race_result")


def test_task_layout_does_not_matter(spark, run, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        split = load(spark, write_files(tmp_path / "source"), str(tmp_path / "warehouse"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for spec in LOAD_ORDER:
        assert rows_of(split, spec.name) == rows_of(run, spec.name)


def test_no_results_at_all(spark, tmp_path):
    files = dict(FILES, results=FILES["results"].splitlines()[0] + "\n")
    empty = load(spark, write_files(tmp_path / "source", files), str(tmp_path / "warehouse"))
    star = empty.star()
    assert empty.table("fact_race_result").count() == 0
    assert analytics.pole_to_win_pct(star).first()[0] is None
    assert analytics.champions(star).count() == 0
    assert [r.orphans for r in quality.orphan_checks(star).collect()] == [0] * 5


def test_a_failed_load_publishes_nothing(spark, tmp_path):
    files = {name: text for name, text in FILES.items() if name != "results"}
    with pytest.raises(Exception):
        load(spark, write_files(tmp_path / "source", files), str(tmp_path / "warehouse"))
    assert not (tmp_path / "warehouse" / "published").exists()


def test_hot_duplicate_key(spark, tmp_path):
    """A third of all results are copies of one key; exactly the first is kept."""
    header, first = FILES["results"].splitlines()[:2]
    lines = [header, first]
    for i in range(3000):
        lines.append(first.replace("12.0", str(i % 20)))
    files = dict(FILES, results="\n".join(lines) + "\n")
    hot = load(spark, write_files(tmp_path / "source", files), str(tmp_path / "warehouse"))
    assert [r.points for r in hot.table("fact_race_result").select("points").collect()] == [Decimal("12.00")]
    assert outcomes(hot, "fact_race_result") == {"accepted": 1, "duplicate_key": 3000}
    assert hot.rejects("fact_race_result").agg(F.count("*")).first()[0] == 3000


def test_a_third_of_the_rows_without_a_key(spark, tmp_path):
    """Rows that are broken by themselves meet no other row."""
    header, first = FILES["results"].splitlines()[:2]
    lines = [header, first] + [first.replace(",900,501,", ",\\N,501,")] * 1500 + [first.replace(",501,31,", ",502,\\N,")] * 500
    run = load(spark, write_files(tmp_path / "source", dict(FILES, results="\n".join(lines) + "\n")), str(tmp_path / "w"))
    assert outcomes(run, "fact_race_result") == {"accepted": 1, "null_key": 2000}


def test_line_breaks_inside_quotes(spark, tmp_path):
    files = dict(FILES, circuits=FILES["circuits"].replace("Upper Ridge", '"Upper\nRidge"'))
    source = write_files(tmp_path / "source", files)
    assert outcomes(load(spark, source, str(tmp_path / "a")), "dim_circuit") == {"accepted": 1, "malformed_row": 2}
    run = load(spark, source, str(tmp_path / "b"), multiline=True)
    assert {r.location for r in run.table("dim_circuit").collect()} == {"Río Hondo", "Upper\nRidge"}
