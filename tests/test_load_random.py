"""The load against a row-by-row reading of its rules, on random small inputs."""

import random

import pytest

from gridmart.plans.warehouse import load

NULL = "\\N"
COLUMNS = ("resultId", "raceId", "driverId", "constructorId", "grid", "position", "points", "laps",
           "milliseconds", "fastestLap", "fastestLapTime", "fastestLapSpeed", "statusId")


def some(rng, values, null_share=0.1):
    return NULL if rng.random() < null_share else str(rng.choice(values))


def make_files(rng):
    drivers = [some(rng, range(12)) for _ in range(20)]
    constructors = [some(rng, range(5)) for _ in range(8)]
    circuits = [some(rng, range(5)) for _ in range(8)]
    races = [(some(rng, range(8)), some(rng, range(6), 0.2),
              some(rng, ["2020-05-01", "2021-06-02", "2021-06-03"], 0.2)) for _ in range(24)]
    # One (race, driver) pair holds about a third of the rows.
    results = []
    for i in range(150):
        race, driver = ("1", "1") if rng.random() < 0.33 else (some(rng, range(9)), some(rng, range(13)))
        results.append((str(i), race, driver, some(rng, range(6)), some(rng, range(3)), some(rng, range(1, 5)),
                        some(rng, [0, 1.5, 10]), str(i), "1", "1", "1:00.5", "200.5", some(rng, [1, 11])))
    return drivers, constructors, circuits, races, results


def write(folder, drivers, constructors, circuits, races, results):
    def table(name, header, rows):
        (folder / f"{name}.csv").write_text("\n".join([header, *[",".join(r) for r in rows]]) + "\n")

    folder.mkdir()
    table("drivers", "driverId,number,code,forename,surname,dob,nationality,url",
          [(d, "1", "A", "B", "C", "2000-01-01", "D", "u") for d in drivers])
    table("constructors", "constructorId,constructorRef,name,nationality,url",
          [(c, "r", "n", "x", "u") for c in constructors])
    table("circuits", "circuitId,circuitRef,name,location,country,lat,lng,alt,url",
          [(c, "r", "n", "l", "c", "1", "2", "3", "u") for c in circuits])
    table("races", "raceId,year,round,circuitId,name,date,time,url",
          [(r, "2020", "1", c, "n", d, NULL, "u") for r, c, d in races])
    table("results", ",".join(COLUMNS), results)


def read_by_row(drivers, constructors, circuits, races, results):
    """Insert in file order: drop null keys, refuse unknown parents, keep the first of a key."""
    known_drivers, known_constructors, known_circuits = (set(x) - {NULL} for x in (drivers, constructors, circuits))
    known_races = {r for r, c, _ in races if r != NULL and c in known_circuits}
    table = {}
    for row in results:
        values = dict(zip(COLUMNS, row))
        race, driver, constructor = values["raceId"], values["driverId"], values["constructorId"]
        for race_id, circuit, date in races:
            if race == NULL or race_id != race or NULL in (driver, constructor, circuit, date):
                continue
            if race in known_races and driver in known_drivers and constructor in known_constructors \
                    and circuit in known_circuits and (race, driver) not in table:
                position, grid, points = (values[n] for n in ("position", "grid", "points"))
                table[race, driver] = (
                    int(constructor), int(circuit), int(date.replace("-", "")), int(values["laps"]),
                    position == "1", position in ("1", "2", "3"), grid == "1",
                    points != NULL and float(points) > 0, values["statusId"] == "1")
    return {(int(r), int(d)): v for (r, d), v in table.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_load_equals_reading_row_by_row(spark, tmp_path, seed):
    files = make_files(random.Random(seed))
    write(tmp_path / "source", *files)
    run = load(spark, str(tmp_path / "source"), str(tmp_path / "warehouse"))
    got = {(r.race_id, r.driver_id): (
        r.constructor_id, r.circuit_id, r.date_id, r.laps, r.is_win, r.is_podium, r.is_pole, r.is_scoring,
        r.is_finished) for r in run.table("fact_race_result").collect()}
    assert got == read_by_row(*files)
    assert len(got) > 5
    assert run.annotated("fact_race_result").count() == 150
