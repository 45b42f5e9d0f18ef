"""The same questions as SQL on the same tables, written from the definitions.

Used to check results only. ``CLEAN`` and ``FLAWED`` describe a result row before the load
rules; ``FACT`` applies the primary-key rule for the star that the questions run on.
"""

from __future__ import annotations

_FIRST = "l_linenumber, l_partkey, l_extendedprice, l_quantity, l_returnflag, l_linestatus"
_RETIRED = "l_returnflag = 'R'"
_STATUS = f"CASE WHEN {_RETIRED} THEN 3 WHEN l_linestatus = 'F' THEN 1 ELSE 11 END"
_BRAND = "CAST(substr(p_brand, 7) AS INTEGER)"
_DAY_KEY = "CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"
_POINTS = f"CASE WHEN {_RETIRED} THEN 0 ELSE CAST(round(l_discount * 100) AS INTEGER) * 2.5 END"
_LOW = "l_discount < 0.03"


def _results(flawed: bool) -> str:
    """Typed result rows; texts of broken keys in *_text columns."""
    tax = "CAST(round(l_tax * 100) AS INTEGER)"
    race = f"CASE WHEN {tax} = 8 AND {_LOW} THEN NULL ELSE l_orderkey END" if flawed else "l_orderkey"
    bad_driver = f"({tax} = 7 AND {_LOW})" if flawed else "false"
    constructor = f"CASE WHEN {tax} = 6 THEN NULL ELSE {_BRAND} END" if flawed else _BRAND
    speed = "CAST(CAST(l_quantity AS INTEGER) + 150.25 AS DECIMAL(6,2))"
    bad_speed = f"({tax} = 5)" if flawed else "false"
    bad_lap = f"({tax} = 4)" if flawed else "false"
    return f"""
    SELECT {race} AS race_id,
      CASE WHEN {bad_driver} THEN NULL ELSE l_suppkey END AS driver_id,
      {constructor} AS constructor_id,
      CAST({_POINTS} AS DECIMAL(5,2)) AS points,
      CASE WHEN NOT ({_RETIRED}) THEN l_linenumber END AS finish_pos,
      CAST(l_quantity AS INTEGER) - 1 AS grid_pos,
      CAST(l_quantity AS INTEGER) + 20 AS laps,
      CASE WHEN NOT ({_RETIRED}) THEN CAST(floor(l_extendedprice) AS BIGINT) * 60 END AS time_ms,
      CASE WHEN NOT ({_RETIRED}) THEN CAST(l_quantity AS INTEGER) END AS best_lap,
      CASE WHEN NOT ({_RETIRED}) AND NOT {bad_lap} THEN 60000 + CAST(floor(l_extendedprice) AS BIGINT) % 60000 END AS best_lap_ms,
      {_RETIRED} OR {bad_lap} AS bad_lap,
      CASE WHEN NOT ({_RETIRED}) AND NOT {bad_speed} THEN {speed} END AS avg_speed,
      {_STATUS} AS status_id,
      {bad_driver} AS bad_driver,
      NOT ({_RETIRED}) AND {bad_speed} AS bad_speed,
      CASE WHEN {bad_driver} THEN coalesce(CAST({race} AS VARCHAR), '') || '|unknown|'
        || coalesce(CAST({constructor} AS VARCHAR), '') END AS source_key,
      {_FIRST}
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey"""


_RACES = f"""
    SELECT o_orderkey AS race_id, CAST(year(o_orderdate) AS INTEGER) AS year,
      CAST(dayofyear(o_orderdate) AS INTEGER) AS round, c_nationkey AS circuit_id,
      'Grand Prix ' || o_orderkey AS name, CAST(o_orderdate AS DATE) AS date,
      {_DAY_KEY.format(d='o_orderdate')} AS date_id, o_orderstatus
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""

# Some races left out, some without a circuit or a (readable) date.
_FAULTY_RACES = f"""
    SELECT race_id, year, round, CASE WHEN race_id % 50 <> 1 THEN circuit_id END AS circuit_id, name,
      CASE WHEN race_id % 50 NOT IN (2, 3) THEN date END AS date,
      CASE WHEN race_id % 50 NOT IN (2, 3) THEN date_id END AS date_id, o_orderstatus, race_id % 50 = 3 AS bad_date
    FROM ({_RACES}) WHERE race_id % 50 <> 4"""

_FLAGS = """
      coalesce(finish_pos = 1, false) AS is_win, coalesce(finish_pos <= 3, false) AS is_podium,
      coalesce(grid_pos = 1, false) AS is_pole, coalesce(points > 0, false) AS is_scoring,
      coalesce(status_id = 1, false) AS is_finished"""

# Drivers, circuits and dates under the names of the star.
_DRIVERS = """
    SELECT s_suppkey AS driver_id, replace(s_name, '#', ' ') AS full_name, n_name AS nationality
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""

_DATES = """
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS date,
      CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
      CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) // 10 * 10 AS INTEGER) AS decade,
      CASE month(d) WHEN 1 THEN 'Enero' WHEN 2 THEN 'Febrero' WHEN 3 THEN 'Marzo' WHEN 4 THEN 'Abril'
        WHEN 5 THEN 'Mayo' WHEN 6 THEN 'Junio' WHEN 7 THEN 'Julio' WHEN 8 THEN 'Agosto'
        WHEN 9 THEN 'Septiembre' WHEN 10 THEN 'Octubre' WHEN 11 THEN 'Noviembre' ELSE 'Diciembre' END AS month_name,
      CASE isodow(d) WHEN 1 THEN 'Lunes' WHEN 2 THEN 'Martes' WHEN 3 THEN 'Miércoles' WHEN 4 THEN 'Jueves'
        WHEN 5 THEN 'Viernes' WHEN 6 THEN 'Sábado' ELSE 'Domingo' END AS weekday_name,
      isodow(d) >= 6 AS is_weekend
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"""

_CIRCUITS = """
    SELECT n_nationkey AS circuit_id, n_name AS circuit_name, r_name AS country
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""

_CONSTRUCTORS = f"SELECT DISTINCT {_BRAND} AS constructor_id, p_brand AS constructor_name FROM part"

# The star: first line item per (order, supplier).
_STAR = f"""
  results AS ({_results(False)}),
  races AS ({_RACES}),
  drivers AS ({_DRIVERS}),
  dates AS ({_DATES}),
  circuits AS ({_CIRCUITS}),
  constructors AS ({_CONSTRUCTORS}),
  fact AS (
    SELECT r.race_id, driver_id, constructor_id, circuit_id, date_id, year, points, finish_pos, grid_pos, {_FLAGS}
    FROM (SELECT *, row_number() OVER (PARTITION BY race_id, driver_id ORDER BY {_FIRST}) AS nth FROM results) r
    JOIN races ON races.race_id = r.race_id
    WHERE nth = 1)"""

WITH_STAR = f"WITH {_STAR}\n"


def _loaded(flawed: bool, incomplete: bool) -> str:
    """Every result row with the first rule it breaks, or none."""
    drivers = "s_acctbal >= 0" if incomplete else "true"
    brands = f"{_BRAND} <= 20" if incomplete else "true"
    countries = "country <> 'AFRICA'" if incomplete else "true"
    days = "weekday_name <> 'Domingo'" if incomplete else "true"
    return f"""WITH
  results AS ({_results(flawed)}),
  races AS ({_FAULTY_RACES if incomplete else _RACES.replace(", o_orderstatus", ", o_orderstatus, false AS bad_date")}),
  known_drivers AS (SELECT s_suppkey FROM supplier WHERE {drivers}),
  known_constructors AS (SELECT DISTINCT {_BRAND} AS brand FROM part WHERE {brands}),
  known_circuits AS (SELECT circuit_id FROM ({_CIRCUITS}) WHERE {countries}),
  known_dates AS (SELECT date_id FROM ({_DATES}) WHERE {days}),
  joined AS (
    SELECT r.* EXCLUDE (race_id), r.race_id, circuit_id, date_id, CASE
      WHEN races.race_id IS NULL THEN 'missing_race'
      WHEN circuit_id IS NULL THEN 'race_without_circuit'
      WHEN circuit_id NOT IN (FROM known_circuits) THEN 'missing_race'
      WHEN bad_date THEN 'race_with_bad_date'
      WHEN date_id IS NULL THEN 'race_without_date' END AS race_fault
    FROM results r LEFT JOIN races ON races.race_id = r.race_id),
  keyed AS (
    SELECT *, CASE
      WHEN bad_driver THEN 'bad_key'
      WHEN race_id IS NULL OR driver_id IS NULL OR constructor_id IS NULL THEN 'null_key'
      WHEN race_fault IS NOT NULL THEN race_fault
      WHEN driver_id NOT IN (FROM known_drivers) THEN 'missing_driver'
      WHEN constructor_id NOT IN (FROM known_constructors) THEN 'missing_constructor'
      WHEN date_id NOT IN (FROM known_dates) THEN 'missing_date' END AS broken
    FROM joined),
  judged AS (
    SELECT *, coalesce(broken, CASE WHEN row_number() OVER (
      PARTITION BY broken IS NULL, race_id, driver_id ORDER BY {_FIRST}) > 1 THEN 'duplicate_key' END) AS reject_reason
    FROM keyed)
"""


def _best(group: str, who: str, name_table: str, name: str, extra: str = "") -> str:
    """Most wins per group, ties kept."""
    return f"""{WITH_STAR}, tallies AS (
    SELECT {group} , {who}, count(*) AS wins FROM fact WHERE is_win GROUP BY ALL),
  ranked AS (SELECT *, rank() OVER (PARTITION BY {group.split(' AS ')[-1]} ORDER BY wins DESC) AS place FROM tallies)
  SELECT {group.split(' AS ')[-1]}, {who}, wins, {name}{', circuit_name' if extra else ''}
  FROM ranked JOIN {name_table} USING ({who}) {extra} WHERE place = 1"""


_JOIN_CIRCUIT = "JOIN circuits USING (circuit_id)"

_PROFILE_COLUMNS = {
    "raceId": "CAST(l_orderkey AS VARCHAR)",
    "driverId": "CAST(l_suppkey AS VARCHAR)",
    "constructorId": "substr(p_brand, 7)",
    "grid": "CAST(CAST(l_quantity AS INTEGER) - 1 AS VARCHAR)",
    "position": f"CASE WHEN NOT ({_RETIRED}) THEN CAST(l_linenumber AS VARCHAR) END",
    "points": f"CAST(CAST({_POINTS} AS DOUBLE) AS VARCHAR)",
    "laps": "CAST(CAST(l_quantity AS INTEGER) + 20 AS VARCHAR)",
    "milliseconds": f"CASE WHEN NOT ({_RETIRED}) THEN CAST(CAST(floor(l_extendedprice) AS BIGINT) * 60 AS VARCHAR) END",
    "fastestLap": f"CASE WHEN NOT ({_RETIRED}) THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END",
    "fastestLapTime": f"""CASE WHEN {_RETIRED} THEN 'no time' ELSE
      printf('1:%02d.%03d', CAST(floor(l_extendedprice) AS BIGINT) % 60000 // 1000, CAST(floor(l_extendedprice) AS BIGINT) % 1000) END""",
    "fastestLapSpeed": f"CASE WHEN NOT ({_RETIRED}) THEN CAST(CAST(l_quantity AS INTEGER) + 150 AS VARCHAR) || '.25' END",
    "statusId": f"CAST({_STATUS} AS VARCHAR)",
}


def _profile_kind(name: str) -> str:
    return f"""CASE WHEN count(TRY_CAST({name} AS DOUBLE)) < count({name}) THEN 'string'
      WHEN bool_and(NOT contains({name}, '.')) THEN 'bigint' ELSE 'double' END"""


def _profile() -> str:
    source = ", ".join(f"{sql} AS {name}" for name, sql in _PROFILE_COLUMNS.items())
    lines = [f"""
    SELECT '{name}' AS column_name, {kind} AS data_type, count(*) AS n_rows, count({name}) AS non_null,
      count(*) - count({name}) AS nulls, count(DISTINCT {name}) AS "distinct",
      CASE WHEN {kind} = 'string' THEN min({name}) ELSE arg_min({name}, TRY_CAST({name} AS DOUBLE)) END AS "min",
      CASE WHEN {kind} = 'string' THEN max({name}) ELSE arg_max({name}, TRY_CAST({name} AS DOUBLE)) END AS "max", round(avg(TRY_CAST({name} AS DOUBLE)), 4) AS "avg",
      round(stddev_samp(TRY_CAST({name} AS DOUBLE)), 4) AS stddev,
      round(quantile_cont(TRY_CAST({name} AS DOUBLE), 0.25), 4) AS q25, round(quantile_cont(TRY_CAST({name} AS DOUBLE), 0.5), 4) AS q50,
      round(quantile_cont(TRY_CAST({name} AS DOUBLE), 0.75), 4) AS q75 FROM cleaned""" for name, kind in zip(_PROFILE_COLUMNS, map(_profile_kind, _PROFILE_COLUMNS))]
    return (f"WITH cleaned AS (SELECT {source} FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"
            + " UNION ALL ".join(lines))


def _cleaned_flawed() -> str:
    tax = "CAST(round(l_tax * 100) AS INTEGER)"
    columns = dict(_PROFILE_COLUMNS)
    columns["raceId"] = f"CASE WHEN NOT ({tax} = 8 AND {_LOW}) THEN CAST(l_orderkey AS VARCHAR) END"
    columns["driverId"] = f"CASE WHEN {tax} = 7 AND {_LOW} THEN 'unknown' ELSE CAST(l_suppkey AS VARCHAR) END"
    columns["constructorId"] = f"CASE WHEN {tax} <> 6 THEN substr(p_brand, 7) END"
    columns["fastestLapTime"] = f"""CASE WHEN NOT ({_RETIRED}) AND {tax} = 4 THEN '153722867280914:01.0'
      ELSE {columns['fastestLapTime']} END"""
    columns["fastestLapSpeed"] = f"""CASE WHEN {_RETIRED} THEN NULL WHEN {tax} = 5 THEN '123456.7'
      ELSE CAST(CAST(l_quantity AS INTEGER) + 150 AS VARCHAR) || '.25' END"""
    source = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"SELECT {source} FROM lineitem LEFT JOIN part ON l_partkey = p_partkey"


_DIM_DRIVER = """
  SELECT s_suppkey AS driver_id, 'Supplier' AS first_name, substr(s_name, 10) AS last_name,
    replace(s_name, '#', ' ') AS full_name, substr(n_name, 1, 3) AS code,
    CASE WHEN s_acctbal >= 0 THEN s_nationkey END AS number, n_name AS nationality,
    CASE WHEN s_acctbal >= 0 THEN make_date(1960 + s_nationkey, n_regionkey + 1, 15) END AS birth_date,
    CASE WHEN s_acctbal >= 0 THEN 'https://example.org/' || s_suppkey END AS url
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""

_DIM_CIRCUIT = """
  SELECT n_nationkey AS circuit_id, n_name AS name, n_name || ', ' || r_name AS location, r_name AS country,
    CAST(n_nationkey * 3.25 - 40 AS DECIMAL(10,6)) AS lat,
    CASE WHEN n_nationkey <> 7 THEN CAST(n_nationkey * 7.5 - 90 AS DECIMAL(10,6)) END AS lng,
    CASE WHEN r_name <> 'ASIA' THEN n_nationkey * 12 END AS altitude, CAST(NULL AS VARCHAR) AS url
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""

ORACLE: dict[str, str] = {
    "null_token_clean": _cleaned_flawed(),
    "typed_cast_report": f"""WITH r AS ({_results(True)})
  SELECT 'fact_race_result' AS table_name, 'driver_id' AS column_name, 'nulled' AS action, count(*) AS n_rows
    FROM r WHERE bad_driver HAVING count(*) > 0
  UNION ALL SELECT 'fact_race_result', 'avg_speed', 'nulled', count(*) FROM r WHERE bad_speed HAVING count(*) > 0
  UNION ALL SELECT 'fact_race_result', 'best_lap_ms', 'nulled', count(*) FROM r WHERE bad_lap HAVING count(*) > 0
  UNION ALL SELECT 'dim_driver', 'code', 'cut', count(*) FROM supplier JOIN nation ON s_nationkey = n_nationkey
    WHERE length(n_name) > 3 HAVING count(*) > 0
  UNION ALL SELECT 'dim_driver', 'birth_date', 'nulled', count(*) FROM supplier WHERE s_acctbal < 0 HAVING count(*) > 0
  UNION ALL SELECT 'dim_circuit', 'lng', 'nulled', count(*) FROM nation WHERE n_nationkey = 7 HAVING count(*) > 0
  UNION ALL SELECT 'dim_race', 'start_time', 'nulled', count(*) FROM orders WHERE o_orderstatus = 'O'
    HAVING count(*) > 0""",
    "critical_null_filter": f"""SELECT race_id, driver_id, constructor_id, points FROM ({_results(True)})
  WHERE race_id IS NOT NULL AND driver_id IS NOT NULL AND constructor_id IS NOT NULL""",
    "dim_driver": _DIM_DRIVER,
    "dim_constructor": f"""SELECT DISTINCT {_BRAND} AS constructor_id, p_brand AS name, lower(p_brand) AS ref,
    CAST(NULL AS VARCHAR) AS nationality, CAST(NULL AS VARCHAR) AS url FROM part""",
    "dim_circuit": _DIM_CIRCUIT,
    "dim_date": _DATES,
    "dim_race": f"""SELECT race_id, year, round, circuit_id, name, date,
    CASE WHEN o_orderstatus = 'F' THEN '14:00:00' END AS start_time, CAST(NULL AS VARCHAR) AS url FROM ({_RACES})""",
    "dim_status": f"""SELECT DISTINCT {_STATUS} AS status_id, CASE WHEN {_RETIRED} THEN 'Accident'
    WHEN l_linestatus = 'F' THEN 'Finished' ELSE '+1 Lap' END AS status FROM lineitem""",
    "fact_lookup_left": f"""SELECT l_orderkey AS race_id, l_suppkey AS driver_id, circuit_id, date_id
    FROM lineitem LEFT JOIN (FROM ({_RACES}) WHERE o_orderstatus <> 'P') ON race_id = l_orderkey""",
    "fact_race_result": _loaded(False, False) + f"""SELECT race_id, driver_id, constructor_id, circuit_id, date_id,
    points, finish_pos, grid_pos, laps, time_ms, best_lap, best_lap_ms, avg_speed, {_FLAGS}
  FROM judged WHERE reject_reason IS NULL""",
    "lap_time_to_ms": f"""SELECT {_PROFILE_COLUMNS['raceId']} AS "raceId", {_PROFILE_COLUMNS['driverId']} AS "driverId",
    {_PROFILE_COLUMNS['fastestLapTime']} AS "fastestLapTime",
    CASE WHEN NOT ({_RETIRED}) THEN 60000 + CAST(floor(l_extendedprice) AS BIGINT) % 60000 END AS best_lap_ms
  FROM lineitem""",
    "pk_dedup_first": f"""SELECT l_orderkey, l_suppkey, {_FIRST} FROM (SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_suppkey ORDER BY {_FIRST}) AS nth FROM lineitem) WHERE nth = 1""",
    "pk_rejects": _loaded(False, False) + """SELECT race_id, driver_id, constructor_id, finish_pos, grid_pos,
    reject_reason FROM judged WHERE reject_reason = 'duplicate_key'""",
    "fk_validate": _loaded(False, True) + """SELECT 'fact_race_result' AS table_name,
    coalesce(reject_reason, 'accepted') AS outcome, count(*) AS n_rows FROM judged GROUP BY ALL""",
    "fk_rejects": _loaded(True, True) + """SELECT race_id, driver_id, constructor_id,
    CASE WHEN reject_reason NOT IN ('bad_key', 'null_key') THEN circuit_id END AS circuit_id,
    CASE WHEN reject_reason NOT IN ('bad_key', 'null_key') THEN date_id END AS date_id, source_key,
    reject_reason FROM judged WHERE reject_reason <> 'duplicate_key'""",
    "load_report": _loaded(True, True) + f"""SELECT 'fact_race_result' AS table_name,
    coalesce(reject_reason, 'accepted') AS outcome, count(*) AS n_rows FROM judged GROUP BY ALL
  UNION ALL SELECT 'dim_driver', 'accepted', count(*) FROM known_drivers
  UNION ALL SELECT 'dim_constructor', 'accepted', count(*) FROM known_constructors
  UNION ALL SELECT 'dim_circuit', 'accepted', count(*) FROM known_circuits
  UNION ALL SELECT 'dim_race', CASE WHEN circuit_id IS NULL THEN 'null_key'
    WHEN circuit_id IN (FROM known_circuits) THEN 'accepted' ELSE 'missing_circuit' END, count(*) FROM races GROUP BY ALL
  UNION ALL SELECT 'dim_date', 'accepted', count(DISTINCT date_id) FROM races WHERE date_id IN (FROM known_dates)""",
    "table_counts": WITH_STAR + """SELECT 'dim_driver' AS table_name, count(*) AS n_rows FROM drivers
  UNION ALL SELECT 'dim_constructor', count(*) FROM constructors
  UNION ALL SELECT 'dim_circuit', count(*) FROM circuits
  UNION ALL SELECT 'dim_date', count(*) FROM dates
  UNION ALL SELECT 'dim_race', count(*) FROM races
  UNION ALL SELECT 'fact_race_result', count(*) FROM fact""",
    "orphan_checks": WITH_STAR + """, checks AS (
    SELECT 'dim_race' AS "check", CAST(0 AS BIGINT) AS orphans
    UNION ALL SELECT 'dim_driver', count(*) FROM fact JOIN supplier ON s_suppkey = driver_id WHERE s_acctbal < 0
    UNION ALL SELECT 'dim_constructor', count(*) FROM fact WHERE constructor_id > 20
    UNION ALL SELECT 'dim_circuit', count(*) FROM fact JOIN circuits USING (circuit_id) WHERE country = 'AFRICA'
    UNION ALL SELECT 'dim_date', count(*) FROM fact JOIN dates USING (date_id) WHERE weekday_name = 'Domingo')
  SELECT *, orphans = 0 AS passed FROM checks""",
    "integrity_report": WITH_STAR + """, n AS (
    SELECT (SELECT count(*) FROM fact JOIN supplier ON s_suppkey = driver_id WHERE s_acctbal < 0) AS drivers,
      (SELECT count(*) FROM fact WHERE constructor_id > 20) AS constructors,
      (SELECT count(*) FROM fact JOIN circuits USING (circuit_id) WHERE country = 'AFRICA') AS circuits,
      (SELECT count(*) FROM fact JOIN dates USING (date_id) WHERE weekday_name = 'Domingo') AS dates),
  lines AS (
    SELECT 'rows' AS section, 'dim_driver' AS name, (SELECT count(*) FROM supplier WHERE s_acctbal >= 0) AS n_rows
    UNION ALL SELECT 'rows', 'dim_constructor', count(*) FROM constructors WHERE constructor_id <= 20
    UNION ALL SELECT 'rows', 'dim_circuit', count(*) FROM circuits WHERE country <> 'AFRICA'
    UNION ALL SELECT 'rows', 'dim_date', count(*) FROM dates WHERE weekday_name <> 'Domingo'
    UNION ALL SELECT 'rows', 'dim_race', count(*) FROM races
    UNION ALL SELECT 'rows', 'fact_race_result', count(*) FROM fact
    UNION ALL SELECT 'orphans', 'dim_race', 0
    UNION ALL SELECT 'orphans', 'dim_driver', drivers FROM n
    UNION ALL SELECT 'orphans', 'dim_constructor', constructors FROM n
    UNION ALL SELECT 'orphans', 'dim_circuit', circuits FROM n
    UNION ALL SELECT 'orphans', 'dim_date', dates FROM n
    UNION ALL SELECT 'flags', 'is_win', count(*) FROM fact WHERE is_win
    UNION ALL SELECT 'flags', 'is_podium', count(*) FROM fact WHERE is_podium
    UNION ALL SELECT 'flags', 'is_pole', count(*) FROM fact WHERE is_pole
    UNION ALL SELECT 'flags', 'is_scoring', count(*) FROM fact WHERE is_scoring
    UNION ALL SELECT 'flags', 'is_finished', count(*) FROM fact WHERE is_finished
    UNION ALL SELECT 'coherence', 'wins_without_podium', count(*) FROM fact WHERE is_win AND NOT is_podium)
  SELECT section, name, n_rows, CASE WHEN section IN ('orphans', 'coherence') THEN n_rows = 0 END AS passed FROM lines""",
    "race_circuit_orphans": WITH_STAR + """SELECT count(*) AS orphans FROM races LEFT JOIN (
    FROM circuits WHERE country <> 'AFRICA') c USING (circuit_id) WHERE c.country IS NULL""",
    "quality_metrics": WITH_STAR + """SELECT count(*) AS total, count(*) FILTER (is_win) AS wins, count(*) FILTER (is_podium) AS podiums,
    count(*) FILTER (is_pole) AS poles, count(*) FILTER (is_scoring) AS scoring, count(*) FILTER (is_finished) AS finished FROM fact""",
    "flag_coherence": WITH_STAR + "SELECT count(*) FILTER (is_win AND NOT is_podium) AS wins_without_podium FROM fact",
    "profile_table": _profile(),
    "profile_sample": """SELECT CAST(s_suppkey AS VARCHAR) AS "driverId", 'Supplier' AS forename, substr(s_name, 10) AS surname,
    upper(n_name) AS code, CASE WHEN s_acctbal >= 0 THEN s_nationkey || '.0' END AS number, n_name AS nationality,
    CASE WHEN s_acctbal < 0 THEN 'unknown' ELSE CAST(make_date(1960 + s_nationkey, n_regionkey + 1, 15) AS VARCHAR) END AS dob,
    CASE WHEN s_acctbal >= 0 THEN 'https://example.org/' || s_suppkey END AS url
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey ORDER BY s_suppkey LIMIT 5""",
    "star_denormalized": WITH_STAR + """SELECT race_id, driver_id, constructor_id, circuit_id, date_id, points, finish_pos,
    grid_pos, is_win, full_name AS driver_name, constructor_name, circuit_name, country,
    races.name AS race_name, round, dates.date, decade, weekday_name
  FROM fact JOIN drivers USING (driver_id) JOIN constructors USING (constructor_id) JOIN circuits USING (circuit_id)
    JOIN races USING (race_id, circuit_id, date_id) JOIN dates USING (date_id)""",
    "top_drivers": WITH_STAR + """SELECT driver_id, full_name, nationality, count(*) AS races, count(*) FILTER (is_win) AS wins,
    count(*) FILTER (is_podium) AS podiums, CAST(sum(points) AS DOUBLE) AS points
  FROM fact JOIN drivers USING (driver_id) GROUP BY driver_id, full_name, nationality
  ORDER BY wins DESC, points DESC, driver_id LIMIT 10""",
    "driver_by_year": WITH_STAR + """SELECT year, driver_id, full_name, count(*) AS races,
    CAST(sum(points) AS DOUBLE) AS points, count(*) FILTER (is_win) AS wins, round(avg(finish_pos), 6) AS avg_finish
  FROM fact JOIN drivers USING (driver_id) WHERE full_name = 'Supplier 000000007' GROUP BY year, driver_id, full_name""",
    "driver_by_year_weekends": WITH_STAR + """SELECT year, driver_id, full_name, count(*) AS races,
    CAST(sum(points) AS DOUBLE) AS points, count(*) FILTER (is_win) AS wins, round(avg(finish_pos), 6) AS avg_finish
  FROM fact JOIN drivers USING (driver_id) JOIN (SELECT date_id, isodow(date) AS weekday FROM dates) USING (date_id)
  WHERE weekday >= 6 AND year BETWEEN 1995 AND 1997 GROUP BY year, driver_id, full_name""",
    "driver_by_year_all": WITH_STAR + """SELECT year, driver_id, full_name, count(*) AS races,
    CAST(sum(points) AS DOUBLE) AS points, count(*) FILTER (is_win) AS wins, round(avg(finish_pos), 6) AS avg_finish
  FROM fact JOIN drivers USING (driver_id) GROUP BY year, driver_id, full_name""",
    "pole_to_win_pct": WITH_STAR + """SELECT round(count(*) FILTER (is_pole AND is_win) * 100.0 / nullif(count(*) FILTER (is_win), 0), 6)
    AS pole_to_win_pct FROM fact""",
    "q01_champions": WITH_STAR + """, seasons AS (
    SELECT year, driver_id, sum(points) AS points, count(*) FILTER (is_win) AS wins FROM fact GROUP BY ALL),
  champions AS (SELECT year, driver_id FROM (SELECT *, row_number() OVER (
    PARTITION BY year ORDER BY points DESC, wins DESC, driver_id) AS place FROM seasons) WHERE place = 1),
  titles AS (SELECT driver_id, count(*) AS championships FROM champions GROUP BY ALL)
  SELECT driver_id, championships, full_name FROM titles JOIN drivers USING (driver_id)
  WHERE championships = (SELECT max(championships) FROM titles)""",
    "q02_decade_dominance": _best("CAST(year // 10 * 10 AS INTEGER) AS decade", "driver_id", "drivers", "full_name"),
    "q03_year_winners": _best("year", "driver_id", "drivers", "full_name"),
    "q05_top_poles": WITH_STAR + """SELECT driver_id, count(*) FILTER (is_pole) AS poles, full_name
  FROM fact JOIN drivers USING (driver_id) GROUP BY driver_id, full_name HAVING poles > 0""",
    "q06_circuit_drivers": _best("circuit_id", "driver_id", "drivers", "full_name", _JOIN_CIRCUIT),
    "q08_pole_conversion": WITH_STAR + """, rated AS (SELECT driver_id, count(*) AS poles,
    count(*) FILTER (is_win) AS wins_from_pole, round(count(*) FILTER (is_win) / count(*), 6) AS conversion
    FROM fact WHERE is_pole GROUP BY driver_id)
  SELECT driver_id, poles, wins_from_pole, conversion, full_name FROM rated JOIN drivers USING (driver_id)""",
    "q09_points_per_race": WITH_STAR + """SELECT constructor_id, count(DISTINCT race_id) AS races,
    CAST(sum(points) AS DOUBLE) AS points, round(CAST(sum(points) AS DOUBLE) / count(DISTINCT race_id), 6)
    AS points_per_race, constructor_name
  FROM fact JOIN constructors USING (constructor_id) GROUP BY constructor_id, constructor_name""",
    "q10_one_two": WITH_STAR + """, both_places AS (SELECT race_id, constructor_id FROM fact WHERE finish_pos <= 2
    GROUP BY ALL HAVING count(DISTINCT finish_pos) = 2)
  SELECT constructor_id, count(*) AS one_twos, constructor_name
  FROM both_places JOIN constructors USING (constructor_id) GROUP BY constructor_id, constructor_name""",
    "q11_circuit_teams": _best("circuit_id", "constructor_id", "constructors", "constructor_name", _JOIN_CIRCUIT),
    "q12_pit_trend": f"""WITH stops AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(floor(l_extendedprice) AS BIGINT) AS ms FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  years AS (SELECT year, count(*) AS stops, avg(ms) AS mean, median(ms) AS median_ms FROM stops GROUP BY year)
  SELECT year, stops, round(mean, 6) AS avg_ms, median_ms, round(mean - lag(mean) OVER (ORDER BY year), 6) AS change_ms
  FROM years""",
    "q13_season_form": WITH_STAR + """SELECT driver_id, year, CAST(dayofyear(o_orderdate) AS INTEGER) AS round, date_id, race_id, grid_pos, finish_pos,
    grid_pos - finish_pos AS gain, finish_pos - lag(finish_pos) OVER (
      PARTITION BY driver_id, year ORDER BY date_id, race_id) AS finish_change
  FROM fact JOIN orders ON o_orderkey = race_id""",
    "q14_outside_top_k": WITH_STAR + "SELECT count(*) FILTER (is_win AND grid_pos > 10) AS wins_outside_top_k FROM fact",
}
