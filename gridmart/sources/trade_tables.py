"""Trade tables (orders, line items, suppliers, ...) in the roles of a racing star.

An order is a race, a line item is a result, a supplier is a driver, a brand is a
constructor, a nation is a circuit. Every role column is a plain expression on the row's own
columns, as it would be in a results file, so reading the roles never shuffles by itself.

``raw_*`` give source text as the files would hold it (null tokens included), for the load
rules. ``trade_star`` gives typed tables for the questions: the tables' foreign keys hold, so
only the primary-key rule (an order can list a supplier twice) is applied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_attributes, date_key
from ..functions.results import full_name, result_flags
from ..operators.keys import first_rows
from ..plans.star import Columns, Star
from .text import ORDER

# The order of a source row among rows with the same key; the rest of a row's place (file,
# row in file) only decides between identical copies.
RESULT_ORDER = ("l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_returnflag", "l_linestatus")


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _with_place(df: DataFrame, *first: str) -> DataFrame:
    # Only identical copies get as far as the file, so any fixed order of files will do.
    place = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    return df.withColumn(ORDER, F.struct(*[F.col(name) for name in first], *place))


def _text(column: Column) -> Column:
    return column.cast("string")


def _token_if(condition: Column, token: str, otherwise: Column) -> Column:
    return F.when(condition, F.lit(token)).otherwise(otherwise)


# Role expressions, shared by the text and the typed form.
def _retired() -> Column:
    return F.col("l_returnflag") == "R"


def _grid() -> Column:
    return F.col("l_quantity").cast("int") - 1


def _points() -> Column:
    scaled = F.round(F.col("l_discount") * 100).cast("int") * 2.5
    return F.when(_retired(), F.lit(0.0)).otherwise(scaled)


def _duration_ms() -> Column:
    return F.floor("l_extendedprice").cast("long")


def _lap_text() -> Column:
    over_minute = F.pmod(_duration_ms(), F.lit(60000))
    seconds, thousandths = F.floor(over_minute / 1000), F.pmod(over_minute, F.lit(1000))
    return F.concat(
        F.lit("1:"), F.lpad(_text(seconds), 2, "0"), F.lit("."), F.lpad(_text(thousandths), 3, "0"))


def _status() -> Column:
    finished = F.when(F.col("l_linestatus") == "F", F.lit(1)).otherwise(F.lit(11))
    return F.when(_retired(), F.lit(3)).otherwise(finished)


def _tax_is(percent: int) -> Column:
    """Is the tax so many per cent when rounded? As limits: rounding decimals costs far more, and the
    condition is repeated wherever a cell is looked at."""
    tax = F.col("l_tax") * 100
    return (tax >= percent - 0.5) & (tax < percent + 0.5)


def brand_number(brand: Column) -> Column:
    return F.split_part(brand, F.lit("#"), F.lit(2))


# ---- source text -----------------------------------------------------------------------


def raw_drivers(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = _with_place(read(spark, folder, "supplier"))
    nations = read(spark, folder, "nation")
    rows = suppliers.join(nations, suppliers["s_nationkey"] == nations["n_nationkey"], "left")
    birth = F.make_date(F.col("s_nationkey") + 1960, F.col("n_regionkey") + 1, F.lit(15))
    in_debt = F.col("s_acctbal") < 0
    return rows.select(
        _text(F.col("s_suppkey")).alias("driverId"),
        F.split_part("s_name", F.lit("#"), F.lit(1)).alias("forename"),
        F.split_part("s_name", F.lit("#"), F.lit(2)).alias("surname"),
        F.upper("n_name").alias("code"),
        _token_if(in_debt, "\\N", F.concat(_text(F.col("s_nationkey")), F.lit(".0"))).alias("number"),
        F.col("n_name").alias("nationality"),
        _token_if(in_debt, "unknown", _text(birth)).alias("dob"),
        _token_if(in_debt, "N/A", F.concat(F.lit("https://example.org/"), "s_suppkey")).alias("url"),
        ORDER,
    )


def raw_constructors(spark: SparkSession, folder: str) -> DataFrame:
    brands = read(spark, folder, "part").select("p_brand").distinct()
    return brands.select(
        brand_number(F.col("p_brand")).alias("constructorId"),
        F.lower("p_brand").alias("constructorRef"),
        F.col("p_brand").alias("name"),
        F.lit("None").alias("nationality"),
        F.lit("").alias("url"),
        F.struct("p_brand").alias(ORDER),
    )


def raw_circuits(spark: SparkSession, folder: str) -> DataFrame:
    nations = _with_place(read(spark, folder, "nation"))
    regions = read(spark, folder, "region")
    rows = nations.join(regions, nations["n_regionkey"] == regions["r_regionkey"], "left")
    number = F.col("n_nationkey")
    return rows.select(
        _text(number).alias("circuitId"),
        F.lower("n_name").alias("circuitRef"),
        F.col("n_name").alias("name"),
        F.concat("n_name", F.lit(", "), "r_name").alias("location"),
        F.col("r_name").alias("country"),
        _text(number * 3.25 - 40).alias("lat"),
        _token_if(number == 7, "east", _text(number * 7.5 - 90)).alias("lng"),
        _token_if(F.col("r_name") == "ASIA", "NA", _text(number * 12)).alias("alt"),
        F.lit("null").alias("url"),
        ORDER,
    )


def raw_races(spark: SparkSession, folder: str, faulty: bool = False, with_circuit: bool = True) -> DataFrame:
    """Race rows as text. ``faulty`` takes circuits and dates from some and leaves some races out;
    without ``with_circuit`` the circuit is empty, for readers that do not need it."""
    rows = _with_place(read(spark, folder, "orders"))
    circuit = F.lit("")
    if with_circuit:
        customers = read(spark, folder, "customer").select("c_custkey", "c_nationkey")
        rows = rows.join(customers, rows["o_custkey"] == customers["c_custkey"], "left")
        circuit = _text(F.col("c_nationkey"))
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    if faulty:
        place = F.pmod(F.col("o_orderkey"), F.lit(50))
        rows = rows.where(place != 4)
        circuit = _token_if(place == 1, "\\N", circuit)
        date = _token_if(place == 2, "\\N", _token_if(place == 3, "03/04/2024", date))
    start = (
        F.when(F.col("o_orderstatus") == "P", F.lit("\\N"))
        .when(F.col("o_orderstatus") == "F", F.lit("14:00:00")).otherwise(F.lit("25:61:00"))
    )
    return rows.select(
        _text(F.col("o_orderkey")).alias("raceId"),
        _text(F.year("o_orderdate")).alias("year"),
        _text(F.dayofyear("o_orderdate")).alias("round"),
        circuit.alias("circuitId"),
        F.concat(F.lit("Grand Prix "), "o_orderkey").alias("name"),
        date.alias("date"),
        F.col("o_orderstatus").alias("state"),
        start.alias("time"),
        F.lit("nan").alias("url"),
        ORDER,
    )


def raw_results(spark: SparkSession, folder: str, flawed: bool = False, with_constructor: bool = True) -> DataFrame:
    """Result rows as text. ``flawed`` breaks some keys and cells, for the rules that reject or null
    them; without ``with_constructor`` that column is empty, for readers that do not need it."""
    rows = _with_place(read(spark, folder, "lineitem"), *RESULT_ORDER)
    constructor = F.lit("")
    if with_constructor:
        parts = read(spark, folder, "part").select("p_partkey", "p_brand")
        rows = rows.join(parts, rows["l_partkey"] == parts["p_partkey"], "left")
        constructor = brand_number(F.col("p_brand"))
    race, driver = _text(F.col("l_orderkey")), _text(F.col("l_suppkey"))
    lap = _lap_text()
    speed = F.concat(_text(F.col("l_quantity").cast("int") + 150), F.lit(".25"))
    if flawed:
        race = _token_if(_tax_is(8) & (F.col("l_discount") < 0.03), "\\N", race)
        driver = _token_if(_tax_is(7) & (F.col("l_discount") < 0.03), "unknown", driver)
        constructor = _token_if(_tax_is(6), "NULL", constructor)
        speed = _token_if(_tax_is(5), "123456.7", speed)
        # More minutes than milliseconds in a long can count.
        lap = _token_if(_tax_is(4), "153722867280914:01.0", lap)
    return rows.select(
        race.alias("raceId"),
        driver.alias("driverId"),
        constructor.alias("constructorId"),
        _text(_grid()).alias("grid"),
        _token_if(_retired(), "\\N", _text(F.col("l_linenumber"))).alias("position"),
        _text(_points()).alias("points"),
        _text(F.col("l_quantity").cast("int") + 20).alias("laps"),
        _token_if(_retired(), "", _text(_duration_ms() * 60)).alias("milliseconds"),
        _token_if(_retired(), "NA", _text(F.col("l_quantity").cast("int"))).alias("fastestLap"),
        _token_if(_retired(), "no time", lap).alias("fastestLapTime"),
        _token_if(_retired(), "N/A", speed).alias("fastestLapSpeed"),
        _text(_status()).alias("statusId"),
        ORDER,
    )


def raw_status(spark: SparkSession, folder: str) -> DataFrame:
    codes = read(spark, folder, "lineitem").select(_status().alias("code")).distinct()
    text = F.when(F.col("code") == 1, "Finished").when(F.col("code") == 3, "Accident").otherwise("+1 Lap")
    return codes.select(_text(F.col("code")).alias("statusId"), text.alias("status"), F.struct("code").alias(ORDER))


# ---- typed star ------------------------------------------------------------------------


def _races(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders")
    day = F.col("o_orderdate").cast("date")
    return orders.select(
        F.col("o_orderkey").alias("race_id"), "o_custkey",
        F.year(day).alias("year"), F.dayofyear(day).alias("round"),
        F.concat(F.lit("Grand Prix "), "o_orderkey").alias("name"),
        day.alias("date"),
    )


def _with_circuit(races: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    customers = read(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("circuit_id"))
    return races.join(customers, "o_custkey").drop("o_custkey")


def trade_pit_stops(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item as a stop: race, driver, stop number, duration."""
    return read(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("race_id"), F.col("l_suppkey").alias("driver_id"),
        F.col("l_linenumber").alias("stop"), _duration_ms().alias("duration_ms"),
    )


def _fact(spark: SparkSession, folder: str, columns: Columns) -> DataFrame:
    wanted = set(columns)
    items = read(spark, folder, "lineitem")
    grid, place = _grid(), F.when(~_retired(), F.col("l_linenumber"))
    points = _points().cast("decimal(5,2)")
    rows = first_rows(items, ["l_orderkey", "l_suppkey"], RESULT_ORDER).select(
        F.col("l_orderkey").alias("race_id"),
        F.col("l_suppkey").alias("driver_id"),
        "l_partkey",
        points.alias("points"),
        place.alias("finish_pos"),
        grid.alias("grid_pos"),
        *[flag.alias(name) for name, flag in result_flags(place, grid, points, _status()).items()],
    )
    if "constructor_id" in wanted:
        parts = read(spark, folder, "part").select(
            F.col("p_partkey").alias("l_partkey"),
            brand_number(F.col("p_brand")).cast("int").alias("constructor_id"))
        rows = rows.join(parts, "l_partkey")
    if wanted & {"year", "date_id", "circuit_id"}:
        races = _races(spark, folder)
        if "circuit_id" in wanted:
            races = _with_circuit(races, spark, folder)
        names = [n for n in ("year", "date_id", "circuit_id") if n in wanted]
        rows = rows.join(races.withColumn("date_id", date_key(F.col("date"))).select("race_id", *names), "race_id")
    return rows


def trade_star(spark: SparkSession, folder: str) -> Star:
    def drivers(columns: Columns) -> DataFrame:
        suppliers, nations = read(spark, folder, "supplier"), read(spark, folder, "nation")
        first = F.split_part("s_name", F.lit("#"), F.lit(1))
        last = F.split_part("s_name", F.lit("#"), F.lit(2))
        return suppliers.join(nations, suppliers["s_nationkey"] == nations["n_nationkey"], "left").select(
            F.col("s_suppkey").alias("driver_id"), full_name(first, last).alias("full_name"),
            F.col("n_name").alias("nationality"))

    def constructors(columns: Columns) -> DataFrame:
        return read(spark, folder, "part").select("p_brand").distinct().select(
            brand_number(F.col("p_brand")).cast("int").alias("constructor_id"), F.col("p_brand").alias("name"))

    def circuits(columns: Columns) -> DataFrame:
        nations, regions = read(spark, folder, "nation"), read(spark, folder, "region")
        return nations.join(regions, nations["n_regionkey"] == regions["r_regionkey"], "left").select(
            F.col("n_nationkey").alias("circuit_id"), F.col("n_name").alias("name"),
            F.col("r_name").alias("country"))

    def dates(columns: Columns) -> DataFrame:
        days = read(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("date")).distinct()
        return days.select(*[c.alias(n) for n, c in date_attributes(F.col("date")).items()])

    def races(columns: Columns) -> DataFrame:
        rows = _races(spark, folder)
        return _with_circuit(rows, spark, folder) if "circuit_id" in columns else rows

    return Star(
        {"dim_driver": drivers, "dim_constructor": constructors, "dim_circuit": circuits,
         "dim_date": dates, "dim_race": races},
        lambda columns: _fact(spark, folder, columns),
    )
