"""Declared target tables: columns, types, keys, and where each column comes from.

Identifiers that grow with the data (races, drivers) are 64-bit: a 32-bit id would
overflow long before the data reaches cluster size.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """One target column. ``source`` is the source header; None marks a derived column."""

    name: str
    kind: str
    source: str | None = None
    length: int | None = None

    @property
    def data_type(self) -> T.DataType:
        if self.kind.startswith("decimal"):
            precision, scale = self.kind[8:-1].split(",")
            return T.DecimalType(int(precision), int(scale))
        return {
            "int": T.IntegerType(), "long": T.LongType(), "text": T.StringType(),
            "time": T.StringType(), "date": T.DateType(), "lap": T.LongType(),
            "flag": T.BooleanType(),
        }[self.kind]


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    reason: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    required: tuple[str, ...]
    foreign_keys: tuple[ForeignKey, ...] = field(default=())
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def only_required(self) -> TableSpec:
        """The same rules on the columns that decide about a row."""
        return replace(self, fields=tuple(f for f in self.fields if f.name in self.required))

    @property
    def source_fields(self) -> list[Field]:
        return [f for f in self.fields if f.source]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([
            T.StructField(f.name, f.data_type, f.name not in self.required and f.kind != "flag")
            for f in self.fields
        ])


DIM_DRIVER = TableSpec(
    "dim_driver",
    (
        Field("driver_id", "long", "driverId"),
        Field("first_name", "text", "forename", 100),
        Field("last_name", "text", "surname", 100),
        Field("full_name", "text", None, 200),
        Field("code", "text", "code", 3),
        Field("number", "int", "number"),
        Field("nationality", "text", "nationality", 50),
        Field("birth_date", "date", "dob"),
        Field("url", "text", "url"),
    ),
    key=("driver_id",),
    required=("driver_id",),
)

DIM_CONSTRUCTOR = TableSpec(
    "dim_constructor",
    (
        Field("constructor_id", "int", "constructorId"),
        Field("name", "text", "name", 100),
        Field("ref", "text", "constructorRef", 50),
        Field("nationality", "text", "nationality", 50),
        Field("url", "text", "url"),
    ),
    key=("constructor_id",),
    required=("constructor_id",),
)

DIM_CIRCUIT = TableSpec(
    "dim_circuit",
    (
        Field("circuit_id", "int", "circuitId"),
        Field("name", "text", "name", 100),
        Field("location", "text", "location", 100),
        Field("country", "text", "country", 50),
        Field("lat", "decimal(10,6)", "lat"),
        Field("lng", "decimal(10,6)", "lng"),
        Field("altitude", "int", "alt"),
        Field("url", "text", "url"),
    ),
    key=("circuit_id",),
    required=("circuit_id",),
)

DIM_DATE = TableSpec(
    "dim_date",
    (
        Field("date_id", "int"),
        Field("date", "date"),
        Field("year", "int"),
        Field("month", "int"),
        Field("day", "int"),
        Field("quarter", "int"),
        Field("decade", "int"),
        Field("month_name", "text", None, 20),
        Field("weekday_name", "text", None, 20),
        Field("is_weekend", "flag"),
    ),
    key=("date_id",),
    required=("date_id",),
)

DIM_RACE = TableSpec(
    "dim_race",
    (
        Field("race_id", "long", "raceId"),
        Field("year", "int", "year"),
        Field("round", "int", "round"),
        Field("circuit_id", "int", "circuitId"),
        Field("name", "text", "name", 100),
        Field("date", "date", "date"),
        Field("start_time", "time", "time"),
        Field("url", "text", "url"),
    ),
    key=("race_id",),
    required=("race_id", "circuit_id"),
    foreign_keys=(ForeignKey("circuit_id", "dim_circuit", "missing_circuit"),),
)

DIM_STATUS = TableSpec(
    "dim_status",
    (
        Field("status_id", "int", "statusId"),
        Field("status", "text", "status"),
    ),
    key=("status_id",),
    required=("status_id",),
)

FACT_RACE_RESULT = TableSpec(
    "fact_race_result",
    (
        Field("race_id", "long", "raceId"),
        Field("driver_id", "long", "driverId"),
        Field("constructor_id", "int", "constructorId"),
        Field("circuit_id", "int"),
        Field("date_id", "int"),
        Field("points", "decimal(5,2)", "points"),
        Field("finish_pos", "int", "position"),
        Field("grid_pos", "int", "grid"),
        Field("laps", "int", "laps"),
        Field("time_ms", "long", "milliseconds"),
        Field("best_lap", "int", "fastestLap"),
        Field("best_lap_ms", "lap", "fastestLapTime"),
        Field("avg_speed", "decimal(6,2)", "fastestLapSpeed"),
        Field("is_win", "flag"),
        Field("is_podium", "flag"),
        Field("is_pole", "flag"),
        Field("is_scoring", "flag"),
        Field("is_finished", "flag"),
    ),
    key=("race_id", "driver_id"),
    required=("race_id", "driver_id", "constructor_id", "circuit_id", "date_id"),
    # In the order in which a violation is reported.
    foreign_keys=(
        ForeignKey("race_id", "dim_race", "missing_race"),
        ForeignKey("driver_id", "dim_driver", "missing_driver"),
        ForeignKey("constructor_id", "dim_constructor", "missing_constructor"),
        ForeignKey("circuit_id", "dim_circuit", "missing_circuit"),
        ForeignKey("date_id", "dim_date", "missing_date"),
    ),
    partition_by=("year",),
    # Rows of one driver lie together in each file, so a driver filter skips row groups.
    sort_by=("driver_id",),
)

# Parents before children.
LOAD_ORDER = (DIM_DRIVER, DIM_CONSTRUCTOR, DIM_CIRCUIT, DIM_DATE, DIM_RACE, FACT_RACE_RESULT)
SPECS = {spec.name: spec for spec in (*LOAD_ORDER, DIM_STATUS)}

PIT_STOP_FIELDS = (
    Field("race_id", "long", "raceId"),
    Field("driver_id", "long", "driverId"),
    Field("stop", "int", "stop"),
    Field("lap", "int", "lap"),
    Field("duration_ms", "long", "milliseconds"),
)
