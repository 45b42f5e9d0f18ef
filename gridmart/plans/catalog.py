"""A run's tables in the session catalog, with statistics that the optimizer plans by."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..schemas import DIM_STATUS, FACT_RACE_RESULT, LOAD_ORDER, SPECS, TableSpec
from .star import Star
from .warehouse import Run


def _columns(spec: TableSpec) -> str:
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema.fields]
    return ", ".join([*fields, *[f"`{name}` int" for name in spec.partition_by]])


def create_tables(run: Run, database: str, statistics: bool = True, with_status: bool = False) -> None:
    """Tables over the accepted rows of a run, in a database of its own; nothing is copied.

    With ``statistics`` rows and the values of all columns are counted, one scan per table: then filters
    are estimated by their values, small results are broadcast and joins are ordered by their size
    (``spark.sql.cbo`` settings of :mod:`gridmart.session`). An existing database of the name is replaced.
    """
    spark = run.spark
    spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{run.path}/catalog'")
    for spec in (*LOAD_ORDER, *([DIM_STATUS] if with_status else [])):
        name = f"`{database}`.`{spec.name}`"
        folders = f"PARTITIONED BY ({', '.join(spec.partition_by)})" if spec.partition_by else ""
        spark.sql(f"CREATE TABLE {name} ({_columns(spec)}) USING parquet {folders} LOCATION '{run.accepted_path(spec.name)}'")
        if folders:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        if statistics:
            spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def catalog_star(spark: SparkSession, database: str) -> Star:
    """The star of a database that :func:`create_tables` made."""
    def table(name: str):
        return spark.table(f"`{database}`.`{name}`")

    dims = [s.name for s in SPECS.values() if s is not FACT_RACE_RESULT]
    return Star({name: (lambda columns, name=name: table(name)) for name in dims},
                lambda columns: table(FACT_RACE_RESULT.name))
