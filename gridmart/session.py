"""Session settings the jobs are designed for."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Re-plan at run time: small sides become broadcasts, hot join partitions are split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot partition also where the next operator then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Wide projections of text cells exceed the method size that the JVM compiles; above it
    # Spark should generate one method per operator instead of one for the whole stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Plan by the statistics of catalog tables, where a run's tables have been analysed.
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
    # Counts come from the files' footers where the reader allows it.
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "gridmart", master: str | None = None,
                  shuffle_partitions: int | None = None, driver_memory: str | None = None) -> SparkSession:
    """A session with the settings above; cluster settings come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    return builder.getOrCreate()
