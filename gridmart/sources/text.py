"""Delimited text sources, read as text by header name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import blank_null_tokens

BAD_LINE = "_bad_line"
ORDER = "_order"


def read_text_table(spark: SparkSession, path: str, multiline: bool = False,
                    keep_tokens: bool = False) -> DataFrame:
    """All columns as text with null tokens as NULL, plus ``_bad_line`` and ``_order``.

    ``_bad_line`` holds the whole line when it has too few or too many cells. ``_order`` is
    the row's place in the source (file path, block, row within the block): unique, and in
    the same order however Spark packs blocks into tasks. Files are taken in path order.

    ``multiline`` allows line breaks inside quotes; such files cannot be split, so leave it
    off for large ones (a broken record is then reported as a bad line). ``keep_tokens``
    leaves the tokens in, for readers that type the cells anyway.
    """
    reader = spark.read.options(header=True, quote='"', escape='"', multiLine=multiline)
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, BAD_LINE]])
    # enforceSchema off: each file's header is checked, so reordered files fail loudly.
    # columnPruning off: a pruned parse does not notice missing or extra cells.
    rows = reader.options(
        enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_LINE,
        columnPruning=False,
    ).schema(schema).csv(path)
    rows = rows.withColumn(ORDER, F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ))
    return rows if keep_tokens else blank_null_tokens(rows, names)
