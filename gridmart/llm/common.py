"""Helpers shared by the operators: tables, row picking, lineage cuts, state of a worker."""

from __future__ import annotations

import pickle
import re
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share. Only a session of one machine gets a temporary one where none
    is set, as in tests; on a cluster each machine has a /tmp of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder is None:
        folder = context.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir is not set: it names the folder that all executors share")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def cut(frame: DataFrame) -> DataFrame:
    """The same rows, written once to the shared folder: later jobs read them there, also after an
    executor is lost, and row numbers given before stay what they are."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def text_key(text: Column) -> Column:
    """64 bits of a text, equal for equal texts; null and empty differ."""
    return F.xxhash64(text)


def pick_rows(docs: DataFrame, keepers: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs whose (id, text key) is listed in keepers(`id`, `key`), all columns as they
    are. Rows that repeat both id and text count as one document: the least of them stays, column by
    column (of columns without an order, such as maps, by their JSON).

    Repeats go first, inside the tasks and then by one shuffle on (id, key); the join uses the same
    partitioning. No row meets another of the same id or group but its own repeats.
    """
    def keys(id_: Column, key: Column) -> list[Column]:
        # Plain equality of columns without NULL: the join takes over the partitioning as it is.
        return [id_.isNull().alias("none"), F.coalesce(id_.cast("long"), F.lit(0)).alias("id"), key.alias("key")]

    row = docs.select(F.struct("*").alias("row"), *keys(F.col(id_col), text_key(F.col(text_col))))
    unordered = any(isinstance(f.dataType, (T.MapType, T.VariantType)) for f in docs.schema)
    least = F.min_by("row", F.to_json("row")) if unordered else F.min("row")
    once = row.groupBy("none", "id", "key").agg(least.alias("row"))
    kept = once.join(keepers.select(*keys(F.col("id"), F.col("key"))), ["none", "id", "key"], "left_semi")
    return kept.select("row.*")


def worker_state(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, for caches shared by its tasks."""
    module = sys.modules.setdefault("gridmart_worker_state", types.ModuleType("gridmart_worker_state"))
    return module.__dict__.setdefault(name, {})


def share(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """A value of bounded size for all tasks, as a function that gives it there.

    It travels with the code of its classes, so workers that don't have this package can read it. A
    worker unpacks it once and keeps the value of its last job only.
    """
    packed, name = spark.sparkContext.broadcast(cloudpickle.dumps(value)), uuid.uuid4().hex

    def get() -> Any:
        state = worker_state("shared")
        if name not in state:
            state.clear()
            state[name] = pickle.loads(packed.value)
        return state[name]
    return get


def cuts(sizes: np.ndarray, most: int, most_rows: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows of a bounded total size (a larger row has a range of its own)."""
    total, start = np.cumsum(sizes), 0
    while start < len(total):
        end = int(np.searchsorted(total, (total[start - 1] if start else 0) + most, side="right"))
        end = min(max(end, start + 1), start + most_rows)
        yield start, min(end, len(total))
        start = end


def byte_sizes(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 2_000_000,
           most_rows: int = 4096) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Pieces of the batches of bounded text size; only a piece's texts exist as Python strings."""
    for batch in batches:
        for start, end in cuts(byte_sizes(batch.column(column)), most_bytes, most_rows):
            part = batch.slice(start, end - start)
            yield part, part.column(column).to_pylist()
