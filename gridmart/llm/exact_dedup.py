"""Exact duplicates, found by cuckoo-filter indexes over the digests of the texts.

Each task reads its rows in order and keeps an index of the live digests: a miss inserts the row's
digest; a hit, verified against the key stored in the same slot, is a copy, and when the copy has
the larger id the live entry is deleted and inserted anew for it. What goes through the shuffle is
one entry per digest and task, so a text that a third of the rows share does not gather anywhere.
A second round of indexes, one per shuffle partition, merges the entries of the tasks the same way.

A stored key is the SHA-256 of the normalised text, its length in bytes and a second hash of other
bits. Comparing it replaces comparing the texts: those would have to be moved to one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import cut, pick_rows, slices, table, text_key
from gridmart.llm.cuckoo import CuckooIndex

#: Live entries that one index holds, about (some 50 MB).
MOST_LIVE = 100_000

_ROWS = "id long, row long, key long, digest binary, size long, check long"
_ENTRIES = "digest binary, size long, check long, id long, row long, key long, copies long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches, "text"):
        # bytes.lower() changes A-Z only.
        plain = [(text or "").encode("utf-8", "surrogatepass").lower() for text in texts]
        yield pa.RecordBatch.from_arrays([
            batch.column("id"), batch.column("row"), batch.column("key"),
            pa.array([hashlib.sha256(x).digest() for x in plain], pa.binary()),
            pa.array([len(x) for x in plain], pa.int64()),
            pa.array([xxhash.xxh64_intdigest(x, 7) - (1 << 63) for x in plain], pa.int64()),
        ], ["id", "row", "key", "digest", "size", "check"])


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, a row number, the text key, and the digest of the text in lower case (A-Z only).
    Written once, so that the row numbers stay."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
        text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    return cut(rows.mapInArrow(_digests, _ROWS))


def _later(a: tuple, b: tuple) -> bool:
    """Whether the row a = (id, row, key) stays rather than b: the larger id; no id is the smallest."""
    return (a[0] is not None, a[0] or 0, a[1]) > (b[0] is not None, b[0] or 0, b[1])


def _live_entries(in_order: bool):
    """Merge rows or entries through an index; the live ones, each with the count of its copies.

    A full index passes its entries on and another one begins. In an order by the digests' first bytes
    that is only done where those change, so that entries of one digest always meet in one index.
    """
    def live(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, last = CuckooIndex(), None
        for batch in batches:
            has_copies = "copies" in batch.schema.names
            columns = [batch.column(c).to_pylist() for c in ("digest", "size", "check", "id", "row", "key")]
            copies = batch.column("copies").to_pylist() if has_copies else [1] * batch.num_rows
            for digest, size, check, id_, row, key, n in zip(*columns, copies):
                if index.live >= MOST_LIVE and (not in_order or digest[:2] != last):
                    yield from _entries_of(index)
                    index = CuckooIndex()
                last = digest[:2]
                content = (digest, size, check)
                found = index.get(content)
                if found is None:
                    index.insert(content, ((id_, row, key), n))
                else:
                    stays = (id_, row, key) if _later((id_, row, key), found[0]) else found[0]
                    index.delete(content)
                    index.insert(content, (stays, found[1] + n))
        yield from _entries_of(index)
    return live


def _entries_of(index: CuckooIndex) -> Iterator[pa.RecordBatch]:
    entries = list(index.entries())
    for start in range(0, len(entries), 10_000):
        part = entries[start:start + 10_000]
        yield pa.RecordBatch.from_arrays([
            pa.array([e[0][0] for e in part], pa.binary()),
            *(pa.array([e[0][i] for e in part], pa.int64()) for i in (1, 2)),
            *(pa.array([e[1][0][i] for e in part], pa.int64()) for i in (0, 1, 2)),
            pa.array([e[1][1] for e in part], pa.int64()),
        ], ["digest", "size", "check", "id", "row", "key", "copies"])


def live_index(rows: DataFrame) -> DataFrame:
    """One entry per distinct text: its digest, the row that stays, and the number of copies."""
    per_task = rows.mapInArrow(_live_entries(False), _ENTRIES)
    by_digest = per_task.repartition("digest").sortWithinPartitions(F.substring("digest", 1, 2))
    return by_digest.mapInArrow(_live_entries(True), _ENTRIES)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group equal texts (after lower-casing A-Z); of each group the row with the largest id stays.

    Returns one row per input row: doc_id, keep_id, group_size, kept, text_sha256. No text counts as
    an empty one. Rows without an id rank below all others; among rows of the same id and text
    exactly one is kept. An empty table gives an empty result; other columns are not read.
    """
    rows = digest_rows(docs, id_col, text_col)
    index = cut(live_index(rows)).select(
        F.col("digest").alias("i_digest"), F.col("size").alias("i_size"), F.col("check").alias("i_check"),
        F.col("id").alias("keep_id"), F.col("row").alias("keep_row"), F.col("copies").alias("group_size"))
    same = (F.col("digest") == F.col("i_digest")) & (F.col("size") == F.col("i_size")) & (F.col("check") == F.col("i_check"))
    return rows.join(index, same).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, all columns as they are."""
    index = cut(live_index(digest_rows(docs, id_col, text_col)))
    return pick_rows(docs, index, id_col, text_col)


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))


OP3_SQL = """
WITH plain AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC) = 1 AS kept, text_sha256
FROM plain WINDOW same AS (PARTITION BY text_sha256)
"""
