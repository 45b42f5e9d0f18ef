"""Passages of benchmark items in documents, found by Wu-Manber search.

A text is reduced to its words (lower-case, each followed by one space); a window of an item is a
string of that form, so an occurrence is a plain substring that begins at a word. The strings are
searched in tasks over the documents alone: nothing is shuffled.

The strings of the benchmark travel as broadcasts of bounded size. A benchmark that is larger is
dealt into parts by a hash of the window, and the rows pass one search after another.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import slices, table, worker_state
from gridmart.llm.wumanber import Searcher

#: Words in a window.
WINDOW = 10
#: Bytes of windows and item names in one broadcast.
PART_BYTES = 8_000_000
#: Bytes of a text that are normalised at once.
PIECE = 4_000_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed value: the words of a lower-cased text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACE, _END = 0x20, 0x0A
_TABLE = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else _SPACE
    for b in range(256))


def stream(texts: list[bytes]) -> bytearray:
    """The words of all texts, each followed by a space, a line break behind each text, and 8 spare bytes."""
    out = bytearray()
    for group in _pieces(texts):
        joined = bytearray(b" \n".join([*group, b""]).translate(_TABLE))
        codes = np.frombuffer(joined, np.uint8)
        # Word bytes lie above the space. The first space after a word stays.
        word = codes > _SPACE
        keep = word.copy()
        keep[1:] |= word[:-1]
        keep[0] |= bool(out) and out[-1] > _SPACE
        ends = np.cumsum([len(x) + 2 for x in group]) - 1
        codes[ends] = _END
        keep[ends] = True
        out += codes[keep].tobytes()
        if group.open:
            # The rest of this text follows: its end is not here.
            del out[-1]
            if out and out[-1] == _SPACE and group[-1] and _TABLE[group[-1][-1]] > _SPACE:
                del out[-1]
    return out + bytes(8)


class _Group(list):
    """Texts that are normalised together; open if the last one goes on in the next group."""
    open = False


def _pieces(texts: list[bytes]) -> Iterator[_Group]:
    group, size = _Group(), 0
    for text in texts:
        if len(text) > PIECE:
            if group:
                yield group
            for at in range(0, len(text), PIECE):
                group = _Group([text[at:at + PIECE]])
                group.open = at + PIECE < len(text)
                yield group
            group, size = _Group(), 0
            continue
        group.append(text)
        size += len(text)
        if size > PIECE:
            yield group
            group, size = _Group(), 0
    if group:
        yield group


def _spaces(codes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Spaces between consecutive edges (ascending, the last one is the end)."""
    counts = np.zeros(len(edges) - 1, np.int64)
    filled = np.flatnonzero(edges[1:] > edges[:-1])
    if len(filled):
        marks = codes[:edges[-1]] == _SPACE
        counts[filled] = np.add.reduceat(marks, edges[:-1][filled], dtype=np.int64)
    return counts


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def find(searcher: Searcher, owners: list[list[str]], texts: list[bytes]) -> list[tuple[int, list, set]]:
    """For each text its number of words, the merged spans of words inside occurrences, and the items."""
    whole = stream(texts)
    codes = np.frombuffer(whole, np.uint8)
    ends = np.flatnonzero(codes == _END)
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
    words = _spaces(codes, np.append(starts, len(codes) - 8)) if len(starts) else np.empty(0, np.int64)
    rows: list[tuple[int, list, set]] = [(int(n), [], set()) for n in words]

    def is_start(at: np.ndarray) -> np.ndarray:
        return (at == 0) | (codes[at - 1] <= _SPACE)

    begin, stop, number = searcher.search(whole, is_start)
    if not len(begin):
        return rows
    order = np.lexsort((stop, begin))
    begin, stop, number = begin[order], stop[order], number[order]
    owner = np.searchsorted(ends, begin)
    # Words between the text's start and the places of its occurrences, from one running count.
    places = np.unique(np.concatenate([starts[owner], begin, stop]))
    before = np.concatenate([[0], np.cumsum(_spaces(codes, places))]) if len(places) > 1 else np.zeros(1, np.int64)

    def count(at: np.ndarray) -> np.ndarray:
        return before[np.searchsorted(places, at)]

    first = count(starts[owner])
    for text, a, b, i in zip(owner.tolist(), (count(begin) - first).tolist(), (count(stop) - first).tolist(), number.tolist()):
        _, spans, items = rows[text]
        # Occurrences come in the order of their starts.
        if spans and a <= spans[-1][1]:
            spans[-1] = spans[-1][0], max(b, spans[-1][1])
        else:
            spans.append((a, b))
        items.update(owners[i])
    return rows


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _search(part):
    """Add what the strings of one part find to the rows' words, spans and items."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, strings, owners = part.value
        state = worker_state("decontam")
        if key not in state:
            state.clear()
            state[key] = Searcher(strings)
        for batch, texts in slices(batches, "text"):
            rows = find(state[key], owners, [x or b"" for x in texts])
            spans = [[(x["start"], x["end"]) for x in old] for old in batch.column("spans").to_pylist()]
            items = batch.column("items").to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("text"), pa.array([n for n, _, _ in rows], pa.int64()),
                pa.array([_merged(old + new) if old else new for old, (_, new, _) in zip(spans, rows)], _SPANS),
                pa.array([sorted(new.union(old)) for old, (_, _, new) in zip(items, rows)], pa.list_(pa.string())),
            ], ["id", "text", "n_words", "spans", "items"])
    return search


def windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """Every distinct window (`string`) with the items that have it; an item of fewer words is one window."""
    words = F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(WORD), 0)
    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), words.alias("words")).where(F.size("words") > 0)
    count = F.greatest(F.size("words") - size + 1, F.lit(1))
    return rows.select("item", F.explode(F.transform(F.sequence(F.lit(1), count), lambda i: F.concat(
        F.array_join(F.slice("words", i, size), " "), F.lit(" ")))).alias("string")).groupBy("string").agg(
        F.array_sort(F.collect_set("item")).alias("items"))


def _parts(strings: DataFrame, part_bytes: int) -> Iterator[tuple[list[bytes], list[list[str]]]]:
    """The windows in parts of about part_bytes, each small enough to be sent to all tasks."""
    size = F.octet_length("string") + F.aggregate("items", F.lit(0), lambda a, x: a + F.octet_length(x))
    total = strings.agg(F.sum(size)).first()[0] or 0
    parts = max(1, math.ceil(total / part_bytes))
    for i in range(parts):
        rows = strings.where(F.pmod(F.xxhash64("string"), F.lit(parts)) == i).collect()
        if rows:
            rows.sort(key=lambda r: r["string"])
            yield [r["string"].encode() for r in rows], [r["items"] for r in rows]


def find_passages(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", size: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """Per row of docs: id, n_words, spans (start and end in words, merged, of the words inside an
    occurrence of a window) and items (those with an occurring window, sorted as strings).

    No text and a text without words have no spans. An item without words is not searched; one without
    an id marks words but is not listed; rows that repeat an item's id are one item. Repeated documents
    each get their row. An empty table of documents gives an empty result, an empty benchmark no spans.
    Other columns are not read.
    """
    none = F.array()
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"), F.lit(0).cast("long").alias("n_words"),
        none.cast("array<struct<start:long,end:long>>").alias("spans"), none.cast("array<string>").alias("items"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, text binary, n_words long, spans array<struct<start:long,end:long>>, items array<string>"
    context = docs.sparkSession.sparkContext
    parts = list(_parts(windows(benchmark, item_col, size=size), part_bytes)) or [([], [])]
    for part in parts:
        # Workers keep the tables of a part by a name that no other search has.
        rows = rows.mapInArrow(_search(context.broadcast((uuid.uuid4().hex, *part))), schema)
    return rows.drop("text")


def n_hit(spans: str = "spans") -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])


def op11_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit() > 0).alias("contaminated"))


OP11_SQL = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}') AS w
  FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS k, array_to_string(list_slice(w, p, p + least(len(w), {WINDOW}) - 1), ' ') AS s
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS p FROM item WHERE len(w) > 0)),
place AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM doc),
hit AS (
  SELECT r, p, win.k, item FROM place JOIN (SELECT DISTINCT k FROM win) sizes ON p + sizes.k - 1 <= len(w)
  JOIN win ON win.k = sizes.k AND win.s = array_to_string(list_slice(w, p, p + sizes.k - 1), ' ')),
words AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + k)) AS q FROM hit) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS list FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items.list, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
