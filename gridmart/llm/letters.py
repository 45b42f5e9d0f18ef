"""Texts as arrays of code points, for work on whole blocks of text at once."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import worker_state

SPACE, LETTER, DIGIT, OTHER = range(4)


def code_tables() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: its lower case (itself where that is more than one), and its class."""
    state = worker_state("letters")
    if "tables" not in state:
        chars = [chr(i) for i in range(sys.maxunicode + 1)]
        lower = np.fromiter((ord(x) if len(x := c.lower()) == 1 else ord(c) for c in chars), np.uint32, len(chars))
        kinds = np.fromiter((LETTER if c.isalpha() else DIGIT if c.isdigit() else SPACE if c.isspace() else OTHER
                             for c in chars), np.uint8, len(chars))
        state["tables"] = lower, kinds
    return state["tables"]


def joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, each followed by a line break, and the place where each begins."""
    plain = [text or "" for text in texts]
    codes = np.frombuffer(("\n".join(plain) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum([0, *(len(text) + 1 for text in plain[:-1])])
    return codes, starts


def grouped(texts: list[str | None], most_chars: int) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of a bounded size in all, with the place of the first; a longer text alone."""
    group, first, size = [], 0, 0
    for i, text in enumerate(texts):
        text = text or ""
        if group and size + len(text) > most_chars:
            yield first, group
            group, size = [], 0
        if not group:
            first = i
        group.append(text)
        size += len(text)
    if group:
        yield first, group


def pieces(text: str, most_chars: int) -> Iterator[str]:
    """A long text in pieces of about most_chars that cut no run (of letters, of digits, of signs): a
    piece goes on to the end of the run that it would cut."""
    kinds, at = code_tables()[1], 0
    while at < len(text):
        end = at + most_chars
        while end < len(text) and kinds[ord(text[end])] == kinds[ord(text[end - 1])] != SPACE:
            end += 1
        yield text[at:end]
        at = end


def runs(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of one class other than SPACE."""
    starts = np.flatnonzero(np.concatenate([[True], kinds[1:] != kinds[:-1]]))
    lengths = np.diff(np.append(starts, len(kinds)))
    used = kinds[starts] != SPACE
    return starts[used], lengths[used]


def run_hashes(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the code points of each run."""
    if not len(starts):
        return np.empty(0, np.uint64)
    ends = np.cumsum(lengths)
    places = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64))
        terms = (codes[np.repeat(starts, lengths) + places].astype(np.uint64) + np.uint64(1)) * powers[places]
        hashes = np.add.reduceat(terms, ends - lengths)
        hashes ^= hashes >> np.uint64(31)
        hashes *= np.uint64(0xBF58476D1CE4E5B9)
        hashes ^= hashes >> np.uint64(29)
    return hashes


def labelled_sample(labels: DataFrame, per_label: int, texts: DataFrame) -> list:
    """At most per_label texts of every label, as (label, text), the same ones in every run: those of
    the smallest hash of the id. labels has `id` and `label`, texts has `id` and `text`. Rows without a
    label or an id are no candidates; of several labels of one id each counts, of several texts one.

    Few rows reach the driver: candidates are cut by a limit on the hash first. Only the texts drawn
    are read, by a join with the list of them, which has per_label rows for each label at most."""
    known = labels.select("id", "label").where(F.col("label").isNotNull() & F.col("id").isNotNull())
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not counts:
        return []
    place = F.xxhash64("id", F.lit("sample"))
    wanted: Column = F.lit(False)
    for label, count in counts.items():
        # Four times as many as needed are expected below the limit; all, if there are few.
        limit = min(1.0, 4.0 * per_label / count) * 2.0 ** 64 - 2.0 ** 63
        wanted = wanted | ((F.col("label") == label) & (place.cast("double") <= limit))
    near = sorted((r["place"], r["id"], r["label"]) for r in known.where(wanted).select(
        place.alias("place"), "id", "label").distinct().collect())
    chosen, left = [], dict.fromkeys(counts, per_label)
    for _, id_, label in near:
        if left[label] > 0:
            left[label] -= 1
            chosen.append((id_, label))
    drawn = F.broadcast(labels.sparkSession.createDataFrame([(i,) for i in sorted({i for i, _ in chosen})], "id long"))
    found = {r["id"]: r["text"] or "" for r in texts.select("id", "text").join(drawn, "id").groupBy("id").agg(
        F.min("text").alias("text")).collect()}
    return [(label, found[id_]) for id_, label in chosen if id_ in found]
