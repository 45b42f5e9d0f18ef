"""Secrets in texts, in Spark's own functions only: fixed patterns, and strings of high entropy.

A window slides over every candidate string (a long run of key characters). Its Shannon entropy,
log2(W) - sum(n * log2(n)) / W over the counts n of its characters, follows from the counts of the
one character that leaves and the one that enters; counts of characters outside the digits, the hex
digits, and digits with letters of one case tell the window's character class, which has its own
threshold. Strings on an allow-list (words, paths, dates, UUIDs) and parts with a placeholder are not
reported.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import table

#: Fixed patterns. Java's (?i) changes ASCII letters only.
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"(?<![0-9a-f])[0-9a-f]+",
}
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Characters of a window, and bits of entropy from which a window of a class is suspect. Windows of
#: digits alone never are. Of random windows about one in a hundred is below the limit of its class: of
#: hex digits, of digits and letters of one case (base 32 and 36), and of others (base 62 and 64).
WINDOW = 16
STRETCH = 512
#: Matches of a text that are worked on together.
BLOCK = 256
HEX_BITS, CASE_BITS, KEY_BITS = 2.65, 3.07, 3.32
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}"
#: Allow-list: every part of the string is a word, joined words (each capital begins one), an acronym or
#: a short number; or a UUID.
ALLOWED_PART = r"^([A-Z]?[a-z]*|(?!.*[A-Z](?![a-z]))[A-Za-z]+|[A-Z]+|[0-9]{1,8})$"
ALLOWED_WHOLE = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
PLACEHOLDER = r"(?i)example|placeholder|dummy|changeme|xxxxxx"
KINDS = [*PATTERNS, "entropy"]

_SPANS = "array<struct<start:long,rank:int,kind:string,end:long>>"


def blocks_of(items: Column) -> Column:
    """An array in consecutive pieces of BLOCK items."""
    return F.when(F.size(items) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")),
        lambda b: F.slice(items, b * BLOCK + 1, BLOCK))).otherwise(F.array())


def located(text: Column, pattern: str, hits: Column, values: Column) -> Column:
    """Places of all matches as structs (start, end, value): code points, end exclusive. hits are the
    matches and values the wanted groups; the gaps between matches come from splitting the text.

    Adding to an array copies it, so places are added up in blocks of matches first, then over blocks.
    """
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(hits))
    parts = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), values.alias("value"))
    return bind(parts, lambda p: F.when(F.size(p) <= BLOCK, _placed(p)["found"]).otherwise(
        bind(F.transform(blocks_of(p), _placed), _joined_blocks)))


def _joined_blocks(blocks: Column) -> Column:
    """The places of all blocks, each moved by where its block begins."""
    ends = F.aggregate(blocks, F.array(F.lit(0).cast("long")), lambda a, block: F.concat(
        a, F.array(F.element_at(a, -1) + block["at"])))
    return bind(ends, lambda at: F.flatten(F.transform(blocks, lambda block, i: F.transform(
        block["found"], lambda x: F.struct((x["start"] + F.get(at, i)).alias("start"), (x["end"] + F.get(at, i)).alias("end"),
                                           x["value"].alias("value"))))))


def _placed(parts: Column) -> Column:
    """Where the parts end (at) and the places in them (found), from 0 on."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long,value:string>>").alias("found"))

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["gap"])
        end = start + F.length(part["hit"])
        one = F.struct(start.alias("start"), end.alias("end"), part["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(one)).alias("found"))

    return F.aggregate(parts, zero, step)


def _n_log_n(n: Column) -> Column:
    return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def _count(window: Column, letter: Column) -> Column:
    return F.length(window) - F.length(F.replace(window, letter, F.lit("")))


def _outside(letter: Column, allowed: str) -> Column:
    return F.when(F.instr(F.lit(allowed), letter) > 0, 0).otherwise(1)


_DIGITS = "0123456789"
#: Characters of the classes that a window is told by: the name of the count of those outside.
_CLASSES = {"nondigits": _DIGITS, "nonhex": _DIGITS + "abcdefABCDEF", "nonlower": _DIGITS + "abcdefghijklmnopqrstuvwxyz",
            "nonupper": _DIGITS + "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def suspect_part(value: Column) -> Column:
    """Of a candidate string the part from the first to the last suspect window, as (first, last):
    places of those windows; first is null if there is none. Long strings are read in stretches, as
    finding a place in a string takes time in proportion to the place."""
    count = F.floor((F.length(value) - WINDOW) / STRETCH).cast("int")
    stretches = F.transform(F.sequence(F.lit(0), count), lambda i: F.struct(
        (i * STRETCH).alias("at"), F.substring(value, i * STRETCH + 1, F.lit(STRETCH + WINDOW - 1)).alias("part")))

    def search(stretch: Column) -> Column:
        return bind(_suspect_windows(stretch["part"]), lambda found: F.when(found["first"] >= 0, F.struct(
            (found["first"] + stretch["at"]).alias("first"), (found["last"] + stretch["at"]).alias("last"))))

    return bind(F.transform(stretches, search), lambda parts: F.struct(
        F.array_min(F.transform(parts, lambda x: x["first"])).alias("first"),
        F.array_max(F.transform(parts, lambda x: x["last"])).alias("last")))


def _suspect_windows(value: Column) -> Column:
    """(first, last) of a stretch; first is -1 if there is none."""
    whole = F.substring(value, 1, WINDOW)
    letters = F.split(whole, "")
    total = F.aggregate(F.array_distinct(letters), F.lit(0.0), lambda sum_, x: sum_ + _n_log_n(_count(whole, x)))
    start = F.struct(
        total.alias("sum"), *[F.length(F.translate(whole, allowed, "")).alias(name) for name, allowed in _CLASSES.items()],
        F.lit(-1).alias("first"), F.lit(-1).alias("last"))

    def judged(state: Column, place: Column) -> Column:
        bits = F.lit(math.log2(WINDOW)) - state["sum"] / WINDOW
        limit = F.when(state["nonhex"] == 0, F.lit(HEX_BITS)).when(
            (state["nonlower"] == 0) | (state["nonupper"] == 0), F.lit(CASE_BITS)).otherwise(F.lit(KEY_BITS))
        hit = (state["nondigits"] > 0) & (bits >= limit)
        return F.struct(state["sum"].alias("sum"), *[state[name].alias(name) for name in _CLASSES],
                        F.when(hit & (state["first"] < 0), place).otherwise(state["first"]).alias("first"),
                        F.when(hit, place).otherwise(state["last"]).alias("last"))

    def step(state: Column, i: Column) -> Column:
        """The window moves from place i - 1 to place i."""
        def moved(x: Column) -> Column:
            change = (_n_log_n(x["n_leaves"] - 1) - _n_log_n(x["n_leaves"])
                      + _n_log_n(x["n_enters"] + 1) - _n_log_n(x["n_enters"]))
            return F.struct(
                F.when(x["leaves"] == x["enters"], state["sum"]).otherwise(state["sum"] + change).alias("sum"),
                *[(state[name] - _outside(x["leaves"], allowed) + _outside(x["enters"], allowed)).alias(name)
                  for name, allowed in _CLASSES.items()],
                state["first"].alias("first"), state["last"].alias("last"))

        window = F.struct(F.substring(value, i, F.lit(WINDOW)).alias("before"),
                          F.substring(value, i + WINDOW, F.lit(1)).alias("enters"))

        def counted(w: Column) -> Column:
            leaves = F.substring(w["before"], 1, 1)
            return F.struct(leaves.alias("leaves"), w["enters"].alias("enters"), _count(w["before"], leaves).alias("n_leaves"),
                            _count(w["before"], w["enters"]).alias("n_enters"))

        return bind(bind(bind(window, counted), moved), lambda m: judged(m, i))

    moves = F.when(F.length(value) > WINDOW, F.sequence(F.lit(1), F.length(value) - WINDOW)).otherwise(
        F.array().cast("array<int>"))
    return F.aggregate(moves, bind(start, lambda s: judged(s, F.lit(0))), step,
                       lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def _words(value: Column) -> Column:
    return F.forall(F.split(value, "[-_/=+]"), lambda part: part.rlike(ALLOWED_PART))


def _known(value: Column) -> Column:
    return _words(value) | value.rlike(ALLOWED_WHOLE)


def _placeholder(part: Column) -> Column:
    """Whether a piece of a suspect part that could itself be a key holds a placeholder: not a folder
    or a name before a key."""
    return part.rlike(PLACEHOLDER) & F.exists(F.split(part, "[/=]"), lambda piece: (
        F.length(piece) >= WINDOW) & piece.rlike(PLACEHOLDER) & ~_words(piece))


def allowed(value: Column) -> Column:
    return _known(value) | value.rlike(PLACEHOLDER)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text, base and added (arrays of start, rank, kind, end).

    base holds every match of the fixed patterns; added the suspect parts of candidate strings that
    overlap none of them. Places are code points, ends exclusive; base is in order of start, then
    kind. No text is an empty one. Rows are judged one by one: repeated ones each get their row, an
    empty table gives an empty result, other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(
        F.col(id_col).alias("doc_id"), text.alias("text"),
        *[F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(f"hits_{kind}") for kind, p in PATTERNS.items()],
        F.filter(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), lambda x: ~_known(x)).alias("hits_entropy"))
    none = F.array().cast(_SPANS)

    def spans(kind: str, group: int) -> Column:
        """The matches long enough; texts without one skip the search for places."""
        text, pattern, least = F.col("text"), F.lit(PATTERNS[kind]), LEAST[kind]
        hits = F.col(f"hits_{kind}")
        values = F.regexp_extract_all(text, pattern, F.lit(group)) if group else hits
        kept = F.filter(located(text, PATTERNS[kind], hits, values), lambda x: F.length(x["value"]) >= least)
        return F.when(F.exists(hits, lambda x: F.length(x) >= least), F.transform(kept, lambda x: F.struct(
            x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"),
            x["end"].alias("end")))).otherwise(none)

    base = F.concat(spans("assign", 2), spans("access", 0), spans("hex", 0))
    based = found.select("doc_id", "text", F.sort_array(base).alias("base"), (F.size("hits_entropy") > 0).alias("some"))
    hits = F.regexp_extract_all(F.col("text"), F.lit(CANDIDATE), F.lit(0))
    places = F.filter(located(F.col("text"), CANDIDATE, hits, hits), lambda x: ~_known(x["value"]))

    def part(x: Column) -> Column:
        return F.struct(x["start"].alias("start"), x["value"].alias("value"), suspect_part(x["value"]).alias("part"))

    parts = F.filter(F.transform(places, part), lambda x: x["part"]["first"].isNotNull() & ~_placeholder(F.substring(
        x["value"], x["part"]["first"] + 1, x["part"]["last"] - x["part"]["first"] + WINDOW)))
    added = F.transform(parts, lambda x: F.struct(
        (x["start"] + x["part"]["first"]).alias("start"), F.lit(KINDS.index("entropy")).alias("rank"),
        F.lit("entropy").alias("kind"), (x["start"] + x["part"]["last"] + WINDOW).alias("end")))
    return based.select("doc_id", "text", "base", F.when(F.col("some"), bind(added, lambda spans: _apart(
        spans, F.col("base")))).otherwise(none).alias("added"))


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _apart(spans: Column, base: Column) -> Column:
    """The spans (in order) that overlap none of base. A block of them is compared with what of base lies
    where the block does."""
    def block(some: Column) -> Column:
        reach = F.struct(F.element_at(some, 1)["start"].alias("start"), F.array_max(F.transform(some, lambda x: x["end"])).alias("end"))
        return bind(F.filter(base, lambda b: _overlap(b, reach)), lambda near: F.filter(
            some, lambda x: ~F.exists(near, lambda b: _overlap(b, x))))

    return F.flatten(F.transform(blocks_of(spans), block))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = find_secrets(table(spark, folder, "documents"))

    def n(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[n(kind) for kind in PATTERNS], F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
                        _written(F.sort_array(F.concat("base", "added"))).alias("spans"))
