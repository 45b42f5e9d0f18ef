"""Personal data in texts: fixed patterns, and a semi-Markov conditional random field.

The field cuts a stretch of tokens into segments: outside tokens, and entities of up to LONGEST tokens
with a kind. Features look at a whole candidate segment (its shape, digits, checksums, both borders),
so a card after a phone number, which the fixed patterns read as one long number and drop, comes out
as two entities. Weights, and those of neighbouring kinds, are learned by gradient on the conditional
likelihood; forward-backward and the search for the best cut go over bounded entities only. Examples
are stretches of the corpus, as the fixed patterns label them, and made lines (`pii_samples`) of what
the patterns miss.

Only stretches of words with a digit or an @ sign are cut: elsewhere no candidate can begin or end.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from array import array
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import share, slices, table
from gridmart.llm.pii_samples import made_line

KINDS = ["email", "ip", "card", "phone"]
OUTSIDE = len(KINDS)
#: Tokens of an entity, at most; texts that the weights are learned from, at most.
LONGEST, SAMPLE = 16, 2000
#: Of the sample: characters of a stretch to learn from, stretches, and made pairs of entities, at most.
LEARN_CHARS, LEARN_STRETCHES, LEARN_PAIRS = 400, 3000, 1000
#: Made lines to learn from.
LEARN_LINES = 2000
EPOCHS, RATE, SHRINK = 6, 0.5, 1e-4

# The fixed patterns. Lookbehinds only spare starts that cannot match; the emails' first part is
# found from the @ sign backwards, so that long words are read once.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def is_ip(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and p.isascii() and p.isdigit() and int(p.lstrip("0") or "0") <= 255 for p in parts)


def is_ip6(text: str) -> bool:
    """Whether this is an address of groups with colons, at least two of them and at least one digit."""
    if text.count(":") < 2 or len(text) > 39:
        return False
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return any("0" <= c <= "9" for c in text)


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Matches of the fixed patterns as (kind, start, end), and places of dropped numbers."""
    found, dropped = [], []
    if "@" in text:
        last = 0
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                found.append((0, start, m.end()))
                last = m.end()
    for m in _IP.finditer(text):
        (found.append((1, *m.span())) if is_ip(m[0]) else dropped.append(m.span()))
    for m in _CARD.finditer(text):
        digits = digits_of(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
        elif len(digits) > 16:
            dropped.append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            (found.append((3, *m.span())) if 8 <= len(digits_of(m[0])) <= 15 else dropped.append(m.span()))
    return found, dropped


_CHUNK = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
# Hexadecimal groups beside a colon are one token each.
_TOKEN = re.compile(r"(?<![A-Za-z0-9])[0-9A-Fa-f]++(?=:)|(?<=:)[0-9A-Fa-f]++(?![A-Za-z0-9])|[0-9]+|[A-Za-z]+|[^\sA-Za-z0-9]")


def stretches(text: str) -> list[tuple[int, int]]:
    """Runs of words with a digit or an @ sign, with white space between."""
    found: list[tuple[int, int]] = []
    for m in _CHUNK.finditer(text):
        if found and text[found[-1][1]:m.start()].isspace():
            found[-1] = (found[-1][0], m.end())
        else:
            found.append(m.span())
    return found


_RUNS = re.compile(r"[0-9]+|[A-Za-z]+|\s+")


def _shape_of(m: re.Match) -> str:
    c = m[0][0]
    return f"d{min(len(m[0]), 20)}" if "0" <= c <= "9" else "a" if c.isalpha() else "_"


def _class(c: str) -> str:
    return "^" if not c or c.isspace() else "d" if "0" <= c <= "9" else "a" if c.isalpha() else c if c < "\x7f" else "o"


def segment_key(text: str, start: int, end: int) -> tuple:
    """What the features of a candidate segment depend on."""
    part = text[start:end]
    digits = digits_of(part)
    ip = 6 if is_ip6(part) else is_ip(part)
    # Lengths of an address's groups say nothing.
    return ("ip6" if ip == 6 else _RUNS.sub(_shape_of, part), len(digits) if ip != 6 else 0,
            12 <= len(digits) <= 19 and luhn(digits), ip, digits[:2] if digits[:2] == "00" else min(digits[:1], "2"), _class(text[start - 1:start]), _class(text[end:end + 1]))


def features(key: tuple) -> list[tuple]:
    shape, n, checked, ip, lead, left, right = key
    signs = "".join(sorted(set(shape) - set("d0123456789")))
    return [("bias",), ("shape", shape), ("digits", min(n, 25)), ("signs", signs), ("checked", checked, n >= 16),
            ("checked+shape", checked, shape), ("lead", lead, shape), ("lead+signs", lead, signs, n),
            ("ip", ip), ("at", shape.count("@")), ("first", shape[0], shape[:3]), ("last", shape[-1]),
            ("left", left, shape[0]), ("right", right), ("left+signs", left, signs), ("right+signs", right, signs)]


#: What a token may do: begin a candidate, end one, be a number, be an @ sign.
_OPENS, _CLOSES, _DIGIT, _AT = 1, 2, 4, 8


class Tokens:
    """The tokens of a stretch, in plain arrays, and the candidate segments that end behind one."""

    def __init__(self, text: str, start: int, end: int):
        self.starts, self.ends, self.marks = array("q"), array("q"), bytearray()
        for m in _TOKEN.finditer(text, start, end):
            c = text[m.start()]
            self.starts.append(m.start())
            self.ends.append(m.end())
            self.marks.append(c.isascii() and (
                _OPENS * (c.isalnum() or c in "+(") | _CLOSES * c.isalnum() | _DIGIT * (c.isalnum() and not m[0].isalpha())
                | _AT * (c == "@")))

    def __len__(self) -> int:
        return len(self.starts)

    def candidates(self, at: int) -> Iterator[int]:
        """First tokens of the candidates that end before token `at`, the shortest first."""
        if not self.marks[at - 1] & _CLOSES:
            return
        seen = 0
        for first in range(at - 1, max(at - 1 - LONGEST, -1), -1):
            seen |= self.marks[first]
            if self.marks[first] & _OPENS and (seen & _AT or seen & _DIGIT and (
                    first < at - 1 or self.ends[first] - self.starts[first] >= 8)):
                yield first

    def key(self, text: str, first: int, at: int) -> tuple:
        return segment_key(text, self.starts[first], self.ends[at - 1])


class Stretch:
    """A short stretch with all its candidate segments (first token, token after, key), to learn from."""

    def __init__(self, text: str, start: int, end: int):
        found = Tokens(text, start, end)
        self.tokens = list(zip(found.starts, found.ends))
        n = len(found)
        self.candidates: list[tuple[int, int, tuple]] = sorted(
            (first, at, found.key(text, first, at)) for at in range(1, n + 1) for first in found.candidates(at))
        self.by_end: list[list[int]] = [[] for _ in range(n + 1)]
        self.by_start: list[list[int]] = [[] for _ in range(n + 1)]
        for c, (i, j, _) in enumerate(self.candidates):
            self.by_start[i].append(c)
            self.by_end[j].append(c)


def _log_sum(rows: np.ndarray) -> np.ndarray:
    top = rows.max(axis=0)
    return top + np.log(np.exp(rows - top).sum(axis=0))


class Model:
    """Weights of features per kind, and of a kind (or outside) after another."""

    def __init__(self):
        self.weights: dict[tuple, np.ndarray] = {}
        self.moves = np.zeros((OUTSIDE + 1, OUTSIDE + 1))
        self._known: dict[tuple, np.ndarray] = {}

    def score(self, key: tuple) -> np.ndarray:
        known = self._known.get(key)
        if known is None:
            if len(self._known) > 100_000:
                self._known.clear()
            known = np.zeros(OUTSIDE)
            for feature in features(key):
                weight = self.weights.get(feature)
                if weight is not None:
                    known = known + weight
            self._known[key] = known
        return known

    def best(self, text: str, tokens: Tokens) -> list[tuple[int, int, int]]:
        """Entities (kind, first token, token after) of the best cut. Of equal cuts, the one with
        fewer entities, then that with the shorter last entity.

        Candidates are made where they end, and values are kept for LONGEST tokens; of the others only
        the way back stays, two bytes for each kind.
        """
        n = len(tokens)
        lengths, befores = np.zeros((n + 1, OUTSIDE + 1), np.uint8), np.full((n + 1, OUTSIDE + 1), OUTSIDE, np.uint8)
        entering: deque = deque(maxlen=LONGEST)  # of the last places, the nearest first
        for at in range(n + 1):
            value = np.full(OUTSIDE + 1, -np.inf)
            if at:
                value[OUTSIDE], before = entering[0][0][OUTSIDE], entering[0][1][OUTSIDE]
                lengths[at, OUTSIDE], befores[at, OUTSIDE] = 1, before
                for first in tokens.candidates(at):
                    ways, before = entering[at - first - 1]
                    total = ways[:OUTSIDE] + self.score(tokens.key(text, first, at))
                    for kind in np.flatnonzero(total > value[:OUTSIDE] + 1e-12):
                        value[kind] = total[kind]
                        lengths[at, kind], befores[at, kind] = at - first, before[kind]
            else:
                value[OUTSIDE] = 0.0
            ways = value[:, None] + self.moves
            ways[OUTSIDE] += 1e-9
            entering.appendleft((ways.max(axis=0), ways.argmax(axis=0)))
        found, at = [], n
        value[OUTSIDE] += 1e-9
        kind = int(value.argmax())
        while at:
            start = at - int(lengths[at, kind])
            if kind != OUTSIDE:
                found.append((kind, start, at))
            at, kind = start, int(befores[at, kind])
        return found[::-1]

    def expected(self, stretch: Stretch, inner: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of (candidate, kind), and expected counts of moves, by forward-backward.
        `inner` has the candidates' scores where they are known."""
        n = len(stretch.tokens)
        if inner is None:
            inner = [self.score(key) for _, _, key in stretch.candidates]
        low = -1e30
        alpha, entering = np.full((n + 1, OUTSIDE + 1), low), np.empty((n + 1, OUTSIDE + 1))
        alpha[0, OUTSIDE] = 0.0
        for at in range(n + 1):
            if at:
                alpha[at, OUTSIDE] = entering[at - 1, OUTSIDE]
                if stretch.by_end[at]:
                    alpha[at, :OUTSIDE] = _log_sum(np.array(
                        [entering[stretch.candidates[c][0], :OUTSIDE] + inner[c] for c in stretch.by_end[at]]))
            entering[at] = _log_sum(alpha[at][:, None] + self.moves)
        beta, leaving = np.empty((n + 1, OUTSIDE + 1)), np.full((n + 1, OUTSIDE + 1), low)
        beta[n] = 0.0
        for at in range(n - 1, -1, -1):
            leaving[at, OUTSIDE] = beta[at + 1, OUTSIDE]
            if stretch.by_start[at]:
                leaving[at, :OUTSIDE] = _log_sum(np.array(
                    [inner[c] + beta[stretch.candidates[c][1], :OUTSIDE] for c in stretch.by_start[at]]))
            beta[at] = _log_sum((self.moves + leaving[at][None, :]).T)
        whole = _log_sum(alpha[n])
        moves = sum(np.exp(alpha[at][:, None] + self.moves + leaving[at][None, :] - whole) for at in range(n)) if n else 0 * self.moves
        chances = [np.exp(entering[i, :OUTSIDE] + inner[c] + beta[j, :OUTSIDE] - whole)
                   for c, (i, j, _) in enumerate(stretch.candidates)]
        return np.array(chances).reshape(-1, OUTSIDE), moves


Labelled = tuple[Stretch, dict[int, int]]


def labelled(text: str, start: int, end: int, spans: list[tuple[int, int, int]]) -> Labelled | None:
    """A stretch and the kinds of its true entities, by candidate; None if one isn't a candidate."""
    stretch = Stretch(text, start, end)
    place = {(stretch.tokens[i][0], stretch.tokens[j - 1][1]): c for c, (i, j, _) in enumerate(stretch.candidates)}
    if any((a, b) not in place for _, a, b in spans):
        return None
    return stretch, {place[a, b]: kind for kind, a, b in spans}


def _by_patterns(text: str, start: int, end: int) -> Labelled | None:
    """A stretch as the fixed patterns label it; None where they don't tell: a dropped number,
    overlapping matches, or one that isn't a candidate."""
    part = text[max(0, start - 1):end + 1]
    shift = start - max(0, start - 1)
    spans, dropped = base_spans(part)
    if dropped:
        return None
    spans.sort(key=lambda s: s[1])
    if any(a[2] > b[1] for a, b in zip(spans, spans[1:])):
        return None
    return labelled(part, shift, shift + end - start, spans)


def _looks(example: Labelled, chosen: bool) -> Iterator[tuple]:
    """What the entities of an example look like (without their borders), or the candidates that
    overlap none of its entities."""
    stretch, gold = example
    taken = [stretch.candidates[c][:2] for c in gold]
    for c, (i, j, key) in enumerate(stretch.candidates):
        if c in gold if chosen else not any(i < b and a < j for a, b in taken):
            yield key[:-2]


def train(texts: list[str], stretch_chars: int = LEARN_CHARS, most_stretches: int = LEARN_STRETCHES,
          pairs: int = LEARN_PAIRS, lines: int = LEARN_LINES) -> Model:
    """Weights by AdaGrad. Examples are
    - stretches of the texts, of at most `stretch_chars` characters and `most_stretches` at most, as the
      fixed patterns label them. Where something unlabelled looks like an entity of a made line, a stretch
      tells nothing and is left out;
    - `pairs` of labelled entities of the texts side by side, which the patterns could not tell apart;
    - `lines` made lines with what the patterns miss, and with numbers that are nobody's.
    """
    model, rng = Model(), np.random.default_rng(11)
    made = [example for line, spans in (made_line(rng) for _ in range(lines)) if (example := labelled(line, 0, len(line), spans))]
    known = {look for example in made for look in _looks(example, True)}
    examples, entities = [], []
    for text in texts:
        for start, end in stretches(text):
            if end - start <= stretch_chars and (example := _by_patterns(text, start, end)):
                if known.isdisjoint(_looks(example, False)):
                    examples.append(example)
        entities += [(kind, text[a:b]) for kind, a, b in base_spans(text)[0]]
    order = rng.permutation(len(examples))[:most_stretches]
    examples = [examples[i] for i in order] + made
    for _ in range(min(pairs, 4 * len(entities))):
        (kind, first), (other, second) = (entities[i] for i in rng.integers(0, len(entities), 2))
        line = f"{first} {second}"
        if example := labelled(line, 0, len(line), [(kind, 0, len(first)), (other, len(first) + 1, len(line))]):
            examples.append(example)
    examples = [example for example in examples if example[0].candidates]
    # Features by number, one row for each candidate of an example.
    numbers: dict[tuple, int] = {}
    rows = [np.array([[numbers.setdefault(f, len(numbers)) for f in features(key)] for _, _, key in stretch.candidates])
            for stretch, _ in examples]
    weights, squares = np.zeros((len(numbers), OUTSIDE)), np.ones((len(numbers), OUTSIDE))
    move_squares = np.full(model.moves.shape, 1.0)
    for _ in range(EPOCHS):
        for at in rng.permutation(len(examples)):
            (stretch, gold), used = examples[at], rows[at]
            chances, moves = model.expected(stretch, weights[used].sum(axis=1))
            missing = -chances
            for c, kind in gold.items():
                missing[c, kind] += 1
            seen, last, i = np.zeros_like(moves), OUTSIDE, 0
            starts = {stretch.candidates[c][0]: (kind, stretch.candidates[c][1]) for c, kind in gold.items()}
            while i < len(stretch.tokens):
                kind, i = starts.get(i, (OUTSIDE, i + 1))
                seen[last, kind] += 1
                last = kind
            wrong = np.abs(missing).max(axis=1) > 1e-4
            touched, place = np.unique(used[wrong], return_inverse=True)
            step = np.zeros((len(touched), OUTSIDE))
            np.add.at(step, place.reshape(-1), np.repeat(missing[wrong], used.shape[1], axis=0))
            step -= SHRINK * weights[touched]
            squares[touched] += step * step
            weights[touched] += RATE * step / np.sqrt(squares[touched])
            step = seen - moves
            move_squares += step ** 2
            model.moves += RATE * step / np.sqrt(move_squares)
    model.weights = {feature: weights[n].copy() for feature, n in numbers.items() if weights[n].any()}
    return model


def added_spans(model: Model, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Entities of the best cut that overlap no match of the fixed patterns."""
    found = []
    matches = sorted((a, b) for _, a, b in base)
    begins, furthest = [a for a, _ in matches], list(accumulate((b for _, b in matches), max))
    for start, end in stretches(text):
        tokens = Tokens(text, start, end)
        for kind, i, j in model.best(text, tokens):
            a, b = tokens.starts[i], tokens.ends[j - 1]
            # Matches that begin before the entity ends; one of them may reach into it.
            before = bisect_left(begins, b)
            if not before or furthest[before - 1] <= a:
                found.append((kind, a, b))
    return found


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE,
          stretch_chars: int = LEARN_CHARS, most_stretches: int = LEARN_STRETCHES) -> Model:
    """A model from a bounded sample: of some 2 * `sample` texts that hold a digit or an @ sign (those of
    the smallest hash), at most `most_stretches` stretches of at most `stretch_chars` characters, again
    those of the smallest hash. Stretches are cut in the tasks, so the driver gets no whole texts."""
    rows = docs.select(F.xxhash64(F.col(id_col), F.lit("pii")).alias("place"), F.col(text_col).alias("text")).where(
        F.col("text").rlike("[0-9@]"))
    count = rows.count()
    limit = min(1.0, 2.0 * sample / max(count, 1)) * 2.0 ** 64 - 2.0 ** 63

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            for place, text in zip(batch.column("place").to_pylist(), texts):
                found = [(a, text[a:b]) for a, b in stretches(text) if b - a <= stretch_chars]
                for i in range(0, len(found), 10_000):
                    starts, parts = zip(*found[i:i + 10_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([place] * len(starts)), pa.array(starts, pa.int64()), pa.array(parts)], ["place", "start", "text"])

    parts = rows.where(F.col("place").cast("double") <= limit).mapInArrow(short, "place long, start long, text string")
    chosen = parts.orderBy(F.xxhash64("place", "start", "text"), "place", "start", "text").limit(most_stretches)
    return train([r["text"] for r in chosen.collect()], stretch_chars, most_stretches)


_SCHEMA = ("id long, base array<struct<kind:int,start:long,end:long>>, added array<struct<kind:int,start:long,end:long>>")


def find_personal_data(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, and the spans base and added as (kind's number, start, end), code points.

    base has every match of the fixed patterns by kind, then start; added what the field finds beside
    them. No text is an empty one. Texts are read one by one: repeated rows each get their row, an
    empty table gives an empty result, other columns are not read.
    """
    shared = share(docs.sparkSession, model)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch, texts in slices(batches, "text"):
            base, added = [], []
            for text in texts:
                spans = base_spans(text or "")[0]
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                added.append([{"kind": k, "start": a, "end": b} for k, a, b in added_spans(shared(), text or "", spans)])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(base, kind), pa.array(added, kind)], ["id", "base", "added"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(find, _SCHEMA)


def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = find_personal_data(docs, learn(docs))
    names = F.array(*map(F.lit, KINDS))

    def written(spans):
        return F.array_join(F.transform(F.sort_array(spans), lambda x: F.concat_ws(
            ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")

    def n(i: int):
        return F.size(F.filter("base", lambda x: x["kind"] == i)).cast("long").alias(f"n_{KINDS[i]}")

    return found.select(F.col("id").alias("doc_id"), *map(n, range(len(KINDS))),
                        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                        written(F.concat("base", "added")).alias("spans"))


def digest_of(spans: list[tuple[int, int, int]]) -> str:
    """base_sha256 of spans, in plain Python."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans)).encode()).hexdigest()
