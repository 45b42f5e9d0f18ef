"""Language of texts, word by word: a linear-chain conditional random field.

The labels of a text's words form a chain. A word's scores are sums of learned weights of its
features: letter bigrams and trigrams, prefixes and suffixes, the word itself, and the learned
lexicons that hold it. Transitions between neighbouring labels are learned too, from texts in which
stretches of different languages follow each other. Forward-backward gives every word's
probabilities; a text's language is the one with most probability, weighted by word length.

Words of many texts make one long chain; a text's first word does not depend on the word before it.
The chain is cut into columns that are worked on together: first their transfer matrices, then the
states at their borders, then the states inside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import share, slices, table
from gridmart.llm.letters import LETTER, code_tables, grouped, joined, labelled_sample, pieces, run_hashes

#: Texts that the weights are learned from, at most, for each language.
SAMPLE = 200
#: Rows of the weight table; features share them by hash.
TABLE_BITS = 16
#: Most frequent words of a language's sample that make its lexicon; slots of the lexicon table.
LEXICON, LEXICON_BITS = 300, 18
EPOCHS, RATE, SHRINK = 3, 0.3, 1e-6
UNKNOWN = "und"
_SALTS = np.array([0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1, 0x9E3779B1, 0x2545F491, 0x7FEB352D, 0x846CA68B], np.uint32)


class Words:
    """The words (runs of letters) of some texts, with the places of their features in the tables."""

    def __init__(self, texts: list[str | None]):
        codes, text_starts = joined(texts)
        lower, kinds = code_tables()
        letter = kinds[codes] == LETTER
        x = np.where(letter, lower[codes], 0).astype(np.uint32)
        change = np.flatnonzero(letter[1:] != letter[:-1]) + 1
        if letter[0]:
            change = np.concatenate([[0], change])
        self.starts, self.ends = change[0::2], change[1::2]  # the last code is a line break
        self.lengths = self.ends - self.starts
        self.count = len(self.starts)
        self.text_of = np.searchsorted(text_starts, self.starts, side="right") - 1
        self.first = np.ones(self.count, bool)
        self.first[1:] = self.text_of[1:] != self.text_of[:-1]
        self.hashes = run_hashes(x, self.starts, self.lengths)
        self.places = self._places(x, letter)

    def _places(self, x: np.ndarray, letter: np.ndarray) -> tuple[list, list]:
        """Rows of the weight table: two arrays by letter, five by word."""
        shift = np.uint32(32 - TABLE_BITS)
        with np.errstate(over="ignore"):
            at = np.flatnonzero(letter)
            padded = np.concatenate([np.zeros(4, np.uint32), x, np.zeros(4, np.uint32)])
            own, after, before = x[at], padded[at + 5], padded[at + 3]

            def mixed(h: np.ndarray) -> np.ndarray:
                h ^= h >> np.uint32(15)
                h *= np.uint32(0x2C1B3C6D)
                h ^= h >> np.uint32(12)
                h *= np.uint32(0x297A2D39)
                return h >> shift

            two = mixed(own * _SALTS[0] + after * _SALTS[1] + np.uint32(1))
            three = mixed(before * _SALTS[2] + own * _SALTS[0] + after * _SALTS[1] + np.uint32(2))

            def affix(begin: np.ndarray, step: int, n: int, kind: int) -> np.ndarray:
                h, open_ = np.full(self.count, kind, np.uint32), np.ones(self.count, bool)
                for i in range(n):
                    letter_ = padded[begin + 4 + step * i] * open_
                    open_ &= letter_ > 0
                    h += (letter_ * _SALTS[i + 3])
                return mixed(h)

            by_word = [affix(self.starts, 1, n, 10 + n) for n in (3, 4)]
            by_word += [affix(self.ends - 1, -1, n, 20 + n) for n in (3, 4)]
            by_word.append((self.hashes >> np.uint64(64 - TABLE_BITS)).astype(np.uint32))
        return [two, three], by_word

    def lexicon_slots(self) -> np.ndarray:
        return (self.hashes & np.uint64((1 << LEXICON_BITS) - 1)).astype(np.int64)

    def letter_words(self) -> np.ndarray:
        return np.repeat(np.arange(self.count), self.lengths)


class Model:
    """Weights: (rows, labels) of features, (lexicons, labels), (labels, labels) of transitions."""

    def __init__(self, labels: list[str]):
        k = len(labels)
        self.labels = labels
        self.weights = np.zeros((1 << TABLE_BITS, k), np.float32)
        self.lexicon = np.zeros((1 << LEXICON_BITS, k), np.uint8)
        self.lexicon_weights = np.zeros((k, k), np.float32)
        self.transitions = np.zeros((k, k))

    def scores(self, words: Words) -> np.ndarray:
        """(words, labels): the sum of the weights of each word's features."""
        by_letter, by_word = words.places
        letters = self.weights[by_letter[0]]
        letters += self.weights[by_letter[1]]
        total = np.add.reduceat(letters, np.cumsum(words.lengths) - words.lengths, axis=0)
        for places in by_word:
            total += self.weights[places]
        total += self.lexicon[words.lexicon_slots()].astype(np.float32) @ self.lexicon_weights
        return total


#: Words in a column of the chain. Characters of texts read at once; a longer text is read in pieces.
COLUMN = 256
GROUP = 1_000_000


def marginals(scores: np.ndarray, transitions: np.ndarray, first: np.ndarray, pairs: bool = False,
              before: np.ndarray | None = None, behind: np.ndarray | None = None):
    """Forward-backward over a chain of words that begins anew where first is set.

    Returns each word's label probabilities and, if wanted, the expected counts of label pairs.
    Every column is a stretch of COLUMN words; transfer matrices carry states from border to border.
    Of a piece of a longer chain, before is the forward state of the word before it, and behind the
    backward state of its last word.
    """
    n, k = scores.shape
    columns = -(-n // COLUMN)
    emit = np.ones((columns * COLUMN, k))
    emit[:n] = np.exp(scores - scores.max(axis=1, keepdims=True))
    if behind is not None:
        # The words behind weigh on the last one as if they were part of it.
        emit[n - 1] *= behind / behind.max()
    begin = np.ones(columns * COLUMN, bool)
    begin[:n] = first
    emit = np.ascontiguousarray(emit.reshape(columns, COLUMN, k).transpose(1, 0, 2))
    begin = np.ascontiguousarray(begin.reshape(columns, COLUMN).T)
    move = np.exp(transitions - transitions.max())

    # Transfer matrices: state before the column to state at its end.
    transfer = np.broadcast_to(np.eye(k), (columns, k, k)).copy()
    for t in range(COLUMN):
        moved = transfer @ move
        if begin[t].any():
            moved[begin[t]] = transfer[begin[t]].sum(axis=2, keepdims=True)
        transfer = moved * emit[t][:, None, :]
        transfer /= transfer.sum(axis=(1, 2), keepdims=True)
    borders = np.empty((columns, k))
    backs = np.empty((columns, k))
    state, back = np.full(k, 1 / k) if before is None else before, np.full(k, 1 / k)
    for c in range(columns):
        borders[c] = state
        state = state @ transfer[c]
        state = state / state.sum()
    for c in range(columns - 1, -1, -1):
        backs[c] = back
        back = transfer[c] @ back
        back = back / back.sum()

    forward = np.empty_like(emit)
    state = borders
    for t in range(COLUMN):
        state = np.where(begin[t][:, None], 1.0, state @ move) * emit[t]
        state = state / state.sum(axis=1, keepdims=True)
        forward[t] = state
    expected = np.zeros((k, k))
    state = backs
    for t in range(COLUMN - 1, -1, -1):
        here = forward[t] * state
        ahead = state * emit[t]
        if pairs:
            before = forward[t - 1] if t else borders
            joint = before[:, :, None] * move[None] * ahead[:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            expected += joint[~begin[t]].sum(axis=0)
        state = np.where(begin[t][:, None], 1.0, ahead @ move.T)
        state = state / state.sum(axis=1, keepdims=True)
        forward[t] = here
    probabilities = forward.transpose(1, 0, 2).reshape(-1, k)[:n]
    probabilities = probabilities / probabilities.sum(axis=1, keepdims=True)
    return (probabilities, expected) if pairs else probabilities


def _switched(sample: list[tuple[str, str]], labels: list[str], seed: int) -> list[tuple[list[str], np.ndarray]]:
    """Batches of texts made of stretches of 5 to 60 words of different texts, with their words' labels."""
    rng = np.random.default_rng(seed)
    stretches = []
    for label, text in sample:
        words = text.split()
        at = 0
        while at < len(words):
            n = int(rng.integers(5, 60))
            stretches.append((labels.index(label), " ".join(words[at:at + n])))
            at += n
    order = rng.permutation(len(stretches))
    return [[stretches[i] for i in order[at:at + 300]] for at in range(0, len(order), 300)]


def train(sample: list[tuple[str, str]]) -> Model | None:
    """Weights by AdaGrad on the conditional likelihood of the words' labels."""
    labels = sorted({label for label, _ in sample})
    if not labels:
        return None
    model, k = Model(labels), len(labels)
    counts = np.zeros((1 << LEXICON_BITS, k))
    for label, text in sample:
        slots = Words([text]).lexicon_slots()
        np.add.at(counts[:, labels.index(label)], slots, 1)
    for i in range(k):
        top = np.argsort(-counts[:, i], kind="stable")[:LEXICON]
        model.lexicon[top[counts[top, i] > 1], i] = 1
    squares = np.full(model.weights.shape, 1e-3, np.float32)
    lexicon_squares, move_squares = np.full((k, k), 1.0), np.full((k, k), 1.0)
    for epoch in range(EPOCHS):
        for batch in _switched(sample, labels, epoch):
            # Six stretches make a text.
            texts = ["\n".join(text for _, text in batch[i:i + 6]) for i in range(0, len(batch), 6)]
            words = Words(texts)
            if not words.count:
                continue
            parts = [Words([text]).count for _, text in batch]
            gold = np.repeat([label for label, _ in batch], parts)
            scores = model.scores(words)
            probabilities, expected = marginals(scores, model.transitions, words.first, pairs=True)
            missing = -probabilities.astype(np.float32)
            missing[np.arange(words.count), gold] += 1
            by_letter, by_word = words.places
            spread = missing[words.letter_words()]
            places = np.concatenate([*by_letter, *by_word])
            shares = np.concatenate([spread, spread, *[missing] * len(by_word)])
            gradient = np.stack([np.bincount(places, shares[:, i], 1 << TABLE_BITS) for i in range(k)], axis=1)
            gradient = (gradient - SHRINK * words.count * model.weights).astype(np.float32)
            squares += gradient ** 2
            model.weights += RATE * gradient / np.sqrt(squares)
            step = model.lexicon[words.lexicon_slots()].astype(np.float32).T @ missing
            lexicon_squares += step ** 2
            model.lexicon_weights += (RATE * step / np.sqrt(lexicon_squares)).astype(np.float32)
            seen = np.zeros((k, k))
            inner = ~words.first[1:]
            np.add.at(seen, (gold[:-1][inner], gold[1:][inner]), 1)
            step = seen - expected
            move_squares += step ** 2
            model.transitions += RATE * step / np.sqrt(move_squares)
    return model


def _passage(scores: np.ndarray, transitions: np.ndarray, is_begin: bool) -> np.ndarray:
    """The transfer matrix of a whole piece: from the state of the word before it to its last word's."""
    move, k = np.exp(transitions - transitions.max()), transitions.shape[0]
    whole = np.eye(k)
    for at in range(0, len(scores), block := max(2, 2_000_000 // k ** 2)):
        part = scores[at:at + block]
        steps = move[None] * np.exp(part - part.max(axis=1, keepdims=True))[:, None, :]
        if is_begin and not at:
            steps[0] = np.exp(part[0] - part[0].max())[None, :]
        while len(steps) > 1:
            odd = steps[-1:] if len(steps) % 2 else steps[:0]
            steps = steps[0:len(steps) - len(odd):2] @ steps[1:len(steps) - len(odd):2]
            steps = np.concatenate([steps / steps.sum(axis=(1, 2), keepdims=True), odd])
        whole = whole @ steps[0]
        whole /= whole.sum()
    return whole


def _long_sums(model: Model, text: str) -> np.ndarray:
    """Probability of each label, added up by word length, over a text that is read in pieces.

    First each piece's transfer matrix; then, from those, the states at the borders; then the words
    inside. So the pieces make the same chain as the whole text, and one piece is held at a time.
    """
    k = len(model.labels)
    passages: list[np.ndarray | None] = []
    begun = False
    for piece in pieces(text, GROUP):
        words = Words([piece])
        passages.append(_passage(model.scores(words), model.transitions, not begun) if words.count else None)
        begun = begun or words.count > 0
    before, behind = [], []
    state = np.full(k, 1 / k)
    for passage in passages:
        before.append(state)
        if passage is not None:
            state = state @ passage
            state = state / state.sum()
    back = np.ones(k)
    for passage in reversed(passages):
        behind.append(back)
        if passage is not None:
            # The state behind the word before a piece.
            back = passage @ back
            back = back / back.sum()
    sums, begun = np.zeros(k), False
    for piece, front, rear in zip(pieces(text, GROUP), before, reversed(behind)):
        words = Words([piece])
        if not words.count:
            continue
        words.first[0] = not begun
        begun = True
        probabilities = marginals(model.scores(words), model.transitions, words.first, before=front, behind=rear)
        sums += words.lengths @ probabilities
    return sums


def classify(model: Model | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of every text. A text longer than GROUP is read in pieces of one chain."""
    if model is None or not texts:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    sums = np.zeros((len(texts), len(model.labels)))
    for at, group in grouped(texts, GROUP):
        if len(group[0]) > GROUP:
            sums[at] = _long_sums(model, group[0])
            continue
        words = Words(group)
        if words.count:
            probabilities = marginals(model.scores(words), model.transitions, words.first)
            sums[at:at + len(group)] += np.stack(
                [np.bincount(words.text_of, p * words.lengths, len(group)) for p in probabilities.T], axis=1)
    total = sums.sum(axis=1)
    best = sums.argmax(axis=1)
    share = np.where(total > 0, sums[np.arange(len(texts)), best] / np.maximum(total, 1e-12), 0.0)
    return ([model.labels[b] if t > 0 else UNKNOWN for b, t in zip(best.tolist(), total.tolist())],
            np.clip(share, 0.0, 1.0).tolist())


def remainder(id_: Column, n: int) -> Column:
    return F.crc32(id_.cast("string").cast("binary")) % n


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score. No text, or one without a letter, has `und` and score 0; so have
    all texts if there was nothing to learn from. Repeated rows each get their row."""
    shared = share(docs.sparkSession, model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text", most_bytes=1_000_000):
            names, scores = classify(shared(), texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(predict, "id long, lang_pred string, score double")


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
          sample: int = SAMPLE) -> Model | None:
    """A model from at most `sample` texts of each label; None if no row has a label."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(text_col).alias("text"))
    return train(labelled_sample(rows, sample, rows))


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = learn(docs.where(remainder(F.col("doc_id"), 3) != 1))
    held_out = F.coalesce(remainder(F.col("id"), 3) == 1, F.lit(False))
    return identify(docs, model).select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score")
