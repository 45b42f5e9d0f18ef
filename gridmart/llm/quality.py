"""Quality of texts: random-indexing word vectors, pooled, and a two-layer network.

Every word (a run of letters, digits or signs, as written) has a slot by hash, and every slot a fixed
sparse vector of +1 and -1. A slot's context vector is the sum of the fixed vectors of the words
beside it, over all texts of the corpus: tasks add up their own share, a shuffle on the slot adds up
the shares. A text is the mean and the deviation of its words' context vectors (scaled to length 1),
and the mean product of neighbouring ones.
The network learns from a bounded sample of labelled rows; a temperature fitted on a part of it that
the network has not seen turns its outputs into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import byte_sizes, cut, cuts, share, slices, table
from gridmart.llm.langid import remainder
from gridmart.llm.letters import code_tables, grouped, joined, labelled_sample, pieces, run_hashes, runs

#: Word slots, length of a vector, entries that aren't zero in a fixed one, neighbours on each side.
SLOT_BITS, SIZE, ENTRIES, REACH = 14, 48, 4, 2
SLOTS = 1 << SLOT_BITS
#: Labelled texts that the network learns from, at most, for each label; share kept for calibration.
SAMPLE, CALIBRATION = 1500, 0.3
HIDDEN, EPOCHS, RATE, DECAY = 32, 60, 0.01, 1e-4
KEEP = 0.7
#: Text worked on at once (a worker then needs some 200 MB).
GROUP = 400_000


def word_slots(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The slots of all words of the texts, and the number of the text that each belongs to."""
    codes, text_starts = joined(texts)
    _, kinds = code_tables()
    starts, lengths = runs(kinds[codes])
    slots = (run_hashes(codes, starts, lengths) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    return slots, np.searchsorted(text_starts, starts, side="right") - 1


def fixed_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of every slot's fixed vector."""
    rng = np.random.default_rng(20)
    places = np.argsort(rng.random((SLOTS, SIZE)), axis=1)[:, :ENTRIES]
    return places, rng.choice(np.array([-1.0, 1.0]), (SLOTS, ENTRIES))


def in_pieces(texts: list[str | None], reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Place of the first text, slots, numbers of the texts from there, and how many of the first slots
    were given before: a text longer than GROUP comes in pieces, each with the last `reach` slots of
    the piece before."""
    for at, group in grouped(texts, GROUP):
        if len(group[0]) <= GROUP:
            yield at, *word_slots(group), 0
            continue
        tail = np.empty(0, np.int64)
        for piece in pieces(group[0], GROUP):
            slots = np.concatenate([tail, word_slots([piece])[0]])
            yield at, slots, np.zeros(len(slots), np.int64), len(tail)
            tail = slots[max(0, len(slots) - reach):]


def add_contexts(sums: np.ndarray, slots: np.ndarray, text_of: np.ndarray, fixed: tuple[np.ndarray, np.ndarray],
                 seen: int = 0) -> None:
    """Add the fixed vectors of each word's neighbours in its text to the sums of its slot. Pairs among
    the first `seen` words are not counted again."""
    places, signs = fixed
    for step in range(1, REACH + 1):
        same = text_of[step:] == text_of[:-step]
        same[:max(0, seen - step)] = False
        left, right = slots[:-step][same], slots[step:][same]
        for word, neighbour in ((left, right), (right, left)):
            at = (word * SIZE)[:, None] + places[neighbour]
            sums += np.bincount(at.ravel(), signs[neighbour].ravel(), sums.size)


def _task_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums, fixed = np.zeros(SLOTS * SIZE), fixed_vectors()
    for _, texts in slices(batches, "text", most_bytes=GROUP):
        for _, slots, text_of, seen in in_pieces(texts, REACH):
            add_contexts(sums, slots, text_of, fixed, seen)
    yield from _vectors(sums)


def _vectors(sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    table_ = sums.reshape(SLOTS, SIZE)
    used = np.flatnonzero(table_.any(axis=1))
    if len(used):
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array([row.tobytes() for row in table_[used].astype(np.int64)], pa.binary())], ["slot", "sums"])


def _add_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros((SLOTS, SIZE))
    for batch in batches:
        slots = batch.column("slot").to_numpy(zero_copy_only=False)
        parts = np.frombuffer(b"".join(batch.column("sums").to_pylist()), np.int64).reshape(-1, SIZE)
        np.add.at(sums, slots, parts)
    yield from _vectors(sums.ravel())


def context_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """(SLOTS, SIZE): the context vectors over all texts, scaled to length 1; zero for unseen slots."""
    tasks = docs.select(F.col(text_col).alias("text")).mapInArrow(_task_contexts, "slot long, sums binary")
    added = tasks.repartition("slot").mapInArrow(_add_vectors, "slot long, sums binary")
    vectors = np.zeros((SLOTS, SIZE), np.float32)
    for row in cut(added).collect():  # SLOTS rows at most
        vectors[row["slot"]] = np.frombuffer(row["sums"], np.int64)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def pooled(vectors: np.ndarray, texts: list[str | None]) -> np.ndarray:
    """(texts, 2 * SIZE + 1): mean and deviation of the vectors of each text's words, and the mean product
    of neighbours (near 1 where words repeat); zeros without words."""
    sums, count = np.zeros((len(texts), 2 * SIZE + 1)), np.zeros((len(texts), 1))
    for at, slots, text_of, seen in in_pieces(texts, 1):
        if len(slots) == seen:
            continue
        words = vectors[slots]
        alike = np.zeros(len(slots))
        alike[1:] = np.einsum("ij,ij->i", words[1:], words[:-1]) * (text_of[1:] == text_of[:-1])
        words, alike, text_of = words[seen:], alike[seen:], text_of[seen:]
        starts = np.flatnonzero(np.concatenate([[True], text_of[1:] != text_of[:-1]]))
        of = at + text_of[starts]  # a text has one run of words in each piece
        sums[of, :SIZE] += np.add.reduceat(words, starts, axis=0, dtype=np.float64)
        sums[of, SIZE:2 * SIZE] += np.add.reduceat(words * words, starts, axis=0, dtype=np.float64)
        sums[of, 2 * SIZE] += np.add.reduceat(alike, starts)
        count[of, 0] += np.diff(np.append(starts, len(text_of)))
    out = sums / np.maximum(count, 1)
    out[:, SIZE:2 * SIZE] = np.sqrt(np.maximum(out[:, SIZE:2 * SIZE] - out[:, :SIZE] ** 2, 0))
    return out


class Network:
    """Two layers, tanh between, and a temperature; weights in plain arrays."""

    def __init__(self, inputs: int):
        rng = np.random.default_rng(7)
        self.shift, self.scale = np.zeros(inputs), np.ones(inputs)
        self.layers = [rng.normal(0, inputs ** -0.5, (inputs, HIDDEN)), np.zeros(HIDDEN),
                       rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        self.temperature = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return np.tanh((x - self.shift) / self.scale @ a + b) @ c + d[0]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """Adam on the weighted log loss, in batches of 64."""
        self.shift, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.shift) / self.scale
        rng, t = np.random.default_rng(3), 0
        first, second = [np.zeros_like(p) for p in self.layers], [np.zeros_like(p) for p in self.layers]
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), 64):
                part = order[at:at + 64]
                a, b, c, d = self.layers
                hidden = np.tanh(x[part] @ a + b)
                error = (1 / (1 + np.exp(-np.clip(hidden @ c + d[0], -40, 40))) - y[part]) * weight[part] / len(part)
                inner = np.outer(error, c) * (1 - hidden * hidden)
                gradients = [x[part].T @ inner + DECAY * a, inner.sum(axis=0), hidden.T @ error + DECAY * c, np.array([error.sum()])]
                t += 1
                for i, g in enumerate(gradients):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    self.layers[i] = self.layers[i] - RATE * (first[i] / (1 - 0.9 ** t)) / (np.sqrt(second[i] / (1 - 0.999 ** t)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """The temperature of least log loss, searched over a grid of its logarithm."""
        logits = self.logits(x)

        def loss(temperature: float) -> float:
            p = np.clip(1 / (1 + np.exp(-np.clip(logits / temperature, -40, 40))), 1e-9, 1 - 1e-9)
            return float(-(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum())

        self.temperature = min(np.exp(np.linspace(-2, 3, 101)), key=loss) if len(x) else 1.0


class Model:
    def __init__(self, vectors: np.ndarray, network: Network | None, prior: float):
        self.vectors, self.network, self.prior = vectors, network, prior

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.prior)
        return self.network.probabilities(pooled(self.vectors, texts))


def train(vectors: np.ndarray, sample: list[tuple[int, str]], shares: dict[int, float]) -> Model:
    """The network and its temperature. With less than two labels in the sample every text gets the
    share of label 1 (one half if there is none)."""
    y = np.array([label for label, _ in sample], float)
    if len(set(y.tolist())) < 2:
        return Model(vectors, None, float(y.mean()) if len(y) else 0.5)
    x = np.concatenate([pooled(vectors, [text for _, text in sample[at:at + 200]]) for at in range(0, len(sample), 200)])
    # The sample has as many of either label; weights bring the labels' shares back.
    weight = np.array([shares[int(v)] / (y == v).mean() for v in y])
    held = np.random.default_rng(5).random(len(y)) < CALIBRATION
    network = Network(x.shape[1])
    network.fit(x[~held], y[~held], weight[~held])
    network.calibrate(x[held], y[held], weight[held])
    return Model(vectors, network, shares.get(1, 0.5))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          fold: int = 4, held_out: int = 2, sample: int = SAMPLE) -> Model:
    """Word vectors over all docs; the network from at most `sample` labelled texts of each label, none of
    the held-out fold. Labels other than 0 and 1 and rows without an id are not learned from."""
    vectors = context_vectors(docs, text_col)
    known = labels.where(F.col(label_col).isin(0, 1) & (remainder(F.col(id_col), fold) != held_out)).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    picked = labelled_sample(known, sample, rows)
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    total = sum(counts.values()) or 1
    return train(vectors, picked, {label: n / total for label, n in counts.items()})


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns in a struct `row`, and `quality_score`: rows are judged one by one, in place.

    No text is an empty one, which has a score too. Repeated rows each get their row; an empty table
    gives an empty result; other columns pass through untouched.
    """
    shared = share(docs.sparkSession, model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        scores = [shared().score(texts.slice(start, end - start).to_pylist())
                  for start, end in cuts(byte_sizes(texts), GROUP, 4096)]
        return pa.array(np.clip(np.concatenate(scores or [np.empty(0)]), 0.0, 1.0), pa.float64())

    return docs.select(F.struct("*").alias("row"), score(F.col(text_col)).alias("quality_score"))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows with a score of at least KEEP, all columns as they are."""
    return scored(docs, model, text_col=text_col).where(F.col("quality_score") >= KEEP).select("row.*")


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, folder, "labels"))
    held_out = F.coalesce(remainder(F.col("row.doc_id"), 4) == 2, F.lit(False))
    return scored(docs, model).select(
        F.col("row.doc_id").alias("doc_id"), held_out.alias("held_out"), F.col("quality_score").alias("score"),
        F.when(F.col("quality_score") >= KEEP, 1).otherwise(0).alias("predicted"))
