"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document is a sparse vector: its words hashed to 16,384 buckets (weight: 1 + log of the count, scaled to length 1), some
statistics of its structure (shares of capitals, digits, symbols and repeated lines, word lengths, variety), and what the row says of
itself (n_chars). The score is the logistic of a bias, a weight per feature and all pairwise interactions of rank `RANK`, which the
identity  sum over pairs <v_i, v_j> x_i x_j = 1/2 sum over factors ((sum v_if x_i)^2 - sum (v_if x_i)^2)  gives in time linear in the features.

Trained on at most `max_training` labelled rows (those with the lowest hashes of their ids) outside the held-out fold, in one task
whose rows are that many at most; every document is scored. Labels, lang, source and doc_id are no features.

Defined results. Null and empty texts: scored by the statistics alone. Very long texts: whole. A score of exactly 0.7 is predicted 1. Ids that labels contradict each other on, null ids and null marks:
not learned from. Without labelled rows every score is 0.5; with one kind of mark only, the share of good ones, kept off 0 and 1.
Rows without an id are not held out. Repeated rows: each comes back. An empty table gives no rows. A missing n_chars column counts as null.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.llm.common import bounded_ids, held_out

WORDS = 1 << 14
RANK = 8
MAX_TRAINING = 10_000
EPOCHS = 12
BATCH = 128
RATE = 0.1
SHRINK = 1e-5
CUT = 0.7
_UPPER, _DIGITS = bytes(range(65, 91)), b"0123456789"
_LETTERS = _UPPER + bytes(range(97, 123))
_SYMBOLS, _STOPS = b"#*$%&|<>@^~\\{}[]_=+", b".,;:!?"
STATISTICS = 12
FEATURES = WORDS + STATISTICS


def features(text: bytes | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values) of a document's features."""
    text = text or b""
    words = text.split()
    counts = Counter(words)
    buckets = np.fromiter(map(zlib.crc32, counts), np.int64, len(counts)) % WORDS
    weights = 1.0 + np.log(np.fromiter(counts.values(), np.float64, len(counts)))
    weights /= max(1e-9, float(np.sqrt((weights * weights).sum())))
    size = max(1, len(text))
    lines = [line for line in text.split(b"\n") if line.strip()]

    def share(of: bytes) -> float:
        return (len(text) - len(text.translate(None, of))) / size

    statistics = [
        np.log1p(len(words)) / 10,
        min(len(text) / max(1, len(words)), 40) / 10,
        share(_UPPER),
        share(_DIGITS),
        4 * share(_SYMBOLS),
        4 * share(_STOPS),
        share(_LETTERS),
        len(counts) / max(1, len(words)),
        (len(lines) - len(set(lines))) / max(1, len(lines)),
        max(counts.values(), default=0) / max(1, len(words)),
        np.log1p(max(0, n_chars or 0)) / 10,
        float(n_chars is None),
    ]
    return np.concatenate([buckets, WORDS + np.arange(STATISTICS)]), np.concatenate([weights, statistics])


class Machine:
    """Bias, weights and factors; all features of a batch are one flat array with the start of each row."""

    def __init__(self, seed: int = 0):
        self.bias, self.weights = 0.0, np.zeros(FEATURES)
        self.factors = np.random.default_rng(seed).normal(0, 0.02, (FEATURES, RANK))

    def _sums(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The linear part, the factors' contributions by feature, and their sums by row."""
        parts = self.factors[index] * value[:, None]
        return np.add.reduceat(self.weights[index] * value, starts), parts, np.add.reduceat(parts, starts, axis=0)

    def margin(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        linear, parts, sums = self._sums(index, value, starts)
        return self.bias + linear + 0.5 * (sums * sums - np.add.reduceat(parts * parts, starts, axis=0)).sum(axis=1)

    def score(self, text: bytes | None, n_chars: int | None) -> float:
        index, value = features(text, n_chars)
        return float(1 / (1 + np.exp(-np.clip(self.margin(index, value, np.zeros(1, np.int64))[0], -30, 30))))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], marks: np.ndarray, epochs: int = EPOCHS, seed: int = 0) -> Machine:
        """Logistic loss by AdaGrad over shuffled batches."""
        rng = np.random.default_rng(seed)
        self.bias = float(np.log((marks.sum() + 1) / (len(marks) - marks.sum() + 1)))
        seen_w, seen_v, seen_b = np.full(FEATURES, 1e-6), np.full((FEATURES, RANK), 1e-6), 1e-6
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(rows), BATCH):
                batch = order[at : at + BATCH]
                lengths = np.array([len(rows[i][0]) for i in batch])
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                index, value = (np.concatenate([rows[i][k] for i in batch]) for k in (0, 1))
                linear, parts, sums = self._sums(index, value, starts)
                margin = self.bias + linear + 0.5 * (sums * sums - np.add.reduceat(parts * parts, starts, axis=0)).sum(axis=1)
                error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - marks[batch]) / len(batch)
                each = np.repeat(error, lengths) * value
                used, place = np.unique(index, return_inverse=True)
                grad_w = np.bincount(place, each, len(used)) + SHRINK * self.weights[used]
                pull = each[:, None] * (np.repeat(sums, lengths, axis=0) - parts)
                grad_v = np.stack([np.bincount(place, pull[:, f], len(used)) for f in range(RANK)], axis=1) + SHRINK * self.factors[used]
                seen_w[used] += grad_w * grad_w
                seen_v[used] += grad_v * grad_v
                seen_b += error.sum() ** 2
                self.weights[used] -= RATE * grad_w / np.sqrt(seen_w[used])
                self.factors[used] -= RATE * 0.3 * grad_v / np.sqrt(seen_v[used])
                self.bias -= RATE * error.sum() / np.sqrt(seen_b)
        return self


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row with the pickled machine, or with the share of good rows if there is one kind only."""
    held = []
    for batch in batches:
        index, value = batch.column(2), batch.column(3)
        for i, (order, mark) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            held.append((order, mark, index[i].values.to_numpy(), value[i].values.to_numpy()))
    if not held:
        return
    held.sort(key=lambda row: row[:2])  # rows of one order are alike
    marks = np.array([row[1] for row in held], np.float64)
    if marks.min() == marks.max():
        model = float(np.clip(marks[0], 0.01, 0.99))
    else:
        model = Machine().fit([row[2:] for row in held], marks)
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])


def _rows(docs: DataFrame, doc_id: str, text: str, n_chars: str) -> DataFrame:
    size = F.col(n_chars).cast("long") if n_chars in docs.columns else F.lit(None).cast("long")
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"), size.alias("n_chars"))


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", max_training: int = MAX_TRAINING) -> DataFrame:
    """(order, mark, index, value) of the rows to learn from, moved to one task; they are found, and their features made, by as many tasks
    as there are: texts do not move."""
    agreed = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    marked = agreed.filter((F.col("low") == F.col("high")) & F.col("low").isin(0, 1) & ~held_out("doc_id")).select("doc_id", F.col("low").alias("mark"))
    chosen = bounded_ids(marked, "doc_id", max_training)
    rows = _rows(docs, doc_id, text, n_chars).join(F.broadcast(chosen), "doc_id")  # bounded: max_training ids
    # Ids that occur on more rows than one make no more training rows than the bound.
    rows = rows.withColumn("order", F.xxhash64("doc_id", "text", "n_chars"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(text.as_py(), n.as_py()) for text, n in zip(batch.column(2), batch.column(3), strict=True)]
            columns = [pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["order", "mark", "index", "value"])

    chosen_rows = bounded_ids(rows, "order", max_training).select("order", F.col("mark").cast("int").alias("mark"), "text", "n_chars")
    return chosen_rows.mapInArrow(made, "order bigint, mark int, index array<bigint>, value array<double>").repartition(1)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", max_training: int = MAX_TRAINING) -> Machine | float:
    """A machine, or a constant score where there is nothing to tell apart."""
    found = training_rows(docs, labels, doc_id, text, n_chars, max_training).mapInArrow(_trained, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else 0.5


def classify(docs: DataFrame, model: Machine | float, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", cut: float = CUT) -> DataFrame:
    """(doc_id, score, predicted) for each row of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES x (RANK + 1) numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in batches:
            pairs = zip(batch.column(1), batch.column(2), strict=True)
            scores = [machine if isinstance(machine, float) else machine.score(t.as_py(), n.as_py()) for t, n in pairs]
            predicted = pa.array([int(s >= cut) for s in scores], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), predicted], names=["doc_id", "score", "predicted"])

    rows = _rows(docs, doc_id, text, n_chars)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
