"""Hard negatives by L2AP-style threshold joins: for each anchor and each of its best same-label rows, the best rows of other labels
whose score lies in a window below that positive's score. A score is the inner product of integer vectors.

Index. Rows come in blocks, their dimensions ordered so that those with the least weight in the whole table come first. For a threshold
the first dimensions of a row, as long as their norm alone cannot reach it, are left out of the index; the others are held as posting
runs by groups of dimensions (rows sorted by where their postings begin, so the postings of a group are one slice). An anchor adds up
partial scores from the last group to the first, and pairs whose partial score plus the product of the remaining norms is below the
threshold are dropped on the way. What is left gets its missing dimensions added: every score that is returned is exact.

Thresholds. A search starts with high thresholds and is repeated with lower ones for the anchors whose lists are not full, at last
with none (positives) or with the lower end of the window (negatives). Within a task the threshold rises to the last score of a full
list. So the rows are those of comparing every anchor with every row, whatever the levels.

What moves: anchors are worked in blocks of about `ANCHORS`, hash-dealt, each sent to the tasks by value; the rows stay
where they are, and a task sends on at most a full list per query. Numbers of full lists, and the positives of one block, come to the
driver. A pass over the rows is made per block of anchors and threshold, so work is anchors times rows; that is what an exact search asks.

Defined results. Rows with a null id, label or vector, or a null or non-finite entry, take no part. A row is "other" if its id
differs from the anchor's. Repeated rows each count as a row; an anchor that stands twice is searched once. Ties go to the
smaller id. Vectors of different lengths are compared as if the shorter ended in zeros. Entries of any finite size are compared
exactly; a score that is no 64-bit number is an error. An empty table gives no rows, and other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardbook.llm.common import spark_schema
from wardbook.operators.keep import keep_table

#: Anchors in a block; a block's vectors go to every task.
ANCHORS = 16_384
#: Anchors and rows whose partial scores are held at once.
GROUP, ROWS = 256, 2_048
#: Dimensions of one posting run.
RUN = 8
#: Thresholds of the positives, as shares of the largest possible score; the last round has none.
POSITIVE_LEVELS = (0.7, 0.45, 0.25, None)
#: Thresholds of the negatives, as shares of the window's upper end; the last round takes the window's lower end.
NEGATIVE_LEVELS = (0.75, 0.5, None)
_EXACT = float(1 << 53)

_POSITIVE = {"anchor": pa.int64(), "score": pa.int64(), "vec_id": pa.int64()}
_NEGATIVE = {"query": pa.int64(), "last": pa.bool_(), "anchor_id": pa.int64(), "positive_id": pa.int64(), "positive_score": pa.int64(), "negative_id": pa.int64(), "negative_score": pa.int64(), "positive_rank": pa.int64()}
_WEIGHT = {"dim": pa.int64(), "weight": pa.float64()}


@dataclass
class Vectors:
    """Rows of a block: float64 matrix of whole numbers in the order of dimensions, ids and labels."""

    x: np.ndarray
    ids: np.ndarray
    labels: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)

    def at(self, rows: np.ndarray | slice) -> Vectors:
        return Vectors(self.x[rows], self.ids[rows], self.labels[rows])


def matrix(lists: pa.Array, order: np.ndarray) -> np.ndarray:
    """Lists as rows in the given order of dimensions; short ones end in zeros."""
    values = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), len(order)))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out[:, order]


def vectors(batch: pa.RecordBatch, order: np.ndarray) -> Vectors:
    ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    return Vectors(matrix(batch.column(2), order), ids, labels)


def _runs(dims: int) -> np.ndarray:
    return np.append(np.arange(0, dims, RUN), dims)


def prefix_norms(x: np.ndarray) -> np.ndarray:
    """Norm of the dimensions before each run, and of all."""
    squares = np.cumsum(np.square(x), axis=1)
    return np.sqrt(np.concatenate([np.zeros((len(x), 1)), squares], axis=1)[:, _runs(x.shape[1])])


def _whole(x: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)


class Index:
    """The postings of one block of rows for thresholds of at least `least` times an anchor's norm."""

    def __init__(self, rows: Vectors, least: float):
        norms = prefix_norms(rows.x)
        # Runs before `first` cannot reach the threshold by themselves: they are left out.
        first = (norms < least).sum(axis=1) - 1 if least > 0 else np.zeros(len(rows), np.int64)
        order = np.argsort(first, kind="stable")
        order = order[first[order] < norms.shape[1] - 1] if least > 0 else order
        self.rows, self.first, self.norms = rows.at(order), np.maximum(first[order], 0), norms[order]
        self.edges = _runs(rows.x.shape[1])
        self.small = float(np.abs(rows.x).max(initial=0))

    def search(self, a: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of every pair whose score is `least` or more for its anchor."""
        x, norms = self.rows.x, self.norms
        far = max(self.small, float(np.abs(a).max(initial=0)))
        if far * far * max(1, x.shape[1]) >= _EXACT:  # whole numbers of any size
            scores = np.dot(_whole(a), _whole(x).T) if len(x) else np.zeros((len(a), 0))
            bar = np.array([v if np.isinf(v) else int(np.ceil(v)) for v in least], object)
            i, j = np.nonzero((scores >= bar[:, None]).astype(bool))
            return i, j, np.array([int(scores[p]) for p in zip(i, j, strict=True)], np.int64)
        own = prefix_norms(a)
        cols, first = np.arange(len(x)), self.first
        bar = least[:, None] - 1e-9 * np.abs(np.nan_to_num(least, posinf=0, neginf=0))[:, None] - 1e-6
        sums = np.zeros((len(a), len(x)))
        for k in range(len(self.edges) - 2, -1, -1):
            part = slice(self.edges[k], self.edges[k + 1])
            posted = int(np.searchsorted(first, k, "right"))
            sums[:, :posted] += a[:, part] @ x[cols[:posted], part].T
            if not np.isfinite(least).any():
                continue
            # What the dimensions not yet added can bring at most.
            begin = np.maximum(first, k)
            alive = (sums + own[:, begin] * norms[cols, begin] >= bar).any(axis=0)
            if alive.sum() < 0.7 * len(cols):
                cols, first, sums = cols[alive], first[alive], sums[:, alive]
        i, j = np.nonzero(sums + own[:, first] * norms[cols, first] >= bar)
        scores, begin = sums[i, j], first[j]
        for k in range(int(begin.max(initial=0))):  # the dimensions left out
            at, part = np.flatnonzero(begin > k), slice(self.edges[k], self.edges[k + 1])
            scores[at] += np.einsum("ij,ij->i", a[i[at], part], x[cols[j[at]], part])
        good = scores >= least[i]
        return i[good], cols[j[good]], np.rint(scores[good]).astype(np.int64)


class Best:
    """The first `size` rows of each query, by falling score and rising id."""

    def __init__(self, queries: int, size: int):
        self.size, self.lowest = size, np.full(queries, -np.inf)
        self.query, self.score, self.row = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, query: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        if not len(query):
            return
        query, score, row = (np.concatenate(p) for p in ((self.query, query), (self.score, score), (self.row, row)))
        order = np.lexsort((row, -score, query))
        query, score, row = query[order], score[order], row[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query, "left")
        best = rank < self.size
        self.query, self.score, self.row = query[best], score[best], row[best]
        full = rank == self.size - 1
        self.lowest[query[full]] = score[full]


def _positives(anchors: Vectors, least: np.ndarray, numbers: np.ndarray, order: np.ndarray, size: int):
    norms = np.sqrt(np.square(anchors.x).sum(axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(anchors), size)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = vectors(batch.slice(at, ROWS), order)
                now = np.maximum(least, best.lowest)
                index = Index(rows, _least(now, norms))
                for start in range(0, len(anchors), GROUP):
                    part = anchors.at(slice(start, start + GROUP))
                    i, j, score = index.search(part.x, now[start : start + GROUP])
                    fits = (part.labels[i] == index.rows.labels[j]) & (part.ids[i] != index.rows.ids[j])
                    best.add(i[fits] + start, score[fits], index.rows.ids[j[fits]])
        yield from _out(_POSITIVE, [numbers[best.query], best.score, best.row])

    return run


@dataclass
class Windows:
    """Queries of a block: a positive of an anchor, and the scores that its negatives may have."""

    anchor: np.ndarray
    rank: np.ndarray
    positive: np.ndarray
    score: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def at(self, rows: np.ndarray) -> Windows:
        return Windows(*[getattr(self, f)[rows] for f in ("anchor", "rank", "positive", "score", "low", "high")])


def _negatives(anchors: Vectors, windows: Windows, least: np.ndarray, numbers: np.ndarray, order: np.ndarray, size: int):
    norms = np.sqrt(np.square(anchors.x).sum(axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(numbers), size)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = vectors(batch.slice(at, ROWS), order)
                wanted = np.maximum(least, best.lowest)
                # An anchor's threshold is the lowest of its windows'.
                now = np.full(len(anchors), np.inf)
                np.minimum.at(now, windows.anchor, wanted)
                index = Index(rows, _least(now, norms))
                for start in range(0, len(anchors), GROUP):
                    part = anchors.at(slice(start, start + GROUP))
                    i, j, score = index.search(part.x, now[start : start + GROUP])
                    other = part.labels[i] != index.rows.labels[j]
                    i, j, score = i[other] + start, j[other], score[other]
                    for rank in np.unique(windows.rank):
                        of = np.full(len(anchors), -1)
                        here = np.flatnonzero(windows.rank == rank)
                        of[windows.anchor[here]] = here
                        q = of[i]
                        fits = (q >= 0) & (score >= wanted[q]) & (score <= windows.high[q])
                        best.add(q[fits], score[fits], index.rows.ids[j[fits]])
        q = best.query
        anchor = windows.anchor[q]
        yield from _out(_NEGATIVE, [numbers[q], least[q] <= windows.low[q], anchors.ids[anchor], windows.positive[q], windows.score[q], best.row, best.score, windows.rank[q]])

    return run


def _least(thresholds: np.ndarray, norms: np.ndarray) -> float:
    """The least share of an anchor's norm that a row must bring; minus infinity if a row may score anything."""
    if not len(thresholds) or (thresholds <= 0).any():
        return -np.inf
    return float((thresholds / np.maximum(norms, 1e-300)).min()) * (1 - 1e-9)


def _out(kinds: dict[str, pa.DataType], columns: list[np.ndarray], size: int = 8192) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), size):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + size], k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))


def scaled(rows: DataFrame, factor: int, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, x) of the rows that take part; x: each entry times `factor`, rounded down."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = rows.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite)
    entries = F.transform(F.col(vector).cast("array<double>"), lambda v: F.floor(v * factor).cast("double"))
    return usable.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), entries.alias("x"))


def dimension_order(rows: DataFrame) -> tuple[np.ndarray, float]:
    """Dimensions by rising weight over all rows, and the largest norm of a row."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(0)
        for batch in batches:
            longest = int(pa.compute.max(pa.compute.list_value_length(batch.column(0))).as_py() or 0)
            found = np.square(matrix(batch.column(0), np.arange(longest))).sum(axis=0)
            size = max(len(sums), longest)
            sums = np.pad(sums, (0, size - len(sums))) + np.pad(found, (0, size - longest))
        yield from _out(_WEIGHT, [np.arange(len(sums)), sums])

    weights = rows.select("x").mapInArrow(weigh, spark_schema(_WEIGHT)).groupBy("dim").agg(F.sum("weight").alias("w")).orderBy("w", "dim").collect()
    square = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    return np.array([r["dim"] for r in weights], np.int64), float(rows.agg(F.coalesce(F.max(F.sqrt(square)), F.lit(0.0))).first()[0])


def _top(found: DataFrame, query: str, score: str, row: str, size: int) -> DataFrame:
    by_score = Window.partitionBy(query).orderBy(F.desc(score), row)
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= size)


def _find_positives(rows: DataFrame, anchors: Vectors, order: np.ndarray, largest: float, size: int) -> tuple[np.ndarray, ...]:
    """(anchor number, rank from 1, id, score) of the positives of a block."""
    norms = np.sqrt(np.square(anchors.x).sum(axis=1))
    todo, kept = np.arange(len(anchors)), []
    for level in POSITIVE_LEVELS:
        least = np.full(len(todo), -np.inf) if level is None else level * largest * norms[todo]
        found = rows.mapInArrow(_positives(anchors.at(todo), least, todo, order, size), spark_schema(_POSITIVE))
        got = _top(found, "anchor", "score", "vec_id", size).toPandas()  # at most `size` for each anchor of the block
        n = np.bincount(got["anchor"].to_numpy(np.int64), minlength=len(anchors))
        done = np.ones(len(anchors), bool) if level is None else n >= size
        kept.append(got[done[got["anchor"].to_numpy(np.int64)]])
        todo = todo[~done[todo]]
        if not len(todo):
            break
    return tuple(np.concatenate([k[c].to_numpy(np.int64) for k in kept]) for c in ("anchor", "rank", "vec_id", "score"))


def _block(anchors: DataFrame, order: np.ndarray) -> Vectors:
    """The anchors of one block, in the order of ids."""
    table = anchors.select("vec_id", "label", "x").orderBy("vec_id", "label", "x").toArrow().combine_chunks()
    batch = table.to_batches()[0] if table.num_rows else pa.RecordBatch.from_pylist([], schema=table.schema)
    return vectors(batch, order)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, anchors_at_once: int = ANCHORS
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank).

    `rows` has vec_id, label and x (see `scaled`). A negative's score is from `low` to `high` hundredths of its positive's score.
    """
    rows = keep_table(rows)
    anchors = keep_table(rows.where(is_anchor).distinct())
    order, largest = dimension_order(rows)
    blocks = max(1, -(-anchors.count() // anchors_at_once))
    out = []
    for block in range(blocks):
        dealt = F.pmod(F.xxhash64("vec_id", "label", "x"), F.lit(blocks)) == block
        part = _block(anchors.where(dealt) if blocks > 1 else anchors, order)
        if not len(part):
            continue
        anchor, rank, positive, score = _find_positives(rows, part, order, largest, positives)
        # Whole numbers: low * score <= 100 * s <= high * score.
        windows = Windows(anchor, rank, positive, score, -(-low * score // 100), high * score // 100)
        todo = np.flatnonzero(windows.low <= windows.high)
        for level in NEGATIVE_LEVELS:
            if not len(todo):
                break
            asked = windows.at(todo)
            least = asked.low.astype(float) if level is None else np.maximum(asked.low, np.ceil(level * asked.high))
            found = rows.mapInArrow(_negatives(part, asked, least, todo, order, negatives), spark_schema(_NEGATIVE))
            best = keep_table(_top(found, "query", "negative_score", "negative_id", negatives))
            best = best.withColumn("n", F.count("*").over(Window.partitionBy("query"))).where(F.col("last") | (F.col("n") >= negatives))
            out.append(best)
            done = best.select("query").distinct().toArrow()["query"].to_numpy()  # queries of one block
            todo = todo[(least > asked.low) & ~np.isin(todo, done)]
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank"]
    if not out:
        return rows.sparkSession.createDataFrame([], f"{spark_schema(_NEGATIVE)}, rank int").select(*names)
    return reduce(DataFrame.unionAll, [found.select(*names) for found in out])
