"""Quality rules: a log-likelihood ratio of hashed n-grams, beside counted rules.

Every text is a bag of its overlapping 4-byte n-grams, hashed to 65,536 buckets. Two multinomials are counted: the raw corpus
over all documents, and the trusted target over all documents that labels mark as good. A document's score is the mean over its
n-grams of log(target / raw), so length does not matter; it is kept when the score reaches a fixed threshold. The counts are
whole numbers, summed in Spark; the tables that travel are of a fixed size (65,536 numbers), whatever the corpus.

Counted rules stand beside the score: a text of fewer than 50 words, or with more than half of its words inside 3-word windows
that the text repeats, is rejected whatever its score.

Defined results. Very long texts: whole. A score at the threshold is kept. Null or blank text: no words, all counts 0, score 0, rejected by the counted rules. Without trusted documents
there is no target, every score is 0 and only the counted rules decide. Repeated rows: each is counted and each comes back.
An empty table gives no rows. Labels with a null id or mark, and ids that labels contradict each other on, are not trusted.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.llm.bloom import Bloom
from wardbook.llm.common import bounded_ids, fresh, map_texts, spark_schema

BUCKETS = 1 << 16
NGRAM_BYTES = 4
#: Mean nats per n-gram below which a text is more like the rest of the corpus than like the target.
THRESHOLD = -0.4
SMOOTHING = 0.5
#: Trusted ids that are broadcast at most; with more, the texts that may be trusted are moved to them.
BROADCAST_IDS = 1_000_000
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
_SYMBOLS = b"#*$%&|<>"
_PIECE = 1 << 20

RULES = {
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "base_failed": pa.bool_(),
}
VERDICT = {**RULES, "kept": pa.bool_(), "score": pa.float64()}


def buckets(text: bytes, size: int = NGRAM_BYTES) -> Iterator[np.ndarray]:
    """The buckets of all n-grams of a text, a piece of it at a time."""
    for start in range(0, max(0, len(text) - size + 1), _PIECE):
        piece = np.frombuffer(text[start : start + _PIECE + size - 1], np.uint8).astype(np.uint32)
        n = len(piece) - size + 1
        gram = np.zeros(n, np.uint32)
        for i in range(size):
            gram = (gram << np.uint32(8)) | piece[i : i + n]
        yield (gram * np.uint32(2654435761)) >> np.uint32(16)


def rules(text: bytes | None) -> tuple[int, int, int, int, int, bool]:
    """What the counted rules say of a text, in the order of RULES."""
    text = text or b""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    seen = Counter(windows)
    repeated = 0
    if len(seen) < len(windows):
        end = 0  # of the words counted so far
        for i, window in enumerate(windows):
            if seen[window] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    return (
        len(words),
        len(b"".join(words).decode("utf-8", "replace")),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(words) < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * len(words),
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per bucket that a task has seen: n-grams of trusted texts, of all texts."""
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for text, trusted in zip(batch.column(0).cast(pa.binary()), batch.column(1), strict=True):
            for found in buckets(text.as_py() or b""):
                here = np.bincount(found, minlength=BUCKETS)
                counts[1] += here
                if trusted.as_py():
                    counts[0] += here
    some = np.flatnonzero(counts[1])
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[0, some]), pa.array(counts[1, some])], names=["bucket", "target", "raw"])


def trusted_ids(labels: DataFrame, bound: int | None = None) -> DataFrame:
    """Ids that labels agree on as good; all of them, or at most `bound`."""
    agreed = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    good = agreed.filter("low = 1 and high = 1").select("doc_id")
    return good if bound is None else bounded_ids(good, "doc_id", bound)


def log_ratios(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", broadcast_ids: int = BROADCAST_IDS) -> np.ndarray:
    """log(target / raw) for each bucket: raw over all of `docs`, target over all that are trusted."""
    trusted = trusted_ids(labels).withColumn("trusted", F.lit(True))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = spark_schema({"bucket": pa.int64(), "target": pa.int64(), "raw": pa.int64()})
    if trusted.count() <= broadcast_ids:
        rows = rows.join(F.broadcast(trusted), "doc_id", "left").select("text", "trusted")  # bounded: broadcast_ids ids
        found = rows.mapInArrow(_counted, schema)
    else:
        raw = rows.select("text", F.lit(False).alias("trusted")).mapInArrow(_counted, schema)
        key = F.xxhash64(F.col("doc_id").cast("string"))
        likely = rows.withColumn("key", key).filter(Bloom(trusted.select(key.alias("key"))).may_have("key"))
        good = likely.join(trusted.hint("shuffle_merge"), "doc_id").select("text", "trusted").mapInArrow(_counted, schema)
        found = raw.union(good.withColumn("raw", F.lit(0).cast("long")))
    sums = found.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))
    counts = np.zeros((2, BUCKETS))
    for row in sums.collect():  # one row per bucket at most
        counts[:, row["bucket"]] = row["target"], row["raw"]
    if not counts[0].sum():
        return np.zeros(BUCKETS)
    target, raw = (np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS)) for c in counts)
    return target - raw


def ratio_score(text: bytes | None, ratios: np.ndarray) -> float:
    total, n = 0.0, 0
    for found in buckets(text or b""):
        total += float(ratios[found].sum())
        n += len(found)
    return total / n if n else 0.0


def judge(docs: DataFrame, ratios: np.ndarray, text: str = "text", threshold: float = THRESHOLD, drop_text: bool = False, names: dict[str, str] | None = None) -> DataFrame:
    """`docs` with the columns of VERDICT (renamed by `names`)."""
    model = docs.sparkSession.sparkContext.broadcast(ratios)  # BUCKETS numbers

    def work():
        def values(texts):
            rows = []
            for t in texts:
                found, score = rules(t), ratio_score(t, model.value)
                rows.append((*found, not found[-1] and score >= threshold, score))
            return list(zip(*rows, strict=True)) if rows else [[] for _ in VERDICT]

        return values

    return map_texts(docs, work, {(names or {}).get(k, k): v for k, v in VERDICT.items()}, text, drop_text)


def quality_rules(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: its id and the columns of VERDICT."""
    ratios = log_ratios(docs, labels, doc_id, text)
    return judge(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), ratios, threshold=threshold, drop_text=True)


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that are kept, with the columns of `docs`."""
    names = {k: fresh(docs, k) for k in VERDICT}
    judged = judge(docs, log_ratios(docs, labels, doc_id, text), text, threshold, names=names)
    return judged.filter(F.col(names["kept"])).select(*[F.col(f"`{c}`") for c in docs.columns])
