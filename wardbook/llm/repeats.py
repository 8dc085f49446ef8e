"""Repeat removal: every byte that a string of `length` bytes covers which also starts anywhere else.

Sparse suffixes. Each window of `length` bytes hangs on an anchor, chosen by its content alone; windows with one anchor in a row are
a stretch (suffix_index.Anchors). Equal windows have equal anchors, so only stretches whose anchor occurs twice can hold a
repeat, and only they go on. Equal stretches travel as one with their number.

Index. The candidate stretches are dealt by anchor. Each task feeds its share, anchor after anchor and batch by batch, to a logarithmic
family of suffix arrays (suffix_index.IndexFamily): a batch is sorted, merge-scanned against the levels there are for matches of
`length` bytes, and equal-sized levels merge. Matches are compared byte by byte. A family ends with its anchor (small anchors share one),
so a task holds one batch and one anchor.

Hot anchors. Equal windows agree on half of what they hold beside the anchor, on the left of it or on the right. The stretches of an anchor with
more than `hot_stretches` different ones are therefore dealt twice, by the anchor with those bytes on either side; each such group is a key like
an anchor, and a match lies in one of them. Where a group is still larger than
`large_group` (tens of thousands of different texts round more than half a window of equal bytes), its windows are counted one by one, by a 128-bit hash. The rows are the same whatever the limit.

Words. `repeated_words` finds passages by words instead of bytes (51 words are often less than 400 bytes): each word becomes 32 bits
of its hash, and the same anchors and suffix arrays look for equal runs of 51 of them.

What moves: anchors (8 bytes per about 130), stretches that may repeat, and the texts that hold them. Filters of fixed size (bloom.py)
keep other texts out of the joins. Nothing but those filters comes to the driver.

Defined results. Null text: as an empty one. Texts shorter than `length`: nothing removed. Very long texts: whole, worked in pieces of 2^18
windows. Ties (equal smallest hashes in a window): the leftmost is the anchor. Repeated rows: their texts stand twice, so
each loses what is repeated. Equal ids with different texts, and rows without an id: each row is judged by its own text. An
empty table gives no rows. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.llm.bloom import Bloom
from wardbook.llm.common import emit, spark_schema
from wardbook.llm.suffix_index import ANCHOR, LENGTH, Anchors, IndexFamily, Words, entry, identity, merged, runs
from wardbook.operators.keep import keep_table

#: Different stretches of one anchor (or anchor and bytes beside it) that one task may hold.
HOT_STRETCHES = 1_000
#: Stretches of an anchor and the bytes beside it beyond which their windows are counted.
LARGE_GROUP = 50_000
#: Words of a repeated passage, and of the strings whose smallest hash anchors it.
WORDS, ANCHOR_WORDS = 51, 10
#: Entries of a new batch of the index.
BATCH = 2_000

_ANCHOR = {"anchor": pa.int64()}
_STRETCH = {"doc_id": pa.int64(), "hash": pa.int64(), "first": pa.int64(), "windows": pa.int64(), "place": pa.int64(), "anchor": pa.int64(), "s1": pa.int64(), "s2": pa.int64()}
_CONTENT = {"dealt": pa.int64(), "anchor": pa.int64(), "s1": pa.int64(), "s2": pa.int64(), "copies": pa.int64(), "place": pa.int64(), "windows": pa.int64(), "content": pa.binary()}
_FOUND = {"s1": pa.int64(), "s2": pa.int64(), "runs": pa.list_(pa.int64())}
_WINDOW = {"dealt": pa.int64(), "w1": pa.int64(), "w2": pa.int64(), "s1": pa.int64(), "s2": pa.int64(), "at": pa.int64(), "copies": pa.int64()}
REMOVED = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept": pa.binary()}


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A row is known by its id and its text's hash."""
    content = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), content.alias("text")).withColumn("hash", F.xxhash64("text"))


def _anchors(rows: DataFrame, length: int, anchor: int, unit: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Anchors(length, anchor, unit=unit)
        yield from emit(_ANCHOR, ((h,) for batch in batches for text in batch.column(0) for _, _, _, h in cut.stretches(text.as_py())))

    return rows.select("text").mapInArrow(run, spark_schema(_ANCHOR))


def _stretches(rows: DataFrame, length: int, anchor: int, unit: int) -> DataFrame:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        cut = Anchors(length, anchor, unit=unit)
        for batch in batches:
            for doc, key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                text = raw.as_py()
                for first, windows, place, h in cut.stretches(text):
                    yield doc, key, first, windows, place - first, h, *identity(text[first * unit : (first + windows + length - 1) * unit])

    return rows.select("doc_id", "hash", "text").mapInArrow(lambda batches: emit(_STRETCH, found(batches)), spark_schema(_STRETCH))


def candidates(rows: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, unit: int = 1) -> DataFrame:
    """All stretches whose anchor occurs twice or more."""
    twice = keep_table(_anchors(rows, length, anchor, unit).groupBy("anchor").count().filter("count > 1").select("anchor"))
    likely = _stretches(rows, length, anchor, unit).filter(Bloom(twice).may_have("anchor"))
    return keep_table(likely.join(twice, "anchor", "left_semi"))


def _contents(rows: DataFrame, stretches: DataFrame, length: int, anchor: int, unit: int, sides: bool) -> DataFrame:
    """The bytes of each different stretch, cut from the text that was chosen for it; once, or once per side of its anchor."""
    by_text = stretches.groupBy("rep.doc_id", "rep.hash").agg(
        F.collect_list(F.struct("anchor", "s1", "s2", "copies", "rep.place", "rep.windows", "rep.first")).alias("cuts")
    )
    by_text = keep_table(by_text.withColumnsRenamed({"doc_id": "text_id", "hash": "text_hash"}))
    texts = rows.filter(Bloom(by_text.select("text_hash")).may_have("hash"))
    joined = texts.join(by_text, (texts["hash"] == by_text["text_hash"]) & texts["doc_id"].eqNullSafe(by_text["text_id"]))
    beside = (length - anchor + 1) // 2 * unit

    def keys(h: int, place: int, content: bytes) -> Iterator[int]:
        if not sides:
            yield h
            return
        place, end = place * unit, (place + anchor) * unit
        for side, held in ((b"l", content[place - beside : place] if place >= beside else b""), (b"r", content[end : end + beside])):
            if len(held) == beside:
                yield xxhash.xxh3_64_intdigest(side + h.to_bytes(8, "big", signed=True) + held) - (1 << 63)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for raw, cuts in zip(batch.column(0), batch.column(1), strict=True):
                text = raw.as_py()
                for c in cuts.as_py():
                    content = text[c["first"] * unit : (c["first"] + c["windows"] + length - 1) * unit]
                    for key in keys(c["anchor"], c["place"], content):
                        yield key, c["anchor"], c["s1"], c["s2"], c["copies"], c["place"], c["windows"], content

    return joined.select("text", "cuts").mapInArrow(lambda batches: emit(_CONTENT, cut(batches), 512), spark_schema(_CONTENT))


def _indexed(contents: DataFrame, length: int, unit: int, batch_entries: int) -> DataFrame:
    """(s1, s2, runs of repeated windows) by families of suffix arrays, one after the other in each task."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        family, new, last = IndexFamily(length, unit), [], None
        for batch in batches:
            for row in batch.to_pylist():
                if len(new) >= batch_entries:
                    family.add(new)
                    new = []
                if row["dealt"] != last and family.levels:
                    # What is held belongs to keys that are past.
                    family.add(new)
                    yield from ((*e.key, runs(e.found)) for e in family.repeats())
                    family, new = IndexFamily(length, unit), []
                last = row["dealt"]
                new.append(entry(row["dealt"], (row["s1"], row["s2"]), row["copies"], row["place"], row["windows"], row["content"], unit))
        family.add(new)
        yield from ((*e.key, runs(e.found)) for e in family.repeats())

    dealt = contents.repartition("dealt").sortWithinPartitions("dealt")
    return dealt.mapInArrow(lambda batches: emit(_FOUND, found(batches)), spark_schema(_FOUND))


def _counted(contents: DataFrame, length: int, unit: int) -> DataFrame:
    """The same for keys with too many stretches for a task: every window is a row, summed before it moves."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for row in batch.to_pylist():
                for t in range(row["windows"]):
                    digest = xxhash.xxh3_128_digest(row["content"][t * unit : (t + length) * unit])
                    halves = (int.from_bytes(digest[i : i + 8], "big", signed=True) for i in (0, 8))
                    yield row["dealt"], *halves, row["s1"], row["s2"], t, row["copies"]

    rows = contents.mapInArrow(lambda batches: emit(_WINDOW, windows(batches)), spark_schema(_WINDOW))
    key = ["dealt", "w1", "w2"]
    twice = rows.groupBy(key).agg(F.sum("copies").alias("n")).filter("n > 1").select(key)
    return rows.join(twice, key, "left_semi").groupBy("s1", "s2").agg(F.flatten(F.collect_set(F.array(F.col("at"), F.col("at") + 1))).alias("runs"))


def _found(rows: DataFrame, stretches: DataFrame, length: int, anchor: int, unit: int, hot_stretches: int, large_group: int, batch_entries: int) -> DataFrame:
    """(s1, s2, runs); a stretch may come more than once."""
    hot = keep_table(stretches.groupBy("anchor").count().filter(F.col("count") > hot_stretches).select("anchor"))
    if hot.isEmpty():
        return _indexed(_contents(rows, stretches, length, anchor, unit, False), length, unit, batch_entries)
    cold = _contents(rows, stretches.join(hot, "anchor", "left_anti"), length, anchor, unit, False)
    sides = keep_table(_contents(rows, stretches.join(hot, "anchor", "left_semi"), length, anchor, unit, True))
    large = keep_table(sides.groupBy("dealt").count().filter(F.col("count") > large_group).select("dealt"))
    small = sides.join(large, "dealt", "left_anti").select(*_CONTENT)
    found = _indexed(cold.union(small), length, unit, batch_entries)
    return found if large.isEmpty() else found.union(_counted(sides.join(large, "dealt", "left_semi").select(*_CONTENT), length, unit))


def repeated_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR, hot_stretches: int = HOT_STRETCHES, large_group: int = LARGE_GROUP, batch_entries: int = BATCH
) -> DataFrame:
    """(doc_id, hash, spans): for each text that has any, the starts of repeated windows as first, end, first, end, ..."""
    return _spans(_keyed(docs, doc_id, text), length, anchor, 1, hot_stretches, large_group, batch_entries)


def _spans(rows: DataFrame, length: int, anchor: int, unit: int, hot_stretches: int, large_group: int, batch_entries: int) -> DataFrame:
    likely = candidates(rows, length, anchor, unit)
    rep = F.min(F.struct("doc_id", "hash", "first", "place", "windows")).alias("rep")
    stretches = keep_table(likely.groupBy("anchor", "s1", "s2").agg(F.count("*").alias("copies"), rep))
    found = keep_table(_found(rows, stretches, length, anchor, unit, hot_stretches, large_group, batch_entries))
    placed = likely.select("doc_id", "hash", "first", "s1", "s2").join(found, ["s1", "s2"])
    shifted = placed.select("doc_id", "hash", F.transform("runs", lambda r: r + F.col("first")).alias("runs"))
    return shifted.groupBy("doc_id", "hash").agg(F.flatten(F.collect_list("runs")).alias("spans"))


def repeated_words(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, anchor: int = ANCHOR_WORDS, hot_stretches: int = HOT_STRETCHES, large_group: int = LARGE_GROUP, batch_entries: int = BATCH
) -> DataFrame:
    """(doc_id, hash, n_repeated_words) of the texts that have any: words in runs of `words` words that start anywhere else too.

    hash: xxhash64 of the text's bytes, as in `remove_repeats`. Words are [^\\x20\\x09-\\x0D]+ and compared as they are, whatever stands between.
    """
    kept = {"doc_id": pa.int64(), "text": pa.binary(), "hash": pa.int64()}

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        cut = Words()
        for batch in batches:
            for doc, raw, key in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                codes = cut.codes(raw.as_py())
                if len(codes) >= 4 * words:
                    yield doc, codes, key

    rows = _keyed(docs, doc_id, text).mapInArrow(lambda batches: emit(kept, coded(batches), 256), spark_schema(kept))
    # Written once: made again for each reading, the codes would put one more Python worker into every task that reads them.
    spans = _spans(keep_table(rows), words, anchor, 4, hot_stretches, large_group, batch_entries)
    ends = F.transform("spans", lambda v, i: F.when(i % 2 == 0, v).otherwise(v - 1 + words))
    counted = {"doc_id": pa.int64(), "hash": pa.int64(), "n_repeated_words": pa.int64()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for doc, key, edges in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield doc, key, sum(b - a for a, b in merged(list(zip(edges[::2], edges[1::2], strict=True))))

    return spans.withColumn("spans", ends).mapInArrow(lambda batches: emit(counted, count(batches)), spark_schema(counted))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, **settings: int) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, hash) for each row of `docs`; kept: the remaining bytes, hash: xxhash64 of the text's bytes."""
    rows = _keyed(docs, doc_id, text)
    spans = keep_table(repeated_spans(docs, doc_id, text, length, **settings)).withColumnsRenamed({"doc_id": "text_id", "hash": "text_hash"})
    hit = Bloom(spans.select("text_hash")).may_have("hash")
    untouched = rows.filter(~hit).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("text").alias("kept"), "hash")
    texts = rows.filter(hit)
    joined = texts.join(spans, (texts["hash"] == spans["text_hash"]) & texts["doc_id"].eqNullSafe(spans["text_id"]), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for doc, raw, starts, key in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                content = raw.as_py()
                gone = merged([(a, b - 1 + length) for a, b in zip((starts or [])[::2], (starts or [])[1::2], strict=True)])
                edges = [0, *(x for span in gone for x in span), len(content)]
                kept = b"".join(content[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                yield doc, len(content), len(content) - len(kept), len(gone), kept, key

    kinds = {"doc_id": pa.int64(), **REMOVED, "hash": pa.int64()}
    return untouched.union(joined.select("doc_id", "text", "spans", texts["hash"]).mapInArrow(lambda batches: emit(kinds, cut(batches), 256), spark_schema(kinds)))

