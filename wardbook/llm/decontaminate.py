"""Benchmark decontamination with a generalised suffix automaton.

The words of all benchmark items go into one suffix automaton per block of items. A document's words stream through it; the
automaton tracks the longest run of words, ending here, that stands in some item. Where that run reaches ten words, those
ten are a window of an item, and the state tells which items; shorter items are windows as a whole and are found on the
state's suffix links. Words inside a found window are hit. Words that stand in no item reset the automaton, so only runs of
item words that are long enough for a window are walked at all.

Blocks. The items are counted first. Up to `block_words` words (an item by itself may be longer) they are one block, which is sent to the tasks, and the
documents need one narrow pass. More items are dealt by hash to as many blocks as their words ask for and written to the shared folder; each block
in turn is sent to the tasks, which build its automaton once and let their documents stream past it. So neither the driver nor a task ever
holds more than one block, and a pass is made per block. Passes write the hits of texts by their hashes, of each different text once; only texts
that have any are joined with them, texts of others do not move.

Limits. A document loses its hit words' spans (texts keep everything else); beyond `max_coverage` hit words of a hundred
the document itself goes.

Defined results. Null or wordless documents: 0 words, nothing hit, kept. Very long texts: whole. Ties: a word inside several windows is hit once.
Repeated rows: each is judged by its text. Other columns play no part. Null or wordless items are no window. Items with the
same words are all reported; an item_id that occurs twice is reported once; items without an id hit, but are not listed.
Empty tables: no rows, or nothing hit.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.llm.bloom import Bloom
from wardbook.llm.common import emit, fresh, map_texts, spark_schema
from wardbook.operators.keep import keep_table

WINDOW_WORDS = 10
BLOCK_WORDS = 200_000
#: Hit words of a hundred beyond which a document goes as a whole.
MAX_COVERAGE = 80

# Word bytes are 0-9, a-z and everything beyond ASCII; A-Z become a-z and all others blanks.
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

FOUND = {"n_words": pa.int64(), "n_hit": pa.int64(), "items": pa.list_(pa.int64())}


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TO_WORDS).split()


class Automaton:
    """Suffix automaton of some items' words, with the windows of `size` words that it reports."""

    def __init__(self, items: Iterable[tuple[int | None, list[bytes]]], size: int = WINDOW_WORDS):
        self.size = size
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(item, [self.ids.setdefault(w, len(self.ids)) for w in found]) for item, found in items if found]
        for _, codes in coded:
            last = 0
            for code in codes:
                last = self._extend(last, code)
        #: Windows end in these states: full ones by state, whole short items by (state, length).
        self.full: dict[int, set] = {}
        self.short: dict[int, dict[int, set]] = {}
        self.shortest = min([size, *(len(codes) for _, codes in coded)])
        for item, codes in coded:
            state, length = 0, 0
            for code in codes:
                state, length = self.step(state, length, code)
                if length >= size:
                    self.full.setdefault(self.cut(state, size), set()).add(item)
            if len(codes) < size:
                self.short.setdefault(self.cut(state, len(codes)), {}).setdefault(len(codes), set()).add(item)
        #: The state itself or its nearest suffix link that short items end in.
        self.marked = [0] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.marked[state] = state if state in self.short else self.marked[self.link[state]]

    def _extend(self, last: int, code: int) -> int:
        following, link, length = self.next, self.link, self.length
        if code in following[last]:
            there = following[last][code]
            return there if length[there] == length[last] + 1 else self._clone(last, code, there)
        new = len(following)
        following.append({})
        link.append(0)
        length.append(length[last] + 1)
        state = last
        while state != -1 and code not in following[state]:
            following[state][code] = new
            state = link[state]
        if state != -1:
            there = following[state][code]
            link[new] = there if length[there] == length[state] + 1 else self._clone(state, code, there)
        return new

    def _clone(self, state: int, code: int, there: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[there]))
        self.link.append(self.link[there])
        self.length.append(self.length[state] + 1)
        self.link[there] = copy
        while state != -1 and self.next[state].get(code) == there:
            self.next[state][code] = copy
            state = self.link[state]
        return copy

    def step(self, state: int, length: int, code: int) -> tuple[int, int]:
        """The state and length of the longest run that ends with this word."""
        following = self.next
        while code not in following[state]:
            state = self.link[state]
            if state == -1:
                return 0, 0
            length = self.length[state]
        return following[state][code], length + 1

    def cut(self, state: int, length: int) -> int:
        """The state of the last `length` words of a longer run."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def windows(self, codes: list[int]) -> Iterator[tuple[int, int, set]]:
        """(first word, end, items) for every occurrence of a window in a run of item words."""
        state, length = 0, 0
        for i, code in enumerate(codes):
            state, length = self.step(state, length, code)
            if length >= self.size:
                yield i + 1 - self.size, i + 1, self.full[self.cut(state, self.size)]
            at = self.marked[state] if self.short else 0
            while at:
                for short, items in self.short[at].items():
                    if short <= length:
                        yield i + 1 - short, i + 1, items
                at = self.marked[self.link[at]]

    def find(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit spans (first word, end), merged and in order, and the items whose windows occur."""
        spans: list[tuple[int, int]] = []
        items: set = set()
        if len(found) < self.shortest or not self.ids:
            return spans, items
        codes = list(map(self.ids.get, found))
        codes.append(None)
        start = 0
        for end in [i for i, code in enumerate(codes) if code is None]:
            if end - start >= self.shortest:
                for first, last, which in self.windows(codes[start:end]):
                    spans.append((start + first, start + last))
                    items |= which
            start = end + 1
        return merge(spans), items


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def _counted_items(benchmark: DataFrame, item_id: str, text: str, block_words: int) -> tuple[DataFrame, int]:
    """(item_id, text, block) and the number of blocks; blocks of about `block_words` words or 16 times as many bytes."""
    items = benchmark.filter(F.col(text).isNotNull()).select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    n_words = F.size(F.regexp_extract_all("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0)))
    weight = items.agg(F.sum(F.greatest(n_words.cast("long"), (F.octet_length("text") / 16).cast("long")))).first()[0] or 0
    blocks = max(1, -(-weight // block_words))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int"))
    return (keep_table(items) if blocks > 1 else items), blocks


class _Block:
    """One block of items in a task; its automaton is built when the first texts come, once."""

    def __init__(self, shared, size: int):
        self.shared, self.size = shared, size
        self.automaton: Automaton | None = None

    def find(self, texts: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set]]:
        if self.automaton is None:
            self.automaton = Automaton(((item, words(raw.encode("utf-8", "surrogatepass"))) for item, raw in self.shared.value), self.size)
        return [self.automaton.find(text) for text in texts]


def _sent(items: DataFrame, block: int):
    """The items of one block, of counted size, for the tasks."""
    held = [tuple(r) for r in items.filter(F.col("block") == block).select("item_id", "text").collect()]
    return items.sparkSession.sparkContext.broadcast(held)


_HITS = {"h1": pa.int64(), "h2": pa.int64(), "spans": pa.list_(pa.int64()), "items": pa.list_(pa.int64())}


def _hits(docs: DataFrame, items: DataFrame, blocks: int, text: str, size: int) -> DataFrame:
    """(h1, h2, spans, items) of each different text that has any, from a pass per block; spans as first, end, first, end, ..."""
    texts = _hashed(docs, text).select("h1", "h2", F.col(text).cast("binary").alias("text")).filter("text IS NOT NULL")

    def passed(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            block = _Block(shared, size)
            for batch in batches:
                found = block.find([words(t.as_py()) for t in batch.column(2)])
                for h1, h2, (spans, which) in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), found, strict=True):
                    if spans:
                        yield h1, h2, [x for span in spans for x in span], [i for i in which if i is not None]

        hits = texts.mapInArrow(lambda batches: emit(_HITS, run(batches), 256), spark_schema(_HITS))
        return keep_table(hits.dropDuplicates(["h1", "h2"]))

    found = reduce(DataFrame.union, [passed(_sent(items, block)) for block in range(blocks)])
    # A row per block and different text: as many as there are blocks at most.
    return found.groupBy("h1", "h2").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))


def _hashed(docs: DataFrame, text: str) -> DataFrame:
    """128 bits of hash stand for a text."""
    return docs.withColumns({"h1": F.xxhash64(F.col(text)), "h2": F.xxhash64(F.col(text), F.lit(1))})


def _pairs(flat: list[int] | None) -> list[tuple[int, int]]:
    return merge(list(zip((flat or [])[::2], (flat or [])[1::2], strict=True)))


def contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WINDOW_WORDS, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """(doc_id, n_words, n_hit, items) for each row of `docs`; items are the ids of items with occurring windows."""
    items, blocks = _counted_items(benchmark, "item_id", "text", block_words)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if blocks > 1:
        hits = keep_table(_hits(docs, items, blocks, "text", size)).withColumnsRenamed({"h1": "t1", "h2": "t2"})
        counted = map_texts(_hashed(docs, "text"), lambda: lambda texts: [[len(words(t)) for t in texts]], {"n_words": pa.int64()}, drop_text=True)
        found = counted.join(hits, (F.col("h1") == F.col("t1")) & (F.col("h2") == F.col("t2")), "left")
        merged = {"doc_id": pa.int64(), **FOUND}

        def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            for batch in batches:
                for doc, n, spans, which in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield doc, n, sum(end - first for first, end in _pairs(spans)), sorted(which or [], key=str)

        found = found.select(F.col("doc_id").cast("long"), "n_words", "spans", "items")
        return found.mapInArrow(lambda batches: emit(merged, finish(batches), 1024), spark_schema(merged))
    shared = _sent(items, 0)

    def work():
        block = _Block(shared, size)

        def values(texts):
            found = [words(t) for t in texts]
            hits = block.find(found)
            return (
                [len(w) for w in found],
                [sum(end - first for first, end in spans) for spans, _ in hits],
                [sorted((i for i in which if i is not None), key=str) for _, which in hits],
            )

        return values

    return map_texts(docs, work, FOUND, drop_text=True)


def items_digest(items: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, items)).encode()).hexdigest()


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the bytes from each span's first word to its last."""
    places = []  # of words
    plain = text.translate(_TO_WORDS)
    at = 0
    for word in plain.split():
        at = plain.index(word, at)
        places.append((at, at + len(word)))
        at += len(word)
    kept, last = [], 0
    for first, end in spans:
        kept.append(text[last : places[first][0]])
        last = places[end - 1][1]
    return b"".join([*kept, text[last:]])


def _cut_out(rows: DataFrame, text: str, new: str, share: str, judged) -> DataFrame:
    """`rows` with the cut text in place of its spans (JSON in `new`), and the share that was covered."""
    names = rows.columns
    at, spans_at = names.index(text), names.index(new)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + f", `{share}` double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            cleaned, covered = judged(texts, [_pairs(json.loads(v)) if v else [] for v in batch.column(spans_at).to_pylist()])
            columns = [pa.array(cleaned, pa.string()) if i == spans_at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(covered, pa.float64())], names=[*names, share])

    return rows.mapInArrow(run, schema)


def clean(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", size: int = WINDOW_WORDS, max_coverage: int = MAX_COVERAGE, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """`docs` with hit spans cut out of the texts, without documents that are covered beyond the limit.

    A column n_chars follows its text where that changed; untouched rows come back as they are.
    """
    items, blocks = _counted_items(benchmark, "item_id", "text", block_words)
    new, share = fresh(docs, "cleaned"), fresh(docs, "share")

    def judged(texts, all_spans):
        cleaned, covered = [], []
        for t, spans in zip(texts, all_spans, strict=True):
            n = len(words(t)) if spans else 0
            cleaned.append(_without(t, spans).decode("utf-8", "replace") if spans else None)
            covered.append(100 * sum(end - first for first, end in spans) / n if n else 0.0)
        return cleaned, covered

    if blocks > 1:
        spans, h1, h2 = (fresh(docs, n) for n in ("spans", "h1", "h2"))
        hits = keep_table(_hits(docs, items, blocks, text, size)).select(F.col("h1").alias("t1"), F.col("h2").alias("t2"), F.col("spans").alias(spans))
        hashed = docs.withColumns({h1: F.xxhash64(F.col(text)), h2: F.xxhash64(F.col(text), F.lit(1))})
        likely = Bloom(hits.select("t1")).may_have(h1)
        joined = hashed.filter(likely).join(hits, (F.col(h1) == F.col("t1")) & (F.col(h2) == F.col("t2")), "left").drop("t1", "t2")
        # The spans of a row travel as text beside it, and are read where it is cut.
        joined = joined.withColumn(new, F.to_json(spans)).drop(spans, h1, h2)
        untouched = hashed.filter(~likely).drop(h1, h2).withColumns({new: F.lit(None).cast("string"), share: F.lit(0.0)})
        marked = _cut_out(joined, text, new, share, judged).unionByName(untouched)
    else:
        shared = _sent(items, 0)

        def work():
            block = _Block(shared, size)
            return lambda texts: judged(texts, [spans for spans, _ in block.find([words(t) for t in texts])])

        marked = map_texts(docs, work, {new: pa.string(), share: pa.float64()}, text)
    marked = marked.filter(F.col(share) <= max_coverage)
    kept = [
        F.coalesce(new, text).alias(c)
        if c == text
        else F.when(F.col(new).isNotNull(), F.length(new)).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars"
        else F.col(f"`{c}`")
        for c in docs.columns
    ]
    return marked.select(*kept)
