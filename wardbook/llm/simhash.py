"""SimHash near-dedup: fingerprints linked through a hierarchical index in Gray order.

The index. A fingerprint of 64 bits within `distance` bits of another agrees with it on one of distance + 1 blocks of bits
at least. These block patterns are the topmost nodes: Spark deals every distinct fingerprint to its blocks' groups, and no
pair outside a group is ever looked at. Within a group the fingerprints are sorted by Gray rank, so neighbours differ in
few bits. Runs of eight become a node that holds the bits all of them share (a mask and a pattern); nodes of nodes follow;
what a parent already holds is taken out of its children. A search goes down from the top and adds the differences between
the query and each node's own shared bits; above `distance` the whole subtree goes. A subtree that already belongs to the
query's component goes too, so a dense ball of near copies costs no pairs. What leaves a group is a star per component.

The fingerprints are counted first. Where groups by one of distance + 1 blocks would be large on average, there are more blocks and more tables, each
with a wider key (`blocks_for`), so a fingerprint has a bounded number of copies however many there are. Groups that are beyond `group_rows`
fingerprints all the same are cut by hash into chunks; each pair of chunks is a task of its own, so any group size is worked exactly and in
bounded memory.

Defined results. Null or blank text: fingerprint zero, which links like any other. Very long texts: whole. A bit is set if it is set in over half
the hashes: at exactly half it is not. Rows without an id get their component's
smallest id (null if no row there has one). Repeated rows and ids: each row comes back. An empty table gives no rows. Other
columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.llm.common import emit, fresh, map_texts, spark_schema
from wardbook.llm.components import components
from wardbook.operators.keep import keep_table

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
#: Fingerprints that one task compares at once.
GROUP_ROWS = 32_768
_FAN = 8
_PAIRS_AT_ONCE = 1 << 20
_SEED = 42
_EDGE = {"u": pa.int64(), "v": pa.int64()}


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text's word shingles, as an unsigned number."""
    tokens = (text or b"").lower().split()  # of bytes: A-Z only, and the six ASCII blanks only
    if not tokens:
        return 0
    shingles = [b" ".join(tokens)] if len(tokens) < words else map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=_SEED), shingles), np.uint64)
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[start : start + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, column: str, text: str = "text", words: int = SHINGLE_WORDS, drop_text: bool = False) -> DataFrame:
    """`docs` with the fingerprint as a signed long."""

    def work():
        return lambda texts: [np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)]

    return map_texts(docs, work, {column: pa.int64()}, text, drop_text)


def _gray_rank(code: Column) -> Column:
    """The place of a code in Gray order: each bit XORed with all bits above it."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


class GrayIndex:
    """Hierarchical index over codes that are sorted by Gray rank."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        level = (codes, np.full(len(codes), ~np.uint64(0)))
        self.levels = [level]
        while len(level[0]) > _FAN:
            ones, some, mask = (f(level[i]) for f, i in ((self._all, 0), (self._any, 0), (self._all, 1)))
            shared = mask & ~(ones ^ some)
            level = (ones & shared, shared)
            self.levels.append(level)
        # What a parent holds, its children need not compare again.
        self.own = [mask & ~np.repeat(above[1], _FAN)[: len(mask)] for (_, mask), above in zip(self.levels, self.levels[1:], strict=False)]
        self.own.append(self.levels[-1][1])

    @staticmethod
    def _all(values: np.ndarray) -> np.ndarray:
        return np.bitwise_and.reduceat(values, np.arange(0, len(values), _FAN))

    @staticmethod
    def _any(values: np.ndarray) -> np.ndarray:
        return np.bitwise_or.reduceat(values, np.arange(0, len(values), _FAN))

    def search(self, queries: np.ndarray, distance: int, labels: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Positions (query, code) of all codes within `distance` bits of codes[query] that stand after the query.

        labels: leave out subtrees whose codes all have the query's label.
        """
        uniform = self._uniform(labels) if labels is not None else None
        top = len(self.levels) - 1
        query = np.repeat(queries, len(self.levels[top][0]))
        node = np.tile(np.arange(len(self.levels[top][0])), len(queries))
        far = np.zeros(len(query), np.int64)
        for depth in range(top, -1, -1):
            if depth < top:
                query, far = np.repeat(query, _FAN), np.repeat(far, _FAN)
                node = (node[:, None] * _FAN + np.arange(_FAN)).ravel()
                real = node < len(self.levels[depth][0])
                query, node, far = query[real], node[real], far[real]
            far = far + np.bitwise_count((self.codes[query] ^ self.levels[depth][0][node]) & self.own[depth][node])
            stay = (far <= distance) & ((node + 1) * _FAN**depth - 1 > query)
            if uniform is not None:
                stay &= uniform[depth][node] != labels[query]
            query, node, far = query[stay], node[stay], far[stay]
        return query, node

    def _uniform(self, labels: np.ndarray) -> list[np.ndarray]:
        """For each node the label that all its codes have, -1 if they differ."""
        out = [labels]
        for _ in self.levels[1:]:
            starts = np.arange(0, len(out[-1]), _FAN)
            low, high = np.minimum.reduceat(out[-1], starts), np.maximum.reduceat(out[-1], starts)
            out.append(np.where(low == high, low, -1))
        return out

    def stars(self, distance: int) -> np.ndarray:
        """For each code the position of the first code of its component."""
        labels = np.arange(len(self.codes))
        step = max(1, _PAIRS_AT_ONCE // len(self.codes))
        for start in range(0, len(self.codes), step):
            a, b = self.search(np.arange(start, min(start + step, len(self.codes))), distance, labels)
            while len(a):
                low, high = np.minimum(labels[a], labels[b]), np.maximum(labels[a], labels[b])
                np.minimum.at(labels, high, low)
                while not np.array_equal(flat := labels[labels], labels):
                    labels = flat
                apart = labels[a] != labels[b]
                a, b = a[apart], b[apart]
        return labels


def _link_groups(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stars() -> Iterator[tuple[int, int]]:
            for codes in _groups(batches):
                if len(codes) > 1:
                    first = GrayIndex(codes).stars(distance)
                    moved = np.flatnonzero(first != np.arange(len(codes)))
                    signed = codes.view(np.int64)
                    yield from zip(signed[moved].tolist(), signed[first[moved]].tolist(), strict=True)

        yield from emit(_EDGE, stars())

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The codes of each (group, chunk pair) from rows sorted by them; a group may span batches."""
    held_key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        group, pair, code = (batch.column(i).to_numpy() for i in range(3))
        code = code.view(np.uint64)
        cuts = np.flatnonzero((group[1:] != group[:-1]) | (pair[1:] != pair[:-1])) + 1
        for start, end in zip([0, *cuts], [*cuts, len(code)], strict=True):
            key = (group[start], pair[start])
            if key != held_key and held:
                yield np.concatenate(held)
                held = []
            held_key = key
            held.append(code[start:end])
    if held:
        yield np.concatenate(held)


def blocks_for(n: int, distance: int = MAX_DISTANCE, group_rows: int = GROUP_ROWS) -> int:
    """Into how many blocks of bits n codes are cut, so that groups by all but `distance` of them are small on average.

    Codes that differ in `distance` bits agree on all but that many blocks. More blocks are more tables, of wider keys: 4 of 16 bits,
    10 of 25, 20 of 32, 35 of 36 for three bits, so a code has 35 copies at most.
    """
    for blocks in range(distance + 1, distance + 4):
        if n >> (64 * (blocks - distance) // blocks) <= group_rows // 4:
            return blocks
    return distance + 4


def shared_bits(blocks: int, distance: int = MAX_DISTANCE) -> list[int]:
    """A mask per table: the bits of all blocks but `distance`."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(block, blocks - distance)]


def links(codes: DataFrame, distance: int = MAX_DISTANCE, group_rows: int = GROUP_ROWS, blocks: int | None = None) -> DataFrame:
    """Stars (u, v) that connect all distinct codes (column `code`) within `distance` bits of each other."""
    blocks = blocks or blocks_for(codes.count(), distance, group_rows)
    masks = shared_bits(blocks, distance)
    key = [F.xxhash64(F.lit(i), F.col("code").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m))) for i, m in enumerate(masks)]
    rows = codes.select("code", F.explode(F.array(*key)).alias("grp"))
    # Groups beyond the bound: their number of chunks. Few rows, as many as fingerprints / group_rows at most.
    large = rows.groupBy("grp").count().filter(F.col("count") > group_rows).select("grp", F.ceil(2 * F.col("count") / group_rows).alias("chunks"))
    rows = rows.join(large, "grp", "left").withColumn("own", F.when(F.col("chunks").isNotNull(), F.pmod(F.xxhash64("code"), F.col("chunks"))))
    others = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: c != F.col("own"))
    pairs = F.when(F.col("chunks").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(
        F.transform(others, lambda c: F.least(c, F.col("own")) * F.col("chunks") + F.greatest(c, F.col("own")))
    )
    dealt = rows.select("grp", F.explode(pairs).alias("pair"), "code").repartition("grp", "pair")
    sorted_rows = dealt.sortWithinPartitions("grp", "pair", _gray_rank(F.col("code")))
    return sorted_rows.mapInArrow(_link_groups(distance), spark_schema(_EDGE))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """(doc_id, code, root, component_id) for each row of `docs`.

    code: the fingerprint; root: one fingerprint of the component; component_id: the smallest doc_id of the component.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = keep_table(fingerprints(rows, "code", words=words, drop_text=True))
    return rows.join(classes(rows, distance, group_rows), "code").select("doc_id", "code", "root", "component_id")


def classes(rows: DataFrame, distance: int = MAX_DISTANCE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(code, root, component_id) for each distinct code of rows (doc_id, code)."""
    codes = keep_table(rows.groupBy("code").agg(F.min("doc_id").alias("first_id")))
    stars = components(links(codes.select("code"), distance, group_rows))
    placed = codes.join(stars.withColumnRenamed("node", "code"), "code", "left").withColumn("root", F.coalesce("root", "code"))
    placed = keep_table(placed)
    # Components of one code need no second look-up.
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return placed.join(least, "root", "left").select("code", "root", F.coalesce("component_id", "first_id").alias("component_id"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of `docs` per component: one that has the component's smallest id."""
    key, number, absent = fresh(docs, "text_hash"), fresh(docs, "id_number"), fresh(docs, "id_absent")

    def keyed(rows: DataFrame, doc: str) -> DataFrame:
        """A row is known by its text's hash and its id; a missing id is a value of its own."""
        return rows.withColumns({number: F.coalesce(F.col(doc), F.lit(0)), absent: F.col(doc).isNull()})

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text).isNull(), F.col(text)).alias(key))
    rows = keep_table(fingerprints(rows, "code", words=words, drop_text=True))
    # One row per component: of those with its smallest id, the one with the smallest hash.
    first = rows.join(classes(rows, distance), "code").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = first.groupBy("root").agg(F.min(F.struct("doc_id", key)).alias("first")).select("first.*")
    kept = [key, number, absent]
    docs_keyed = keyed(docs.withColumn(key, F.xxhash64(F.col(text).isNull(), F.col(text))), doc_id)
    chosen = docs_keyed.join(keyed(first, "doc_id").select(*kept), kept, "left_semi")
    # Repeated rows have met by the same columns already.
    return chosen.dropDuplicates(kept).select(*[F.col(f"`{c}`") for c in docs.columns])


def hex_digits(code: Column) -> Column:
    return F.lower(F.lpad(F.hex(code), 16, "0"))
