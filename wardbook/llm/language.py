"""Language identification by compression.

For each language a zstandard dictionary of raw content is filled with training texts. A text, in lower case like the
dictionaries, is cut into blocks of 2 KB, each is encoded with every language's dictionary, and the language with the smallest sum of sizes wins. Cutting bounds
memory and keeps a long text from becoming its own dictionary; the whole text is encoded. When the runner-up comes nearer than
`margin` (a share of the winner's size), the row is marked as rejected: the best guess stays in its column and the mark
stands beside it.

Learned from: texts with a language outside the held-out fold. A dictionary holds whole texts of its language, taken in the
order of their hashes (of id and text; repeated rows count once), up to `dictionary_bytes`; at most `max_texts` texts a language are
looked at. Texts over 16 KB come after those, as slices spread evenly over the text, and only where the shorter ones leave room. So
every language with a text that is not empty has a dictionary. Where there are more than `LANGUAGES_AT_A_TIME`, the documents are
encoded with one group of languages after the other and the smallest sizes of the groups are compared. Every document is encoded,
none is cut.

Defined results. Very long texts: whole. Null texts and texts without a letter: `und`, score 0, rejected. Equal sizes: the language with more
training rows, then the name; such a row is rejected. No learned language: `und`. Repeated rows: each comes back. Rows
without an id are not held out.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardbook.llm.common import hash_limit, hash_place, held_out, map_texts
from wardbook.operators.keep import keep_table

LEVEL = 6
DICTIONARY_BYTES = 64 * 1024
MAX_TEXTS = 400
#: Longest text (bytes) that goes into a dictionary whole; longer ones would fill it alone, and give slices.
MAX_TEXT_BYTES = 16 * 1024
SLICE_BYTES = 2048
BLOCK_BYTES = 2048
MARGIN = 0.02
#: Languages whose dictionaries (64 KB each) a task holds at a time.
LANGUAGES_AT_A_TIME = 512
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")

ANSWER = {"lang_pred": pa.string(), "score": pa.float64(), "margin": pa.float64(), "rejected": pa.bool_()}


def _slices(share: Column) -> Column:
    """About `share` bytes of the column `text`, in slices spread evenly over it; all of it where it is no longer."""
    chars = F.length("text")
    size = F.greatest(F.lit(1), F.floor(F.lit(SLICE_BYTES) * chars / F.col("bytes"))).cast("int")
    n = F.ceil(share / SLICE_BYTES).cast("int")
    starts = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.floor(i * (chars - size) / F.greatest(n - 1, F.lit(1))).cast("int") + 1)
    return F.when(F.col("bytes") <= share, F.col("text")).otherwise(F.array_join(F.transform(starts, lambda at: F.substring("text", at, size)), "\n"))


def dictionaries(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    dictionary_bytes: int = DICTIONARY_BYTES,
    max_texts: int = MAX_TEXTS,
) -> list[tuple[str, bytes]]:
    """(language, dictionary content) by falling number of training rows; only rows outside the held-out fold count."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id")
    )
    rows = rows.select("lang", F.xxhash64("doc_id", "text").alias("mark"), F.octet_length("text").alias("bytes"), "text")
    # Marks first: what is counted and ordered has no text, and repeated rows are one.
    marks = keep_table(rows.groupBy("lang", "mark", "bytes").agg(F.count("*").alias("n")))
    whole = min(MAX_TEXT_BYTES, dictionary_bytes)
    kinds = marks.withColumn("long", F.col("bytes") > whole)
    counted = kinds.groupBy("lang").agg(
        F.sum("n").alias("n"), F.count_if(~F.col("long") & (F.col("bytes") > 0)).alias("n_short"), F.count_if("long").alias("n_long")
    )
    sizes = [tuple(r) for r in counted.orderBy(F.desc("n"), "lang").collect()]  # one row a language
    if not sizes:
        return []
    languages = [name for name, _, _, _ in sizes]
    schema = "lang string, n_short bigint, n_long bigint, rank int"
    counts = F.broadcast(docs.sparkSession.createDataFrame([(name, short, long, i) for i, (name, _, short, long) in enumerate(sizes)], schema))
    # The window sees of each language little more than max_texts marks, however many rows there are.
    eligible = kinds.filter("bytes > 0").join(counts, "lang")
    few = eligible.filter(hash_place("mark") < hash_limit(4 * max_texts, F.when(F.col("long"), F.col("n_long")).otherwise(F.col("n_short"))))
    n_slots = -(-dictionary_bytes // whole)  # long texts that fill a dictionary
    order = Window.partitionBy("lang", "long").orderBy(hash_place("mark"), "mark", "bytes")
    taken = few.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= F.when(F.col("long"), n_slots).otherwise(max_texts))
    share = F.greatest(F.lit(whole), F.ceil(F.lit(dictionary_bytes) / F.least("n_long", F.lit(n_slots)))).cast("int")
    taken = taken.withColumn("share", F.when(F.col("long"), share).otherwise(F.col("bytes")))
    # As many texts as fill the dictionary: a running sum, long texts last; of the last long one, the driver takes what has room.
    size = F.least("bytes", "share")
    upto = F.sum(size).over(Window.partitionBy("lang").orderBy("long", "place").rowsBetween(Window.unboundedPreceding, 0))
    filled = taken.withColumn("upto", upto).filter(F.when(F.col("long"), F.col("upto") - size < dictionary_bytes).otherwise(F.col("upto") <= dictionary_bytes))
    filled = F.broadcast(filled.select("lang", "mark", "bytes", "rank", "long", "place", "share"))  # bounded: max_texts marks a language
    chosen = rows.join(filled, ["lang", "mark", "bytes"]).withColumn("text", _slices(F.col("share"))).drop("share")
    chosen = keep_table(chosen.dropDuplicates(["lang", "mark", "bytes"]))
    learned: list[tuple[str, bytes]] = []
    for start in range(0, len(languages), LANGUAGES_AT_A_TIME):
        content: dict[str, list[bytes]] = {}
        group = chosen.filter(F.col("rank").between(start, start + LANGUAGES_AT_A_TIME - 1))
        for row in group.orderBy("rank", "long", "place").collect():
            content.setdefault(row["lang"], []).append(row["text"].lower().encode("utf-8", "surrogatepass"))
        names = languages[start : start + LANGUAGES_AT_A_TIME]
        learned += [(name, b"\n".join(content[name])[: dictionary_bytes + max_texts]) for name in names if name in content]
    return learned


class Encoders:
    """One compressor per language, its dictionary digested once."""

    def __init__(self, learned: list[tuple[str, bytes]], level: int = LEVEL):
        self.names = [name for name, _ in learned]
        self.encoders = []
        for _, content in learned:
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=level)
            self.encoders.append(zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_content_size=False, write_checksum=False))

    def sizes(self, text: bytes, block: int = BLOCK_BYTES) -> list[int]:
        """Per language, the bytes that the whole text takes."""
        blocks = [text[i : i + block] for i in range(0, len(text), block)]
        return [sum(len(encoder.compress(b)) for b in blocks) for encoder in self.encoders]

    def nearest(self, text: bytes | None) -> tuple[int, int, int | None] | None:
        """(place, size, runner-up's size) of the smallest encoding; None without languages or without a letter."""
        plain = (text or b"").decode("utf-8", "replace").lower()
        if not self.names or not _LETTER.search(plain):
            return None
        sizes = self.sizes(plain.encode())
        best = min(range(len(sizes)), key=sizes.__getitem__)  # ties: the first, which has more training rows
        return best, sizes[best], min((s for i, s in enumerate(sizes) if i != best), default=None)

    def answer(self, text: bytes | None, margin: float = MARGIN) -> tuple[str, float, float, bool]:
        found = self.nearest(text)
        if found is None:
            return UNKNOWN, 0.0, 0.0, True
        best, size, second = found
        gap = (second - size) / size if second is not None else 1.0
        return self.names[best], 1.0 - 0.5 * 2.0 ** (-gap / 0.05), gap, gap < margin


def _nearest(docs: DataFrame, learned: list[tuple[str, bytes]], first: int) -> DataFrame:
    """`docs` with the nearest of a group of languages in the place of the text; `first` is the place of the group's first."""
    shared = docs.sparkSession.sparkContext.broadcast(learned)  # at most a group x dictionary_bytes

    def work():
        encoders = Encoders(shared.value)

        def values(texts):
            found = [encoders.nearest(t) or (None, None, None) for t in texts]
            return [[None if b is None else first + b for b, _, _ in found], [s for _, s, _ in found], [s for _, _, s in found]]

        return values

    return map_texts(docs, work, {"best": pa.int64(), "size": pa.int64(), "second": pa.int64()}, drop_text=True)


def _identify_in_groups(rows: DataFrame, learned: list[tuple[str, bytes]], margin: float, at_a_time: int) -> DataFrame:
    """Like `identify`, by one pass over the documents for each group of languages."""
    keyed = rows.withColumns({"k1": F.xxhash64(F.col("text").isNull(), "text"), "k2": F.xxhash64(F.lit(7), F.col("text").isNull(), "text")})
    groups = [_nearest(keyed, learned[i : i + at_a_time], i).withColumn("grp", F.lit(i)) for i in range(0, len(learned), at_a_time)]
    # Equal rows have equal answers: they go on as one with their number.
    once = reduce(DataFrame.unionAll, groups).groupBy("doc_id", "k1", "k2", "grp", "best", "size", "second").agg(F.count("*").alias("copies"))
    listed = F.sort_array(F.collect_list(F.struct("size", "best", "second")))  # one a group
    met = once.groupBy("doc_id", "k1", "k2").agg(F.max("copies").cast("int").alias("copies"), listed.alias("found"))
    near, after = F.col("found")[0], F.get("found", F.lit(1))
    met = met.select("doc_id", "copies", near["best"].alias("best"), near["size"].alias("size"), F.least(near["second"], after["size"]).alias("second"))
    names = F.broadcast(rows.sparkSession.createDataFrame([(i, name) for i, (name, _) in enumerate(learned)], "best bigint, lang_pred string"))
    gap = F.coalesce((F.col("second") - F.col("size")) / F.col("size"), F.lit(0.0))
    answers = met.join(names, "best", "left").withColumn("margin", gap)
    return answers.select(
        "doc_id",
        F.coalesce("lang_pred", F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(F.col("best").isNull(), 0.0).otherwise(1.0 - 0.5 * F.pow(F.lit(2.0), -F.col("margin") / 0.05)).alias("score"),
        "margin",
        (F.col("best").isNull() | (F.col("margin") < margin)).alias("rejected"),
        F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy"),
    ).drop("copy")


def identify(
    docs: DataFrame, learned: list[tuple[str, bytes]], doc_id: str = "doc_id", text: str = "text", margin: float = MARGIN, at_a_time: int = LANGUAGES_AT_A_TIME
) -> DataFrame:
    """(doc_id, lang_pred, score, margin, rejected) for each row of `docs`.

    score: 0.5 at a tie, rising towards 1 with the margin.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if len(learned) > at_a_time:
        return _identify_in_groups(rows, learned, margin, at_a_time)
    shared = docs.sparkSession.sparkContext.broadcast(learned)  # at most at_a_time x dictionary_bytes

    def work():
        encoders = Encoders(shared.value)

        def values(texts):
            answers = [encoders.answer(t, margin) for t in texts]
            return list(zip(*answers, strict=True)) if answers else [[] for _ in ANSWER]

        return values

    return map_texts(rows, work, ANSWER, drop_text=True)
