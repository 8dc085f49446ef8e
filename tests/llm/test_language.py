from __future__ import annotations

import random
import zlib

import pytest
import zstandard
from helpers import DOCS, LONG, MIDDLE, ODD, SMALL, odd_docs, table

from wardbook.llm import language, queries
from wardbook.llm.language import Encoders, dictionaries, identify


def test_held_out_accuracy(spark):
    langs = dict(table("documents", "doc_id, lang", MIDDLE))
    found = queries.op10_language(spark, MIDDLE).collect()
    assert len(found) == len(langs)
    out = [r for r in found if r.held_out]
    assert {r.doc_id for r in out} == {d for d in langs if zlib.crc32(str(d).encode()) % 4 == 2}
    assert sum(r.lang_pred == langs[r.doc_id] for r in out) / len(out) > 0.97
    sure = [r for r in out if not r.rejected]
    assert sum(r.lang_pred == langs[r.doc_id] for r in sure) / len(sure) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_learned_from_the_other_fold_alone(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    turned = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 'xx' ELSE lang END AS lang", "source", "n_chars")
    assert dictionaries(docs) == dictionaries(turned.repartition(5))
    assert all(len(content) <= language.DICTIONARY_BYTES + 400 for _, content in dictionaries(docs))


def test_the_smallest_encoding_wins():
    learned = [("a", b"abcabcabc" * 500), ("b", b"xyzzyxzzy" * 500)]
    encoders = Encoders(learned)
    text = b"zzyxyzzyxzzyxyz" * 300
    plain = []
    for _, content in learned:
        packer = zstandard.ZstdCompressor(level=language.LEVEL, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False)
        plain.append(sum(len(packer.compress(text[i : i + 2048])) for i in range(0, len(text), 2048)))
    # A digested dictionary is searched a little differently; the order is the same.
    assert (encoders.sizes(text)[0] > encoders.sizes(text)[1]) == (plain[0] > plain[1])
    assert encoders.answer(text)[0] == "b"
    name, score, margin, rejected = encoders.answer(b"Q")
    assert (name, score, margin, rejected) == ("a", 0.5, 0.0, True)


@pytest.mark.parametrize("text", [None, b"", b" \n", b"123 !!! #", "日本".encode()[:2]])
def test_texts_without_letters(text):
    assert Encoders([("a", b"abc")]).answer(text) == ("und", 0.0, 0.0, True)


def test_odd_rows(spark):
    docs = odd_docs(spark, [(3000, LONG, "la", "a", 1)])
    found = {r.doc_id: r for r in identify(docs, dictionaries(spark.read.parquet(f"{SMALL}/documents.parquet"))).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3, -5)] == ["und"] * 4
    assert found[5].lang_pred == "en" and found[3000].lang_pred in ("de", "en", "es", "fr")
    assert identify(docs, dictionaries(docs)).count() == len(ODD) + 1
    assert {r.lang_pred for r in identify(docs, []).collect()} == {"und"}
    none = spark.createDataFrame([], DOCS)
    assert dictionaries(none) == [] and identify(none, []).count() == 0


def _words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(300)]
    return " ".join(rng.choices(words, k=n))


def test_a_language_of_long_texts_has_a_dictionary(spark):
    """One book, four laws and a short text beside them; none of the long ones fits whole."""
    book = _words(1, 40_000)
    rows = [(4 * i, text, lang) for i, (text, lang) in enumerate([(book, "book"), *[(_words(2, 4_000), "law")] * 4, (_words(3, 20), "note"), (_words(3, 9_000), "note")])]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2] + [(None, book, "book"), (None, _words(2, 4_000), "law"), (None, _words(3, 20), "note"), (None, _words(3, 9_000), "note")]
    learned = dict(dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    assert set(learned) == {"book", "law", "note"}
    assert all(16 * 1024 < len(c) <= language.DICTIONARY_BYTES + language.MAX_TEXTS for c in learned.values())
    assert len(learned["book"]) > 60 * 1024
    first, last = learned["book"].split(b"\n")[0], learned["book"].split(b"\n")[-1]
    assert book.encode().startswith(first) and book.encode()[-4096:].find(last[-500:]) >= 0
    assert learned["note"].startswith(_words(3, 20).encode())  # short texts come first
    assert Encoders(list(learned.items())).answer(book[50_000:52_000].encode())[0] == "book"


def test_short_texts_among_many_others_are_all_used(spark):
    """The share of texts looked at follows from those that may be taken, not from all rows of the language."""
    empty = spark.range(30_000).selectExpr("id AS doc_id", "'' AS text", "'xx' AS lang")
    few = spark.createDataFrame([(None, f"short text {i}", "xx") for i in range(5)], "doc_id long, text string, lang string")
    content = dict(dictionaries(empty.union(few)))["xx"]
    assert sorted(content.split(b"\n")) == [b"short text %d" % i for i in range(5)]


def test_every_language_of_many_is_learned_and_compared_in_groups(spark):
    rows = [(None, _words(i, 60), f"l{i:03d}") for i in range(520)]
    learned = dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert [name for name, _ in learned] == [f"l{i:03d}" for i in range(520)]
    few = learned[:7]
    docs = odd_docs(spark, [(4000 + i, _words(i, 30), None, None, None) for i in range(7)])

    def found(at_a_time: int) -> list:
        return sorted((r.doc_id is None, r.doc_id or 0, r.lang_pred, round(r.score, 9), round(r.margin, 9), r.rejected) for r in identify(docs, few, at_a_time=at_a_time).collect())

    assert found(2) == found(512)
    assert [r[2] for r in found(2)][-8:-1] == [f"l{i:03d}" for i in range(7)]
