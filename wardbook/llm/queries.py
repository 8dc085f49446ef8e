"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.llm.chats import collapse_and_render
from wardbook.llm.common import held_out, read
from wardbook.llm.decontaminate import contamination
from wardbook.llm.factorisation import classify, train
from wardbook.llm.hard_negatives import hard_negatives, scaled
from wardbook.llm.language import dictionaries, identify
from wardbook.llm.licenses import license_scan
from wardbook.llm.quality_rules import quality_rules
from wardbook.llm.repeats import remove_repeats, repeated_words
from wardbook.llm.secrets import KINDS, listed, secrets
from wardbook.llm.sentencepiece_tokens import load, tokenize
from wardbook.llm.simhash import hex_digits, near_duplicates
from wardbook.llm.sql import SQL as SQL
from wardbook.llm.warc import base32_sha1, read_archives, write_pages
from wardbook.llm.whitening import whiten
from wardbook.operators.keep import keep_table, shared_folder

#: A public model file; a parameter of `op2_sentencepiece`.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_digits(found["code"]).alias("fingerprint"), "component_id")


def op2_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str = MODEL_PATH) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = tokenize(docs, load(docs, model_path))
    return found.select("doc_id", "ids", "n_tokens", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "round_trip", "parity")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes every page to archives in the shared folder and reads them back; lengths and digests of responses are of the payload as read."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    write_pages(read(spark, sf_dir, "pages"), path)
    back = read_archives(spark, path)
    whole = F.col("record_type") == "response"
    return back.select(
        "page_id",
        F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(whole, base32_sha1(F.col("payload"))).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        F.regexp_extract("refers_to", r"^urn:page:(-?\d+)$", 1).cast("long").alias("refers_to"),
    )


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = classify(docs, train(docs, read(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also the words in passages of over 50 words that stand elsewhere, many of which are less than 400 bytes."""
    docs = read(spark, sf_dir, "documents")
    found = remove_repeats(docs).select("doc_id", "hash", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    passages = keep_table(repeated_words(docs)).withColumnsRenamed({"doc_id": "text_id", "hash": "text_hash"})
    found = found.join(passages, (F.col("hash") == F.col("text_hash")) & F.col("doc_id").eqNullSafe(F.col("text_id")), "left")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.coalesce("n_repeated_words", F.lit(0).cast("long")).alias("n_repeated_words"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(list(KINDS)))

    def n_of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[n_of(kind) for kind in KINDS], F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    listed = F.array_join(F.col("items").cast("array<string>"), ",").cast("binary")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse_and_render(read(spark, sf_dir, "conversations"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return identify(docs, dictionaries(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation that is no long is NULL here."""
    found = whiten(read(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = scaled(rows.withColumn("label", label), 256)
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (op1_simhash, op2_sentencepiece, op3_warc, op4_quality_classifier, op5_suffix_dedup, op6_secrets, op7_quality_rules, op8_decontaminate, op9_chats, op10_language, op11_whitening, op12_licenses, op13_hard_negatives)
}
