"""From raw documents to token ids: the text operators in a row, each working on all that the one before it kept.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's docs. All but the last
return the columns of `documents`. What the operators define for nulls, empty texts, ties, repeated rows and empty tables holds here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardbook.llm.common import read
from wardbook.llm.decontaminate import clean
from wardbook.llm.quality_rules import keep_good
from wardbook.llm.queries import MODEL_PATH
from wardbook.llm.secrets import mask
from wardbook.llm.sentencepiece_tokens import load, tokenize
from wardbook.llm.simhash import keep_first
from wardbook.operators.keep import keep_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return keep_good(docs, read(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays, the one with the smallest id."""
    return keep_first(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are little else go."""
    return clean(docs, read(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A placeholder stands for each secret."""
    return mask(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, checked by decoding and against the sentencepiece library."""
    return tokenize(docs, load(docs, MODEL_PATH)).select("doc_id", "ids", "n_tokens", "round_trip", "parity")


STAGES = [
    ("quality rules", quality),
    ("near copies", near_copies),
    ("decontamination", decontaminated),
    ("secrets", without_secrets),
    ("tokens", tokens),
]

#: SQL cannot express these stages; the tests hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = keep_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
