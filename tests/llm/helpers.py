"""Odd rows that every operator must take."""

from __future__ import annotations

import duckdb

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "Lorem ipsum dolor sit amet consectetur " * 20_000

#: Nulls in any column, empty and blank texts, ties, repeated rows, other characters.
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n\v\f\r ", "en", "a", 7),
    (None, "a text without an id", "en", None, 20),
    (5, "a text without an id", None, "a", 20),
    (6, "one", "en", "a", 3),
    (7, "two words", "en", "a", 9),
    (8, "Äpfel über alles   日本語 😀 é", "de", "a", 30),
    (9, "the same row twice, the same row twice", "en", "a", 38),
    (9, "the same row twice, the same row twice", "en", "a", 38),
    (10, "one id", "en", "a", 6),
    (10, "another text of that id", "fr", "b", 23),
    (-5, "12345 67890 !!! ###", "en", "a", 19),
    (12, "\x00 null \x00 bytes \x7f", "en", "a", 16),
]


def odd_docs(spark, more: list[tuple] = (), clashing: bool = True):
    """ODD as a frame, with columns named like those that operators add."""
    df = spark.createDataFrame([*ODD, *more], DOCS)
    if clashing:
        for name in ("code", "root", "component_id", "kept", "score", "spans", "hash", "first", "share", "cleaned", "masked", "count", "grp", "plain"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


def table(name: str, columns: str, sf: str = SMALL) -> list[tuple]:
    return duckdb.sql(f"SELECT {columns} FROM '{sf}/{name}.parquet'").fetchall()


def ordered(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))
