"""License scan: phrases that name a license, and text blocks that hold most of a license notice, by an exact set-similarity join.

Tokens are pairs of neighbouring words. A template is the set of its tokens; a block is `2 * step` words of a text from word 0, step,
2 * step, ..., where step is the number of words of the longest template, so a passage of a template's length always lies in one block
whole. A block has a template's label if it holds at least `share` (0.8) of the template's tokens. Every such block is found:

* A first pass over the texts counts words and phrases and keeps, of each block, the tokens that any template has, if they are
  as many as the easiest template needs (length filter). It writes these, without the texts, to the shared folder.
* Tokens are ordered by their number of blocks in the whole corpus, the rarest first. A block that holds `need` tokens of a template has
  one of them among its first `size - need + 1` and among the template's, so only these prefixes are joined (prefix filter), the
  block must be long enough for that template (length filter), and what follows the common token on either side must
  suffice (positional filter). What is left is compared token by token.

What moves: one row per text without its text; the frequencies (as many as the templates have tokens) and the templates are the
only things that come to the driver or are broadcast. Templates are a parameter of at most `MAX_WORDS` words (more is an error).

Defined results. Null text: no words, as an empty one. Very long texts: whole, with as many blocks as they need. Ties: a block may have
several labels, a label is listed once; two templates of one label count as either. Repeated rows, and rows without or with the same id: each is
judged for itself. An empty table gives no rows. Other columns play no part, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.llm.common import map_texts
from wardbook.operators.keep import keep_table

#: Phrases of the base scan and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices of public licenses, (label, text).
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc-4.0", "licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by-sa-4.0", "licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
SHARE = 0.8
MAX_WORDS = 1_000_000

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: bytes | None) -> list[bytes]:
    """Bytes lower-case only A-Z; the pattern is [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ in UTF-8."""
    return _WORD.findall((text or b"").lower())


class Notices:
    """Templates as sets of numbered tokens."""

    def __init__(self, templates: Sequence[tuple[str, str]], share: float):
        cut = [words(text.encode()) for _, text in templates]
        if any(len(c) < 2 for c in cut):
            raise ValueError("a template needs two words")
        if sum(map(len, cut)) > MAX_WORDS:
            raise ValueError(f"templates hold more than {MAX_WORDS} words")
        phrases = [words(p.encode()) for p in PHRASES]
        self.labels = [label for label, _ in templates]
        self.step = max(map(len, cut))
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for part in [*cut, *phrases] for w in part}))}
        sets = [{self._code(*pair) for pair in zip(c, c[1:], strict=False)} for c in cut]
        self.codes = np.array(sorted(set().union(*sets)), np.int64)
        self.sets = [np.searchsorted(self.codes, sorted(s)).tolist() for s in sets]
        self.needs = [math.ceil(share * len(s) - 1e-9) for s in sets]
        self.phrases = [([self.vocabulary[w] for w in p], label) for p, label in zip(phrases, PHRASES.values(), strict=True)]

    def _code(self, a: bytes, b: bytes) -> int:
        return self.vocabulary[a] * len(self.vocabulary) + self.vocabulary[b]

    def scan(self, text: bytes | None) -> tuple:
        """Words, phrases with their first and last place and labels, and the tokens of the blocks that may hold a template."""
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in words(text)), np.int64)
        places, labels = [], set()
        for phrase, label in self.phrases:
            starts = np.arange(max(0, len(ids) - len(phrase) + 1))
            for at, word in enumerate(phrase):
                starts = starts[ids[starts + at] == word]
            places += starts.tolist()
            labels |= {label} if len(starts) else set()
        at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        code = ids[at] * len(self.vocabulary) + ids[at + 1]
        token = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        known = self.codes[token] == code
        return len(ids), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), self._blocks(at[known], token[known])

    def _blocks(self, at: np.ndarray, token: np.ndarray) -> list[list[int]]:
        block = at // self.step
        before = (block > 0) & ((at + 1) // self.step == block)
        both = np.unique(np.concatenate([block * len(self.codes) + token, (block[before] - 1) * len(self.codes) + token[before]]))
        which, starts = np.unique(both // len(self.codes), return_index=True)
        return [part.tolist() for part in np.split(both % len(self.codes), starts[1:]) if len(part) >= min(self.needs)] if len(which) else []


_SCANNED = {"row": pa.int64(), "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "blocks": pa.list_(pa.list_(pa.int32()))}


def _scanned(docs: DataFrame, text: str, notices: Notices) -> DataFrame:
    """One row per text, numbered; written once, so that the numbers stay."""

    def work():
        number = TaskContext.get().partitionId() << 40

        def values(texts):
            nonlocal number
            found = [notices.scan(t) for t in texts]
            rows = range(number, number + len(found))
            number += len(found)
            return [rows, *zip(*found, strict=True)]

        return values

    return keep_table(map_texts(docs, work, _SCANNED, text, drop_text=True))


def _matches(scanned: DataFrame, notices: Notices) -> DataFrame:
    """(row, label, share of the template) of every block and template that meet."""
    spark = scanned.sparkSession
    blocks = scanned.select("row", F.posexplode("blocks").alias("block", "tokens"))
    seen = {r["token"]: r["n"] for r in blocks.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n")).collect()}
    order = sorted(range(len(notices.codes)), key=lambda t: (seen.get(t, 0), t))  # rarest first
    rank = {t: i for i, t in enumerate(order)}
    ranks = F.lit([rank[t] for t in range(len(order))])
    index = []
    for template, (tokens, need) in enumerate(zip(notices.sets, notices.needs, strict=True)):
        ranked = sorted(rank[t] for t in tokens)
        index += [(t, place, template, notices.labels[template], need, ranked) for place, t in enumerate(ranked[: len(ranked) - need + 1])]
    index = F.broadcast(spark.createDataFrame(index, "t int, t_place int, template int, label string, need int, t_tokens array<int>"))
    ranked = F.array_sort(F.transform("tokens", lambda t: F.get(ranks, t)))
    blocks = blocks.select("row", "block", ranked.alias("tokens")).withColumn("size", F.size("tokens"))
    prefix = F.slice("tokens", F.lit(1), F.col("size") - min(notices.needs) + 1)
    probes = blocks.select("*", F.posexplode(prefix).alias("place", "t"))
    rest = 1 + F.least(F.col("size") - F.col("place") - 1, F.size("t_tokens") - F.col("t_place") - 1)
    met = probes.join(index, "t").where((F.col("size") >= F.col("need")) & (F.col("place") <= F.col("size") - F.col("need")) & (rest >= F.col("need")))
    common = F.size(F.array_intersect("tokens", "t_tokens"))
    return met.where(common >= F.col("need")).select("row", "label", (common / F.size("t_tokens")).alias("share"))


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES, share: float = SHARE) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for each row of `docs`.

    score: the largest share of a template that a block holds, if that is `share` or more; 1 where a phrase stands; else 0.
    """
    notices = Notices(templates, share)
    scanned = _scanned(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", notices)
    found = _matches(scanned, notices).groupBy("row").agg(F.collect_set("label").alias("found"), F.max("share").alias("most"))
    base = F.filter(F.split("base_labels", ","), lambda v: v != "")
    labels = F.array_sort(F.array_union(base, F.coalesce("found", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("most", F.lit(0.0)))
    return scanned.drop("blocks").join(found, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", F.array_join(labels, ",").alias("labels"), score.alias("score")
    )
