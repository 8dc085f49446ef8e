"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Everything is DataFrame functions in one narrow pass. A pattern's matches come as pieces (what stands before a match, and the match);
running sums of the pieces' lengths give positions in code points. The base patterns are `assign`, `access` and `hex`.

The method adds `markov` spans: long tokens with a digit and a letter whose characters follow each other as in random strings
rather than as in identifiers, by the mean log-likelihood ratio of two first-order models. Separators (+ / _ = -) stand in paths,
dates and names as well as in random strings, so pairs with one are not scored, nor are numbers and times between separators. A piece
between separators that is a word in whatever case, or words run together with capitals, is scored in lower case and without a number
behind it: a corpus need not hold identifiers in every case. The models are trained from samples that the base
patterns label: values that these find are random strings, other words are ordinary identifiers. The random model is mixed
with equal chances for every character, so alphabets beyond those seen count as random as well. The samples come from at most
`sample_docs` documents (those with the lowest hashes of their ids); all documents are scanned. The models are a table of a
fixed size (67 x 67 numbers).

Work on a text grows with its length and, but for sorting, with its number of spans: lists are run along in blocks, and masked in pieces.

Defined results. Null text: as an empty one, no spans, and null text stays null when masked. Very long texts: whole. Overlapping spans: base kinds may
overlap each other and all are listed; a markov span that touches a base span is left out. Ties in start: in the order of KINDS.
Nothing to learn from: equal chances on both sides, no markov spans. Repeated rows: each comes back. An empty table gives no rows.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.llm.common import bounded_ids, fresh


def _either_case(words: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


KEYWORDS = _either_case("password|passwd|secret|token|api_?key")
#: kind: (pattern, its group that must be long enough, least length). `assign` takes all it can and short matches are dropped
#: after, for a dropped match hides what stands in it. Runs of the other two hide nothing but parts of themselves, which are
#: shorter still, so their least length can stand in the pattern.
KINDS = {
    "assign": (f"({KEYWORDS})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    "access": ("(AKIA[A-Z0-9]{16,})", 1, 20),
    "hex": ("([0-9a-f]{24,})", 1, 24),
}
MARKOV = "markov"
TOKEN = "([A-Za-z0-9+/_=-]{16,})"
IDENTIFIER = "[A-Za-z_][A-Za-z0-9_]{7,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Pieces between separators that are a number or a time, and that are a word, or words run together, with or without a number.
NUMBER = "^[0-9]+(T[0-9]+)?Z?$"
WORDS = "^([A-Z]+|[A-Z]?[a-z]+)([A-Z][a-z]+)*[0-9]*$"
#: Mean nats per pair of characters above which a token is more like a random string.
THRESHOLD = 3.5
#: The mean is over as many pairs at least: a few odd ones in a date are no random string.
LEAST_PAIRS = 10
#: Weight of a character's own chance against its counts after another.
FALLBACK = 8.0
SAMPLE_DOCS = 20_000
_WIDTH = len(ALPHABET)
_SEPARATORS = ALPHABET.index("+")
_BLOCK = 64
#: Code points of a piece that a text is masked in, and a position after all others.
_CHUNK = 4_096
_FAR = 2**31 - 1
PLACEHOLDER = "[SECRET]"


def _running(values: Column, join: Callable[[Column, Column], Column] = lambda a, b: a + b, start: int = 0) -> Column:
    """Sums (or what else `join` makes) up to and with each element, in blocks: no list is copied once per element."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(_BLOCK))
    blocks = F.transform(starts, lambda s: F.slice(values, s, _BLOCK))

    def grown(done: Column, more: Column) -> Column:
        return F.concat(done, F.array(join(F.element_at(done, -1), more)))

    def sums(block: Column, base: Column) -> Column:
        return F.slice(F.aggregate(block, F.array(base), grown), 2, F.size(block))

    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(start), join))
    bases = F.aggregate(totals, F.array(F.lit(start)), grown)
    # Side by side: what a lambda names from outside is worked out again for each element.
    return F.flatten(F.zip_with(blocks, F.slice(bases, F.lit(1), F.size(blocks)), sums))


def _once(values: Column) -> Column:
    """Values of a column that is worked out where it is defined. A lambda that looks into a plain column may get its definition
    instead, by Spark's merging of projections, and work it out for each element; this one counts as not deterministic, and stays."""
    return F.when(F.monotonically_increasing_id() >= 0, values)


def _with_running(df: DataFrame, name: str, values: Column, join: Callable[[Column, Column], Column] = lambda a, b: a + b, start: int = 0) -> DataFrame:
    """`df` with running values; what they are made from is a column of its own first, so that it is worked out once and not per block."""
    source = fresh(df, "running")
    return df.withColumn(source, _once(values)).withColumn(name, _running(F.col(source), join, start)).drop(source)


def _larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _smaller(a: Column, b: Column) -> Column:
    return F.least(a, b)


def _before(running: Column, start: int = 0) -> Column:
    """What stands before each element: the running values one place later."""
    return F.concat(F.array(F.lit(start)), F.slice(running, 1, F.greatest(F.size(running) - 1, F.lit(0))))


def _pieces(text: Column, pattern: str) -> Column:
    """The text cut after each match; the last piece has none. Texts without a match are not cut."""
    whole = f"(?s)(.*?)(?:{pattern}|\\z)"
    return F.when(text.rlike(pattern), F.regexp_extract_all(text, F.lit(whole), F.lit(0)))


def _spans(pieces: Column, ends: Column, kind: str, order: int, pattern: str, group: int, least: int) -> Column:
    """(start, order, end, kind, value) for each long enough match."""

    def span(piece: Column, end: Column) -> Column:
        match = F.regexp_extract(piece, pattern, 0)
        return F.struct(
            (end - F.length(match)).alias("start"),
            F.lit(order).alias("place"),
            end.alias("end"),
            F.lit(kind).alias("kind"),
            F.regexp_extract(piece, pattern, group).alias("value"),
        )

    found = F.filter(F.zip_with(pieces, ends, span), lambda s: F.length(s["value"]) >= least)
    return F.coalesce(found, F.array().cast("array<struct<start:int,place:int,end:int,kind:string,value:string>>"))


def _with_matches(df: DataFrame, text: str, kinds: dict[str, tuple[str, int, int]], first: int, column: str) -> DataFrame:
    """`df` with the spans of all kinds in one array column."""
    names = {k: (fresh(df, f"p_{k}"), fresh(df, f"e_{k}")) for k in kinds}
    # Pieces and ends are columns of their own, so that each is worked out once.
    df = df.withColumns({names[k][0]: _pieces(F.col(text), v[0]) for k, v in kinds.items()})
    for pieces, ends in names.values():
        df = _with_running(df, ends, F.transform(pieces, F.length))
    spans = [_spans(F.col(names[k][0]), F.col(names[k][1]), k, first + i, *v) for i, (k, v) in enumerate(kinds.items())]
    return df.withColumn(column, F.concat(*spans)).drop(*[n for pair in names.values() for n in pair])


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS) -> list[float]:
    """log(random / ordinary) for each pair of characters of ALPHABET, row by row."""
    ids = bounded_ids(docs.select(F.col(doc_id).alias("doc_id")).filter("doc_id is not null").distinct(), "doc_id", sample_docs)
    sample = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")  # bounded: sample_docs ids
    found = _with_matches(sample, "text", KINDS, 0, "spans")
    random = found.select(F.explode("spans").alias("s")).select(F.lit(True).alias("random"), F.col("s.value").alias("token")).filter("length(token) >= 16 and token rlike '[0-9]'")
    rest = F.col("text")
    for pattern, _, _ in KINDS.values():
        rest = F.regexp_replace(rest, pattern, " ")
    ordinary = sample.select(F.lit(False).alias("random"), F.explode(F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(0))).alias("token"))
    tokens = random.union(ordinary).groupBy("random", "token").agg(F.lit(1).alias("once"))
    letters = tokens.withColumn("c", F.split("token", ""))
    pairs = letters.select("random", F.explode(F.zip_with(F.slice("c", 1, F.size("c") - 1), F.slice("c", 2, F.size("c")), lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))))).alias("pair"))
    counts = {True: {}, False: {}}
    for row in pairs.filter(F.length("pair") == 2).groupBy("random", "pair").count().collect():  # at most 2 x 67 x 67 rows
        if row["pair"][0] in ALPHABET and row["pair"][1] in ALPHABET:
            counts[row["random"]][row["pair"]] = row["count"]
    if not counts[False]:
        return [0.0] * (_WIDTH * _WIDTH)
    random_chance, ordinary_chance = _chances(counts[True]), _chances(counts[False])
    return [math.log(0.5 * random_chance[a + b] + 0.5 / _WIDTH) - math.log(ordinary_chance[a + b]) for a in ALPHABET for b in ALPHABET]


def _chances(counts: dict[str, int]) -> dict[str, float]:
    """The chance of a character after another; after rarely seen ones it falls back on that of the character by itself."""
    alone = {b: 0.5 + sum(counts.get(c + b, 0) for c in ALPHABET) for b in ALPHABET}
    total = sum(alone.values())
    row = {a: sum(counts.get(a + c, 0) for c in ALPHABET) for a in ALPHABET}
    return {a + b: (counts.get(a + b, 0) + FALLBACK * alone[b] / total) / (row[a] + FALLBACK) for a in ALPHABET for b in ALPHABET}


def _ratio(token: Column, table: Column) -> Column:
    """Mean log-likelihood ratio over the token's pairs of characters without a separator."""
    pieces = F.regexp_extract_all(token, F.lit("[A-Za-z0-9]+|[^A-Za-z0-9]+"), F.lit(0))
    # What is not scored becomes a separator.
    words = F.transform(pieces, lambda p: F.when(p.rlike(WORDS), F.regexp_replace(F.lower(p), "[0-9]", "-")).when(p.rlike(NUMBER), F.regexp_replace(p, ".", "-")).otherwise(p))
    plain = F.array_join(words, "")
    places = F.transform(F.filter(F.split(plain, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)

    def pair(a: Column, b: Column) -> Column:
        return F.when(F.greatest(a, b) < _SEPARATORS, F.get(table, a * _WIDTH + b))

    pairs = F.filter(F.zip_with(F.slice(places, 1, F.size(places) - 1), F.slice(places, 2, F.size(places) - 1), pair), lambda x: x.isNotNull())
    return F.aggregate(pairs, F.lit(0.0), lambda total, x: total + x) / F.greatest(F.size(pairs), F.lit(LEAST_PAIRS))


def scan(docs: DataFrame, ratios: list[float], text: str = "text", column: str = "spans", threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with all spans, in order: array of (start, place, end, kind, value); positions in code points, end exclusive."""
    plain, base, more, scored = (fresh(docs, n) for n in ("plain", "base", "more", "scored"))
    df = docs.withColumn(plain, F.coalesce(F.col(text), F.lit("")))
    df = _with_matches(df, plain, KINDS, 0, base)
    df = _with_matches(df, plain, {MARKOV: (TOKEN, 1, 16)}, len(KINDS), more)
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")  # folded to one literal
    likely = F.filter(more, lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
    df = df.withColumn(scored, F.filter(likely, lambda s: _ratio(s["value"], table) > threshold))
    # Tokens beside base spans, all in order: the furthest end of a base span before, and the next start of one after.
    both, ends, starts = (fresh(docs, n) for n in ("both", "ends", "starts"))
    df = df.withColumn(both, F.array_sort(F.concat(base, scored)))
    is_base = lambda s: s["kind"] != MARKOV
    df = _with_running(df, ends, F.transform(both, lambda s: F.when(is_base(s), s["end"]).otherwise(0)), _larger)
    later = F.reverse(F.transform(both, lambda s: F.when(is_base(s), s["start"]).otherwise(_FAR)))
    df = _with_running(df, starts, later, _smaller, _FAR)
    judged = F.zip_with(F.zip_with(both, _before(F.col(ends)), lambda s, e: F.struct(s.alias("s"), e.alias("e"))), F.reverse(starts), _apart)
    kept = F.transform(F.filter(judged, lambda j: j["apart"]), lambda j: j["s"])
    return df.withColumn(column, kept).drop(plain, base, more, scored, both, ends, starts)


def _apart(found: Column, next_start: Column) -> Column:
    """A span, and whether it is a base span or touches none."""
    s = found["s"]
    apart = (s["kind"] != MARKOV) | (found["e"] <= s["start"]) & (next_start >= s["end"])
    return F.struct(s.alias("s"), apart.alias("apart"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, spans) for each row of `docs`."""
    ratios = train(docs, doc_id, text, sample_docs)
    return scan(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), ratios).select("doc_id", "spans")


def _opened(span: Column, upto: Column) -> Column:
    opens = (upto == 0) | (span["start"] >= upto)
    return F.struct(span["start"].alias("start"), upto.alias("before"), opens.alias("opens"))


def _with_chunks(df: DataFrame, name: str, text: str, runs: str) -> DataFrame:
    """`df` with the text in chunks, each with its place and the numbers of the runs that reach into it; NULL without runs.

    A position is found by walking along a string, so a long text is only ever walked chunk by chunk.
    """
    pieces, first, last = (fresh(df, n) for n in ("pieces", "first", "last"))
    cut = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0))
    df = df.withColumn(pieces, F.when(F.col(runs).isNotNull(), cut))
    places = F.transform(F.sequence(F.lit(0), F.size(pieces)), lambda c: c * _CHUNK)
    for column, side, kind in ((first, "end", 0), (last, "start", 2)):
        # How many ends (starts) are before each place: those and the places in order, counted along. 1 marks a place.
        both, counts = fresh(df, "both"), fresh(df, "counts")
        of_runs = F.transform(runs, lambda r: F.struct(r[side].alias("at"), F.lit(kind).alias("kind")))  # noqa: B023
        of_places = F.transform(places, lambda v: F.struct(v.alias("at"), F.lit(1).alias("kind")))
        df = df.withColumn(both, F.array_sort(F.concat(of_runs, of_places)))
        df = _with_running(df, counts, F.transform(both, lambda b: (b["kind"] != 1).cast("int")))
        counted = F.zip_with(both, counts, lambda b, n: F.struct(b["kind"].alias("kind"), n.alias("n")))
        df = df.withColumn(column, F.transform(F.filter(counted, lambda c: c["kind"] == 1), lambda c: c["n"])).drop(both, counts)
    # Places are one more than pieces: a piece ends where the next place is.
    reach = F.zip_with(F.slice(first, 1, F.size(pieces)), F.slice(last, 2, F.size(pieces)), lambda f, n: F.struct(f.alias("first"), n.alias("last")))
    zipped = F.zip_with(pieces, reach, lambda piece, r: F.struct(piece.alias("piece"), r["first"].alias("first"), r["last"].alias("last")))
    chunks = F.transform(zipped, lambda z, c: F.struct((c * _CHUNK).alias("place"), z["piece"].alias("piece"), z["first"].alias("first"), z["last"].alias("last")))
    return df.withColumn(name, F.when(F.col(runs).isNotNull(), chunks)).drop(pieces, first, last)


def _masked(chunk: Column, placeholder: str) -> Column:
    """A chunk without what its runs cover; a placeholder stands where a run begins."""
    place, piece, inside = chunk["place"], chunk["piece"], chunk["runs"]

    def part(run: Column) -> Column:
        begin = F.greatest(run["before"] - place, F.lit(0))
        kept = F.substring(piece, begin + 1, F.greatest(run["start"] - place, F.lit(0)) - begin)
        return F.concat(kept, F.when(run["start"] >= place, F.lit(placeholder)).otherwise(""))

    last = F.coalesce(F.get(F.transform(F.slice(inside, -1, 1), lambda r: r["end"]), F.lit(0)), place)
    rest = F.substring(piece, F.greatest(last - place, F.lit(0)) + 1, F.lit(_CHUNK))
    return F.concat(F.array_join(F.transform(inside, part), ""), rest)


def mask(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS, placeholder: str = PLACEHOLDER) -> DataFrame:
    """`docs` with a placeholder for every run of spans; a column n_chars follows its text where that changed."""
    spans, ends, runs, chunks, new = (fresh(docs, n) for n in ("spans", "ends", "runs", "chunks", "masked"))
    found = scan(docs, train(docs, doc_id, text, sample_docs), text, spans)
    # Spans that overlap are one run; a run knows where the one before it ends.
    opened = fresh(docs, "opened")
    found = _with_running(found, ends, F.transform(spans, lambda s: s["end"]), _larger)
    found = found.withColumn(opened, F.filter(F.zip_with(spans, _before(F.col(ends)), _opened), lambda o: o["opens"]))
    run_ends = F.concat(F.slice(F.transform(opened, lambda o: o["before"]), 2, F.greatest(F.size(opened) - 1, F.lit(0))), F.slice(ends, -1, 1))
    merged = F.zip_with(opened, run_ends, lambda o, e: F.struct(o["start"].alias("start"), e.alias("end"), o["before"].alias("before")))
    found = found.withColumn(runs, _once(F.when(F.size(spans) > 0, merged)))
    found = _with_chunks(found, chunks, text, runs)
    # The runs of a chunk are cut out first, so that no lambda looks into the whole list.
    held = F.transform(chunks, lambda c: F.struct(c["place"].alias("place"), c["piece"].alias("piece"), F.slice(F.col(runs), c["first"] + 1, F.greatest(c["last"] - c["first"], F.lit(0))).alias("runs")))
    found = found.withColumn(new, F.array_join(F.transform(held, lambda c: _masked(c, placeholder)), "")).drop(opened)
    return found.select(
        *[
            F.coalesce(new, text).alias(c)
            if c == text
            else F.when(F.col(new).isNotNull(), F.length(new)).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c)
            if c == "n_chars"
            else F.col(f"`{c}`")
            for c in docs.columns
        ]
    )
