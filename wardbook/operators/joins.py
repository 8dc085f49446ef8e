"""Joins that hold when one key owns a large share of the rows.

`Facts` is the usual way in: it takes the many side of a report (orders,
results, nursing records, ...) and looks rows of other tables up by key. It
first counts the facts per key, which reads the key columns only, and joins
according to the numbers:

* All keys of the facts are counted in one pass (grouping sets).
* Keys with very many facts are cut into slots, so no task gets one whole; the
  rows they are looked up from are repeated once per slot. Facts without a key
  are spread over as many slots as their number asks for. The list of hot keys is
  written once, so that facts and looked-up rows see the same one.
* When the facts hold few keys (a daily list over a long history), the tables
  they are looked up in are cut to those keys before they are shuffled.
* When they hold more, those tables are cut by a bitmap of the keys (`KeyFilter`), of fixed size and built once, and shuffled after.
* All lookups on one key share one shuffle.

What is broadcast by hand was counted first: the keys of the facts, or of a
short list (`cut_to`), when there are at most `FEW_KEYS` of them, the bitmap of more keys, which has a largest size, and the list
of hot keys, which `MAX_HOT_KEYS` bounds. Small code tables are broadcast by Spark itself after its own check.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.operators.keep import keep_table
from wardbook.operators.keyfilter import MOST_KEYS, KeyFilter

ROWS_PER_SLOT = 2_000_000
ROWS_PER_SLOT_CONF = "spark.wardbook.rowsPerSlot"
FEW_KEYS = 100_000
FEW_KEYS_CONF = "spark.wardbook.fewKeys"
#: At most so many keys are hot. Beyond 2 * 10^11 facts a slot, and the largest key that is left whole, grows with them:
#: it holds a hundred-thousandth of all facts at most.
MAX_HOT_KEYS = 100_000

_ID, _SLOT, _SLOTS = "_row_id", "_slot", "_slots"


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


@dataclass(frozen=True)
class Look:
    """Where to look a fact's key up. `key` names the table's own key columns;
    they are dropped from the result, the facts keep theirs. `short` marks a table
    that is itself the short list, so that it is not cut to the facts' keys. `pick` makes one row per key of the
    rows that are left after the cut."""

    table: DataFrame
    key: str | Sequence[str]
    how: str = "left"
    short: bool = False
    pick: Callable[[DataFrame], DataFrame] | None = None

    @property
    def picked(self) -> DataFrame:
        return self.pick(self.table) if self.pick else self.table


@dataclass(frozen=True)
class _Spread:
    """What the counts say about one key: how many keys, and who needs slots."""

    on: list[str]
    few: DataFrame | None
    filter: KeyFilter | None
    hot: DataFrame | None
    missing_slots: int

    def cut(self, table: DataFrame, key: str | Sequence[str]) -> DataFrame:
        """The table's rows that these keys may ask for."""
        if self.few is not None:
            return _semi(table, key, self.few)
        return self.filter.cut(table, _names(key)) if self.filter is not None else table

    @property
    def needs_slots(self) -> bool:
        return self.hot is not None or self.missing_slots > 1


def with_row_id(scan: DataFrame) -> DataFrame:
    """Number the rows of a scan, for facts that are joined again after a shuffle."""
    return scan.withColumn(_ID, F.monotonically_increasing_id())


class Facts:
    """A fact table and the lookups made from it.

    `facts` is a scan with filters and projections on it, so that row ids come
    out the same when a lost task is run again. For facts that come out of a
    shuffle, take the ids at the scan (`with_row_id`), or name the columns that
    tell the rows apart in `row_key`.
    """

    def __init__(self, facts: DataFrame, row_key: Sequence[str] | None = None):
        self._facts = facts
        self._columns = set(facts.columns)
        self._row_key = row_key
        self._steps: list[tuple] = []
        self._spreads: dict[tuple[str, ...], _Spread] | None = None
        conf = facts.sparkSession.conf
        self._rows_per_slot = int(conf.get(ROWS_PER_SLOT_CONF, str(ROWS_PER_SLOT)))
        self._few_keys = int(conf.get(FEW_KEYS_CONF, str(FEW_KEYS)))

    def by(self, on: str | Sequence[str], *looks: Look) -> Facts:
        """Look up by key columns of the fact table."""
        on = _names(on)
        if not self._columns.issuperset(on):
            raise ValueError(f"{on} must be columns of the fact table; use code() for others")
        self._steps.append(("by", on, looks))
        return self

    def code(self, on: str | Sequence[str], table: DataFrame, key: str | Sequence[str], how: str = "left") -> Facts:
        """Look a code up in a code table, or a key that an earlier lookup brought in."""
        self._steps.append(("code", on, table, key, how))
        return self

    def where(self, condition: Column) -> Facts:
        self._steps.append(("where", condition))
        return self

    @property
    def spreads(self) -> dict[tuple[str, ...], _Spread]:
        """What the counts say, once for all uses of these facts."""
        if self._spreads is None:
            self._spreads = self._count(list(dict.fromkeys(tuple(step[1]) for step in self._steps if step[0] == "by")))
        return self._spreads

    def sift(self, on: str | Sequence[str], *tables: tuple[DataFrame, str | Sequence[str]]) -> list[DataFrame]:
        """`sift_all` of tables that are joined later, by a key that these facts look up by and so have counted."""
        spread = self.spreads[tuple(_names(on))]
        return [spread.cut(table, key) for table, key in tables]

    @property
    def df(self) -> DataFrame:
        spreads = self.spreads
        result = self._facts
        own_id = _ID not in self._columns and any(s.needs_slots for s in spreads.values())
        if own_id:
            result = result.withColumn(_ID, F.xxhash64(*self._row_key)) if self._row_key else with_row_id(result)
        for kind, *step in self._steps:
            if kind == "by":
                on, looks = step
                result = _look_up(result, spreads[tuple(on)], looks)
            elif kind == "code":
                on, table, key, how = step
                result = equi_join(result, table, on, key, how)
            else:
                result = result.where(step[0])
        return result.drop(_ID) if own_id else result

    def _count(self, keys: list[tuple[str, ...]]) -> dict[tuple[str, ...], _Spread]:
        """Count the facts per key, all keys in one pass; four numbers per key come back to the driver."""
        if not keys:
            return {}
        columns = list(dict.fromkeys(c for on in keys for c in on))
        # The number that Spark gives a grouping set: a bit for each column that is not in it.
        numbers = {on: sum(1 << i for i, c in enumerate(reversed(columns)) if c not in on) for on in keys}
        sets = {number: list(on) for on, number in numbers.items()}
        counts = self._facts.groupingSets(list(sets.values()), *columns).agg(
            F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set")
        )
        missing = F.lit(False)
        for number, on in sets.items():
            for c in on:
                missing = missing | ((F.col("_set") == number) & F.col(c).isNull())
        seen = counts.groupBy("_set").agg(
            F.count_if(~missing).alias("keys"),
            F.sum("_n").alias("rows"),
            F.coalesce(F.max(F.when(~missing, F.col("_n"))), F.lit(0)).alias("most"),
            F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias("missing"),
        )
        seen = {row["_set"]: row for row in seen.collect()}  # a row per key
        # At most rows / limit keys can have more than `limit` rows.
        limits = {n: max(self._rows_per_slot, row["rows"] // MAX_HOT_KEYS) for n, row in seen.items()}
        hot = None
        if any(row["most"] > limits[n] for n, row in seen.items()):
            limit = F.lit(None).cast("long")
            for n, rows in limits.items():
                limit = F.when(F.col("_set") == n, F.lit(rows)).otherwise(limit)
            hot = counts.where(~missing & (F.col("_n") > limit))
            hot = keep_table(hot.withColumn(_SLOTS, F.ceil(F.col("_n") / limit).cast("int")))
        return {on: self._spread(list(on), seen.get(n), hot.where(F.col("_set") == n) if hot and seen[n]["most"] > limits[n] else None) for on, n in numbers.items()}

    def _spread(self, on: list[str], seen, hot: DataFrame | None) -> _Spread:
        few = cut = None
        if seen is None or seen["keys"] <= self._few_keys:
            few = self._facts.select(*on).dropna().distinct()
        elif seen["keys"] <= MOST_KEYS and any(not look.short for step in self._steps if step[:2] == ("by", on) for look in step[2]):
            cut = KeyFilter(self._facts, on, seen["keys"])
        missing_slots = -(-seen["missing"] // self._rows_per_slot) if seen else 0
        return _Spread(on, few, cut, hot.select(*on, _SLOTS) if hot else None, missing_slots)


def _look_up(left: DataFrame, spread: _Spread, looks: Sequence[Look]) -> DataFrame:
    on = spread.on
    slots = spread.needs_slots
    if slots:
        left = _with_slot(left, spread)
    for number, look in enumerate(looks):
        keys = [f"_key{number}_{i}" for i in range(len(on))]
        table = look.table if look.short else spread.cut(look.table, look.key)
        table = look.pick(table) if look.pick else table
        table = table.withColumnsRenamed(dict(zip(_names(look.key), keys, strict=True)))
        condition = [F.col(c) == F.col(k) for c, k in zip(on, keys, strict=True)]
        extra = list(keys)
        if slots:
            extra.append(f"{_SLOT}{number}")
            table = _repeated(table, spread, keys, extra[-1])
            condition.append(F.col(_SLOT) == F.col(extra[-1]))
        left = left.join(table, condition, look.how)
        if look.how not in ("left_semi", "left_anti"):
            left = left.drop(*extra)
    return left.drop(_SLOT) if slots else left


def _semi(table: DataFrame, key: str | Sequence[str], few: DataFrame) -> DataFrame:
    """The rows of a table whose key is one of the few counted ones."""
    names = [f"_few_{i}" for i in range(len(few.columns))]
    return table.join(F.broadcast(few.toDF(*names)), [F.col(k) == F.col(n) for k, n in zip(_names(key), names, strict=True)], "left_semi")


def _with_slot(facts: DataFrame, spread: _Spread) -> DataFrame:
    """The slot of each fact: by row id for hot and for missing keys, 0 for the others."""
    missing = F.lit(False)
    for c in spread.on:
        missing = missing | F.col(c).isNull()
    slot = F.when(missing, F.pmod(F.col(_ID), F.lit(max(1, spread.missing_slots))))
    if spread.hot is None:
        return facts.withColumn(_SLOT, slot.otherwise(0).cast("int"))
    names = {c: f"_hot_{c}" for c in spread.on}
    hot = F.broadcast(spread.hot.withColumnsRenamed(names))
    slot = slot.when(F.col(_SLOTS).isNotNull(), F.pmod(F.col(_ID), F.col(_SLOTS))).otherwise(0)
    found = facts.join(hot, [F.col(c) == F.col(h) for c, h in names.items()], "left")
    return found.select(*facts.columns, slot.cast("int").alias(_SLOT))


def _repeated(table: DataFrame, spread: _Spread, keys: Sequence[str], slot: str) -> DataFrame:
    """The looked-up rows, those of a hot key once per slot."""
    if spread.hot is None:
        return table.withColumn(slot, F.lit(0))
    columns = table.columns
    names = {c: f"_hot_{c}" for c in spread.on}
    hot = F.broadcast(spread.hot.withColumnsRenamed(names))
    found = table.join(hot, [F.col(k) == F.col(h) for k, h in zip(keys, names.values(), strict=True)], "left")
    last = F.coalesce(F.col(_SLOTS), F.lit(1)) - 1
    return found.select(*columns, F.explode(F.sequence(F.lit(0), last)).alias(slot))


def cut_to(table: DataFrame, key: str | Sequence[str], few: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """The rows of a large table that a short list asks for, without shuffling the table.

    The distinct keys of the list are counted. Up to `FEW_KEYS` they are
    broadcast; beyond, the table is returned whole and the join that follows
    sorts it out. The rows of the report are the same either way.
    """
    return cut_all([(table, key)], few, on)[0]


def cut_all(tables: Sequence[tuple[DataFrame, str | Sequence[str]]], few: DataFrame, on: str | Sequence[str]) -> list[DataFrame]:
    """`cut_to` for several tables and their keys; the list is counted once."""
    keys, n = _distinct(few, _names(on))
    return [_semi(table, key, keys) for table, key in tables] if n <= _few_keys(few) else [table for table, _ in tables]


def _distinct(asked: DataFrame, on: list[str]) -> tuple[DataFrame, int]:
    keys = asked.select(*on).dropna().distinct()
    return keys, keys.count()


def _few_keys(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(FEW_KEYS_CONF, str(FEW_KEYS)))


def sift_to(table: DataFrame, key: str | Sequence[str], asked: DataFrame, on: str | Sequence[str], also: Column | None = None) -> DataFrame:
    """`cut_to` for a table that is joined with the list afterwards: beyond `FEW_KEYS` a bitmap of the keys takes most other rows away.

    Rows that `also` holds for stay whatever their key.
    """
    return sift_all([(table, key)], asked, on, also)[0]


def sift_all(
    tables: Sequence[tuple[DataFrame, str | Sequence[str]]], asked: DataFrame, on: str | Sequence[str], also: Column | None = None
) -> list[DataFrame]:
    """`sift_to` for several tables; the list is counted, and its bitmap made, once."""
    on = _names(on)
    keys, n = _distinct(asked, on)
    if n <= _few_keys(asked):
        return [_semi(table, key, keys) if also is None else _marked(table, key, keys, also) for table, key in tables]
    if n > MOST_KEYS:
        return [table for table, _ in tables]
    cut = KeyFilter(asked, on, n)
    return [cut.cut(table, _names(key), also) for table, key in tables]


def meet(history: DataFrame, key: str | Sequence[str], asked: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner join of a many-rows history with a list that is usually short, which is counted once.

    Up to `FEW_KEYS` rows the list is broadcast as it is: the history is neither shuffled nor counted, so it does not matter who has how
    many rows in it. Beyond, the history is cut by the list's keys and joined as `Facts`. The key columns of the list are dropped.
    """
    key, on = _names(key), _names(on)
    names = [f"_asked_{i}" for i in range(len(on))]
    asked = asked.dropna(subset=on).withColumnsRenamed(dict(zip(on, names, strict=True)))
    if asked.count() > _few_keys(history):
        return Facts(sift_to(history, key, asked, names)).by(key, Look(asked, names, "inner", short=True)).df
    return history.join(F.broadcast(asked), [F.col(k) == F.col(n) for k, n in zip(key, names, strict=True)], "inner").drop(*names)


def _marked(table: DataFrame, key: str | Sequence[str], few: DataFrame, also: Column) -> DataFrame:
    """Rows whose key is one of the few, and those that `also` holds for."""
    names = [f"_few_{i}" for i in range(len(few.columns))]
    found = table.join(F.broadcast(few.toDF(*names)), [F.col(k) == F.col(n) for k, n in zip(_names(key), names, strict=True)], "left")
    return found.where(also | F.col(names[0]).isNotNull()).drop(*names)


def equi_join(left: DataFrame, right: DataFrame, on, key, how: str = "left") -> DataFrame:
    """Plain equi-join on differently named keys; the right key columns are dropped.

    Used for code tables and for lookups whose left side is small or already one
    row per key; Spark picks broadcast or shuffle by size and splits skewed
    partitions at run time.
    """
    on, key = _names(on), _names(key)
    renamed = {k: f"_right_{i}" for i, k in enumerate(key)}
    right = right.withColumnsRenamed(renamed)
    condition = [F.col(a) == F.col(renamed[b]) for a, b in zip(on, key, strict=True)]
    joined = left.join(right, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*renamed.values())


def join_chain(base: DataFrame, steps: Sequence[tuple]) -> DataFrame:
    """Joins in the order given: (table, base key, table key[, how])."""
    for table, on, key, *how in steps:
        base = equi_join(base, table, on, key, *how)
    return base


def role(table: DataFrame, suffix: str, keep: Sequence[str] = ()) -> DataFrame:
    """A table in one of several roles: every column but `keep` gets the suffix."""
    return table.withColumnsRenamed({c: f"{c}{suffix}" for c in table.columns if c not in keep})


def in_roster(df: DataFrame, roster: DataFrame, on, key=None) -> DataFrame:
    """Rows whose key is in the roster (semi join; duplicates on either side are fine)."""
    return equi_join(df, roster.select(*_names(key or on)), on, key or on, "left_semi")


def not_in_roster(df: DataFrame, roster: DataFrame, on, key=None) -> DataFrame:
    """Rows whose key is not in the roster. Rows with a NULL key are dropped, as by NOT IN."""
    return equi_join(df.dropna(subset=_names(on)), roster.select(*_names(key or on)), on, key or on, "left_anti")


def split_matched(df: DataFrame, other: DataFrame, on, key=None, row_key=None) -> tuple[DataFrame, DataFrame]:
    """(matched, unmatched) rows of `df`; both keep their duplicates, NULL keys are unmatched."""
    keys = other.select(*_names(key or on)).dropna().distinct()
    return (
        Facts(df, row_key).by(on, Look(keys, key or on, "left_semi")).df,
        Facts(df, row_key).by(on, Look(keys, key or on, "left_anti")).df,
    )


def with_details(heads: DataFrame, details: DataFrame, on, key) -> DataFrame:
    """Left join from heads (one row per key) to many details per key.

    The details are the facts here, so those of a hot head are split; when the
    heads are few the details are cut to theirs first. Heads without details are
    added after.
    """
    on, key = _names(on), _names(key)
    names = {k: f"_d{i}" for i, k in enumerate(key)}
    facts = details.withColumnsRenamed(names)
    asked = {f"_h{i}": F.col(c) for i, c in enumerate(on)}
    found = meet(facts, list(names.values()), heads.withColumns(asked), list(asked))
    facts = equi_join(facts, heads.select(*on), list(names.values()), on, "left_semi")
    bare = equi_join(heads, facts.select(*names.values()).distinct(), on, list(names.values()), "left_anti")
    columns = heads.columns + [c for c in details.columns if c not in key]
    return found.select(*columns).unionByName(bare, allowMissingColumns=True)


def merge(left: DataFrame, right: DataFrame, key: str, how: str = "inner", row_key: Sequence[str] | None = None) -> DataFrame:
    """Frame merge on one key; `right` holds one row per key.

    Unlike a frame library, NULL keys never match each other. A full outer merge is one join; its left side is meant to be
    a list of places, without hot keys.
    """
    probe = right.withColumnRenamed(key, "_merge_key")
    if how in ("inner", "left"):
        return Facts(left, row_key).by(key, Look(probe, "_merge_key", how)).df
    if how != "full_outer":
        raise ValueError(f"merge knows inner, left and full_outer, not {how!r}")
    # Each input is worked out once. Rows without a key get one of their own that matches nothing, so they are spread.
    salt = F.when(F.col(key).isNull(), F.xxhash64(*(row_key or left.columns))).otherwise(F.lit(0))
    joined = left.withColumn("_salt", salt).join(
        probe.withColumn("_salt_right", F.lit(0).cast("long")), (F.col(key) == F.col("_merge_key")) & (F.col("_salt") == F.col("_salt_right")), "full_outer"
    )
    columns = [F.coalesce(key, "_merge_key").alias(key) if c == key else F.col(c) for c in left.columns]
    return joined.select(*columns, *[c for c in right.columns if c != key])


def stack_sources(*frames: DataFrame) -> DataFrame:
    """Union of frames with the same columns (a bag: nothing is dropped)."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
