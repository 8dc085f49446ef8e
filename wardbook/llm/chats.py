"""Chat formatting: cumulative snapshots of a conversation collapse into the longest one, which is then rendered.

Logs often hold a conversation once per turn: each snapshot is a prefix of the next. Every turn gets the rolling hash of its
conversation's turns so far: two 64-bit hashes of (place, role, text), XORed along the conversation. A conversation whose last hash
is some conversation's hash at a later turn is a prefix of it and goes by an anti-join; among equal ones the smallest id stays.
Hashes are made distinct before the join, so a first turn that a third of all logs share is one row. Texts move once, and only those of
maximal conversations.

Turns are ordered by turn, then role, then a hash of the text; their place in that order counts, not the number itself.

Defined results. Null role or text: kept apart from an empty one when conversations are compared, rendered as `unknown` and as nothing.
Null turn: comes first. Rows without a conv_id form one conversation without an id. Repeated rows are turns like any other. Very long texts: whole; a rendered
conversation is one row of 2 GB at most, with an id or without. Ties between equal conversations: the smallest id stays (one without an id last). An empty table gives no rows. Other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardbook.operators.keep import keep_table

START, END = "<|im_start|>", "<|im_end|>"



def prefix_hashes(turns: DataFrame, parts: int | None = None) -> DataFrame:
    """(conv_id, place, h1, h2) for each turn: the hashes of the conversation up to it.

    Turns are dealt by ranges of their order, so a long conversation is many parts. Places and hashes are worked out in each part and
    moved on by what the parts before it hold; a cut between ranges goes through one conversation, so only few have more than one part.
    """
    # The order needs the text only as a tie-break: its hash does, and the text itself does not move.
    rows = turns.select(
        "conv_id", "turn", "role", F.xxhash64(F.col("text").isNull(), "text").alias("text_key"), F.xxhash64(F.lit(7), F.col("text").isNull(), "text").alias("text_key2")
    )
    by = ["turn", F.col("role").isNull(), "role", "text_key", "text_key2", "spread"]
    rows = rows.withColumn("spread", F.monotonically_increasing_id())  # parts equal turns
    ranged = rows.repartitionByRange(*([parts] if parts else []), "conv_id", *by)
    dealt = keep_table(ranged.withColumn("part", F.spark_partition_id()))
    order = Window.partitionBy("conv_id", "part").orderBy(*by)
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    split = sizes.withColumns({"n_parts": F.count("*").over(Window.partitionBy("conv_id")), "places": F.coalesce(F.sum("n").over(before), F.lit(0))})
    split = keep_table(split.filter("n_parts > 1").selectExpr("conv_id AS split_id", "part AS split_part", "places"))

    def beside(df: DataFrame, few: DataFrame) -> DataFrame:
        on = df["conv_id"].eqNullSafe(few["split_id"]) & (df["part"] == few["split_part"])
        return df.join(F.broadcast(few), on, "left").drop("split_id", "split_part")  # bounded: two parts a cut

    placed = beside(dealt.withColumn("place", F.row_number().over(order)), split)
    placed = placed.withColumn("place", (F.col("place") + F.coalesce("places", F.lit(0))).cast("int"))
    one = F.xxhash64(F.lit(1), "place", F.col("role").isNull(), "role", "text_key", "text_key2")
    two = F.xxhash64(F.lit(2), "place", F.col("role").isNull(), "role", "text_key", "text_key2")
    placed = keep_table(placed.select("conv_id", "part", "place", one.alias("h1"), two.alias("h2"), F.col("places").isNotNull().alias("split")))
    whole = placed.filter("split").groupBy("conv_id", "part").agg(F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))
    earlier = whole.select(F.col("conv_id").alias("split_id"), F.col("part").alias("split_part"), F.bit_xor("h1").over(before).alias("e1"), F.bit_xor("h2").over(before).alias("e2"))
    upto = Window.partitionBy("conv_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hashed = beside(placed.withColumns({"h1": F.bit_xor("h1").over(upto), "h2": F.bit_xor("h2").over(upto)}), earlier)
    return hashed.select("conv_id", "place", *[F.col(f"h{i}").bitwiseXOR(F.coalesce(f"e{i}", F.lit(0).cast("long"))).alias(f"h{i}") for i in (1, 2)])


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of conversations that are no prefix of a longer one; one of equal ones."""
    hashes = keep_table(prefix_hashes(turns))
    last = hashes.groupBy("conv_id").agg(F.max("place").alias("n_turns"), F.max_by(F.struct("h1", "h2"), "place").alias("h"))
    ends = last.groupBy("n_turns", F.col("h.h1").alias("h1"), F.col("h.h2").alias("h2")).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    # Every hash that is not its conversation's last stands for a prefix that someone continued.
    continued = (
        hashes.join(last.select("conv_id", "n_turns"), hashes["conv_id"].eqNullSafe(last["conv_id"]))
        .filter("place < n_turns")
        .select(F.col("place").alias("n_turns"), "h1", "h2")
        .distinct()
    )
    return ends.join(continued, ["n_turns", "h1", "h2"], "left_anti").select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), "n_copies")


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(START), F.coalesce(turn["role"], F.lit("unknown")), F.lit("\n"), F.coalesce(turn["text"], F.lit("")), F.lit(END + "\n"))


def collapse_and_render(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies, rendered) for each maximal conversation.

    n_copies: the number of equal conversations, this one included.
    """
    turns = conversations.select("conv_id", "turn", "role", "text")
    chosen = keep_table(maximal(turns)).withColumnRenamed("conv_id", "kept_id")
    kept = turns.join(chosen, turns["conv_id"].eqNullSafe(chosen["kept_id"]))
    # A rendered conversation is one row, so its turns meet in one row: their number is that of one conversation.
    listed = F.sort_array(F.collect_list(F.struct("turn", F.col("role").isNull().alias("no_role"), "role", F.xxhash64(F.col("text").isNull(), "text").alias("text_key"), "text")))
    grouped = kept.groupBy("conv_id", "n_turns", "n_copies").agg(listed.alias("turns"))
    return grouped.select("conv_id", "n_turns", "n_copies", F.array_join(F.transform("turns", _rendered), "").alias("rendered"))
