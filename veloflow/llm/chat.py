"""Chat rendering of logged conversations, after collapsing cumulative snapshots; Spark SQL expressions only.

A log often holds a conversation again each time that it has grown. Each turn gets a rolling hash of all turns up to it. A
conversation whose last hash is the hash of some turn within a longer one is a prefix of it and goes; equal conversations
leave one. Only what stays is rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turn template, as text around role and content.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 1), n (turns of the conversation) and two rolling hashes of the turns up to each one.

    A rolling hash is the sum, over the turns so far, of a hash of place, role and text; as the place is hashed too, order
    counts. Sums of 32-bit halves cannot overflow. Only ids and hashes are shuffled, not texts.
    """
    narrow = turns.select("conv_id", "turn", F.xxhash64(F.coalesce("role", F.lit("")), F.lit("\x1f"), F.coalesce("text", F.lit(""))).alias("h"))
    order = Window.partitionBy("conv_id").orderBy("turn", "h")
    placed = narrow.withColumn("place", F.row_number().over(order)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("conv_id")))
    mixed = placed.withColumn("h", F.xxhash64("place", "h"))
    so_far = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    half = lambda c: F.sum(c).over(so_far)
    low, high = F.col("h").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("h", 32)
    return mixed.select("conv_id", "place", "n", half(low).alias("low"), half(high).alias("high"))


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_equal of the conversations that are no proper prefix of another one.

    Of equal conversations the one with the smallest conv_id stays; ``n_equal`` counts them. Prefixes that many
    conversations share are taken together before the anti-join, so a common first turn is one row.
    """
    seen = prefixes(turns)
    last = seen.filter("place = n").groupBy("n", "low", "high").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_equal"))
    inner = seen.filter("place < n").select(F.col("place").alias("n"), "low", "high").distinct()
    return last.join(inner, ["n", "low", "high"], "left_anti").select("conv_id", F.col("n").cast("long").alias("n_turns"), "n_equal")


def render(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_equal, rendered of each maximal conversation.

    Turns stand in the order of turn (null first; ties by hash of role and text, as for the hashes). Null roles and texts
    count as empty. Rows that repeat a turn are turns of their own. A null conv_id is one conversation. An empty table gives
    no rows. Other columns are ignored. A conversation is one row of the result, so its turns meet in one task.
    """
    kept = maximal(turns).withColumnRenamed("conv_id", "_kept")
    line = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("")), F.lit(MIDDLE), F.coalesce("text", F.lit("")), F.lit(CLOSE))
    tie = F.xxhash64(F.coalesce("role", F.lit("")), F.lit("\x1f"), F.coalesce("text", F.lit("")))
    lines = turns.select("conv_id", F.struct(F.col("turn").alias("t"), tie.alias("h"), line.alias("line")).alias("x")).join(kept, _same("conv_id", "_kept"))
    whole = lines.groupBy("conv_id", "n_turns", "n_equal").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    return whole.select("conv_id", "n_turns", "n_equal", F.array_join(F.transform("xs", lambda x: x["line"]), "").alias("rendered"))
