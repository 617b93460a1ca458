"""Chat logs: only conversations that no longer one continues, rendered turn by turn.

A service that logs a conversation after each turn leaves many snapshots of it. Each turn
gets the hash of all turns up to it, by its conversation's order; a conversation whose last
hash another conversation has at the same place, but goes on after it, is a prefix and goes.
Of equal conversations the one with the smallest conv_id stays.

Only DataFrame functions run. The order of a conversation is that of (turn, role, text),
nulls first, in blocks of ``BLOCK`` turn numbers: sums within and over blocks give places and
hashes, so that a conversation with a large part of all rows spreads over many tasks. Each
turn is rendered as a row, with the place where it starts in the conversation's whole text,
so that no conversation has to fit into a task.

A null role or text is rendered as empty, but differs from an empty one when conversations
are compared. Rows without a conv_id are left out. Repeated rows are turns like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardmart.llm.common import written

BLOCK = 1024
# How a turn is written.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _xor(column: str):
    return F.expr(f"bit_xor({column})")


def placed(turns: DataFrame) -> DataFrame:
    """Turns with their place from 1, and h and g: hashes of the conversation up to there."""
    rows = turns.where("conv_id is not null").select(
        "conv_id", "turn", "role", "text",
        F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))).cast("long").alias("block"))
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]
    # Many rows with one turn number stay together; such a log is malformed, but sorts and spills.
    block = Window.partitionBy("conv_id", "block")
    until = block.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    at = F.row_number().over(block.orderBy(*order)) + F.col("before")
    # Of null and empty the hash is alike, so both are told apart beforehand.
    marks = [F.col("at"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    hashed = (
        rows.join(sizes, ["conv_id", "block"]).withColumn("at", at.cast("long")).drop("before")
        .withColumn("own_h", F.xxhash64(*marks)).withColumn("own_g", F.xxhash64(F.lit(5), *marks)))
    totals = hashed.groupBy("conv_id", "block").agg(_xor("own_h").alias("h"), _xor("own_g").alias("g"))
    totals = totals.select(
        "conv_id", "block", *(F.coalesce(_xor(c).over(earlier), F.lit(0)).alias("before_" + c) for c in "hg"))
    return (
        hashed.withColumns({c: _xor("own_" + c).over(until) for c in "hg"})
        .join(totals, ["conv_id", "block"])
        .withColumns({c: F.col(c).bitwiseXOR(F.col("before_" + c)) for c in "hg"})
        .select("conv_id", "block", "turn", "at", "role", "text", "h", "g"))


def maximal(found: DataFrame) -> DataFrame:
    """conv_id of each conversation of ``found`` (from ``placed``) that none continues."""
    last = found.groupBy("conv_id").agg(F.max(F.struct("at", "h", "g")).alias("last")).select(
        "conv_id", "last.at", "last.h", "last.g")
    whole = last.groupBy("at", "h", "g").agg(F.min("conv_id").alias("conv_id"))
    # A place and hash that some conversation passes without ending there.
    passed = found.join(last.select("conv_id", F.col("at").alias("end")), "conv_id").where("at < end")
    return whole.join(passed.select("at", "h", "g").distinct(), ["at", "h", "g"], "left_anti").select("conv_id")


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, place, turn, role, rendered, and start_char of each turn of the maximal conversations."""
    found = written(placed(turns), "turns")
    kept = found.join(maximal(found), "conv_id", "left_semi")
    rendered = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("")), F.lit(MIDDLE), F.coalesce("text", F.lit("")), F.lit(CLOSE))
    rows = kept.withColumn("rendered", rendered).withColumn("size", F.length("rendered").cast("long"))
    block = Window.partitionBy("conv_id", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("conv_id", "block").agg(F.sum("size").alias("n"))
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    return rows.join(sizes, ["conv_id", "block"]).select(
        "conv_id", F.col("at").alias("place"), "turn", "role", "rendered",
        (F.coalesce(F.sum("size").over(block), F.lit(0)) + F.col("before")).alias("start_char"))
