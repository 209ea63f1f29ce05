"""Chat logs folded into histories.

A log row is ``(session, seq, role, line)``. On user rows ``/exit`` closes the
session, ``/reset`` starts an empty history and blank lines are skipped; every
other row joins the history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogprep.config import CMD_EXIT, CMD_RESET, ROLE_USER
from dialogprep.functions.columns import as_long
from dialogprep.functions.text import strip
from dialogprep.operators.ordered import BLOCK, before, carry, has_long_groups, of_long_keys, total_before, with_block

# Messages of a page; a longer history is several pages.
MAX_HISTORY = 1024
BLOCK_ROWS = 65536


def classify(log: DataFrame, *more: str) -> DataFrame:
    """Strips lines and adds ``is_exit``, ``is_reset`` and ``joins``; keeps the columns named in ``more``."""
    line = strip(F.coalesce("line", F.lit("")))
    by_user = F.coalesce(F.col("role") == ROLE_USER, F.lit(False))
    rows = log.select("session", "seq", "role", line.alias("line"), by_user.alias("_user"), *more)
    is_exit = F.col("_user") & (F.col("line") == CMD_EXIT)
    is_reset = F.col("_user") & (F.col("line") == CMD_RESET)
    return (
        rows.withColumn("is_exit", is_exit)
        .withColumn("is_reset", is_reset)
        .withColumn(
            "joins",
            ~F.col("is_exit") & ~F.col("is_reset") & ~(F.col("_user") & (F.col("line") == "")),
        )
        .drop("_user")
    )


def _ones(flag: str) -> Column:
    return as_long(F.when(F.col(flag), 1).otherwise(0))


def _with_pause(rows: DataFrame, idle_seconds: int, group: list[str]) -> DataFrame:
    """Adds ``pause``: the row comes more than ``idle_seconds`` after the latest ``ts`` of the session's rows before it."""
    earlier = F.max("ts").over(Window.partitionBy(*group).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    if BLOCK in group:
        blocks = of_long_keys(rows).groupBy(*group).agg(F.max("ts").alias("b_ts"))
        rows = carry(rows, blocks.select(*group, F.max("b_ts").over(before("session")).alias("ts_0")), group)
        earlier = F.greatest(earlier, F.col("ts_0"))
    idle = F.expr(f"interval {idle_seconds} seconds")
    return rows.withColumn("pause", F.coalesce(F.col("ts") > earlier + idle, F.lit(False))).drop("ts_0")


def fold_log(log: DataFrame, block_rows: int = BLOCK_ROWS, idle_seconds: int | None = None) -> DataFrame:
    """``(session, segment, pos, seq, role, line)`` of the rows that joined.

    ``segment`` counts resets, ``pos`` numbers the rows of a segment from 0: the
    history after row ``pos`` is the segment's rows up to it. Linear in the log.
    A long session is folded block by block, with its counters carried across.

    With ``idle_seconds`` the log has a column ``ts`` and the result a column
    ``since``: the rows of the segment joined since the session's last pause
    longer than that, before this one.
    """
    rows = classify(log, *(["ts"] if idle_seconds is not None else []))
    long = has_long_groups(log.select("session", "seq"), "session", "seq", block_rows)
    group = ["session", BLOCK] if long else ["session"]
    if long:
        rows = with_block(rows, "session", "seq", block_rows)
    rows = rows.withColumn("pause", F.lit(False)) if idle_seconds is None else _with_pause(rows, idle_seconds, group)
    so_far = Window.partitionBy(*group).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    origin = F.when(F.col("is_reset") | F.col("pause"), F.col("joined") - _ones("joins"))
    rows = (
        rows.withColumn("exits", F.sum(_ones("is_exit")).over(so_far))
        .withColumn("resets", F.sum(_ones("is_reset")).over(so_far))
        .withColumn("joined", F.sum(_ones("joins")).over(so_far))
        .withColumn("base", F.max(F.when(F.col("is_reset"), F.col("joined"))).over(so_far))
        .withColumn("origin", F.max(origin).over(so_far))
    )
    if long:
        blocks = (
            of_long_keys(rows)
            .groupBy(*group)
            .agg(
                F.max("exits").alias("b_exits"),
                F.max("resets").alias("b_resets"),
                F.max("joined").alias("b_joined"),
                F.max("base").alias("b_base"),
                F.max("origin").alias("b_origin"),
            )
            .withColumn("joined_0", total_before("b_joined", "session"))
            .select(
                *group,
                "joined_0",
                total_before("b_exits", "session").alias("exits_0"),
                total_before("b_resets", "session").alias("resets_0"),
                F.max(F.col("joined_0") + F.col("b_base")).over(before("session")).alias("base_0"),
                F.max(F.col("joined_0") + F.col("b_origin")).over(before("session")).alias("origin_0"),
            )
        )
        none = F.lit(0)
        rows = carry(rows, blocks, group).select(
            "session",
            "seq",
            "role",
            "line",
            "joins",
            (F.coalesce("exits_0", none) + F.col("exits")).alias("exits"),
            (F.coalesce("resets_0", none) + F.col("resets")).alias("resets"),
            (F.coalesce("joined_0", none) + F.col("joined")).alias("joined"),
            F.coalesce(F.coalesce("joined_0", none) + F.col("base"), F.col("base_0")).alias("base"),
            F.coalesce(F.coalesce("joined_0", none) + F.col("origin"), F.col("origin_0")).alias("origin"),
        )
    since = as_long(F.col("joined") - F.coalesce("origin", F.lit(0)) - 1).alias("since")
    return rows.where(F.col("joins") & (F.col("exits") == 0)).select(
        "session",
        F.col("resets").alias("segment"),
        as_long(F.col("joined") - F.coalesce("base", F.lit(0)) - 1).alias("pos"),
        "seq",
        "role",
        "line",
        *([since] if idle_seconds is not None else []),
    )


def chat_history(
    log: DataFrame, max_history: int = MAX_HISTORY, block_rows: int = BLOCK_ROWS, idle_seconds: int | None = None
) -> DataFrame:
    """The folded log, each row with its page of the history up to itself.

    A page holds ``max_history`` messages, the first of them at ``history_from``.
    Up to that length ``history`` is the whole history. Behind it, the pages
    before are those of the rows at their ends: ``pos == history_from - 1`` and
    so on. Nothing is left out, no row is longer than a page, and a long segment
    is not one task's work. With ``idle_seconds`` a pause longer than that, by the
    column ``ts``, starts a new page too.
    """
    since = F.col("pos") if idle_seconds is None else F.col("since")
    so_far = (
        Window.partitionBy("session", "segment", "history_from")
        .orderBy("pos")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    message = F.struct("role", F.col("line").alias("content"))
    return (
        fold_log(log, block_rows, idle_seconds)
        .withColumn("history_from", as_long(F.col("pos") - since % max_history))
        .withColumn("history", F.collect_list(message).over(so_far))
        .select("session", "segment", "pos", "seq", "role", "line", "history", "history_from")
    )
