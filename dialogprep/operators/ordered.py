"""Ordered work inside a key that may hold a large share of all rows.

A window partitioned by the key alone puts the whole key in one task. Where a
key is long its rows are cut into blocks of consecutive order values; windows
run inside ``(key, block)`` and a summary with one row per block carries running
totals across. Whether any key is that long is checked first, so that ordinary
data pays for one window only, and ordinary keys are never cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogprep.operators.lookup import fits_broadcast
from dialogprep.sources.storage import stage

BLOCK = "_block"
#: The block of a key that is not cut.
WHOLE_KEY = -1
#: Blocks are range partitions, whose bounds the driver holds; with more rows than this allows, blocks grow.
MAX_BLOCKS = 20_000


def has_long_groups(df: DataFrame, key: str, order: str, limit: int) -> bool:
    """True if some key has more than ``limit`` rows; order values may repeat or be null."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return not counts.where(F.col("n") > limit).limit(1).isEmpty()


def with_block(df: DataFrame, key: str, order: str, limit: int) -> DataFrame:
    """Adds BLOCK, which cuts the keys of more than ``limit`` rows into blocks of about half that.

    Cuts are equi-depth: rows of long keys are range-partitioned by key and order on a sample of both, so sparse
    order values, such as timestamps, give blocks as full as dense ones. The numbers of the partitions are written
    with the rows, and grow with the order in a key. Rows that share key and order stay together. A null order
    comes first, as in a window.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    long = stage(counts.where(F.col("_n") > limit).select(F.col(key).alias("_long"), "_n"), "long-keys")
    n = long.agg(F.sum("_n")).first()[0] or 0
    keys = long.select("_long")
    keys = F.broadcast(keys) if fits_broadcast(keys) else keys
    same = F.col(key).eqNullSafe(F.col("_long"))
    blocks = max(1, min(MAX_BLOCKS, -(-2 * n // limit)))
    cut = df.join(keys, same, "left_semi").repartitionByRange(blocks, key, order)
    cut = stage(cut.withColumn(BLOCK, F.spark_partition_id().cast("bigint")), "blocks")
    rest = df.join(keys, same, "left_anti").withColumn(BLOCK, F.lit(WHOLE_KEY).cast("bigint"))
    return cut.unionByName(rest)


def of_long_keys(rows: DataFrame) -> DataFrame:
    """The rows that a summary of blocks is made of."""
    return rows.where(F.col(BLOCK) != WHOLE_KEY)


def carry(rows: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Adds the columns of a summary of blocks, null for keys that are not cut. A null key meets a null key."""
    renamed = blocks.withColumnsRenamed({k: f"_other_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_other_{k}"))
    return rows.join(renamed, condition, "left").drop(*[f"_other_{k}" for k in keys])


def before(key: str) -> "Window":
    """Frame over the earlier blocks of a key."""
    return (
        Window.partitionBy(key)
        .orderBy(BLOCK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def total_before(value: str | Column, key: str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(value).over(before(key)), F.lit(0)).cast("bigint")


def dense_index(df: DataFrame, key: str, order: str, limit: int, name: str = "i") -> DataFrame:
    """Adds the 0-based position of each row in its key."""
    if not has_long_groups(df, key, order, limit):
        w = Window.partitionBy(key).orderBy(order)
        return df.withColumn(name, (F.row_number().over(w) - 1).cast("bigint"))
    blocked = with_block(df, key, order, limit)
    offsets = (
        of_long_keys(blocked)
        .groupBy(key, BLOCK)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(key, BLOCK, total_before("_n", key).alias("_offset"))
    )
    w = Window.partitionBy(key, BLOCK).orderBy(order)
    return (
        blocked.withColumn("_rank", F.row_number().over(w))
        .transform(lambda rows: carry(rows, offsets, [key, BLOCK]))
        .withColumn(name, (F.coalesce("_offset", F.lit(0)) + F.col("_rank") - 1).cast("bigint"))
        .drop("_rank", "_offset", BLOCK)
    )
