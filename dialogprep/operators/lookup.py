"""Joins to a keyed table that neither broadcast blindly nor skew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogprep.sources.storage import stage

# The most that is sent to every executor.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 100 << 20

# A key is hot above 1/HOT_SHARE of the rows, so there are fewer than that many.
HOT_SHARE = 1000
SALTS = 64


def keep_keys(
    df: DataFrame, ids: DataFrame, key: str, max_broadcast_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Rows of ``df`` whose key is in ``ids``, which is broadcast if measured small."""
    ids = stage(ids, "keys")
    if fits_broadcast(ids, max_broadcast_rows):
        ids = F.broadcast(ids)
    return df.join(ids, key, "left_semi")


def fits_broadcast(
    table: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Is the table small in rows and in bytes? Pass a staged one, as it is read for this."""
    fixed = 16 * len(table.columns)
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in table.schema if f.dataType.typeName() == "string"]
    size = F.sum(sum(texts, F.lit(fixed).cast("bigint")))
    n, held = table.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    return n <= max_rows and held <= max_bytes


def lookup(
    facts: DataFrame,
    table: DataFrame,
    keys: list[str],
    spread_by: str,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """``facts`` with the columns of ``table``, whose ``keys`` are unique.

    A table within ``max_broadcast_rows`` and ``MAX_BROADCAST_BYTES`` (measured;
    pass a staged table) is broadcast. A larger one is shuffled, with the hot
    keys of ``facts`` spread over ``SALTS`` tasks by a hash of ``spread_by``.
    """
    if fits_broadcast(table, max_broadcast_rows):
        return facts.join(F.broadcast(table), keys, "left")

    counts = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    everything = counts.agg(F.sum("_n")).scalar()
    hot = F.broadcast(
        counts.where(F.col("_n") * HOT_SHARE > everything).select(*keys, F.lit(True).alias("_hot"))
    )
    salted = facts.join(hot, keys, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread_by), F.lit(SALTS))).otherwise(0)
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copied = (
        table.join(hot, keys, "left")
        .withColumn("_salt", F.explode(copies.cast("array<bigint>")))
        .drop("_hot")
    )
    return salted.join(copied, [*keys, "_salt"], "left").drop("_salt", "_hot")
