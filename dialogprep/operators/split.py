"""Seeded order, exact hold-out, slices and leak checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogprep.config import DRY_RUN_ROWS, PrepareConfig
from dialogprep.functions.columns import as_long
from dialogprep.functions.hashing import key_bucket, shuffle_key

DEFAULT = PrepareConfig()


def _bucket_offsets(keyed: DataFrame) -> DataFrame:
    """``(bucket, n, before)``: at most 65,536 rows, whatever the input."""
    counts = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", as_long(F.coalesce(F.sum("n").over(earlier), F.lit(0))))


def _keyed(df: DataFrame, seed: int, id_col: str) -> DataFrame:
    missing = F.raise_error(F.lit(f"{id_col} is null: rows without an id have no place in the order"))
    key = F.when(F.col(id_col).isNull(), missing.cast("string")).otherwise(shuffle_key(F.col(id_col), seed))
    return df.withColumn("shuffle_key", key).withColumn("bucket", key_bucket(F.col("shuffle_key")))


def seeded_shuffle(df: DataFrame, seed: int = DEFAULT.seed, id_col: str = "conv_id") -> DataFrame:
    """Rows in seeded order (a range-partitioned sort)."""
    return df.orderBy(shuffle_key(F.col(id_col), seed), id_col)


def shuffle_position(df: DataFrame, seed: int = DEFAULT.seed, id_col: str = "conv_id") -> DataFrame:
    """Adds ``pos``, the 0-based place of each row in the seeded order.

    ``id_col`` is unique. The key's leading digits cut the order into 65,536
    even buckets; a row's place is its rank in the bucket plus the rows of the
    buckets before, so no task sees more than a bucket. The offsets are
    broadcast: their number is fixed. ``df`` is read twice.
    """
    keyed = _keyed(df, seed, id_col)
    offsets = _bucket_offsets(_keyed(df.select(id_col), seed, id_col)).select("bucket", "before")
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("shuffle_key", id_col))
    return (
        keyed.withColumn("_rank", rank)
        .join(F.broadcast(offsets), "bucket")
        .withColumn("pos", as_long(F.col("before") + F.col("_rank") - 1))
        .drop("shuffle_key", "bucket", "before", "_rank")
    )


def _holdout_size(n: Column, fraction: float) -> Column:
    """``max(1, floor(n * fraction))``."""
    return F.greatest(F.lit(1), F.floor(n * F.lit(float(fraction)))).cast("bigint")


def holdout_boundary(ids: DataFrame, cfg: PrepareConfig = DEFAULT) -> DataFrame:
    """The last ``(shuffle_key, conv_id)`` of the hold-out; one row, or none.

    The bucket that contains it follows from a histogram; only that bucket is
    ranked.
    """
    keyed = _keyed(ids.select("conv_id"), cfg.seed, "conv_id")
    offsets = _bucket_offsets(keyed)
    total = Window.partitionBy()
    edge = (
        offsets.withColumn("want", _holdout_size(F.sum("n").over(total), cfg.val_fraction))
        .where((F.col("before") < F.col("want")) & (F.col("before") + F.col("n") >= F.col("want")))
        .select("bucket", (F.col("want") - F.col("before")).alias("rank"))
    )
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("shuffle_key", "conv_id"))
    return (
        keyed.join(F.broadcast(edge), "bucket")
        .withColumn("_rank", rank)
        .where(F.col("_rank") == F.col("rank"))
        .select(F.struct("shuffle_key", "conv_id").alias("last"))
    )


def _heads(convs: DataFrame) -> DataFrame:
    """One row per conversation."""
    return convs.where(F.col("part") == 0) if "part" in convs.columns else convs


def assign_split(convs: DataFrame, last: Column, seed: int) -> DataFrame:
    """``val`` up to the boundary, ``train`` beyond: no shuffle, no join."""
    here = F.struct(shuffle_key(F.col("conv_id"), seed).alias("shuffle_key"), "conv_id")
    return convs.withColumn("split", F.when(here <= last, "val").otherwise("train"))


def holdout_split(convs: DataFrame, cfg: PrepareConfig = DEFAULT) -> DataFrame:
    """Adds ``split``: exactly ``max(1, floor(n * fraction))`` conversations in ``val``.

    All parts of a conversation go the same way. Rows are compared with a scalar
    boundary, so a conversation with many rows does no harm. ``convs`` is read
    three times, twice for its ids only: pass a table or a staged frame.
    """
    return assign_split(convs, holdout_boundary(_heads(convs), cfg).scalar(), cfg.seed)


def fixed_holdout_split(convs: DataFrame, cfg: PrepareConfig = DEFAULT) -> DataFrame:
    """``holdout_split`` with the boundary, one row, found now and kept as a literal.

    For a split that is read again and again: nothing is searched twice.
    """
    found = holdout_boundary(_heads(convs), cfg).first()
    if found is None:
        return convs.withColumn("split", F.lit("train"))
    key, conv_id = found["last"]
    kind = convs.schema["conv_id"].dataType
    last = F.struct(F.lit(key).alias("shuffle_key"), F.lit(conv_id).cast(kind).alias("conv_id"))
    return assign_split(convs, last, cfg.seed)


def head_slice(
    df: DataFrame, n: int = DRY_RUN_ROWS, seed: int = DEFAULT.seed, id_col: str = "conv_id"
) -> DataFrame:
    """The first ``n`` rows in seeded order (each task keeps its own ``n``)."""
    return seeded_shuffle(df, seed, id_col).limit(n)


def first_row(df: DataFrame, seed: int = DEFAULT.seed, id_col: str = "conv_id") -> DataFrame:
    return head_slice(df, 1, seed, id_col)


def content_hash(messages: Column) -> Column:
    return F.md5(F.to_json(messages))


def leak_audit(df: DataFrame) -> DataFrame:
    """Conversations present in both splits, by id and by content.

    ``(kind, key, train_rows, val_rows)``. Aggregated, not joined: copies are
    combined before the shuffle, however many there are. ``df`` may carry a
    ready ``content_hash`` in place of the messages.
    """
    ready = "content_hash" in df.columns
    content = F.col("content_hash") if ready else content_hash(F.col("messages"))
    keys = F.array(
        F.struct(F.lit("id").alias("kind"), F.col("conv_id").cast("string").alias("key")),
        F.struct(F.lit("content").alias("kind"), content.alias("key")),
    )
    return (
        df.select("split", F.inline(keys))
        .groupBy("kind", "key")
        .agg(
            F.count_if(F.col("split") == "train").alias("train_rows"),
            F.count_if(F.col("split") == "val").alias("val_rows"),
        )
        .where((F.col("train_rows") > 0) & (F.col("val_rows") > 0))
    )


def train_minus_val(df: DataFrame, val: DataFrame) -> DataFrame:
    """Rows whose conversation is not in ``val``.

    Ids are made unique first, map-side where they repeat. A conversation that
    fills a partition of ``df`` is split by adaptive execution.
    """
    return df.join(val.select("conv_id").distinct(), "conv_id", "left_anti")


def prepare_counts(loaded: DataFrame, split: DataFrame) -> DataFrame:
    """``(stage, conversations)`` for loaded, kept, train and val."""
    is_split = [F.col("split") == name for name in ("train", "val")]
    counted = _heads(split).agg(
        F.count(F.lit(1)).alias("kept"),
        F.count_if(is_split[0]).alias("train"),
        F.count_if(is_split[1]).alias("val"),
    )
    rows = F.array(
        *[F.struct(F.lit(s).alias("stage"), F.col(s).alias("conversations")) for s in ("kept", "train", "val")]
    )
    first = loaded.agg(F.count(F.lit(1)).alias("conversations")).select(
        F.lit("loaded").alias("stage"), "conversations"
    )
    return first.unionByName(counted.select(F.inline(rows)))
