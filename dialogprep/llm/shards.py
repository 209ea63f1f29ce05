"""Sharding by a two-pass external shuffle: rows are scattered into buckets by hash, and each bucket is shuffled and written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogprep.sources.storage import stage

SEED = 42
#: Bytes of text a bucket is planned for; a task holds one bucket.
BUCKET_BYTES = 32 << 20
#: Beyond so many buckets they grow, up to MOST_BYTES each.
BUCKETS, MOST_BYTES = 1 << 16, 256 << 20
#: Offsets of up to so many buckets, 16 bytes each, are broadcast.
SENT_BUCKETS = 1 << 20
GROUP = 1 << 10


def size_of(text: Column | str = "text") -> Column:
    """Bytes of the text in UTF-8 and one more; a null text has none."""
    column = F.col(text) if isinstance(text, str) else text
    return (F.coalesce(F.octet_length(column), F.lit(0)) + 1).cast("long")


def shard(docs: DataFrame, shards: int = 16, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The columns of ``docs`` with ``shard`` (from 0) and ``slot``, the place in the shard without gaps from 0.

    All rows are put in one random order, and shards are consecutive parts of it whose counts differ by one at
    most. The order is fixed by ``seed`` for given files, and as good as uniform over all orders.

    * First pass: a hash of the seed, the id and the row's number deals rows into buckets that fit in memory. Equal
      texts, ids and even rows are dealt like any others, so nothing makes a bucket large but a single text.
    * Second pass: a task takes its bucket in the order of the hashes, shuffles it by Fisher and Yates (that is
      what the built-in ``shuffle`` does) and writes it. A lost task gives the same order again.
    * Counts of buckets, added up in groups and then inside them, give each row its place in the whole order.

    Only built-in expressions are used. A frame that comes out of a shuffle is written first, so that the rows of
    a task, and with them their numbers, are the same if it is run again. Null texts and ids are rows like
    others; an empty table stays empty. Columns ``shard`` and ``slot`` are replaced.
    """
    if "Exchange" in docs._jdf.queryExecution().executedPlan().toString():
        docs = stage(docs, "to-shard", compression="zstd")
    own = [c for c in docs.columns if c not in ("shard", "slot")]
    total = docs.agg(F.sum(size_of())).first()[0] or 0
    least = min(MOST_BYTES, max(bucket_bytes, total // BUCKETS))
    n = max(1, -(-total // least))

    dealt = F.xxhash64(F.lit(seed), "doc_id", F.monotonically_increasing_id())
    rows = docs.select(F.struct(*own).alias("row"), dealt.alias("hash"))
    rows = rows.select("row", "hash", F.pmod("hash", F.lit(n)).cast("int").alias("bucket"))
    rows = rows.repartitionById(n, "bucket").sortWithinPartitions("bucket", "hash")
    buckets = rows.groupBy("bucket").agg(F.collect_list("row").alias("rows"))
    written = buckets.select("bucket", F.posexplode(F.shuffle("rows", F.lit(seed))).alias("rank", "row"))
    written = stage(written, "buckets", compression="zstd")

    offsets = _offsets(written.groupBy("bucket").agg(F.count("*").alias("n")))
    n_rows = max(1, written.count())
    placed = written.join(F.broadcast(offsets) if n <= SENT_BUCKETS else offsets, "bucket")
    place = (F.col("before") + F.col("rank")).cast("decimal(38,0)")
    number = F.expr(f"cast(cast(before + rank as decimal(38,0)) * {shards} div {n_rows} as bigint)")
    placed = placed.select("row", place.cast("long").alias("place"), number.alias("shard"))
    first = F.expr(f"cast((cast(shard as decimal(38,0)) * {n_rows} + {shards - 1}) div {shards} as bigint)")
    return placed.select("row.*", F.col("shard").cast("int").alias("shard"), (F.col("place") - first).alias("slot"))


def _offsets(counts: DataFrame) -> DataFrame:
    """(bucket, before): rows of all buckets before; sums over groups of buckets first, so that no window holds all."""
    counts = counts.withColumn("group", F.expr(f"bucket div {GROUP}"))
    earlier = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = counts.groupBy("group").agg(F.sum("n").alias("n"))
    groups = groups.select("group", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("of_group"))
    inside = Window.partitionBy("group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    own = counts.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return own.join(groups, "group").select("bucket", (F.col("of_group") + F.col("inside")).alias("before"))


def write_shards(docs: DataFrame, folder: str, shards: int = 16, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Parquet files in a folder for each shard; rows of a file follow each other by ``slot``.

    A bucket lies in one shard, or in few that follow each other, so a task opens few files.
    """
    shard(docs, shards, seed, bucket_bytes).write.partitionBy("shard").parquet(folder)
