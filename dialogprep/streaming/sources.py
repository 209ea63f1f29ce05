"""File streams in micro-batches of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from dialogprep.sources.storage import few_splits

BATCH_BYTES = 1 << 30
STATELESS_BATCH_BYTES = 64 << 30


def read_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    spread_by: str,
    name_glob: str | None = None,
    batch_bytes: int = BATCH_BYTES,
    fmt: str = "parquet",
    batch_files: int | None = None,
) -> DataFrame:
    """Files of ``path`` as they arrive, at most ``batch_bytes`` per micro-batch, or at most ``batch_files`` if given.

    The limit (one file at least) bounds what a stateful operator gets for one
    key at a time; stateless work can take ``STATELESS_BATCH_BYTES``. Files
    that are too few to use the cluster are redistributed by ``spread_by``; the
    choice is made from the files present at the start.
    """
    options = {"maxBytesPerTrigger": str(batch_bytes)} if batch_files is None else {"maxFilesPerTrigger": str(batch_files)}
    only = {"pathGlobFilter": name_glob} if name_glob else {}
    stream = spark.readStream.schema(schema).options(**options, **only).format(fmt).load(path)
    present = spark.read.schema(schema).options(**only).format(fmt).load(path)
    if not few_splits(present):
        return stream
    return stream.repartition(spark.sparkContext.defaultParallelism, spread_by)
