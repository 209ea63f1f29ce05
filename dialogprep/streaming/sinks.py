"""File sinks: one catch-up run of a stream, and runs that go on where the last one ended."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialogprep.sources.storage import fresh_path

NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
BATCH = "batch"


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """A query keeps the settings that it is started with."""
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def drain(stream: DataFrame, name: str, output_mode: str = "append", settings: dict[str, str] | None = None) -> DataFrame:
    """Process what has arrived, once, into a fresh folder, and read the result back.

    Batches without data are off for this query, unless ``settings`` has them
    on: waiting for a processing-time timeout, it would run them for ever, but
    event-time timers need them.
    """
    spark = stream.sparkSession
    out = fresh_path(spark, name)
    with _settings(spark, {NO_DATA_BATCHES: "false"} | (settings or {})):
        query = (
            stream.writeStream.format("parquet")
            .outputMode(output_mode)
            .option("checkpointLocation", f"{out}-progress")
            .trigger(availableNow=True)
            .start(out)
        )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def advance(
    stream: DataFrame,
    out: str,
    progress: str,
    settings: dict[str, str] | None = None,
    write: Callable[[DataFrame, str, int], None] | None = None,
) -> None:
    """Process what has arrived since the last run with the same ``progress``, into folders ``out/batch=<id>``.

    ``progress`` holds the offsets and the state. A run that is stopped at any
    point may be started again: a batch that was not finished comes again with
    the same id and the same rows, and replaces what its folder holds.
    ``write(batch, folder, id)`` may write it in another way, if it replaces too.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        folder = f"{out}/{BATCH}={batch_id}"
        if write is None:
            batch.write.mode("overwrite").parquet(folder)
        else:
            write(batch, folder, batch_id)

    with _settings(stream.sparkSession, settings or {}):
        query = (
            stream.writeStream.foreachBatch(replace)
            .outputMode("append")
            .option("checkpointLocation", progress)
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()


def finished_batches(spark: SparkSession, progress: str) -> int:
    """How many batches runs with this ``progress`` have finished."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{progress}/commits")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []
    return max((int(name) + 1 for name in names if name.isdigit()), default=0)


def advanced(spark: SparkSession, out: str, progress: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """What finished batches have written; one that is being written or was cut off is not seen."""
    n = finished_batches(spark, progress)
    if not n:
        return spark.createDataFrame([], schema)
    whole = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(whole).format(fmt).load(out).where(F.col(BATCH) < n).drop(BATCH)
