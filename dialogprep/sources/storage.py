"""Where intermediate tables go, and how scans are spread."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    do without, and then gets a temporary one.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="dialogprep-")
    spark.conf.set(CHECKPOINT_DIR, own)
    return own


def is_file(spark: SparkSession, path: str) -> bool:
    """Is this one file, and not a folder of files?"""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isFile()


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write once, read many times.

    Used where an expensive result is read more than once. Re-reads see only
    the columns they need, and a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def few_splits(scan: DataFrame) -> bool:
    """Would a plain file scan leave cores idle?"""
    return scan.rdd.getNumPartitions() < 2 * scan.sparkSession.sparkContext.defaultParallelism


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Redistribute a scan that has too few splits to use the cluster.

    For a plain file scan only. A large input has far more splits than cores
    and is left where it is, without a shuffle.
    """
    if not few_splits(scan):
        return scan
    return scan.repartition(scan.sparkSession.sparkContext.defaultParallelism, key)
