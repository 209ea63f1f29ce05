"""Readers and writers of dialogue corpora."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialogprep import schemas
from dialogprep.config import PrepareConfig
from dialogprep.operators.lookup import fits_broadcast
from dialogprep.operators.ordered import dense_index
from dialogprep.operators.prepare import dialog_turns
from dialogprep.sources.storage import spread, stage

DEFAULT = PrepareConfig()


def read_dialogs(spark: SparkSession, path: str) -> DataFrame:
    """Parquet with one conversation per row; other columns are not read.

    ``conv_id`` may be of any type. Without it, rows get an id from where they stand.
    """
    found = spark.read.parquet(path)
    if "conv_id" in found.columns:
        return spread(found.select("conv_id", "dialog"), "conv_id")
    return spread(found.select(position_id(path).alias("conv_id"), "dialog"), "conv_id")


def position_id(path: str) -> Column:
    """An id for each row of Parquet files: its file, within ``path``, and its number there.

    It costs no shuffle, tells equal rows apart, and is the same for the same
    files, wherever the folder lies and however the scan is cut.
    """
    folder = path.rstrip("/").split("://")[-1]
    inside = F.substring_index(F.col("_metadata.file_path"), folder, -1)
    return F.xxhash64(inside, F.col("_metadata.row_index"))


def spread_ids(rows: DataFrame, content: str) -> DataFrame:
    """``conv_id`` from the content of a row and its number among equal rows.

    Equal rows are interchangeable, so the ids do not depend on how the rows are
    dealt out. Rows stay where they are: what is shuffled is the digests, to tell
    which repeat. Only rows with such a digest are written and numbered, by the
    partition they are written from and then inside it, so that any share of the
    rows may be equal.
    """
    named = rows.withColumn("_digest", F.xxhash64(F.to_json(F.struct(content))))
    first = F.xxhash64("_digest", F.lit(1)).alias("conv_id")
    counts = named.select("_digest").groupBy("_digest").agg(F.count(F.lit(1)).alias("_n"))
    repeated = stage(counts.where(F.col("_n") > 1).select("_digest"), "repeated")
    if repeated.isEmpty():
        return named.select(first, *rows.columns)
    known = F.broadcast(repeated) if fits_broadcast(repeated) else repeated
    once = named.join(known, "_digest", "left_anti").select(first, *rows.columns)
    more = stage(named.join(known, "_digest", "left_semi").withColumn("_from", F.spark_partition_id()), "repeats")
    earlier = Window.partitionBy("_digest").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    offsets = more.groupBy("_digest", "_from").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select("_digest", "_from", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_digest", "_from").orderBy(F.lit(0)))
    more = more.withColumn("_own", own).join(offsets, ["_digest", "_from"])
    nth = (F.col("_before") + F.col("_own")).cast("int")
    return once.unionByName(more.select(F.xxhash64("_digest", nth).alias("conv_id"), *rows.columns))


def read_turns(spark: SparkSession, path: str) -> DataFrame:
    """Parquet with one turn per row."""
    return spark.read.schema(schemas.TURNS).parquet(path)


def dialogs_from_text(texts: DataFrame, id_col: str, text_col: str, separator: str = "\n") -> DataFrame:
    """Texts with one utterance per line as dialogues; ``separator`` is plain text."""
    quoted = re.escape(separator)
    return texts.select(
        F.col(id_col).alias("conv_id"), F.split(text_col, quoted).alias("dialog")
    )


def turns_to_dialogs(turns: DataFrame, cfg: PrepareConfig = DEFAULT) -> DataFrame:
    """Turn rows to ``(conv_id, part, dialog)``, utterances in order.

    A dialogue of more than ``part_messages`` turns is delivered in parts.
    ``prepare_turns`` does not need this: it works on the turns themselves.
    """
    indexed = dense_index(dialog_turns(turns), "conv_id", "turn", cfg.block_rows)
    return (
        indexed.withColumn("part", F.floor(F.col("i") / cfg.part_messages).cast("int"))
        .groupBy("conv_id", "part")
        .agg(F.sort_array(F.collect_list(F.struct("i", "text"))).alias("rows"))
        .select("conv_id", "part", F.col("rows.text").alias("dialog"))
    )


def read_messages(spark: SparkSession, path: str | list[str], schema=schemas.CONVERSATION_LINES) -> DataFrame:
    """JSON lines of ``messages``; a malformed line fails the job.

    Bare lines, without the id columns, count as whole conversations. They get an
    id from their content and their number among equal lines, so that repeated
    conversations stay apart.
    """
    lines = spark.read.schema(schema).json(path, mode="FAILFAST")
    lines = lines.withColumn("part", F.coalesce("part", F.lit(0)))
    bare = F.col("conv_id").isNull()
    if lines.where(bare).limit(1).isEmpty():
        return lines
    named = spread_ids(lines.where(bare).drop("conv_id"), "messages").select(*lines.columns)
    return lines.where(~bare).unionByName(named)


def read_splits(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Several named splits as one frame with a ``split`` column."""
    if not paths:
        raise ValueError("no splits given")
    frames = [read_messages(spark, p).withColumn("split", F.lit(name)) for name, p in paths.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def read_split_dir(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_messages`` wrote: a filter on ``split`` prunes directories."""
    schema = schemas.T.StructType([*schemas.CONVERSATION_LINES.fields, schemas.T.StructField("split", schemas.T.StringType())])
    return read_messages(spark, path, schema)


def write_messages(convs: DataFrame, path: str, keys: Iterable[str] = ("conv_id", "part")) -> None:
    """One JSON object per line, non-ASCII unescaped, a directory per split.

    ``keys`` are written next to ``messages``; pass none for bare lines.
    """
    columns = [*keys, "messages"]
    if "split" in convs.columns:
        convs.select(*columns, "split").write.partitionBy("split").json(path)
    else:
        convs.select(*columns).write.json(path)


def require_inputs(spark: SparkSession, paths: Iterable[str]) -> None:
    """Fail before any work, naming every missing path."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        found = path.getFileSystem(conf).globStatus(path)
        if not found:
            missing.append(p)
    if missing:
        raise FileNotFoundError("missing input: " + ", ".join(missing))
