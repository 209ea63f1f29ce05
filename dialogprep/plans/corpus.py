"""End-to-end jobs put together from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dialogprep import schemas
from dialogprep.config import PrepareConfig
from dialogprep.functions.hashing import in_hash_share
from dialogprep.operators.chat import MAX_HISTORY
from dialogprep.operators.prepare import gather_messages, observed_funnel, prepare_dialogs, prepare_turns
from dialogprep.operators.split import fixed_holdout_split
from dialogprep.sources.storage import stage
from dialogprep.sources.tables import read_dialogs, read_turns, require_inputs, write_messages
from dialogprep.streaming.ordered import STATE_STORE, chat_history_in_order
from dialogprep.streaming.sinks import BATCH, advance, finished_batches
from dialogprep.streaming.sources import BATCH_BYTES, STATELESS_BATCH_BYTES, read_stream

DEFAULT = PrepareConfig()


def split_corpus(convs: DataFrame, cfg: PrepareConfig = DEFAULT) -> DataFrame:
    """Staged conversations with their split.

    All columns of ``convs`` are written: select those the split is needed for.
    The corpus is cleaned once; the hold-out boundary reads the ids of the
    staged table, and the result may be read any number of times.
    """
    return fixed_holdout_split(stage(convs, "prepared"), cfg)


def prepare_corpus(
    spark: SparkSession,
    source: str,
    target: str,
    layout: str = "dialogs",
    cfg: PrepareConfig = DEFAULT,
    with_funnel: bool = False,
) -> dict[str, int | dict[str, tuple[int, int]]]:
    """Read, repair, cut, hold out, write JSON lines; returns the counts.

    They are observed while rows are written, and so is the funnel, which
    ``with_funnel`` adds: under ``funnel`` the conversations and turns of each reason.
    """
    require_inputs(spark, [source])
    funnel = Observation("funnel") if with_funnel else None
    if layout == "dialogs":
        convs = prepare_dialogs(read_dialogs(spark, source), cfg, funnel=funnel)
    elif layout == "turns":
        convs = gather_messages(prepare_turns(read_turns(spark, source), cfg, funnel=funnel), cfg)
    else:
        raise ValueError("layout is 'dialogs' or 'turns'")
    counts = Observation("counts")
    first = F.col("part") == 0
    split = split_corpus(convs, cfg).observe(
        counts,
        F.count_if(first).alias("kept"),
        F.count_if(first & (F.col("split") == "train")).alias("train"),
        F.count_if(first & (F.col("split") == "val")).alias("val"),
    )
    write_messages(split, target)
    if funnel is None:
        return counts.get
    return counts.get | {"funnel": {reason: (convs, turns) for reason, convs, turns in observed_funnel(funnel)}}


FUNNEL = "_funnel"
FUNNEL_ROWS = "reason string, conversations bigint, turns bigint"


def prepare_corpus_stream(
    spark: SparkSession,
    source: str,
    target: str,
    progress: str,
    cfg: PrepareConfig = DEFAULT,
    batch_bytes: int = STATELESS_BATCH_BYTES,
) -> None:
    """``prepare_corpus`` for a folder of dialogue files that grows; each run takes what has come since the last.

    Batches are written to ``target/batch=<id>/split=...`` as JSON lines, their
    funnels, observed on the way, to ``target/_funnel/batch=<id>``. A run that was
    stopped may be started again with the same ``progress``: nothing is lost or
    written twice. Ids are held out by hash share, since a stream has no total.
    """
    require_inputs(spark, [source])
    dialogs = read_stream(spark, source, schemas.DIALOGS, "conv_id", None, batch_bytes)

    def write(batch: DataFrame, folder: str, batch_id: int) -> None:
        funnel = Observation(f"funnel-{batch_id}")
        held_out = in_hash_share(F.col("conv_id"), cfg.seed, cfg.val_fraction)
        convs = prepare_dialogs(batch, cfg, funnel=funnel)
        convs = convs.withColumn("split", F.when(held_out, "val").otherwise("train"))
        convs.write.mode("overwrite").partitionBy("split").json(folder)
        lost = spark.createDataFrame(observed_funnel(funnel), FUNNEL_ROWS)
        lost.coalesce(1).write.mode("overwrite").json(f"{target}/{FUNNEL}/{BATCH}={batch_id}")

    advance(dialogs, target, progress, write=write)


def stream_funnel(spark: SparkSession, target: str, progress: str) -> DataFrame:
    """``(reason, conversations, turns)`` of all finished batches."""
    schema = schemas.T.StructType([*spark.createDataFrame([], FUNNEL_ROWS).schema.fields, schemas.T.StructField(BATCH, schemas.T.LongType())])
    rows = spark.read.schema(schema).json(f"{target}/{FUNNEL}")
    done = rows.where(F.col(BATCH) < finished_batches(spark, progress))
    return done.groupBy("reason").agg(F.sum("conversations").alias("conversations"), F.sum("turns").alias("turns"))


def fold_chat_stream(
    spark: SparkSession,
    source: str,
    target: str,
    progress: str,
    delay: str,
    idle_seconds: int | None = None,
    max_history: int = MAX_HISTORY,
    batch_bytes: int = BATCH_BYTES,
) -> None:
    """Histories of a folder of chat-log files that grows, to ``target/batch=<id>``; runs go on from ``progress``.

    Rows are ``(session, seq, role, line, ts)`` and come out once ``ts`` is
    ``delay`` behind the latest: ``chat_history_in_order``. ``close_log`` ends a log.
    """
    require_inputs(spark, [source])
    schema = schemas.T.StructType([*schemas.CHAT_LOG.fields, schemas.T.StructField("ts", schemas.T.TimestampType())])
    log = read_stream(spark, source, schema, "session", None, batch_bytes)
    advance(chat_history_in_order(log, delay, max_history, idle_seconds), target, progress, settings=STATE_STORE)
