"""Checks on generated replies and on role sequences."""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialogprep.config import (
    ASSISTANT_PHRASES,
    KNOWN_ROLES,
    NO_REPEAT_NGRAM,
    REPLY_CAP,
    REPLY_ROLES,
    STOP_MARKERS,
    PrepareConfig,
)
from dialogprep.functions.columns import as_long
from dialogprep.functions.text import (
    cut_at_stop,
    extract_reply,
    has_stop,
    ngram_counts,
    plain_quotes,
    sounds_like_assistant,
    units,
)
from dialogprep.operators.ordered import BLOCK, before, carry, has_long_groups, of_long_keys, with_block
from dialogprep.sources.storage import stage

DEFAULT = PrepareConfig()


def with_reply(raw: DataFrame) -> DataFrame:
    """Adds ``reply``, the readable part of ``raw``."""
    return raw.withColumn("reply", extract_reply(F.col("raw")))


def stop_audit(
    raw: DataFrame, cap: int = REPLY_CAP, stops: Sequence[str] = STOP_MARKERS
) -> DataFrame:
    """Per run: generations without a stop marker, and those that ran to the cap."""
    text = F.coalesce("raw", F.lit(""))
    return raw.groupBy("run").agg(
        F.count(F.lit(1)).alias("replies"),
        F.count_if(~has_stop(text, stops)).alias("no_stop"),
        F.count_if(units(cut_at_stop(text, stops)) >= cap).alias("at_cap"),
    )


def repeated_ngrams(replies: DataFrame, n: int = NO_REPEAT_NGRAM) -> DataFrame:
    """Per run: share of word n-grams that repeat an earlier one of their reply."""
    return (
        replies.select("run", ngram_counts(F.coalesce("reply", F.lit("")), n).alias("g"))
        .groupBy("run")
        .agg(
            F.count(F.lit(1)).alias("replies"),
            as_long(F.sum("g.total")).alias("ngrams"),
            as_long(F.sum("g.repeated")).alias("repeated"),
            F.count_if(F.col("g.repeated") > 0).alias("looping_replies"),
        )
        .withColumn("rate", F.try_divide(F.col("repeated"), F.col("ngrams")))
    )


def assistant_voice(
    replies: DataFrame, phrases: Sequence[str] = ASSISTANT_PHRASES, by: Sequence[str] = ("run",)
) -> DataFrame:
    """Per group: replies with a stock assistant phrase, and their share."""
    return (
        replies.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("replies"),
            F.count_if(sounds_like_assistant(F.col("reply"), phrases)).alias("flagged"),
        )
        .withColumn("rate", F.col("flagged") / F.col("replies"))
    )


# Bytes of phrases that one automaton is made of; a larger table is scanned for in several.
PHRASE_BYTES = 64 << 20


def phrase_hits(replies: DataFrame, phrases: DataFrame, text: str = "reply", part_bytes: int = PHRASE_BYTES) -> DataFrame:
    """The columns of ``replies`` and ``phrase``: a row for each different phrase of a table that a reply holds.

    ``phrases`` has a column ``phrase``. Texts and phrases are compared with A-Z in lower case and with plain quotes, as
    ``sounds_like_assistant`` does. All phrases are looked for in one scan of the replies: an Aho-Corasick automaton of
    them is the state of each task, so the cost grows with the texts and the hits, not with the phrases. The
    automaton is made of what was measured to be small; a table of more than ``part_bytes`` is split into parts,
    each of which is scanned for. Null and empty phrases are in no text, a null text holds none.
    """
    known = phrases.select(_folded(F.col("phrase")).alias("phrase")).where(F.length("phrase") > 0).distinct()
    known = stage(known, "phrases")
    size = known.agg(F.sum(F.octet_length("phrase") + 64)).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    schema = T.StructType([*replies.schema.fields, T.StructField("phrase", T.StringType())])
    named = "_folded_text"
    texts = replies.withColumn(named, _folded(F.col(text)))
    found = None
    for i in range(parts):
        own = [row["phrase"] for row in known.where(part == i).toLocalIterator()]
        sent = replies.sparkSession.sparkContext.broadcast(own)
        hits = texts.mapInArrow(_scanner(sent, named), schema)
        found = hits if found is None else found.unionByName(hits)
    return found


def _folded(c: Column) -> Column:
    return F.translate(plain_quotes(c), ascii_uppercase, ascii_lowercase)


def _scanner(sent, column: str):  # noqa: ANN001
    """The scan of a task. All it uses is local, so workers need no copy of this package."""

    def scan(batches):  # noqa: ANN001, ANN202
        import ahocorasick
        import pyarrow as pa

        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, phrase in enumerate(sent.value):
            automaton.add_word(phrase, i)
        automaton.make_automaton()
        for batch in batches:
            rows, which = [], []
            for row, text in enumerate(batch.column(column).to_pylist() if len(sent.value) else []):
                if text:
                    own = sorted({i for _, i in automaton.iter(text)})
                    rows += [row] * len(own)
                    which += own
            taken = batch.drop_columns([column]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array([sent.value[i] for i in which], pa.string())], [*taken.schema.names, "phrase"])

    return scan


def assistant_voice_table(replies: DataFrame, phrases: DataFrame, by: Sequence[str] = ("run",), key: Sequence[str] = ("conv_id", "i")) -> DataFrame:
    """``assistant_voice`` with the phrases of a table, and how many different ones each group has.

    ``key`` names a reply within its group; rows of the same key are one reply.
    """
    hits = phrase_hits(replies.select(*by, *key, "reply"), phrases)
    flagged = hits.groupBy(*by, *key).agg(F.lit(True).alias("flag"))
    told = hits.groupBy(*by).agg(F.countDistinct("phrase").alias("phrases"))
    counts = replies.select(*by, *key).distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("replies"))
    flags = flagged.groupBy(*by).agg(F.count(F.lit(1)).alias("flagged"))
    zero = F.lit(0).cast("bigint")
    rows = counts.join(flags, list(by), "left").join(told, list(by), "left")
    rows = rows.select(*by, "replies", F.coalesce("flagged", zero).alias("flagged"), F.coalesce("phrases", zero).alias("phrases"))
    return rows.withColumn("rate", F.col("flagged") / F.col("replies"))


def role_audit(
    turns: DataFrame,
    key: str = "conv_id",
    order: str = "turn",
    known: Sequence[str] = KNOWN_ROLES,
    replying: Sequence[str] = REPLY_ROLES,
    cfg: PrepareConfig = DEFAULT,
) -> DataFrame:
    """``(violation, rows, conversations)`` of the role sequence of each key.

    A role outside the closed set, a role that repeats the one before, a last
    row that is not a reply. A missing role is outside the set.
    """
    rows = turns.select(key, order, F.coalesce("role", F.lit("")).alias("role"))
    if has_long_groups(rows, key, order, cfg.block_rows):
        rows = with_block(rows, key, order, cfg.block_rows)
        last = of_long_keys(rows).groupBy(key, BLOCK).agg(F.max_by("role", order).alias("_last"))
        carried = F.last("_last", ignorenulls=True).over(before(key))
        last = last.select(key, BLOCK, carried.alias("_carried"))
        lag = F.lag("role").over(Window.partitionBy(key, BLOCK).orderBy(order))
        rows = carry(rows.withColumn("_lag", lag), last, [key, BLOCK])
        previous = F.coalesce("_lag", "_carried")
    else:
        previous = F.lag("role").over(Window.partitionBy(key).orderBy(order))
    per_key = (
        rows.withColumn("previous", previous)
        .groupBy(key)
        .agg(
            F.count_if(~F.col("role").isin(*known)).alias("unknown_role"),
            F.count_if(F.col("role") == F.col("previous")).alias("broken_alternation"),
            F.max(F.struct(order, "role")).alias("_end"),
        )
        .withColumn(
            "not_ending_on_reply",
            F.when(F.col("_end.role").isin(*replying), 0).otherwise(1).cast("bigint"),
        )
    )
    kinds = ("unknown_role", "broken_alternation", "not_ending_on_reply")
    sums = [
        F.struct(
            F.lit(kind).alias("violation"),
            as_long(F.coalesce(F.sum(kind), F.lit(0))).alias("rows"),
            F.count_if(F.col(kind) > 0).alias("conversations"),
        ).alias(kind)
        for kind in kinds
    ]
    return per_key.agg(*sums).select(F.inline(F.array(*[F.col(k) for k in kinds])))
