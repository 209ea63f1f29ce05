"""Perplexity, run trends, checkpoints and reply tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogprep.config import DEFAULT_TEMPLATE, EVAL_PROMPTS, KEEP_CHECKPOINTS, ROLE_USER, ChatTemplate
from dialogprep.functions.columns import as_long
from dialogprep.functions.template import render_chat
from dialogprep.operators.lookup import MAX_BROADCAST_ROWS, lookup
from dialogprep.sources.storage import stage

START, END = "<s>", "</s>"


# --- Losses ---------------------------------------------------------------


def _is_loss(column: str) -> Column:
    return F.col(column).isNotNull() & ~F.isnan(column)


def perplexity(losses: DataFrame, by: Sequence[str] = ("run",), shifted: bool = False) -> DataFrame:
    """``exp(sum(loss * n) / sum(n))`` per run.

    ``losses`` holds the mean loss and unit count of each conversation. Long
    conversations weigh more. ``shifted`` weighs by ``n - 1``, the number of
    predicted units. A row without a loss, or with NaN, has no weight.
    """
    n = F.col("n_tokens") - 1 if shifted else F.col("n_tokens")
    n = F.when(_is_loss("mean_loss"), n)
    return losses.groupBy(*by).agg(
        as_long(F.sum("n_tokens")).alias("n_tokens"),
        F.exp(F.sum(F.when(_is_loss("mean_loss"), F.col("mean_loss")) * n) / F.sum(n)).alias("perplexity"),
    )


def run_trend(losses: DataFrame, order: str = "run_no") -> DataFrame:
    """Perplexity of each run and its change from the run before.

    The window sees one row per training run, after aggregation.
    """
    previous = F.lag("perplexity").over(Window.orderBy(order))
    return perplexity(losses, (order,)).withColumn("change", F.col("perplexity") - previous)


# --- An n-gram model as a Spark-native source of losses --------------------


def _word_pairs(convs: DataFrame, roles: Sequence[str] = ()) -> DataFrame:
    """``(conv_id, prev, w)``: every word with the one before; messages end in ``</s>``.

    With ``roles``, only the messages of those roles.
    """
    messages = F.filter("messages", lambda m: m["role"].isin(*roles)) if roles else F.col("messages")
    pairs = convs.select("conv_id", F.explode(messages["content"]).alias("text")).select(
        "conv_id", F.split("text", " ").alias("ws")
    )
    # Outer, so that no inferred filter on the array splits every text again.
    zipped = F.arrays_zip(
        F.concat(F.array(F.lit(START)), F.col("ws")), F.concat(F.col("ws"), F.array(F.lit(END)))
    )
    return pairs.select("conv_id", F.inline_outer(zipped).alias("prev", "w")).where(F.col("w").isNotNull())


def _log_add_one(count: Column, total: Column, vocabulary: Column) -> Column:
    return -F.ln((F.coalesce(count, F.lit(0)) + 1) / (F.coalesce(total, F.lit(0)) + vocabulary))


def ngram_losses(
    train: DataFrame,
    val: DataFrame,
    n: int = 1,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    replies_only: bool = False,
    tpl: ChatTemplate = DEFAULT_TEMPLATE,
) -> DataFrame:
    """Mean loss per ``val`` conversation under an add-one model of ``train``.

    ``n`` is 1 or 2. One word more than seen stands for all unknown words. The
    counts are staged: they give the totals and are looked up. With
    ``replies_only`` just the words of replies are scored; the model still
    learns from all.
    """
    if n not in (1, 2):
        raise ValueError("n must be 1 or 2")
    gram = ["w"] if n == 1 else ["prev", "w"]
    grams = stage(
        _word_pairs(train).groupBy(*gram).agg(F.count(F.lit(1)).alias("seen")), "ngrams"
    )
    vocabulary = grams.agg(F.count_distinct("w") + 1).scalar()
    scored = _word_pairs(val, tpl.reply_roles if replies_only else ())
    facts = lookup(scored.select("conv_id", *gram), grams, gram, "conv_id", max_broadcast_rows)
    if n == 1:
        total = grams.agg(F.sum("seen")).scalar()
    else:
        contexts = stage(grams.groupBy("prev").agg(F.sum("seen").alias("context")), "contexts")
        facts = lookup(facts, contexts, ["prev"], "conv_id", max_broadcast_rows)
        total = F.col("context")
    loss = _log_add_one(F.col("seen"), total, vocabulary)
    return facts.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_tokens"), F.avg(loss).alias("mean_loss")
    ).select(F.lit(f"{n}-gram").alias("run"), "conv_id", "n_tokens", "mean_loss")


def ngram_perplexity(train: DataFrame, val: DataFrame, n: int = 1) -> DataFrame:
    """Word-level perplexity; not comparable with a neural model's."""
    return perplexity(ngram_losses(train, val, n)).withColumnsRenamed(
        {"n_tokens": "n_words", "perplexity": "ngram_perplexity"}
    )


# --- Checkpoints ----------------------------------------------------------


def best_checkpoint(log: DataFrame) -> DataFrame:
    """Per run the saved step with the lowest ``eval_loss``, earliest on a tie.

    A step without a loss, or with NaN, is never the best.
    """
    return (
        log.where(F.col("saved") & _is_loss("eval_loss"))
        .groupBy("run")
        .agg(F.min(F.struct("eval_loss", "step")).alias("best"))
        .select("run", F.col("best.step").alias("step"), F.col("best.eval_loss").alias("eval_loss"))
    )


def checkpoint_retention(log: DataFrame, keep: int = KEEP_CHECKPOINTS) -> DataFrame:
    """Saved steps that stay on disk: the newest ``keep`` and the best.

    The rank filter stands alone, so that Spark keeps ``keep`` rows per run in
    each task before it shuffles.
    """
    saved = log.where("saved").select("run", "step", "eval_loss")
    newest = (
        saved.withColumn("_age", F.row_number().over(Window.partitionBy("run").orderBy(F.desc("step"))))
        .where(F.col("_age") <= keep)
        .select("run", "step", "eval_loss", F.lit(False).alias("is_best"))
    )
    best = best_checkpoint(log).select("run", "step", "eval_loss", F.lit(True).alias("is_best"))
    return (
        newest.unionByName(best)
        .groupBy("run", "step")
        .agg(F.max("eval_loss").alias("eval_loss"), F.max("is_best").alias("is_best"))
    )


# --- Prompts and replies --------------------------------------------------


def eval_matrix(
    runs: DataFrame,
    prompts: Sequence[str] = EVAL_PROMPTS,
    tpl: ChatTemplate = DEFAULT_TEMPLATE,
) -> DataFrame:
    """Every fixed prompt for every run, rendered and waiting for a reply.

    The battery is a literal array: one row per run becomes one per prompt.
    """
    battery = F.array(*[F.lit(p) for p in prompts])
    message = F.array(F.struct(F.lit(ROLE_USER).alias("role"), F.col("prompt").alias("content")))
    return runs.select("run", F.posexplode(battery).alias("prompt_id", "prompt")).withColumn(
        "rendered", render_chat(message, add_generation_prompt=True, tpl=tpl)
    )


def side_by_side(
    replies: DataFrame, a: str, b: str, keys: Sequence[str] = ("prompt_id",)
) -> DataFrame:
    """Replies of two runs to the same prompt, null where a run has none.

    A prompt answered more than once has a row for each of its replies, those of
    both runs side by side in the order of their texts; ``n_a`` and ``n_b`` count
    them. Both runs are read in one scan and met by one shuffle on ``keys``.
    """
    in_a, in_b = F.col("run") == a, F.col("run") == b
    nth = F.row_number().over(Window.partitionBy(*keys, "run").orderBy("reply"))
    every = Window.partitionBy(*keys)
    return (
        replies.where(in_a | in_b)
        .withColumn("_nth", nth)
        .withColumns({"n_a": F.count_if(in_a).over(every), "n_b": F.count_if(in_b).over(every)})
        .groupBy(*keys, "_nth")
        .agg(
            F.max(F.when(in_a, F.col("reply"))).alias("reply_a"),
            F.max(F.when(in_b, F.col("reply"))).alias("reply_b"),
            F.max("n_a").alias("n_a"),
            F.max("n_b").alias("n_b"),
        )
        .drop("_nth")
    )
