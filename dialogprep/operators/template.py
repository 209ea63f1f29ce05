"""Rendered text, trained-on spans and training pairs, all inside a row.

Input rows are ``(conv_id, part, messages)``. Only part 0 opens with BOS: the
texts of the parts, joined in order, are the text of the conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.config import DEFAULT_TEMPLATE, ChatTemplate
from dialogprep.functions.columns import as_long, let
from dialogprep.functions.template import (
    ids_start_with_one_bos,
    is_reply,
    labeled_chars,
    render_chat,
    reply_spans,
    segment,
    starts_with_one_bos,
    trained_chars,
)
from dialogprep.functions.text import strip


def render(
    convs: DataFrame, add_generation_prompt: bool = False, tpl: ChatTemplate = DEFAULT_TEMPLATE
) -> DataFrame:
    text = render_chat(F.col("messages"), add_generation_prompt, tpl, F.col("part") == 0)
    return convs.select("conv_id", "part", text.alias("text"))


def span_rows(convs: DataFrame, tpl: ChatTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """One row per reply: ``reply``, ``start``, ``end`` in the text of its part."""
    spans = reply_spans(F.col("messages"), tpl, F.col("part") == 0)
    return convs.select("conv_id", "part", F.posexplode(spans).alias("reply", "s")).select(
        "conv_id", "part", as_long(F.col("reply")).alias("reply"), "s.start", "s.end"
    )


def _texts_with_spans(convs: DataFrame, tpl: ChatTemplate) -> DataFrame:
    """Text and one span per row.

    The outer generator is deliberate: an inner one adds a filter on the array,
    which is pushed below the projection and renders everything again.
    """
    first = F.col("part") == 0
    return (
        convs.select(
            "conv_id",
            "part",
            render_chat(F.col("messages"), False, tpl, first).alias("text"),
            reply_spans(F.col("messages"), tpl, first).alias("spans"),
        )
        .select("conv_id", "part", "text", F.posexplode_outer("spans").alias("reply", "s"))
        .where(F.col("s").isNotNull())
    )


def _inside(start, end):
    return F.substring("text", (start + 1).cast("int"), (end - start).cast("int"))


def labeled_text(convs: DataFrame, tpl: ChatTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """The text under each span of ``span_rows``: a reply as it is rendered, and its closing marker."""
    replies = F.filter("messages", lambda m: is_reply(m, tpl))
    texts = F.transform(replies, lambda m: F.concat(strip(m["content"]), F.lit(tpl.turn_close)))
    return convs.select("conv_id", "part", F.posexplode(texts).alias("reply", "labeled")).select(
        "conv_id", "part", as_long(F.col("reply")).alias("reply"), "labeled"
    )


def context_reply_pairs(
    convs: DataFrame, tpl: ChatTemplate = DEFAULT_TEMPLATE, max_turns: int | None = None
) -> DataFrame:
    """One row per reply: everything said before it, then the reply.

    The text up to a span is exactly the prompt with the reply's turn opened,
    so the history is rendered once per row and cut, not once per reply. In a
    part after the first, the prompt continues the texts of the parts before.

    With ``max_turns`` a prompt holds the last so many messages before the reply
    and opens with BOS. Messages are rendered once, and a window of them slides
    along the row: the result grows with the text, not with its square.
    """
    if max_turns is not None:
        return _windowed_pairs(convs, tpl, max_turns)
    return _texts_with_spans(convs, tpl).select(
        "conv_id",
        "part",
        as_long(F.col("reply")).alias("reply"),
        _inside(F.lit(0), F.col("s.start")).alias("prompt"),
        _inside(F.col("s.start"), F.col("s.end")).alias("completion"),
    )


def _windowed_pairs(convs: DataFrame, tpl: ChatTemplate, max_turns: int) -> DataFrame:
    if max_turns < 1:
        raise ValueError("max_turns must be positive")
    # What a message looks like in a prompt, and as a completion if it is one.
    rendered = F.transform(
        "messages",
        lambda m: F.struct(
            segment(m, tpl).alias("text"),
            F.when(is_reply(m, tpl), F.concat(strip(m["content"]), F.lit(tpl.turn_close))).alias("completion"),
            m["role"].alias("role"),
        ),
    )

    def pairs(rows: Column) -> Column:
        def pair(row: Column, i: Column) -> Column:
            seen = F.least(i, F.lit(max_turns))
            window = F.slice(rows, i - seen + 1, seen)
            opener = F.concat(F.lit(tpl.turn_open), row["role"], F.lit("\n"))
            prompt = F.concat(F.lit(tpl.bos), F.array_join(F.transform(window, lambda r: r["text"]), ""), opener)
            return F.when(row["completion"].isNotNull(), F.struct(prompt.alias("prompt"), row["completion"].alias("completion")))

        return F.filter(F.transform(rows, pair), lambda p: p.isNotNull())

    found = convs.select("conv_id", "part", F.posexplode_outer(let(rendered, pairs)).alias("reply", "p"))
    return found.where(F.col("p").isNotNull()).select(
        "conv_id", "part", as_long(F.col("reply")).alias("reply"), "p.prompt", "p.completion"
    )


def label_fraction(
    convs: DataFrame, tpl: ChatTemplate = DEFAULT_TEMPLATE, replies_only: bool = True
) -> DataFrame:
    """Trained-on share of each row, in characters; all of them without ``replies_only``."""
    total = as_long(F.length(render_chat(F.col("messages"), False, tpl, F.col("part") == 0)))
    rows = convs.select("conv_id", "part", "messages", total.alias("total_chars"))
    labeled = labeled_chars(F.col("messages"), tpl) if replies_only else F.col("total_chars")
    return rows.select("conv_id", "part", labeled.alias("labeled_chars"), "total_chars").withColumn(
        "fraction", F.col("labeled_chars") / F.col("total_chars")
    )


def label_total(
    convs: DataFrame, tpl: ChatTemplate = DEFAULT_TEMPLATE, replies_only: bool = True
) -> DataFrame:
    rows = label_fraction(convs, tpl, replies_only)
    return rows.agg(
        as_long(F.sum("labeled_chars")).alias("labeled_chars"),
        as_long(F.sum("total_chars")).alias("total_chars"),
    ).withColumn("fraction", F.col("labeled_chars") / F.col("total_chars"))


def bos_check(texts: DataFrame, tpl: ChatTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """Adds ``one_bos``: does the text open with exactly one BOS?"""
    return texts.withColumn("one_bos", F.coalesce(starts_with_one_bos(F.col("text"), tpl), F.lit(False)))


def token_bos_check(tokens: DataFrame, bos_id: int) -> DataFrame:
    """Adds ``one_bos``: do the token ids in ``ids`` open with exactly one BOS?"""
    return tokens.withColumn("one_bos", F.coalesce(ids_start_with_one_bos(F.col("ids"), bos_id), F.lit(False)))


def token_mask(
    tokens: DataFrame, tpl: ChatTemplate = DEFAULT_TEMPLATE, replies_only: bool = True
) -> DataFrame:
    """Adds ``assistant_masks``, 1 for each token that is trained on, and their ``labeled_ids``.

    ``tokens`` holds ``conv_id, part, messages`` and what the user's own tokenizer made of the rendered
    text: ``ids`` and ``offsets array<struct<start, end>>``, character offsets with the end exclusive. A token
    that touches a trained-on span counts; one without characters, such as a marker put in, does not.
    Without ``replies_only`` every token counts.
    """
    if replies_only:
        # Bound once a row; as a column of its own it would be moved into the lambda and built for each token.
        masks = let(
            trained_chars(F.col("messages"), tpl, F.col("part") == 0),
            lambda trained: F.transform(
                "offsets",
                lambda o: F.exists(
                    F.slice(trained, (o["start"] + 1).cast("int"), (o["end"] - o["start"]).cast("int")), lambda c: c
                ).cast("int"),
            ),
        )
    else:
        masks = F.transform("ids", lambda _: F.lit(1))
    masked = tokens.withColumn("assistant_masks", masks)
    kept = F.filter(F.arrays_zip("ids", "assistant_masks"), lambda t: t["assistant_masks"] == 1)
    return masked.withColumn("labeled_ids", kept["ids"])


def token_label_fraction(
    tokens: DataFrame, tpl: ChatTemplate = DEFAULT_TEMPLATE, replies_only: bool = True
) -> DataFrame:
    """Trained-on share of each row, in tokens; ``tokens`` as ``token_mask`` takes them. A row without tokens has none."""
    masked = token_mask(tokens, tpl, replies_only)
    n = as_long(F.size("labeled_ids")).alias("labeled_tokens")
    return masked.select("conv_id", "part", n, as_long(F.size("ids")).alias("total_tokens")).withColumn(
        "fraction", F.try_divide(F.col("labeled_tokens"), F.col("total_tokens"))
    )


def token_label_total(
    tokens: DataFrame, tpl: ChatTemplate = DEFAULT_TEMPLATE, replies_only: bool = True
) -> DataFrame:
    """``label_total`` in tokens."""
    rows = token_label_fraction(tokens, tpl, replies_only)
    return rows.agg(
        as_long(F.sum("labeled_tokens")).alias("labeled_tokens"),
        as_long(F.sum("total_tokens")).alias("total_tokens"),
    ).withColumn("fraction", F.try_divide(F.col("labeled_tokens"), F.col("total_tokens")))
