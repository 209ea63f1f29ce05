"""The chat format as Column expressions over ``ARRAY<STRUCT<role, content>>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialogprep.config import DEFAULT_TEMPLATE, ChatTemplate
from dialogprep.functions.columns import as_long, let
from dialogprep.functions.text import strip


def _bos(tpl: ChatTemplate, with_bos: Column | bool) -> Column:
    if isinstance(with_bos, bool):
        return F.lit(tpl.bos if with_bos else "")
    return F.when(with_bos, tpl.bos).otherwise("")


def turn_opener(tpl: ChatTemplate = DEFAULT_TEMPLATE) -> str:
    """What a prompt ends with: the reply's turn is open, its text is not there."""
    return f"{tpl.turn_open}{tpl.reply_role}\n"


def segment(message: Column, tpl: ChatTemplate = DEFAULT_TEMPLATE) -> Column:
    """One message as text, with its closing newline."""
    return F.concat(
        F.lit(tpl.turn_open),
        message["role"],
        F.lit("\n"),
        strip(message["content"]),
        F.lit(f"{tpl.turn_close}\n"),
    )


def render_chat(
    messages: Column,
    add_generation_prompt: bool = False,
    tpl: ChatTemplate = DEFAULT_TEMPLATE,
    with_bos: Column | bool = True,
) -> Column:
    """A whole conversation as training text, or as a prompt waiting for a reply."""
    body = F.array_join(F.transform(messages, lambda m: segment(m, tpl)), "")
    tail = turn_opener(tpl) if add_generation_prompt else ""
    return F.concat(_bos(tpl, with_bos), body, F.lit(tail))


#: Messages whose spans are gathered in one array that grows.
SPAN_BLOCK = 128


def is_reply(message: Column, tpl: ChatTemplate = DEFAULT_TEMPLATE) -> Column:
    return message["role"].isin(*tpl.reply_roles)


def reply_spans(
    messages: Column,
    tpl: ChatTemplate = DEFAULT_TEMPLATE,
    with_bos: Column | bool = True,
) -> Column:
    """Trained-on character spans of the rendered text, 0-based and half open.

    A span covers the reply and its closing marker: a model that never sees the
    marker trained never learns to stop. The newline after it stays out.
    """
    kind = "struct<at:bigint,spans:array<struct<start:bigint,end:bigint>>>"
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    close = len(tpl.turn_close)

    # Lengths up to the content and of it with its marker; the content is stripped once.
    sized = F.transform(
        messages,
        lambda m: F.struct(
            as_long(len(tpl.turn_open) + F.length(m["role"]) + 1).alias("head"),
            as_long(F.length(strip(m["content"])) + close).alias("body"),
            is_reply(m, tpl).alias("reply"),
        ),
    )

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + m["head"]
        end = start + m["body"]
        span = F.struct(start.alias("start"), end.alias("end"))
        spans = F.when(m["reply"], F.array_append(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans")).cast(kind)

    def within(block: Column, at: Column) -> Column:
        return F.aggregate(block, F.struct(at.alias("at"), none.alias("spans")).cast(kind), step, lambda acc: acc["spans"])

    # An array that grows is copied at each step, so spans are made block by block, from where each block begins.
    def spans_of(blocks: Column) -> Column:
        begins = F.aggregate(
            blocks,
            F.array(as_long(F.length(_bos(tpl, with_bos)))),
            lambda acc, b: F.array_append(
                acc, F.element_at(acc, -1) + F.aggregate(b, F.lit(0).cast("bigint"), lambda n, m: n + m["head"] + m["body"] + 1)
            ),
        )
        return F.flatten(F.zip_with(blocks, F.slice(begins, F.lit(1), F.size(blocks)), within))

    def cut(rows: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(rows), F.lit(SPAN_BLOCK))
        return F.transform(starts, lambda at: F.slice(rows, at, F.lit(SPAN_BLOCK)))

    found = let(sized, lambda rows: F.when(F.size(rows) > 0, let(cut(rows), spans_of)).otherwise(none))
    return F.when(messages.isNotNull(), found)


def labeled_chars(messages: Column, tpl: ChatTemplate = DEFAULT_TEMPLATE) -> Column:
    """Total length of the reply spans, without building them."""
    return F.aggregate(
        F.filter(messages, lambda m: is_reply(m, tpl)),
        F.lit(0).cast("bigint"),
        lambda acc, m: as_long(acc + F.length(strip(m["content"])) + len(tpl.turn_close)),
    )


def trained_chars(
    messages: Column, tpl: ChatTemplate = DEFAULT_TEMPLATE, with_bos: Column | bool = True
) -> Column:
    """For each character of the rendered text, whether a reply span covers it."""

    def flags(value: bool, n: Column | int) -> Column:
        return F.array_repeat(F.lit(value), n)

    def of_message(m: Column) -> Column:
        head = F.lit(len(tpl.turn_open) + 1) + F.length(m["role"])
        body = F.length(strip(m["content"])) + len(tpl.turn_close)
        reply = F.concat(flags(False, head), flags(True, body), flags(False, 1))
        return F.when(is_reply(m, tpl), reply).otherwise(flags(False, head + body + 1))

    return F.concat(flags(False, F.length(_bos(tpl, with_bos))), F.flatten(F.transform(messages, of_message)))


def starts_with_one_bos(text: Column, tpl: ChatTemplate = DEFAULT_TEMPLATE) -> Column:
    return F.startswith(text, F.lit(tpl.bos)) & ~F.startswith(text, F.lit(tpl.bos * 2))


def ids_start_with_one_bos(ids: Column, bos_id: int) -> Column:
    """The same check on token ids from the user's own tokenizer."""
    second = F.get(ids, F.lit(1))
    return (F.get(ids, F.lit(0)) == bos_id) & (second.isNull() | (second != bos_id))
