"""Text repair and reply inspection as built-in Column expressions (no UDFs)."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialogprep.config import (
    ASSISTANT_PHRASES,
    NO_REPEAT_NGRAM,
    SPECIAL_TOKENS,
    STOP_MARKERS,
)
from dialogprep.functions.columns import let

# Unicode whitespace plus the four ASCII separators U+001C-U+001F, which Java's
# own Unicode \s leaves out. Needs the (?U) flag. As a predicate plus a bitmap
# it is several times faster in java.util.regex than the same set in ranges.
WS = r"[\s\x1c-\x1f]"

# A whitespace run, tried from its first character only and never given back, so
# a text of blanks costs linear time. The look behind comes after the first
# character: most positions fail on that one.
_RUN = rf"{WS}(?<!{WS}{WS}){WS}*+"


def tighten_punctuation(c: Column) -> Column:
    """Drop whitespace in front of ``. , ! ? ; :``."""
    return F.regexp_replace(c, rf"(?U){_RUN}([.,!?;:])", "$1")


def rejoin_apostrophes(c: Column) -> Column:
    """Glue an apostrophe that follows whitespace to both of its neighbours."""
    return F.regexp_replace(c, rf"(?U){_RUN}(['’]){WS}*+", "$1")


def plain_quotes(c: Column) -> Column:
    """Right single and both double curly quotes to ASCII."""
    return F.translate(c, "’“”", "'\"\"")


def collapse_whitespace(c: Column) -> Column:
    """One blank per whitespace run, none at the ends.

    Single blanks, by far the most common run, are left alone instead of being
    replaced by themselves.
    """
    other = r"[\s\x1c-\x1f&&[^ ]]"
    return F.btrim(F.regexp_replace(c, rf"(?U) {WS}++|{other}{WS}*+", " "))


def tighten_all(c: Column) -> Column:
    """``tighten_punctuation`` then ``rejoin_apostrophes`` in one scan.

    Each step only removes whitespace next to a character the other does not
    match, so one alternation gives the same text (property-tested).
    """
    return F.regexp_replace(c, rf"(?U){_RUN}(?:([.,!?;:])|(['’]){WS}*+)", "$1$2")


STEPS: tuple[Callable[[Column], Column], ...] = (
    tighten_punctuation,
    rejoin_apostrophes,
    plain_quotes,
    collapse_whitespace,
)

FUSED_STEPS: tuple[Callable[[Column], Column], ...] = (
    tighten_all,
    plain_quotes,
    collapse_whitespace,
)


def clean_utterance(
    c: Column, steps: Sequence[Callable[[Column], Column]] = FUSED_STEPS
) -> Column:
    """Undo word-tokenized spacing. ``steps`` is the extension point."""
    for step in steps:
        c = step(c)
    return c


def strip(c: Column) -> Column:
    """Trim the same whitespace at both ends, keeping the inside."""
    return F.regexp_replace(c, rf"(?U)\A{WS}++|{_RUN}\z", "")


def in_length_band(length: Column, lo: int, hi: int) -> Column:
    """True inside the closed band; null length counts as outside."""
    return F.coalesce(length.between(lo, hi), F.lit(False))


def units(c: Column) -> Column:
    """Number of words and single punctuation marks, a stand-in for tokens.

    Not a tokenizer: results are labelled *units*. Every sizing operator takes
    another ``Column -> Column`` counter instead, such as a ``pandas_udf``.
    """
    return F.regexp_count(c, F.lit(rf"(?U)[\p{{L}}\p{{N}}_]++|[^\p{{L}}\p{{N}}_\s\x1c-\x1f]")).cast("bigint")


def cut_at_stop(c: Column, stops: Sequence[str] = STOP_MARKERS) -> Column:
    """Text before the earliest stop marker."""
    for stop in stops:
        c = F.substring_index(c, stop, 1)
    return c


def extract_reply(
    c: Column,
    stops: Sequence[str] = STOP_MARKERS,
    special: Sequence[str] = SPECIAL_TOKENS,
) -> Column:
    """What a reader sees of a raw generation: cut, drop specials, strip."""
    c = cut_at_stop(c, stops)
    for token in special:
        if token not in stops:
            c = F.replace(c, F.lit(token), F.lit(""))
    return strip(c)


def has_stop(c: Column, stops: Sequence[str] = STOP_MARKERS) -> Column:
    found = F.lit(False)
    for stop in stops:
        found = found | F.contains(c, F.lit(stop))
    return found


def words(c: Column) -> Column:
    """Whitespace-separated words; empty array for blank text."""
    return F.filter(F.split(c, rf"(?U){WS}+"), lambda w: w != "")


def ngram_counts(c: Column, n: int = NO_REPEAT_NGRAM) -> Column:
    """``STRUCT<total, repeated>`` of the word n-grams of a text.

    The grams are joined to strings: distinct strings are found by hashing,
    distinct arrays pair by pair.
    """

    def count(ws: Column) -> Column:
        grams = F.when(
            F.size(ws) >= n,
            F.transform(
                F.sequence(F.lit(1), F.size(ws) - F.lit(n - 1)),
                lambda at: F.array_join(F.slice(ws, at, F.lit(n)), " "),
            ),
        ).otherwise(F.array().cast("array<string>"))
        return let(
            grams,
            lambda g: F.struct(
                F.size(g).cast("bigint").alias("total"),
                (F.size(g) - F.size(F.array_distinct(g))).cast("bigint").alias("repeated"),
            ),
        )

    return let(words(c), count)


def sounds_like_assistant(
    c: Column, phrases: Sequence[str] = ASSISTANT_PHRASES
) -> Column:
    """True if any stock phrase occurs, whatever the case or apostrophe style."""
    if not phrases:
        return F.lit(False)
    pattern = "(?i)" + "|".join(re.escape(p) for p in phrases)
    return F.coalesce(plain_quotes(c).rlike(pattern), F.lit(False))
