"""From raw dialogues to role-tagged conversations.

Two inputs, one result. *Dialogues* hold a conversation per row, as the corpora
this is made for are delivered; everything happens inside the row and nothing is
shuffled. *Turns* hold a turn per row and need one exchange on the conversation.

The result is ``(conv_id, part, messages)``. ``part`` is 0 unless a conversation
has more than ``PrepareConfig.part_messages`` messages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from dialogprep.config import ROLE_MODEL, ROLE_USER, PrepareConfig
from dialogprep.functions.columns import as_long, let
from dialogprep.functions.text import clean_utterance, in_length_band
from dialogprep.operators.ordered import (
    BLOCK,
    carry,
    dense_index,
    has_long_groups,
    of_long_keys,
    total_before,
    with_block,
)

DEFAULT = PrepareConfig()
Cleaner = Callable[[Column], Column]


def role_at(index: Column) -> Column:
    """Even positions ask, odd positions reply."""
    return F.when(index % 2 == 0, ROLE_USER).otherwise(ROLE_MODEL)


def even(k: Column) -> Column:
    """Length without a trailing user turn."""
    return k - k % 2


# --- Dialogues: one conversation per row ----------------------------------


def _first_position(flags: Column) -> Column:
    """0-based position of the first true element, null if there is none."""
    at = F.array_position(flags, True)
    return F.when(at > 0, at - 1)


def _kept_parts(turns: Column, cfg: PrepareConfig) -> Column:
    """``ARRAY<ARRAY<STRUCT<role, content>>>`` of cleaned turns, null for a rejected conversation."""
    size = cfg.part_messages

    def build(kept: Column) -> Column:
        def part(start: Column) -> Column:
            inside = F.slice(turns, start + 1, F.least(F.lit(size), kept - start))
            return F.transform(
                inside,
                lambda text, i: F.struct(role_at(i).alias("role"), text.alias("content")),
            )

        starts = F.sequence(F.lit(0), kept - 1, F.lit(size))
        return F.when(kept >= cfg.min_kept, F.transform(starts, part))

    bad = F.transform(turns, lambda t: ~in_length_band(F.length(t), cfg.min_chars, cfg.max_chars))
    return let(even(F.coalesce(_first_position(bad), F.size(turns))).cast("int"), build)


def _turn_stats(lengths: Column, cfg: PrepareConfig) -> Column:
    """What ``dialog_stats`` tells, from the lengths of the turns."""
    bad = F.transform(lengths, lambda n: ~in_length_band(n, cfg.min_chars, cfg.max_chars))
    return let(
        _first_position(bad),
        lambda at: F.struct(
            as_long(F.size(lengths)).alias("n_turns"),
            as_long(F.coalesce(at, F.size(lengths))).alias("prefix"),
            at.isNotNull().alias("cut"),
            as_long(F.get(lengths, at.cast("int"))).alias("cut_length"),
        ),
    )


def _cleaned(clean: Cleaner) -> Column:
    """The turns of a dialogue after cleaning; a null dialogue has none."""
    return F.transform(F.coalesce("dialog", F.array().cast("array<string>")), lambda t: clean(t))


def prepare_dialogs(
    dialogs: DataFrame, cfg: PrepareConfig = DEFAULT, clean: Cleaner = clean_utterance, funnel: Observation | None = None
) -> DataFrame:
    """``(conv_id, dialog)`` to ``(conv_id, part, messages)``, batch or stream.

    The generator is what keeps the regexes single: a filter on a plain
    projection would be pushed below it and evaluate them again. ``funnel`` gets
    the sums of ``filter_funnel`` while the result is written (``observed_funnel``).
    """
    if funnel is None:
        parts = let(_cleaned(clean), lambda turns: _kept_parts(turns, cfg))
        rows = dialogs.select("conv_id", F.posexplode_outer(parts).alias("part", "messages"))
    else:

        def both(turns: Column) -> Column:
            stats = let(F.transform(turns, F.length), lambda n: _turn_stats(n, cfg))
            return F.struct(stats.alias("stats"), _kept_parts(turns, cfg).alias("parts"))

        seen = dialogs.select("conv_id", F.inline_outer(F.array(let(_cleaned(clean), both)))).select("conv_id", "stats.*", "parts")
        seen = seen.observe(funnel, *_funnel_sums(_lost_turns(cfg)))
        rows = seen.select("conv_id", F.posexplode_outer("parts").alias("part", "messages"))
    return rows.where(F.col("messages").isNotNull())


def dialog_stats(dialogs: DataFrame, cfg: PrepareConfig = DEFAULT) -> DataFrame:
    """Per conversation: turns, valid prefix, length of the turn that ended it."""
    lengths = F.transform(_cleaned(clean_utterance), F.length)
    return dialogs.select("conv_id", F.inline_outer(F.array(let(lengths, lambda n: _turn_stats(n, cfg)))))


# --- Turns: one turn per row ----------------------------------------------


def dialog_turns(turns: DataFrame) -> DataFrame:
    """Drop system rows; they belong to neither speaker."""
    return turns.where((F.col("role") != "system") | F.col("role").isNull()).select("conv_id", "turn", "text")


def prepare_turns(
    turns: DataFrame, cfg: PrepareConfig = DEFAULT, clean: Cleaner = clean_utterance, funnel: Observation | None = None
) -> DataFrame:
    """``(conv_id, turn, role, text)`` to kept ``(conv_id, i, role, content)``.

    Roles come from the position after system rows are dropped. The exchange
    stands before the regexes, so that they run on all cores, and serves the
    windows as well. Rows of a null ``conv_id`` are one conversation. ``funnel``
    is filled as in ``prepare_dialogs``.
    """
    turns = dialog_turns(turns)
    long = has_long_groups(turns.select("conv_id", "turn"), "conv_id", "turn", cfg.block_rows)
    group = ["conv_id", BLOCK] if long else ["conv_id"]
    if long:
        turns = with_block(turns, "conv_id", "turn", cfg.block_rows)
    in_order = Window.partitionBy(*group).orderBy("turn")
    whole = Window.partitionBy(*group)

    def checked(part: DataFrame) -> DataFrame:
        """Cleaned turns with their place in the group and, if invalid, that place again."""
        valid = in_length_band(F.length("content"), cfg.min_chars, cfg.max_chars)
        return (
            part.repartition(*group)
            .withColumn("content", clean(F.col("text")))
            .withColumn("at", as_long(F.row_number().over(in_order) - 1))
            .withColumn("bad_at", F.when(~valid, F.col("at")))
        )

    rows = checked(turns).withColumns(
        {"i": F.col("at"), "n_turns": F.count(F.lit(1)).over(whole), "first_bad": F.min("bad_at").over(whole)}
    )
    if long:
        # Conversations that are cut take these from a summary of their blocks.
        blocks = (
            checked(of_long_keys(turns))
            .groupBy(*group)
            .agg(F.count(F.lit(1)).alias("n"), F.min("bad_at").alias("bad"))
            .withColumn("offset", total_before("n", "conv_id"))
        )
        conv = Window.partitionBy("conv_id")
        blocks = blocks.select(
            *group,
            "offset",
            F.min(F.col("offset") + F.col("bad")).over(conv).alias("long_bad"),
            F.sum("n").over(conv).alias("long_n"),
        )
        cut = F.col("offset").isNotNull()
        rows = carry(rows, blocks, group).withColumns(
            {
                "i": F.col("at") + F.coalesce("offset", F.lit(0)),
                "n_turns": F.coalesce("long_n", "n_turns"),
                "first_bad": F.when(cut, F.col("long_bad")).otherwise(F.col("first_bad")),
            }
        )
    rows = rows.withColumn("prefix", F.coalesce("first_bad", "n_turns"))
    if funnel is not None:
        # a conversation is told by its first row, and by the row that ends it
        per_row = _lost_turns(cfg, opens=F.col("i") == 0, cuts=F.col("i") == F.col("first_bad"), length=F.length("content"))
        rows = rows.observe(funnel, *_funnel_sums(per_row))
    kept = even(F.col("prefix"))
    return rows.where((kept >= cfg.min_kept) & (F.col("i") < kept)).select(
        "conv_id", "i", role_at(F.col("i")).alias("role"), "content"
    )


def gather_messages(rows: DataFrame, cfg: PrepareConfig = DEFAULT) -> DataFrame:
    """``(conv_id, i, role, content)`` to conversation rows.

    A group is a part of at most ``part_messages`` turns, each within the length
    band. By default that is a whole conversation, however long; set it lower to
    bound the rows.
    """
    messages = F.transform(
        F.sort_array(F.collect_list(F.struct("i", "role", "content"))),
        lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")),
    )
    part = F.floor(F.col("i") / cfg.part_messages).cast("int")
    return (
        rows.withColumn("part", part)
        .groupBy("conv_id", "part")
        .agg(messages.alias("messages"))
    )


def explode_messages(convs: DataFrame, cfg: PrepareConfig = DEFAULT) -> DataFrame:
    """Conversation rows back to one row per message."""
    return convs.select(
        "conv_id", "part", F.posexplode("messages").alias("at", "m")
    ).select(
        "conv_id",
        as_long(F.col("part") * cfg.part_messages + F.col("at")).alias("i"),
        F.col("m.role").alias("role"),
        F.col("m.content").alias("content"),
    )


def turn_stats(turns: DataFrame, cfg: PrepareConfig = DEFAULT) -> DataFrame:
    """``dialog_stats`` for a turn table: one aggregation with partial combine."""
    indexed = dense_index(dialog_turns(turns), "conv_id", "turn", cfg.block_rows)
    length = F.length(clean_utterance(F.col("text")))
    bad = ~in_length_band(F.col("length"), cfg.min_chars, cfg.max_chars)
    first_bad = F.min(F.when(bad, F.struct("i", "length")))
    return (
        indexed.withColumn("length", length)
        .groupBy("conv_id")
        .agg(F.count(F.lit(1)).alias("n_turns"), first_bad.alias("bad"))
        .select(
            "conv_id",
            "n_turns",
            as_long(F.coalesce(F.col("bad.i"), F.col("n_turns"))).alias("prefix"),
            F.col("bad").isNotNull().alias("cut"),
            as_long(F.col("bad.length")).alias("cut_length"),
        )
    )


# --- What was lost, and why -----------------------------------------------

FUNNEL_REASONS = ("kept", "too_short", "too_long", "after_cut", "under_min_turns", "trailing_user")


def _lost_turns(
    cfg: PrepareConfig, opens: Column | None = None, cuts: Column | None = None, length: Column | None = None
) -> dict[str, Column]:
    """Turns by reason, of a row of stats or, if ``opens`` and ``cuts`` tell which rows speak, of turn rows."""
    opens = F.lit(True) if opens is None else opens
    cuts = F.col("cut") if cuts is None else cuts
    length = F.col("cut_length") if length is None else length
    prefix, n = F.col("prefix"), F.col("n_turns")
    kept = even(prefix) >= cfg.min_kept
    too_long = F.coalesce(length > cfg.max_chars, F.lit(False))
    return {
        "kept": F.when(opens & kept, even(prefix)),
        "too_short": F.when(cuts & ~too_long, 1),
        "too_long": F.when(cuts & too_long, 1),
        "after_cut": F.when(cuts, F.nullif(n - prefix - 1, F.lit(0))),
        "under_min_turns": F.when(opens & ~kept, prefix),
        "trailing_user": F.when(opens & kept, F.nullif(prefix % 2, F.lit(0))),
    }


def _funnel_sums(turns: dict[str, Column]) -> list[Column]:
    counts = [F.count(turns[r]).alias(f"{r}_conversations") for r in FUNNEL_REASONS]
    return counts + [as_long(F.coalesce(F.sum(turns[r]), F.lit(0))).alias(f"{r}_turns") for r in FUNNEL_REASONS]


def observed_funnel(funnel: Observation) -> list[tuple[str, int, int]]:
    """``(reason, conversations, turns)`` as ``filter_funnel`` has them, once the observed frame is written."""
    found = funnel.get
    return [(r, found[f"{r}_conversations"], found[f"{r}_turns"]) for r in FUNNEL_REASONS]


def filter_funnel(stats: DataFrame, cfg: PrepareConfig = DEFAULT) -> DataFrame:
    """``(reason, conversations, turns)``; the turns add up to all turns read.

    ``too_short`` and ``too_long`` count the turn that ended a conversation,
    ``after_cut`` what followed it, ``under_min_turns`` the valid prefix of a
    rejected conversation.
    """
    reasons = [
        F.struct(
            F.lit(r).alias("reason"),
            F.col(f"{r}_conversations").alias("conversations"),
            F.col(f"{r}_turns").alias("turns"),
        )
        for r in FUNNEL_REASONS
    ]
    return stats.agg(*_funnel_sums(_lost_turns(cfg))).select(F.inline(F.array(*reasons)))


def _band_columns(bands: list[tuple[int, int]]) -> list[str]:
    return [f"prefix_{b}" for b in range(len(bands))]


def dialog_band_prefixes(dialogs: DataFrame, bands: list[tuple[int, int]]) -> DataFrame:
    """Valid prefix of each conversation under each length band, cleaning once."""

    def prefix(lengths: Column, lo: int, hi: int) -> Column:
        bad = F.transform(lengths, lambda n: ~in_length_band(n, lo, hi))
        return as_long(F.coalesce(_first_position(bad), F.size(lengths)))

    def prefixes(lengths: Column) -> Column:
        named = zip(_band_columns(bands), bands)
        return F.struct(*[prefix(lengths, lo, hi).alias(name) for name, (lo, hi) in named])

    lengths = F.transform(F.coalesce("dialog", F.array().cast("array<string>")), lambda t: F.length(clean_utterance(t)))
    return dialogs.select("conv_id", F.inline_outer(F.array(let(lengths, prefixes))))


def turn_band_prefixes(
    turns: DataFrame, bands: list[tuple[int, int]], cfg: PrepareConfig = DEFAULT
) -> DataFrame:
    indexed = dense_index(dialog_turns(turns), "conv_id", "turn", cfg.block_rows)
    length = F.length(clean_utterance(F.col("text")))
    return (
        indexed.withColumn("length", length)
        .groupBy("conv_id")
        .agg(
            *[
                F.coalesce(
                    F.min(F.when(~in_length_band(F.col("length"), lo, hi), F.col("i"))),
                    F.count(F.lit(1)),
                ).alias(name)
                for name, (lo, hi) in zip(_band_columns(bands), bands)
            ]
        )
    )


def length_band_sweep(
    prefixes: DataFrame, bands: list[tuple[int, int]], cfg: PrepareConfig = DEFAULT
) -> DataFrame:
    """Kept conversations and messages per band, in one pass.

    The bands become columns, not rows: the data is not multiplied by the grid.
    """
    names = _band_columns(bands)
    sums = []
    for name, (lo, hi) in zip(names, bands):
        kept = F.when(even(F.col(name)) >= cfg.min_kept, even(F.col(name)))
        sums.append(
            F.struct(
                F.lit(lo).cast("bigint").alias("min_chars"),
                F.lit(hi).cast("bigint").alias("max_chars"),
                F.count(kept).alias("conversations"),
                as_long(F.coalesce(F.sum(kept), F.lit(0))).alias("messages"),
            ).alias(name)
        )
    return prefixes.agg(*sums).select(F.inline(F.array(*[F.col(n) for n in names])))


# --- A grid of bands that is a table ---------------------------------------

_ANY = (1 << 31) - 1  # longer than any band allows


def dialog_staircases(dialogs: DataFrame, cfg: PrepareConfig = DEFAULT) -> DataFrame:
    """``(shortest, longest, conversations, messages)``: what a band gains once it holds these two lengths.

    Of a conversation's first two, four, six ... turns, the shortest and the longest make a staircase: a band keeps
    the steps it holds. It has few steps, since each is a new extreme. The first step that is long enough brings the
    conversation, each further pair two messages.
    """
    first = -(-cfg.min_kept // 2)  # the pair of turns that makes a conversation long enough

    def gains(begin: Column, end: Column) -> list[Column]:
        """Of the pairs from ``begin`` to ``end``, counted from 1."""
        brings = (begin <= first) & (end >= first)
        more = F.greatest(end - F.greatest(begin - 1, F.lit(first)), F.lit(0))
        return [
            F.when(brings, 1).otherwise(0).cast("bigint").alias("conversations"),
            as_long(2 * more + F.when(brings, 2 * first).otherwise(0)).alias("messages"),
        ]

    def steps(lengths: Column) -> Column:
        kind = "struct<low:int,high:int,since:int,at:int,out:array<struct<shortest:int,longest:int,begin:int,end:int>>>"
        known = lambda i, other: F.coalesce(F.get(lengths, i), F.lit(other))
        pairs = F.when(
            F.size(lengths) >= 2,
            F.transform(
                F.sequence(F.lit(0), F.floor(F.size(lengths) / 2).cast("int") - 1),
                lambda j: F.struct(
                    F.least(known(2 * j, -1), known(2 * j + 1, -1)).alias("low"),
                    F.greatest(known(2 * j, _ANY), known(2 * j + 1, _ANY)).alias("high"),
                ),
            ),
        ).otherwise(F.array().cast("array<struct<low:int,high:int>>"))

        def close(acc: Column) -> Column:
            step = F.struct(acc["low"].alias("shortest"), acc["high"].alias("longest"), acc["since"].alias("begin"), acc["at"].alias("end"))
            return F.when(acc["at"] >= acc["since"], F.array_append(acc["out"], step)).otherwise(acc["out"])

        def step(acc: Column, pair: Column) -> Column:
            low, high = F.least(acc["low"], pair["low"]), F.greatest(acc["high"], pair["high"])
            same = (low == acc["low"]) & (high == acc["high"])
            return F.struct(
                low.alias("low"),
                high.alias("high"),
                F.when(same, acc["since"]).otherwise(acc["at"] + 1).alias("since"),
                (acc["at"] + 1).alias("at"),
                F.when(same, acc["out"]).otherwise(close(acc)).alias("out"),
            ).cast(kind)

        none = F.array().cast("array<struct<shortest:int,longest:int,begin:int,end:int>>")
        start = F.struct(
            F.lit(_ANY).alias("low"), F.lit(-1).alias("high"), F.lit(1).alias("since"), F.lit(0).alias("at"), none.alias("out")
        ).cast(kind)
        return F.aggregate(pairs, start, step, close)

    lengths = F.transform(_cleaned(clean_utterance), F.length)
    rows = dialogs.select(F.inline(let(lengths, steps)))
    return rows.select("shortest", "longest", *gains(F.col("begin"), F.col("end")))


def turn_staircases(turns: DataFrame, cfg: PrepareConfig = DEFAULT) -> DataFrame:
    """``dialog_staircases`` for a turn table, a row for each pair of turns; a long conversation is run in blocks."""
    rows = dense_index(dialog_turns(turns), "conv_id", "turn", cfg.block_rows)
    length = F.length(clean_utterance(F.col("text")))
    rows = rows.select("conv_id", "i", length.alias("length")).withColumn(BLOCK, F.floor(F.col("i") / cfg.block_rows))
    rows = rows.withColumns({"low": F.coalesce("length", F.lit(-1)), "high": F.coalesce("length", F.lit(_ANY))})
    group = ["conv_id", BLOCK]
    so_far = Window.partitionBy(*group).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"low": F.min("low").over(so_far), "high": F.max("high").over(so_far)})
    ends = rows.where(F.col("i") % cfg.block_rows == cfg.block_rows - 1).select(*group, "low", "high")
    if not ends.where(F.col(BLOCK) >= 0).limit(1).isEmpty():
        every = Window.partitionBy("conv_id").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, 0)
        ends = ends.select("conv_id", (F.col(BLOCK) + 1).alias(BLOCK), F.min("low").over(every).alias("low_0"), F.max("high").over(every).alias("high_0"))
        rows = carry(rows, ends, group).withColumns({"low": F.least("low", "low_0"), "high": F.greatest("high", "high_0")})
    last = F.col("i") + 1
    brings = last == even(F.lit(cfg.min_kept + 1))
    return rows.where((last % 2 == 0) & (last >= even(F.lit(cfg.min_kept + 1)))).select(
        F.col("low").alias("shortest"),
        F.col("high").alias("longest"),
        F.when(brings, 1).otherwise(0).cast("bigint").alias("conversations"),
        as_long(F.when(brings, last).otherwise(2)).alias("messages"),
    )


def length_band_grid(staircases: DataFrame, bands: DataFrame) -> DataFrame:
    """``(min_chars, max_chars, conversations, messages)`` of each different band of a table, however many there are.

    Steps of staircases are first added up by their two lengths. A band gains those with ``shortest >= min_chars`` and
    ``longest <= max_chars``. The lengths from ``min_chars`` on are few dyadic ranges: each step is counted in the
    ranges that hold its shortest turn, and in each range a running sum over the longest turn meets the bands that
    ask for it. So steps and bands are sorted together once, and no step meets a band.
    """
    grid = bands.select(F.col("min_chars").cast("bigint"), F.col("max_chars").cast("bigint")).distinct()
    asked = grid.where(F.col("min_chars").isNotNull() & F.col("max_chars").isNotNull())
    asked = asked.withColumn("low", F.greatest("min_chars", F.lit(0)))
    top = asked.agg(F.max("low")).first()[0] or 0
    levels = int(top).bit_length()
    sums = staircases.groupBy("shortest", "longest").agg(F.sum("conversations").alias("conversations"), F.sum("messages").alias("messages"))

    def ranges(low: Column, wanted: Callable[[Column, int], Column]) -> Column:
        """(level, number) of a single length at level 0, and of wider ranges where they are wanted."""
        own = F.struct(F.lit(-1).alias("level"), low.alias("number"))
        wider = [F.when(wanted(low, t), F.struct(F.lit(t).alias("level"), F.shiftright(low, t).bitwiseOR(F.lit(1)).cast("bigint").alias("number"))) for t in range(levels)]
        return F.filter(F.array(own, *wider), lambda r: r.isNotNull())

    bit = lambda x, t: F.shiftright(x, t).bitwiseAND(F.lit(1))
    low = F.least(F.col("shortest").cast("bigint"), F.lit(int(top)))
    # a length is in the right half of its range at a level where its bit is 1; a band asks where its bit is 0
    steps = sums.where(F.col("shortest") >= 0).select(
        F.explode(ranges(low, lambda x, t: bit(x, t) == 1)).alias("r"),
        F.col("longest").cast("bigint").alias("high"),
        F.lit(0).alias("asks"),
        "conversations",
        "messages",
    )
    steps = steps.groupBy("r", "high", "asks").agg(F.sum("conversations").alias("conversations"), F.sum("messages").alias("messages"))
    asks = asked.select(
        F.explode(ranges(F.col("low"), lambda x, t: bit(x, t) == 0)).alias("r"),
        F.col("max_chars").alias("high"),
        F.lit(1).alias("asks"),
        F.lit(0).cast("bigint").alias("conversations"),
        F.lit(0).cast("bigint").alias("messages"),
        "min_chars",
        "max_chars",
    )
    nobody = [F.lit(None).cast("bigint").alias(c) for c in ("min_chars", "max_chars")]
    so_far = Window.partitionBy("r").orderBy("high", "asks").rowsBetween(Window.unboundedPreceding, 0)
    told = steps.select("*", *nobody).unionByName(asks).select(
        "asks",
        "min_chars",
        "max_chars",
        F.sum("conversations").over(so_far).alias("conversations"),
        F.sum("messages").over(so_far).alias("messages"),
    )
    told = told.where("asks = 1").groupBy("min_chars", "max_chars")
    found = told.agg(as_long(F.sum("conversations")).alias("conversations"), as_long(F.sum("messages")).alias("messages"))
    none = grid.where(F.col("min_chars").isNull() | F.col("max_chars").isNull())
    zero = F.lit(0).cast("bigint")
    return found.unionByName(none.select("*", zero.alias("conversations"), zero.alias("messages")))
