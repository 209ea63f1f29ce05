"""How big a training run is: steps, lengths, batches, packing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.config import (
    DEVICE_BATCH,
    DRY_RUN_MAX_UNITS,
    TRAIN_BATCH,
    TRAIN_EPOCHS,
    TRAIN_MAX_UNITS,
    WARMUP_SHARE,
    PrepareConfig,
)
from dialogprep.functions.columns import as_long, let
from dialogprep.functions.text import units
from dialogprep.operators.split import shuffle_position

# The template adds to each message: opener, role, newline, closer, newline.
MESSAGE_OVERHEAD = 5

# Conversations packed by one task in one go.
PACK_SHARD = 1024

SEED = PrepareConfig().seed


def conversation_units(messages: Column, count: Callable[[Column], Column] = units) -> Column:
    """Units of the rendered conversation, each marker counted as one."""
    return F.aggregate(
        messages,
        F.lit(1).cast("bigint"),
        lambda acc, m: as_long(acc + count(m["content"]) + MESSAGE_OVERHEAD),
    )


def with_units(convs: DataFrame, count: Callable[[Column], Column] = units) -> DataFrame:
    """``(conv_id, n_units)``, the parts of a conversation added up; it opens once."""
    again = F.when(F.col("part") > 0, 1).otherwise(0) if "part" in convs.columns else F.lit(0)
    return (
        convs.select("conv_id", (conversation_units(F.col("messages"), count) - again).alias("n_units"))
        .groupBy("conv_id")
        .agg(as_long(F.sum("n_units")).alias("n_units"))
    )


def train_plan(
    train: DataFrame,
    batch: int = TRAIN_BATCH,
    epochs: int = TRAIN_EPOCHS,
    warmup: float = WARMUP_SHARE,
) -> DataFrame:
    """Optimizer steps and warm-up of a run over ``train``, one row.

    Halves round to even in the warm-up.
    """
    steps = F.ceil(F.col("examples") / batch).cast("bigint")
    warm = F.bround(F.lit(float(warmup)) * F.col("steps_per_epoch") * F.lit(epochs), 0)
    return (
        train.agg(F.count(F.lit(1)).alias("examples"))
        .withColumn("steps_per_epoch", steps)
        .withColumn("total_steps", as_long(F.col("steps_per_epoch") * epochs))
        .withColumn("warmup_steps", F.greatest(F.lit(1), warm.cast("bigint")).cast("bigint"))
    )


def length_profile(
    lengths: DataFrame,
    caps: Sequence[int] = (DRY_RUN_MAX_UNITS, TRAIN_MAX_UNITS),
    exact: bool = True,
) -> DataFrame:
    """Length quantiles, and per cap how many conversations and units it cuts.

    Exact quantiles keep a count per distinct length, which the longest
    conversation bounds; ``exact=False`` uses a sketch.
    """
    n = F.col("n_units")
    quantile = F.percentile if exact else F.percentile_approx
    aggs = [
        F.count(F.lit(1)).alias("conversations"),
        as_long(F.sum(n)).alias("units"),
        *[quantile(n, q).cast("double").alias(f"p{int(q * 100)}") for q in (0.5, 0.9, 0.99)],
        F.max(n).alias("longest"),
    ]
    for cap in caps:
        aggs.append(F.count_if(n > cap).alias(f"over_{cap}"))
        aggs.append(as_long(F.sum(F.greatest(n - cap, F.lit(0)))).alias(f"lost_{cap}"))
    return lengths.agg(*aggs)


def batch_plan(lengths: DataFrame, size: int = DEVICE_BATCH, seed: int = SEED) -> DataFrame:
    """Padding waste of each batch of the shuffled conversations.

    Batches follow the exact seeded order, as a loader would cut them.
    """
    n = F.col("n_units")
    return (
        shuffle_position(lengths, seed)
        .groupBy(as_long(F.floor(F.col("pos") / size)).alias("batch"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.max(n).alias("longest"),
            as_long(F.sum(n)).alias("units"),
            as_long(F.max(n) * F.count(F.lit(1)) - F.sum(n)).alias("padding"),
        )
    )


def _next_fit(sizes: Column, budget: int) -> Column:
    """Bin number of each size: a new bin whenever the next does not fit."""
    kind = "struct<bin:bigint,used:bigint,bins:array<bigint>>"

    def place(acc: Column, n: Column) -> Column:
        return let(
            (acc["bin"] < 0) | (acc["used"] + n > budget),
            lambda opens: let(
                acc["bin"] + F.when(opens, 1).otherwise(0),
                lambda b: F.struct(
                    as_long(b).alias("bin"),
                    as_long(F.when(opens, n).otherwise(acc["used"] + n)).alias("used"),
                    F.array_append(acc["bins"], as_long(b)).alias("bins"),
                ),
            ),
        ).cast(kind)

    zero = F.struct(
        F.lit(-1).cast("bigint").alias("bin"),
        F.lit(0).cast("bigint").alias("used"),
        F.array().cast("array<bigint>").alias("bins"),
    ).cast(kind)
    return F.aggregate(sizes, zero, place, lambda acc: acc["bins"])


def pack_sequences(
    lengths: DataFrame,
    budget: int = TRAIN_MAX_UNITS,
    shard: int = PACK_SHARD,
    seed: int = SEED,
) -> DataFrame:
    """``(conv_id, n_units, shard, bin)``: whole conversations in fixed budgets.

    The seeded order is cut into shards of equal size and each is filled next-fit.
    A conversation above the budget has a bin to itself.
    """
    rows = shuffle_position(lengths, seed).select(
        as_long(F.floor(F.col("pos") / shard)).alias("shard"), F.struct("pos", "conv_id", "n_units").alias("row")
    )
    members = rows.groupBy("shard").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    packed = members.select(
        "shard",
        "rows",
        _next_fit(F.transform("rows", lambda r: r["n_units"]), budget).alias("bins"),
    )
    # Outer, so that no inferred filter on the array packs everything again.
    return packed.select("shard", F.inline_outer(F.arrays_zip("rows", "bins"))).select(
        "rows.conv_id", "rows.n_units", "shard", F.col("bins").alias("bin")
    )


# Conversations that one task packs best-fit.
BEST_FIT_SHARD = 16_384


def best_fit(budget: int) -> Callable[[Sequence[int]], list[int]]:
    """Gives the bin number of each size, in the order of the sizes: the fullest bin that holds it, else a new one.

    All it uses is local, so workers need no copy of this package.
    """
    from heapq import heappop, heappush

    leaves = 1 << budget.bit_length()

    class RoomTree:
        """Open bins by the room that is left in them: a segment tree over rooms counts the bins below each node."""

        def __init__(self) -> None:
            self.counts = [0] * (2 * leaves)
            self.bins: dict[int, list[int]] = {}

        def put(self, room: int, number: int) -> None:
            heappush(self.bins.setdefault(room, []), number)
            self.add(room, 1)

        def take(self, size: int) -> tuple[int, int] | None:
            """(room, bin) with the least room that holds ``size``, of several the first bin; it leaves the tree."""
            at = size + leaves
            while self.counts[at] == 0:
                # what lies to the right of this node: its sibling, or that of the first node above that is a left child
                while at & 1:
                    at >>= 1
                if at <= 1:
                    return None
                at += 1
            while at < leaves:
                at = 2 * at if self.counts[2 * at] else 2 * at + 1
            self.add(at - leaves, -1)
            return at - leaves, heappop(self.bins[at - leaves])

        def add(self, room: int, n: int) -> None:
            at = room + leaves
            while at:
                self.counts[at] += n
                at >>= 1

    def fit(sizes: Sequence[int]) -> list[int]:
        tree, out, opened = RoomTree(), [], 0
        for size in sizes:
            found = tree.take(size) if size <= budget else None
            room, number = found if found else (budget, opened)
            opened += found is None
            out.append(number)
            if room > size:
                tree.put(room - size, number)
        return out

    return fit


def pack_best_fit(
    lengths: DataFrame,
    budget: int = TRAIN_MAX_UNITS,
    shard: int = BEST_FIT_SHARD,
    seed: int = SEED,
) -> DataFrame:
    """``pack_sequences`` by best-fit-decreasing: less waste, for a longer look at each shard.

    The seeded order is cut into shards. In each, conversations are taken from
    the longest to the shortest (ties by place) and go to the bin with the least room that holds
    them. A conversation above the budget has a bin to itself.
    """

    fit = best_fit(budget)

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_units", "pos"], ascending=[False, True])
        return rows.assign(bin=fit(rows["n_units"].tolist()))[["conv_id", "n_units", "shard", "bin"]]

    rows = shuffle_position(lengths.select("conv_id", "n_units"), seed)
    rows = rows.withColumn("shard", as_long(F.floor(F.col("pos") / shard)))
    kind = lengths.schema["conv_id"].dataType.simpleString()
    return rows.groupBy("shard").applyInPandas(pack, f"conv_id {kind}, n_units bigint, shard bigint, bin bigint")


# --- Profiles that are stored and merged -----------------------------------

# Rank error of a sketch of this size: about 1.65 %, with 99 % confidence.
SKETCH_K = 200


def length_sketches(lengths: DataFrame, by: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """Per group a sketch of the lengths, of bounded size, to be stored and merged: a day's table is not read again."""
    n = F.col("n_units")
    return lengths.groupBy(*by).agg(
        F.count(F.lit(1)).alias("conversations"),
        as_long(F.sum(n)).alias("units"),
        F.max(n).alias("longest"),
        F.kll_sketch_agg_bigint(as_long(n), F.lit(k)).alias("sketch"),
    )


def merged_profile(sketches: DataFrame, by: Sequence[str] = (), quantiles: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """``length_profile`` of any union of groups, from their sketches alone; quantiles are within the sketch's rank error."""
    merged = sketches.groupBy(*by).agg(
        as_long(F.sum("conversations")).alias("conversations"),
        as_long(F.sum("units")).alias("units"),
        F.kll_merge_agg_bigint("sketch").alias("sketch"),
        F.max("longest").alias("longest"),
    )
    points = [F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(q))).alias(f"p{int(q * 100)}") for q in quantiles]
    return merged.select(*by, "conversations", "units", *points, "longest")
