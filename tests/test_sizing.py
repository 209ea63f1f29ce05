import math
import random

import pytest
from pyspark.sql import functions as F

from dialogprep.operators import sizing as Z
from dialogprep.operators.split import shuffle_position


@pytest.mark.parametrize("n, steps, warm", [(1, 1, 1), (32, 1, 1), (33, 2, 1), (1600, 50, 4), (3200, 100, 9)])
def test_train_plan(spark, n, steps, warm):
    row = Z.train_plan(spark.range(n)).first()
    assert (row.examples, row.steps_per_epoch, row.total_steps, row.warmup_steps) == (n, steps, 3 * steps, warm)


def test_warmup_rounds_like_python(spark):
    got = spark.range(1, 20001).select(
        "id", F.greatest(F.lit(1), F.bround(F.lit(0.03) * F.col("id") * F.lit(3), 0).cast("bigint")).alias("w")
    )
    assert all(r.w == max(1, round(0.03 * r.id * 3)) for r in got.collect())


@pytest.fixture(scope="module")
def sizes():
    rng = random.Random(5)
    return {i: rng.choice([3, 40, 200, 900, 1500]) for i in range(400)}


@pytest.fixture(scope="module")
def lengths(spark, sizes):
    return spark.createDataFrame(list(sizes.items()), "conv_id bigint, n_units bigint")


def shuffled(lengths):
    return [r.conv_id for r in shuffle_position(lengths).orderBy("pos").collect()]


def test_batches(lengths, sizes):
    order = shuffled(lengths)
    got = {r.batch: r for r in Z.batch_plan(lengths).collect()}
    assert len(got) == 25
    for b, row in got.items():
        group = [sizes[c] for c in order[16 * b : 16 * b + 16]]
        assert row.padding == max(group) * len(group) - sum(group)


@pytest.mark.parametrize("shard", [1024, 64])
def test_packing(lengths, sizes, shard):
    order = shuffled(lengths)
    got = {r.conv_id: (r.shard, r.bin) for r in Z.pack_sequences(lengths, 1024, shard).collect()}
    want = {}
    for at in range(0, len(order), shard):
        bin_no, used = 0, 0
        for n, conv in enumerate(order[at : at + shard]):
            if n and used + sizes[conv] > 1024:
                bin_no, used = bin_no + 1, 0
            used += sizes[conv]
            want[conv] = (at // shard, bin_no)
    assert got == want


def test_profile(lengths, sizes):
    row = Z.length_profile(lengths, caps=(512,)).first()
    values = sorted(sizes.values())
    at = 0.9 * (len(values) - 1)
    lo, hi = values[math.floor(at)], values[math.ceil(at)]
    assert row.p90 == pytest.approx(lo + (hi - lo) * (at - math.floor(at)))
    assert row.over_512 == sum(v > 512 for v in values)
    assert row.lost_512 == sum(max(0, v - 512) for v in values)
    rough = Z.length_profile(lengths, exact=False).first()
    assert rough.longest == row.longest


def test_units_of_parts_and_custom_counter(spark):
    schema = "conv_id bigint, part int, messages array<struct<role:string,content:string>>"
    rows = [(1, 0, [("user", "a b"), ("model", "c.")]), (1, 1, [("user", "d"), ("model", "e")])]
    convs = spark.createDataFrame(rows, schema)
    assert Z.with_units(convs).first().n_units == (1 + 14) + 12
    assert Z.with_units(convs, F.length).first().n_units == (1 + 15) + 12
