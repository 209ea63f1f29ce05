import hashlib

import pytest
from pyspark.sql import functions as F

from dialogprep.config import PrepareConfig
from dialogprep.operators import split as S


def conversations(spark, n):
    messages = "array(named_struct('role', 'user', 'content', concat('t', id % 7)))"
    return spark.range(n).selectExpr("id AS conv_id", "0 AS part", f"{messages} AS messages")


def key(i, seed=42):
    return (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i)


@pytest.mark.parametrize("n, want", [(0, 0), (1, 1), (19, 1), (20, 1), (39, 1), (40, 2), (100, 5)])
def test_exact_size(spark, n, want):
    for how in (S.holdout_split, S.fixed_holdout_split):
        got = how(conversations(spark, n))
        assert got.where("split = 'val'").count() == want
        assert got.count() == n


def test_same_as_global_sort(spark):
    n = 3000
    order = sorted(range(n), key=key)
    got = {r.conv_id for r in S.holdout_split(conversations(spark, n)).where("split = 'val'").collect()}
    assert got == set(order[: n // 20])
    placed = {r.conv_id: r.pos for r in S.shuffle_position(conversations(spark, n)).collect()}
    assert [placed[i] for i in order] == list(range(n))
    head = [r.conv_id for r in S.head_slice(conversations(spark, n)).collect()]
    assert head == order[:64]
    assert S.first_row(conversations(spark, n)).first().conv_id == order[0]


def test_independent_of_partitioning(spark):
    df = conversations(spark, 500)
    a = S.holdout_split(df.repartition(7)).where("split = 'val'").select("conv_id")
    b = S.holdout_split(df.coalesce(1)).where("split = 'val'").select("conv_id")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_parts_stay_together(spark):
    df = conversations(spark, 60)
    df = df.unionByName(df.withColumn("part", F.lit(1)))
    got = S.holdout_split(df, PrepareConfig(val_fraction=0.2))
    assert got.groupBy("conv_id").agg(F.count_distinct("split").alias("n")).where("n > 1").isEmpty()
    assert got.where("split = 'val'").count() == 2 * 12


def test_leaks_and_remainder(spark):
    df = S.fixed_holdout_split(conversations(spark, 100))
    assert S.leak_audit(df).where("kind = 'id'").isEmpty()
    by_content = S.leak_audit(df).where("kind = 'content'").collect()
    assert by_content and sum(r.val_rows for r in by_content) == 5
    val = df.where("split = 'val'")
    rest = S.train_minus_val(df, val)
    assert rest.count() == 95 and rest.join(val, "conv_id").isEmpty()
    mixed = df.unionByName(val.withColumn("split", F.lit("train")))
    assert S.leak_audit(mixed).where("kind = 'id'").count() == 5


def test_counts(spark):
    got = S.prepare_counts(spark.range(120), S.fixed_holdout_split(conversations(spark, 100)))
    assert {r.stage: r.conversations for r in got.collect()} == {"loaded": 120, "kept": 100, "train": 95, "val": 5}


def test_hash_share_is_not_biased_and_null_ids_are_refused(spark):
    from dialogprep.functions.hashing import in_hash_share
    from dialogprep.operators.split import shuffle_position

    for share in (0.05, 0.5):
        n = spark.range(400_000).where(in_hash_share(F.col("id"), 42, share)).count()
        assert abs(n / 400_000 - share) < 0.0025
    with pytest.raises(Exception, match="is null"):
        shuffle_position(spark.createDataFrame([(None,), (1,)], "conv_id bigint")).collect()
