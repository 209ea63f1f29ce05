"""Periodic runs, spelling variants and sharding: against brute force, and edge cases."""

from __future__ import annotations

import random

import brute_llm as plain
import numpy as np
import pytest
from pyspark.sql import functions as F

from dialogprep.llm import runs, shards, variants

DOCS = "doc_id long, text string, row long, id string, runs long, shard string, slot long, word int, n int"


def doc_rows(texts):
    return [(i, t, 7, "x", 1, "s", 2, 3, 4) for i, t in enumerate(texts)]


def solved(words, min_words=12, **more):
    return [tuple(map(int, x)) for x in zip(*runs.solve(np.array(words, dtype=np.int64), runs.spacings(len(words), min_words), min_words, **more), strict=True)]


def as_runs(found, min_words):
    least = {}
    for q, start, end in found:
        if end - start >= max(min_words - q, q):
            key = (start, end - start + q)
            least[key] = min(q, least.get(key, q))
    return sorted((*key, q) for key, q in least.items())


@pytest.mark.parametrize("min_words", [2, 3, 5, 8, 12, 31])
def test_solve_equals_brute_force(min_words):
    rng = random.Random(min_words)
    for _ in range(150):
        words = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randrange(1, 90))]
        if rng.random() < 0.5:
            part = words[: rng.randrange(1, len(words) + 1)]
            words = words + part * rng.randrange(1, 6) + part[: len(part) // 2]
        assert as_runs(solved(words, min_words), min_words) == plain.all_runs(words, min_words)


def test_z_function():
    assert runs.z_function([1, 1, 2, 1, 1, 2, 1]) == [0, 1, 0, 4, 1, 0, 1]
    assert runs.z_function([]) == []


def periodic_texts():
    rng = random.Random(3)
    word = lambda k: f"w{rng.randrange(k)}"
    texts = [None, "", " \t ", "a", "a " * 11, "a " * 12, "a b " * 6, "é é " * 9, "a b " * 12]
    for period in (1, 3, 7, 8, 40, 300, 700):
        block = [word(10_000) for _ in range(period)]
        texts.append(" ".join([word(9) for _ in range(rng.randrange(50))] + block * 4 + block[: period // 2] + [word(9) for _ in range(50)]))
    texts.append(" ".join(word(2) for _ in range(1500)))
    return texts


@pytest.mark.parametrize("span", [64, 256, 1 << 13])
def test_runs_of_dealt_documents(spark, monkeypatch, span):
    """Documents longer than SPAN go through groups of tiles in other tasks; the result is the same."""
    monkeypatch.setattr(runs, "SPAN", span)
    texts = periodic_texts()
    docs = spark.createDataFrame(doc_rows(texts) + doc_rows(texts)[-3:] + [(None, "a " * 30, *[None] * 7)], DOCS).repartition(3)
    # the tasks cut by the span of this process
    short, explode = runs._solve_short, runs._explode
    with_span = lambda f: lambda *a: (setattr(runs, "SPAN", span), f(*a))[1]
    monkeypatch.setattr(runs, "_solve_short", with_span(short))
    monkeypatch.setattr(runs, "_explode", with_span(explode))
    found = runs.find_runs(docs)
    assert found.columns == ["doc_id", "text", "row", "id", "shard", "slot", "word", "n", "runs"]
    got = found.withColumn("kept", runs.collapsed()).collect()
    assert len(got) == len(texts) + 4
    for r in got:
        words = plain.cut_words(r.text)
        want = plain.all_runs(words)
        assert [tuple(x) for x in r.runs] == want
        lost = {i for s, length, q in want for i in range(s + q, s + length)}
        assert r.kept == " ".join(w for i, w in enumerate(words) if i not in lost)


def test_runs_of_a_very_long_text(spark):
    """A million words: a run across all groups of tiles, one in its middle and one of a third of the text."""
    rng = np.random.default_rng(1)
    block = [f"w{x}" for x in rng.integers(0, 1 << 30, 100_000)]
    words = ["a", "b", "c"] * 60_000 + block * 3 + block[:5] + [f"v{x}" for x in rng.integers(0, 1 << 30, 200_000)] + ["z"] * 70_000
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    got = [tuple(r) for r in runs.find_runs(docs).first().runs]
    assert got == [(0, 180_000, 3), (180_000, 300_005, 100_000), (680_005, 70_000, 1)]


def test_stitch_joins_fragments_that_meet(spark):
    parts = [(1, 2, 0, 6), (1, 2, 6, 12), (1, 2, 14, 20), (1, 4, 0, 10), (2, 2, 3, 13), (1, 2, 0, 6)]
    docs = spark.createDataFrame(parts, "id long, period long, start long, end long")
    got = sorted(tuple(r) for r in runs.stitch(docs, 12).collect())
    assert got == [(1, 0, 14, 2), (2, 3, 12, 2)]


def test_words_are_counted_whole(spark):
    texts = [None, "", "Apple apple APPLE äpple_ÄPPLE x", "apple" * 20_000 + " apple", "éÉ naïve naïve naïve ab1cd"]
    docs = spark.createDataFrame([*doc_rows(texts), (None, "apple apple", *[None] * 7), (0, "apple", *[None] * 7), (0, "apple", *[None] * 7)], DOCS)
    got = {r.word: r.n for r in variants.count_words(docs, min_count=1).collect()}
    assert got == {"apple": 8, "äpple": 1, "Äpple": 1, "apple" * 20_000: 1, "naïve": 3}
    assert {r.word: r.n for r in variants.count_words(docs).collect()} == {"apple": 8, "naïve": 3}


@pytest.mark.parametrize("block", [3, 1024])
def test_variants_equal_brute_force(spark, block):
    rng = random.Random(block)
    counts = {}
    for _ in range(1500):
        word = "".join(rng.choices("abcé", k=rng.randrange(1, 8)))
        counts[word] = rng.randrange(1, 40)
    stem = "long" * 40
    counts |= {stem: 100, stem[1:]: 20, stem[2:]: 4, stem + "s": 9, stem[:-1] + "é": 3, stem[:80] + stem[81:]: 50}
    words = spark.createDataFrame([(w, n, 5) for w, n in counts.items()], "word string, n long, form int").repartition(3)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.spelling_variants(words, block=block).collect()}
    assert got == plain.variants_of(counts)


def test_a_chain_of_forms_ends_at_its_root(spark):
    chain = [("x" * (k + 1), 2**k) for k in range(12)]
    got = variants.spelling_variants(spark.createDataFrame(chain, "word string, n long")).collect()
    assert {r.root for r in got} == {"x" * 12} and sum(r.form is None for r in got) == 1


def shard_texts():
    rng = random.Random(4)
    return [None, "", "é" * 10, *["copy"] * 40, *["w" * rng.randrange(400) for _ in range(120)], "long " * 40_000]


def laid(placed):
    return {(r.shard, r.slot): r.doc_id for r in placed.collect()}


def test_shards_are_random_whole_and_the_same_again(spark, tmp_path):
    docs = spark.createDataFrame(doc_rows(shard_texts()), DOCS).repartition(4)
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    placed = shards.shard(docs, 7, bucket_bytes=4_000)
    assert placed.columns == ["doc_id", "text", "row", "id", "runs", "word", "n", "shard", "slot"]
    first = laid(placed)
    assert sorted(first.values()) == list(range(164))
    sizes = [sum(s == i for s, _ in first) for i in range(7)]
    assert max(sizes) - min(sizes) <= 1 and set(first) == {(s, i) for s in range(7) for i in range(sizes[s])}
    assert laid(shards.shard(docs, 7, bucket_bytes=4_000)) == first
    assert laid(shards.shard(docs, 7, seed=1, bucket_bytes=4_000)) != first
    order = [first[k] for k in sorted(first)]
    assert sum(a < b for a, b in zip(order, order[1:], strict=False)) in range(60, 105)  # neither sorted nor reversed
    shards.write_shards(docs, f"{tmp_path}/out", 7, bucket_bytes=4_000)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert laid(back) == first and back.where("shard = 3").select("text").count() == sizes[3]


def test_shards_of_every_bucket_are_mixed(spark):
    """Ids in order in one bucket: each place is as likely as any other."""
    spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    docs = spark.range(0, 3000, 1, 3).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    got = shards.shard(docs, 3).groupBy("shard").agg(F.avg("doc_id").alias("mean"), F.count("*").alias("n")).collect()
    assert {r.n for r in got} == {1000} and all(abs(r.mean - 1499.5) < 150 for r in got)


def test_repeated_rows_and_null_ids_are_dealt_like_others(spark):
    rows = [(None, "same")] * 500 + [(5, "same")] * 500
    placed = shards.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 4, bucket_bytes=500)
    got = placed.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("slots"), F.max("slot").alias("last"), F.count("doc_id").alias("fives"))
    assert [(r.n, r.slots, r.last) for r in got.collect()] == [(250, 250, 249)] * 4
    assert all(80 <= r.fives <= 170 for r in got.collect())


def test_offsets_of_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(shards, "GROUP", 3)
    monkeypatch.setattr(shards, "SENT_BUCKETS", 0)
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("12345678").alias("text"))
    got = laid(shards.shard(docs, 5, bucket_bytes=100))
    assert set(got) == {(s, i) for s in range(5) for i in range(80)} and sorted(got.values()) == list(range(400))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    assert runs.find_runs(docs).withColumn("kept", runs.collapsed()).count() == 0
    assert variants.spelling_variants(variants.count_words(docs)).count() == 0
    assert shards.shard(docs).count() == 0


def test_fewer_rows_than_shards(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    got = shards.shard(docs, 16).collect()
    assert len({r.shard for r in got}) == 2 and {r.slot for r in got} == {0}
