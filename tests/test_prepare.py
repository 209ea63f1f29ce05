import random

import pytest
from pyspark.sql import functions as F

import brute
from dialogprep.config import PrepareConfig
from dialogprep.operators import prepare as P

V, X = "valid turn", "x" * 501

CASES = [
    ([], 0),
    ([V], 0),
    ([X, V, V], 0),
    ([V, X, V], 0),
    ([V, V], 2),
    ([V, V, X, V, V], 2),
    ([V, V, V, X, V], 2),
    ([V, V, V, V], 4),
    ([V, V, V, V, V], 4),
    ([V, V, None, V], 2),
]


def as_dialogs(spark, dialogs):
    return spark.createDataFrame(list(enumerate(dialogs)), "conv_id bigint, dialog array<string>")


def as_turns(spark, dialogs, system=()):
    rows = []
    for conv, dialog in enumerate(dialogs):
        shift = 0
        if conv in system:
            rows.append((conv, 0, "system", "be nice"))
            shift = 1
        rows += [(conv, i + shift, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(dialog)]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def expected(dialogs, lo=2, hi=500, least=2):
    return {
        (conv, i, role, text)
        for conv, dialog in enumerate(dialogs)
        for i, (role, text) in enumerate(brute.prepare(dialog, lo, hi, least))
    }


def long_form(df):
    return {tuple(r) for r in df.select("conv_id", "i", "role", "content").collect()}


@pytest.fixture(scope="module")
def dialogs():
    rng = random.Random(11)
    options = [V, "short .", "", None, "y" * 501, "z" * 500, "\U0001f600" * 500, "a", "Well , I ’ m in !"]
    weights = [30, 10, 1, 1, 1, 3, 1, 1, 20]
    made = [rng.choices(options, weights, k=rng.randrange(0, 30)) for _ in range(300)]
    return [d for d, _ in CASES] + made + [[V] * 41, [V] * 16]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_kept_counts(spark, case):
    dialog, want = CASES[case]
    rows = P.prepare_dialogs(as_dialogs(spark, [dialog])).collect()
    assert sum(len(r.messages) for r in rows) == want


def test_dialogs_match_brute_force(spark, dialogs):
    got = P.explode_messages(P.prepare_dialogs(as_dialogs(spark, dialogs)))
    assert long_form(got) == expected(dialogs)


@pytest.mark.parametrize("block_rows", [65536, 7, 1])
def test_turns_match_brute_force(spark, dialogs, block_rows):
    """Small blocks take the path for conversations too long for one window."""
    cfg = PrepareConfig(block_rows=block_rows)
    got = P.prepare_turns(as_turns(spark, dialogs, system={5, 20, 311}), cfg)
    assert long_form(got) == expected(dialogs)


@pytest.mark.parametrize("part", [2, 4, 8])
def test_parts_are_whole_conversations(spark, dialogs, part):
    cfg = PrepareConfig(part_messages=part)
    from_dialogs = P.prepare_dialogs(as_dialogs(spark, dialogs), cfg)
    from_turns = P.gather_messages(P.prepare_turns(as_turns(spark, dialogs), cfg), cfg)
    for convs in (from_dialogs, from_turns):
        assert long_form(P.explode_messages(convs, cfg)) == expected(dialogs)
        for row in convs.collect():
            roles = [m.role for m in row.messages]
            assert len(roles) <= part
            assert roles == ["user", "model"] * (len(roles) // 2)


def test_settings(spark, dialogs):
    cfg = PrepareConfig(min_chars=6, max_chars=100, min_turns=5)
    got = P.explode_messages(P.prepare_dialogs(as_dialogs(spark, dialogs), cfg), cfg)
    assert long_form(got) == expected(dialogs, 6, 100, 5)


def test_length_band_edges(spark):
    texts = ["a", "ab", "c" * 500, "c" * 501, "\U0001f600" * 500, "d" * 250 + " " * 100 + "d" * 249]
    dialogs = [[V, t] for t in texts]
    kept = {r.conv_id for r in P.prepare_dialogs(as_dialogs(spark, dialogs)).collect()}
    assert kept == {1, 2, 4, 5}


def test_funnel_adds_up(spark, dialogs):
    want = {r: 0 for r in P.FUNNEL_REASONS}
    for d in dialogs:
        cleaned = [brute.clean(t) for t in d]
        ok = [c is not None and 2 <= len(c) <= 500 for c in cleaned]
        k = ok.index(False) if False in ok else len(d)
        if k < len(d):
            want["too_long" if cleaned[k] and len(cleaned[k]) > 500 else "too_short"] += 1
            want["after_cut"] += len(d) - k - 1
        if k >= 2:
            want["kept"] += k - k % 2
            want["trailing_user"] += k % 2
        else:
            want["under_min_turns"] += k
    both = [
        P.dialog_stats(as_dialogs(spark, dialogs)),
        P.turn_stats(as_turns(spark, dialogs)),
        P.turn_stats(as_turns(spark, dialogs), PrepareConfig(block_rows=5)),
    ]
    for stats in both:
        got = {r.reason: r.turns for r in P.filter_funnel(stats).collect()}
        assert got == want
    assert sum(want.values()) == sum(len(d) for d in dialogs)


def test_band_sweep(spark, dialogs):
    bands = [(1, 20), (2, 500), (6, 1000)]
    for prefixes in (
        P.dialog_band_prefixes(as_dialogs(spark, dialogs), bands),
        P.turn_band_prefixes(as_turns(spark, dialogs), bands, PrepareConfig(block_rows=6)),
    ):
        for row in P.length_band_sweep(prefixes, bands).collect():
            kept = [brute.prepare(d, row.min_chars, row.max_chars) for d in dialogs]
            assert row.conversations == sum(bool(k) for k in kept)
            assert row.messages == sum(len(k) for k in kept)


def test_null_dialog_and_empty_corpus(spark):
    df = spark.createDataFrame([(1, None)], "conv_id bigint, dialog array<string>")
    assert P.prepare_dialogs(df).count() == 0
    assert P.dialog_stats(df).first().n_turns == 0
    assert P.filter_funnel(P.dialog_stats(df.limit(0))).count() == len(P.FUNNEL_REASONS)


def test_no_shuffle_and_single_regex_for_dialogs(spark, dialogs):
    df = as_dialogs(spark, dialogs)
    plan = P.prepare_dialogs(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert plan.count("regexp_replace") == 2


def test_one_exchange_for_turns(spark, small):
    turns = spark.read.parquet(f"{small}/conversations.parquet")
    plan = P.gather_messages(P.prepare_turns(turns))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "PushedFilters: [Or(Not(EqualTo(role,system)),IsNull(role))]" in plan


def test_custom_cleaner(spark):
    df = as_dialogs(spark, [["HI THERE", "OH YES"]])
    row = P.prepare_dialogs(df, clean=F.lower).first()
    assert [m.content for m in row.messages] == ["hi there", "oh yes"]


def test_bad_settings():
    for bad in ({"part_messages": 3}, {"min_turns": 0}, {"block_rows": 0}):
        with pytest.raises(ValueError):
            PrepareConfig(**bad)
