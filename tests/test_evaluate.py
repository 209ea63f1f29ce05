import math
from collections import Counter

import pytest

from dialogprep.config import EVAL_PROMPTS, PrepareConfig
from dialogprep.operators import audit, evaluate
from dialogprep.operators.lookup import fits_broadcast

SCHEMA = "conv_id bigint, part int, messages array<struct<role:string,content:string>>"


def test_perplexity_is_weighted(spark):
    df = spark.createDataFrame([("a", 1, 10, 1.0), ("a", 2, 30, 2.0)], "run string, conv_id bigint, n_tokens bigint, mean_loss double")
    assert evaluate.perplexity(df).first().perplexity == pytest.approx(math.exp(1.75))
    assert evaluate.perplexity(df, shifted=True).first().perplexity == pytest.approx(math.exp(67 / 38))


def test_trend(spark):
    df = spark.createDataFrame([(1, 1, 5, 1.0), (2, 1, 5, 0.5), (4, 1, 5, 0.6)], "run_no int, conv_id bigint, n_tokens bigint, mean_loss double")
    rows = evaluate.run_trend(df).orderBy("run_no").collect()
    assert rows[0].change is None
    assert rows[1].change == pytest.approx(math.exp(0.5) - math.exp(1.0))
    assert rows[2].change > 0


def convs(spark, dialogs):
    rows = [(i, 0, [("user" if j % 2 == 0 else "model", t) for j, t in enumerate(d)]) for i, d in enumerate(dialogs)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("broadcast", [10**6, 0])
@pytest.mark.parametrize("n", [1, 2])
def test_ngram_losses(spark, n, broadcast):
    """``broadcast=0`` takes the salted join; 'the' is hot, 'ufo' hot and unknown."""
    train = [["the cat sat", "the the dog"], ["a cat", "the end"]] * 5
    val = [["the the the ufo", "cat ufo"], ["ufo ufo", "the cat sat"]]

    def grams(dialogs):
        for conv, d in enumerate(dialogs):
            for text in d:
                ws = text.split(" ")
                for prev, w in zip(["<s>", *ws], [*ws, "</s>"]):
                    yield conv, prev, w

    seen = list(grams(train))
    uni = Counter(w for _, _, w in seen)
    bi = Counter((p, w) for _, p, w in seen)
    ctx = Counter(p for _, p, _ in seen)
    v = len(uni) + 1
    want = {}
    for conv, p, w in grams(val):
        prob = (uni[w] + 1) / (len(seen) + v) if n == 1 else (bi[p, w] + 1) / (ctx[p] + v)
        want.setdefault(conv, []).append(-math.log(prob))
    got = evaluate.ngram_losses(convs(spark, train), convs(spark, val), n, broadcast).collect()
    assert {r.conv_id: r.n_tokens for r in got} == {c: len(x) for c, x in want.items()}
    for r in got:
        assert r.mean_loss == pytest.approx(sum(want[r.conv_id]) / len(want[r.conv_id]))


def test_ngram_losses_of_replies(spark):
    train, val = convs(spark, [["a b", "c"]]), convs(spark, [["z z z z", "c"]])
    row = evaluate.ngram_losses(train, val, replies_only=True).first()
    # c and </s>: 1 and 2 of 5 seen, 4 words and an unknown one
    assert (row.n_tokens, row.mean_loss) == (2, pytest.approx(-(math.log(2 / 10) + math.log(3 / 10)) / 2))


def test_broadcast_is_bounded_in_bytes(spark):
    table = spark.createDataFrame([("x" * 1000, 1), (None, 2)], "w string, n bigint")
    assert fits_broadcast(table) and not fits_broadcast(table, max_bytes=1000) and not fits_broadcast(table, max_rows=1)
    assert fits_broadcast(table.limit(0), 0, 0)


def test_checkpoints(spark):
    rows = [(200, 2.1, True), (400, 2.1, True), (600, 2.2, True), (100, 2.5, False), (300, 2.0, False)]
    log = spark.createDataFrame([("r", *r) for r in rows], "run string, step bigint, eval_loss double, saved boolean")
    assert evaluate.best_checkpoint(log).first().step == 200
    kept = {r.step: r.is_best for r in evaluate.checkpoint_retention(log).collect()}
    assert kept == {200: True, 400: False, 600: False}
    plan = evaluate.checkpoint_retention(log)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_matrix_and_side_by_side(spark):
    runs = spark.createDataFrame([("a",), ("b",)], "run string")
    rows = evaluate.eval_matrix(runs).collect()
    assert len(rows) == 10 and {r.prompt for r in rows} == set(EVAL_PROMPTS)
    assert rows[0].rendered.endswith("<end_of_turn>\n<start_of_turn>model\n")
    replies = spark.createDataFrame(
        [("a", 0, "x"), ("b", 0, "y"), ("a", 1, "z"), ("c", 2, "w"), ("b", 3, None)], "run string, prompt_id int, reply string"
    )
    got = {r.prompt_id: (r.reply_a, r.reply_b, r.n_a, r.n_b) for r in evaluate.side_by_side(replies, "a", "b").collect()}
    assert got == {0: ("x", "y", 1, 1), 1: ("z", None, 1, 0), 3: (None, None, 0, 1)}


def test_reply_audits(spark):
    raw = spark.createDataFrame(
        [("r", "a b c a b c a<eos>zzz"), ("r", "As an AI, no"), ("r", " ".join(["w"] * 60)), ("r", None)],
        "run string, raw string",
    )
    stops = audit.stop_audit(raw).first()
    assert (stops.replies, stops.no_stop, stops.at_cap) == (4, 3, 1)
    replies = audit.with_reply(raw)
    grams = audit.repeated_ngrams(replies).first()
    assert (grams.ngrams, grams.repeated, grams.looping_replies) == (5 + 2 + 58, 2 + 57, 2)
    voice = audit.assistant_voice(replies).first()
    assert (voice.replies, voice.flagged, voice.rate) == (4, 1, 0.25)


@pytest.mark.parametrize("block_rows", [65536, 3, 1])
def test_role_audit(spark, block_rows):
    seqs = {
        1: ["user", "model", "user", "model"],
        2: ["user", "user", "model", "model", "user"],
        3: ["system", "user", "assistant"],
        4: ["user", None, None],
        5: ["user"] * 8,
    }
    rows = [(k, i, r) for k, s in seqs.items() for i, r in enumerate(s)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string")
    got = {r.violation: (r.rows, r.conversations) for r in audit.role_audit(df, cfg=PrepareConfig(block_rows=block_rows)).collect()}
    assert got == {
        "unknown_role": (3, 2),
        "broken_alternation": (2 + 1 + 7, 3),
        "not_ending_on_reply": (3, 3),
    }


def test_missing_losses_have_no_weight_and_never_win(spark):
    losses = spark.createDataFrame([("r", 10, 2.0), ("r", 90, None), ("r", 5, float("nan"))], "run string, n_tokens bigint, mean_loss double")
    assert evaluate.perplexity(losses).first().perplexity == pytest.approx(math.exp(2.0))
    log = spark.createDataFrame([("r", 1, 2.0, True), ("r", 2, None, True), ("r", 3, float("nan"), True)], "run string, step bigint, eval_loss double, saved boolean")
    assert evaluate.best_checkpoint(log).first().step == 1


def test_side_by_side_keeps_every_reply(spark):
    replies = spark.createDataFrame([("a", 0, "x"), ("a", 0, "y"), ("b", 0, "z")], "run string, prompt_id int, reply string")
    got = {(r.reply_a, r.reply_b, r.n_a, r.n_b) for r in evaluate.side_by_side(replies, "a", "b").collect()}
    assert got == {("x", "z", 2, 1), ("y", None, 2, 1)}
