import random

import pytest
from pyspark.sql import functions as F

import brute
from dialogprep.functions import text as T

PAIRS = [
    ("I ’ m not sure .", "I'm not sure."),
    ("said ' hello ' there", "said'hello'there"),
    ("“Hi”", '"Hi"'),
    ("‘Hi", "‘Hi"),
    ("a 　b\u001c.", "a b."),
    ("a​b", "a​b"),
    ("cost $1 \\ 2 !", "cost $1 \\ 2!"),
    ("", ""),
    ("   ", ""),
    (None, None),
]


def column(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")


def apply(spark, texts, fn):
    rows = column(spark, texts).select("id", fn(F.col("t")).alias("out")).orderBy("id").collect()
    return [r.out for r in rows]


def random_texts(n=5000, seed=7):
    rng = random.Random(seed)
    blanks = [chr(c) for c in range(1, 0x3001) if chr(c).isspace()]
    alphabet = list("ab.,!?;:'’‘“”\"$\\1") + ["\U0001f600", "​", " ", " "]
    return [
        "".join(rng.choice(alphabet + [rng.choice(blanks)] * 6) for _ in range(rng.randrange(0, 24)))
        for _ in range(n)
    ]


def test_golden_pairs(spark):
    got = apply(spark, [raw for raw, _ in PAIRS], T.clean_utterance)
    assert got == [want for _, want in PAIRS]


def test_random_texts_match_brute_force(spark):
    texts = random_texts()
    assert apply(spark, texts, T.clean_utterance) == [brute.clean(t) for t in texts]


def test_fused_equals_single_steps(spark):
    texts = random_texts(seed=8)
    fused = apply(spark, texts, T.clean_utterance)
    assert fused == apply(spark, texts, lambda c: T.clean_utterance(c, T.STEPS))


def test_whitespace_class_is_pythons(spark):
    chars = [chr(c) for c in range(1, 0x3100)]
    found = apply(spark, chars, lambda c: c.rlike(f"(?U)^{T.WS}$"))
    assert found == [c.isspace() for c in chars]


def test_long_blank_run_is_linear(spark):
    n = 300_000
    assert apply(spark, ["a" + " " * n + "b" + "　" * n + "."], T.clean_utterance) == ["a b."]
    assert apply(spark, [" " * n + "a" + " " * n], T.strip) == ["a"]


def test_extra_cleaning_step(spark):
    steps = (*T.FUSED_STEPS, F.lower)
    assert apply(spark, ["Oh , YES !"], lambda c: T.clean_utterance(c, steps)) == ["oh, yes!"]


@pytest.mark.parametrize(
    "raw, want",
    [
        (" Ugh, Mondays.<end_of_turn>\n<start_of_turn>user\nhi", "Ugh, Mondays."),
        ("a b c a b c a<eos>zzz", "a b c a b c a"),
        ("<bos>hi<pad> ", "hi"),
        ("<eos>x<end_of_turn>", ""),
        ("", ""),
        ("no stop 　", "no stop"),
    ],
)
def test_extract_reply(spark, raw, want):
    assert apply(spark, [raw], T.extract_reply) == [want]


def test_repeated_ngrams(spark):
    got = apply(spark, ["a b c a b c a", "a b", "", "x x x x"], T.ngram_counts)
    assert [(g.total, g.repeated) for g in got] == [(5, 2), (0, 0), (0, 0), (2, 1)]


def test_stop_and_voice(spark):
    texts = ["x<end_of_turn>", "x<eos>", "x", "As an AI, I don't have feelings", "i’m here to help", None]
    assert apply(spark, texts[:3], T.has_stop) == [True, True, False]
    assert apply(spark, texts[2:], T.sounds_like_assistant) == [False, True, True, False]


def test_units(spark):
    assert apply(spark, ["Hello, wörld! 42 ok_1", "", "　"], T.units) == [6, 0, 0]
