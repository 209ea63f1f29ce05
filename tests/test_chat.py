import random

import pytest
from pyspark.sql import functions as F

import brute
from dialogprep import schemas
from dialogprep.operators import chat
from dialogprep.streaming.chat import accepted, chat_history_stream, late_rows, settled
from dialogprep.streaming.sinks import drain

PLANTED = [
    (1, 1, "user", "hi"),
    (1, 2, "user", "  "),
    (1, 3, "user", "how are you "),
    (1, 4, "user", "/reset"),
    (1, 5, "user", "again"),
    (2, 1, "user", "yo"),
    (2, 2, "user", "/exit"),
    (2, 3, "user", "late"),
    (3, 1, "user", "a"),
    (3, 2, "model", "/exit"),
    (3, 3, "model", ""),
    (3, 4, "user", "b"),
]


def random_log(n=400, seed=2):
    rng = random.Random(seed)
    lines = ["hi", "ok ", " ", "/reset", "/exit", None]
    out = []
    for session in range(12):
        for seq in range(rng.randrange(1, n // 6)):
            line = rng.choices(lines, [40, 40, 5, 8, 1 if session % 3 else 0, 3])[0]
            out.append((session, seq * 3, rng.choice(["user", "model"]), line))
    rng.shuffle(out)
    return out


def want(rows, max_history=10**9):
    out = set()
    for session in {r[0] for r in rows}:
        own = sorted((r[1:] for r in rows if r[0] == session), key=lambda r: r[0])
        for segment, pos, seq, history in brute.fold(own):
            first = pos - pos % max_history
            out.add((session, segment, pos, seq, first, tuple(history[first:])))
    return out


def got(df):
    return {
        (r.session, r.segment, r.pos, r.seq, r.history_from, tuple((m.role, m.content) for m in r.history))
        for r in df.collect()
    }


@pytest.mark.parametrize("block_rows, max_history", [(65536, 1024), (7, 1024), (1, 5), (65536, 3)])
def test_batch(spark, block_rows, max_history):
    for rows in (PLANTED, random_log()):
        log = spark.createDataFrame(rows, schemas.CHAT_LOG)
        assert got(chat.chat_history(log, max_history, block_rows)) == want(rows, max_history)


def test_planted(spark):
    log = spark.createDataFrame(PLANTED, schemas.CHAT_LOG)
    rows = chat.chat_history(log).where("session < 3").orderBy("session", "seq").collect()
    assert ["|".join(m.content for m in r.history) for r in rows] == ["hi", "hi|how are you", "again", "yo"]


def test_pages_of_a_long_session(spark):
    rows = [(1, i, "user", str(i)) for i in range(5000)]
    folded = chat.chat_history(spark.createDataFrame(rows, schemas.CHAT_LOG), 1024)
    assert folded.where(F.col("history").isNull()).isEmpty()
    ends = folded.where((F.col("pos") % 1024 == 1023) | (F.col("pos") == 4999)).orderBy("pos").collect()
    assert [m.content for r in ends for m in r.history] == [str(i) for i in range(5000)]


def test_null_keys_and_orders_by_block(spark):
    rows = [(None, 1, "user", "a"), (None, 5, "user", "b"), (1, None, "user", "c"), (1, 2, "user", "d"), (1, 9, "user", "e"), (2, 1, "user", "f"), (2, 1, "user", "f")]
    log = spark.createDataFrame(rows, schemas.CHAT_LOG)
    short, long = (sorted(map(repr, chat.fold_log(log, n).collect())) for n in (65536, 2))
    assert short == long and len(short) == 7


def stream_of(spark, path, *files):
    for rows in files:
        spark.createDataFrame(rows, schemas.CHAT_LOG).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schemas.CHAT_LOG).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_equals_batch_over_micro_batches(spark, tmp_path):
    rows = sorted(random_log(120), key=lambda r: r[1])
    third = len(rows) // 3
    # A seq value never spans two files here: it is shared by all sessions.
    cuts = [rows[:third], rows[third : 2 * third], rows[2 * third :]]
    log = stream_of(spark, str(tmp_path / "log"), *cuts)
    folded = drain(chat_history_stream(log, max_history=4), "chat")
    assert late_rows(folded).isEmpty()
    assert got(accepted(folded)) == want(rows, 4)


def test_stream_sets_late_rows_apart(spark, tmp_path):
    first = [(1, 5, "user", "a"), (1, 6, "user", "b")]
    second = [(1, 6, "user", "again"), (1, 2, "user", "old"), (1, 7, "user", "c")]
    folded = drain(chat_history_stream(stream_of(spark, str(tmp_path / "log"), first, second)), "chat")
    assert {(r.seq, r.line) for r in late_rows(folded).collect()} == {(6, "again"), (2, "old")}
    last = accepted(folded).where(F.col("seq") == 7).first()
    assert [m.content for m in last.history] == ["a", "b", "c"]


def test_stream_of_shuffled_files_equals_batch(spark, tmp_path):
    rows = [*random_log(120), (99, 1, "user", "in"), (99, 2, "user", "order")]
    random.Random(1).shuffle(rows)
    files = [rows[i::4] for i in range(4)]
    folded = drain(chat_history_stream(stream_of(spark, str(tmp_path / "log"), *files), max_history=4), "chat")
    assert not late_rows(folded).isEmpty()
    assert got(settled(folded, spark.createDataFrame(rows, schemas.CHAT_LOG), max_history=4)) == want(rows, 4)
