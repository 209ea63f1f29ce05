"""Streams in event time, idle sessions, restarts, and what they observe."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from dialogprep import schemas
from dialogprep.__main__ import main
from dialogprep.operators import chat, prepare
from dialogprep.plans import corpus, queries
from dialogprep.streaming import sinks
from dialogprep.streaming.chat import accepted, chat_history_stream, late_rows, settled
from dialogprep.streaming.ordered import STATE_STORE, chat_history_in_order, close_log
from dialogprep.streaming.sinks import NO_DATA_BATCHES, advance, advanced, drain, finished_batches

LOG = "session bigint, seq bigint, role string, line string, ts timestamp"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)
ORDERED = STATE_STORE | {NO_DATA_BATCHES: "true"}


def timed(rows, seconds=60):
    """A minute between the rows of all sessions, in the order of seq."""
    return [(*row, None if row[1] is None else START + timedelta(seconds=seconds * row[1])) for row in rows]


def random_log(sessions=12, n=60, seed=3):
    rng = random.Random(seed)
    lines, out = ["hi", "ok ", " ", "/reset", "/exit", None], []
    for session in [*range(sessions), None]:
        seq = 0
        for _ in range(rng.randrange(1, n)):
            seq += rng.choice([1, 1, 2, 40])
            line = rng.choices(lines, [40, 40, 5, 8, 1 if session and session % 3 == 0 else 0, 3])[0]
            out.append((session, seq, rng.choice(["user", "model"]), line))
    rng.shuffle(out)
    return out


def files_of(spark, path, *files):
    for rows in files:
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(path)


def rows_of(df):
    columns = ["session", "segment", "pos", "seq", "role", "line", "history", "history_from"]
    return sorted(map(repr, df.select(*columns).collect()))


@pytest.mark.parametrize("idle, page", [(None, 1024), (None, 3), (600, 1024), (600, 3)])
def test_shuffled_files_come_out_as_in_batch(spark, tmp_path, idle, page):
    rows = timed(random_log())
    path = str(tmp_path / "log")
    files_of(spark, path, *[rows[i::5] for i in range(5)])
    close_log(spark, path, LOG)
    log = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(path)
    folded = drain(chat_history_in_order(log, "10 days", page, idle), "ordered", settings=ORDERED)
    assert late_rows(folded).isEmpty()
    batch = spark.createDataFrame(rows, LOG)
    want = chat.chat_history(batch, page, idle_seconds=idle)
    assert rows_of(accepted(folded)) == rows_of(want)
    for block_rows in (1, 7):
        assert rows_of(chat.chat_history(batch, page, block_rows, idle)) == rows_of(want)


def test_pauses_start_pages(spark):
    rows = timed([(1, s, "user", f"m{s}") for s in (1, 2, 3, 20, 21, 50)])
    got = chat.chat_history(spark.createDataFrame(rows, LOG), idle_seconds=600).orderBy("seq").collect()
    assert [(r.pos, r.history_from, len(r.history)) for r in got] == [(0, 0, 1), (1, 0, 2), (2, 0, 3), (3, 3, 1), (4, 3, 2), (5, 5, 1)]


def test_rows_wait_for_the_watermark(spark, tmp_path):
    """A row that comes an hour late is folded in its place; one behind the watermark is told as late."""
    path = str(tmp_path / "log")
    hour = 60
    first = timed([(1, 1, "user", "a"), (1, 90, "user", "c"), (2, 5, "user", "x")])
    second = timed([(1, 2 * hour, "user", "d"), (1, 85, "user", "b")])
    third = timed([(1, 9 * hour, "user", "e")])
    fourth = timed([(1, 3, "user", "too late"), (3, 4, "user", "late, but first of its session")])
    between = timed([(2, 9 * hour + 1, "user", "y")])  # in this micro-batch the first session's timer fires
    files_of(spark, path, first, second, third, between, fourth)
    close_log(spark, path, LOG)
    log = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(path)
    folded = drain(chat_history_in_order(log, "1 hour"), "waiting", settings=ORDERED)
    assert [(r.session, r.seq, r.line) for r in late_rows(folded).collect()] == [(1, 3, "too late")]
    last = accepted(folded).where("session = 1").orderBy(F.desc("seq")).first()
    assert [m.content for m in last.history] == ["a", "b", "c", "d", "e"]
    assert accepted(folded).where("session = 3").count() == 1


def test_null_session_seq_and_time(spark, tmp_path):
    rows = [(None, 1, "user", "a", START), (None, None, "user", "first", START), (None, 2, "model", "b", None), (7, None, "user", "only", None)]
    path = str(tmp_path / "log")
    files_of(spark, path, rows)
    close_log(spark, path, LOG)
    folded = drain(chat_history_in_order(spark.readStream.schema(LOG).parquet(path), "1 hour"), "nulls", settings=ORDERED)
    got = {(r.session, r.seq, r.late) for r in folded.collect()}
    # the row without a time waits for nothing, so the two before it come late
    assert got == {(None, 2, False), (None, 1, True), (None, None, True), (7, None, False)}


def test_first_stream_folds_null_sessions(spark, tmp_path):
    first = [(None, 5, "user", "a", START), (None, None, "user", "z", START), (1, 1, "user", "x", START)]
    second = [(None, 6, "user", "b", START), (None, 2, "user", "old", START)]
    log = files_of(spark, str(tmp_path / "log"), first, second).drop("ts")
    folded = drain(chat_history_stream(log), "chat")
    assert {(r.session, r.seq) for r in late_rows(folded).collect()} == {(None, 2)}
    batch = spark.createDataFrame(first + second, LOG).drop("ts")
    assert rows_of(settled(folded, batch)) == rows_of(chat.chat_history(batch))


def state_rows(spark, progress, name):
    return spark.read.format("statestore").option("stateVarName", name).load(progress)


def test_idle_sessions_give_their_pages_back(spark, tmp_path):
    """Many sessions speak once and pause; numbers and /exit survive, lines do not stay."""
    path, out, progress = (str(tmp_path / x) for x in ("log", "out", "progress"))
    early = [(s, 1 + s % 7, "user", f"line {s}") for s in range(300)] + [(s, 10, "user", "/exit") for s in range(0, 300, 3)]
    later = [(999, 10_000, "user", "much later")]
    last = [(s, 20_000, "user", "back") for s in range(30)]
    log = files_of(spark, path, timed(early), timed(later))
    advance(chat_history_in_order(log, "1 minute", idle_seconds=3600), out, progress, settings=ORDERED)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE["spark.sql.streaming.stateStore.providerClass"])
    try:
        assert state_rows(spark, progress, "place").count() == 301
        assert state_rows(spark, progress, "page").count() <= 1  # at most the session that has just spoken
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    files_of(spark, path, timed(last))
    close_log(spark, path, LOG)
    stream = chat_history_in_order(spark.readStream.schema(LOG).parquet(path), "1 minute", idle_seconds=3600)
    advance(stream, out, progress, settings=ORDERED)
    got = accepted(advanced(spark, out, progress, stream.schema))
    assert rows_of(got) == rows_of(chat.chat_history(spark.createDataFrame(timed(early + later + last), LOG), idle_seconds=3600))
    back = got.where("line = 'back'").collect()
    assert len(back) == 20 and {(r.pos, r.history_from, len(r.history)) for r in back} == {(1, 1, 1)}


class Stopped(Exception):
    pass


@pytest.mark.parametrize("after_write", [False, True])
def test_a_stopped_stream_goes_on(spark, tmp_path, monkeypatch, after_write):
    """Stopped in its second batch, before or after it is written, and started again: the same as one run."""
    source, out, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    for part in range(4):
        dialogs = [(i, ["hello there", "hi , you", "more of it"][: 1 + i % 3]) for i in range(part * 25, part * 25 + 25)]
        spark.createDataFrame(dialogs, schemas.DIALOGS).coalesce(1).write.mode("append").parquet(source)
    whole = sinks.advance

    def breaking(stream, out, progress, settings=None, write=None):
        def stops(batch, folder, batch_id):
            if batch_id == 1 and not after_write:
                raise Stopped
            write(batch, folder, batch_id)
            if batch_id == 1:
                raise Stopped

        whole(stream, out, progress, settings, stops)

    monkeypatch.setattr(corpus, "advance", breaking)
    with pytest.raises(Exception, match="Stopped"):
        corpus.prepare_corpus_stream(spark, source, out, progress, batch_bytes=1)
    schema = schemas.T.StructType([*schemas.CONVERSATION_LINES.fields, schemas.T.StructField("split", schemas.T.StringType())])
    assert finished_batches(spark, progress) == 1
    assert advanced(spark, out, progress, schema, "json").count() < 25
    monkeypatch.setattr(corpus, "advance", whole)
    corpus.prepare_corpus_stream(spark, source, out, progress, batch_bytes=1)
    corpus.prepare_corpus_stream(spark, source, out, progress, batch_bytes=1)  # nothing new
    assert finished_batches(spark, progress) == 4
    got = advanced(spark, out, progress, schema, "json").drop("split")
    all_dialogs = spark.read.schema(schemas.DIALOGS).parquet(source)
    want = prepare.prepare_dialogs(all_dialogs)
    key = lambda df: sorted(map(repr, df.select("conv_id", "part", "messages").collect()))
    assert key(got) == key(want) and len(key(got)) == 66
    funnel = {tuple(r) for r in corpus.stream_funnel(spark, out, progress).collect()}
    assert funnel == {tuple(r) for r in prepare.filter_funnel(prepare.dialog_stats(all_dialogs)).collect()}


def test_nothing_finished_is_an_empty_frame(spark, tmp_path):
    assert finished_batches(spark, str(tmp_path / "none")) == 0
    assert advanced(spark, str(tmp_path / "out"), str(tmp_path / "none"), schemas.DIALOGS).isEmpty()


@pytest.mark.parametrize("layout, block_rows", [("dialogs", 65536), ("turns", 65536), ("turns", 3)])
def test_corpus_job_observes_the_funnel(spark, small, tmp_path, layout, block_rows):
    cfg = prepare.PrepareConfig(block_rows=block_rows)
    source = f"{small}/conversations.parquet"
    turns = spark.read.parquet(source)
    if layout == "dialogs":
        source = str(tmp_path / "dialogs")
        corpus.gather_messages  # the job reads what this wrote
        from dialogprep.sources import tables

        tables.turns_to_dialogs(turns).select("conv_id", "dialog").write.parquet(source)
    got = corpus.prepare_corpus(spark, source, str(tmp_path / "out"), layout, cfg, with_funnel=True)
    want = {r.reason: (r.conversations, r.turns) for r in prepare.filter_funnel(prepare.turn_stats(turns)).collect()}
    assert got["funnel"] == want and got["kept"] == want["kept"][0]


def test_command_line_streams(spark, small, tmp_path, capsys):
    source, out, log, histories = (str(tmp_path / x) for x in ("in", "out", "log", "histories"))
    spark.createDataFrame([(i, ["hello there", "hi , you"]) for i in range(30)], schemas.DIALOGS).write.parquet(source)
    main(["stream", source, out])
    main(["stream", source, out])
    assert "conversations so far" in capsys.readouterr().out
    assert spark.read.json(f"{out}/batch=0").count() == 30
    files_of(spark, log, timed(random_log(4)))
    close_log(spark, log, LOG)
    main(["chat", log, histories, "--delay", "1 day"])
    want = chat.chat_history(spark.createDataFrame(timed(random_log(4)), LOG))
    assert spark.read.parquet(histories).where("not late").count() == want.count()
    main(["chat", log, f"{histories}-batch"])
    # the row that closes the log is a row of the null session here
    assert spark.read.parquet(f"{histories}-batch").count() == want.count() + 1


@pytest.mark.parametrize("buckets, idle, page", [(1, 600, 3), (5, None, 1024)])
def test_sessions_of_a_bucket_are_folded_in_one_call(spark, tmp_path, buckets, idle, page):
    """Many sessions wait as a few chunks of their buckets, and come out as in batch."""
    path, out, progress = (str(tmp_path / x) for x in ("log", "out", "progress"))
    rows = timed(random_log(40, 30))
    log = files_of(spark, path, rows[::2], rows[1::2])
    advance(chat_history_in_order(log, "10 days", page, idle, buckets=buckets), out, progress, settings=STATE_STORE | {NO_DATA_BATCHES: "false"})
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE["spark.sql.streaming.stateStore.providerClass"])
    try:
        assert 1 <= state_rows(spark, progress, "waiting").count() <= 2 * buckets
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    close_log(spark, path, LOG)
    stream = chat_history_in_order(spark.readStream.schema(LOG).parquet(path), "10 days", page, idle, buckets=buckets)
    advance(stream, out, progress, settings=ORDERED)
    folded = advanced(spark, out, progress, stream.schema)
    assert late_rows(folded).isEmpty()
    assert rows_of(accepted(folded)) == rows_of(chat.chat_history(spark.createDataFrame(rows, LOG), page, idle_seconds=idle))


def test_a_longer_log_takes_as_many_micro_batches(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "FILE_ROWS", 20)
    path, out, progress = (str(tmp_path / x) for x in ("log", "out", "progress"))
    files = queries._arrive(spark, small, path, range(queries.ARRIVALS))
    assert files > 3
    close_log(spark, path, queries.TIMED_LOG)
    stream = queries._arriving(spark, path, files)
    advance(stream, out, progress, settings=ORDERED)
    assert finished_batches(spark, progress) <= queries.ARRIVALS + 2
    want = chat.chat_history(queries.timed_log(queries.events(spark, small)))
    assert rows_of(accepted(advanced(spark, out, progress, stream.schema))) == rows_of(want)
