"""Blocks by depth, ids by position, sliding prompts, tokens, best-fit packing, sketches, band tables, phrase tables."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from dialogprep import schemas
from dialogprep.config import PrepareConfig
from dialogprep.operators import audit, chat, ordered, prepare, sizing, template
from dialogprep.plans.queries import chat_convs, doc_tokens, phrase_table
from dialogprep.sources import tables

SCHEMA = "conv_id bigint, part int, messages array<struct<role:string,content:string>>"
TURNS = "conv_id bigint, turn bigint, role string, text string"


def lines(df):
    return sorted(map(repr, df.collect()))


# --- Blocks ----------------------------------------------------------------


def test_blocks_of_sparse_orders_are_even(spark):
    """Timestamps as order: as many blocks as rows need, none fuller than the limit, and short keys are not cut."""
    rng = random.Random(1)
    rows = [(1, 10**15 + i * 10**9 + rng.randrange(10**8)) for i in range(5000)] + [(2, i) for i in range(90)] + [(None, 7 * i) for i in range(900)]
    df = spark.createDataFrame(rows, "k bigint, o bigint").repartition(4)
    cut = ordered.with_block(df, "k", "o", 100)
    sizes = {(r.k, r._block): r["count"] for r in cut.groupBy("k", "_block").count().collect()}
    assert sizes.pop((2, ordered.WHOLE_KEY)) == 90 and sum(sizes.values()) == 5900
    assert max(sizes.values()) <= 100 and len(sizes) <= 3 * 59
    spans = cut.where("k = 1").groupBy("_block").agg(F.min("o").alias("low"), F.max("o").alias("high")).orderBy("_block").collect()
    assert all(a.high < b.low for a, b in zip(spans, spans[1:], strict=False))
    got = ordered.dense_index(df, "k", "o", 100)
    assert got.where("k = 1").orderBy("o").select("i").collect() == [(i,) for i in range(5000)]
    assert {r.i for r in got.where("k is null").collect()} == set(range(900))


@pytest.mark.parametrize("block_rows", [2, 3, 65536])
def test_null_conversations_in_blocks(spark, block_rows):
    rows = [(None, t, "user", f"turn {t}") for t in range(8)] + [(1, 10**12 * t, "user", "x" if t == 5 else f"turn {t}") for t in range(9)] + [(2, 1, "user", "one turn")]
    turns = spark.createDataFrame(rows, TURNS)
    cfg = PrepareConfig(block_rows=block_rows)
    got = {(r.conv_id, r.i): (r.role, r.content) for r in prepare.prepare_turns(turns, cfg).collect()}
    want = {(None, i): (("user", "model")[i % 2], f"turn {i}") for i in range(8)} | {(1, i): (("user", "model")[i % 2], f"turn {i}") for i in range(4)}
    assert got == want
    assert lines(audit.role_audit(turns, cfg=cfg)) == lines(audit.role_audit(turns))
    assert lines(prepare.turn_stats(turns, cfg)) == lines(prepare.turn_stats(turns))


def test_histories_by_timestamp_order(spark):
    rng = random.Random(3)
    rows = [(s, rng.randrange(10**15), rng.choice(["user", "model"]), rng.choice(["a", "b", "/reset", " "])) for s in (1, 1, 1, 2, None) for _ in range(60)]
    log = spark.createDataFrame(rows, schemas.CHAT_LOG)
    assert lines(chat.chat_history(log, 4, 10)) == lines(chat.chat_history(log, 4))


# --- Ids -------------------------------------------------------------------


def test_ids_by_position_need_no_shuffle(spark, tmp_path):
    path, moved = str(tmp_path / "dialogs"), str(tmp_path / "moved")
    rows = [(["same", "lines"],)] * 50 + [([f"own {i}", "reply"],) for i in range(50)]
    spark.createDataFrame(rows, "dialog array<string>").repartition(16).write.parquet(path)
    many = tables.read_dialogs(spark, path)
    ids = {r.conv_id for r in many.collect()}
    assert len(ids) == 100 and {r.conv_id for r in tables.read_dialogs(spark, path).collect()} == ids
    spark.conf.set("spark.sql.files.openCostInBytes", 1 << 30)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 10)
    try:
        cut = tables.read_dialogs(spark, path)
        assert "Exchange" not in cut._jdf.queryExecution().executedPlan().toString()
        assert {r.conv_id for r in cut.collect()} == ids
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    import shutil

    shutil.copytree(path, moved)
    assert {r.conv_id for r in tables.read_dialogs(spark, moved).collect()} == ids


def test_bare_lines_are_told_apart_where_they_repeat(spark, tmp_path):
    path = str(tmp_path / "lines")
    messages = [[("user", "hi"), ("model", "yo")]] * 200 + [[("user", f"q{i}"), ("model", "a")] for i in range(30)]
    spark.createDataFrame([(m,) for m in messages], "messages array<struct<role:string,content:string>>").repartition(7).write.json(path)
    once = {(r.conv_id, repr(r.messages)) for r in tables.read_messages(spark, path).collect()}
    again = {(r.conv_id, repr(r.messages)) for r in tables.read_messages(spark, path).coalesce(1).collect()}
    assert len({i for i, _ in once}) == 230 and once == again


# --- Prompts and spans -----------------------------------------------------


@pytest.mark.parametrize("max_turns", [1, 2, 3, 50])
def test_sliding_prompts(spark, small, max_turns):
    convs = chat_convs(spark, small)
    rows = {r.conv_id: [(m.role, m.content) for m in r.messages] for r in convs.collect()}
    got = template.context_reply_pairs(convs, max_turns=max_turns).collect()
    assert len(got) == sum(len(m) // 2 for m in rows.values())
    for p in got:
        at = 2 * p.reply + 1
        assert p.prompt == brute.render(rows[p.conv_id][max(0, at - max_turns) : at], opener=True)
        assert p.completion == rows[p.conv_id][at][1] + "<end_of_turn>"
    if max_turns == 50:
        assert lines(template.context_reply_pairs(convs)) == lines(template.context_reply_pairs(convs, max_turns=50))


def test_spans_and_prompts_of_a_long_conversation(spark):
    messages = [("user" if i % 2 == 0 else "model", f"turn {i} " + "é" * (i % 7)) for i in range(3000)]
    df = spark.createDataFrame([(1, 0, messages), (2, 0, []), (3, 0, None), (4, 1, messages[:129])], SCHEMA)
    texts = {r.conv_id: r.text for r in template.render(df).collect()}
    spans = template.span_rows(df).collect()
    assert [r.conv_id for r in spans].count(1) == 1500 and [r.conv_id for r in spans].count(4) == 64
    assert all(texts[s.conv_id][s.start : s.end] == messages[2 * s.reply + 1][1].strip() + "<end_of_turn>" for s in spans)
    labeled = {(r.conv_id, r.reply): r.labeled for r in template.labeled_text(df).collect()}
    assert labeled == {(s.conv_id, s.reply): texts[s.conv_id][s.start : s.end] for s in spans}
    pairs = template.context_reply_pairs(df.where("conv_id = 1"), max_turns=2)
    assert pairs.agg(F.max(F.length("prompt"))).first()[0] < 140 and pairs.count() == 1500


def test_token_share(spark, small):
    tokens = doc_tokens(spark, small)
    masks = {r.conv_id: r.assistant_masks for r in template.token_mask(tokens).collect()}
    got = template.token_label_fraction(tokens).collect()
    assert {r.conv_id: (r.labeled_tokens, r.total_tokens) for r in got} == {c: (sum(m), len(m)) for c, m in masks.items()}
    whole = template.token_label_total(tokens, replies_only=False).first()
    assert whole.labeled_tokens == whole.total_tokens == sum(map(len, masks.values())) and whole.fraction == 1
    empty = tokens.limit(1).withColumns({"ids": F.array().cast("array<int>"), "offsets": F.array().cast("array<struct<start:int,end:int>>")})
    assert template.token_label_fraction(empty).first().fraction is None


# --- Sizing ----------------------------------------------------------------


def plain_best_fit(sizes, budget):
    rooms, out = [], []
    for n in sizes:
        fits = [(room, i) for i, room in enumerate(rooms) if room >= n]
        if fits and n <= budget:
            i = min(fits)[1]
            rooms[i] -= n
        else:
            i = len(rooms)
            rooms.append(max(budget - n, 0))
        out.append(i)
    return out


def test_best_fit_equals_a_search_over_all_bins():
    rng = random.Random(0)
    for _ in range(400):
        budget = rng.choice([1, 5, 8, 16, 31, 100, 1024])
        sizes = [rng.randrange(1, budget + 3) for _ in range(rng.randrange(80))]
        assert sizing.best_fit(budget)(sizes) == plain_best_fit(sizes, budget)


def test_best_fit_packing_wastes_less_than_next_fit(spark):
    rng = random.Random(5)
    lengths = spark.createDataFrame([(i, rng.randrange(10, 900)) for i in range(3000)] + [(5000, 4000)], "conv_id bigint, n_units bigint")

    def bins(packed):
        assert packed.count() == 3001 and packed.select("conv_id").distinct().count() == 3001
        per = packed.groupBy("shard", "bin").agg(F.sum("n_units").alias("used"), F.count("*").alias("n"))
        assert per.where("used > 1024 and n > 1").isEmpty()
        return per.count()

    best, following = bins(sizing.pack_best_fit(lengths, shard=1000)), bins(sizing.pack_sequences(lengths, shard=1000))
    assert best < 0.9 * following and best >= sum(r.n_units for r in lengths.collect()) / 1024


def test_merged_sketches_are_near_the_exact_profile(spark):
    rng = random.Random(6)
    rows = [(i, int(rng.lognormvariate(5, 1)) + 1, i % 30) for i in range(20_000)]
    lengths = spark.createDataFrame(rows, "conv_id bigint, n_units bigint, day bigint")
    sketches = sizing.length_sketches(lengths, ["day"])
    merged = sizing.merged_profile(sketches).first()
    values = sorted(n for _, n, _ in rows)
    assert (merged.conversations, merged.units, merged.longest) == (20_000, sum(values), values[-1])
    for q, got in ((0.5, merged.p50), (0.9, merged.p90), (0.99, merged.p99)):
        below, upto = sum(v < got for v in values) / 20_000, sum(v <= got for v in values) / 20_000
        assert below - 0.0165 <= q <= upto + 0.0165
    assert sketches.agg(F.max(F.length("sketch"))).first()[0] < 8_000
    halves = sketches.withColumn("half", F.col("day") % 2)
    assert sum(r.conversations for r in sizing.merged_profile(halves, ["half"]).collect()) == 20_000


# --- A table of bands ------------------------------------------------------


@pytest.mark.parametrize("min_turns, block_rows", [(2, 65536), (3, 4), (6, 5)])
def test_band_table_equals_the_sweep(spark, min_turns, block_rows):
    rng = random.Random(min_turns)
    cfg = PrepareConfig(min_turns=min_turns, block_rows=block_rows)
    dialogs = [(i, [rng.choice([None, "", "x" * rng.randrange(1, 40)]) if rng.random() < 0.1 else "y" * rng.randrange(1, 60) for _ in range(rng.randrange(30))]) for i in range(80)]
    dialogs += [(900, None), (901, []), (902, ["a"] * 25)]
    bands = [(lo, hi) for lo in (0, 1, 2, 7, 30, 1000) for hi in (0, 5, 20, 45, 60, 5000)]
    grid = spark.createDataFrame([*bands, bands[3], (None, 5), (-4, 70)], "min_chars int, max_chars int")
    turns = spark.createDataFrame([(c, 10 * t, "user", text) for c, d in dialogs for t, text in enumerate(d or [])], TURNS)
    rows = spark.createDataFrame(dialogs, schemas.DIALOGS)
    want = {tuple(r) for r in prepare.length_band_sweep(prepare.dialog_band_prefixes(rows, [*bands, (-4, 70)]), [*bands, (-4, 70)], cfg).collect()}
    for staircases in (prepare.dialog_staircases(rows, cfg), prepare.turn_staircases(turns, cfg)):
        got = {tuple(r) for r in prepare.length_band_grid(staircases, grid).collect()}
        assert got == want | {(None, 5, 0, 0)}


def test_staircases_have_few_steps(spark):
    rng = random.Random(2)
    rows = spark.createDataFrame([(1, ["w" * rng.randrange(1, 500) for _ in range(4000)])], schemas.DIALOGS)
    steps = prepare.dialog_staircases(rows)
    assert steps.count() < 60 and steps.agg(F.sum("messages")).first()[0] == 4000


# --- A table of phrases ----------------------------------------------------


@pytest.mark.parametrize("part_bytes", [64 << 20, 200])
def test_phrases_are_found_as_by_search(spark, part_bytes):
    rng = random.Random(7)
    words = ["as", "an", "AI", "I’m", "here", "to", "help", "é", "you", "“so”"]
    replies = [(r, i, " ".join(rng.choices(words, k=rng.randrange(12)))) for r in ("a", "b") for i in range(80)] + [("a", 900, None), ("c", 901, "")]
    phrases = [" ".join(rng.choices(words, k=rng.randrange(1, 4))) for _ in range(60)] + [None, "", "AS AN ai", "i'm here"]
    table = spark.createDataFrame([(p,) for p in phrases], "phrase string")
    df = spark.createDataFrame(replies, "run string, i int, reply string")
    fold = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t.translate({8217: "'", 8220: '"', 8221: '"'}))
    known = {fold(p) for p in phrases if p}
    want = {(r, i, p) for r, i, t in replies if t for p in known if p in fold(t)}
    got = audit.phrase_hits(df, table, part_bytes=part_bytes).collect()
    assert {(r.run, r.i, r.phrase) for r in got} == want and len(got) == len(want)
    rates = {r.run: (r.replies, r.flagged, r.phrases) for r in audit.assistant_voice_table(df, table, key=("i",)).collect()}
    assert rates["c"] == (1, 0, 0) and rates["a"][:2] == (81, len({i for r, i, _ in want if r == "a"}))


def test_a_hundred_thousand_phrases_in_one_scan(spark, small):
    many = spark.range(100_000).select(F.concat(F.lit("phrase number "), F.col("id").cast("string"), F.lit(" of many")).alias("phrase"))
    replies = spark.createDataFrame([("a", i, f"it is phrase number {i} of many, i say") for i in range(300)], "run string, i bigint, reply string")
    found = audit.phrase_hits(replies, many.unionByName(phrase_table(spark, small)))
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert found.count() == 300
    assert audit.phrase_hits(replies, many.limit(0)).isEmpty()
