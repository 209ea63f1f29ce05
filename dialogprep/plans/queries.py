"""Registered queries: each operator over whole driver tables.

``conversations`` is a turn table. ``documents`` stands in for a corpus with a
dialogue per row, one utterance per line. ``events`` stands in for logs: chat
lines, training runs, losses. Results are flat, so that SQL can check them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogprep import schemas
from dialogprep.config import ASSISTANT_PHRASES, BOS, EOS, ROLE_MODEL, TURN_CLOSE, TURN_OPEN, PrepareConfig
from dialogprep.functions.text import clean_utterance
from dialogprep.operators import audit, chat, evaluate, prepare, sizing, split, template
from dialogprep.plans.corpus import prepare_corpus_stream, split_corpus, stream_funnel
from dialogprep.sources import tables
from dialogprep.sources.storage import fresh_path, is_file, spread, stage
from dialogprep.streaming.chat import accepted, chat_history_stream, settled
from dialogprep.streaming.ordered import STATE_STORE, chat_history_in_order, close_log
from dialogprep.streaming.prepare import prepare_stream
from dialogprep.streaming.sinks import NO_DATA_BATCHES, advance, advanced, drain
from dialogprep.streaming.sources import BATCH_BYTES, STATELESS_BATCH_BYTES, read_stream

CFG = PrepareConfig()
BANDS = [(lo, hi) for lo in (1, 2, 20) for hi in (200, 500, 2000)]
BOS_ID = 2

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- Inputs ---------------------------------------------------------------


def turns(spark: SparkSession, d: str) -> DataFrame:
    return tables.read_turns(spark, f"{d}/conversations.parquet")


def dialogs(spark: SparkSession, d: str) -> DataFrame:
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    return tables.dialogs_from_text(spread(docs, "doc_id"), "doc_id", "text")


def events(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/events.parquet")


def chat_convs(spark: SparkSession, d: str) -> DataFrame:
    return prepare.gather_messages(prepare.prepare_turns(turns(spark, d), CFG), CFG)


def doc_convs(spark: SparkSession, d: str) -> DataFrame:
    return prepare.prepare_dialogs(dialogs(spark, d), CFG)


def doc_split(spark: SparkSession, d: str, *columns) -> DataFrame:
    """The document corpus with its split; only ``columns`` are staged."""
    convs = doc_convs(spark, d)
    return split_corpus(convs.select("conv_id", "part", *columns) if columns else convs, CFG)


def n_messages():
    return F.size("messages").cast("bigint").alias("n_messages")


def train_lengths(spark: SparkSession, d: str) -> DataFrame:
    lengths = split_corpus(sizing.with_units(doc_convs(spark, d)), CFG)
    return lengths.where(F.col("split") == "train").drop("split")


def event_log(rows: DataFrame, *more: str, exits: bool = False) -> DataFrame:
    """Events as chat lines: errors reset, purchases reply, sign-ups may exit."""
    kind = F.col("event_type")
    line = F.when(kind == "error", "/reset")
    if exits:
        line = line.when(kind == "signup", "/exit")
    return rows.select(
        F.col("user_id").alias("session"),
        F.col("event_id").alias("seq"),
        F.when(kind == "purchase", "model").otherwise("user").alias("role"),
        line.otherwise(kind).alias("line"),
        *more,
    )


def raw_replies(spark: SparkSession, d: str) -> DataFrame:
    """Three runs of generations made of each reply of the corpus.

    ``stopped`` ends its turn and rambles on, ``rambling`` repeats itself and
    never stops, ``assistant`` talks like one and has nothing to say where the
    reply is short: the comparison of runs meets prompts only one answered.
    """
    text = F.col("content")

    def run(name: str, raw):
        return F.struct(F.lit(name).alias("run"), raw.alias("raw"))

    stopped = F.concat(F.lit(" "), text, F.lit(f"{TURN_CLOSE}\n{TURN_OPEN}user\n"), text)
    rambling = F.concat(F.lit(BOS), text, F.lit(" "), text, F.lit("\n"))
    assistant = F.concat(F.lit("as an AI, "), text, F.lit(EOS), text)
    runs = F.array(run("stopped", stopped), run("rambling", rambling), run("assistant", assistant))
    short = F.length(text) < 100
    return (
        prepare.explode_messages(doc_convs(spark, d), CFG)
        .where(F.col("role") == ROLE_MODEL)
        .select("conv_id", "i", F.inline(F.when(short, F.slice(runs, 1, 2)).otherwise(runs)))
    )


def run_losses(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select(
        F.col("event_type").alias("run"),
        F.dayofmonth("ts").cast("bigint").alias("run_no"),
        F.col("event_id").alias("conv_id"),
        (F.col("event_id") % 50 + 2).alias("n_tokens"),
        (F.col("value") / 100).alias("mean_loss"),
    )


def training_log(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select(
        F.col("user_id").alias("run"),
        F.col("event_id").alias("step"),
        F.col("value").alias("eval_loss"),
        F.col("event_type").isin("view", "click", "purchase").alias("saved"),
    )


# --- Text repair and preparation ------------------------------------------


@query
def clean_utterance_turns(spark, d):
    return turns(spark, d).select("conv_id", "turn", clean_utterance(F.col("text")).alias("content"))


@query
def clean_utterance_spaced(spark, d):
    """Repair of text with spaced punctuation, contractions and odd blanks put in."""
    spaced = F.regexp_replace("text", "([.,!?;:])", " $1")
    spaced = F.replace(spaced, F.lit("and"), F.lit("I ’ m “ s ”"))
    spaced = F.translate(spaced, "\n", "　")
    return turns(spark, d).select("conv_id", "turn", clean_utterance(spaced).alias("content"))


@query
def turns_to_dialogs(spark, d):
    return tables.turns_to_dialogs(turns(spark, d), CFG).select(
        "conv_id",
        F.size("dialog").cast("bigint").alias("n_turns"),
        F.array_join("dialog", "|").alias("joined"),
    )


@query
def prepare_messages(spark, d):
    return prepare.prepare_turns(turns(spark, d), CFG)


@query
def prepare_messages_docs(spark, d):
    return prepare.explode_messages(doc_convs(spark, d), CFG)


@query
def filter_funnel(spark, d):
    return prepare.filter_funnel(prepare.turn_stats(turns(spark, d), CFG), CFG)


@query
def filter_funnel_docs(spark, d):
    return prepare.filter_funnel(prepare.dialog_stats(dialogs(spark, d), CFG), CFG)


@query
def length_band_sweep(spark, d):
    return prepare.length_band_sweep(prepare.turn_band_prefixes(turns(spark, d), BANDS, CFG), BANDS, CFG)


@query
def length_band_sweep_docs(spark, d):
    return prepare.length_band_sweep(prepare.dialog_band_prefixes(dialogs(spark, d), BANDS), BANDS, CFG)


GRID = [(lo, 25 * hi) for lo in range(100) for hi in range(1, 101)]


def _grid(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(GRID, "min_chars bigint, max_chars bigint")


@query
def length_band_grid(spark, d):
    """Ten thousand bands over the turn table."""
    return prepare.length_band_grid(prepare.turn_staircases(turns(spark, d), CFG), _grid(spark))


@query
def length_band_grid_docs(spark, d):
    return prepare.length_band_grid(prepare.dialog_staircases(dialogs(spark, d), CFG), _grid(spark))


# --- Split ----------------------------------------------------------------


@query
def holdout_split(spark, d):
    ids = stage(doc_convs(spark, d).select("conv_id", "part"), "ids")
    return split.holdout_split(ids, CFG).select("conv_id", "split")


@query
def seeded_shuffle(spark, d):
    ids = stage(doc_convs(spark, d).where(F.col("part") == 0).select("conv_id"), "ids")
    return split.shuffle_position(ids)


@query
def shuffle_head(spark, d):
    return split.head_slice(doc_convs(spark, d).select("conv_id", n_messages()))


@query
def first_row(spark, d):
    return split.first_row(chat_convs(spark, d)).select(
        "conv_id", template.render_chat(F.col("messages")).alias("text")
    )


@query
def prepare_counts(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return split.prepare_counts(docs, doc_split(spark, d, n_messages()))


@query
def leak_audit(spark, d):
    hashed = split.content_hash(F.col("messages")).alias("content_hash")
    return split.leak_audit(doc_split(spark, d, hashed))


@query
def train_minus_val(spark, d):
    both = doc_split(spark, d, n_messages())
    return split.train_minus_val(both, both.where(F.col("split") == "val")).select("conv_id", "n_messages")


# --- Template -------------------------------------------------------------


@query
def render_chat(spark, d):
    return template.render(chat_convs(spark, d))


@query
def render_prompt(spark, d):
    return template.render(chat_convs(spark, d), add_generation_prompt=True)


@query
def render_chat_docs(spark, d):
    return template.render(doc_convs(spark, d))


@query
def bos_check(spark, d):
    """Texts over 1,000 characters get a second BOS."""
    texts = template.render(chat_convs(spark, d))
    doubled = F.when(F.length("text") > 1000, F.concat(F.lit(BOS), "text")).otherwise(F.col("text"))
    return template.bos_check(texts.withColumn("text", doubled)).select("conv_id", "one_bos")


@query
def reply_spans(spark, d):
    return template.span_rows(doc_convs(spark, d))


@query
def labeled_text(spark, d):
    return template.labeled_text(chat_convs(spark, d))


@query
def label_fraction(spark, d):
    return template.label_fraction(chat_convs(spark, d)).withColumn("fraction", F.round("fraction", 6))


@query
def label_total(spark, d):
    return template.label_total(doc_convs(spark, d)).withColumn("fraction", F.round("fraction", 6))


@query
def label_total_full(spark, d):
    """Trained on whole sequences."""
    return template.label_total(doc_convs(spark, d), replies_only=False).withColumn("fraction", F.round("fraction", 6))


def _five_char_tokens(texts: DataFrame) -> DataFrame:
    """A stand-in for a tokenizer: pieces of five characters, BOS is one. Adds ids and offsets."""
    pieces = texts.withColumn("pieces", F.regexp_extract_all("text", F.lit("(?s).{1,5}"), F.lit(0)))
    ids = F.transform("pieces", lambda p: F.when(p == BOS, BOS_ID).otherwise(F.ascii(p)))
    offsets = F.transform("pieces", lambda p, k: F.struct((k * 5).alias("start"), (k * 5 + F.length(p)).alias("end")))
    return pieces.select("*", ids.alias("ids"), offsets.alias("offsets")).drop("pieces")


def doc_tokens(spark: SparkSession, d: str) -> DataFrame:
    text = template.render_chat(F.col("messages"), with_bos=F.col("part") == 0)
    return _five_char_tokens(doc_convs(spark, d).withColumn("text", text))


@query
def token_mask(spark, d):
    masked = template.token_mask(doc_tokens(spark, d))
    return masked.select(
        "conv_id",
        "part",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.size("labeled_ids").cast("bigint").alias("labeled_tokens"),
        F.array_join(F.transform("assistant_masks", lambda m: m.cast("string")), "").alias("mask"),
        F.array_join(F.transform("labeled_ids", lambda i: i.cast("string")), ",").alias("labeled_ids"),
    )


@query
def token_bos_check(spark, d):
    """Texts over 1,000 characters get a second BOS."""
    texts = template.render(chat_convs(spark, d))
    doubled = F.when(F.length("text") > 1000, F.concat(F.lit(BOS), "text")).otherwise(F.col("text"))
    tokens = _five_char_tokens(texts.withColumn("text", doubled))
    return template.token_bos_check(tokens, BOS_ID).select("conv_id", "one_bos")


@query
def context_reply_pairs(spark, d):
    return template.context_reply_pairs(chat_convs(spark, d))


@query
def context_reply_pairs_window(spark, d):
    """Prompts of the last four messages."""
    return template.context_reply_pairs(chat_convs(spark, d), max_turns=4)


@query
def token_label_fraction(spark, d):
    fractions = template.token_label_fraction(doc_tokens(spark, d))
    return fractions.withColumn("fraction", F.round("fraction", 6))


@query
def token_label_total(spark, d):
    return template.token_label_total(doc_tokens(spark, d)).withColumn("fraction", F.round("fraction", 6))


# --- Sizing ---------------------------------------------------------------


@query
def train_plan(spark, d):
    return sizing.train_plan(doc_split(spark, d, n_messages()).where(F.col("split") == "train"))


@query
def length_profile(spark, d):
    profile = sizing.length_profile(sizing.with_units(doc_convs(spark, d)))
    return profile.withColumns({p: F.round(p, 6) for p in ("p50", "p90", "p99")})


@query
def batch_plan(spark, d):
    return sizing.batch_plan(train_lengths(spark, d))


@query
def pack_sequences(spark, d):
    return sizing.pack_sequences(train_lengths(spark, d))


@query
def pack_best_fit(spark, d):
    return sizing.pack_best_fit(train_lengths(spark, d), shard=1024)


@query
def length_sketches(spark, d):
    """Sketches of 64 parts of the corpus, stored, read back and merged; a sketch tells its number exactly, and quantiles nearly."""
    path = fresh_path(spark, "sketches")
    lengths = stage(sizing.with_units(doc_convs(spark, d)), "lengths")
    parts = lengths.withColumn("day", F.pmod(F.xxhash64("conv_id"), F.lit(64)))
    sizing.length_sketches(parts, ["day"]).write.parquet(path)
    merged = sizing.merged_profile(spark.read.parquet(path)).first()
    n, points = merged["conversations"], {q: merged[f"p{q}"] for q in (50, 90, 99)}
    counts = [F.count_if(F.col("n_units") < v).alias(f"below_{q}") for q, v in points.items()]
    counts += [F.count_if(F.col("n_units") <= v).alias(f"upto_{q}") for q, v in points.items()]
    near = lambda q: (F.col(f"below_{q}") <= n * (q / 100 + 0.02)) & (F.col(f"upto_{q}") >= n * (q / 100 - 0.02))
    told = [F.struct(F.lit(q).cast("bigint").alias("quantile"), near(q).alias("within")) for q in points]
    whole = [F.lit(merged[c]).cast("bigint").alias(c) for c in ("conversations", "units", "longest")]
    return lengths.agg(*counts).select(*whole, F.inline(F.array(*told)))


# --- Evaluation -----------------------------------------------------------


@query
def perplexity(spark, d):
    return evaluate.perplexity(run_losses(spark, d)).withColumn("perplexity", F.round("perplexity", 6))


@query
def perplexity_shifted(spark, d):
    shifted = evaluate.perplexity(run_losses(spark, d), shifted=True)
    return shifted.withColumn("perplexity", F.round("perplexity", 6))


@query
def run_trend(spark, d):
    trend = evaluate.run_trend(run_losses(spark, d))
    return trend.withColumns({c: F.round(c, 6) for c in ("perplexity", "change")})


def _ngram_losses(spark, d, n, replies_only=False):
    both = doc_split(spark, d)
    is_val = F.col("split") == "val"
    return evaluate.ngram_losses(both.where(~is_val), both.where(is_val), n, replies_only=replies_only)


@query
def ngram_losses(spark, d):
    return _ngram_losses(spark, d, 1).withColumn("mean_loss", F.round("mean_loss", 6))


@query
def ngram_losses_replies(spark, d):
    return _ngram_losses(spark, d, 1, replies_only=True).withColumn("mean_loss", F.round("mean_loss", 6))


@query
def ngram_perplexity(spark, d):
    losses = _ngram_losses(spark, d, 1)
    return evaluate.perplexity(losses).withColumn("perplexity", F.round("perplexity", 4))


@query
def bigram_perplexity(spark, d):
    losses = _ngram_losses(spark, d, 2)
    return evaluate.perplexity(losses).withColumn("perplexity", F.round("perplexity", 4))


@query
def best_checkpoint(spark, d):
    return evaluate.best_checkpoint(training_log(spark, d))


@query
def checkpoint_retention(spark, d):
    return evaluate.checkpoint_retention(training_log(spark, d))


@query
def eval_matrix(spark, d):
    runs = events(spark, d).select(F.col("user_id").alias("run")).distinct()
    return evaluate.eval_matrix(runs).withColumn("prompt_id", F.col("prompt_id").cast("bigint"))


@query
def extract_reply(spark, d):
    return audit.with_reply(raw_replies(spark, d)).select("run", "conv_id", "i", "reply")


@query
def side_by_side(spark, d):
    replies = audit.with_reply(raw_replies(spark, d))
    return evaluate.side_by_side(replies, "stopped", "assistant", ("conv_id", "i"))


@query
def stop_audit(spark, d):
    return audit.stop_audit(raw_replies(spark, d))


@query
def repeated_ngrams(spark, d):
    rates = audit.repeated_ngrams(audit.with_reply(raw_replies(spark, d)))
    return rates.withColumn("rate", F.round("rate", 6))


@query
def assistant_voice(spark, d):
    rates = audit.assistant_voice(audit.with_reply(raw_replies(spark, d)))
    return rates.withColumn("rate", F.round("rate", 6))


def phrase_table(spark: SparkSession, d: str) -> DataFrame:
    """The library's own phrases, and the first three words of each item of the benchmark and of each document."""
    words = lambda c: F.array_join(F.slice(F.split(F.btrim(c), " +"), 1, 3), " ")
    own = spark.createDataFrame([(p,) for p in ASSISTANT_PHRASES], "phrase string")
    items = spark.read.parquet(f"{d}/benchmark.parquet").select(words(F.col("text")).alias("phrase"))
    docs = spark.read.parquet(f"{d}/documents.parquet").select(words(F.col("text")).alias("phrase"))
    return own.unionByName(items).unionByName(docs).where(F.length("phrase") >= 8)


@query
def assistant_voice_table(spark, d):
    replies = audit.with_reply(raw_replies(spark, d))
    rates = audit.assistant_voice_table(replies, phrase_table(spark, d))
    return rates.withColumn("rate", F.round("rate", 6))


@query
def role_audit(spark, d):
    return audit.role_audit(turns(spark, d), cfg=CFG)


@query
def role_audit_events(spark, d):
    """Users as conversations, event types as roles: every violation occurs."""
    log = events(spark, d).select("user_id", "event_id", F.col("event_type").alias("role"))
    known, replying = ("view", "click", "purchase", "signup"), ("click", "purchase")
    return audit.role_audit(log, "user_id", "event_id", known, replying, CFG)


# --- Chat logs ------------------------------------------------------------


def _flat_history(rows: DataFrame, keep_from: bool = False) -> DataFrame:
    said = F.transform("history", lambda m: F.concat(m["role"], F.lit(":"), m["content"]))
    flat = rows.withColumn("history", F.array_join(said, "|"))
    return flat if keep_from else flat.drop("history_from")


@query
def chat_fold(spark, d):
    return chat.fold_log(event_log(events(spark, d)))


@query
def chat_history(spark, d):
    return _flat_history(chat.chat_history(event_log(events(spark, d))))


@query
def chat_history_exit(spark, d):
    return _flat_history(chat.chat_history(event_log(events(spark, d), exits=True)))


# --- Streams --------------------------------------------------------------


def _stream(spark: SparkSession, d: str, name: str, spread_by: str, batch_bytes: int) -> DataFrame:
    path = f"{d}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    if is_file(spark, path):
        return read_stream(spark, d, schema, spread_by, f"{name}.parquet", batch_bytes)
    return read_stream(spark, path, schema, spread_by, None, batch_bytes)


@query
def chat_history_stream_events(spark, d):
    log = event_log(_stream(spark, d, "events", "user_id", BATCH_BYTES))
    return _flat_history(settled(drain(chat_history_stream(log), "chat"), event_log(events(spark, d))))


#: Events arrive up to three days late, in so many files' worth of arrival.
LATEST_SECONDS = 3 * 86400
ARRIVALS = 6
FILE_ROWS = 1_000_000
#: A micro-batch takes the files of one arrival, up to so many.
BATCH_FILES = 64
#: A session that pauses for longer starts a new page.
IDLE_SECONDS = 86400
TIMED_LOG = "session bigint, seq bigint, role string, line string, ts timestamp"


def timed_log(rows: DataFrame) -> DataFrame:
    ts = F.col("ts").cast("timestamp").alias("ts")
    return event_log(rows.select("user_id", F.col("event_id"), "event_type", ts), "ts")


def _arrive(spark: SparkSession, d: str, path: str, parts: range) -> int:
    """Events in the order of arrival, up to LATEST_SECONDS after they happened, written part by part; the files of a part."""
    rows = timed_log(events(spark, d))
    first, last = rows.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    late = F.pmod(F.xxhash64("seq", F.lit("late")), F.lit(LATEST_SECONDS * 1_000_000))
    span = max(1, (last or 0) - (first or 0) + LATEST_SECONDS * 1_000_000)
    part = F.floor((F.unix_micros("ts") - F.lit(first) + late) * ARRIVALS / F.lit(span))
    files = max(1, rows.count() // (ARRIVALS * FILE_ROWS))
    for i in parts:
        rows.where(part == i).repartition(files).write.mode("append").parquet(path)
    return files


def _arriving(spark: SparkSession, path: str, files: int, idle_seconds: int | None = None) -> DataFrame:
    """An arrival in each micro-batch, so that there are as many however long the log is."""
    log = read_stream(spark, path, TIMED_LOG, "session", batch_files=min(files, BATCH_FILES))
    return chat_history_in_order(log, f"{LATEST_SECONDS} seconds", idle_seconds=idle_seconds)


@query
def chat_history_ordered_stream_events(spark, d):
    """Events in disorder, many micro-batches, folded as the watermark passes."""
    path = fresh_path(spark, "arrivals")
    files = _arrive(spark, d, path, range(ARRIVALS))
    close_log(spark, path, TIMED_LOG)
    # what the last row moves the watermark past comes out in a batch without data
    folded = drain(_arriving(spark, path, files), "chat-ordered", settings=STATE_STORE | {NO_DATA_BATCHES: "true"})
    return _flat_history(accepted(folded))


@query
def chat_history_idle_events(spark, d):
    return _flat_history(chat.chat_history(timed_log(events(spark, d)), idle_seconds=IDLE_SECONDS), keep_from=True)


@query
def chat_history_expiring_stream_events(spark, d):
    """As above, in two runs: the second goes on from the state of the first, with sessions that were idle deleted."""
    path, out, progress = (fresh_path(spark, f"expiring-{name}") for name in ("log", "out", "progress"))
    files = _arrive(spark, d, path, range(ARRIVALS // 2))
    stream = _arriving(spark, path, files, IDLE_SECONDS)
    advance(stream, out, progress, settings=STATE_STORE | {NO_DATA_BATCHES: "false"})
    _arrive(spark, d, path, range(ARRIVALS // 2, ARRIVALS))
    close_log(spark, path, TIMED_LOG)
    advance(_arriving(spark, path, files, IDLE_SECONDS), out, progress, settings=STATE_STORE | {NO_DATA_BATCHES: "true"})
    return _flat_history(accepted(advanced(spark, out, progress, stream.schema)), keep_from=True)


@query
def prepare_stream_docs(spark, d):
    docs = _stream(spark, d, "documents", "doc_id", STATELESS_BATCH_BYTES)
    arriving = tables.dialogs_from_text(docs, "doc_id", "text")
    return drain(prepare_stream(arriving, CFG), "prepared-stream").select("conv_id", "part", "text", "split")


@query
def prepare_stream_restarted_docs(spark, d):
    """Half of the files, a run, the other half, a second run with the same progress."""
    source, out, progress = (fresh_path(spark, f"restarted-{name}") for name in ("dialogs", "out", "progress"))
    half = F.pmod(F.xxhash64("conv_id"), F.lit(2))
    for part in (0, 1):
        dialogs(spark, d).where(half == part).write.mode("append").parquet(source)
        prepare_corpus_stream(spark, source, out, progress, CFG)
    schema = schemas.T.StructType([*schemas.CONVERSATION_LINES.fields, schemas.T.StructField("split", schemas.T.StringType())])
    prepared = advanced(spark, out, progress, schema, "json")
    return prepared.select("conv_id", "part", template.render_chat(F.col("messages"), with_bos=F.col("part") == 0).alias("text"), "split")


@query
def filter_funnel_observed(spark, d):
    """The funnel of the corpus job, summed while conversations are written, by micro-batch of a stream."""
    source, out, progress = (fresh_path(spark, f"observed-{name}") for name in ("dialogs", "out", "progress"))
    tables.turns_to_dialogs(turns(spark, d), CFG).select("conv_id", "dialog").write.parquet(source)
    prepare_corpus_stream(spark, source, out, progress, CFG)
    return stream_funnel(spark, out, progress)


# --- Files ----------------------------------------------------------------


@query
def jsonl_roundtrip(spark, d):
    path = fresh_path(spark, "lines")
    tables.write_messages(chat_convs(spark, d), path)
    return prepare.explode_messages(tables.read_messages(spark, path), CFG)


@query
def split_roundtrip(spark, d):
    path = fresh_path(spark, "splits")
    tables.write_messages(doc_split(spark, d), path)
    named = tables.read_splits(spark, {"train": f"{path}/split=train", "validation": f"{path}/split=val"})
    return named.select("split", "conv_id", n_messages())


@query
def split_pruning(spark, d):
    """Only the validation directory of a written corpus is read."""
    path = fresh_path(spark, "splits")
    tables.write_messages(doc_split(spark, d), path)
    val = tables.read_split_dir(spark, path).where(F.col("split") == "val")
    return template.render(val)


@query
def dialogs_roundtrip(spark, d):
    """Dialogues written as Parquet with an unused column, read back and prepared."""
    path = fresh_path(spark, "dialogs")
    tables.turns_to_dialogs(turns(spark, d), CFG).write.parquet(path)
    return prepare.explode_messages(prepare.prepare_dialogs(tables.read_dialogs(spark, path), CFG), CFG)


