"""Command line: ``spark-submit`` or ``python -m dialogprep <job> ...``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogprep.config import PrepareConfig
from dialogprep.operators import audit, evaluate, sizing, split, template
from dialogprep.operators.chat import chat_history
from dialogprep.plans.corpus import fold_chat_stream, prepare_corpus, prepare_corpus_stream, stream_funnel
from dialogprep.sources.tables import read_split_dir, require_inputs


def _show(title: str, df: DataFrame, n: int = 50) -> None:
    print(f"\n== {title}")
    df.show(n, truncate=False)


def _config(args: argparse.Namespace) -> PrepareConfig:
    return PrepareConfig(
        min_chars=args.min_chars,
        max_chars=args.max_chars,
        min_turns=args.min_turns,
        val_fraction=args.val_fraction,
        seed=args.seed,
    )


def prepare(spark: SparkSession, args: argparse.Namespace) -> None:
    print(json.dumps(prepare_corpus(spark, args.source, args.target, args.layout, _config(args), with_funnel=True)))


def _progress(args: argparse.Namespace) -> str:
    return args.progress or f"{args.target.rstrip('/')}/_progress"


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Dialogue files that have come since the last run."""
    prepare_corpus_stream(spark, args.source, args.target, _progress(args), _config(args))
    _show("conversations so far", stream_funnel(spark, args.target, _progress(args)))


def chat(spark: SparkSession, args: argparse.Namespace) -> None:
    """Histories of a log, at once or of what has come since the last run."""
    require_inputs(spark, [args.log])
    if args.delay:
        fold_chat_stream(spark, args.log, args.target, _progress(args), args.delay, args.idle_seconds)
    else:
        chat_history(spark.read.parquet(args.log), idle_seconds=args.idle_seconds).write.parquet(args.target)


def inspect(spark: SparkSession, args: argparse.Namespace) -> None:
    """Format checks on every row, and one example in full."""
    require_inputs(spark, [args.corpus])
    train = read_split_dir(spark, args.corpus).where(F.col("split") == "train")
    example = split.first_row(train)
    _show("first conversation", template.render(example))
    _show("trained-on text", template.labeled_text(example))
    _show("training pairs", template.context_reply_pairs(example))
    checked = template.bos_check(template.render(train))
    _show("opens with exactly one BOS", checked.groupBy("one_bos").count())
    _show("trained-on share", template.label_total(train))


def plan(spark: SparkSession, args: argparse.Namespace) -> None:
    require_inputs(spark, [args.corpus])
    train = read_split_dir(spark, args.corpus).where(F.col("split") == "train")
    _show("steps", sizing.train_plan(train))
    _show("lengths", sizing.length_profile(sizing.with_units(train), exact=False))


def evaluate_runs(spark: SparkSession, args: argparse.Namespace) -> None:
    """Tables ``(run, conv_id, n_tokens, mean_loss)`` and ``(run, prompt_id, raw)``."""
    require_inputs(spark, [p for p in (args.losses, args.replies) if p])
    if args.losses:
        _show("perplexity", evaluate.perplexity(spark.read.parquet(args.losses)))
    if args.replies:
        raw = spark.read.parquet(args.replies)
        replies = audit.with_reply(raw)
        _show("stops", audit.stop_audit(raw))
        _show("repeated n-grams", audit.repeated_ngrams(replies))
        _show("assistant voice", audit.assistant_voice(replies))
        if args.compare:
            _show("side by side", evaluate.side_by_side(replies, *args.compare))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="dialogprep")
    jobs = top.add_subparsers(required=True)
    defaults = PrepareConfig()

    def preparing(name: str, text: str) -> argparse.ArgumentParser:
        job = jobs.add_parser(name, help=text)
        job.add_argument("source")
        job.add_argument("target")
        job.add_argument("--min-chars", type=int, default=defaults.min_chars)
        job.add_argument("--max-chars", type=int, default=defaults.max_chars)
        job.add_argument("--min-turns", type=int, default=defaults.min_turns)
        job.add_argument("--val-fraction", type=float, default=defaults.val_fraction)
        job.add_argument("--seed", type=int, default=defaults.seed)
        return job

    job = preparing("prepare", "dialogues to split JSON lines")
    job.add_argument("--layout", choices=("dialogs", "turns"), default="dialogs")
    job.set_defaults(run=prepare)

    job = preparing("stream", "the same for files as they come; run it again for more")
    job.add_argument("--progress", help="where the run left off; in the target by default")
    job.set_defaults(run=stream)

    job = jobs.add_parser("chat", help="chat log to histories")
    job.add_argument("log")
    job.add_argument("target")
    job.add_argument("--delay", help="how late rows may come, as '1 hour': the log is a stream with a column ts")
    job.add_argument("--idle-seconds", type=int, help="a longer pause starts a new page")
    job.add_argument("--progress", help="where the run left off; in the target by default")
    job.set_defaults(run=chat)

    for name, run, text in (
        ("inspect", inspect, "what training will see"),
        ("plan", plan, "how big a training run is"),
    ):
        job = jobs.add_parser(name, help=text)
        job.add_argument("corpus")
        job.set_defaults(run=run)

    job = jobs.add_parser("evaluate", help="perplexity and reply audits")
    job.add_argument("--losses")
    job.add_argument("--replies")
    job.add_argument("--compare", nargs=2, metavar=("RUN_A", "RUN_B"))
    job.set_defaults(run=evaluate_runs)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(SparkSession.builder.appName("dialogprep").getOrCreate(), args)


if __name__ == "__main__":
    main()
