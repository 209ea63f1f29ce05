"""The registered queries of the operators, one each, with the columns that their results are compared by."""

from __future__ import annotations

import shutil
import tempfile
from functools import cache
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogprep.llm import bpe, fingerprints, grammar, langid, lines, neighbours, packing, pii, runs, shards, simhash, toxicity, variants
from dialogprep.llm.common import held_out, table
from dialogprep.sources.storage import fresh_path

MULTI, ENGLISH = "byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json"
END_OF_DOCUMENT, END_OF_FILE_ENTRY = 0, 2


@cache
def _archive() -> str:
    """The package as an archive, for executors that don't have it."""
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="package-")
    return shutil.make_archive(f"{folder}/{root.name}", "zip", root.parent, root.name)


def ship(spark: SparkSession) -> None:
    """Make the package importable in Python workers, wherever they were started."""
    name = Path(_archive()).name
    if name not in spark.sparkContext._python_includes:
        spark.sparkContext.addPyFile(_archive())


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return table(spark, sf_dir, "documents")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_repeated_lines(_documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", F.col("n_dropped").cast("long").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_documents(spark, sf_dir), public_tokenizers.path(MULTI), public_tokenizers.PATTERN)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edit(_documents(spark, sf_dir))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicate_groups(_documents(spark, sf_dir))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    scorer = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, scorer)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_documents(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_documents(spark, sf_dir), public_tokenizers.path(ENGLISH), END_OF_DOCUMENT)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return neighbours.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "token-files")
    grammar.write_documents(_documents(spark, sf_dir), public_tokenizers.path(ENGLISH), folder, END_OF_FILE_ENTRY)
    read = grammar.read_documents(spark, folder).select("shard", "block", "doc_id", "before", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    rows = read.join(grammar.block_starts(spark, folder), ["shard", "block"])
    return rows.select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """In a tenth of the documents, chosen by the id, the words from one on become repeats of the words there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    docs = docs.withColumn("g", F.floor(h / 10)).withColumn("words", F.when(h % 10 == 0, words))
    planted = F.expr("transform(words, (w, i) -> if(i < a, w, words[cast(a + (i - a) % p as int)]))")
    docs = docs.withColumn("a", F.expr("if(size(words) > 0, g % size(words), null)")).withColumn("p", F.expr("1 + (size(words) - a) div (3 + g % 8)"))
    return docs.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(planted, " ")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(_with_planted_runs(_documents(spark, sf_dir).select("doc_id", "text")))
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    top = found.withColumn("top", runs.longest())
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2(runs.collapsed(), 256).alias("collapsed_sha256"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(variants.count_words(_documents(spark, sf_dir), min_chars=5, min_count=3, typo=97))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.shard(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=16)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return placed.select("doc_id", shards.size_of().alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_byte_bpe,
        op3_fingerprints,
        op4_simhash,
        op5_language,
        op6_toxicity,
        op7_pii,
        op8_packing,
        op9_embedding_dedup,
        op10_token_files,
        op11_periodic_runs,
        op12_spelling_variants,
        op13_sharding,
    )
}
