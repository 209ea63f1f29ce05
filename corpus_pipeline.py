"""The training-data pipeline: five stages over documents, each one of the operators in dialogprep.llm."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogprep.llm import lines, packing, pii, simhash, toxicity
from dialogprep.llm.common import table
from dialogprep.llm.queries import END_OF_DOCUMENT, ENGLISH, ship
from dialogprep.sources.storage import stage


def _measured(docs: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, with ``n_chars`` counted anew where there is one."""
    return docs.select(*[F.length("text").cast(like.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in like.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. Learned from the labels of documents that are still here."""
    ship(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them."""
    ship(spark)
    return _measured(lines.drop_repeated_lines(docs), docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: runs of three words, fingerprints at most three bits apart."""
    ship(spark)
    return simhash.drop_near_duplicates(docs, words=3)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and terms that disclose it, are replaced by their kinds."""
    return _measured(pii.sanitise(docs), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of packed sequences."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path(ENGLISH), END_OF_DOCUMENT)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash", drop_copies),
    ("pii", sanitise),
    ("packing", pack),
]

#: SQL has no models, no XXH64 and no tokenizer; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what a stage returns is written once and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, name)
    return docs
