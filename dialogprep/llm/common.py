"""Reading tables, cutting Arrow batches and finding connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogprep.sources.storage import stage

CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about ``limit`` bytes of text; a longer text is a slice of its own.

    What an operator holds at once does not depend on how many rows Arrow puts in a batch.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a slice, null as the empty text."""
    return pc.fill_null(batch.column(column), "").to_pylist()


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Rows kept out of all learning; a null id is held out as well."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node of the undirected links; root is the smallest node reached.

    Alternating large-star and small-star steps, each made of a minimum per node and a join with it, so that no
    list of neighbours is ever held: a node may have any number of links. Every step is a table in the shared
    folder, which cuts the lineage. Links with a null end and loops link nothing.
    """
    edges = stage(_down(links.select(F.col(a).alias("u"), F.col(b).alias("v"))), "links")
    seen = _state(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(_down(large), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(_down(small.unionByName(least.select("u", F.col("m").alias("v")))), "small-star")
        now = _state(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _down(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger end to the smaller."""
    u, v = F.greatest("u", "v"), F.least("u", "v")
    return edges.where(F.col("u") != F.col("v")).select(u.alias("u"), v.alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    x = F.xxhash64("u", "v")
    row = edges.agg(F.count("*"), F.bit_xor(x), F.sum(F.shiftright(x, 20))).first()
    return tuple(row)
