"""Line dedup: two Bloom filters find suspected repeats, which alone are shuffled and confirmed exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.operators.lookup import lookup
from dialogprep.sources.storage import stage

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS_PER_HASH = 12
PROBES = 4
#: Hashes that the first level of a filter is made for; each further level is twice as large.
FIRST_LEVEL = 1 << 12
#: Second filters of up to so many bytes, all together, go to every task that reads lines.
SENT_BYTES = 64 << 20


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def drop_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Keep a line that many documents share only in the document with the largest id.

    Returns the columns of ``docs`` with ``text`` rewritten (null becomes empty) and two more, ``n_lines`` and
    ``n_dropped``. A key shorter than ``min_chars`` code points, or found in fewer than ``min_docs`` documents,
    loses nothing. A line repeated within the keeping document stays as often as it stands there.

    * The hashes of the keys, without texts, go to the owner of their range. It streams them through a filter of
      hashes seen once and one of hashes seen twice, and gives back the bits of the second. A filter errs only by
      naming a hash too many.
    * The second filters, if they are measured to be small, travel to the tasks that read the lines, which let
      only suspected ones go on. Larger ones stay with their owners, and the lines' hashes go there.
    * What is left is shuffled as SHA-256 of the key with the document's id, and counted in documents, with partial
      sums before the shuffle. Where the shared keys are too many to broadcast, those of hot keys are spread; so a line may
      stand in any share of all rows.
    * A document gets the list of its own lines to drop, which is never longer than the document.

    A null id is one document that sorts before all others, as do rows with the same id: they are one document.
    An empty table stays empty. Columns named as the added ones are replaced.
    """
    text = F.coalesce("text", F.lit(""))
    keys = F.transform(F.split(text, "\n", -1), line_key)
    long_keys = F.array_distinct(F.filter(keys, lambda k: F.length(k) >= min_chars))
    lines = docs.select("doc_id", F.explode(long_keys).alias("key")).select("doc_id", "key", F.xxhash64("key").alias("h"))

    repeats = suspected(lines).groupBy(F.unhex(F.sha2("key", 256)).alias("d"), "doc_id").agg(F.lit(1).alias("one"))
    repeats = stage(repeats.select("d", "doc_id"), "repeats")
    shared = repeats.groupBy("d").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
    shared = stage(shared.where(F.col("n") >= min_docs).select("d", "keeper", F.lit(True).alias("is_shared")), "shared")
    lost = lookup(repeats, shared, ["d"], "doc_id").where(F.col("is_shared") & ~F.col("doc_id").eqNullSafe(F.col("keeper")))
    lost = lost.groupBy(F.col("doc_id").alias("__lost_id")).agg(F.collect_set("d").alias("__lost"))

    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    found = docs.select(*own).join(lost, F.col("doc_id").eqNullSafe(F.col("__lost_id")), "left")
    key = lambda line: line_key(line)
    stays = lambda line: (F.length(key(line)) < min_chars) | ~F.array_contains(F.col("__lost"), F.unhex(F.sha2(key(line), 256)))
    found = found.withColumn("__lines", F.split(text, "\n", -1))
    found = found.withColumn("__kept", F.when(F.col("__lost").isNull(), F.col("__lines")).otherwise(F.filter("__lines", stays)))
    n_lines = F.size("__lines").cast("long")
    return found.select(
        *[F.array_join("__kept", "\n").alias(c) if c == "text" else F.col(c) for c in own],
        n_lines.alias("n_lines"),
        (n_lines - F.size("__kept")).alias("n_dropped"),
    )


def suspected(lines: DataFrame, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """The rows of (doc_id, key, h) whose hash occurs twice, and few others. Only hashes are shuffled."""
    spark = lines.sparkSession
    owners = int(spark.conf.get("spark.sql.shuffle.partitions"))
    filters = stage(second_filters(lines.select("h"), owners), "second-filters")
    if (filters.agg(F.sum(F.length("bits"))).first()[0] or 0) <= sent_bytes:
        levels: dict[int, list[bytes]] = {}
        for row in filters.toLocalIterator():
            levels.setdefault(row["owner"], []).append(bytes(row["bits"]))
        sent = spark.sparkContext.broadcast(levels)

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = {owner: Filter.of(own) for owner, own in sent.value.items()}
            for batch in batches:
                h = batch.column("h").to_numpy()
                by_owner, told = h % owners, np.zeros(len(h), dtype=bool)
                order = np.argsort(by_owner, kind="stable")
                begin = np.flatnonzero(np.append(True, np.diff(by_owner[order]) != 0)) if len(h) else []
                for a, b in zip(begin, [*begin[1:], len(h)], strict=True):
                    if own := known.get(int(by_owner[order[a]])):
                        told[order[a:b]] = own.has(h[order[a:b]])
                yield batch.filter(pa.array(told))

        return lines.mapInArrow(probe, lines.schema)
    asked = lines.select("doc_id", "key", "h", F.lit(None).cast("binary").alias("bits"), _owner(owners).alias("owner"))
    none = [F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in ("doc_id", "key", "h")]
    rows = filters.select(*none, "bits", "owner").unionByName(asked)
    rows = rows.repartitionById(owners, "owner").sortWithinPartitions("owner", F.col("bits").isNull())
    return rows.mapInArrow(_probe_at_owner, lines.schema)


def _owner(owners: int) -> Column:
    return F.pmod("h", F.lit(owners)).cast("int")


def second_filters(hashes: DataFrame, owners: int) -> DataFrame:
    """(owner, level, bits): of each owner the filter of hashes seen twice, a row for each level.

    A task first folds equal hashes of a batch into one row, so a hash that a third of all rows share reaches
    its owner once a batch.
    """
    folded = hashes.mapInArrow(_fold, "h long, n long").withColumn("owner", _owner(owners))
    return folded.repartitionById(owners, "owner").mapInArrow(lambda batches: _seen_twice(batches, owners), "owner int, level int, bits binary")


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h, n = np.unique(batch.column(0).to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], ["h", "n"])


def _seen_twice(batches: Iterator[pa.RecordBatch], owners: int) -> Iterator[pa.RecordBatch]:
    """One pass; what is held are the bits of the two filters."""
    once, twice, owner = Filter(), Filter(), None
    for batch in batches:
        h, n = batch.column("h").to_numpy(), batch.column("n").to_numpy()
        if len(h):
            owner = int(h[0] % owners)
            order = np.argsort(h, kind="stable")
            own, first, times = np.unique(h[order], return_index=True, return_counts=True)
            twice.add(own[(times > 1) | (np.maximum.reduceat(n[order], first) > 1) | once.has(own)])
            once.add(own)
    for level, bloom in enumerate(twice.levels):
        if bloom.held:
            columns = [pa.array([owner], pa.int32()), pa.array([level], pa.int32()), pa.array([bloom.words.tobytes()])]
            yield pa.RecordBatch.from_arrays(columns, ["owner", "level", "bits"])


def _probe_at_owner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of bits come before the lines of the partition."""
    levels: list[bytes] = []
    known = None
    for batch in batches:
        bits = batch.column("bits")
        levels += [b for b in bits.to_pylist() if b is not None]
        asked = batch.filter(bits.is_null()).select(["doc_id", "key", "h"])
        if asked.num_rows:
            known = known or Filter.of(levels)
            yield asked.filter(pa.array(known.has(asked.column("h").to_numpy())))


class Bloom:
    """A Bloom filter over 64-bit hashes that are random already."""

    def __init__(self, expected: int, words: bytes | None = None) -> None:
        self.room, self.held = expected, 0
        bits = 1 << max(10, int(expected * BITS_PER_HASH - 1).bit_length())
        self.words = np.zeros(bits // 8, dtype=np.uint8) if words is None else np.frombuffer(words, dtype=np.uint8)
        self.mask = np.uint64(len(self.words) * 8 - 1)

    def _bits(self, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        h = hashes.astype(np.int64).view(np.uint64)
        step = (h >> np.uint64(33)) | np.uint64(1)
        for i in range(PROBES):
            at = (h + np.uint64(i) * step * np.uint64(0x9E3779B97F4A7C15)) & self.mask
            yield (at >> np.uint64(3)).astype(np.int64), np.left_shift(np.uint8(1), (at & np.uint64(7)).astype(np.uint8))

    def add(self, hashes: np.ndarray) -> None:
        self.held += len(hashes)
        for word, bit in self._bits(hashes):
            np.bitwise_or.at(self.words, word, bit)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), dtype=bool)
        for word, bit in self._bits(hashes):
            found &= (self.words[word] & bit) != 0
        return found


class Filter:
    """A Bloom filter that grows with what it holds: when a level is full, one of twice its size follows."""

    def __init__(self, levels: list[Bloom] | None = None) -> None:
        self.levels = [Bloom(FIRST_LEVEL)] if levels is None else levels

    @classmethod
    def of(cls, bits: list[bytes]) -> Filter:
        return cls([Bloom(0, words) for words in bits])

    def add(self, hashes: np.ndarray) -> None:
        new = hashes[~self.has(hashes)]
        while len(new):
            last = self.levels[-1]
            if last.held >= last.room:
                last = Bloom(2 * last.room)
                self.levels.append(last)
            room = last.room - last.held
            last.add(new[:room])
            new = new[room:]

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.zeros(len(hashes), dtype=bool)
        for level in self.levels:
            found |= level.has(hashes)
        return found
