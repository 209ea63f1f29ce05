"""Packing: deficit round-robin over the sources' queues fills windows of tokens in given proportions."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dialogprep.llm.common import chunks, texts
from dialogprep.llm.tokens import TEXT_BYTES, forget_tokenizers, word_tokenizer
from dialogprep.sources.storage import stage

WINDOW = 1024
#: What a queue sends at once. A source's share of a window is off by one packet at most while its queue lasts.
PACKET = 256
#: Tokens that one task holds at a time.
BUCKET_TOKENS = 2_000_000

#: Pieces that leave a task together, at most 4 MB of ids.
PIECES_AT_ONCE = 1024

PIECES = "doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def tokenise(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, source, task, row, n, ids): each text's ids and ``end_id``, once, as a table in the shared folder.

    Ids have as many bytes as the tokenizer's greatest needs, two or four. (task, row) names the row for good, also where ids are null or repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task, row = word_tokenizer(path), TaskContext.get().partitionId(), 0
        size = own.dtype.itemsize
        end = int(end_id).to_bytes(size, "little")
        for batch in chunks(batches, limit=TEXT_BYTES):
            ids = [i + end for i in own.encode_all(texts(batch))]
            n = np.array([len(i) // size for i in ids], dtype=np.int64)
            columns = [batch.column("doc_id"), batch.column("source"), pa.array(np.full(len(ids), task)), pa.array(np.arange(row, row + len(ids))), pa.array(n), pa.array(ids, pa.binary())]
            row += len(ids)
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "source", "task", "row", "n", "ids"])

    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(source, F.lit("")).alias("source"), "text")
    return stage(rows.mapInArrow(run, "doc_id long, source string, task long, row long, n long, ids binary"), "token-ids")


def pack(docs: DataFrame, path: str, end_id: int = 0, window: int = WINDOW, packet: int = PACKET, weights: dict[str, float] | None = None, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """Pieces of documents in sequences of ``window`` tokens: PIECES, one row a piece.

    A document is its ids and ``end_id``; a null text is empty and has the latter alone. Each id lies in one piece.
    ``ids`` are the piece's, as little-endian unsigned 32-bit integers; ``start`` counts the document's ids
    before it and ``offset`` the sequence's.

    Documents are dealt into buckets at random, so each holds the sources much as the corpus does. In a bucket
    every source has a queue. The queues take turns: each turn adds the source's share of a window to its
    deficit, which the queue spends in packets; what it can't spend, it keeps for later windows. A bucket starts
    with the deficits that the buckets before it leave: the targets of all their tokens less what they held.
    ``weights`` are target shares by source, by default the corpus's own; a source not named there counts with
    its own share. Once only some queues have tokens left, the others' shares go to these.

    What remains at a bucket's end, less than a window, is cut into sequences whose lengths are powers of two, so
    no sequence needs padding. A null source is the empty name. Rows with null or repeated ids are packed each
    for itself. An empty table gives no pieces. Other columns are not read.
    """
    rows = tokenise(docs, path, end_id)
    sums = rows.groupBy("source").agg(F.sum("n").alias("tokens"))
    total = rows.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // bucket_tokens))
    share = F.col("tokens") / F.lit(float(max(total, 1)))
    if weights:
        named = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
        share = F.coalesce(named[F.col("source")].cast("double"), share)
    targets = sums.select("source", share.alias("weight"))
    bucket = F.pmod(F.xxhash64("task", "row"), F.lit(buckets))
    held = rows.groupBy(bucket.alias("bucket"), "source").agg(F.sum("n").alias("tokens"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    every = held.groupBy("bucket").agg(F.sum("tokens").alias("all")).withColumn("all_before", F.coalesce(F.sum("all").over(before), F.lit(0)))
    own = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("own_before", F.coalesce(F.sum("tokens").over(own), F.lit(0))).join(every, "bucket").join(targets, "source")
    null = lambda kind: F.lit(None).cast(kind)
    heads = held.select("bucket", F.lit(-1).cast("long").alias("task"), F.lit(0).cast("long").alias("row"), "source", "weight", (F.col("weight") * F.col("all_before") - F.col("own_before")).alias("deficit"), null("long").alias("doc_id"), null("int").alias("size"), null("binary").alias("ids"))
    body = rows.select(bucket.alias("bucket"), "task", "row", "source", null("double").alias("weight"), null("double").alias("deficit"), "doc_id", (F.length("ids") / F.col("n")).cast("int").alias("size"), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_tokenizers()
        now: Bucket | None = None
        for batch in chunks(batches, "ids"):
            columns = [batch.column(c).to_pylist() for c in ("bucket", "task", "source", "weight", "deficit", "doc_id", "size", "ids")]
            for number, task, source, weight, deficit, doc_id, size, ids in zip(*columns, strict=True):
                if now is None or now.number != number:
                    if now:
                        yield from now.packed()
                    now = Bucket(number, window, packet)
                if task < 0:
                    now.open(source, weight, deficit)
                else:
                    now.size = size
                    now.queues[source].append([doc_id, ids, 0])
        if now:
            yield from now.packed()

    dealt = heads.unionByName(body).repartition("bucket").sortWithinPartitions("bucket", "task", "row", "source")
    return dealt.mapInArrow(run, PIECES)


class Bucket:
    """The queues of one bucket, and the sequences made of them."""

    def __init__(self, number: int, window: int, packet: int, size: int = 2) -> None:
        self.number, self.window, self.packet, self.size = number, window, packet, size  # bytes of an id
        self.queues: dict[str, deque] = {}
        self.weight: dict[str, float] = {}
        self.deficit: dict[str, float] = {}

    def open(self, source: str, weight: float, deficit: float) -> None:
        self.queues[source] = deque()
        self.weight[source], self.deficit[source] = max(weight, 1e-9), deficit

    def served(self) -> Iterator[tuple]:
        """(source, doc_id, ids, start, length) in the order of the round-robin."""
        active = [s for s in self.queues if self.queues[s]]
        while active:
            need = {s: min(self.packet, len(self.queues[s][0][1]) // self.size - self.queues[s][0][2]) for s in active}
            # turns in which no queue could send are taken at once
            turns = max(1.0, min(np.ceil((need[s] - self.deficit[s]) / (self.weight[s] * self.window)) for s in active))
            for s in active:
                self.deficit[s] += turns * self.weight[s] * self.window
                queue = self.queues[s]
                while queue:
                    doc_id, ids, start = queue[0]
                    length = min(self.packet, len(ids) // self.size - start)
                    if length > self.deficit[s]:
                        break
                    # packets of one document that follow each other are one piece
                    whole = min(len(ids) // self.size - start, int(self.deficit[s] // self.packet) * self.packet or length)
                    self.deficit[s] -= whole
                    if start + whole == len(ids) // self.size:
                        queue.popleft()
                    else:
                        queue[0][2] = start + whole
                    yield s, doc_id, ids, start, whole
            active = [s for s in active if self.queues[s]]

    def packed(self) -> Iterator[pa.RecordBatch]:
        left = sum(len(ids) // self.size for q in self.queues.values() for _, ids, _ in q)
        sequence, room, offset, out = self.number << 24, min(self.window, left), 0, []
        if left < self.window:
            room = _power(left)
        for source, doc_id, ids, start, length in self.served():
            total = len(ids) // self.size
            while length:
                take = min(length, room - offset)
                own = np.frombuffer(ids, f"<u{self.size}", take, start * self.size).astype("<u4").tobytes()
                out.append((doc_id, source, start, take, total, sequence, offset, own))
                start, length, offset, left = start + take, length - take, offset + take, left - take
                if offset == room:
                    sequence, offset = sequence + 1, 0
                    room = self.window if left >= self.window else _power(left)
            if len(out) >= PIECES_AT_ONCE:
                yield _pieces(out)
                out = []
        if out:
            yield _pieces(out)


def _power(n: int) -> int:
    """The greatest power of two not above n; 0 for 0."""
    return 1 << (n.bit_length() - 1) if n else 0


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), *[pa.int64()] * 5, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split()[0] for f in PIECES.split(", ")])
