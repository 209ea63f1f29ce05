"""Token-ID files: ids in shards of Re-Pair grammars, read back document by document."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dialogprep.llm.common import chunks, texts
from dialogprep.llm.ordered import range_of, range_starts
from dialogprep.llm.tokens import TEXT_BYTES, word_tokenizer

#: Ids of a block, but for one longer document. Each block has its own grammar.
BLOCK_IDS = 1 << 19
#: Places a pair must have to be worth a rule. Two symbols and a length are written for it, 6.25 bytes, and a symbol of
#: 2.125 bytes is saved at each place: three places save nothing once the codec has seen both.
LEAST = 4

SCHEMA = (
    "shard int, block int, n_tokens long, first_rule int, doc_ids array<long>, doc_tokens array<long>, doc_ends array<long>, "
    "rules binary, rules_high binary, lengths binary, lengths_high binary, coded binary, coded_high binary"
)


@dataclass
class Grammar:
    """Symbol ``first + i`` is rule i: two symbols, each an id or an earlier rule, and in the end ``lengths[i]`` ids."""

    first: int
    rules: np.ndarray
    lengths: np.ndarray

    def sizes(self, coded: np.ndarray) -> np.ndarray:
        """How many ids each symbol stands for."""
        rule = coded >= self.first
        out = np.ones(len(coded), dtype=np.int64)
        out[rule] = self.lengths[coded[rule] - self.first]
        return out

    def expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """All symbols written out as ids, one after the other, and where each begins."""
        out = list(_ids_alone(self.first))
        for left, right in self.rules.tolist():
            out.append(out[left] + out[right])
        starts = np.concatenate([np.arange(self.first), self.first + np.cumsum(self.lengths) - self.lengths])
        return np.frombuffer(b"".join(out), dtype="<u4"), starts

    def decode(self, coded: np.ndarray, sizes: np.ndarray | None = None) -> np.ndarray:
        """The ids that the symbols stand for, as unsigned 32-bit integers; ``sizes`` are those of the symbols, if known."""
        flat, starts = self.expansions()
        sizes = self.sizes(coded) if sizes is None else sizes
        ends = np.cumsum(sizes)
        kind = np.int32 if max(len(flat), int(ends[-1]) if len(ends) else 0) < 1 << 31 else np.int64
        at = np.repeat((starts[coded] - (ends - sizes)).astype(kind), sizes)
        at += np.arange(len(at), dtype=kind)
        return flat[at]

    def at(self, coded: np.ndarray, position: int) -> int:
        """The id at a position, found by lengths alone, without decoding what stands before."""
        ends = np.cumsum(self.sizes(coded))
        i = int(np.searchsorted(ends, position, side="right"))
        symbol, position = int(coded[i]), position - (int(ends[i - 1]) if i else 0)
        while symbol >= self.first:
            left, right = self.rules[symbol - self.first].tolist()
            size = int(self.lengths[left - self.first]) if left >= self.first else 1
            symbol, position = (left, position) if position < size else (right, position - size)
        return symbol


@cache
def _ids_alone(n: int) -> list[bytes]:
    raw = np.arange(n, dtype="<u4").tobytes()
    return [raw[i : i + 4] for i in range(0, len(raw), 4)]


def compress(ids: np.ndarray, last: np.ndarray, first_rule: int | None = None, least: int = LEAST) -> tuple[Grammar, np.ndarray, np.ndarray]:
    """(grammar, coded, positions in ``coded`` after each place of ``last``).

    ``last`` are the places of the documents' last ids; no pair reaches over one, so a document is a slice of
    ``coded``. Pairs are counted exactly and replaced until none has ``least`` places: from then on a rule would
    take more room than it saves. A round replaces many pairs at once. Of places that share a symbol, that of the
    more frequent pair comes first, then that of the smaller pair; a pair that is left with fewer than ``least``
    places by that waits for the next round. In a run of one symbol every second place counts. A pair
    that once has too few places never has more, as its symbols are made no more; so a round looks only at
    places beside new symbols and at those that were frequent before.
    """
    symbols = np.array(ids, dtype=np.int32)
    first = int(symbols.max(initial=0)) + 1 if first_rule is None else first_rule
    ends = np.zeros(len(symbols) + 1, dtype=bool)
    ends[np.asarray(last) + 1] = True  # before which a document begins
    alive = np.flatnonzero(~ends[1 : len(symbols)]).astype(np.int32)
    rules, lengths = [np.empty((0, 2), np.int64)], np.empty(0, dtype=np.int64)
    while True:
        places, pair, own, count, spare = _frequent(symbols, alive, least)
        if not len(places):
            break
        # a place gives way to that of a more frequent pair beside it, or of the smaller pair
        rank = np.empty(len(count), dtype=np.int32)
        rank[np.argsort(-count, kind="stable")] = np.arange(len(count), dtype=np.int32)
        rank = rank[own]
        beside, ahead = places[1:] == places[:-1] + 1, rank[1:] < rank[:-1]
        wins = np.ones(len(places), dtype=bool)
        wins[:-1] &= ~(beside & ahead)
        wins[1:] &= ahead | ~beside
        chosen = np.bincount(own[wins], minlength=len(count)) >= least
        take = wins & chosen[own]
        here, made = places[take], (first + len(lengths) - 1 + np.cumsum(chosen)).astype(np.int32)[own[take]]
        pair, known = pair[chosen], np.append(lengths, 1)
        lengths = np.concatenate([lengths, known[np.where(pair < first, len(lengths), pair - first)].sum(axis=1)])
        rules.append(pair)
        # the places that are left, and where they are when the second symbols are gone
        used = np.zeros(len(symbols) + 1, dtype=bool)
        used[here + 1] = True
        symbols[here] = made
        moved = np.cumsum(used, dtype=np.int32)
        waiting = np.concatenate([places[~take], spare])
        waiting = waiting[~(used[waiting] | used[waiting + 1])]
        waiting -= moved[waiting]
        fresh = here - moved[here]
        left = ~used
        symbols, ends = symbols[left[:-1]], ends[left]
        look = np.zeros(len(symbols) + 1, dtype=bool)
        for some in (waiting, fresh, fresh - 1):
            look[some] = True  # the place before the first is the one behind the last, which is not looked at
        alive = np.flatnonzero(look[: len(symbols) - 1] & ~ends[1 : len(symbols)]).astype(np.int32)
    return Grammar(first, np.concatenate(rules), lengths), symbols.astype(np.int64), np.flatnonzero(ends[1:]) + 1


def _frequent(symbols: np.ndarray, places: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """The places, in order, of pairs with ``least`` of them; their different pairs, each place's pair, counts.

    Places in a run of one symbol overlap; every second one counts, the others come last.
    """
    left, right = symbols[places], symbols[places + 1]
    same = np.flatnonzero(left == right)
    spare = places[:0]
    if len(same):
        run = places[same]
        begin = np.flatnonzero(np.append(True, (np.diff(run) != 1) | (symbols[run[1:]] != symbols[run[:-1]])))
        inside = np.arange(len(run)) - np.repeat(begin, np.diff(np.append(begin, len(run))))
        odd = same[inside % 2 == 1]
        if len(odd):
            spare = places[odd]
            even = np.ones(len(places), dtype=bool)
            even[odd] = False
            places, left, right = places[even], left[even], right[even]
    bits, at = int(symbols.max(initial=0)).bit_length(), max(1, len(places)).bit_length()
    key = left.astype(np.int64)
    key <<= bits
    key |= right
    if 2 * bits + at < 63:  # sorted with their places in one number
        key <<= at
        key |= np.arange(len(places), dtype=np.int64)
        key.sort()
        order = (key & ((1 << at) - 1)).astype(np.int32)
        key >>= at
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
    edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, np.int64)
    count = np.diff(edges)
    enough = count >= least
    often = np.flatnonzero(enough)
    pairs, sizes = key[edges[often]], count[often]
    own = np.full(len(key), -1, dtype=np.int32)
    own[order[np.repeat(enough, count)]] = np.repeat(np.arange(len(often), dtype=np.int32), sizes)
    told = own >= 0
    return places[told], np.stack([pairs >> bits, pairs & ((1 << bits) - 1)], axis=1), own[told], sizes, spare


def write_documents(docs: DataFrame, path: str, folder: str, end_id: int, block_ids: int = BLOCK_IDS) -> None:
    """Encode the texts, add ``end_id`` to each, and write them in ascending doc_id order as Parquet rows of SCHEMA.

    A row is a block: whole documents, their grammar, and where each document ends in ``coded``. Shards are
    ranges of ids, in order; texts are shuffled to their range once. A null text is empty. Rows with the same id
    follow each other by text. A row with a null id stands first in a shard chosen by its text. An empty table
    gives no block.
    """
    starts = range_starts(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("shard", range_of(starts)).repartitionById(max(1, len(starts)), "shard")
    rows = rows.sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_tokenizer(path)
        end = int(end_id).to_bytes(own.dtype.itemsize, "little")
        held, size, block = [], 0, 0
        for batch in chunks(batches, limit=TEXT_BYTES):
            ids = own.encode_all(texts(batch))
            for doc_id, raw, shard in zip(batch.column("doc_id").to_pylist(), ids, batch.column("shard").to_pylist(), strict=True):
                n = len(raw) // own.dtype.itemsize + 1
                if held and size + n > block_ids:
                    yield _block(block, held, own.size)
                    held, size, block = [], 0, block + 1
                held.append((doc_id, shard, np.frombuffer(raw + end, dtype=own.dtype)))
                size += n
        if held:
            yield _block(block, held, own.size)

    rows.mapInArrow(run, SCHEMA).write.parquet(folder, compression="zstd")


def _block(number: int, held: list[tuple], first_rule: int) -> pa.RecordBatch:
    n = np.array([len(ids) for _, _, ids in held], dtype=np.int64)
    grammar, coded, ends = compress(np.concatenate([ids for _, _, ids in held]), np.cumsum(n) - 1, first_rule)
    planes = [*_planes(grammar.rules.ravel()), *_planes(grammar.lengths), *_planes(coded)]
    values = [held[0][1], number, int(n.sum()), first_rule, [d for d, _, _ in held], n.tolist(), ends.tolist(), *planes]
    longs = pa.list_(pa.int64())
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), longs, longs, longs, *[pa.binary()] * 6]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], [f.split()[0] for f in SCHEMA.split(", ")])


def _planes(symbols: np.ndarray) -> tuple[bytes, bytes]:
    """The low two bytes of each number, and the bits above them, a plane of packed bits for each."""
    high = symbols >> 16
    planes = [np.packbits((high >> bit) & 1).tobytes() for bit in range(int(high.max(initial=0)).bit_length())]
    return (symbols & 0xFFFF).astype("<u2").tobytes(), b"".join(planes)


def _numbers(low: bytes, high: bytes) -> np.ndarray:
    out = np.frombuffer(low, dtype="<u2").astype(np.int64)
    if high:
        for bit, plane in enumerate(np.frombuffer(high, dtype=np.uint8).reshape(-1, -(-len(out) // 8))):
            out |= np.unpackbits(plane, count=len(out)).astype(np.int64) << (16 + bit)
    return out


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, block, doc_id, before, n_tokens, ids): the documents of the files; ``before`` counts the block's ids before.

    A row for each row that was written, those with null or repeated ids too; ids are little-endian unsigned
    32-bit integers. Files of an empty table give no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rules, lengths, coded = (_numbers(row[c], row[f"{c}_high"]) for c in ("rules", "lengths", "coded"))
                grammar = Grammar(row["first_rule"], rules.reshape(-1, 2), lengths)
                sizes = grammar.sizes(coded)
                ids = grammar.decode(coded, sizes)
                # a document's ids are a slice of the block's: those of the symbols up to its end
                edges = np.append(0, np.cumsum(sizes)[np.array(row["doc_ends"], dtype=np.int64) - 1])
                buffers = [None, pa.py_buffer((4 * edges).astype(np.int64)), pa.py_buffer(ids)]
                n = len(edges) - 1
                raw = pa.Array.from_buffers(pa.large_binary(), n, buffers).cast(pa.binary())
                columns = [pa.array([row["shard"]] * n, pa.int32()), pa.array([row["block"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(edges[:-1]), pa.array(np.diff(edges)), raw]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "block", "doc_id", "before", "n_tokens", "ids"])

    schema = "shard int, block int, doc_id long, before long, n_tokens long, ids binary"
    return spark.read.schema(SCHEMA).parquet(folder).mapInArrow(run, schema)


def block_starts(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, block, first): the ids of all documents before each block; reads three small columns."""
    blocks = spark.read.schema(SCHEMA).parquet(folder).select("shard", "block", "n_tokens")
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("of_shard"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("of_block", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return blocks.join(shards, "shard").select("shard", "block", (F.col("of_shard") + F.col("of_block")).alias("first"))
