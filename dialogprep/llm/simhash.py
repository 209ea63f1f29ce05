"""SimHash near-dedup: fingerprints meet at Golay codewords near their segments."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogprep.llm.common import chunks, components, texts
from dialogprep.sources.storage import stage

MAX_BITS = 3
SEED = 42
#: The generator polynomial of the binary Golay code of length 23, and its number of check bits.
GENERATOR = 0b110001110101
CHECKS = 11
LENGTH = 23
#: The three segments of a fingerprint, low bits first; each fits in a Golay word.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Members of a key that one task compares with each other. Larger keys are compared block by block.
DENSE = 8192
#: Members of a key that are all compared at once.
FEW = 8


def simhash(many: Iterable[str], words: int = 3) -> np.ndarray:
    """The fingerprint of each text, as unsigned 64-bit integers.

    A-Z are lower-cased and words end at ASCII white space. The XXH64 hashes of all runs of ``words`` words vote on
    each bit, which is 1 if more than half of them have it. Fewer words are one run; no word gives 0.
    """
    return np.array([_majority(shingle_hashes(text, words)) for text in many], dtype=np.uint64)


def shingle_hashes(text: str, words: int) -> np.ndarray:
    own = text.encode().lower().split()
    n = len(own) - words + 1
    joined = b" ".join(own)
    if n < 1:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)] if own else [], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[words - 1 :].tolist(), strict=True)], dtype=np.uint64)


def _majority(hashes: np.ndarray) -> int:
    votes = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


@cache
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(remainder of the low and high bits of a word, error patterns by remainder, their number).

    The first pattern has weight 3 at most and leads to the nearest codeword; the others have weight 4.
    """

    def remainder(word: int) -> int:
        for bit in range(LENGTH - 1, CHECKS - 1, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - CHECKS)
        return word

    low = np.array([remainder(x) for x in range(1 << 12)], dtype=np.int64)
    high = np.array([remainder(x << 12) for x in range(1 << CHECKS)], dtype=np.int64)
    found: list[list[int]] = [[] for _ in range(1 << CHECKS)]
    for weight in range(5):
        for bits in combinations(range(LENGTH), weight):
            word = sum(1 << b for b in bits)
            found[low[word & 4095] ^ high[word >> 12]].append(word)
    most = max(map(len, found))
    patterns = np.array([p + [0] * (most - len(p)) for p in found], dtype=np.int64)
    return np.stack([low, np.pad(high, (0, 2048))]), patterns, np.array([len(p) for p in found], dtype=np.int64)


def codewords(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The indices of all codewords within 4 bits of each segment, nearest first, and which of them there are.

    The nearest is within 3 bits, as the code is perfect. So of two segments that differ in one bit, either has
    the nearest of the other among its own.
    """
    remainder, patterns, number = golay()
    syndrome = remainder[0][segment & 4095] ^ remainder[1][segment >> 12]
    near = (segment[:, None] ^ patterns[syndrome]) >> CHECKS
    return near, np.arange(near.shape[1]) < number[syndrome][:, None]


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position of the fingerprint, key, whether it is a home key) of all keys of the fingerprints.

    Of two fingerprints at most 3 bits apart, over three segments: if a segment is equal, one of the two others
    has an error at most, so (equal segment, codeword of the other) meets, for one of six orders. Else each
    segment has one error, one half of the second and one of the third are equal, and (codeword of the first,
    these halves) meets, for one of four choices. A codeword meets as the nearest of one and any of the other:
    at a key, one of the two is at home.
    """
    x = prints.astype(np.uint64)
    part = [((x >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
    near = [codewords(p) for p in part]
    rows, out, home = [], [], []

    def put(tag: int, fixed: np.ndarray, at: int) -> None:
        index, there = near[at]
        row, column = np.nonzero(there)
        rows.append(row)
        out.append(np.int64(tag) << 40 | fixed[row] << 12 | index[row, column])
        home.append(column == 0)

    for tag, (i, j) in enumerate((i, j) for i in range(3) for j in range(3) if i != j):
        put(tag, part[i], j)
    half = lambda p, high: p >> 10 if high else (p & 1023)
    for tag in range(4):
        put(6 + tag, half(part[1], tag & 1) << 11 | half(part[2], tag >> 1), 0)
    return np.concatenate(rows), np.concatenate(out), np.concatenate(home)


def near_links(nodes: DataFrame, max_bits: int, dense: int = DENSE) -> DataFrame:
    """(a, b): links that join all nodes at most ``max_bits`` apart that meet at a key; each is true, not all are told.

    ``nodes`` has (node long, print binary), one row a fingerprint. The groups of these
    links are those of all such pairs, and n members of a key are joined by less than n links. A key with more
    than ``dense`` members is cut in blocks and each pair of blocks becomes a key: no pair is left out.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, node, prints, home in _whole_keys(batches, dense):
            a, b = _links(key, node, prints, home, max_bits, dense)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    rows = _key_rows(nodes)
    found = rows.repartition("key").sortWithinPartitions("key").mapInArrow(meet, "a long, b long")
    found = stage(found.distinct(), "met")
    links = found.where(F.col("b").isNotNull())
    crowded = found.where(F.col("b").isNull()).select(F.col("a").alias("key"))
    if crowded.isEmpty():
        return links
    pairs = _block_rows(rows.join(crowded, "key", "left_semi"), dense).repartition("key").sortWithinPartitions("key")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, node, prints, home in _whole_keys(batches, 1 << 40):
            a, b = _links(key, node, prints, home, max_bits, 1 << 40)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return links.unionByName(pairs.mapInArrow(compare, "a long, b long").distinct())


def _key_rows(nodes: DataFrame) -> DataFrame:
    """(key, node, print, home): a row for each key of each node."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 10_000):
                part = batch.slice(i, 10_000)
                node, prints = part.column(0).to_numpy(), _words64(part.column(1))
                row, key, home = keys(prints[:, 0])
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node[row]), _binary(prints[row]), pa.array(home)], names)

    names, schema = ["key", "node", "print", "home"], "key long, node long, print binary, home boolean"
    return nodes.select("node", "print").mapInArrow(spread, schema)


def _block_rows(rows: DataFrame, dense: int) -> DataFrame:
    """The rows of keys with each pair of blocks of a key as a key: every two members meet, at most ``dense`` or so at once."""
    others = [c for c in rows.columns if c != "key"]
    size = F.count("*")
    blocks = rows.groupBy("key").agg(F.when(size <= dense, F.lit(1).cast("long")).otherwise(F.ceil(size / F.lit(max(1, dense // 2)))).alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    pairs = rows.join(blocks, "key").select("key", *others, own.alias("own"), other.alias("other"))
    return pairs.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), *others)


def _words64(column: pa.Array) -> np.ndarray:
    """Equally long binary values as rows of 64-bit integers."""
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]]
    return raw.view(np.uint64).reshape(len(column), -1)


def _binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (8 * rows.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def _whole_keys(batches: Iterator[pa.RecordBatch], dense: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Sorted rows in slices that end with a key. Of a key over-full already, further rows are let go."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        more = [c.to_numpy(zero_copy_only=False) for c in batch.columns[3:]]
        now = (batch.column(0).to_numpy(), batch.column(1).to_numpy(), _words64(batch.column(2)), *more)
        if held:
            now = tuple(np.concatenate(x) for x in zip(held, now, strict=True))
        cut = int(np.searchsorted(now[0], now[0][-1]))
        if cut:
            yield tuple(x[:cut] for x in now)
        held = tuple(x[cut : cut + dense + 1] for x in now)
    if held:
        yield held


def _links(key: np.ndarray, node: np.ndarray, prints: np.ndarray, home: np.ndarray, max_bits: int, dense: int) -> tuple[pa.Array, pa.Array]:
    """Links within the keys of a slice. A link of a key's number with nothing says that the key is over-full.

    Whether an over-full key has a member at home is not known here, as rows of it were let go.
    """
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.concatenate([begin, [len(key)]]))
    some = (size > 1) & (np.add.reduceat(home.astype(np.int64), begin) > 0)
    crowded, few = size > dense, some & (size <= min(FEW, dense))
    a, b = [], []
    keep = np.repeat(few, size)
    k, n, p, h = key[keep], node[keep], prints[keep], home[keep]
    for lag in range(1, FEW):
        ok = np.flatnonzero((k[:-lag] == k[lag:]) & (h[:-lag] | h[lag:]) & (n[:-lag] != n[lag:]))
        ok = ok[_apart(p[ok], p[ok + lag]) <= max_bits]
        a.append(n[ok])
        b.append(n[ok + lag])
    for i in np.flatnonzero(some & ~few & ~crowded):
        own = slice(begin[i], begin[i] + size[i])
        x, y = _forest(node[own], prints[own], max_bits)
        a.append(x)
        b.append(y)
    a, b = np.concatenate(a), np.concatenate(b)
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
    full = key[begin[crowded]]
    return pa.array(np.concatenate([pairs[0], full])), pa.concat_arrays([pa.array(pairs[1]), pa.nulls(len(full), pa.int64())])


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)


def _forest(node: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links enough to join all members that chains of near ones join: one less than there are of them."""
    a, b = [], []
    while len(node):
        queue, node, prints = [(node[0], prints[0])], node[1:], prints[1:]
        while queue and len(node):
            one, own = queue.pop()
            near = _apart(prints, own) <= max_bits
            if near.any():
                a.append(np.full(near.sum(), one))
                b.append(node[near])
                queue.extend(zip(node[near], prints[near], strict=True))
                node, prints = node[~near], prints[~near]
    if not a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(a), np.concatenate(b)


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, print): the fingerprint as a signed long; null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(simhash(texts(batch), words).view(np.int64))], ["doc_id", "print"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, print long")


def near_duplicate_groups(docs: DataFrame, words: int = 3, dense: int = DENSE) -> DataFrame:
    """(doc_id, print, component_id) of every row; component_id is the least doc_id reached over links of 3 bits.

    Rows with equal fingerprints are one node from the start, so copies cost nothing after the first shuffle,
    which sums them up before it. A null text is empty: its fingerprint is 0 and links like any other. A row
    with a null id gives a row; the least id of its group is taken over the others, null where there are none.
    Rows with the same id are rows of their own. An empty table gives an empty result. Other columns are not read.
    """
    prints = stage(fingerprints(docs, words), "prints")
    nodes = prints.groupBy("print").agg(F.min("doc_id").alias("least"))
    wanted = nodes.select(F.col("print").alias("node"), _bytes_of("print").alias("print"))
    groups = components(near_links(wanted, MAX_BITS, dense), "a", "b")
    nodes = nodes.join(groups, nodes["print"] == groups["node"], "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = nodes.join(least, "root").select("print", "component_id")
    return prints.join(classes, "print").select("doc_id", "print", "component_id")


def _bytes_of(number: str) -> F.Column:
    """The 8 bytes of a long. Their order is of no account: no bit's place matters to the distance."""
    return F.unhex(F.lpad(F.hex(number), 16, "0"))


def drop_near_duplicates(docs: DataFrame, words: int = 3) -> DataFrame:
    """The columns of ``docs``, with one document of each group of near_duplicate_groups(): that with the least id.

    Rows with a null id stay, as do rows that share the least id of their group: they are one document. Texts
    without a word are a group, like any equal texts.
    """
    groups = near_duplicate_groups(docs, words)
    copies = groups.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("__copy")).distinct()
    return docs.join(copies, F.col("doc_id") == F.col("__copy"), "left_anti")
