"""Byte-level BPE: a segment tree per piece gives the leftmost pair of least rank."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from dialogprep.llm.common import chunks, texts

NO_RANK = np.int64(1) << 60
#: Byte positions that one call of merge_pieces() holds at a time.
POSITIONS = 1 << 18
#: From this many bytes on, a piece is merged by itself; both ways give the same ids.
LONG_PIECE = 512
#: Encoded words a Python worker remembers. It forgets none and learns no more when full.
REMEMBERED = 1 << 18


class Encoder:
    """Ranks of byte strings, and the ranks of all pairs of them that join to another."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.split = regex.compile(pattern).findall
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.first = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pair = pairs
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.joined = np.array([pairs[p] for p in self.pairs.tolist()], dtype=np.int64)
        self.known: dict[str, bytes] = {}

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NO_RANK where there is none; a negative id pairs with nothing."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (left >= 0) & (right >= 0), self.joined[at], NO_RANK)

    def encode(self, text: str) -> np.ndarray:
        """The ids of one text."""
        return self.encode_all([text])[0]

    def encode_all(self, many: list[str]) -> list[np.ndarray]:
        """The ids of each text. Cuts at single spaces are cuts of the pattern; what lies between is remembered."""
        words = [word_keys(text) for text in many]
        known = self.known
        fresh = set().union(*words).difference(known)
        spelled = [[p.encode() for p in self.split(word_of(w))] for w in fresh]
        pieces = {p: self.ranks.get(p) for own in spelled for p in own}
        ids = {p: np.array([r]).astype("<u4").tobytes() for p, r in pieces.items() if r is not None}
        ids |= merge_pieces(self, [p for p, r in pieces.items() if r is None])
        known.update((w, b"".join([ids[p] for p in own])) for w, own in zip(fresh, spelled, strict=True))
        out = [np.frombuffer(b"".join(map(known.__getitem__, own)), dtype="<u4") for own in words]
        forget(known, fresh, REMEMBERED)
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


#: White space other than spaces and line ends, and the sign that marks a key as a whole piece.
ODD = re.compile(r"[^\S \n]|\0")


def word_keys(text: str) -> list[str]:
    """The text cut before single spaces and line ends that follow a visible character, as keys of word_of().

    A match of the pattern that takes white space along starts at the first white space of its run, so each of
    these places starts a match. A longer run of white space stays whole with what follows.
    """
    spread = text.replace("\n", " \n")
    odd = not spread.replace("\n", "").isprintable() and ODD.search(text)
    if odd or "  " in spread or "\n " in spread or spread[:1] in ("", " ") or spread[-1] in " \n":
        return ["\0" + w for w in _careful(text)]
    keys = spread.split(" ")
    keys[0] = "\0" + keys[0]
    return keys


def word_of(key: str) -> str:
    """A key is a word without its space, or starts with a line end, or is a piece behind a zero."""
    return key[1:] if key[0] == "\0" else key if key[0] == "\n" else " " + key


def _careful(text: str) -> list[str]:
    out, held = [], ""
    for piece in re.split("(?=[ \n])", text):
        if held and not held[-1].isspace():
            out.append(held)
            held = piece
        else:
            held += piece
    return [*out, held] if held else out


def merge_pieces(enc: Encoder, pieces: list[bytes]) -> dict[bytes, bytes]:
    """Each piece's ids as little-endian unsigned 32-bit integers.

    Pieces of similar length stand side by side as rows, each with its own tree. A node holds rank * width +
    position of the least pair below it, so the root names the leftmost pair of least rank. A merge changes the
    pair of the joined part, the pair before it and the pair it used up: three paths from leaf to root.
    """
    out = {p: _merge_long(enc, p) for p in pieces if len(p) >= LONG_PIECE}
    by_width: dict[int, list[bytes]] = {}
    for p in pieces:
        if p not in out:
            by_width.setdefault(max(8, 1 << (len(p) - 1).bit_length()), []).append(p)
    for width, own in by_width.items():
        rows = max(1, POSITIONS // width)
        for i in range(0, len(own), rows):
            part = own[i : i + rows]
            out.update(zip(part, _merge_rows(enc, part, width), strict=True))
    return out


def _merge_rows(enc: Encoder, pieces: list[bytes], width: int) -> list[bytes]:
    n = len(pieces)
    lengths = np.array([len(p) for p in pieces])
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(n, width)
    # columns 0 and width + 1 stand for the ends
    ids = np.full((n, width + 2), -1, dtype=np.int64)
    inside = np.arange(width) < lengths[:, None]
    ids[:, 1:-1] = np.where(inside, enc.first[raw], -1)
    after = np.tile(np.arange(1, width + 3), (n, 1))
    before = np.tile(np.arange(-1, width + 1), (n, 1))
    tree = np.full((n, 2 * width), NO_RANK, dtype=np.int64)
    ranks = enc.pair_ranks(ids[:, 1:-1].ravel(), ids[:, 2:].ravel()).reshape(n, width)
    tree[:, width:] = np.where(ranks == NO_RANK, NO_RANK, ranks * width + np.arange(width))
    level = width
    while level > 1:
        level //= 2
        tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])

    def leaf(row: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        ok = at > 0
        row, at = row[ok], at[ok]
        rank = enc.pair_ranks(left[ok], right[ok])
        node = at - 1 + width
        tree[row, node] = np.where(rank == NO_RANK, NO_RANK, rank * width + at - 1)
        while len(node) and node[0] > 1:
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    row = np.flatnonzero(tree[:, 1] < NO_RANK)
    while len(row):
        rank, at = np.divmod(tree[row, 1], width)
        at += 1
        used = after[row, at]
        behind, prior = after[row, used], before[row, at]
        ids[row, at], ids[row, used] = rank, -1
        after[row, at], before[row, behind] = behind, at
        gone = np.full(len(row), -1)
        leaf(row, used, gone, gone)
        leaf(row, at, rank, ids[row, behind])
        leaf(row, prior, ids[row, prior], rank)
        row = row[tree[row, 1] < NO_RANK]
    live = ids >= 0
    flat, ends = ids[live].astype("<u4").tobytes(), np.cumsum(live.sum(axis=1)) * 4
    return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def _merge_long(enc: Encoder, piece: bytes) -> bytes:
    """The same tree for one long piece, in plain integers."""
    n, none = len(piece), 1 << 60
    width = 1 << (n - 1).bit_length()
    ids = [*enc.first[np.frombuffer(piece, dtype=np.uint8)].tolist(), -1]
    after, before = list(range(1, n + 2)), list(range(-1, n))
    rank_of = enc.pair.get
    leaves = [rank_of(ids[i] << 32 | ids[i + 1]) if i + 1 < n else None for i in range(n)]
    tree = [none] * width + [none if r is None else r * width + i for i, r in enumerate(leaves)] + [none] * (width - n)
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(at: int, value: int) -> None:
        node = at + width
        tree[node] = value
        while node > 1:
            a, b = tree[node], tree[node ^ 1]
            node >>= 1
            least = a if a < b else b
            if tree[node] == least:
                return
            tree[node] = least

    while tree[1] < none:
        rank, at = divmod(tree[1], width)
        used, prior = after[at], before[at]
        behind = after[used]
        ids[at], ids[used], after[at] = rank, -1, behind
        put(used, none)
        joined = None
        if behind < n:
            before[behind] = at
            joined = rank_of(rank << 32 | ids[behind])
        put(at, none if joined is None else joined * width + at)
        if prior >= 0:
            joined = rank_of(ids[prior] << 32 | rank)
            put(prior, none if joined is None else joined * width + prior)
    return np.array([i for i in ids if i >= 0]).astype("<u4").tobytes()


def forget(known: dict, fresh: Iterable[str], limit: int) -> None:
    """Drop what was just learned if that is too much, or too long to come again."""
    full = len(known) > limit
    for w in fresh:
        if full or len(w) > 64:
            del known[w]


@cache
def encoder(path: str, pattern: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(path, pattern)


def encode_texts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) of each text, in the rows' own tasks; null or empty: no ids.

    ``path`` is a rank file that every executor has. Rows are not moved. Each row gives a row, also with a null
    or repeated id. Other columns are not read. A text of any length is encoded whole, in time n log n.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for batch in chunks(batches):
            ids = enc.encode_all(texts(batch))
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = pa.array(np.concatenate([np.empty(0, "<u4"), *ids]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), flat)], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {_type(docs)}, ids array<int>")


def decode_ids(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, bytes binary) of each row of (doc_id, ids); null ids give null, an id outside the file fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for batch in batches:
            raw = [None if ids is None else enc.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(raw, pa.binary())], ["doc_id", "bytes"])

    return coded.select("doc_id", "ids").mapInArrow(run, f"doc_id {_type(coded)}, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): texts encoded, and the ids decoded again.

    Both in one task, so that no ids are moved; the digests are of the ids and of the decoded bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        names = [str(i) for i in range(len(enc.bytes_of))]
        digest = lambda raw: hashlib.sha256(raw).hexdigest()
        for batch in chunks(batches):
            n, coded, decoded = [], [], []
            for ids in map(np.ndarray.tolist, enc.encode_all(texts(batch))):
                n.append(len(ids))
                coded.append(digest(",".join(map(names.__getitem__, ids)).encode()))
                decoded.append(digest(enc.decode(ids)))
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = f"doc_id {_type(docs)}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _type(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()
