"""Document fingerprints: sums of wide vectors that stand for paragraphs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogprep.llm.common import chunks, texts
from dialogprep.llm.ordered import range_of, range_starts

#: A paragraph's vector has 4 parts modulo 2**64, which decide equality, and 256 parts modulo 2**32 for likeness.
WIDE = 4
LIKE = 256
SHINGLE = 3
STEP = 0x9E3779B97F4A7C15
INVERSE = pow(STEP, -1, 1 << 64)


def fingerprint(many: list[str]) -> np.ndarray:
    """A row of WIDE * 8 + LIKE * 4 bytes for each text.

    A text is the multiset of its paragraphs, which end at line ends; the empty text has one, an empty one. The first
    WIDE numbers of a paragraph are its BLAKE2b digest. The others are a sum of their own, over the paragraph's
    3-word shingles (all its words, where it has fewer): each adds 1 or -1 to one part that its hash names.
    All sums are modular, so the order of paragraphs does not matter, and two fingerprints can be added and
    subtracted like the multisets.
    """
    out = np.zeros((len(many), WIDE * 8 + LIKE * 4), dtype=np.uint8)
    wide, doc = [], []
    for i, text in enumerate(many):
        own = [hashlib.blake2b(p.encode(), digest_size=WIDE * 8).digest() for p in text.split("\n")]
        wide += own
        doc += [i] * len(own)
    sums = np.zeros((len(many), WIDE), dtype=np.uint64)
    np.add.at(sums, np.array(doc, dtype=np.int64), np.frombuffer(b"".join(wide), dtype="<u8").reshape(-1, WIDE))
    out[:, : WIDE * 8] = sums.astype("<u8").view(np.uint8).reshape(len(many), -1)
    doc, hashes = shingles(many)
    if len(hashes):
        part = doc * LIKE + (hashes & np.uint64(LIKE - 1)).astype(np.int64)
        sign = 1 - 2 * ((hashes >> np.uint64(32)) & np.uint64(1)).astype(np.int64)
        like = np.bincount(part, weights=sign, minlength=len(many) * LIKE).astype(np.int64)
        out[:, WIDE * 8 :] = like.astype("<u4").view(np.uint8).reshape(len(many), -1)
    return out


def shingles(many: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The number of its text and a 64-bit hash of each shingle of all texts.

    A word's hash is a polynomial of its bytes, taken out of running sums over all texts at once.
    """
    coded = [t.encode() for t in many]
    raw = np.frombuffer(b"\n".join([*coded, b""]), dtype=np.uint8)
    if not len(raw):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    space = raw <= 32
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    power = np.full(len(raw) + 1, STEP, dtype=np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw + np.uint64(1)) * power[:-1], dtype=np.uint64, out=sums[1:])
    back = np.full(len(raw) + 1, INVERSE, dtype=np.uint64)
    back[0] = 1
    back = np.cumprod(back, dtype=np.uint64)
    word = _mix((sums[end] - sums[start]) * back[start])
    paragraph = np.cumsum(raw == 10)[start] if len(start) else np.empty(0, np.int64)
    doc = np.searchsorted(np.cumsum([len(c) + 1 for c in coded]), start, side="right")
    n = len(word)
    opens = np.concatenate([[True], paragraph[1:] != paragraph[:-1]]) if n else np.empty(0, bool)
    hashes, whole, alive = word, np.ones(n, dtype=bool), np.ones(n, dtype=bool)
    for k in range(1, SHINGLE):
        same = np.zeros(n, dtype=bool)
        same[: n - k] = paragraph[k:] == paragraph[: n - k]
        alive = alive & same
        hashes = np.where(alive, _mix(hashes + np.concatenate([word[k:], word[:k]])), hashes)
        whole = alive
    keep = whole | opens
    return doc[keep], hashes[keep]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 less the squared distance of the shingle sums, as a share of the sum of their squares; within 0 and 1.

    About the share of shingles, by number, that two texts have in common. Equal fingerprints have 1.
    """
    like = lambda x: np.ascontiguousarray(x[:, WIDE * 8 :]).view("<i4").astype(np.float64)
    square = lambda x: np.square(x).sum(axis=1)
    apart, both = square(like(a) - like(b)), square(like(a)) + square(like(b))
    near = np.clip(1 - apart / np.maximum(both, 1), 0, 1)
    near[both == 0] = 0
    near[(a == b).all(axis=1)] = 1
    return near


def added(a: str, b: str) -> str:
    """The fingerprint of the paragraphs of both."""
    return _combined(a, b, 1)


def removed(a: str, b: str) -> str:
    """The fingerprint of the paragraphs of a without those of b."""
    return _combined(a, b, -1)


def _combined(a: str, b: str, sign: int) -> str:
    x, y = (np.frombuffer(bytes.fromhex(v), dtype=np.uint8) for v in (a, b))
    n = WIDE * 8
    parts = [x[at].view(kind) + y[at].view(kind) * np.array(sign).astype(kind) for at, kind in ((slice(n), "<u8"), (slice(n, None), "<u4"))]
    return b"".join(p.tobytes() for p in parts).hex()


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint): the hex form of each text's fingerprint, in the rows' own tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            hexes = [row.tobytes().hex() for row in fingerprint(texts(batch))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(hexes, pa.string())], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint string")


EDIT_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_edit(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint against that of an edit and that of the next document.

    The edit replaces the last half of the code points by as many of the start of the next document in ascending
    doc_id; after the last comes the first. Rows with the same id follow each other by text. A row with a null
    id has no place in the order and is its own next document, as is the only row of a table. A null text is
    empty. An empty table gives an empty result. Other columns are not read.

    Texts are shuffled once, to their range of ids. The first document of a range also goes to the range before
    it, so each task finds the document after its last one at the end of its own rows.
    """
    starts = range_starts(docs)
    n = max(1, len(starts))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("range", range_of(starts))
    opens = F.col("doc_id").isin(starts) if n <= 32 else _opens(starts)
    place = lambda number, guest: F.struct(number.alias("range"), F.lit(guest).alias("guest"))
    before = F.pmod(F.col("range") - 1, F.lit(n)).cast("int")
    places = F.when(F.coalesce(opens, F.lit(False)), F.array(place(F.col("range"), False), place(before, True))).otherwise(F.array(place(F.col("range"), False)))
    rows = rows.select("doc_id", "text", F.explode(places).alias("at")).select("doc_id", "text", "at.range", "at.guest")
    rows = rows.repartitionById(n, "range").sortWithinPartitions("guest", F.asc_nulls_first("doc_id"), "text")
    return rows.select("doc_id", "text", "guest").mapInArrow(_against_next, EDIT_SCHEMA)


def _opens(starts: list[int]) -> F.Column:
    edges = np.array(starts, dtype=np.int64)

    @F.pandas_udf("boolean")
    def opens(ids):  # noqa: ANN001, ANN202
        import pandas as pd

        known = ids.notna()
        return pd.Series(np.isin(ids.fillna(0).to_numpy(dtype=np.int64), edges) & known.to_numpy())

    return opens(F.col("doc_id"))


def _against_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: tuple | None = None  # the last row, which waits for the next one
    done = False
    for batch in chunks(batches):
        if done:
            continue
        ids, many, guests = batch.column("doc_id").to_pylist(), texts(batch), batch.column("guest").to_pylist()
        prints = fingerprint(many)
        rows = []
        for i, text, guest, own in zip(ids, many, guests, prints, strict=True):
            if i is None:
                if not guest:
                    rows.append((i, text, own, text, own))
                continue
            if held:
                rows.append((*held, text, own))
            held = (i, text, own)
            if guest:
                held, done = None, True
                break
        if rows:
            yield _edits(rows)


def _edits(rows: list[tuple]) -> pa.RecordBatch:
    half = [len(text) // 2 for _, text, _, _, _ in rows]
    edited = [text[: len(text) - k] + after[:k] for (_, text, _, after, _), k in zip(rows, half, strict=True)]
    own, after, edit = np.stack([r[2] for r in rows]), np.stack([r[4] for r in rows]), fingerprint(edited)
    columns = [
        pa.array([r[0] for r in rows], pa.int64()),
        pa.array([len(r[1]) for r in rows], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
        pa.array([x.tobytes().hex() for x in own], pa.string()),
        pa.array([x.tobytes().hex() for x in edit], pa.string()),
        pa.array(likeness(own, edit)),
        pa.array(likeness(own, after)),
    ]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in EDIT_SCHEMA.split(", ")])
