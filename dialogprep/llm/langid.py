"""Language ID: code lengths under byte context trees with escapes (prediction by partial matching)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogprep.llm.common import chunks, held_out, texts

UNKNOWN = "und"
#: Texts are scored in blocks of so many bytes.
BLOCK = 1 << 19


@dataclass(frozen=True)
class ContextTrees:
    """Bits per byte, by context and language, of trees of order 2.

    ``row`` gives for two bytes the row of ``bits`` that holds what follows them: one of their own where any
    language has seen the pair, else that of the second byte alone.
    """

    languages: list[str]
    row: np.ndarray
    bits: np.ndarray

    def code_lengths(self, many: list[str]) -> np.ndarray:
        """Bits that each language needs for each whole text."""
        coded = [b"\0\0" + t.encode() for t in many]
        raw = np.frombuffer(b"".join(coded), dtype=np.uint8)
        sizes = np.array([len(c) for c in coded], dtype=np.int64)
        text_of = np.repeat(np.arange(len(many)), sizes)
        own = np.ones(len(raw), dtype=bool)
        first = np.cumsum(sizes) - sizes
        own[first] = own[first + 1] = False
        at = np.flatnonzero(own)
        out = np.zeros((len(many), len(self.languages)))
        for i in range(0, len(at), BLOCK):
            k = at[i : i + BLOCK]
            cost = self.bits[self.row[raw[k - 2].astype(np.int64) << 8 | raw[k - 1]], raw[k]]
            for j in range(out.shape[1]):
                out[:, j] += np.bincount(text_of[k], weights=cost[:, j], minlength=len(many))
        return out


def learn(rows: DataFrame) -> ContextTrees:
    """The trees of all rows of (text, lang) with a language; the counts are frozen from then on.

    Each task counts three-byte strings; what comes to the driver is one row for each such string and language,
    of which there are 2**24 at most and some thousands in prose, however long the input.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            many = texts(batch)
            for lang in sorted(set(langs.tolist())):
                raw = np.frombuffer(b"".join(b"\0\0" + many[i].encode() for i in np.flatnonzero(langs == lang)), dtype=np.uint8).astype(np.uint32)
                grams, n = np.unique(raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:], return_counts=True)
                # a string across two texts ends in one of the two zero bytes put before the second
                real = (grams & 255 != 0) | (grams >> 8 == 0)
                grams, n = grams[real & (grams & 0xFFFF != 0)], n[real & (grams & 0xFFFF != 0)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(grams.astype(np.int32)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    known = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", F.col("lang").cast("string").alias("lang"))
    counts = known.mapInArrow(run, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    return _trees(counts["lang"].to_numpy(), counts["gram"].to_numpy(dtype=np.int64), counts["n"].to_numpy(dtype=np.float64))


def _trees(lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> ContextTrees:
    """Escape method C: a context seen n times with q different bytes keeps q of n + q for bytes not seen there."""
    languages = sorted(set(lang.tolist()))
    pairs = np.unique(gram >> 8)
    row = np.tile(np.arange(256), 256)
    row[pairs] = 256 + np.arange(len(pairs))
    bits = np.zeros((256 + len(pairs), 256, len(languages)), dtype=np.float32)
    for j, name in enumerate(languages):
        own = lang == name
        two = np.zeros((len(pairs), 256))
        np.add.at(two, (np.searchsorted(pairs, gram[own] >> 8), gram[own] & 255), n[own])
        one = np.zeros((256, 256))
        np.add.at(one, pairs & 255, two)
        none = one.sum(axis=0)
        shorter = _extend(none[None, :], np.full((1, 256), 8.0))
        shorter = _extend(one, np.repeat(shorter, 256, axis=0))
        bits[:256, :, j] = shorter
        bits[256:, :, j] = _extend(two, shorter[pairs & 255])
    return ContextTrees(languages, row, bits)


def _extend(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    total, kinds = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        seen, escape = -np.log2(counts / (total + kinds)), -np.log2(kinds / (total + kinds))
    return np.where(total == 0, shorter, np.where(counts > 0, seen, escape + shorter))


def predict(docs: DataFrame, trees: ContextTrees) -> DataFrame:
    """(doc_id, lang_pred, score) of each row: the language that needs the fewest bits for the whole text.

    ``score`` is its share when each language is given 2 to the power of minus its bits. A null text, one without a
    letter, and any text where nothing was learned, is ``und`` with 0. Equal bits go to the first language by
    name. Rows are not moved; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)  # its size depends on languages and contexts alone
    letter = re.compile(r"[A-Za-z]").search

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in chunks(batches):
            many = texts(batch)
            written = [bool(own.languages) and bool(letter(t) or any(map(str.isalpha, t))) for t in many]
            names, score = [UNKNOWN] * len(many), np.zeros(len(many))
            if any(written):
                bits = own.code_lengths(many)
                best = bits.argmin(axis=1)
                share = 1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
                names = [own.languages[b] if w else UNKNOWN for b, w in zip(best, written, strict=True)]
                score = np.where(written, share, 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learned from the rows with a language that are not held out."""
    trees = learn(docs.where(~held_out()))
    return predict(docs, trees).withColumn("held_out", held_out()).select("doc_id", "held_out", "lang_pred", "score")
