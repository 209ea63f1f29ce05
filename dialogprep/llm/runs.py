"""Periodic runs of words: tiles of each octave of periods, solved alone by Z-functions and stitched by document and period."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialogprep.llm.common import chunks, texts
from dialogprep.sources.storage import stage

#: Words of a group of tiles. A longer document is dealt out in such groups, a shorter one is solved where it is.
SPAN = 1 << 13
#: Bytes of a text that are cut into words at once.
CUT_BYTES = 1 << 20

#: Equals no word and no place outside of documents.
NOTHING = -(1 << 50)

WHITE = b" \t\n\x0b\x0c\r"
RUN = "struct<start: bigint, length: bigint, period: bigint>"


def word_ids(text: str) -> tuple[np.ndarray, int]:
    """(a number for each word, equal for equal words of the text; how many numbers)."""
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    parts = [np.fromiter(map(number.__getitem__, part), dtype=np.int32) for part in _words(text)]
    return (np.concatenate(parts) if parts else np.empty(0, np.int32)), len(number)


def _words(text: str) -> Iterator[list[bytes]]:
    """The words of a text, of about CUT_BYTES bytes at a time; bytes are split at ASCII white space alone."""
    raw = text.encode()
    start = 0
    while start < len(raw):
        end = start + CUT_BYTES
        while end < len(raw) and raw[end] not in WHITE:
            end += 1
        yield raw[start:end].split()
        start = end


def spacings(n_words: int, min_words: int) -> list[int]:
    """Spaces between boundaries, an octave each: periods from the space to twice it; the first takes all shorter ones too."""
    out, s = [], first_spacing(min_words)
    while not out or s <= n_words // 2:
        out.append(s)
        s *= 2
    return out


def first_spacing(min_words: int) -> int:
    """The largest power of two that any stretch of matches, at least half of ``min_words`` long, must step over."""
    return 1 << max(0, (max(min_words, 2) // 2).bit_length() - 1)


def z_function(s: list[int]) -> list[int]:
    """For each place, how many symbols from there on repeat the beginning."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def solve(words: np.ndarray, octaves: list[int], min_words: int, own: tuple[int, int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(periods, starts, ends) of stretches of places whose word stands again a period later.

    A run of period q and n words is a stretch of n - q such places, at least ``max(min_words - q, q)`` long, so it
    holds a boundary of q's octave. The tile around a boundary reaches two spaces back and four on. Two Z-functions
    tell how far words a period apart agree from the boundary to both sides; stretches that leave the tile are cut
    there and go on in the next one. Stretches of this call that meet are one. A tile is solved only if half a
    space of words beside the boundary stands again in it, which hashes of word sequences tell for all tiles at
    once. ``own``: the places whose boundaries are solved. Negative words equal nothing.
    """
    smallest, largest = octaves[0], octaves[-1]
    reach = max(2 * largest, min_words)
    pad = -(-reach // largest) * largest
    n = pad + -(-len(words) // largest) * largest + 2 * pad + 3 * largest
    w = np.arange(-n, 0, dtype=np.int64) - (1 << 40)  # what stands outside equals nothing
    w[pad : pad + len(words)] = words
    low, high = (pad, pad + len(words)) if own is None else (pad + own[0], pad + own[1])
    sequences, size = w.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1
    found: list[tuple[int, int, int]] = []
    for s in octaves:
        while size < max(1, s // 2):
            later = np.append(sequences[size:], np.zeros(size, np.uint64))
            sequences = (sequences ^ (sequences >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + later * np.uint64(0x94D049BB133111EB)
            size *= 2
        rows = n // s - 2
        on, back = sequences[: (rows + 1) * s].reshape(-1, s), sequences[s - size : s - size + rows * s].reshape(-1, s)
        again = on[1:] == on[:-1, :1]  # row i: boundary i * s
        again[1:] |= back[1:] == back[:-1, :1]
        if s == smallest:
            short = np.zeros((rows, s), dtype=bool)
            for q in range(1, s):
                short[:, q] = sequences[q : q + rows * s : s] == on[:-1, 0]
                short[1:, q] |= sequences[s - size + q : s - size + q + (rows - 1) * s : s] == back[:-1, 0]
        else:
            short = None
        tiles = again.any(axis=1)
        if short is not None:
            tiles |= short.any(axis=1)
        i = np.flatnonzero(tiles)
        for i in i[(i * s >= low) & (i * s < high)].tolist():
            periods = (np.flatnonzero(again[i]) + s).tolist()
            if short is not None:
                periods += np.flatnonzero(short[i]).tolist()
            found += _tile(w, i * s, s, max(2 * s, min_words), periods, min_words)
    if not found:
        return (np.empty(0, np.int64),) * 3
    q, start, end = np.array(sorted(found), dtype=np.int64).T
    new = np.append(True, (q[1:] != q[:-1]) | (start[1:] > end[:-1]))
    at = np.flatnonzero(new)
    return q[at], start[at] - pad, np.maximum.reduceat(end, at) - pad


def _tile(w: np.ndarray, b: int, s: int, reach: int, periods: list[int], min_words: int) -> list[tuple[int, int, int]]:
    """The stretches over boundary ``b`` of the given periods, cut at ``reach`` to both sides."""
    on = z_function(w[b : b + 2 * s + reach].tolist())
    before = w[max(0, b - reach) : b + 2 * s][::-1].tolist()
    back = z_function(before[2 * s :] + [NOTHING] + before)
    at = len(before) - 2 * s + 1
    out = []
    for q in periods:
        left, right = min(back[at + 2 * s - q], reach), min(on[q], reach)
        if left + right >= max(min_words - q, q):
            out.append((q, b - left, b + right))
    return out


def find_runs(docs: DataFrame, min_words: int = 12) -> DataFrame:
    """The columns of ``docs`` and ``runs``, an array of (start, length, period) by start and period, counted in words.

    Words are what ASCII white space separates. A run is a stretch of words with smallest period q, at least
    ``max(min_words, 2 * q)`` long, that cannot be extended to either side with that period.

    * A document of up to SPAN words is cut into tiles and solved by the task that reads it, many documents at a
      time. A longer one is written out as groups of tiles, one for each SPAN words and all short octaves and some
      for each long octave, which are dealt to all tasks.
    * Fragments are shuffled by document and period and stitched where they meet. Of stretches with the same ends
      the least period is the run's own.
    * Documents without a fragment are not shuffled; the others meet their runs again by the number of their row.

    A null or empty text has no runs, and a row no null array. Ids are not looked at: rows with a null or repeated
    id, and equal rows, are each solved alone. An empty table stays empty. A column ``runs`` is replaced.
    """
    own = [c for c in docs.columns if c != "runs"]
    fields = [docs.schema[c] for c in own]
    fragment = T.StructType([T.StructField(c, T.LongType()) for c in ("period", "start", "end")])
    more = [T.StructField("fragments", T.ArrayType(fragment)), T.StructField("n_fragments", T.LongType())]
    held = T.StructType([T.StructField("row", T.StructType(fields)), T.StructField("id", T.LongType()), *more])
    rows = docs.select(F.struct(*own).alias("row"), F.col("text"), F.monotonically_increasing_id().alias("id"))
    rows = rows.mapInArrow(lambda batches: _solve_short(batches, min_words), held)
    # numbers of rows are fixed by this table
    solved = stage(rows, "fragments", compression="zstd")

    short = solved.where("n_fragments > 0").select("id", F.inline("fragments"))
    tiles = solved.where("n_fragments < 0").select("id", F.col("row.text").alias("text")).mapInArrow(lambda batches: _explode(batches, min_words), TILES)
    dealt = tiles.repartition("id", "octave", "first_word").mapInArrow(lambda batches: _solve_tiles(batches, min_words), "id long, period long, start long, end long")
    runs = stitch(short.unionByName(dealt), min_words).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))

    none = F.array().cast(f"array<{RUN}>")
    plain = solved.where("n_fragments = 0").select("row.*", none.alias("runs"))
    with_runs = solved.where("n_fragments <> 0").join(runs, "id", "left").select("row.*", F.coalesce("runs", none).alias("runs"))
    return plain.unionByName(with_runs)


def stitch(fragments: DataFrame, min_words: int) -> DataFrame:
    """(id, start, length, period): whole runs from (id, period, start, end) of stretches, cut anywhere and in any order."""
    w = Window.partitionBy("id", "period").orderBy("start", "end")
    reached = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    parts = fragments.withColumn("new", F.when(F.col("start") <= reached, 0).otherwise(1))
    parts = parts.withColumn("part", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    whole = parts.groupBy("id", "period", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    whole = whole.where(F.col("end") - F.col("start") >= F.greatest(F.lit(min_words) - F.col("period"), F.col("period")))
    runs = whole.groupBy("id", "start", (F.col("end") + F.col("period")).alias("stop")).agg(F.min("period").alias("period"))
    return runs.select("id", "start", (F.col("stop") - F.col("start")).alias("length"), "period")


def _solve_short(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """Adds the fragments of each document of up to SPAN words; a longer one gets null and -1."""
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("period", "start", "end")]))
    for batch in chunks(batches):
        ids, seen = [], 0
        for text in texts(batch):
            own, n = word_ids(text)
            ids.append(own.astype(np.int64) + seen)
            seen += n
        n = np.array([len(x) for x in ids], dtype=np.int64)
        here = np.where(n > SPAN, 0, n)
        starts = np.cumsum(here + 1) - here - 1
        line = -np.arange(1, int((here + 1).sum()) + 1, dtype=np.int64)  # a word that equals nothing ends each document
        for x, at, size in zip(ids, starts.tolist(), here.tolist(), strict=True):
            line[at : at + size] = x[:size]
        period, start, end = solve(line, spacings(int(here.max(initial=0)), min_words), min_words)
        doc = np.searchsorted(starts, start, side="right") - 1
        order = np.argsort(doc, kind="stable")
        doc, period, start, end = doc[order], period[order], start[order], end[order]
        many = np.bincount(doc, minlength=len(n)).astype(np.int64)
        offsets = pa.array(np.append(0, np.cumsum(many)).astype(np.int32))
        values = pa.StructArray.from_arrays([pa.array(period), pa.array(start - starts[doc]), pa.array(end - starts[doc])], ["period", "start", "end"])
        fragments = pa.ListArray.from_arrays(offsets, values).cast(kind)
        told = np.where(n > SPAN, -1, many)
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), fragments, pa.array(told)], ["row", "id", "fragments", "n_fragments"])


TILES = "id long, octave long, last_octave long, first_word long, low long, high long, words binary"


def _explode(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """Groups of tiles: the octaves, and the words from ``first_word`` on with the margins that the tiles reach into.

    Octaves of up to an eighth of SPAN share groups of SPAN words; a longer one has groups of eight spaces.
    """
    for batch in chunks(batches):
        for key, text in zip(batch.column("id").to_pylist(), texts(batch), strict=True):
            ids, _ = word_ids(text)
            octaves = spacings(len(ids), min_words)
            groups = [([s for s in octaves if 8 * s <= SPAN], SPAN)] + [([s], 8 * s) for s in octaves if 8 * s > SPAN]
            for own, step in groups:
                margin = step // 4 if own[-1] * 8 <= SPAN else 2 * own[-1]
                for low in range(0, len(ids), step) if own else ():
                    first, last = max(0, low - margin), min(len(ids), low + step + 2 * margin)
                    words = ids[first:last].astype("<i4").tobytes()
                    row = [key, own[0], own[-1], first, low - first, min(low + step, len(ids)) - first, words]
                    names = [c.split()[0] for c in TILES.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names)


def _solve_tiles(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            own = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
            octaves = [own["octave"]]
            while octaves[-1] < own["last_octave"]:
                octaves.append(2 * octaves[-1])
            words = np.frombuffer(own["words"], dtype="<i4").astype(np.int64)
            period, start, end = solve(words, octaves, min_words, (own["low"], own["high"]))
            columns = [np.full(len(period), own["id"]), period, start + own["first_word"], end + own["first_word"]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "period", "start", "end"])


def _kept(text: pd.Series, runs: pd.Series) -> pd.Series:
    out = []
    for one, own in zip(text, runs, strict=True):
        words = [word for part in _words(one) for word in part]
        if len(own):
            # +1 where a run's first period ends, -1 where the run ends
            depth = np.zeros(len(words) + 1, dtype=np.int64)
            for run in own:
                depth[run["start"] + run["period"]] += 1
                depth[run["start"] + run["length"]] -= 1
            words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]
        out.append(b" ".join(words).decode())
    return pd.Series(out, dtype=object)


def collapsed(text: Column | str = "text", runs: Column | str = "runs") -> Column:
    """The words that stand in no run behind its first period, joined by one space; a null text is empty."""
    column = lambda c: F.col(c) if isinstance(c, str) else c
    return F.pandas_udf(_kept, "string")(F.coalesce(column(text), F.lit("")), column(runs))


def longest(runs: Column | str = "runs") -> Column:
    """The longest run, of ties the one that starts first, then of least period; null if there is none."""
    least = lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length"))
    return F.array_min(F.transform(runs, least))
