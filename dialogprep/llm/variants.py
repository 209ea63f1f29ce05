"""Spelling variants: words one edit apart, found by comparing padded code-point matrices block by block."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.llm.common import chunks, texts
from dialogprep.sources.storage import stage

#: Runs of letters in lower-cased UTF-8; U+00C0 to U+00FF are the bytes C3 80 to C3 BF.
LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
#: Distinct words a task adds up before it passes them on.
COUNTED = 200_000
#: Words of a block; a larger group is compared block with block.
BLOCK = 1024
#: Cells of the matrices that are compared at once.
CELLS = 1 << 23


def count_words(docs: DataFrame, min_chars: int = 5, min_count: int = 3, typo: int = 0) -> DataFrame:
    """(word, n): the runs of Latin letters of all texts, A-Z in lower case, with how often they stand there.

    Words are added up by each task before they are shuffled. ``typo``: where the crc32 of ``<doc_id>:<word>`` is a
    multiple of it, the word loses the code point at that number modulo its length; 0 changes nothing. A null text
    has no words, a null id counts as empty. Rows with the same id and equal rows all count. An empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in chunks(batches):
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, texts(batch), strict=True):
                own = Counter(LETTERS.findall(text.encode().lower()))
                before = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
                before = zlib.crc32(b":", before)
                for word, n in own.items():
                    if len(word) >= min_chars:
                        if typo and not (key := zlib.crc32(word, before)) % typo:
                            whole = word.decode()
                            at = key % len(whole)
                            word = (whole[:at] + whole[at + 1 :]).encode()
                        total[word] += n
            if len(total) > COUNTED:
                yield _counted(total)
                total.clear()
        yield _counted(total)

    counts = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    words = counts.where(F.length("word") >= min_chars).groupBy("word").agg(F.sum("n").alias("n"))
    return words.where(F.col("n") >= min_count)


def _counted(total: Counter[bytes]) -> pa.RecordBatch:
    words = pa.array(list(total), pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], ["word", "n"])


def _parts(longer: Column) -> list[Column]:
    """Hashes of the four parts of a word of which one is the same in any word an edit away.

    One edit in a pair whose longer word has L code points leaves the first or the last half of L as it is, and
    of the other half again the first or the last half. ``longer`` is L.
    """
    half = F.floor(longer / 2).cast("int")
    quarter = F.floor((longer - half) / 2).cast("int")
    n = F.length("word")
    cut = lambda start, size: F.substring("word", start, size)
    first, last = cut(F.lit(1), half), cut(n - half + 1, half)
    return [
        F.xxhash64(first, cut(half + 1, quarter)),
        F.xxhash64(first, cut(n - quarter + 1, quarter)),
        F.xxhash64(last, cut(F.lit(1), quarter)),
        F.xxhash64(last, cut(n - half - quarter + 1, quarter)),
    ]


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n): every two of ``words`` (distinct, with ``n``) one edit apart, once from each side.

    A word meets others of its length, and of one more or less, in groups that share three quarters of it. A group is a
    tile; one of more than ``block`` words is split into blocks by hash, and every pair of blocks is a tile. A tile
    compares its words as rows of matrices, padded at the end for common prefixes and at the front for common
    suffixes: prefix and suffix together reach the longer length less one in words one edit apart. Such a pair
    may share several groups and counts in the first only. Letters bound the pairs of a word.
    """
    lengths = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("longer"))
    keyed = lengths.select("word", "n", "longer", F.posexplode(F.array(*_parts(F.col("longer")))).alias("part", "key"))
    sizes = keyed.groupBy("longer", "part", "key").agg(F.count("*").alias("size"), F.max(F.length("word") == F.col("longer")).alias("has_longer"))
    sizes = sizes.where((F.col("size") > 1) & F.col("has_longer"))
    split = keyed.join(sizes, ["longer", "part", "key"]).withColumn("blocks", F.ceil(F.col("size") / block))
    split = split.withColumn("own", F.pmod(F.xxhash64("word", "key"), "blocks"))
    tiles = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.select("word", "n", "longer", "part", "key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own")
    at = ["longer", "part", "key", "a", "b"]
    tiles = tiles.repartition(*at).sortWithinPartitions(*at, "word")
    return tiles.mapInArrow(_compare, "word string, near string, near_n long")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches are in the order of tiles; the last tile of a batch waits for its rest."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = _tile_keys(batch)
        cut = int(np.flatnonzero((keys != keys[-1]).any(axis=1)).max(initial=-1)) + 1
        if held and (cut or (_tile_keys(held[-1].slice(0, 1)) != keys[:1]).any()):
            whole = pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            yield from _tiles(whole)
            held = []
        elif cut:
            yield from _tiles(pa.Table.from_batches([batch.slice(0, cut)]))
        held.append(batch.slice(cut))
    if held:
        yield from _tiles(pa.Table.from_batches(held).combine_chunks())


def _tile_keys(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("longer", "part", "key", "a", "b")], axis=1)


def _tiles(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    keys = _tile_keys(rows)
    words, n, own = rows.column("word").to_pylist(), rows.column("n").to_numpy(), rows.column("own").to_numpy()
    edges = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
    tile = np.repeat(edges, np.diff(np.append(edges, len(keys))))
    for longer in np.unique(keys[:, 0]).tolist():
        here = np.flatnonzero(keys[:, 0] == longer)
        own_words = [words[i] for i in here.tolist()]
        sizes = np.array([len(w) for w in own_words])
        heads, tails = _matrix(own_words, longer), _matrix([w[::-1] for w in own_words], longer)
        earlier = here - tile[here]  # words of the tile before this one
        ends = np.cumsum(earlier)
        step = max(1, CELLS // longer)
        for start in range(0, int(ends[-1]), step):
            pairs = np.arange(start, min(start + step, int(ends[-1])))
            right = np.searchsorted(ends, pairs, side="right")
            left = tile[here][right] - here[0] + pairs - (ends[right] - earlier[right])
            x, y = here[left], here[right]
            across = (keys[x, 3] == keys[x, 4]) | (own[x] != own[y])
            right, left = right[across & (np.maximum(sizes[left], sizes[right]) == longer)], left[across & (np.maximum(sizes[left], sizes[right]) == longer)]
            prefix = np.argmin(heads[left] == heads[right], axis=1)
            suffix = np.argmin(tails[left] == tails[right], axis=1)
            part = _first_part(prefix, suffix, longer)
            near = (prefix + suffix >= longer - 1) & (part == keys[here[left], 1])
            x, y = here[left[near]], here[right[near]]
            if len(x):
                a, b = pa.array([words[i] for i in x.tolist()]), pa.array([words[i] for i in y.tolist()])
                both = [pa.concat_arrays([a, b]), pa.concat_arrays([b, a]), pa.array(np.concatenate([n[y], n[x]]))]
                yield pa.RecordBatch.from_arrays(both, ["word", "near", "near_n"])


def _matrix(words: list[str], width: int) -> np.ndarray:
    return np.array(words, dtype=f"<U{width}").view(np.uint32).reshape(len(words), width)


def _first_part(prefix: np.ndarray, suffix: np.ndarray, longer: int) -> np.ndarray:
    """The first of the four parts that a pair shares, 4 if none."""
    half = longer // 2
    quarter = (longer - half) // 2
    shares = [prefix >= half + quarter, (prefix >= half) & (suffix >= quarter), (suffix >= half) & (prefix >= quarter), suffix >= half + quarter]
    return np.select(shares, [0, 1, 2, 3], 4)


def spelling_variants(words: DataFrame, times: int = 2, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word; ``words`` are distinct with their counts ``n``.

    The form of a word is the word one edit away that is counted most, of ties the first in code-point order, if
    it is counted ``times`` as often; else null. The root is the last form that forms lead to, the word itself if it
    has none. Counts grow from form to form, so there are few steps, and each round below doubles them.
    """
    words = stage(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_words(words, block).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    formed = words.join(near, "word", "left").withColumn("form_n", -F.col("best.less"))
    has_form = F.col("form_n") >= F.col("n") * times
    formed = stage(formed.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has_form, F.col("best.form")).alias("form"), F.when(has_form, F.col("form_n")).alias("form_n")), "forms")

    # (word, to): where the forms of a word lead so far; words without a form are where they end
    steps = formed.where("form is not null").select("word", F.col("form").alias("to"))
    while True:
        ahead = steps.select(F.col("word").alias("to"), F.col("to").alias("next"))
        joined = stage(steps.join(ahead, "to", "left").select("word", "to", "next"), "roots")
        steps = joined.select("word", F.coalesce("next", "to").alias("to"))
        if joined.where("next is not null").isEmpty():
            break
    found = formed.join(steps, "word", "left")
    return found.select("word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n")
