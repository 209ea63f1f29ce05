"""Embedding near-dedup: inverted lists with product-quantised residuals, and an exact rerank."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogprep.llm.common import components
from dialogprep.sources.storage import stage

THRESHOLD = 0.93
#: Vectors that the index is fit on; every vector is indexed.
SAMPLE = 20_000
#: Cells of the coarse quantiser: one for so many vectors, within these bounds.
CELL_VECTORS, CELLS = 400, (1, 1024)
#: Lists that a vector looks in.
PROBES = 12
#: Subspaces and codewords of each in the product quantiser of the residuals.
PARTS, CODES = 8, 64
#: Members of a list that one task compares with all that look there.
BLOCK = 2048
SLICE = 1024


@dataclass(frozen=True)
class Index:
    cells: np.ndarray
    codes: np.ndarray

    def nearest(self, x: np.ndarray, probes: int) -> np.ndarray:
        """The nearest cells of each row, nearest first."""
        far = (self.cells**2).sum(axis=1) - 2 * x @ self.cells.T
        k = min(probes, len(self.cells))
        some = np.argpartition(far, k - 1, axis=1)[:, :k]
        return np.take_along_axis(some, np.take_along_axis(far, some, axis=1).argsort(axis=1, kind="stable"), axis=1)

    def encode(self, residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, what they miss: the distance of each residual from its codes)."""
        parts = residuals.reshape(len(residuals), len(self.codes), -1)
        out = np.empty(parts.shape[:2], dtype=np.uint8)
        missed = np.zeros(len(residuals))
        for m, book in enumerate(self.codes):
            far = ((parts[:, m, None, :] - book) ** 2).sum(axis=2)
            out[:, m] = far.argmin(axis=1)
            missed += far.min(axis=1)
        return out, np.sqrt(missed)

    def tables(self, residuals: np.ndarray) -> np.ndarray:
        """Squared distances of the parts of each row from all codewords: rows, parts, codes."""
        parts = residuals.reshape(len(residuals), len(self.codes), 1, -1)
        return ((parts - self.codes) ** 2).sum(axis=3)


def _means(x: np.ndarray, k: int, rng: np.random.Generator, steps: int = 8) -> np.ndarray:
    k = min(k, len(x))
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(steps):
        near = ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def fit(sample: np.ndarray, cells: int, seed: int = 7) -> Index:
    """Cells from the unit vectors of a sample, codes from what the cells leave."""
    rng = np.random.default_rng(seed)
    centres = _means(sample, cells, rng)
    near = ((centres**2).sum(axis=1) - 2 * sample @ centres.T).argmin(axis=1)
    width = sample.shape[1]
    parts = next(m for m in range(min(PARTS, width), 0, -1) if width % m == 0)
    rest = (sample - centres[near]).reshape(len(sample), parts, -1)
    books = [_means(rest[:, m], CODES, rng) for m in range(parts)]
    return Index(centres, np.stack(books))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, unit array<double>): rows with a label and a vector that has a direction, of unit length.

    A vector is scaled by its greatest part first, so that no square overflows or vanishes. Equal vectors have
    equal units.
    """
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    rows = rows.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            parts = lists.flatten().to_numpy(zero_copy_only=False)  # a null part becomes NaN
            first = np.cumsum(sizes) - sizes
            for width in np.unique(sizes[sizes > 0]):
                row = np.flatnonzero(sizes == width)
                x = parts[first[row][:, None] + np.arange(width)]
                top = np.abs(x).max(axis=1)
                good = np.isfinite(top) & (top > 0)
                x = x[good] / top[good][:, None]
                x /= np.sqrt((x**2).sum(axis=1))[:, None]
                kept = batch.take(pa.array(row[good]))
                ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * width)
                yield pa.RecordBatch.from_arrays([kept.column("vec_id"), kept.column("label"), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], ["vec_id", "label", "unit"])

    return rows.mapInArrow(run, f"vec_id long, label {vectors.schema['label'].dataType.simpleString()}, unit array<double>")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, probes: int = PROBES, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each vector; links join vectors of equal label and a cosine not below ``threshold``.

    Each vector stands in the list of its nearest cell as a code of its residual, and looks in the lists of its
    ``probes`` nearest cells. There a table of distances sums up the codes, and what may be near enough, given how
    much each code misses, is compared exactly in double precision. So only pairs whose lists are not looked in
    are lost; tests measure that against brute force.

    A list is cut in blocks of about ``block`` members, each compared with all that look in the list, slice by
    slice: no task holds a list of unknown length, and pairs are counted where they are found and not written.
    Equal vectors are one member with a number of copies. What is written is a link for each vector and block at
    most, enough to join the groups.

    A null label, and a vector that is null, empty, zero or holds null or non-finite parts, links with nothing. So
    does a null vec_id, each row of which is a row with a null component. Rows with the same vec_id are one vector and
    give one row: equal ones count once, of different ones each links. Vectors of different lengths don't link. An empty table gives an empty result.
    Other columns are not read.
    """
    spark = vectors.sparkSession
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), "embedding")
    units = stage(usable(every).dropDuplicates(["vec_id", "label", "unit"]), "units")
    # copies: one member, told by its least id
    members = units.groupBy("label", "unit").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    members = stage(members, "members")
    found = []
    for row in members.groupBy(F.size("unit").alias("width")).agg(F.count("*").alias("n")).orderBy("width").collect():
        same = members.where(F.size("unit") == row["width"])
        picked = same.where(F.pmod(F.xxhash64("unit"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, sample / row["n"])) + 1).select("unit").limit(2 * sample)
        fitted = np.array([r["unit"] for r in picked.toLocalIterator()] or [same.first()["unit"]])
        cells = int(np.clip(row["n"] // CELL_VECTORS, *CELLS))
        found.append(_links_of(same, spark.sparkContext.broadcast(fit(fitted, cells)), threshold, probes, block))
    schema = "node long, n_links long, other long"
    told = found[0] if found else spark.createDataFrame([], schema)
    for more in found[1:]:
        told = told.unionByName(more)
    told = stage(told, "vector-links")

    counts = told.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    groups = components(told.where(F.col("other").isNotNull()), "node", "other")
    nodes = members.join(counts, "node", "left").join(groups, "node", "left")
    nodes = nodes.select("label", "unit", "node", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id"))
    placed = units.join(nodes, ["label", "unit"]).groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    ids = every.select("vec_id")
    ids = ids.where(F.col("vec_id").isNotNull()).distinct().unionByName(ids.where(F.col("vec_id").isNull()))
    out = ids.join(placed, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def _links_of(members: DataFrame, index, threshold: float, probes: int, block: int) -> DataFrame:  # noqa: ANN001
    """(node, n_links, other): counts and links found; a row for each node and block at most, and one for each link."""
    kind = members.schema["label"].dataType.simpleString()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                part = batch.slice(i, SLICE)
                near = own.nearest(_matrix(part.column("unit")), probes)
                lists = pa.array(near.astype(np.int32).tolist(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("label"), part.column("node"), part.column("copies"), part.column("unit"), lists], ["label", "node", "copies", "unit", "probes"])

    looked = stage(members.mapInArrow(look, f"label {kind}, node long, copies long, unit array<double>, probes array<int>"), "probes")
    blocks = looked.groupBy("label", F.col("probes")[0].alias("cell")).agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    home = looked.select("*", F.col("probes")[0].alias("cell")).join(blocks, ["label", "cell"])
    home = home.select("label", "cell", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), F.lit(True).alias("home"), "node", "copies", "unit", "probes")
    visit = looked.select("*", F.explode("probes").alias("cell")).join(blocks, ["label", "cell"])
    visit = visit.select("label", "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(False).alias("home"), "node", "copies", "unit", "probes")
    rows = home.unionByName(visit).repartition("label", "cell", "block").sortWithinPartitions("label", "cell", "block", F.desc("home"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, key, here, held = index.value, None, None, []
        for batch in batches:
            keys = list(zip(batch.column("label").to_pylist(), batch.column("cell").to_pylist(), batch.column("block").to_pylist(), batch.column("home").to_pylist(), strict=True))
            begin = 0
            while begin < len(keys):
                end = begin + 1
                while end < len(keys) and end - begin < SLICE and keys[end] == keys[begin]:
                    end += 1
                part, now = batch.slice(begin, end - begin), keys[begin]
                if now[:3] != key:
                    key, here, held = now[:3], None, []
                if now[3]:
                    held.append(part)
                elif held or here:
                    here = here or List(own, key[1], held)
                    held = []
                    yield from here.compare(part, threshold)
                begin = end

    return rows.mapInArrow(compare, "node long, n_links long, other long")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


class List:
    """The members of one block of a list."""

    def __init__(self, index: Index, cell: int, parts: list[pa.RecordBatch]) -> None:
        self.index, self.cell = index, cell
        join = lambda c: np.concatenate([p.column(c).to_numpy() for p in parts])
        self.node, self.copies = join("node"), join("copies")
        self.unit = np.concatenate([_matrix(p.column("unit")) for p in parts])
        self.probes = np.concatenate([_matrix(p.column("probes")) for p in parts])
        self.codes, self.missed = index.encode(self.unit - index.cells[cell])

    def compare(self, part: pa.RecordBatch, threshold: float) -> Iterator[pa.RecordBatch]:
        """Exact links of a slice of visitors with the members.

        A visitor counts its links here. A member counts them too where the visitor's own list is not among those
        it looks in, so each link is counted once at either end.
        """
        node, copies, unit = part.column("node").to_numpy(), part.column("copies").to_numpy(), _matrix(part.column("unit"))
        own_cell = _matrix(part.column("probes"))[:, 0]
        tables = self.index.tables(unit - self.index.cells[self.cell])
        far = np.zeros((len(unit), len(self.node)))
        for m in range(self.codes.shape[1]):
            far += tables[:, m][:, self.codes[:, m]]
        reach = np.sqrt(2 - 2 * threshold)
        maybe = (np.sqrt(far) <= reach + self.missed + 1e-9) & (node[:, None] != self.node)
        a, b = np.nonzero(maybe)
        exact = np.empty(len(a))
        for i in range(0, len(a), 1 << 17):
            k = slice(i, i + (1 << 17))
            exact[k] = np.einsum("ij,ij->i", unit[a[k]], self.unit[b[k]])
        a, b = a[exact >= threshold], b[exact >= threshold]
        if not len(a):
            return
        back = ~(self.probes[b] == own_cell[a][:, None]).any(axis=1)
        ids = np.concatenate([node[a], self.node[b[back]]])
        ids, at = np.unique(ids, return_inverse=True)
        n = np.bincount(at, weights=np.concatenate([self.copies[b], copies[a[back]]])).astype(np.int64)
        x, y = _forest(node[a], self.node[b])
        columns = [np.concatenate([ids, x]), np.concatenate([n, np.zeros(len(x), np.int64)])]
        other = pa.concat_arrays([pa.nulls(len(ids), pa.int64()), pa.array(y)])
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), other], ["node", "n_links", "other"])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of these links, enough to join the same nodes: each node with the least it reaches."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[x], root[y])
        now = root.copy()
        np.minimum.at(now, x, low)
        np.minimum.at(now, y, low)
        now = np.minimum(now, now[now])
        if (now == root).all():
            break
        root = now
    moved = root != np.arange(len(ids))
    return ids[moved], ids[root[moved]]
