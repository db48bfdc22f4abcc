"""Embedding near-dedup: an exact range join of unit vectors in cells around pivots.

Cosine at least c is Euclidean distance at most r = sqrt(2 - 2c) between unit vectors, a metric. Every
vector has its home in the cell of its nearest pivot. A vector y can have a partner at home in the
cell of pivot p only if

    d(y, p) <= (largest home distance of p) + r    and    d(y, p) <= d(y, nearest pivot) + 2 r,

both by the triangle inequality; it is sent to those cells and no others. So each vector meets all its
partners in its own home, and cells join independently. Homes are cut into blocks that fit a
task, past which the vectors sent to the cell stream, so memory is bounded whatever the cell's size. How
many cells a vector visits depends on the data: close groups visit few, vectors without structure in many
dimensions nearly all, and then the join is one of blocks against all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemart.llm.components import components
from lakemart.llm.tables import Scratch

THRESHOLD = 0.9
#: Vectors of a home block, the unit that is held in memory, and of those that stream past it at once; and
#: a bound on the pivots, which are sent out.
BLOCK, AT_ONCE, MOST_PIVOTS = 16_384, 256, 256
#: Rounding of distances and cosines: only widens the search, pairs this close are computed again.
SLACK = 1e-9
#: Pairs computed again in double precision at once: bounds the memory of a task.
TOGETHER = 8_192


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vectors that can link, as bytes of doubles."""
    for batch in batches:
        ids, kept = [], []
        for vec_id, vector in zip(batch.column("vec_id").to_pylist(), batch.column("embedding")):
            if vec_id is None or not vector.is_valid or vector.values is None or vector.values.null_count:
                continue
            values = np.asarray(vector.values, dtype=np.float64)
            with np.errstate(over="ignore", invalid="ignore"):
                norm = np.linalg.norm(values / np.abs(values).max()) if len(values) and np.abs(values).max() > 0 else 0.0
            if np.isfinite(values).all() and norm > 0:
                ids.append(vec_id)
                kept.append(values.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(kept, pa.binary())], ["vec_id", "vec"])


def unit(vectors: list[bytes]) -> np.ndarray:
    """Rows scaled to length 1, without overflow."""
    x = np.frombuffer(b"".join(vectors), dtype=np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ pivots.T)))


def _by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Row numbers and vectors of each dimension; vectors of different dimensions never link."""
    vectors = batch.column("vec").to_pylist()
    sizes = np.array([len(v) for v in vectors])
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, [vectors[r] for r in rows]


class _Pivots:
    """Pivots by dimension, numbered across all of them."""

    def __init__(self, chosen: list[bytes]):
        self.first, self.units = {}, {}
        at = 0
        for size in sorted({len(v) for v in chosen}):
            mine = [v for v in chosen if len(v) == size]
            self.first[size], self.units[size] = at, unit(mine)
            at += len(mine)

    def distances(self, vectors: list[bytes]) -> tuple[int, np.ndarray]:
        size = len(vectors[0])
        if size not in self.units:  # no pivot of this dimension: one cell of its own
            return -size, np.zeros((len(vectors), 1))
        return self.first[size], _distances(unit(vectors), self.units[size])


def _homes(pivots: _Pivots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, vectors in _by_dimension(batch):
                first, d = pivots.distances(vectors)
                home = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(home + first, pa.int64()), pa.array(d[np.arange(len(d)), home])], ["cell", "d"]
                )

    return run


def _visits(pivots: _Pivots, homes: dict[int, tuple[int, float]], reach: float):
    """One row per vector and block it meets: its home block first in role 0, all blocks of reached cells in role 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, weights = batch.column("rep").to_numpy(), batch.column("w").to_numpy()
            cells, blocks, roles, rows_out = [], [], [], []
            for rows, vectors in _by_dimension(batch):
                first, d = pivots.distances(vectors)
                home = d.argmin(axis=1)
                nearest = d[np.arange(len(d)), home]
                for k in range(d.shape[1]):
                    n, radius = homes.get(first + k, (0, 0.0))
                    if not n:
                        continue
                    near = np.flatnonzero((d[:, k] <= radius + reach + SLACK) & (d[:, k] <= nearest + 2 * reach + SLACK))
                    n_blocks = -(-n // BLOCK)
                    here = np.flatnonzero(home == k)
                    own = (ids[rows[here]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(n_blocks)
                    parts = [(here, own.astype(np.int64), 0)]
                    parts += [(near, np.full(len(near), b), 1) for b in range(n_blocks)]
                    for members, block, role in parts:
                        cells.append(np.full(len(members), first + k))
                        blocks.append(block)
                        roles.append(np.full(len(members), role))
                        rows_out.append(rows[members])
            if not cells:
                continue
            at = np.concatenate(rows_out)
            for i in range(0, len(at), 8192):
                part = slice(i, i + 8192)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(cells)[part], pa.int64()),
                        pa.array(np.concatenate(blocks)[part], pa.int64()),
                        pa.array(np.concatenate(roles)[part], pa.int32()),
                        pa.array(ids[at[part]], pa.int64()),
                        pa.array(weights[at[part]], pa.int64()),
                        batch.column("vec").take(pa.array(at[part])),
                    ],
                    ["cell", "block", "role", "rep", "w", "vec"],
                )

    return run


class _Block:
    """A home block: counts the weighted links of its members and the links that connect them."""

    def __init__(self, threshold: float):
        self.threshold = threshold
        self.ids: list[int] = []
        self.weights: list[int] = []
        self.vectors: list[bytes] = []
        self.matrix = None

    def add(self, ids, weights, vectors) -> None:
        self.ids += ids
        self.weights += weights
        self.vectors += vectors

    def _root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def meet(self, ids, weights, vectors) -> list[tuple[int, int]]:
        if self.matrix is None:
            self.matrix = unit(self.vectors)
            self.rough = self.matrix.astype(np.float32)
            # Rounding of single precision: of the components, and of as many products and sums as there are components.
            self.margin = (self.matrix.shape[1] + 8) * float(np.finfo(np.float32).eps)
            self.parent = list(range(len(self.ids)))
            self.links = np.zeros(len(self.ids), dtype=np.int64)
            self.own = np.array(self.ids)
        other = unit(vectors)
        members, found = self._linked(other, vectors)
        apart = np.asarray(ids)[members] != self.own[found]
        members, found = members[apart], found[apart]
        np.add.at(self.links, found, np.asarray(weights, dtype=np.int64)[members])
        edges = []
        cuts = np.flatnonzero(np.diff(members, prepend=-1))
        for i, linked in zip(members[cuts].tolist(), np.split(found, cuts[1:])):
            first, *more = linked.tolist()
            edges.append((ids[i], self.ids[first]))
            root = self._root(first)
            for j in more:
                other_root = self._root(j)
                if other_root != root:
                    self.parent[other_root] = root
                    edges.append((self.ids[first], self.ids[j]))
        return edges

    def _linked(self, other: np.ndarray, vectors: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``other`` and members of the block at the threshold, in order of row and member.

        Single precision tells which pairs are clearly above or below; the others are computed in double precision.
        """
        rough = (other.astype(np.float32) @ self.rough.T).ravel()
        at = np.flatnonzero(rough >= np.float32(self.threshold - self.margin))
        unsure = np.flatnonzero(rough[at] <= np.float32(self.threshold + self.margin))
        linked = np.ones(len(at), dtype=bool)
        for k in range(0, len(unsure), TOGETHER):
            here = unsure[k : k + TOGETHER]
            rows, members = np.divmod(at[here], len(self.ids))
            cosines = np.einsum("ij,ij->i", other[rows], self.matrix[members])
            for c in np.flatnonzero(np.abs(cosines - self.threshold) <= SLACK):
                a = np.frombuffer(vectors[rows[c]], np.float64)
                b = np.frombuffer(self.vectors[members[c]], np.float64)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                cosines[c] = a @ b / (np.linalg.norm(a) * np.linalg.norm(b))
            linked[here] = cosines >= self.threshold
        return np.divmod(at[linked], len(self.ids))

    def counts(self) -> list[tuple[int, int]]:
        if self.matrix is None:
            return []
        return [(i, int(n) + w - 1) for i, n, w in zip(self.ids, self.links, self.weights)]


def _result(kind: str, pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(pairs)), pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())],
        ["kind", "a", "b"],
    )


def _join_cells(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, None
        for batch in batches:
            places = np.stack([batch.column(n).to_numpy() for n in ("cell", "block", "role")], axis=1)
            cuts = np.flatnonzero((np.diff(places, axis=0) != 0).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(places)]):
                if b == a:
                    continue
                cell, number, role = places[a].tolist()
                rows = [batch.column(n).slice(a, b - a).to_pylist() for n in ("rep", "w", "vec")]
                if (cell, number) != key:
                    if block:
                        yield _result("n", block.counts())
                    key, block = (cell, number), _Block(threshold)
                if role == 0:
                    block.add(*rows)
                    continue
                if not block.ids:
                    continue
                for i in range(0, b - a, AT_ONCE):
                    edges = block.meet(*(r[i : i + AT_ONCE] for r in rows))
                    if edges:
                        yield _result("link", edges)
        if block:
            yield _result("n", block.counts())

    return run


def embedding_groups(spark: SparkSession, embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``embeddings`` (vec_id, embedding).

    n_links counts the other rows at cosine >= threshold; component_id is the smallest vec_id that links
    reach, itself included; kept marks that row. Vectors that are null, empty, zero or hold a null or
    non-finite component link with nothing, nor do rows without vec_id or of different dimensions with each other.
    Equal vectors are searched once and counted as often as they occur. Rows that share a vec_id with
    different vectors are one node, and count the links of all. Other columns are ignored.
    """
    scratch = Scratch(spark, "embedding")
    named = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    valid = scratch.write(named.mapInArrow(_valid, "vec_id long, vec binary"), "valid")
    distinct = scratch.write(
        valid.groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("w")), "distinct"
    )
    n = distinct.count()
    size = min(MOST_PIVOTS, -(-n // BLOCK))
    chosen = distinct.orderBy(F.xxhash64("rep", "vec")).limit(size).select("vec").collect()
    pivots = _Pivots([bytes(r.vec) for r in chosen])
    homes = distinct.select("vec").mapInArrow(_homes(pivots), "cell long, d double")
    homes = {r.cell: (r.n, r.d) for r in homes.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("d")).collect()}
    reach = float(np.sqrt(2.0 - 2.0 * threshold))
    found = scratch.write(
        distinct.mapInArrow(
            _visits(pivots, homes, reach), "cell long, block long, role int, rep long, w long, vec binary"
        )
        .repartition("cell", "block")
        .sortWithinPartitions("cell", "block", "role", "rep")
        .mapInArrow(_join_cells(threshold), "kind string, a long, b long"),
        "found",
    )
    copies = valid.join(distinct.where("w > 1"), "vec").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    copies = scratch.write(copies, "copies")
    groups = components(found.where("kind = 'link'").select("a", "b").unionByName(copies), scratch)
    counts = found.where("kind = 'n'").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("n_links"))
    reps = named.select("vec_id").join(copies.distinct(), F.col("vec_id") == F.col("a"), "left")
    return (
        reps.select("vec_id", F.coalesce("b", "vec_id").alias("rep"))
        .join(counts, "rep", "left")
        .join(groups.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
    )
