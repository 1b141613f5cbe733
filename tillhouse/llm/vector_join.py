"""Exact cosine self-join of vectors within a label, by pigeonholes in rotated subspaces.

For unit vectors, cosine >= c means a squared distance of at most ``d = 2 (1 - c)``. All vectors are rotated by the eigenvectors
of their second-moment matrix, whose size depends on the dimension only, and the coordinates are dealt to blocks so that each
block gets strong and weak directions. If two vectors are within d, then in at least one block their squared distance is
within that block's share of d, which is proportional to its share of the coordinates. So per block a range join is enough:

* the block's two strongest coordinates are cut into cells twice as wide as the block's radius;
* a vector is *home* in its cell and *visits* the cells whose box lies within the radius, at most nine and mostly one to four;
* in a cell, homes and visitors are compared by the block's squared distance, and the candidates of all blocks are
  verified by the cosine of the original vectors in double precision.

A vector has some forty places in cells, so cells are made where vectors already are together and are never shuffled. The vectors of a label
are dealt to parts of ``BLOCK`` at most, and each two parts, or a part with itself, meet in one task. They meet in rounds, in each of which a part has
one partner: a round shuffles every vector once and deletes that shuffle when it has ended, so disk grows with the vectors and not with
the number of pairs of parts. A task reports how many vectors each of its vectors links with, and a spanning forest of the links; pairs are never written
out. Equal vectors of a label are one vector with a weight.

Defined results: a null, empty, zero vector, one with a null or non-finite component, of a null label, or with a null id, links
with nothing and is its own component; vectors of different lengths never link; rows that share an id are one vertex; an
empty table gives no rows. Rounding is covered by ``SLACK`` on every squared distance; only the exact cosine decides.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.components import components
from tillhouse.session import let_go, settle

BLOCKS = 8
BLOCK = 16_384  # vectors of a part
VALUES = 1 << 20  # numbers of a part's vectors
HOMES = 256
PAIRS = 1 << 16
SLACK = 1e-9


def _usable(vectors: DataFrame) -> DataFrame:
    """Vectors that can link, with ``print``: a hash that equal vectors share, whatever the sign of their zeros."""
    fine = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    some = F.exists("vector", lambda v: v != 0)
    usable = vectors.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & fine & some)
    return usable.withColumn("print", F.xxhash64(F.transform("vector", lambda v: F.when(v == 0, F.abs(v)).otherwise(v))))


def _unit_rows(usable: DataFrame) -> DataFrame:
    """One row per different usable vector of a label: id (the least), copies, label, vector, print."""
    return usable.groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("print").alias("print"))


def _same(usable: DataFrame, different: DataFrame) -> DataFrame:
    """id, first (the least id of the equal vectors), copies. Joined by the narrow hash, unless two different vectors of a label share one."""
    alone = different.groupBy("label", "print").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    key = ["label", "print" if alone else "vector"]
    return usable.select(*key, "id").join(different.select(*key, F.col("id").alias("first"), "copies"), key).select("id", "first", "copies")


def _rotation(rows: DataFrame, size: int) -> np.ndarray:
    """Eigenvectors of the mean outer product of the unit vectors, strongest first: size x size."""
    def add(batches):
        total = np.zeros((size, size))
        for batch in batches:
            x = _matrix(batch.column(0), size)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.reshape(-1).tolist()], pa.list_(pa.float64()))], names=["total"])

    parts = rows.where(F.size("vector") == size).select("vector").mapInArrow(add, "total array<double>")
    sums = parts.select(F.posexplode("total").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(size * size)
    for r in sums:  # size * size rows
        total[r.at] = r.v
    _, vectors = np.linalg.eigh(total.reshape(size, size))
    return vectors[:, ::-1]


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Unit rows of a list column."""
    x = np.array(column.to_pylist(), float).reshape(-1, size)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1]) if len(x) else x
    return x / np.sqrt((x * x).sum(1))[:, None]


def turn(unit: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """Rotated rows. Unlike a matrix product of the library, a row's result doesn't depend on the rows beside it, so all
    tasks see the same coordinates."""
    return np.einsum("ij,jk->ik", unit, rotation, optimize=False)


def block_columns(size: int, blocks: int) -> list[np.ndarray]:
    return [c for c in (np.arange(size)[k::blocks] for k in range(blocks)) if len(c)]


def _homes(x: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """A block's two strongest coordinates in widths of a cell, and the cell that each row is home in."""
    x = np.column_stack([x[:, 0], x[:, 1] if x.shape[1] > 1 else np.zeros(len(x))]) / (2 * radius)
    return x, np.floor(x).astype(np.int64)


def _visitors(x: np.ndarray, radius: float) -> dict[tuple[int, int], np.ndarray]:
    """The rows that each cell holds: those at home in it and those that visit it."""
    x, home = _homes(x, radius)
    cells, rows = [], []
    for dx in (-1, 0, 1):
        for dy in (-1, 0, 1):
            cell = home + (dx, dy)
            gap = np.maximum(0, np.maximum(cell - x, x - cell - 1)) * 2 * radius
            near = np.flatnonzero((gap * gap).sum(1) <= radius * radius + SLACK)
            cells.append(cell[near])
            rows.append(near)
    cells, rows = np.concatenate(cells), np.concatenate(rows)
    order = np.lexsort((rows, cells[:, 1], cells[:, 0]))
    cells, rows = cells[order], rows[order]
    at = np.flatnonzero(np.append(True, (cells[1:] != cells[:-1]).any(1)))
    return {tuple(c): part for c, part in zip(cells[at].tolist(), np.split(rows, at[1:]))}


class Block:
    """One block's cells for the vectors that meet in a task: ``home`` and ``row`` are their numbers, ``order`` the homes by cell."""

    def __init__(self, x: np.ndarray, home: np.ndarray, row: np.ndarray, radius: float):
        self.x, self.row, self.square = x, row, (x * x).sum(1)
        self.cell = _homes(x, radius)[1]
        self.visitors = _visitors(x[row], radius)
        self.order = home[np.lexsort(self.cell[home].T)]

    def mark(self, candidate: np.ndarray, h: np.ndarray, most: float) -> None:
        """Set where the homes ``h`` and a row of their cell are near in this block."""
        at = np.lexsort(self.cell[h].T)
        cells = self.cell[h[at]]
        for some in np.split(at, np.flatnonzero((cells[1:] != cells[:-1]).any(1)) + 1):
            seen = self.visitors.get(tuple(self.cell[h[some[0]]].tolist()))
            if seen is not None:
                x, y = h[some], self.row[seen]
                i, j = np.nonzero(self.square[x][:, None] + self.square[y][None] - 2 * (self.x[x] @ self.x[y].T) <= most)
                candidate[some[i], seen[j]] = True


def _join(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give the components of the pairs (i, j) one root, the least number in them. ``root`` leads from each number to its root."""
    while True:
        low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
        apart = low != high
        if not apart.any():
            return
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root[:] = root[root]


def _round(dealt: DataFrame, number: int) -> DataFrame:
    """The vectors with the pair of parts (low, high) in which each one's part meets its partner of this round. Each two of a label's n_parts
    parts, and each part with itself, are partners in one round."""
    other = F.pmod(F.lit(number) - F.col("part"), F.col("n_parts"))
    return dealt.where(F.col("n_parts") > number).withColumns({"low": F.least("part", other), "high": F.greatest("part", other)}).drop("n_parts")


def _links(rows: DataFrame, size: int, least: float, blocks: int, most: int) -> list[DataFrame]:
    """kind 0: an edge (a, b); kind 1: vector a links with b vectors more. Written round by round."""
    budget = 2 * (1 - least) + SLACK
    rotation = _rotation(rows, size)
    columns = block_columns(size, blocks)
    radius = [math.sqrt(budget * len(held) / size) + SLACK for held in columns]
    rows = rows.where(F.size("vector") == size).select("id", "copies", "label", "vector")
    most = max(1, min(most, VALUES // size))
    large = settle(rows.groupBy("label").agg(F.ceil(F.count("*") / most).cast("int").alias("n_parts")).where("n_parts > 1"))  # fewer than one row per ``most``
    rounds = large.agg(F.max("n_parts")).first()[0] or 1
    dealt = rows.join(F.broadcast(large), "label", "left").withColumn("n_parts", F.coalesce("n_parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.hash("id"), F.col("n_parts")))

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids, copies, part = (table.column(c).to_numpy() for c in ("id", "copies", "part"))
        vectors = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, size)
        # by a power of two, which rounds nothing, so that squares neither overflow nor vanish
        scaled = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1, keepdims=True))[1])
        norm = np.sqrt((scaled * scaled).sum(1))
        turned = turn(scaled / norm[:, None], rotation)
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        home, row = np.flatnonzero(part == low), np.flatnonzero(part == high)
        n_links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        if len(home) and len(row):
            held = [Block(turned[:, c], home, row, r) for c, r in zip(columns, radius)]
            home = held[0].order
            for at in range(0, len(home), HOMES):
                h = home[at:at + HOMES]
                candidate = np.zeros((len(h), len(row)), bool)
                for block, c in zip(held, columns):
                    block.mark(candidate, h, budget * len(c) / size + SLACK)
                every_i, every_j = np.nonzero(candidate)
                for start in range(0, len(every_i), PAIRS):
                    i, j = h[every_i[start:start + PAIRS]], row[every_j[start:start + PAIRS]]
                    i, j = i[ids[i] != ids[j]], j[ids[i] != ids[j]]
                    linked = (scaled[i] * scaled[j]).sum(1) / (norm[i] * norm[j]) >= least
                    i, j = i[linked], j[linked]
                    np.add.at(n_links, i, copies[j])
                    if low != high:  # within a part, each vector is a home
                        np.add.at(n_links, j, copies[i])
                    _join(root, i, j)
        a, b = ids[root], ids
        edge, some = np.flatnonzero(a != b), np.flatnonzero(n_links)
        return pa.table({"kind": pa.array(np.repeat([0, 1], [len(edge), len(some)]).astype(np.int32)),
                         "a": np.concatenate([a[edge], ids[some]]), "b": np.concatenate([b[edge], n_links[some]])})

    return [settle(_round(dealt, t).groupBy("label", "low", "high").applyInArrow(compare, "kind int, a long, b long").hint("rebalance")) for t in range(rounds)]


def similar_vectors(vectors: DataFrame, *, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", blocks: int = BLOCKS, most: int = BLOCK) -> DataFrame:
    """One row per row of ``vectors``: id_col, n_links (other vectors linked directly), component_id (least id reachable by
    links), kept (it is that least id)."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
                          F.col(vector_col).alias("vector"))
    if rows.schema["vector"].dataType.simpleString() not in ("array<float>", "array<double>"):
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    usable = _usable(rows)
    different = settle(_unit_rows(usable))
    sizes = [r.size for r in different.select(F.size("vector").alias("size")).distinct().collect()]  # dimensions in use
    same = settle(_same(usable, different))
    edges = same.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    rounds = [found for size in sorted(sizes) for found in _links(different, size, least, blocks, most)]
    let_go(different)
    links = None
    if rounds:
        found = reduce(DataFrame.unionByName, rounds)
        edges = edges.unionByName(found.where("kind = 0").select("a", "b"))
        links = found.where("kind = 1").groupBy(F.col("a").alias("first")).agg(F.sum("b").alias("more"))
    labels = components(edges)
    direct = same.select("id", "first", "copies")
    if links is None:
        direct = direct.withColumn("more", F.lit(None).cast("long"))
    else:
        direct = direct.join(links, "first", "left")
    direct = direct.groupBy("id").agg(F.max(F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("direct"))
    return (rows.select("id").join(direct, "id", "left").join(labels, "id", "left")
            .select(F.col("id").alias(id_col), F.coalesce("direct", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", F.col("id")).alias("component_id"),
                    F.coalesce(F.coalesce("component", F.col("id")) == F.col("id"), F.lit(True)).alias("kept")))
