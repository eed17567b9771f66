"""Operator 13: near-duplicate embeddings by a subspace pigeonhole join.

Two unit vectors have a cosine of ``threshold`` or more exactly if their squared distance is at most
``2 - 2 * threshold``. All vectors are turned by one random rotation, which spreads their differences
evenly, and split into blocks of ``BLOCK`` coordinates. Each block has a share of the squared distance in
proportion to its coordinates as its budget, so a pair that links keeps to the budget of one block at
least. Per label and block, a range join finds the pairs within that block's budget, and they are
verified on the whole vectors. A pair belongs to the first block whose budget it keeps, so the union
of the candidates holds it once and nothing has to be made distinct.

The range join lays a grid over the first ``g`` coordinates of a block, four budget radii wide; ``g``
follows from the number of vectors of the label (none for a small one). A vector is at home in its
own cell and a guest in the later ones that its radius reaches, so a pair meets in one cell of each block.
A cell of more than ``tile`` vectors is dealt to tiles, and each pair of tiles is a group of its own:
no task holds more than about two tiles, whatever share of the rows a label or a cell has. In a group,
vectors are sorted by one coordinate and compared in strips. Pairs never leave a group: it returns
a count and one edge to a local root for each vector that links.

Vectors that are equal, with their label, are one class; only classes are joined, with their number of
copies. Vectors of different length, or of different or no label, are not compared. Vectors that are
null or zero or hold null, NaN or infinite components link with nothing, nor do rows without a label.
Every row is a vector: rows equal in all columns link with each other, and a null vec_id never is
the smallest unless no other id is reachable. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kvadrat.llm.common import lean, stored
from kvadrat.llm.jaccard_join import components
from kvadrat.session import ship_package

THRESHOLD = 0.98
#: Coordinates of a block.
BLOCK = 8
#: Vectors of a tile; a label with more of them has a grid.
TILE = 4096
_STRIP = 128
_SEED = 13


class Space:
    """Rotation, blocks and budgets of vectors of one length."""

    def __init__(self, dim: int, threshold: float):
        turn, _ = np.linalg.qr(np.random.default_rng(_SEED).standard_normal((dim, dim)))
        self.turn = turn
        self.blocks = [slice(a, min(a + BLOCK, dim)) for a in range(0, dim, BLOCK)]
        # a hair more than the distance, for rounding
        whole = max(0.0, 2 - 2 * threshold) * (1 + 1e-9) + 1e-12
        self.budget = [whole * (b.stop - b.start) / dim for b in self.blocks]

    def rotated(self, unit: np.ndarray) -> np.ndarray:
        return unit @ self.turn


@lru_cache(maxsize=2)
def space(dim: int, threshold: float) -> Space:
    return Space(dim, threshold)


def _unit(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Unit vectors of a column of equally long lists; scaled first, so no square overflows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _axes(n: int, tile: int, width: float, most: int) -> tuple[int, int]:
    """Gridded coordinates of a block for ``n`` vectors, and cells that a coordinate can have. Turned unit
    vectors fill about three cells of a coordinate."""
    each = int(np.ceil(2 / width)) + 3
    wanted = 0 if n <= tile else int(np.ceil(np.log(n / tile) / np.log(3)))
    return min(wanted, most, int(62 // np.log2(each))), each


def _cells(y: np.ndarray, budget: float, n: int, tile: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, at home) of the vectors with block coordinates ``y``."""
    radius = np.sqrt(budget) * (1 + 1e-9)
    width = max(4 * radius, 1e-6)
    axes, each = _axes(n, tile, width, y.shape[1])
    row = np.arange(len(y))
    code, home = np.zeros(len(y), np.int64), np.zeros(len(y), np.int64)
    for a in range(axes):
        place = lambda x: np.floor((x + 1) / width).astype(np.int64) + 1
        low, mid, high = place(y[:, a] - radius), place(y[:, a]), place(y[:, a] + radius)
        home = home * each + mid
        more = np.flatnonzero(high[row] > low[row])
        code = np.concatenate([code * each + low[row], code[more] * each + high[row[more]]])
        row = np.concatenate([row, row[more]])
    keep = code >= home[row]
    row, code = row[keep], code[keep]
    return row, code, code == home[row]


def _placed(classes: DataFrame, threshold: float, tile: int) -> DataFrame:
    """node, block, cell, home: the cells of each class. ``classes`` has node, embedding, dim, peers."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, peers = batch.column("dim").to_numpy(), batch.column("peers").to_numpy()
            for dim, n in np.unique(np.stack([dims, peers], 1), axis=0).tolist():
                some = batch.filter(pa.array((dims == dim) & (peers == n)))
                held = space(dim, threshold)
                y = held.rotated(_unit(some.column("embedding")))
                for b, (part, budget) in enumerate(zip(held.blocks, held.budget)):
                    row, cell, home = _cells(y[:, part], budget, n, tile)
                    yield pa.RecordBatch.from_arrays(
                        [some.column("node").take(pa.array(row)), pa.array(np.full(len(row), b), pa.int32()), pa.array(cell), pa.array(home)],
                        names=["node", "block", "cell", "home"])

    rows = classes.select("node", "embedding", "dim", "peers")
    return rows.mapInArrow(lean(make), "node long, block int, cell long, home boolean")


def _compare(table: pa.Table, threshold: float) -> pa.Table:
    """node, n_links, root of the vectors of a group that link."""
    first = {c: table.column(c)[0].as_py() for c in ("dim", "block", "i", "j")}
    held, block = space(first["dim"], threshold), first["block"]
    x = _unit(table.column("embedding"))
    y = held.rotated(x)
    order = np.argsort(y[:, held.blocks[block].start], kind="stable")
    x, y = x[order], y[order]
    node, copies, home, slot = (table.column(c).to_numpy()[order] for c in ("node", "copies", "home", "slot"))
    parts = [np.ascontiguousarray(y[:, b]) for b in held.blocks[: block + 1]]
    norms = [(p * p).sum(axis=1) for p in parts]
    along, radius = parts[block][:, 0], np.sqrt(held.budget[block])
    links, root = np.zeros(len(node), np.int64), np.arange(len(node))
    for a in range(0, len(node), _STRIP):
        b = min(a + _STRIP, len(node))
        end = int(np.searchsorted(along, along[b - 1] + radius * (1 + 1e-6) + 1e-12, "right"))
        near = np.arange(a, b)[:, None] < np.arange(a, end)[None, :]  # each pair once
        near &= home[a:b, None] | home[None, a:end]
        if first["i"] != first["j"]:
            near &= slot[a:b, None] != slot[None, a:end]
        for k in range(block, -1, -1):  # within this block's budget, beyond those of all before
            apart = norms[k][a:b, None] + norms[k][None, a:end] - 2 * (parts[k][a:b] @ parts[k][a:end].T)
            near &= apart <= held.budget[k] if k == block else apart > held.budget[k]
            if not near.any():
                break
        else:
            left, right = np.nonzero(near)
            if len(left) <= 4 * _STRIP:
                near[left, right] = np.einsum("ij,ij->i", x[a + left], x[a + right]) >= threshold
            else:
                near &= x[a:b] @ x[a:end].T >= threshold
            links[a:b] += near @ copies[a:end]
            links[a:end] += copies[a:b] @ near
            for i in np.flatnonzero(near.any(axis=1)):
                met = np.unique(root[np.concatenate([[a + i], a + np.flatnonzero(near[i])])])
                if len(met) > 1:
                    root[np.isin(root, met)] = met[0]
    some = np.flatnonzero(links)
    return pa.table({"node": node[some], "n_links": links[some], "root": node[root[some]]})


def _valid(label: Column, embedding: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return label.isNotNull() & F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    tile: int = TILE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors that link with it), component_id (smallest
    vec_id reachable by links), kept (it is that one)."""
    ship_package(vectors.sparkSession)
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{vector_col}`").alias("embedding"),
        F.col(f"`{label_col}`").alias("label"),
    ).withColumn("valid", _valid(F.col("label"), F.col("embedding")))
    keys = [F.when(F.col("valid"), k).alias(n) for n, k in (
        ("k1", F.xxhash64("label", "embedding")), ("k2", F.xxhash64(F.lit(_SEED), F.reverse("embedding"), "label")))]
    keyed = rows.select("vec_id", "valid", "label", "embedding", *keys)
    classes = keyed.where("valid").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    # written: the numbers stay as they are
    classes = stored(classes.select(F.monotonically_increasing_id().alias("node"), "*", F.size("embedding").alias("dim")), "vector-classes")
    peers = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("peers"))
    placed = stored(_placed(classes.join(peers, ["label", "dim"]), threshold, tile), "vector-cells")

    at = placed.join(classes.select("node", "label", "dim"), "node")
    group = ["label", "dim", "block", "cell"]
    tiles = at.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("some")).where("some AND n > 1")
    tiles = tiles.select(*group, F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    slot = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int").alias("slot")
    dealt = at.join(tiles, group).select("node", "block", "cell", "home", slot, F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    dealt = dealt.select("node", "block", "cell", "home", "slot", F.least("slot", "other").alias("i"), F.greatest("slot", "other").alias("j"))
    met = dealt.join(classes.select("node", "label", "dim", "copies", "embedding"), "node")
    found = met.groupBy(*group, "i", "j").applyInArrow(
        lambda table: _compare(table, threshold), "node long, n_links long, root long")
    found = stored(found, "vector-links")

    links = found.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    reach = components(found.select(F.col("root").alias("a"), F.col("node").alias("b")))
    named = classes.select("node", "k1", "k2", "rep", "copies").join(reach.withColumnRenamed("doc_id", "node"), "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node")).join(links, "node", "left")
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "component").select(
        F.col("k1").alias("c1"), F.col("k2").alias("c2"), "component_id", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    joined = keyed.select("vec_id", "k1", "k2").join(named, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left")
    component = F.when(F.col("c1").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))
