"""Near duplicates among vectors by cosine: a subspace pigeonhole join, links and their components.

Unit vectors with a cosine of ``least`` or more are within a squared distance
of ``2 - 2 * least``. Vectors are rotated (signs and Hadamard, so that every
block of coordinates gets its share) and split into blocks of few
dimensions. Two vectors within the whole budget are within a block's share
of it (in proportion to its dimensions) in some block, so each block is
range-joined under its share: a grid over its first coordinates deals
vectors to cells twice as wide as the block's radius, a vector visits every
cell its ball touches, and within a cell the distances over the block select
the candidates. A candidate is verified exactly in the first block that
selects it, in double precision; so the candidates of all blocks are united
without ever being listed, and each link is counted once.

Cells are cut into chunks of bounded size, home chunks against visiting
ones, so that a crowd of near copies is spread over many tasks. A task
returns the number of links of each vector and a spanning star of what it
linked, never the pairs themselves. Equal vectors are one class from the
start.

Defined results: vectors that are null, empty or zero, or hold a null or
non-finite component link with nothing and are their own component; vectors
of different lengths do not link; rows that repeat a ``vec_id`` are vectors
each and all kept if their id is their component's; a null ``vec_id`` is
never a component's id (that of a component of such rows is null) and never
kept; values so large or small that squares overflow are scaled first;
extra columns, labels among them, are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.llm.common import written
from feedlake.llm.graph import connected, stars

LEAST = 0.95
BLOCK_DIMS = 16
GRID_DIMS = 2
CHUNK_ROWS = 1 << 15
SLAB = 1 << 20  # pairs looked at at once
PIECE = 1 << 16  # pairs verified at once
ROUNDING = 1e-5  # of squared distances in single precision
EXACT = 1e-9  # of sums in double precision
MOST_CELLS = 1 << 12  # per coordinate, far beyond what a radius needs


@lru_cache
def _signs(dim: int) -> np.ndarray:
    return np.random.default_rng(dim).integers(0, 2, (2, dim)) * 2.0 - 1.0


def rotated(x: np.ndarray) -> np.ndarray:
    """Rows turned by signs and a Hadamard matrix, twice, filled up with zeros to a power of two.

    Only sums and differences of whole columns, so that a row comes out the
    same in every task that has it.
    """
    dim = 1 << max(0, x.shape[1] - 1).bit_length()
    out = np.zeros((len(x), dim))
    out[:, : x.shape[1]] = x
    for signs in _signs(dim):
        out *= signs
        half = 1
        while half < dim:
            pairs = out.reshape(len(x), -1, 2, half)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), dim)
            half *= 2
        out /= np.sqrt(dim)
    return out


def units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Blocks:
    """Blocks of the rotated coordinates of vectors of ``dim`` values, and each one's share of the budget."""

    def __init__(self, dim: int, least: float, block_dims: int):
        self.dim = 1 << max(0, dim - 1).bit_length()
        self.starts = list(range(0, self.dim, block_dims))
        self.ends = [*self.starts[1:], self.dim]
        self.shares = np.array([(2 - 2 * least) * (e - s) / self.dim for s, e in zip(self.starts, self.ends, strict=True)]) * (1 + EXACT)

    def distances(self, difference: np.ndarray) -> np.ndarray:
        """Squared distances by block, of rows of differences."""
        return np.add.reduceat(difference * difference, self.starts, axis=1)

    def cells(self, r: np.ndarray):
        """(row, cell, home) triples: every cell that a row's ball touches, in every block."""
        rows, cells, homes = [], [], []
        everyone = np.arange(len(r))
        for b, (start, end) in enumerate(zip(self.starts, self.ends, strict=True)):
            radius = np.sqrt(self.shares[b]) * (1 + EXACT)
            reach = [(everyone, np.zeros(len(r)), np.full(len(r), b), np.ones(len(r), bool))]
            for c in range(start, min(end, start + GRID_DIMS)):
                own = np.floor(r[:, c] / (2 * radius))
                step = []
                for at, used, code, home in reach:
                    for move in (-1, 0, 1):
                        place = own[at] + move
                        # distance from the row to that cell, along this coordinate
                        gap = 0.0 if move == 0 else (r[at, c] - (place + 1) * 2 * radius if move < 0 else place * 2 * radius - r[at, c])
                        total = used + np.square(gap)
                        near = total <= radius * radius * (1 + EXACT)
                        step.append((at[near], total[near], (code * MOST_CELLS + place.astype(np.int64) % MOST_CELLS)[near], home[near] & (move == 0)))
                reach = step
            for at, _, code, home in reach:
                rows.append(at)
                cells.append(code * MOST_CELLS ** (GRID_DIMS - min(GRID_DIMS, end - start)))
                homes.append(home)
        return np.concatenate(rows), np.concatenate(cells), np.concatenate(homes)


@lru_cache
def blocks_of(dim: int, least: float, block_dims: int) -> Blocks:
    return Blocks(dim, least, block_dims)


def vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, digest, raw`` of every row; the last two null where the vector links with nothing."""
    kind = embeddings.schema["embedding"].dataType.elementType
    single = isinstance(kind, T.FloatType)

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            starts = column.offsets.to_numpy()
            flat = pc.fill_null(column.values, np.nan).to_numpy(zero_copy_only=False) + 0.0  # no -0.0
            none = column.is_null().to_numpy(zero_copy_only=False)
            raw, digests = [], []
            for i in range(batch.num_rows):
                x = flat[starts[i] : starts[i + 1]]
                fine = not none[i] and len(x) > 0 and np.isfinite(x).all() and x.any()
                raw.append(x.tobytes() if fine else None)
                digests.append(hashlib.blake2b(raw[-1], digest_size=16).digest() if fine else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(raw, pa.binary())], ["vec_id", "digest", "raw"])

    typed = "array<float>" if single else "array<double>"
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(typed).alias("embedding"))
    return rows.mapInArrow(run, "vec_id bigint, digest binary, raw binary")


def _matrix(raw: pa.Array, width: int) -> np.ndarray:
    x = np.frombuffer(b"".join(raw.to_pylist()), np.float32 if width == 4 else np.float64)
    return x.reshape(len(raw), -1).astype(np.float64)


def placed(classes: DataFrame, width: int, least: float, block_dims: int, chunk_rows: int) -> DataFrame:
    """Classes dealt to the tiles of their cells: ``dim, cell, home_chunk, visit_chunk, home, cls, weight, raw``."""

    def found(batch):
        """(rows of one length, their dimension, row, cell and home of each placement), 1024 rows at a time."""
        lengths = pc.binary_length(batch.column("raw")).to_numpy()
        for size in np.unique(lengths):
            of_size = np.flatnonzero(lengths == size)
            for part in np.array_split(of_size, len(of_size) // 1024 + 1):
                rows = batch.take(pa.array(part))
                dim = int(size) // width
                yield rows, dim, *blocks_of(dim, least, block_dims).cells(rotated(units(_matrix(rows.column("raw"), width))))

    def count(batches):
        for batch in batches:
            for _, dim, _, cell, home in found(batch):
                cells, at = np.unique(cell, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(cells), dim), pa.int32()), pa.array(cells), pa.array(np.bincount(at, home).astype(np.int64)), pa.array(np.bincount(at))],
                    ["dim", "cell", "homes", "visits"],
                )

    def place(batches):
        for batch in batches:
            for rows, dim, row, cell, home in found(batch):
                # a home row visits its own cell too
                row, cell = np.concatenate([row, row[home]]), np.concatenate([cell, cell[home]])
                home = np.concatenate([np.zeros(len(home), bool), np.ones(home.sum(), bool)])
                taken = rows.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), dim), pa.int32()), pa.array(cell), pa.array(home), *taken.columns], ["dim", "cell", "home", *taken.schema.names]
                )

    counts = classes.mapInArrow(count, "dim int, cell bigint, homes bigint, visits bigint").groupBy("dim", "cell").agg(F.sum("homes").alias("homes"), F.sum("visits").alias("visits"))
    chunks = lambda c: F.ceil(F.col(c) / chunk_rows).cast("int")
    # cells without a home row have nothing to compare
    counts = written(counts.filter("homes > 0").select("dim", "cell", chunks("homes").alias("n_home"), chunks("visits").alias("n_visit")), "cells")
    rows = classes.select("cls", "weight", "raw").mapInArrow(place, "dim int, cell bigint, home boolean, cls bigint, weight bigint, raw binary")
    rows = rows.join(counts, ["dim", "cell"])
    mine = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    rows = rows.withColumn("home_chunk", F.explode(F.when(F.col("home"), F.array(mine("n_home"))).otherwise(every("n_home"))))
    rows = rows.withColumn("visit_chunk", F.explode(F.when(F.col("home"), every("n_visit")).otherwise(F.array(mine("n_visit")))))
    return rows.drop("n_home", "n_visit")


def _exactly(i, j, home, visit, blocks: Blocks, b: int, least: float) -> np.ndarray:
    """Whether pairs link and ``b`` is the first block to select them."""
    out = np.zeros(len(i), bool)
    for lo in range(0, len(i), PIECE):
        p, q = i[lo : lo + PIECE], j[lo : lo + PIECE]
        inside = blocks.distances(home[1][p] - visit[1][q]) <= blocks.shares
        cosine = (home[0][p] * visit[0][q]).sum(axis=1)
        out[lo : lo + PIECE] = inside[:, b] & (inside.argmax(axis=1) == b) & (cosine >= least)
    return out


def linked(tile: pa.Table, width: int, least: float, block_dims: int) -> pa.Table:
    """Links between the home rows and the visitors of one tile: ``a, b, n``.

    With a null ``b`` a class and the rows it links with; else a pair in the same component.
    """
    out = [np.zeros((0, 2), np.int64)]
    dim, cell = tile.column("dim")[0].as_py(), tile.column("cell")[0].as_py()
    blocks = blocks_of(dim, least, block_dims)
    sides = []
    for side in (True, False):
        rows = tile.filter(pc.equal(tile.column("home"), side)).sort_by("cls")
        if not rows.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("a", "b", "n")})
        x = units(_matrix(rows.column("raw").combine_chunks(), width))
        sides.append((x, rotated(x), rows.column("cls").to_numpy(), rows.column("weight").to_numpy()))
    home, visit = sides
    degree = np.zeros(len(home[0]), np.int64)
    step = max(1, SLAB // len(visit[0]))
    b = cell // MOST_CELLS**GRID_DIMS
    shown = []
    for k in range(b + 1):
        at = slice(blocks.starts[k], blocks.ends[k])
        h, v = home[1][:, at].astype(np.float32), visit[1][:, at].astype(np.float32)
        square = lambda x: (x * x).sum(axis=1, keepdims=True)
        ones = lambda x: np.ones((len(x), 1), np.float32)
        # one product gives |h|^2 - 2 h v + |v|^2
        shown.append((np.hstack([-2 * h, square(h), ones(h)]), np.hstack([v, ones(v), square(v)]).T))
    for lo in range(0, len(home[0]), step):
        part = slice(lo, lo + step)
        distance = shown[b][0][part] @ shown[b][1]
        near = distance <= blocks.shares[b] + ROUNDING
        own = np.searchsorted(visit[2], home[2][part])
        hit = visit[2][np.minimum(own, len(visit[2]) - 1)] == home[2][part]
        near[np.flatnonzero(hit), own[hit]] = False
        if np.count_nonzero(near) > near.size // 16:
            # a crowd: settle what is clear by products
            cosine = home[0][part] @ visit[0].T
            near &= cosine >= least - EXACT
            clear = near & (cosine >= least + EXACT) & (distance <= blocks.shares[b] - ROUNDING)
            for k in range(b):
                over = shown[k][0][part] @ shown[k][1] - np.float32(blocks.shares[k])
                near &= over > -ROUNDING
                clear &= over > ROUNDING
            clear &= near
            i, j = np.nonzero(near & ~clear)
            sure = _exactly(i + lo, j, home, visit, blocks, b, least)
            clear[i[sure], j[sure]] = True
            i, j = np.nonzero(clear)
            i += lo
        else:
            i, j = np.nonzero(near)
            i += lo
            sure = _exactly(i, j, home, visit, blocks, b, least)
            i, j = i[sure], j[sure]
        if len(i):
            degree += np.bincount(i, visit[3][j], len(degree)).astype(np.int64)
            out.append(stars(i, j, home[2], visit[2]))
    pairs = np.unique(np.concatenate(out), axis=0)
    some = np.flatnonzero(degree)
    a = np.concatenate([home[2][some], pairs[:, 0]])
    b_column = pa.array(np.concatenate([np.zeros(len(some), np.int64), pairs[:, 1]]), mask=np.arange(len(a)) < len(some))
    n = np.concatenate([degree[some], np.zeros(len(pairs), np.int64)])
    return pa.Table.from_arrays([pa.array(a), b_column, pa.array(n)], ["a", "b", "n"])


def embedding_dedup(embeddings: DataFrame, least: float = LEAST, block_dims: int = BLOCK_DIMS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vec_id, embedding``."""
    rows = written(vectors(embeddings), "vectors")
    width = 4 if isinstance(embeddings.schema["embedding"].dataType.elementType, T.FloatType) else 8
    classes = rows.filter("digest is not null").groupBy("digest").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("weight"), F.min("raw").alias("raw"))
    classes = written(classes.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")

    def tile(table: pa.Table) -> pa.Table:
        return linked(table, width, least, block_dims)

    tiles = placed(classes, width, least, block_dims, chunk_rows).groupBy("dim", "cell", "home_chunk", "visit_chunk")
    links = written(tiles.applyInArrow(tile, "a bigint, b bigint, n bigint"), "vector-links")
    degree = links.filter("b is null").groupBy("a").agg(F.sum("n").alias("links")).withColumnRenamed("a", "cls")
    label = connected(links.filter("b is not null").select("a", "b")).withColumnRenamed("id", "cls")
    of = classes.select("digest", "cls", "least_id", "weight").join(degree, "cls", "left").join(label, "cls", "left")
    of = written(of.withColumn("comp", F.coalesce("comp", "cls")).drop("cls"), "vector-components")
    lowest = of.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    result = of.join(lowest, "comp").select("digest", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "digest").join(result, "digest", "left")
    alone = F.col("digest").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
