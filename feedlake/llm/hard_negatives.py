"""Hard negatives for contrastive training, by a secondary sort of packed scores.

Every row with ``vec_id % ANCHOR_EVERY = 0`` is an anchor. Its positives are
its best rows of the same label; for each positive the best rows of other
labels whose score lies within a share of the positive's are its hard
negatives. Scores are integer inner products, compared exactly.

Anchors (a stated query set) meet all rows tile by tile: a chunk of anchors
against a block of rows is one matrix product in one task. A tile keeps only
what can still matter: first the best rows of each anchor's own label, and
then, as the positives and with them all windows are known, the best rows in
each window. What is kept is packed into keys (anchor, descending score,
positive before negative, id), dealt by anchor and sorted within partitions
(``repartition`` + ``sortWithinPartitions``, the DataFrame form of
``repartitionAndSortWithinPartitions``: the sort spills, nothing is
grouped). One pass over a partition opens a window for each positive it
meets and emits each negative into the open windows it belongs to, holding
no more than one anchor's windows.

Defined results: a row without ``vec_id``, label or vector, or with a null or
non-finite component, takes no part; vectors of different lengths do not
meet; rows that repeat a ``vec_id`` are rows each, so a repeated anchor has
its rows repeated and may be its twin's positive; ties of score go to the
smaller id; an anchor without positives or negatives gives no row; a score
beyond the range of a long counts as the nearest long; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedlake.llm.common import written

ANCHOR_EVERY = 100
MOVED_EVERY = 7  # rows whose label moves on by one, round LABELS
LABELS = 10
SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100  # a negative's score in percent of its positive's

MATRIX_BYTES = 32 << 20  # of a block's or chunk's matrix
TILE = 1 << 20  # scores in memory at once
EXACT = 2.0**53  # whole doubles below this add up exactly
LEAST, MOST = -(2**63), 2**63 - 1

MATRIX = "dim int, ids binary, labels binary, matrix binary"
PAIR = "anchor bigint, anchor_id bigint, id bigint, score bigint, own bigint"
FOUND = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
KEY = struct.Struct(">QQBQ")


def usable(rows: DataFrame) -> DataFrame:
    """``id, label, embedding`` of the rows that have all three, labels moved."""
    moved = F.when(F.col("vec_id") % MOVED_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    return rows.select(F.col("vec_id").cast("bigint").alias("id"), moved.cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("x"))


def matrices(rows: DataFrame, matrix_bytes: int = MATRIX_BYTES) -> DataFrame:
    """Rows of ``usable`` packed into matrices of floor(256 x), rows in ascending id: ``MATRIX``.

    A matrix holds vectors of one length; those with a null or non-finite component are left out.
    """

    def packed(dim, parts):
        ids, labels, q = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(ids, kind="stable")
        columns = [pa.array([x[order].tobytes()], pa.binary()) for x in (ids, labels, q)]
        return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *columns], ["dim", "ids", "labels", "matrix"])

    def run(batches):
        held: dict[int, list] = {}
        rows: dict[int, int] = {}
        for batch in batches:
            ids, labels = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            starts = batch.column(2).offsets.to_numpy()
            flat = pc.fill_null(batch.column(2).values, np.nan).to_numpy(zero_copy_only=False)
            lengths = np.diff(starts)
            for dim in map(int, np.unique(lengths)):
                at = np.flatnonzero(lengths == dim)
                x = flat[starts[at][:, None] + np.arange(dim)[None, :]]
                at, x = at[(fine := np.isfinite(x).all(axis=1))], x[fine]
                if not len(at):
                    continue
                with np.errstate(over="ignore"):
                    q = np.clip(np.floor(SCALE * x), -1e300, 1e300) + 0.0
                held.setdefault(dim, []).append((ids[at], labels[at], q))
                rows[dim] = rows.get(dim, 0) + len(at)
                if rows[dim] * max(1, dim) * 8 >= matrix_bytes:
                    yield packed(dim, held.pop(dim))
                    rows[dim] = 0
        for dim, parts in held.items():
            yield packed(dim, parts)

    return rows.mapInArrow(run, MATRIX)


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["labels"], np.int64), np.frombuffer(row["matrix"], np.float64).reshape(len(ids), row["dim"])


def _largest(x: np.ndarray) -> float:
    return float(np.abs(x).max()) if x.size else 0.0


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and ``b``, whole numbers held in doubles."""
    if _largest(a) * _largest(b) * max(1, a.shape[1]) < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape) for x in (a, b)]
    return np.clip(whole[0] @ whole[1].T, LEAST, MOST).astype(np.int64)


def best(s: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` of the places ``at`` with the highest scores, ties to the first."""
    if len(at) <= k:
        return at
    x = s[at]
    least = np.partition(x, len(x) - k)[len(x) - k]
    above, equal = at[x > least], at[x == least]
    return np.concatenate([above, equal[: k - len(above)]])


def in_window(score, positive: int):
    """Whether negatives of these scores may stand beside a positive of that score."""
    if isinstance(score, np.ndarray):
        # the least whole number of at least LOW percent, so that nothing overflows
        return (score >= min(MOST, -(-LOW * positive // HIGH))) & (score <= positive)
    return LOW * positive <= HIGH * score <= HIGH * positive


def _found_in(left: pa.Table, right: pa.Table) -> pa.Table:
    """What one chunk of anchors keeps of one block of rows.

    Without ``windows`` the best rows of each anchor's label, one more than
    needed as the anchor may be among them; with it the best of other labels
    in the window of each positive.
    """
    out: list[list] = [[], [], [], [], []]
    if left.num_rows and right.num_rows:
        chunk, block = left.to_pylist()[0], right.to_pylist()[0]
        first = "windows" not in chunk
        a_ids, a_labels, a = _unpacked(chunk)
        ids, labels, b = _unpacked(block)
        windows: dict[int, list[int]] = {}
        for w in () if first else chunk["windows"]:
            windows.setdefault(w["anchor"], []).append(w["score"])
        same = {int(x): np.flatnonzero(labels == x) for x in np.unique(labels)}
        none = np.zeros(0, np.int64)
        step = max(1, TILE // max(1, len(ids)))
        for lo in range(0, len(a_ids) if chunk["dim"] == block["dim"] else 0, step):
            s = scores(a[lo : lo + step], b)
            for i, x in enumerate(s, lo):
                key = chunk["chunk"] << 32 | i
                at, own = none, None
                if first:
                    own = int(scores(a[i : i + 1], a[i : i + 1])[0, 0])
                    at = best(x, same.get(int(a_labels[i]), none), POSITIVES + 1)
                elif key in windows:
                    top, low = max(windows[key]), min(LOW * p for p in windows[key])
                    near = np.flatnonzero((labels != a_labels[i]) & (x <= top) & (x >= max(LEAST, low // HIGH)))
                    at = np.unique(np.concatenate([best(x, near[in_window(x[near], p)], NEGATIVES) for p in set(windows[key])]))
                if len(at):
                    for column, values in zip(out, ([key] * len(at), [a_ids[i]] * len(at), ids[at], x[at], [own] * len(at)), strict=True):
                        column.extend(values)
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in out], ["anchor", "anchor_id", "id", "score", "own"])


def met(chunks: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every chunk against every block, each pair a group of its own: ``PAIR``.

    The driver sees the numbers of the matrices, one per ``MATRIX_BYTES`` of vectors. On both sides
    they are longs: an equal int hashes otherwise, and its group would not meet the other side's.
    """
    numbers = lambda df, key: F.explode(F.lit([r[0] for r in df.select(key).collect()]).cast("array<bigint>")).alias(key)
    left = chunks.select("*", numbers(blocks, "block")).groupBy("chunk", "block")
    right = blocks.select("*", numbers(chunks, "chunk")).groupBy("chunk", "block")
    return left.cogroup(right).applyInArrow(_found_in, PAIR)


def _ordered(value: Column) -> Column:
    """Sixteen hex digits whose order as text is that of the numbers."""
    return F.lpad(F.hex(value.bitwiseXOR(F.lit(LEAST))), 16, "0")


def packed_keys(pairs: DataFrame) -> DataFrame:
    """``anchor, anchor_id, key``; keys sort by anchor, falling score, positives first, id."""
    parts = [F.lpad(F.hex("anchor"), 16, "0"), _ordered(F.bitwise_not("score")), F.when(F.col("positive"), "00").otherwise("01"), _ordered(F.col("id"))]
    return pairs.select("anchor", "anchor_id", F.unhex(F.concat(*parts)).alias("key"))


def emitted(batches):
    """One pass over sorted keys: positives open windows, negatives fall into those they fit."""
    names = [c.split()[0] for c in FOUND.split(", ")]
    kinds = [pa.int32() if n == "rank" else pa.int64() for n in names]
    now, windows = None, []
    for batch in batches:
        out = []
        for anchor_id, key in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            anchor, falling, negative, row = KEY.unpack(key)
            score, row = -1 - (falling + LEAST), row + LEAST
            if anchor != now:
                now, windows = anchor, []
            if not negative:
                windows.append([row, score, 0])
                continue
            for window in windows:
                if window[2] < NEGATIVES and in_window(score, window[1]):
                    window[2] += 1
                    out.append((anchor_id, window[0], window[2], row, window[1], score))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)


def hard_negatives(embeddings: DataFrame, matrix_bytes: int = MATRIX_BYTES) -> DataFrame:
    """``FOUND`` of every anchor and positive of ``vec_id, embedding, label``."""
    spark = embeddings.sparkSession
    rows = usable(embeddings)
    number = F.monotonically_increasing_id()  # of a matrix; fixed by the write
    blocks = written(matrices(rows, matrix_bytes).withColumn("block", number), "vector-blocks")
    anchors = written(rows.filter(F.col("id") % ANCHOR_EVERY == 0), "anchors")
    size = anchors.agg(F.sum(F.size("x")) * 8).first()[0] or 0
    chunks = written(matrices(anchors.repartition(size // matrix_bytes + 1), matrix_bytes).withColumn("place", number), "anchor-chunks")
    # small numbers leave room for the anchor's place in the chunk
    places = {r[0]: n for n, r in enumerate(chunks.select("place").orderBy("place").collect())}
    if not places:
        return spark.createDataFrame([], FOUND)
    chunks = chunks.select(F.element_at(F.create_map(*(F.lit(x).cast("bigint") for kv in places.items() for x in kv)), F.col("place")).alias("chunk"), "dim", "ids", "labels", "matrix")

    first = met(chunks, blocks)
    order = W.partitionBy("anchor").orderBy(F.desc("score"), "id")
    top = first.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= POSITIVES + 1)
    # the anchor itself, if it is among them, is one row of its id and its own score
    self_like = (F.col("id") == F.col("anchor_id")) & (F.col("score") == F.col("own"))
    mine = F.min(F.when(self_like, F.col("r"))).over(W.partitionBy("anchor"))
    top = top.withColumn("mine", F.coalesce(mine, F.lit(POSITIVES + 1)))
    positives = written(top.filter(F.col("r") != F.col("mine")).select("anchor", "anchor_id", "id", "score"), "positives")
    windows = positives.groupBy(F.shiftright("anchor", 32).alias("chunk")).agg(F.collect_list(F.struct("anchor", "score")).alias("windows"))
    negatives = met(chunks.join(windows, "chunk"), blocks)

    pairs = positives.withColumn("positive", F.lit(True)).unionByName(negatives.select("anchor", "anchor_id", "id", "score", F.lit(False).alias("positive")))
    keyed = packed_keys(pairs).repartition("anchor").sortWithinPartitions("key")
    return keyed.mapInArrow(emitted, FOUND)
