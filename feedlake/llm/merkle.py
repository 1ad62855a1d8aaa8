"""Merkle manifest of a dataset, with a witness for every row.

Rows are leaves of one tree per partition value (``lang``); up to ``FANOUT``
consecutive nodes become their parent, until one is left. The subroots, in
order of that value, are the leaves of a last tree, whose top is the root.

Witnesses are built incrementally. Leaves are dealt in aligned blocks of
``FANOUT ** BLOCK_LEVELS``; a task appends the leaves of a block one by one.
A leaf's partial witness hangs on the open subtree that holds it, and each
sibling run that completes extends the witnesses below it. Block roots are
then appended the same way, in blocks of their own, level by level, and
their witnesses extend those of the leaves. Only digests are shuffled: texts
are hashed where they are read, positions come from a range sort and the row
counts of its partitions, and no task holds more than a block.

Defined results: a null field is ``-`` in its leaf, an empty one ``0:``; a
null ``lang`` is a tree of its own, before all others; null ``doc_id``s come
first, equal ones by leaf digest, repeated rows are leaves each; a null
``doc_id`` has no checksum, so the query leaves it untampered; texts of any
length are hashed whole; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedlake.llm.common import written

FANOUT = 8
BLOCK_LEVELS = 3  # levels that one task folds: 512 leaves
BLOCK = FANOUT**BLOCK_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(data: bytes) -> bytes:
    """Lowercase hex SHA-256: digests go into further ones as hex text."""
    return hashlib.sha256(data).hexdigest().encode()


def leaf(**changed: Column) -> Column:
    """Digest of a row's fields, each with its length in UTF-8 bytes; ``changed`` gives other values for some."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


class Frontier:
    """The open runs of a tree that is appended to, and the witnesses that hang on them.

    ``append`` returns a leaf's witness: a list of (digests to the left,
    digests to the right) per level, which grows as runs complete.
    """

    def __init__(self, witnesses: bool = True):
        self.open: list[list[tuple[bytes, list]]] = [[]]
        self.witnesses = witnesses

    def append(self, leaf: bytes) -> list[tuple[bytes, bytes]]:
        witness: list[tuple[bytes, bytes]] = []
        self._add(0, leaf, [witness] if self.witnesses else [])
        return witness

    def _add(self, level: int, node: bytes, below: list) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append((node, below))
        if len(self.open[level]) == FANOUT:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        nodes = [node for node, _ in run]
        for i, (_, below) in enumerate(run):
            siblings = (b"".join(nodes[:i]), b"".join(nodes[i + 1 :]))
            for witness in below:
                witness.append(siblings)
        self._add(level + 1, digest(b"".join(nodes)), [w for _, below in run for w in below])

    def close(self, levels: int) -> bytes:
        """Complete what is open below ``levels``; the node on top."""
        for level in range(levels):
            if level < len(self.open) and self.open[level]:
                self._complete(level)
        return self.open[levels][0][0]


def fold(node: bytes, witness: list[tuple[bytes, bytes]]) -> bytes:
    """The root that ``node`` leads to with these siblings."""
    for left, right in witness:
        node = digest(left + node + right)
    return node


def levels_of(n: int) -> int:
    """Levels that a block of a tree of ``n`` nodes is folded: until one is left if it is the only block."""
    if n > BLOCK:
        return BLOCK_LEVELS
    levels = 0
    while FANOUT**levels < n:
        levels += 1
    return levels


def positioned(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with their place ``pos`` in their tree by ``order`` and the tree's size ``n``.

    A window would sort each tree in one task. Here ranges are sorted side by
    side, and the sizes of the ranges before give each its first place.
    """
    by = ["tree", *order]
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    rows = written(rows.withColumn("at", F.monotonically_increasing_id()), "leaves-sorted")
    rows = rows.withColumn("part", F.shiftright("at", 33))
    parts = rows.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    earlier = W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")
    parts = parts.select("tree", "part", shift.alias("shift"), F.sum("rows").over(W.partitionBy("tree")).alias("n"))
    return rows.join(parts, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def blocked(nodes: DataFrame, *carry: str) -> DataFrame:
    """One row per aligned block: ``tree, block, n`` and its nodes in order, ``BLOCK`` at most."""
    rows = F.sort_array(F.collect_list(F.struct("pos", "node", *carry)))
    blocks = nodes.groupBy("tree", F.floor(F.col("pos") / BLOCK).cast("bigint").alias("block"), "n").agg(rows.alias("nodes"))
    return written(blocks, "blocks")


def _block_rows(batch: pa.RecordBatch):
    """Each row as a dict, one block's nodes in Python at a time."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _block_roots(blocks: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            out = []
            for row in _block_rows(batch):
                tree = Frontier(witnesses=False)
                for x in row["nodes"]:
                    tree.append(x["node"].encode())
                out.append((row["tree"], row["block"], -(-row["n"] // BLOCK), tree.close(levels_of(row["n"])).decode()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["tree", "pos", "n", "node"])

    return blocks.mapInArrow(run, "tree string, pos bigint, n bigint, node string")


def grown(nodes: DataFrame, *carry: str) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of blocks from the leaves up, and the top of each tree (``tree, node``)."""
    rounds = []
    while True:
        rounds.append(blocked(nodes, *carry))
        nodes, carry = written(_block_roots(rounds[-1]), "block-roots"), ()
        if (nodes.agg(F.max("n")).first()[0] or 1) == 1:
            return rounds, nodes.select("tree", "node")


def _witnesses(row: dict):
    """The nodes of a block with their witnesses up to the top that ``row`` has a witness of."""
    tree, upper = Frontier(), list(zip(row["witness"][0::2], row["witness"][1::2], strict=True))
    upper = [(left.encode(), right.encode()) for left, right in upper]
    own = [tree.append(x["node"].encode()) for x in row["nodes"]]
    tree.close(levels_of(row["n"]))
    for x, witness in zip(row["nodes"], own, strict=True):
        yield x, witness, upper


def _descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``tree, pos, witness`` of the nodes of the first round; ``tops`` are those of the last one's blocks."""

    def run(batches):
        for batch in batches:
            for row in _block_rows(batch):
                out = [(row["tree"], x["pos"], [p.decode() for pair in w + upper for p in pair]) for x, w, upper in _witnesses(row)]
                trees, places, paths = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(trees), pa.array(places, pa.int64()), pa.array(paths, pa.list_(pa.string()))], ["tree", "pos", "witness"]
                )

    for blocks in reversed(rounds):
        tops = tops.withColumnRenamed("pos", "block")
        tops = written(blocks.join(tops, ["tree", "block"]).mapInArrow(run, "tree string, pos bigint, witness array<string>"), "witnesses")
    return tops


PROVED = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def prove(docs: DataFrame, claimed: Column | None = None, siblings: bool = False) -> DataFrame:
    """Every row's leaf, tree tops and witness, checked against the leaf ``claimed`` where that is not null.

    Columns: ``doc_id, leaf, subroot, root, proof_sha256, folded_root,
    verified``, and with ``siblings`` the witness itself, ``[left, right,
    ...]`` level by level. ``claimed`` is a leaf digest over the columns of
    ``docs``, such as one received with the row; null claims the true one.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    claim = F.lit(None).cast("string") if claimed is None else claimed
    # hashed once: the range sort looks at its input twice
    leaves = written(docs.select(tree.alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"), leaf().alias("node"), claim.alias("claimed")), "leaves")
    rounds, subroots = grown(positioned(leaves, "doc_id", "node", "claimed"), "doc_id", "claimed")

    names = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    names = written(positioned(names, "name"), "subroots")
    upper, root = grown(names)
    top = root.first()
    if top is None:
        return docs.sparkSession.createDataFrame([], PROVED + (", siblings array<string>" if siblings else ""))
    start = root.select("tree", F.lit(0).cast("bigint").alias("pos"), F.array().cast("array<string>").alias("witness"))
    tops = _descend(upper, start).join(names.select("pos", "name", F.col("node").alias("subroot")), "pos")
    tops = written(tops.select(F.col("name").alias("tree"), F.lit(0).cast("bigint").alias("pos"), "witness", "subroot"), "subroot-witnesses")
    subroot = tops.select("tree", "subroot")
    tops = _descend(rounds[1:], tops.drop("subroot")).withColumnRenamed("pos", "block")
    blocks = rounds[0].join(tops, ["tree", "block"]).join(subroot, "tree")
    root_hex = top["node"].encode()

    def run(batches):
        for batch in batches:
            for row in _block_rows(batch):
                out = []
                for x, own, rest in _witnesses(row):
                    witness = own + rest
                    found = fold((x["claimed"] or x["node"]).encode(), witness)
                    proof = digest(b"".join(side for pair in witness for side in pair))
                    shown = ([side.decode() for pair in witness for side in pair],) if siblings else ()
                    out.append((x["doc_id"], x["node"], row["subroot"], root_hex.decode(), proof.decode(), found.decode(), found == root_hex, *shown))
                kinds = [pa.int64()] + [pa.string()] * 5 + [pa.bool_()] + [pa.list_(pa.string())] * siblings
                names = [c.split()[0] for c in PROVED.split(", ")] + ["siblings"] * siblings
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return blocks.mapInArrow(run, PROVED + (", siblings array<string>" if siblings else ""))
