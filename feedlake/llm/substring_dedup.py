"""Substring deduplication by level-wise doubling of repeated word windows.

A window of ``window`` words can only repeat if its halves do. So short
windows are looked at first, and only where they repeat are they extended
to twice their length (two that share a word or none make the longer one),
level by level up to ``window``, until no candidates survive. On the lowest
level it is enough to look at one short window in each long one, the one
with the smallest hash: equal long windows choose equal short ones.

Texts are staged once as blocks, bucketed by block, so that the answers of a
level are joined to them without shuffling text. Of a level only key hashes
travel: a block sends each key once (with the smallest id that has it, on
the last level), a cell of the hash range meets the blocks' keys, and
answers in the order they were sent. A passage in a third of all texts is
thus sent once per block.

On the last level a window is 64 bits of one hash and 16 of an independent
one, on top of its short window's 64-bit match.

Defined results: null or empty text has no words; a text shorter than the
window keeps all; equal ``doc_id``s do not remove from one another; a null
``doc_id`` counts as larger than any other; repeated rows are answered each;
extra columns are ignored; an empty table gives an empty result. Windows
are judged on the input, not on what is left.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm import spans
from feedlake.llm.common import bucketed, written

WINDOW = 13
LEAST = 7  # windows shorter than this repeat too often to tell anything
BLOCK_BYTES = 2 << 20
CELL_BYTES = 32 << 20
LEAST_CELLS = 256
LAST_ID = np.int64(2**63 - 1)  # stands for a null id


def levels(window: int) -> list[int]:
    """Window lengths from the shortest: each is twice the one before, less one if odd."""
    out = [window]
    while (out[0] + 1) // 2 >= LEAST:
        out.insert(0, (out[0] + 1) // 2)
    return out


class Block:
    """Words and keys of a block of texts, level by level."""

    def __init__(self, ids: list[int | None], texts: list[str | None], window: int):
        self.lengths = levels(window)
        self.ids = np.array([LAST_ID if i is None else i for i in ids], np.int64)
        self.raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        parts = [spans.Words(part) for _, part in spans.chunks(self.raw)]
        at = np.cumsum([0] + [len(p.first) - 1 for p in parts])
        self.text = np.concatenate([p.text + a for p, a in zip(parts, at[:-1], strict=True)] or [np.zeros(0, np.int64)])
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))
        self.hash = [np.concatenate([p.hashes(seed) for p in parts] or [np.zeros(0, np.uint64)]) for seed in (31, 32)]

    def _inside(self, n: int) -> np.ndarray:
        m = max(0, len(self.text) - n + 1)
        return self.text[:m] == self.text[n - 1 : n - 1 + m]

    def _keys(self, n: int) -> np.ndarray:
        return spans.windows(self.hash[0], n, 40 + n)

    def chosen(self, n: int, short: np.ndarray, m: int) -> np.ndarray:
        """For each window of ``n`` words, where its short window of ``m`` words with the smallest key starts."""
        width = n - m + 1
        if len(short) < width:
            return np.zeros(0, np.int64)
        view = np.lib.stride_tricks.sliding_window_view(short, width)
        out = np.empty(len(view), np.int64)
        for a in range(0, len(view), 1 << 17):
            out[a : a + (1 << 17)] = view[a : a + (1 << 17)].argmin(axis=1)
        return out + np.arange(len(view))

    def alive(self, answers: list[np.ndarray]) -> np.ndarray:
        """Starts of the candidates of the level after ``answers``."""
        n = self.lengths[0]
        if len(self.lengths) == 1:
            return np.flatnonzero(self._inside(n))
        long = self.lengths[1]
        short = self._keys(n)
        fits = np.flatnonzero(self._inside(long))
        pick = self.chosen(long, short, n)[fits]
        if not answers:
            return np.unique(pick)
        sent, multi = self._multi(short, np.unique(pick))
        again = sent[answers[0] | multi]
        at = fits[np.isin(short[pick], again)]
        for level in range(1, len(answers)):
            keys = self._keys(self.lengths[level])
            sent, multi = self._multi(keys, at)
            hit = np.zeros(len(keys) + 1, bool)
            hit[at] = np.isin(keys[at], sent[answers[level] | multi])
            step = self.lengths[level + 1] - self.lengths[level]
            fits = np.flatnonzero(self._inside(self.lengths[level + 1]))
            at = fits[hit[fits] & hit[np.minimum(fits + step, len(keys))]]
        return at

    def _multi(self, keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct keys at ``at``, and whether a key lies in more than one text."""
        k, t = keys[at], self.ids[self.text[at]]
        order = np.lexsort((t, k))
        k, t = k[order], t[order]
        new = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
        other = np.concatenate([[False], (k[1:] == k[:-1]) & (t[1:] != t[:-1])]) if len(k) else new
        group = np.cumsum(new) - 1
        return k[new], np.bincount(group[other], minlength=int(new.sum())) > 0

    def send(self, answers: list[np.ndarray]) -> np.ndarray:
        """Sorted distinct keys of an upper or lowest level."""
        return self._multi(self._keys(self.lengths[len(answers)]), self.alive(answers))[0]

    def last(self, answers: list[np.ndarray], n_cells: int):
        """Distinct windows of the last level in sending order, with the smallest id that has each.

        Returns the starts of all candidates and which distinct window each
        is, then per distinct window: key, check, smallest id, cell.
        """
        n = self.lengths[-1]
        at = self.alive(answers)
        key = self._keys(n)[at]
        proof = (spans.windows(self.hash[1], n, 90)[at] >> np.uint64(48)).astype("<u2")
        of = self.ids[self.text[at]]
        order = np.lexsort((of, proof, key))
        k, p = key[order], proof[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (p[1:] != p[:-1])]) if len(k) else np.zeros(0, bool)
        group = np.empty(len(at), np.int64)
        group[order] = np.cumsum(new) - 1
        key, proof, low = k[new], p[new], of[order][new]
        cell = spans.cells_of(key, n_cells)
        # by cell, then id: ids come in runs
        sending = np.lexsort((key, low, cell))
        place = np.empty(len(sending), np.int64)
        place[sending] = np.arange(len(sending))
        return at, place[group], key[sending], proof[sending], low[sending], cell[sending]


def _answers(batch_row, upto: int) -> list[np.ndarray]:
    """Answers of the levels before ``upto`` as boolean arrays in sending order."""
    by: list[list[tuple[int, bytes, int]]] = [[] for _ in range(upto)]
    for r in batch_row or []:
        if r["level"] < upto:
            by[r["level"]].append((r["cell"], r["answer"], r["n"]))
    return [
        np.concatenate([np.unpackbits(np.frombuffer(a, np.uint8), count=n) for _, a, n in sorted(rows)] or [np.zeros(0, np.uint8)]).astype(bool)
        for rows in by
    ]


def _blocks(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield [c[i].as_py() for c in batch.columns]


def stage(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Texts as rows of about ``block_bytes`` each, in a table bucketed by block."""
    def pack(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            for a, b in _runs((np.cumsum(sizes) - sizes) // block_bytes):
                lists = [pa.array([c.slice(a, b - a)], pa.list_(t)) for c, t in ((ids, pa.int64()), (texts, pa.string()))]
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *lists], ["block", "ids", "texts"])
                block += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    packed = rows.mapInArrow(pack, "block bigint, ids array<bigint>, texts array<string>")
    return bucketed(packed, "blocks", "block")


def _ask(blocks: DataFrame, window: int, level: int, n_cells: int) -> DataFrame:
    """``block, cell, level, n, answer``: which of a block's keys another block has too, as bits."""

    def send(batches):
        for block, ids, texts, *before in _blocks(batches):
            answers = _answers(before[0] if before else None, level)
            keys = Block(ids, texts, window).send(answers)
            cells = spans.cells_of(keys, n_cells)
            cut = np.flatnonzero(np.diff(cells, prepend=-1))
            if len(cut):
                groups = [spans.planes(g) for g in np.split(keys, cut[1:])]
                yield spans.binary_rows(cells[cut], [block] * len(cut), groups, names=["cell", "block", "keys"], kinds=[pa.int64(), pa.int64(), pa.binary()])

    def meet(table: pa.Table) -> pa.Table:
        sent = [spans.unplanes(k.as_py()) for k in table.column("keys")]
        keys = np.concatenate(sent)
        order = np.argsort(keys, kind="stable")
        k = keys[order]
        same = np.concatenate([[False], k[1:] == k[:-1], [False]])
        again = np.empty(len(k), bool)
        again[order] = same[1:] | same[:-1]
        sizes = [len(s) for s in sent]
        parts = np.split(again, np.cumsum(sizes)[:-1])
        return pa.table(
            {
                "block": table.column("block"),
                "cell": table.column("cell"),
                "level": pa.array([level] * len(sent), pa.int32()),
                "n": pa.array(sizes, pa.int32()),
                "answer": pa.array([np.packbits(p).tobytes() for p in parts], pa.binary()),
            }
        )

    sent = blocks.mapInArrow(send, "cell bigint, block bigint, keys binary")
    return sent.groupBy("cell").applyInArrow(meet, "block bigint, cell bigint, level int, n int, answer binary")


def _ask_last(blocks: DataFrame, window: int, n_cells: int) -> DataFrame:
    """``block, cell, least``: the smallest id that has each window a block sent, where it is another's."""
    depth = len(levels(window)) - 1

    def send(batches):
        for block, ids, texts, *before in _blocks(batches):
            answers = _answers(before[0] if before else None, depth)
            _, _, key, proof, low, cell = Block(ids, texts, window).last(answers, n_cells)
            rows = []
            for a, b in _runs(cell):
                start = np.flatnonzero(np.concatenate([[True], low[a + 1 : b] != low[a : b - 1]]))
                runs = np.diff(start, append=b - a)
                rows.append((cell[a], block, key[a:b].astype("<u8").tobytes(), proof[a:b].tobytes(), low[a:b][start].astype("<i8").tobytes(), runs.astype("<u4").tobytes()))
            if rows:
                yield spans.binary_rows(*zip(*rows, strict=True), names=["cell", "block", "keys", "proof", "ids", "runs"], kinds=[pa.int64(), pa.int64()] + [pa.binary()] * 4)

    def meet(table: pa.Table) -> pa.Table:
        raw = lambda name, kind: [np.frombuffer(x.as_py(), kind) for x in table.column(name)]
        sent, proofs = raw("keys", "<u8"), raw("proof", "<u2")
        lows = [np.repeat(i, r) for i, r in zip(raw("ids", "<i8"), raw("runs", "<u4"), strict=True)]
        key, proof, low = np.concatenate(sent), np.concatenate(proofs), np.concatenate(lows)
        order = np.lexsort((low, proof, key))
        k, p = key[order], proof[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (p[1:] != p[:-1])])
        least = np.empty(len(k), np.int64)
        least[order] = low[order][new][np.cumsum(new) - 1]
        least[least == low] = -1  # its own: nothing to tell; equal numbers in runs compress away
        own = least == -1
        least[own] = LAST_ID
        parts = np.split(least, np.cumsum([len(s) for s in sent])[:-1])
        tell = [bool((x != LAST_ID).any()) for x in parts]
        out = pa.table({"block": table.column("block"), "cell": table.column("cell"), "least": pa.array([x.astype("<i8").tobytes() for x in parts], pa.binary())})
        return out.filter(pa.array(tell, pa.bool_()))

    sent = blocks.mapInArrow(send, "cell bigint, block bigint, keys binary, proof binary, ids binary, runs binary")
    return sent.groupBy("cell").applyInArrow(meet, "block bigint, cell bigint, least binary")


def _removed(block: Block, answers: list[np.ndarray], least_of: dict[int, bytes], window: int, n_cells: int) -> np.ndarray:
    """Which words of the block go."""
    at, which, key, _, low, cell = block.last(answers, n_cells)
    least = np.full(len(key), LAST_ID)
    for a, b in _runs(cell):
        if int(cell[a]) in least_of:
            least[a:b] = np.frombuffer(least_of[int(cell[a])], "<i8")
    least = np.minimum(least, low)
    gone = at[least[which] < block.ids[block.text[at]]]
    edge = np.zeros(len(block.text) + window + 1, np.int64)
    np.add.at(edge, gone, 1)
    np.add.at(edge, gone + window, -1)
    return np.cumsum(edge)[: len(block.text)] > 0


def _runs(x: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each run of equal values (none is negative); of nothing, no run."""
    cut = np.flatnonzero(np.diff(x, prepend=-1)).tolist()
    return list(zip(cut, [*cut[1:], len(x)][: len(cut)], strict=True))


def substring_dedup(docs: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every row; ``kept`` is the words that stay, one blank between."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_cells = max(LEAST_CELLS, total // CELL_BYTES)
    # as cells grow in number, blocks grow too, so that a row still carries many keys
    staged = stage(docs, block_bytes * n_cells // LEAST_CELLS)
    depth = len(levels(window)) - 1
    blocks, told = staged, None
    for level in range(depth):
        found = written(_ask(blocks, window, level, n_cells), f"level-{level}")
        told = found if told is None else told.union(found)
        per = told.groupBy("block").agg(F.collect_list(F.struct("level", "cell", "n", "answer")).alias("answers"))
        blocks = staged.join(per, "block", "left")
    last = written(_ask_last(blocks, window, n_cells), "level-last")
    lasts = last.groupBy("block").agg(F.collect_list(F.struct("cell", "least")).alias("least"))
    if not depth:
        blocks = blocks.withColumn("answers", F.lit(None).cast("array<struct<level:int,cell:bigint,n:int,answer:binary>>"))

    def finish(batches):
        for _, ids, texts, before, least in _blocks(batches):
            block = Block(ids, texts, window)
            gone = _removed(block, _answers(before, depth), {r["cell"]: r["least"] for r in least or []}, window, n_cells)
            kept, counts, removed = [], [], []
            for i, raw in enumerate(block.raw):
                mine = gone[block.first[i] : block.first[i + 1]]
                words = raw.split()
                n = int(mine.sum())
                kept.append(b" ".join(compress(words, ~mine) if n else words).decode("utf-8", "surrogatepass"))
                counts.append(len(words))
                removed.append(n)
            yield spans.binary_rows(ids, counts, removed, kept, names=["doc_id", "n_words", "n_removed", "kept"], kinds=[pa.int64(), pa.int64(), pa.int64(), pa.string()])

    final = blocks.join(lasts, "block", "left").select("block", "ids", "texts", "answers", "least")
    return final.mapInArrow(finish, "doc_id bigint, n_words bigint, n_removed bigint, kept string")
