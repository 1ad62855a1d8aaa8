"""Language identification by bit-sliced Bloom filters over character n-grams.

Each language has a Bloom filter of its n-grams. The filters are stored
sliced: position p holds one bit per language, so that ANDing the k
positions of an n-gram yields the mask of all languages that contain it at
once. A text's hits per language are popcounts of those masks, corrected
for the filter's false positives; the language with the largest corrected
share wins, and that share is the score.

Training reads a bounded sample (rows whose hash is below a threshold that
leaves about ``per_language`` texts per language, so every size of table is
treated alike and no task gathers them) and counts its n-grams in Spark. The
model has a fixed size (``bits`` positions, a bit per language), so it is
safe to hand to every task. Only texts go through Python, in slices.

Defined results: null text or text without a letter is ``und`` with score
0; a text of letters always gets a learned language (ties: the first by
code point); languages of null label are not learned; an empty training set
gives ``und`` everywhere; whole texts are read; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedlake.llm.common import hand_back, written

SIZES = (2, 3, 4)
HASHES = 3
CHUNK = 1 << 17  # characters whose n-grams are in memory at once
SLICE_BYTES = 4 << 20  # of a batch's texts that are Python strings at once


@dataclass
class Model:
    languages: list[str]
    slices: np.ndarray  # (positions, 64-language words) of uint64
    false_rate: np.ndarray  # per language


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case code point of every letter, 0 for anything else."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _spell(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts, runs of other characters as one 0, and the text each belongs to."""
    table = _letters()
    raw = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    sizes = [len(r) + 2 for r in raw]
    joined = np.zeros(sum(sizes), np.uint32)
    at = 1
    for r, n in zip(raw, sizes, strict=True):
        joined[at : at + n - 2] = table[r]
        at += n
    doc = np.repeat(np.arange(len(texts)), sizes)
    keep = joined != 0
    keep[1:] |= joined[:-1] != 0  # the 0 that ends a word
    keep[0] = True
    return joined[keep].astype(np.uint64), doc[keep]


def _grams(seq: np.ndarray, doc: np.ndarray):
    """Hash and text of every n-gram inside a word and its two borders."""
    zero = seq == 0
    for n in SIZES:
        if len(seq) < n:
            continue
        m = len(seq) - n + 1
        h = np.full(m, n, np.uint64)
        ok = np.ones(m, bool)
        for i in range(n):
            h = h * np.uint64(0x100000001B3) + seq[i : i + m]
            if 0 < i < n - 1:
                ok &= ~zero[i : i + m]
        if n == 2:
            ok &= ~(zero[:m] & zero[1 : 1 + m])
        yield _mix(h[ok]), doc[n - 1 :][ok]


def _chunks(texts: list[str]):
    """Lists of (index, text) of about ``CHUNK`` characters; a longer text is a chunk of its own."""
    part, size = [], 0
    for i, t in enumerate(texts):
        if part and size + len(t) > CHUNK:
            yield part
            part, size = [], 0
        part.append((i, t))
        size += len(t)
    if part:
        yield part


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """``texts`` cut into runs of about ``SLICE_BYTES``; a longer text is one of its own."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    cut = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // SLICE_BYTES, prepend=-1)).tolist()
    for a, b in zip(cut, [*cut[1:], len(texts)][: len(cut)], strict=True):
        yield texts.slice(a, b - a)


def sampled(known: DataFrame, per_language: int) -> DataFrame:
    """``lang, text`` of about ``per_language`` rows of each language, by hash of the row; all if there are fewer."""
    size_of = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per language
    if not size_of:
        return known.select("lang", "text").limit(0)
    share = F.create_map(*(F.lit(x) for k, n in size_of.items() for x in (k, min(1.0, per_language / n))))
    # ids may be null or repeat, so the text has a say too
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 32)) / (1 << 32)
    return known.filter(drawn < F.element_at(share, F.col("lang"))).select("lang", "text")


def train(docs: DataFrame, per_language: int = 3000, min_count: int = 4, share: float = 0.125, bits: int = 1 << 20) -> Model:
    """Learn filters from the non-null ``lang`` and ``text`` of ``docs``.

    An n-gram belongs to a language if the sample has it there ``min_count``
    times and at no less than ``share`` of its largest rate over languages.
    """
    spark = docs.sparkSession
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    known = known.filter("lang is not null and text is not null")
    sample = sampled(known, per_language)

    def count(batches):
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            names = sorted(set(langs))
            index = np.array([names.index(x) for x in langs])
            for part in _chunks(texts):
                seq, doc = _spell([t for _, t in part])
                of = index[[i for i, _ in part]]
                for grams, where in _grams(seq, doc):
                    for k, name in enumerate(names):
                        g, c = np.unique(grams[of[where] == k], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(c.astype(np.int64))],
                            ["lang", "gram", "n"],
                        )

    counts = sample.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = written(counts, "language-grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    total_of = {r["lang"]: r["total"] for r in totals.collect()}  # one row per language
    languages = sorted(total_of)
    words = max(1, (len(languages) + 63) // 64)
    slices = np.zeros((bits, words), np.uint64)
    if languages:
        bit = [int(np.array(1 << (i % 64), np.uint64).view(np.int64)) for i in range(len(languages))]
        word, total = [i // 64 for i in range(len(languages))], [float(total_of[x]) for x in languages]
        # as Arrow: rows of Python objects go through workers of their own, which then wait beside the others
        ref = pa.table([languages, pa.array(word, pa.int32()), bit, total], names=["lang", "word", "bit", "total"])
        ref = spark.createDataFrame(ref)
        rate = F.col("n") / F.col("total")
        top = F.max("rate").over(W.partitionBy("gram"))
        own = counts.join(ref, "lang").withColumn("rate", rate).withColumn("top", top)
        own = own.filter((F.col("n") >= min_count) & (F.col("rate") >= share * F.col("top")))
        spots = [F.pmod(F.shiftrightunsigned(F.col("gram"), 20 * j), F.lit(bits)) for j in range(HASHES)]
        sliced = own.select(F.explode(F.array(*spots)).alias("spot"), "word", "bit")
        sliced = sliced.groupBy("spot", "word").agg(F.bit_or("bit").alias("mask"))
        got = sliced.toArrow()  # ``bits`` rows per 64 languages at most, whatever the input
        spot, word = got.column("spot").to_numpy(), got.column("word").to_numpy()
        slices[spot.astype(np.int64), word.astype(np.int64)] = got.column("mask").to_numpy().view(np.uint64)
    fill = [float(np.mean((slices[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1))) for i in range(len(languages))]
    return Model(languages, slices, np.array(fill) ** HASHES)


def score(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language (index), its corrected share, and whether there is a letter at all."""
    n, langs = len(texts), len(model.languages)
    hits, total = np.zeros((langs, n)), np.zeros(n)
    bits = np.uint64(len(model.slices) - 1)
    for part in _chunks(texts):
        seq, doc = _spell([t for _, t in part])
        where = np.array([i for i, _ in part])
        for grams, of in _grams(seq, doc):
            total[where] += np.bincount(of, minlength=len(part))
            rows = [((grams >> np.uint64(20 * j)) & bits).astype(np.int64) for j in range(HASHES)]
            for w in range(model.slices.shape[1]):
                column = model.slices[:, w]
                mask = column[rows[0]] & column[rows[1]] & column[rows[2]]
                for k in range(64 * w, min(langs, 64 * w + 64)):
                    hit = of[(mask >> np.uint64(k % 64)) & np.uint64(1) == 1]
                    hits[k, where] += np.bincount(hit, minlength=len(part))
    rate = hits / np.maximum(total, 1)
    fair = (rate - model.false_rate[:, None]) / (1 - np.minimum(model.false_rate, 0.999))[:, None]
    fair = np.clip(fair, 0, 1)
    if not langs:
        return np.zeros(n, int), np.zeros(n), np.zeros(n, bool)
    best = fair.argmax(0)
    return best, fair[best, np.arange(n)], total > 0


def identify(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """``doc_id, lang_pred, score`` and the columns ``keep`` of every row; only ``text`` is judged."""
    keep = [c for c in keep if c != "doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for texts in batches:
            parts = [(np.zeros(0, int), np.zeros(0), np.zeros(0, bool)), *(score(x.to_pylist(), m) for x in _slices(texts))]
            best, share, known = (np.concatenate(x) for x in zip(*parts, strict=True))
            names = [m.languages[b] if k else "und" for b, k in zip(best, known, strict=True)]
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.where(known, share, 0.0))], names=["lang", "share"])
        hand_back()

    # the other columns stay in the JVM; judged once, wherever the result is filtered
    found = F.arrow_udf(judge, "lang string, share double").asNondeterministic()
    rows = docs.withColumn("__found", found(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("__found.lang").alias("lang_pred"), F.col("__found.share").alias("score"), *keep)
