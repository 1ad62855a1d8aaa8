"""Toxicity scores: a fuzzy lexicon matched in context.

Words and word beginnings that mark toxic texts are learned from labels and
put into a trie. The Levenshtein automaton of each word of a text is
intersected with that trie: the deterministic automaton of (trie node,
edits spent) sets is built as texts need its transitions, so misspelled
terms are caught at the cost of one table step per letter. Every hit is
weighed in a window of words around it: inside quotation marks or beside a
word that reports speech it counts as quotation, otherwise as abuse, misspelled
or not. A
logistic model over the two, their density and the misspelled part of the
abuse gives the score.

Learning reads a bounded sample (about ``per_class`` texts per label, taken
by hash of the id). Lexicon and model have a fixed size.

Defined results: null or empty text scores as a text without hits; without
labels of both classes every text scores 0.5 * base rate; repeated rows are
scored each; whole texts are read; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import written

WINDOW = 8  # words on either side of a hit
PREFIX = (4, 5, 6, 7)  # lengths of word beginnings that may become terms
MEMO = 400_000
ROOM = 1_000_000  # (trie node, edits) pairs and transitions that a task's automaton holds; words of one state set are few
WORDS = re.compile(r"[^\W\d_]+|[\"“”„«»‹›]")
MARKS = frozenset("\"“”„«»‹›")
# words that report speech, in the languages the data may have
REPORTING = frozenset(
    "said says wrote writes called calls quoted quote quoting reported accused insult insults sagte schrieb nannte "
    "zitat zitierte dit disait appelé citation écrit dijo dice escribió llamó cita".split()
)


@dataclass
class Lexicon:
    """Terms with weights; a term that ends in ``*`` stands for all words that begin so.

    ``fuzzy_weight`` has the terms that misspellings are looked for.
    """

    weight: dict[str, float]
    fuzzy_weight: dict[str, float] = field(default_factory=dict)


class Matcher:
    """The trie of a lexicon, intersected with Levenshtein automata, as a lazily built DFA.

    States are kept until they hold ``room`` pairs and transitions, then built anew as words need them.
    """

    def __init__(self, lexicon: Lexicon, room: int = ROOM):
        self.edits: dict[str, int] = {}
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.begin: list[str | None] = [None]
        self.allowed: list[int] = [0]  # most edits of any word below the node
        for word in sorted(lexicon.weight):
            at, stem = 0, word.rstrip("*")
            edits = self.edits[word] = edits_for(stem) if word in lexicon.fuzzy_weight else 0
            self.allowed[0] = max(self.allowed[0], edits)
            for ch in stem:
                if ch not in self.children[at]:
                    self.children[at][ch] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.begin.append(None)
                    self.allowed.append(0)
                at = self.children[at][ch]
                self.allowed[at] = max(self.allowed[at], edits)
            if word.endswith("*"):
                self.begin[at] = word
            else:
                self.term[at] = word
        self.alphabet = {ch for c in self.children for ch in c}
        self.room = room
        self._begin()
        self.known = _Known(self)

    def _begin(self) -> None:
        """An automaton without any state but the first."""
        self.ids: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.stems: list[str | None] = []  # the beginning spelled without edits in each state
        self.near: list[tuple[int, str] | None] = []  # the nearest beginning spelled with edits
        self.held = 0  # pairs in all states, and transitions
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        # a letter of a term may be missing from the word
        todo, best = list(pairs), {}
        while todo:
            node, e = todo.pop()
            if e > self.allowed[node] or best.get(node, 99) <= e:
                continue
            best[node] = e
            todo.extend((child, e + 1) for child in self.children[node].values())
        key = frozenset(best.items())
        if not key:
            return -1
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.held += len(key)
            self.states.append(key)
            self.steps.append({})
            self.stems.append(next((self.begin[node] for node, e in best.items() if e == 0 and self.begin[node]), None))
            near = [(e, self.begin[node]) for node, e in best.items() if self.begin[node] and 0 < e <= self.edits[self.begin[node]]]
            self.near.append(min(near, default=None))
        return self.ids[key]

    def _step(self, state: int, ch: str) -> int:
        out = set()
        for node, e in self.states[state]:
            for letter, child in self.children[node].items():
                out.add((child, e if letter == ch else e + 1))
            out.add((node, e + 1))  # a letter too many
        return self._state(out)

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its edits; whole words go before beginnings of the word, if both or neither need edits."""
        if self.held > self.room:
            self._begin()
        state, stem, near = self.start, None, None
        for ch in word:
            step = self.steps[state]
            if ch not in self.alphabet:
                ch = "\0"  # all letters that no term has are one
            if ch not in step:
                self.held += 1
                step[ch] = self._step(state, ch)
            state = step[ch]
            if state < 0:
                break
            stem = self.stems[state] or stem
            if self.near[state] and (near is None or self.near[state] < near):
                near = self.near[state]
        found = []
        if state >= 0:
            # short terms allow fewer edits than their neighbours in the trie
            found = [(e, self.term[node]) for node, e in self.states[state] if self.term[node] and e <= self.edits[self.term[node]]]
        if found and (min(found)[0] == 0 or not stem):
            e, term = min(found)
            return term, e
        if stem:
            return stem, 0
        return (near[1], near[0]) if near else None

    def lookup(self, words: list[str]):
        """A match or None for each word."""
        if len(self.known) > MEMO:
            self.known.clear()
        return map(self.known.__getitem__, words)


class _Known(dict):
    """Matches of the words seen lately."""

    def __init__(self, matcher: Matcher):
        self.matcher = matcher

    def __missing__(self, word: str) -> tuple[str, int] | None:
        hit = self[word] = self.matcher.match(word)
        return hit


def edits_for(term: str) -> int:
    """Most edits a term of so many letters may have."""
    return 2 if len(term) >= 9 else 1 if len(term) >= 5 else 0


FEATURES = ["abuse", "quotation", "misspelled", "density", "rate"]


def features(text: str, matcher: Matcher, lexicon: Lexicon) -> list[float]:
    """Sums of term weights by context; see ``FEATURES``."""
    words = WORDS.findall(text.lower())
    hits = [(i, h) for i, h in enumerate(matcher.lookup(words)) if h and (h[1] == 0 or lexicon.fuzzy_weight.get(h[0], 0.0) > 0)]
    if not hits:
        return [0.0] * len(FEATURES)
    marks = [i for i, w in enumerate(words) if w in MARKS]
    abuse = quotation = misspelled = 0.0
    crowd, at = 0, 0
    spots = [i for i, _ in hits]
    for n, (i, (term, edits)) in enumerate(hits):
        value = lexicon.fuzzy_weight[term] if edits else lexicon.weight[term]
        while spots[at] < i - WINDOW:
            at += 1
        crowd = max(crowd, n - at + 1)
        before = any(i - WINDOW <= m < i for m in marks)
        after = any(i < m <= i + WINDOW for m in marks)
        told = not REPORTING.isdisjoint(words[max(0, i - WINDOW) : i + WINDOW + 1])
        if (before and after) or told:
            quotation += value
        else:
            abuse += value
            misspelled += value if edits else 0.0
    rate = 100 * abuse / len(words)
    return [math.log1p(v) for v in (abuse, quotation, misspelled, max(0, crowd - 1), rate)]


def _sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """``text, y`` of about ``per_class`` texts per label, by hash of the id; all if there are fewer."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y"))
    known = known.filter("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y"))
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    share = F.when(F.col("y") == 1, min(1.0, per_class / n.get(1, 1))).otherwise(min(1.0, per_class / n.get(0, 1)))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) / (1 << 32)
    picked = known.filter(drawn < share).select("doc_id", "y")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # about 2 * per_class rows of two numbers
    return texts.join(F.broadcast(picked), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), "y")


def learn_lexicon(sample: DataFrame, least: int = 5, odds: float = 3.0, size: int = 4000) -> Lexicon:
    """Terms found in ``least`` toxic texts or more whose log-odds reach ``odds``; the ``size`` strongest."""

    def terms(batches):
        for batch in batches:
            out: dict[str, list[int]] = {}
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = {w for w in WORDS.findall(text.lower()) if len(w) >= PREFIX[0]}
                stems = {w[:n] + "*" for w in words for n in PREFIX if len(w) > n}
                for term in words | stems:
                    out.setdefault(term, [0, 0])[y] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(out), pa.string()), pa.array([v[0] for v in out.values()], pa.int64()), pa.array([v[1] for v in out.values()], pa.int64())],
                ["term", "n0", "n1"],
            )

    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = sample.mapInArrow(terms, "term string, n0 bigint, n1 bigint").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    rate = lambda c, y: (F.col(c) + 0.5) / F.lit(n.get(y, 0) + 1.0)
    weight = F.log(rate("n1", 1) / rate("n0", 0))
    strong = counts.filter(F.col("n1") >= least).withColumn("weight", weight).filter(F.col("weight") >= odds)
    top = strong.orderBy(F.desc("weight"), "term").limit(size).collect()  # bounded by ``size``
    best = {r["term"]: r["weight"] for r in top}
    # what a kept beginning covers adds nothing, but for words long enough to look for misspellings of
    kept, spelled = {}, {}
    for term in sorted(best, key=lambda t: (len(t.rstrip("*")), not t.endswith("*"), t)):
        stem = term.rstrip("*")
        covered = any(stem[:k] + "*" in kept for k in PREFIX if k <= len(stem))
        if not covered or (not term.endswith("*") and edits_for(stem)):
            kept[term] = best[term]
            if edits_for(stem):
                spelled[term] = best[term]
    return Lexicon(kept, spelled)


def weigh_misspellings(sample: DataFrame, lexicon: Lexicon) -> Lexicon:
    """Give each term the log-odds that a text with a misspelling of it, and without the term, is toxic."""
    shared = sample.sparkSession.sparkContext.broadcast(lexicon)  # of fixed size

    def near(batches):
        matcher = Matcher(shared.value)
        for batch in batches:
            out: dict[str, list[int]] = {}
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hits = {h for h in matcher.lookup(WORDS.findall(text.lower())) if h}
                exact = {t for t, e in hits if e == 0}
                for term in {t for t, e in hits if e} - exact:
                    out.setdefault(term, [0, 0])[y] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(out), pa.string()), pa.array([v[0] for v in out.values()], pa.int64()), pa.array([v[1] for v in out.values()], pa.int64())],
                ["term", "n0", "n1"],
            )

    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = sample.mapInArrow(near, "term string, n0 bigint, n1 bigint").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    # one row per term of the lexicon at most
    rows = {r["term"]: (r["n0"], r["n1"]) for r in counts.collect()}
    odds = lambda a, b: math.log((b + 0.5) / (n.get(1, 0) + 1)) - math.log((a + 0.5) / (n.get(0, 0) + 1))
    # a misspelling never seen in a clean text of the sample still counts, by half its term's weight
    fuzzy = {t: odds(*rows[t]) if t in rows else 0.5 * w for t, w in lexicon.fuzzy_weight.items()}
    # terms whose near matches are as common in clean texts are looked for as spelled
    return Lexicon(lexicon.weight, {t: w for t, w in fuzzy.items() if w > 0})


@dataclass
class Model:
    lexicon: Lexicon
    coef: list[float]  # intercept first
    mean: list[float]
    scale: list[float]


def train(docs: DataFrame, labels: DataFrame, per_class: int = 4000) -> Model:
    """Learn lexicon and logistic model; ``labels`` has ``doc_id, toxic``."""
    sample = written(_sample(docs, labels, per_class).repartition(64), "toxicity-sample")
    lexicon = weigh_misspellings(sample, learn_lexicon(sample))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # of fixed size

    def run(batches):
        lex = shared.value
        matcher = Matcher(lex)
        for batch in batches:
            rows = [features(t, matcher, lex) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).cast(pa.int64()), *[pa.array([r[j] for r in rows], pa.float64()) for j in range(len(FEATURES))]],
                ["y", *FEATURES],
            )

    schema = "y bigint, " + ", ".join(f"{f} double" for f in FEATURES)
    got = sample.mapInArrow(run, schema).toArrow()  # 2 * per_class short rows
    x = np.column_stack([got.column(f).to_numpy() for f in FEATURES]) if got.num_rows else np.zeros((0, len(FEATURES)))
    y = got.column("y").to_numpy().astype(float)
    return Model(lexicon, *fit(x, y))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[list[float], list[float], list[float]]:
    """Logistic regression by Newton steps; coefficients, means and scales of the features."""
    d = len(FEATURES)
    if len(y) == 0 or y.min() == y.max():
        p = min(0.499, 0.5 * float(y.mean())) if len(y) else 0.25
        return [math.log((p + 1e-6) / (1 - p))] + [0.0] * d, [0.0] * d, [1.0] * d
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.column_stack([np.ones(len(y)), (x - mean) / scale])
    w, penalty = np.zeros(d + 1), np.diag([0.0] + [ridge] * d)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + penalty @ w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty + 1e-9 * np.eye(d + 1), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist(), mean.tolist(), scale.tolist()


def probability(x: list[float], model: Model) -> float:
    z = model.coef[0] + sum(c * (v - m) / s for c, v, m, s in zip(model.coef[1:], x, model.mean, model.scale, strict=True))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted`` and the context sums of every row; only ``text`` is judged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        matcher = Matcher(m.lexicon)
        for batch in batches:
            rows = [features(t or "", matcher, m.lexicon) for t in batch.column(1).to_pylist()]
            scores = [probability(r, m) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                    *[pa.array([r[j] for r in rows], pa.float64()) for j in range(len(FEATURES))],
                ],
                ["doc_id", "score", "predicted", *FEATURES],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id bigint, score double, predicted int, " + ", ".join(f"{f} double" for f in FEATURES)
    return rows.mapInArrow(run, schema)
