"""Quality rules: base statistics, then robust multivariate outliers per language and source.

The statistics of each document become a vector of logarithms; every
(language, source) group gets a minimum-covariance-determinant estimate of
location and scatter by concentration steps, all groups at once as grouped
aggregates, and a vector whose Mahalanobis distance is too large is
rejected. No group is gathered: quantiles are sketches, means and
covariances are partial aggregates, and rows meet their group's estimate by
a size-checked broadcast or over salts.

Defined results: null or empty text has 0 words and fails the base rule;
null language or source is a group of its own; groups under ``min_group``
rows share one pooled estimate; groups whose statistics do not vary are
judged by the floor of the spread; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import BLANK_CLASS, BLANKS, code_points, text_or_empty, written

# Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
VECTOR = ["v_chars", "v_symbols", "v_lines", "v_repeat"]
# the least standard deviation a coordinate is given (natural logarithms): what varies less is not told apart
FLOOR = (0.08, 0.35, 0.5, 0.8)
SUBSET = 0.75  # share of a group the estimate is taken from
# chi-square with 4 degrees of freedom: consistency factor of the subset's scatter, cut-off at 1e-6
CONSISTENCY = 1.4863
CUTOFF = 33.4
D = range(len(VECTOR))
STARTS = ("_plain", "_tanh", "_sign")
EARLY, MOST_STEPS, SETTLED = 2, 20, 1e-3
SMALL_GROUPS = 50_000  # groups that may be broadcast: at most 45 numbers each, 18 MB
SALT = 64


def base_stats(docs: DataFrame, *keep: str, spare_bits: int = 0) -> DataFrame:
    """Statistics of every row beside the columns ``keep``.

    ``spare_bits`` takes that many bits from the hash of a window; the result does not depend on it.

    Each step is a projection of its own, as the arrays it makes are read
    more than once by the next.
    """
    text = text_or_empty()
    trimmed = F.btrim(text, F.lit(BLANKS))
    split = F.when(trimmed != "", F.split(trimmed, BLANK_CLASS + "+")).otherwise(F.array().cast("array<string>"))
    # all symbols are single bytes
    symbols = sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in SYMBOLS), F.lit(0))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    a = docs.select(
        *keep,
        split.alias("words"),
        symbols.cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    n = F.size("words")
    # a window's hash with its place in the low bits: sorting these plain numbers brings equal windows together.
    # A text of n words leaves 64 - log2(n) bits of hash, so the words are compared below
    bits = F.ceil(F.log2(n + 1.0)).cast("int") + spare_bits
    windows = F.transform(
        F.slice("words", 1, F.greatest(n - 2, F.lit(0))),
        lambda w, i: F.call_function("shiftleft", F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)), F.col("bits")).bitwiseOR(i.cast("long")),
    )
    b = a.withColumn("bits", bits)
    b = b.select(
        *keep,
        n.cast("long").alias("n_words"),
        code_points(F.array_join("words", "")).alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "bits",
        "words",
        F.sort_array(windows).alias("windows"),
    )
    shifted = F.slice("windows", 2, F.greatest(F.size("windows") - 1, F.lit(0)))
    hash_of = lambda x: F.call_function("shiftright", x, F.col("bits"))
    place = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")) - 1
    at = lambda x: x.bitwiseAND(place).cast("int")
    pairs = F.zip_with("windows", shifted, lambda x, y: F.when(hash_of(x) == hash_of(y), F.struct(at(x).alias("x"), at(y).alias("y"))))
    c = b.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "words",
        F.filter(pairs, lambda p: p.isNotNull()).alias("pairs"),
    )
    word = lambda i, k: F.get("words", i + k)
    same = lambda p: (word(p["x"], 0) == word(p["y"], 0)) & (word(p["x"], 1) == word(p["y"], 1)) & (word(p["x"], 2) == word(p["y"], 2))
    ends = F.array_distinct(F.concat(F.transform("pairs", lambda p: p["x"]), F.transform("pairs", lambda p: p["y"])))
    d = c.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "words",
        F.sort_array(ends).alias("starts"), F.forall("pairs", same).alias("sure"),
    )
    # where neighbours differ, windows of one hash may lie mixed: sort these by their words (which hold no blank)
    spelled = F.transform("starts", lambda i: F.struct(F.concat_ws(" ", word(i, 0), word(i, 1), word(i, 2)).alias("w"), i.alias("i")))
    d = d.withColumn("spelled", F.when(~F.col("sure"), F.sort_array(spelled)))
    after = F.slice("spelled", 2, F.greatest(F.size("spelled") - 1, F.lit(0)))
    equal = F.zip_with("spelled", after, lambda x, y: F.when(x["w"] == y["w"], F.array(x["i"], y["i"])))
    exact = F.sort_array(F.array_distinct(F.flatten(F.filter(equal, lambda p: p.isNotNull()))))
    d = d.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.col("sure"), F.col("starts")).otherwise(exact).alias("starts"),
    )
    later = F.slice("starts", 2, F.greatest(F.size("starts") - 1, F.lit(0)))
    gaps = F.zip_with("starts", later, lambda x, y: F.least(F.coalesce(y - x, F.lit(3)), F.lit(3)).cast("long"))
    return d.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.aggregate(gaps, F.lit(0).cast("long"), lambda s, g: s + g).alias("n_repeat_words"),
    )


def vector(stats: DataFrame) -> DataFrame:
    """The statistics as four logarithms; rates are per hundred words."""
    per = lambda c: F.log1p(100.0 * F.col(c) / F.greatest(F.col("n_words"), F.lit(1)))
    return stats.withColumns(
        {
            "v_chars": F.log((F.col("word_chars") + 1.0) / (F.col("n_words") + 1.0)),
            "v_symbols": per("n_symbols"),
            "v_lines": per("n_dup_lines"),
            "v_repeat": per("n_repeat_words"),
        }
    )


def _distance(tag: str = "") -> Column:
    """Squared Mahalanobis distance by forward substitution on the Cholesky factor columns ``l_i_j``."""
    z: list[Column] = []
    for i, v in enumerate(VECTOR):
        rest = F.col(v) - F.col(f"m_{i}{tag}")
        for j in range(i):
            rest = rest - F.col(f"l_{i}_{j}{tag}") * z[j]
        z.append(rest / F.col(f"l_{i}_{i}{tag}"))
    return sum((x * x for x in z[1:]), z[0] * z[0])


def _factor(groups: DataFrame, tags: tuple[str, ...] = ("",)) -> DataFrame:
    """Cholesky factors of the scatters ``s_i_j`` (i >= j), one column at a time."""
    keep = ["g"]
    for tag in tags:
        for j in D:
            under = lambda i, j=j, tag=tag: sum((F.col(f"l_{i}_{k}{tag}") * F.col(f"l_{j}_{k}{tag}") for k in range(j)), F.lit(0.0))
            # the floor keeps the factor defined where a coordinate is a combination of the others
            square = F.greatest(F.col(f"s_{j}_{j}{tag}") - under(j), F.lit(FLOOR[j] ** 2))
            groups = groups.withColumn(f"l_{j}_{j}{tag}", F.sqrt(square))
            for i in range(j + 1, len(VECTOR)):
                groups = groups.withColumn(f"l_{i}_{j}{tag}", (F.col(f"s_{i}_{j}{tag}") - under(i)) / F.col(f"l_{j}_{j}{tag}"))
        keep += _columns(tag)
    return groups.select(*keep)


def _columns(tag: str = "") -> list[str]:
    return [f"m_{i}{tag}" for i in D] + [f"l_{i}_{j}{tag}" for i in D for j in range(i + 1)]


def _log_det(tag: str = "", of: str = "") -> Column:
    """Half the logarithm of the scatter's determinant."""
    return sum((F.log(F.col(f"{of}l_{i}_{i}{tag}")) for i in D), F.lit(0.0))


def _beside(rows: DataFrame, groups: DataFrame, n_groups: int, small: int = SMALL_GROUPS) -> DataFrame:
    """``rows`` with the columns of their group.

    Up to ``small`` groups of a few numbers are broadcast; more are copied
    for each ``salt``, so that the rows of one group meet in ``SALT`` tasks.
    """
    if n_groups <= small:
        return rows.join(F.broadcast(groups), "g")
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return rows.join(salted, ["g", "salt"])


def _starts(rows: DataFrame, n_groups: int, small: int) -> DataFrame:
    """First estimates per group, one per tag of ``STARTS``, all around the medians.

    Scatters of the standardised rows: none off the diagonal, the
    correlation of their hyperbolic tangents, and that of their directions.
    """
    med = rows.groupBy("g").agg(*[F.percentile_approx(v, 0.5).alias(f"m_{i}") for i, v in enumerate(VECTOR)])
    at = _beside(rows, written(med, "mcd-median"), n_groups, small)
    dev = at.groupBy("g").agg(
        *[F.first(f"m_{i}").alias(f"m_{i}") for i in D],
        *[(1.4826 * F.percentile_approx(F.abs(F.col(v) - F.col(f"m_{i}")), 0.5)).alias(f"d_{i}") for i, v in enumerate(VECTOR)],
    )
    dev = dev.withColumns({f"d_{i}": F.greatest(F.col(f"d_{i}"), F.lit(FLOOR[i])) for i in D})
    z = _beside(rows, written(dev, "mcd-deviation"), n_groups, small)
    z = z.select("g", *[f"m_{i}" for i in D], *[f"d_{i}" for i in D], *[((F.col(v) - F.col(f"m_{i}")) / F.col(f"d_{i}")).alias(f"z_{i}") for i, v in enumerate(VECTOR)])
    norm2 = sum((F.col(f"z_{i}") * F.col(f"z_{i}") for i in D), F.lit(0.0))
    z = z.withColumn("norm2", norm2)
    pairs = [(i, j) for i in D for j in range(i + 1)]
    both = z.groupBy("g").agg(
        *[F.first(c).alias(c) for i in D for c in (f"m_{i}", f"d_{i}")],
        *[F.covar_pop(F.tanh(f"z_{i}"), F.tanh(f"z_{j}")).alias(f"t_{i}_{j}") for i, j in pairs],
        *[F.avg(F.when(F.col("norm2") > 0, F.col(f"z_{i}") * F.col(f"z_{j}") / F.col("norm2")).otherwise(0.0)).alias(f"u_{i}_{j}") for i, j in pairs],
    )
    # a coordinate that does not vary has no correlation
    spread = lambda i, j: F.sqrt(F.col(f"t_{i}_{i}") * F.col(f"t_{j}_{j}"))
    tanh = lambda i, j: F.when(spread(i, j) > 0, F.col(f"t_{i}_{j}") / spread(i, j)).otherwise(0.0)
    scatter = {
        "_plain": lambda i, j: F.lit(1.0 if i == j else 0.0),
        "_tanh": lambda i, j: F.lit(1.0) if i == j else tanh(i, j),
        "_sign": lambda i, j: len(VECTOR) * F.col(f"u_{i}_{j}"),
    }
    both = both.withColumns(
        {f"s_{i}_{j}{tag}": F.col(f"d_{i}") * F.col(f"d_{j}") * scatter[tag](i, j) for tag in STARTS for i, j in pairs}
        | {f"m_{i}{tag}": F.col(f"m_{i}") for tag in STARTS for i in D}
    )
    return _factor(both, STARTS)


def _concentrate(rows: DataFrame, now: DataFrame, n_groups: int, small: int, tags: tuple[str, ...] = ("",)) -> DataFrame:
    """One step: the ``SUBSET`` nearest rows of each group give the next mean and covariance, for each tag in one pass.

    ``now`` is a written table. The cut is the distance of a row, so a group keeps one row at least.
    """
    near = _beside(rows, now, n_groups, small)
    cut = near.groupBy("g").agg(*[F.percentile_approx(_distance(t), SUBSET).alias(f"cut{t}") for t in tags])
    at = _beside(rows, written(now.join(cut, "g"), "mcd-cut"), n_groups, small)
    inside = at.select("g", *[F.when(_distance(t) <= F.col(f"cut{t}"), F.col(v)).alias(f"{v}{t}") for t in tags for v in VECTOR])
    new = inside.groupBy("g").agg(
        *[F.avg(f"{v}{t}").alias(f"m_{i}{t}") for t in tags for i, v in enumerate(VECTOR)],
        *[(CONSISTENCY * F.covar_pop(f"{VECTOR[i]}{t}", f"{VECTOR[j]}{t}")).alias(f"s_{i}_{j}{t}") for t in tags for i in D for j in range(i + 1)],
    )
    return written(_factor(new, tags), "mcd-step")


def estimates(rows: DataFrame, n_groups: int, small: int = SMALL_GROUPS) -> DataFrame:
    """Robust location and Cholesky factor per group ``g`` of ``g, salt`` and vector rows.

    ``EARLY`` concentration steps from every start, then the start of least
    determinant goes on, until no group's determinant moves by more than
    ``SETTLED`` (or ``MOST_STEPS`` are done). No step raises a determinant,
    but for the error of the approximate quantile.
    """
    now = written(_starts(rows, n_groups, small), "mcd-start")
    for _ in range(EARLY):
        now = _concentrate(rows, now, n_groups, small, STARTS)
    least = F.least(*[_log_det(t) for t in STARTS])
    best = lambda c: F.coalesce(*[F.when(_log_det(t) == least, F.col(f"{c}{t}")) for t in STARTS])
    now = written(now.select("g", *[best(c).alias(c) for c in _columns()]), "mcd-best")
    for _ in range(MOST_STEPS):
        new = _concentrate(rows, now, n_groups, small)
        was = now.select("g", _log_det().alias("was"))
        moved = new.join(was, "g").agg(F.max(F.abs(_log_det() - F.col("was")))).first()[0]
        now = new
        if moved is None or moved <= SETTLED:
            break
    return now


def quality(docs: DataFrame, min_group: int = 100, cutoff: float = CUTOFF, small: int = SMALL_GROUPS) -> DataFrame:
    """Statistics, base rule and verdict of every row.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, distance2, kept``. The estimate is taken
    over the rows that pass the base rule; rows that fail it are not kept.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        "text",
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = base_stats(rows, "doc_id", "lang", "source")
    # fixed by the write: rows of one group are dealt over the salts
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALT)).cast("int")
    stats = written(vector(stats).withColumns({"base_failed": failed, "salt": salt, "by": F.xxhash64("lang", "source")}), "quality-stats")
    passed = stats.filter("not base_failed")
    sizes = passed.groupBy("by", "lang", "source").agg(F.count(F.lit(1)).alias("n"))
    # a number per group; 0 is the pooled one
    name = F.when(F.col("n") >= min_group, F.monotonically_increasing_id() + 1).otherwise(F.lit(0))
    groups = written(sizes.select(F.col("by").alias("g"), F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), name.alias("name")), "quality-groups")
    n_groups = groups.count()
    own = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    labelled = _beside(passed.withColumnRenamed("by", "g"), groups, n_groups, small).filter(own)
    labelled = written(labelled.select("doc_id", *STATS, *VECTOR, "base_failed", F.col("name").alias("g"), "salt"), "quality-vectors")
    estimate = estimates(labelled.select("g", "salt", *VECTOR), n_groups, small)
    judged = _beside(labelled, estimate, n_groups, small)
    judged = judged.select("doc_id", *STATS, "base_failed", _distance().alias("distance2"))
    judged = judged.withColumn("kept", F.col("distance2") <= F.lit(cutoff))
    rest = stats.filter("base_failed").select(
        "doc_id", *STATS, "base_failed", F.lit(None).cast("double").alias("distance2"), F.lit(False).alias("kept")
    )
    return judged.unionByName(rest)
