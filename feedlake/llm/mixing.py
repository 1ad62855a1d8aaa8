"""Mix sources to target weights by a low-discrepancy schedule of equal-token blocks.

Every source's documents are put in hash order and cut into blocks of
``block_words`` words. Slot k of the mix takes the golden-ratio point
frac(k * phi) and maps it through the cumulative block weights to a source;
the slot's rank among the slots of its source says which block it draws
(rank modulo number of blocks, so a second pass starts when the blocks are
used up). Nothing depends on partitioning: reruns agree.

Scale: ranks and offsets are prefix sums in two levels (inside bounded
cells, then over the cells' totals), so a source with a third of all rows
is never ordered in one task. Only tables with one row per source are
gathered; they are broadcast when Spark's own size check allows it.

Defined results: null text has size 0; a null source is a source of its own
and comes last; sizes of 0 take nothing; extra columns are ignored; an
empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedlake.llm.common import n_words, written

# weights by position in the ordered list of sources, repeating
WEIGHTS = (5, 2, 1)
GOLDEN = 0.6180339887498949  # frac(phi)
GRID = 1024  # cells of [0, 1) that turn the range lookup into an equi-join
CELLS = 1024  # cells of the hash order of one source
CHUNK = 65536  # slots ranked together


def source_targets(sizes: DataFrame, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``sid, source, n, source_size, target`` per source from ``source, size`` rows.

    Targets start as ``share`` of all sizes dealt by weight; a target over
    ``cap`` times its source's size stops there and the excess goes to the
    others by weight, until none is above. Each round is one aggregate.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    per = written(per.select("*", F.row_number().over(order).alias("sid")), "mix-sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), ((F.col("sid") - 1) % len(WEIGHTS)) + 1)
    per = per.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    total = per.agg(F.sum("source_size")).first()[0] or 0
    budget, level = share * total, 0.0
    n_open = None
    while True:
        # level: words per unit of weight; sources whose limit lies below their share are closed
        closed = F.col("limit") < F.col("weight") * F.lit(level)
        a = per.agg(
            F.sum(F.when(closed, F.col("limit"))).alias("used"),
            F.sum(F.when(~closed, F.col("weight"))).alias("open_weight"),
            F.count(F.when(~closed, 1)).alias("n_open"),
        ).first()
        if not a["n_open"] or a["n_open"] == n_open:
            break
        n_open = a["n_open"]
        level = (budget - (a["used"] or 0.0)) / a["open_weight"]
    return per.withColumn("target", F.least("limit", F.col("weight") * F.lit(float(level))))


def layout(sizes: DataFrame, targets: DataFrame, seed: int = 7) -> DataFrame:
    """Word interval ``[start, start + size)`` of each row in its source's hash order."""
    docs = sizes.join(targets.select("sid", F.col("source").alias("s")), F.col("source").eqNullSafe(F.col("s")))
    h = F.xxhash64("doc_id", "size", F.lit(seed))
    docs = docs.select("row", "sid", "size", h.alias("h"), F.pmod(F.shiftrightunsigned(h, 40), F.lit(CELLS)).alias("cell"))
    cells = docs.groupBy("sid", "cell").agg(F.sum("size").alias("cell_size"))
    before = F.sum("cell_size").over(W.partitionBy("sid").orderBy("cell")) - F.col("cell_size")
    cells = cells.select(F.col("sid").alias("c_sid"), F.col("cell").alias("c_cell"), before.alias("before"))
    inside = W.partitionBy("sid", "cell").orderBy("h", "row").rowsBetween(W.unboundedPreceding, -1)
    docs = docs.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return docs.join(cells, (F.col("sid") == F.col("c_sid")) & (F.col("cell") == F.col("c_cell"))).select(
        "row", "sid", "size", (F.col("before") + F.col("inside")).alias("start")
    )


def schedule(targets: DataFrame, block_words: int, passes: int = 2) -> DataFrame:
    """The mix: one row per slot with ``slot, sid, rank, block, pass_no``.

    A source is scheduled in proportion to the blocks its target needs;
    slots past its last whole pass (``passes``) are idle and left out.
    """
    spark = targets.sparkSession
    blocks = F.ceil(F.col("source_size") / F.lit(block_words)).cast("long")
    need = targets.filter(F.col("source_size") > 0).select(
        "sid", blocks.alias("n_blocks"), (blocks * F.col("target") / F.col("source_size")).alias("need")
    )
    total = need.agg(F.sum("need")).first()[0] or 0.0
    slots = int(round(total))
    hi = F.sum("need").over(W.orderBy("sid")) / F.lit(total or 1.0)
    bounds = need.select("sid", "n_blocks", "need", hi.alias("hi"))
    bounds = bounds.withColumn("lo", F.coalesce(F.lag("hi").over(W.orderBy("sid")), F.lit(0.0)))
    # the last bound is open, so that rounding of the sum leaves no gap
    bounds = bounds.withColumn("hi", F.when(F.lead("sid").over(W.orderBy("sid")).isNull(), 2.0).otherwise(F.col("hi")))
    first = F.floor(F.col("lo") * GRID)
    last = F.least(F.floor(F.col("hi") * GRID), F.lit(GRID))
    grid = bounds.select("sid", "n_blocks", "lo", "hi", F.explode(F.sequence(first, last)).alias("g"))
    # exact to the slot: k * phi keeps its fraction by splitting k, as a double loses it for large k
    k = F.col("id")
    big = F.floor(k / F.lit(1 << 20))
    step = (GOLDEN * (1 << 20)) % 1.0
    x = F.pmod(F.pmod(big * F.lit(step), F.lit(1.0)) + F.pmod((k % F.lit(1 << 20)) * F.lit(GOLDEN), F.lit(1.0)), F.lit(1.0))
    points = spark.range(slots).select(k.alias("slot"), x.alias("x")).withColumn("g", F.floor(F.col("x") * GRID))
    taken = points.join(grid, "g").filter("lo <= x and x < hi")
    taken = taken.select("slot", "sid", "n_blocks", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    counts = taken.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("c"))
    before = F.sum("c").over(W.partitionBy("sid").orderBy("chunk")) - F.col("c")
    counts = counts.select(F.col("sid").alias("k_sid"), F.col("chunk").alias("k_chunk"), before.alias("before"))
    ranked = taken.withColumn("r", F.row_number().over(W.partitionBy("sid", "chunk").orderBy("slot")) - 1)
    ranked = ranked.join(counts, (F.col("sid") == F.col("k_sid")) & (F.col("chunk") == F.col("k_chunk")))
    rank = F.col("before") + F.col("r")
    return ranked.select(
        "slot",
        "sid",
        rank.alias("rank"),
        (rank % F.col("n_blocks")).alias("block"),
        F.floor(rank / F.col("n_blocks")).alias("pass_no"),
    ).filter(F.col("pass_no") < passes)


def mix(docs: DataFrame, block_words: int = 64, share: float = 1.5, cap: float = 2.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """Words the mix takes of every document.

    Returns ``doc_id, source, size, source_size, target, taken`` and the
    columns ``keep``, named otherwise than what is used here: ``taken``
    counts repeats, and as a block is drawn at most ``cap`` (rounded down)
    times, no document exceeds that many times its size.
    """
    sizes = written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            n_words(F.col("text")).alias("size"),
            # repeated rows stay apart; fixed by the write below
            F.monotonically_increasing_id().alias("row"),
            *keep,
        ),
        "mix-sizes",
    )
    targets = source_targets(sizes, share, cap)
    plan = schedule(targets, block_words, int(cap))
    drawn = plan.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("draws"))
    placed = layout(sizes, targets)
    end = F.col("start") + F.col("size")
    first, last = F.floor(F.col("start") / block_words), F.floor((end - 1) / block_words)
    pieces = placed.filter("size > 0").select(
        "row", F.col("sid").alias("p_sid"), "start", end.alias("end"), F.explode(F.sequence(first, last)).alias("p_block")
    )
    lo, hi = F.col("p_block") * block_words, (F.col("p_block") + 1) * block_words
    pieces = pieces.withColumn("words", F.least("end", hi) - F.greatest("start", lo))
    taken = (
        pieces.join(drawn, (F.col("p_sid") == F.col("sid")) & (F.col("p_block") == F.col("block")))
        .groupBy("row")
        .agg(F.sum(F.col("words") * F.col("draws")).alias("taken"))
    )
    per = targets.select(F.col("source").alias("s"), "source_size", "target")
    return (
        sizes.join(per, F.col("source").eqNullSafe(F.col("s")))
        .join(taken, "row", "left")
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            F.col("target").cast("double").alias("target"),
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
            *keep,
        )
    )
