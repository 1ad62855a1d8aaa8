"""Secret scans over an incremental blob ledger.

A blob is a distinct text, addressed by its SHA-256. The ledger holds which
(blob, rule, rule version) pairs were scanned and what they found; a scan
reads only blobs with unseen pairs, appends, and joins the findings back to
every row (path or historical version) that has the blob.

Positions are code points from 0, end exclusive. Matches of one rule are
leftmost and do not overlap; spans of different rules may.

Defined results: null text is the empty text and has no findings; equal
texts share one scan; extra columns are ignored; an empty table gives an
empty result; a text with very many matches is handled as rows, one per
match, never as one growing array of partial sums.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedlake.llm.common import text_or_empty
from feedlake.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds candidates; group ``group`` must have ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def key(self) -> str:
        return f"{self.kind}:{self.version}"


# The base rules. A run of hex digits or of AKIA letters is taken whole, so asking
# for its length inside the pattern finds the same spans as dropping short runs afterwards.
BASE = (
    Rule(
        "assign",
        1,
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", 1, r"[0-9a-f]{16,}"),
)
# what the ledger adds beside the base rules
EXTRA = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    # from the user name on: every part is of any length, and no run is looked at twice
    Rule("url_login", 2, r"(?<=://)[^\s:/@]+:[^\s:/@]{6,}@[A-Za-z0-9.-]+"),
)
RULES = BASE + EXTRA

SCANNED = "blob string, rule string"
FOUND = "blob string, rule string, kind string, start bigint, `end` bigint"


def blob_of(text: Column) -> Column:
    return F.sha2(text, 256)


def _pieces(text: Column, rule: Rule) -> Column:
    """One struct per candidate: its order, the gap before it and the matched text."""
    hit = text.rlike(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.char_length)
    pairs = F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("hit"))
    rows = F.transform(
        pairs,
        lambda z, i: F.struct(
            F.lit(rule.key).alias("rule"),
            F.lit(rule.kind).alias("kind"),
            i.alias("i"),
            z["gap"].cast("long").alias("gap"),
            z["hit"].alias("hit"),
        ),
    )
    return F.when(hit, F.filter(rows, lambda r: r["hit"].isNotNull()))


def find(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings (``FOUND``) of ``blob, text, pending`` rows; ``pending`` lists the rules to run."""
    per_rule = [F.when(F.array_contains("pending", r.key), _pieces(F.col("text"), r)) for r in rules]
    per_rule = [F.coalesce(p, F.array().cast("array<struct<rule:string,kind:string,i:int,gap:bigint,hit:string>>")) for p in per_rule]
    rows = blobs.select("blob", F.explode(F.concat(*per_rule)).alias("m")).select("blob", "m.*")
    rows = rows.withColumn("size", F.char_length("hit").cast("long"))
    upto = W.partitionBy("blob", "rule").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(upto)
    keep = F.lit(True)
    for r in rules:
        if r.least:
            keep = F.when(F.col("rule") == r.key, F.char_length(F.regexp_extract("hit", r.pattern, r.group)) >= r.least).otherwise(keep)
    return (
        rows.withColumn("end", end)
        .filter(keep)
        .select("blob", "rule", "kind", (F.col("end") - F.col("size")).alias("start"), "end")
    )


class BlobLedger:
    """Scanned (blob, rule version) pairs and their findings, as two Parquet tables in shared storage."""

    def __init__(self, spark: SparkSession, path: str | None = None, rules: tuple[Rule, ...] = RULES):
        self.spark, self.rules = spark, rules
        self.path = path or scratch_path(spark, "blob-ledger")
        # an empty append makes both tables readable from the start
        for name, schema in (("scanned", SCANNED), ("found", FOUND)):
            spark.createDataFrame([], schema).write.mode("append").parquet(f"{self.path}/{name}")

    def scanned(self) -> DataFrame:
        return self.spark.read.schema(SCANNED).parquet(f"{self.path}/scanned")

    def found(self) -> DataFrame:
        return self.spark.read.schema(FOUND).parquet(f"{self.path}/found")

    def scan(self, docs: DataFrame) -> int:
        """Scan the unseen pairs of ``docs``; returns how many blobs were read.

        Findings are appended before the pairs that vouch for them, so a
        run that dies in between is repeated, and its findings, equal by
        content, count once (see ``findings``).
        """
        text = text_or_empty()
        keys = F.array(*[F.lit(r.key) for r in self.rules])
        seen = self.scanned().groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        blobs = docs.select(blob_of(text).alias("blob"), text.alias("text")).dropDuplicates(["blob"])
        pending = F.when(F.col("seen").isNull(), keys).otherwise(F.array_except(keys, F.col("seen")))
        todo = blobs.join(seen, "blob", "left").select("blob", "text", pending.alias("pending")).filter(F.size("pending") > 0)
        find(todo, self.rules).write.mode("append").parquet(f"{self.path}/found")
        pairs = (
            docs.select(blob_of(text).alias("blob")).distinct().join(seen, "blob", "left")
            .select("blob", F.explode(pending).alias("rule"))
        )
        before = self.scanned().count()
        pairs.write.mode("append").parquet(f"{self.path}/scanned")
        return self.scanned().count() - before

    def findings(self, docs: DataFrame) -> DataFrame:
        """``doc_id, spans`` of every row: the spans of the current rule versions, sorted."""
        order = F.lit(0)
        for n, r in enumerate(self.rules):
            order = F.when(F.col("kind") == r.kind, n).otherwise(order)
        current = self.found().filter(F.col("rule").isin([r.key for r in self.rules])).distinct()
        # one row per blob: bounded by the matches of a single text
        per = current.groupBy("blob").agg(
            F.sort_array(F.collect_list(F.struct("start", order.alias("order"), "end", "kind"))).alias("spans")
        )
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), blob_of(text_or_empty()).alias("blob"))
        return rows.join(per, "blob", "left").select("doc_id", "blob", "spans")


def secret_scan(docs: DataFrame, ledger: BlobLedger | None = None) -> DataFrame:
    """``doc_id, blob, spans`` after scanning what ``ledger`` (new by default) has not seen."""
    ledger = ledger or BlobLedger(docs.sparkSession)
    ledger.scan(docs)
    return ledger.findings(docs)


def digest_columns(found: DataFrame) -> DataFrame:
    """The report columns: counts per base kind, digest of the base spans, all spans as text."""
    base = [r.kind for r in BASE]
    spans = F.coalesce("spans", F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string>>"))

    def text(kinds=None):
        rows = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(kinds))
        return F.array_join(F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(text(base), 256).alias("base_sha256"),
        text().alias("spans"),
    )
