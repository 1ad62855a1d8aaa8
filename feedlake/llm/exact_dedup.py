"""Exact deduplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by the digest of the
normalised text (every ASCII blank deleted). A batch is hashed once and
deduplicated in itself, sort-merge anti-joined with the index and its new
digests are appended. The index side of that join needs no shuffle: the table
is bucketed by the join key. Digests carry the id of their batch, so that a
batch given again (after a driver was lost, say) gets the verdicts it got.

Defined results: null text counts as empty (all empty texts are one group);
ties on length go to the smallest ``doc_id`` (null last), and of rows that
share that too the first read stays, one row of each group; an empty batch
adds nothing; columns of the input other than ``doc_id`` and ``text`` pass by
untouched, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.common import code_points, text_or_empty, without_blanks, written
from feedlake.session import scratch_path
from feedlake.sources import fs

SCHEMA = "text_sha256 string, keep_id bigint, keep_chars bigint, group_size bigint, batch string"


def digests(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id, text_sha256, chars, own`` of every row, ``own`` holding its columns ``keep``; no text leaves its scan task."""
    text = text_or_empty()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(without_blanks(text), 256).alias("text_sha256"),
        code_points(text).alias("chars"),
        (F.struct(*keep) if keep else F.lit(None).cast("boolean")).alias("own"),
    )


class DigestIndex:
    """Digests seen so far, one row each, bucketed and sorted by digest.

    ``path`` names shared storage; an existing folder is opened again, so
    the index outlives the session. ``buckets`` must stay the same for one
    path, which is checked; take about one per 128 MB of index.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 64):
        self.spark = spark
        self.path = path or scratch_path(spark, "digest-index")
        self.name = f"digest_index_{uuid.uuid4().hex[:12]}"
        made_with = {int(f.rpartition("-")[2]) for f in fs.glob(spark, f"{self.path}/.buckets-*")}
        if made_with - {int(buckets)}:
            raise ValueError(f"{self.path} has {max(made_with)} buckets, not {buckets}")
        fs.write_bytes(spark, f"{self.path}/.buckets-{int(buckets)}", b"")
        spark.sql(
            f"CREATE TABLE {self.name} ({SCHEMA}) USING parquet "
            f"CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {int(buckets)} BUCKETS "
            f"LOCATION '{self.path}'"
        )
        self.buckets = int(buckets)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, docs: DataFrame, *keep: str, batch: str | None = None) -> DataFrame:
        """Take in a batch; returns its verdicts, dropped rows too.

        Columns: ``doc_id, keep_id, group_size, kept, text_sha256, seen_before``
        and the batch's columns ``keep``.
        Within the batch the longest original text (code points), then the
        smallest ``doc_id`` stays. A digest that an earlier batch added keeps the
        row it kept then: ``keep_id`` names that row, ``seen_before`` is true
        and nothing of this batch is kept for it. ``group_size`` counts the
        batch's rows of the digest. ``batch`` names the batch, if it may be
        given again; what it added itself was not seen before.
        """
        batch = batch or uuid.uuid4().hex
        rows = written(digests(docs, *keep).withColumn("row", F.monotonically_increasing_id()), "digests")
        # partial aggregation leaves one row per digest and task, however many copies there are
        rank = F.struct(F.col("chars"), (-F.col("doc_id")).alias("neg"), (-F.col("row")).alias("row"))
        groups = rows.groupBy("text_sha256").agg(F.max(rank).alias("best"), F.count(F.lit(1)).alias("group_size"))
        groups = groups.select(
            "text_sha256",
            (-F.col("best.neg")).alias("keep_id"),
            F.col("best.chars").alias("keep_chars"),
            (-F.col("best.row")).alias("keep_row"),
            "group_size",
        )
        before = self.rows().select("text_sha256", F.col("keep_id").alias("old_id"), F.col("batch").alias("old_batch"))
        joined = groups.join(before.hint("merge"), "text_sha256", "left")
        seen = F.col("old_batch").isNotNull() & (F.col("old_batch") != batch)
        # the verdict per digest is fixed before the append changes the index
        verdicts = written(
            joined.select(
                "text_sha256",
                F.when(seen, F.col("old_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                "keep_chars",
                F.when(~seen, F.col("keep_row")).alias("keep_row"),
                "group_size",
                seen.alias("seen_before"),
            ),
            "digest-verdicts",
        )
        new = verdicts.filter("not seen_before").join(self.rows().hint("merge"), "text_sha256", "left_anti")
        self._append(new.withColumn("batch", F.lit(batch)))
        return rows.join(verdicts, "text_sha256").select(
            "doc_id",
            "keep_id",
            "group_size",
            F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"),
            "text_sha256",
            "seen_before",
            *(F.col("own").getField(c).alias(c) for c in keep),
        )

    def _append(self, new: DataFrame) -> None:
        # one task per bucket, so that each batch adds one sorted file per bucket
        (
            new.select("text_sha256", "keep_id", "keep_chars", "group_size", "batch")
            .repartition(self.buckets, "text_sha256")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "text_sha256")
            .sortBy("text_sha256")
            .saveAsTable(self.name)
        )
        self.spark.catalog.refreshTable(self.name)


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Verdicts of ``docs`` against ``index`` (a new, empty one by default)."""
    return (index or DigestIndex(docs.sparkSession)).add(docs, *keep)
