"""Pick up only the feed files that arrived since the last run.

A Structured Streaming file source over the inbox folder with
``trigger(availableNow=True)``: each run processes every file not yet
recorded in the checkpoint, then stops. The checkpoint (in the shared
scratch folder) is what makes a re-run skip files already landed, and it
also makes the run restartable after a lost executor or driver.

The sink is partitioned by run (``_run``), so what a run picked up is
counted from what it wrote, however many batches that took. ``pos`` keeps
the place of a line: run, file, block, line in the block; the newest SCHEMA
or STATE of the sink is the one with the largest ``pos``.
"""

from __future__ import annotations

import time

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.operators.publish import RUN_COLUMN
from feedlake.sources import fs
from feedlake.sources.feed import messages

OUT_COLUMNS = ["pos", "type", "stream", "record", "schema", "key_properties", "value", "reject_reason", "line"]


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines with a number that grows within a task: streams have no ``monotonically_increasing_id``."""

    def run(batches):
        n = 0
        for batch in batches:
            yield batch.append_column("n", pa.array(range(n, n + batch.num_rows), pa.int64()))
            n += batch.num_rows

    return lines.mapInArrow(run, "line string, file string, block bigint, n bigint")


def pickup_available(spark: SparkSession, inbox: str, sink: str, checkpoint: str, max_files: int | None = None) -> dict:
    """Parse the new lines of the inbox into the envelope and append them to ``sink``.

    Returns the run's id and how many messages (lines that are not blank) it landed, in how many
    batches of ``max_files`` files at most."""
    run, done = f"{time.time_ns():020d}", _last_batch(spark, checkpoint)
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(inbox).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )
    pos = F.struct(F.lit(run).alias("run"), "file", "block", "n")
    env = messages(_numbered(lines).select("line", pos.alias("pos"))).select(*OUT_COLUMNS, F.lit(run).alias(RUN_COLUMN))
    q = (
        env.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .partitionBy(RUN_COLUMN)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    landed = 0
    if fs.exists(spark, f"{sink}/{RUN_COLUMN}={run}"):
        landed = spark.read.parquet(sink).where(F.col(RUN_COLUMN).cast("decimal(20,0)") == int(run)).count()  # its folder only
    return {"run": run, "rows": landed, "batches": _last_batch(spark, checkpoint) - done}


def _last_batch(spark: SparkSession, checkpoint: str) -> int:
    """Number of the last committed batch, from -1; the checkpoint keeps only the newest ones."""
    return max((int(x.rpartition("/")[2]) for x in fs.glob(spark, f"{checkpoint}/commits/[0-9]*")), default=-1)
