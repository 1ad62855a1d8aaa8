"""Run ledger and the catalog derived from it.

The reference keeps one JSON log per run and a manifest dict it rewrites
after each run. Here both are views over one append-only ledger table with
one row per (run, stream):

    run_id, pipeline, source, stream, started_at, duration_seconds,
    status ('success' | 'failure'), records, error

Appending never rewrites earlier rows, so concurrent runs do not clobber
each other, and every catalog figure is a grouped aggregate that Spark
reduces map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.functions import qcol, to_day

LEDGER_COLUMNS = [
    "run_id", "pipeline", "source", "stream", "started_at", "duration_seconds", "status", "records", "error",
]
# what a run may say of a stream besides: rows before the transform, rejected ones, landed columns, broken source files
DETAIL_COLUMNS = ["mode", "records_raw", "rejected", "columns", "files_skipped"]
COLUMNS_DDL = "array<struct<name:string,type:string,nullable:boolean>>"


def _latest_key() -> Column:
    # total order for "latest": start time, then run id
    return F.struct("started_at", "run_id")


def append_runs(runs: DataFrame, path: str) -> None:
    """Append run rows to the ledger table (partitioned by start day).
    The columns of ``DETAIL_COLUMNS`` are kept when present; ``mode`` is 'full' or 'incremental'."""
    cols = LEDGER_COLUMNS + [c for c in DETAIL_COLUMNS if c in runs.columns]
    (
        runs.select(*cols)
        .withColumn("run_day", to_day("started_at"))
        .write.mode("append")
        .partitionBy("run_day")
        .parquet(path)
    )


def read_ledger(spark, path: str) -> DataFrame:
    # runs of an older writer have fewer columns
    df = spark.read.option("mergeSchema", "true").parquet(path)
    return df.select(*LEDGER_COLUMNS, *(c for c in DETAIL_COLUMNS if c in df.columns))


def columns_of(schema: T.StructType) -> list[tuple[str, str, bool]]:
    """Name, type and nullability of a landed table's columns, as a ledger row holds them."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in schema.fields]


def manifest_rollup(ledger: DataFrame) -> DataFrame:
    """Per (source, stream) over successful runs: total rows, extractions,
    last extraction time, its row count and, where the ledger has them, its columns.
    Streams with zero rows stay (K7)."""
    ok = ledger.where(F.col("status") == "success")
    columns = [F.max_by("columns", _latest_key()).alias("columns")] if "columns" in ledger.columns else []
    return ok.groupBy("source", "stream").agg(
        F.sum("records").alias("total_rows"),
        F.count(F.lit(1)).alias("extractions"),
        F.max("started_at").alias("last_extraction"),
        F.max_by("records", _latest_key()).alias("last_extraction_rows"),
        *columns,
    )


def manifest_listing(ledger: DataFrame) -> DataFrame:
    """One row per column of every table, as its last successful run landed it."""
    last = manifest_rollup(ledger).select("source", "stream", F.posexplode("columns").alias("position", "c"))
    return last.select("source", "stream", "position", "c.name", "c.type", "c.nullable")


def schema_drift(ledger: DataFrame) -> DataFrame:
    """T4: what changed in a table's columns from one successful run to the next.

    ``run_id, source, stream, name, change, old_type, new_type``; ``change`` is added, removed, type or
    nullable. Runs are compared within a table's own history, a few columns each."""
    ok = ledger.where((F.col("status") == "success") & F.col("columns").isNotNull())
    before = Window.partitionBy("source", "stream").orderBy("started_at", "run_id")
    both = ok.withColumn("old", F.lag("columns").over(before)).where("old is not null and old <> columns")
    as_map = lambda c: F.map_from_entries(F.transform(c, lambda x: F.struct(x["name"], F.struct(x["type"], x["nullable"]))))
    names = F.array_union(F.transform("old", lambda x: x["name"]), F.transform("columns", lambda x: x["name"]))
    rows = both.select("run_id", "source", "stream", F.explode(names).alias("name"), as_map("old").alias("o"), as_map("columns").alias("n"))
    rows = rows.select("run_id", "source", "stream", "name", F.element_at("o", F.col("name")).alias("o"), F.element_at("n", F.col("name")).alias("n"))
    change = (
        F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed")
        .when(F.col("o.type") != F.col("n.type"), "type").when(F.col("o.nullable") != F.col("n.nullable"), "nullable")
    )
    rows = rows.withColumn("change", change).where("change is not null")
    return rows.select("run_id", "source", "stream", "name", "change", F.col("o.type").alias("old_type"), F.col("n.type").alias("new_type"))


def rows_live(ledger: DataFrame) -> DataFrame:
    """Rows currently in each table, as opposed to ``total_rows`` (rows ever landed).

    A full run replaces the table, an incremental run appends, so the live rows
    are the last successful full run plus the incremental runs after it (all
    runs when there was never a full one). Needs the ledger's ``mode`` column.
    The last full run per table is a small aggregate (one row per table) joined
    back on the table key."""
    ok = ledger.where(F.col("status") == "success")
    last_full = ok.where(F.col("mode") == "full").groupBy("source", "stream").agg(
        F.max(_latest_key()).alias("_lf")
    )
    since = ok.join(last_full, ["source", "stream"], "left").where(
        F.col("_lf").isNull() | (_latest_key() >= F.col("_lf"))
    )
    return since.groupBy("source", "stream").agg(F.sum("records").alias("rows_live"))


def manifest_merge(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert new per-stream stats into an existing catalog (insert if absent, else
    accumulate), as a union plus grouped re-aggregation rather than a join."""
    cols = ["source", "stream", "total_rows", "extractions", "last_extraction", "last_extraction_rows"]
    both = existing.select(*cols).unionByName(new.select(*cols))
    return both.groupBy("source", "stream").agg(
        F.sum("total_rows").alias("total_rows"),
        F.sum("extractions").alias("extractions"),
        F.max("last_extraction").alias("last_extraction"),
        F.max_by("last_extraction_rows", "last_extraction").alias("last_extraction_rows"),
    )


def manifest_flat(rollup: DataFrame, prefix: str = "raw") -> DataFrame:
    """One row per table with its lake location and row count."""
    loc = F.concat_ws("/", F.lit(prefix), F.col("source"), F.col("stream"))
    return rollup.select(loc.alias("location"), F.col("total_rows").alias("row_count"))


def column_profile(df: DataFrame) -> DataFrame:
    """Name, type and null count of every column, in one aggregate pass."""
    fields = df.schema.fields
    wide = df.agg(*[F.count_if(qcol(f.name).isNull()).alias(f"n{i}") for i, f in enumerate(fields)])
    triples = [
        x for i, f in enumerate(fields) for x in (F.lit(f.name), F.lit(f.dataType.simpleString()), F.col(f"n{i}"))
    ]
    return wide.select(F.stack(F.lit(len(fields)), *triples).alias("column_name", "data_type", "null_count"))


def runs(ledger: DataFrame) -> DataFrame:
    """One row per run in the ledger's columns: its streams joined as text, the sum of
    their records, the run's duration and its worst status with the first error. Of a
    run that was tried again (same id) the last attempt counts."""
    failed = F.col("status") != "success"
    tries = ledger.groupBy("pipeline", "run_id", "started_at").agg(
        F.max("source").alias("source"),
        F.array_join(F.array_sort(F.collect_set("stream")), ",").alias("stream"),
        F.max("duration_seconds").alias("duration_seconds"),
        F.coalesce(F.min(F.when(failed, F.col("status"))), F.min("status")).alias("status"),
        F.sum("records").alias("records"),
        F.min("error").alias("error"),
    )
    rest = [c for c in LEDGER_COLUMNS if c not in ("pipeline", "run_id")]
    last = tries.groupBy("pipeline", "run_id").agg(F.max_by(F.struct(*rest), "started_at").alias("r"))
    return last.select("pipeline", "run_id", "r.*").select(*LEDGER_COLUMNS)


def totals_by_run(ledger: DataFrame) -> DataFrame:
    """Per run: total records, duration and per-stream counts as ``stream=n`` text in stream order."""
    counts = ledger.groupBy("run_id", "started_at", "stream").agg(F.sum("records").alias("n"))
    part = F.concat_ws("=", "stream", F.col("n").cast("string"))
    counts = counts.groupBy("run_id", "started_at").agg(F.array_join(F.array_sort(F.collect_list(part)), ";").alias("streams"))
    all_runs = runs(ledger).select("run_id", "pipeline", "started_at", "status", F.col("records").alias("total_records"), "duration_seconds")
    return all_runs.join(counts, ["run_id", "started_at"])


def run_totals(ledger: DataFrame) -> DataFrame:
    """Per pipeline and day: total records, duration (each run once) and per-stream
    counts as ``stream=n`` text in stream order."""
    day = to_day("started_at").alias("day")
    per_stream = ledger.groupBy("pipeline", day, "stream").agg(F.sum("records").alias("n"))
    per_stream = per_stream.groupBy("pipeline", "day").agg(
        F.sum("n").alias("total_records"),
        F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "stream", F.col("n").cast("string")))), ";")
        .alias("streams"),
    )
    spent = runs(ledger).groupBy("pipeline", day).agg(F.round(F.sum("duration_seconds"), 3).alias("duration_seconds"))
    return per_stream.join(spent, ["pipeline", "day"]).select(
        "pipeline", "day", "total_records", "duration_seconds", "streams"
    )


def run_summary(ledger: DataFrame) -> DataFrame:
    """Successful and failed runs per day."""
    return runs(ledger).groupBy(to_day("started_at").alias("day")).agg(
        F.count_if(F.col("status") == "success").alias("succeeded"),
        F.count_if(F.col("status") != "success").alias("failed"),
    )


def run_latest(ledger: DataFrame) -> DataFrame:
    """The latest run of each pipeline. Only its rows are summed up: the others are
    dropped before the shuffle (``run_last_n``)."""
    rest = [c for c in LEDGER_COLUMNS if c != "pipeline"]
    return runs(run_last_n(ledger, 1)).select("pipeline", *rest)


def run_last_n(ledger: DataFrame, n: int = 10) -> DataFrame:
    """The stream rows of the last ``n`` runs of each pipeline.

    The streams of a run share its rank. ``dense_rank() <= n`` plans a partial
    ``WindowGroupLimit`` before the shuffle, so a pipeline with a huge history
    sends at most ``n`` runs per map task."""
    w = Window.partitionBy("pipeline").orderBy(F.col("started_at").desc(), F.col("run_id").desc())
    return ledger.withColumn("_rn", F.dense_rank().over(w)).where(F.col("_rn") <= n).drop("_rn")


def run_status(pipelines: DataFrame, ledger: DataFrame) -> DataFrame:
    """Every configured pipeline with its latest run, ``no runs`` when none."""
    latest = run_latest(ledger)
    j = pipelines.select("name").join(latest, F.col("name") == F.col("pipeline"), "left")
    return j.select(
        "name",
        F.col("started_at").alias("last_run"),
        F.coalesce(F.col("status"), F.lit("no runs")).alias("status"),
        F.col("duration_seconds").alias("duration"),
        F.col("records"),
    )


def run_stale(ledger: DataFrame, as_of: Column) -> DataFrame:
    """Pipelines whose latest run started before the day ``as_of``."""
    latest = run_latest(ledger)
    return latest.where(to_day("started_at") < as_of).select("pipeline", F.col("started_at").alias("last_run"))


def run_failed_latest(ledger: DataFrame) -> DataFrame:
    """Pipelines whose latest run failed, with the error."""
    latest = run_latest(ledger)
    return latest.where(F.col("status") == "failure").select("pipeline", "started_at", "error")
