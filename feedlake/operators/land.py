"""Landing tables in the lake (K1-K6, K8, U1) and reading them back.

Lake layout follows the reference's convention:
``<root>/<source>/<stream>/[dt=YYYY-MM-DD/[_run=<id>/]]part-*.parquet``. A
table is replaced by writing aside and swapping (``publish.replace``), so a
failed run leaves the old rows (D11). Increments of a run are keyed by it: a
second run on the same day appends instead of overwriting (D5), a second
attempt of one run takes the place of the first.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from feedlake.operators import bookmarks
from feedlake.operators.decode import decode, infer_fields, json_schema_fields, struct_type
from feedlake.operators.ingest import CONTROL, REJECTS, route_of, stage_envelope, staged_schemas, staged_streams
from feedlake.operators.publish import RUN_COLUMN, replace, withdraw
from feedlake.session import scratch_path
from feedlake.sources import fs

CODECS = ("zstd", "snappy", "gzip", "none")


@dataclass
class Landed:
    """Outcome of a fan-out run: per stream counts / columns / path, and rejected lines."""

    streams: dict[str, dict]
    rejected_lines: int
    last_state: str | None = None
    schemas: dict[str, dict] = field(default_factory=dict)


# fixed value: the reference's batch size, used as the default file bound
BATCH_ROWS = 10_000


def _writer(df: DataFrame, compression: str, max_records: int | None):
    w = df.write.option("compression", "uncompressed" if compression == "none" else compression)
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    return w


def land_full(df: DataFrame, path: str, compression: str = "zstd", max_records: int | None = None) -> None:
    """K1/K2: full landing; the table is replaced as a whole, so no stale files remain (D6), and stays as it
    was if the write fails."""
    replace(df.sparkSession, path, lambda aside: _writer(df, compression, max_records).parquet(aside))


def land_incremental(
    df: DataFrame, path: str, run_date: str, compression: str = "zstd", partition_col: str = "dt",
    max_records: int | None = None, extra_partitions: list[str] | None = None, run: str | None = None,
) -> None:
    """K3: incremental landing into the ``dt=<run_date>`` partition, appended.

    With ``run`` the rows go below ``_run=<run>`` there, in the place of what an earlier attempt of that
    run left, on whatever date; without, every call appends. A table holds one kind of increment.

    A table last landed by a full run holds its files at the top of the folder;
    partitioned readers would silently skip them next to ``dt=`` folders, so
    appending partitions there is refused rather than hiding rows."""
    spark = df.sparkSession
    if fs.has_root_files(spark, path):
        raise ValueError(
            f"{path} holds a full (unpartitioned) landing; run full again or land increments elsewhere"
        )
    keyed = fs.glob(spark, f"{path}/{partition_col}=*/{RUN_COLUMN}=*")
    if run is None and keyed or run is not None and not keyed and fs.glob(spark, f"{path}/{partition_col}=*"):
        raise ValueError(f"{path} holds increments {'keyed by' if keyed else 'without'} run; land others elsewhere")
    out, parts = df.withColumn(partition_col, F.lit(run_date).cast("date")), [partition_col]
    if run is not None:
        withdraw(spark, path, run)
        out, parts = out.withColumn(RUN_COLUMN, F.lit(run)), [partition_col, RUN_COLUMN]
    _writer(out, compression, max_records).mode("append").partitionBy(*parts, *(extra_partitions or [])).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A landed table with its ``dt`` and user partitions, without the run key."""
    return spark.read.parquet(path).drop(RUN_COLUMN)


def land_partitioned_by(df: DataFrame, path: str, cols: list[str], compression: str = "zstd") -> None:
    """K4: landing partitioned by user columns (``partition_by``); replaces as ``land_full`` does."""
    replace(df.sparkSession, path, lambda aside: _writer(df, compression, None).partitionBy(*cols).parquet(aside))


def export(df: DataFrame, path: str, fmt: str) -> None:
    """K8: export a result as CSV (with header), JSON lines or Parquet; replaces as ``land_full`` does."""
    if fmt not in ("csv", "json", "parquet"):
        raise ValueError(fmt)
    options = {"header": True} if fmt == "csv" else {}
    replace(df.sparkSession, path, lambda aside: df.write.format(fmt).options(**options).save(aside))


def read_tree(spark: SparkSession, root: str, pattern: str = "*.parquet", schema=None,
              ignore_corrupt: bool = False, merge: bool = False) -> DataFrame:
    """Every Parquet file under ``root`` at any depth.

    Partition directories are not turned into columns (as the reference's
    declared-field projection drops them). ``schema`` fixes the columns
    (S3: extra columns of later files are dropped, missing ones are null);
    ``merge`` takes the columns of all files instead; ``ignore_corrupt`` skips unreadable files
    (S4; ``read_audited`` also leaves out and names files that break off half-way).
    """
    r = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    if ignore_corrupt:
        r = r.option("ignoreCorruptFiles", "true")
    if merge:
        r = r.option("mergeSchema", "true")
    elif ignore_corrupt and schema is None:
        schema = first_file_schema(spark, root)
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(root)


AUDIT_DDL = "file string, readable boolean, rows bigint, reason string"


def audit_tree(spark: SparkSession, root: str, suffix: str = ".parquet") -> DataFrame:
    """Every Parquet file under ``root`` with whether all of it can be read, its rows, and else why not.

    The driver only lists; tasks open each footer and decode its row groups one after another, so a file that
    breaks off half-way is found, which a scan with ``ignoreCorruptFiles`` reads in part without a word.
    Files are opened with pyarrow: local, HDFS and the object stores it knows."""
    files = [(f,) for f in fs.iter_files(spark, root, suffix)]

    def check(batches):
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows, why = 0, None
                try:
                    store, name = pafs.FileSystem.from_uri(file)
                    with store.open_input_file(name) as raw:
                        parquet = pq.ParquetFile(raw)
                        for part in parquet.iter_batches(batch_size=1 << 14):
                            rows += part.num_rows
                        if rows != parquet.metadata.num_rows:
                            why = f"{rows} rows of {parquet.metadata.num_rows}"
                except Exception as e:  # noqa: BLE001 - the reason is the result
                    why = f"{type(e).__name__}: {e}"[:300]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([why is None]), pa.array([None if why else rows], pa.int64()), pa.array([why], pa.string())],
                    ["file", "readable", "rows", "reason"],
                )

    listed = spark.createDataFrame(files, "file string")
    tasks = max(1, min(len(files), 4 * spark.sparkContext.defaultParallelism))
    return listed.repartition(tasks).mapInArrow(check, AUDIT_DDL)


def read_audited(spark: SparkSession, root: str, merge: bool = False) -> tuple[DataFrame | None, DataFrame]:
    """The rows of all files that are whole, and the audit of all (written, so that it is made once).

    Columns are the first file's, or with ``merge`` those of all files. No DataFrame where no file is whole."""
    path = scratch_path(spark, "audit")
    audit_tree(spark, root).write.parquet(path)
    audit = spark.read.schema(AUDIT_DDL).parquet(path)
    bad = {r["file"] for r in audit.where("not readable").select("file").collect()}  # the few that are broken
    good = [f for f in fs.iter_files(spark, root) if f not in bad]
    if not good:
        return None, audit
    r = spark.read.option("mergeSchema", "true") if merge else spark.read.schema(spark.read.parquet(good[0]).schema)
    return r.parquet(*good), audit


def tree_file_counts(df: DataFrame) -> dict:
    """S4 accounting for a tree read with ``read_tree``: files listed, files that gave
    rows, and the difference (unreadable files skipped, or valid empty files).
    The per-file row counts are a distributed aggregate; one row per file returns."""
    listed = len(df.inputFiles())
    used = df.select(F.col("_metadata.file_path").alias("f")).distinct().count()
    return {"files_listed": listed, "files_with_rows": used, "files_without_rows": listed - used}


def first_file_schema(spark: SparkSession, root: str):
    """S3: schema of the first readable Parquet file under ``root`` in path order
    (footer reads only; unreadable files are passed over, as S4 skips them)."""
    for path in fs.iter_files(spark, root):
        try:
            return spark.read.parquet(path).schema
        except Exception:  # noqa: BLE001 - a corrupt footer: try the next file
            continue
    return None


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name; a column missing on one side is null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def apply_failsafe(df: DataFrame, fn) -> tuple[DataFrame, str | None]:
    """T3 at plan time: a missing transform, an exception while building the plan
    (e.g. an unknown column) or a ``None`` result keep the raw rows."""
    if fn is None:
        return df, None
    try:
        out = fn(df)
        if out is None:
            return df, "transform returned None"
        out.schema  # force analysis now, not at the write
        return out, None
    except Exception as e:  # noqa: BLE001
        return df, f"{type(e).__name__}: {e}"


def land_observed(rows, fn, land, *metrics: Column) -> tuple[Observation, Observation, DataFrame, str | None]:
    """T3 in a run: land ``fn(rows)``, or the raw rows when ``fn`` fails at plan or at run time.

    ``rows`` is a DataFrame, or a function that makes one for each attempt.

    Returns what was observed in the write that committed (``metrics`` over the
    raw rows, the number ``n`` of landed ones), the landed rows and the error.
    When the raw rows cannot be landed either, that error is raised.
    """
    error = None
    while True:
        raw_obs, out_obs = Observation(), Observation()
        seen = (rows() if callable(rows) else rows).observe(raw_obs, *metrics)
        out, why = apply_failsafe(seen, None if error else fn)
        error = error or why
        out = out.observe(out_obs, F.count(F.lit(1)).alias("n"))
        try:
            land(out)
            return raw_obs, out_obs, out, error
        except Exception as e:  # noqa: BLE001 - the raw rows are tried once
            if fn is None or error:
                raise
            error = f"{type(e).__name__}: {e}"


def folder_of(stream: str) -> str:
    """Folder name of a stream: no separators, and never one that readers skip or that holds rejects."""
    name = stream.replace("%", "%25").replace("/", "%2F")
    return f"%{ord(name[0]):02X}{name[1:]}" if name[0] in "_." else name


def _reject(rows: DataFrame, path: str, n: int, run: str | None) -> None:
    """Land ``n`` rejected rows: of a keyed ``run`` beside those of others, else in the place of earlier ones."""
    spark = rows.sparkSession
    if run is not None:
        withdraw(spark, path, run, 0)
        if n:
            rows.withColumn(RUN_COLUMN, F.lit(run)).write.mode("append").partitionBy(RUN_COLUMN).parquet(path)
    elif n or fs.exists(spark, path):
        replace(spark, path, lambda aside: rows.write.parquet(aside))


def fan_out(
    spark: SparkSession,
    env: DataFrame,
    root: str,
    source: str,
    transform=None,
    compression: str = "zstd",
    run_date: str | None = None,
    partition_by: list[str] | None = None,
    run: str | None = None,
    bookmark_keys: dict[str, str] | None = None,
    concurrent: int = 4,
    **policy,
) -> "Landed":
    """Land every stream of one feed in one run.

    The envelope is staged once, partitioned by stream (see
    ``ingest.stage_envelope``); each stream is decoded from its own folder, up to
    ``concurrent`` streams at a time, and landed under ``<root>/<source>/<stream>`` (replacing it, or appended into
    ``dt=<run_date>`` when ``run_date`` is given; ``partition_by`` adds user
    partition columns, D9; ``run`` keys the increment, so that another attempt of
    the run replaces it). Counts are observed inside the
    write job: records in, rows decoded, rows after the transform, and the largest
    value of a stream's ``bookmark_keys`` column. Rejected
    lines and quarantined records are landed under ``<root>/<source>/_rejects``
    by a second job that only runs when there are any: beside those of other runs when
    ``run_date`` is given, else in their place. A transform that raises, at plan
    or at run time, or returns None leaves the raw rows; the stream's ``error``
    says so (T3). A stream with a SCHEMA
    and no rows is reported with zero rows and no files (K7).
    """
    bad_obs = Observation()
    staged = stage_envelope(env, scratch_path(spark, "staging"), bad_obs)
    schemas = staged_schemas(staged)
    present = staged_streams(staged)
    bad_lines = staged.where(F.col("route") == REJECTS).select("pos", "line", "reject_reason")
    n_bad = bad_obs.get["n"]
    run = (run or uuid.uuid4().hex) if run_date else None
    _reject(bad_lines, f"{root}/{source}/_rejects/_lines", n_bad, run)

    def land_stream(stream: str) -> dict:
        if stream not in present:
            fields = json_schema_fields(schemas[stream]["schema"])
            return {"rows_raw": 0, "rows_out": 0, "rejected": 0, "largest": None, "kind": None,
                    "columns": [f.name for f in fields], "schema": struct_type(fields), "path": None, "error": None}
        part = staged.where(F.col("route") == route_of(stream))
        fields = json_schema_fields(schemas[stream]["schema"]) if stream in schemas else infer_fields(part)
        path = f"{root}/{source}/{folder_of(stream)}"
        plain = decode(part, fields, **policy)
        seen: list[Observation] = []

        def rows() -> DataFrame:
            seen.append(Observation())  # of the attempt that lands the last counts
            return decode(part.observe(seen[-1], F.count(F.lit(1)).alias("n")), fields, **policy).rows

        def land(df):
            if run_date:
                land_incremental(df, path, run_date, compression, extra_partitions=partition_by, run=run)
            elif partition_by:
                land_partitioned_by(df, path, list(partition_by), compression)
            else:
                land_full(df, path, compression)

        fn = (lambda df: transform(df, stream)) if transform else None
        metrics, key = [F.count(F.lit(1)).alias("n")], (bookmark_keys or {}).get(stream)
        if key:
            metrics.append(bookmarks.largest(plain.rows, key).alias("largest"))
        ok_obs, out_obs, out, error = land_observed(rows, fn, land, *metrics)
        rejected = seen[-1].get["n"] - ok_obs.get["n"]
        _reject(plain.rejects, f"{root}/{source}/_rejects/{folder_of(stream)}", rejected, run)
        return {
            "rows_raw": ok_obs.get["n"],
            "rows_out": out_obs.get["n"],
            "rejected": rejected,
            "largest": ok_obs.get["largest"] if key else None,
            "kind": bookmarks.kind_of(plain.rows, key) if key else None,
            "columns": out.columns,
            "schema": out.schema,
            "path": path,
            "error": error,
        }

    streams = sorted(set(schemas) | set(present))
    # streams do not wait for one another; the scheduler shares the executors (evenly under FAIR)
    with ThreadPoolExecutor(max(1, min(concurrent, len(streams)))) as pool:
        def pooled(stream):
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"land-{stream}")
            return land_stream(stream)

        result = dict(zip(streams, pool.map(inheritable_thread_target(spark)(pooled), streams)))
    state = staged.where((F.col("route") == CONTROL) & (F.col("type") == "STATE")).agg(
        F.max_by("value", "pos").alias("v")
    ).first()
    return Landed(result, n_bad, state["v"] if state else None, schemas)
