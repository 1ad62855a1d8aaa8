"""One ingest run of a pipeline: feed -> lake tables -> ledger -> state.

The commit order follows the reference's run: data first, then the run
ledger, then the saved state, and the state only when the data committed
(I3). Every step is a Spark job; the driver only handles per-stream
counters and the one-row STATE value.
"""

from __future__ import annotations

import datetime as dt
import random
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions import qcol
from feedlake.operators import bookmarks as B
from feedlake.operators import envelope as E
from feedlake.operators import ledger as L
from feedlake.operators import land as K
from feedlake.operators.land import fan_out, land_observed
from feedlake.operators.publish import replace
from feedlake.sources import delimited, fs
from feedlake.sources.feed import read_feed

LEDGER_DDL = (
    "run_id bigint, pipeline string, source string, stream string, started_at timestamp_ntz, "
    "duration_seconds double, status string, records bigint, error string, mode string, "
    f"records_raw bigint, rejected bigint, columns {L.COLUMNS_DDL}, files_skipped bigint"
)
# fixed value: stream name under which the feed's opaque STATE is kept in the bookmark table
STATE_STREAM = "*"


@dataclass
class RunResult:
    pipeline: str
    success: bool
    streams: dict[str, int] = field(default_factory=dict)  # rows landed (after the transform)
    streams_raw: dict[str, int] = field(default_factory=dict)  # rows decoded (before the transform)
    schemas: dict[str, list[str]] = field(default_factory=dict)
    rejected_lines: int = 0
    error: str | None = None
    last_state: str | None = None
    run_id: int | None = None  # give it to another attempt of a run that failed


def _run_id(now: float) -> int:
    """Grows with the start time; runs of one millisecond differ in the low bits."""
    return int(now * 1000) << 20 | random.getrandbits(20)


def _recorded(spark: SparkSession, ledger_path: str, pipeline: str, run_id: int | None) -> RunResult | None:
    """The result of a run that has succeeded already, from the ledger."""
    if run_id is None or not fs.exists(spark, ledger_path):
        return None
    rows = L.read_ledger(spark, ledger_path).where(
        (F.col("run_id") == run_id) & (F.col("pipeline") == pipeline) & (F.col("status") == "success")
    ).select("stream", "records").collect()
    return RunResult(pipeline, True, {r["stream"]: r["records"] for r in rows if r["stream"] is not None}, run_id=run_id) if rows else None


def run(
    spark: SparkSession,
    feed_path: str,
    lake_root: str,
    source: str,
    pipeline: str,
    *,
    transform=None,
    streams: list[str] | None = None,
    partition_by: list[str] | None = None,
    incremental: bool = False,
    full: bool = False,
    bookmark_keys: dict[str, str] | None = None,
    run_date: str | None = None,
    run_id: int | None = None,
    ledger_path: str | None = None,
    state_path: str | None = None,
    compression: str = "zstd",
    **policy,
) -> RunResult:
    """Land every stream of the feed at ``feed_path`` under ``<lake_root>/<source>/``.

    ``incremental`` lands into ``dt=<run_date>`` partitions (appending) only the records
    above their stream's saved bookmark (I1); else each table is replaced. ``full`` makes an
    incremental run take every record whatever was saved (I2). Bookmarks are the largest landed
    value of the stream's column in ``bookmark_keys``, or else what the feed's STATE says.
    ``streams`` is the allow-list (None = all, D8) and ``partition_by`` adds partition columns
    (D9). One ledger row per stream records the run (one failure row if the run fails);
    the feed's last STATE and the bookmarks are saved only after success (I3).

    ``run_id`` is that of a run to try again: what the failed attempt landed is replaced, and a
    run that succeeded is not repeated.
    """
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    t0 = time.time()
    ledger_path = ledger_path or f"{lake_root}/_ledger"
    state_path = state_path or f"{lake_root}/_state/{pipeline}"
    if done := _recorded(spark, ledger_path, pipeline, run_id):
        return done
    run_id = _run_id(t0) if run_id is None else run_id
    res = RunResult(pipeline=pipeline, success=False, run_id=run_id)
    marks: list[tuple] = []
    try:
        env = E.stream_filter(read_feed(spark, feed_path), streams)
        if incremental and not full:
            saved = B.load(spark, state_path, kinds=True).where(F.col("stream") != STATE_STREAM)
            env = B.newer_records(env, saved)
        landed = fan_out(
            spark, env, lake_root, source, transform=transform, compression=compression,
            run_date=(run_date or started.date().isoformat()) if incremental else None,
            partition_by=partition_by, run=str(run_id), bookmark_keys=bookmark_keys, **policy,
        )
        res.streams = {s: int(r["rows_out"]) for s, r in landed.streams.items()}
        res.streams_raw = {s: int(r["rows_raw"]) for s, r in landed.streams.items()}
        res.schemas = {s: list(r["columns"]) for s, r in landed.streams.items()}
        errors = {s: r["error"] for s, r in landed.streams.items() if r["error"]}
        res.error = "\n".join(f"{s}: {e}" for s, e in errors.items()) or None  # raw rows were landed there
        res.rejected_lines = landed.rejected_lines
        res.last_state = landed.last_state
        own = {s: (s, bookmark_keys[s], r["largest"], r["kind"]) for s, r in landed.streams.items() if r["largest"] is not None}
        said = B.from_state(landed.last_state, landed.schemas)
        marks = [m for m in said if m[0] not in (bookmark_keys or {})] + list(own.values())
        res.success = True
    except Exception as e:  # noqa: BLE001 - a failed run is recorded, not raised
        res.error = f"{type(e).__name__}: {e}" if str(e) else type(e).__name__
    duration = round(time.time() - t0, 3)
    mode = "incremental" if incremental else "full"
    if res.success:
        rows = [(run_id, pipeline, source, s, started, duration, "success", int(r["rows_out"]), errors.get(s), mode,
                 int(r["rows_raw"]), int(r["rejected"]), L.columns_of(r["schema"]), None) for s, r in landed.streams.items()]
        rows = rows or [(run_id, pipeline, source, None, started, duration, "success", 0, None, mode, 0, 0, None, None)]
    else:
        rows = [(run_id, pipeline, source, None, started, duration, "failure", 0, res.error, mode, None, None, None, None)]
    L.append_runs(spark.createDataFrame(rows, LEDGER_DDL), ledger_path)
    if res.success and res.last_state is not None:
        marks.append((STATE_STREAM, "state", res.last_state, None))
    if res.success and marks:
        B.save(spark.createDataFrame(marks, B.KINDED_DDL), state_path)
    return res


def load_state(spark: SparkSession, lake_root: str, pipeline: str, state_path: str | None = None) -> str | None:
    """The STATE saved by the last successful run (JSON text), or None."""
    return B.value_for(B.load(spark, state_path or f"{lake_root}/_state/{pipeline}"), STATE_STREAM)


def run_table(
    spark: SparkSession,
    df,
    lake_root: str,
    source: str,
    stream: str,
    pipeline: str,
    *,
    bookmark_key: str | None = None,
    full: bool = False,
    transform=None,
    incremental: bool = False,
    run_date: str | None = None,
    run_id: int | None = None,
    ledger_path: str | None = None,
    bookmarks_path: str | None = None,
    compression: str = "zstd",
    rejects: DataFrame | None = None,
    audit: DataFrame | None = None,
) -> RunResult:
    """One run for a table source (Parquet tree, CSV, JDBC): the same landing, ledger
    and commit order as :func:`run`, with bookmark-driven extraction (I1-I3): rows
    with ``bookmark_key`` above the saved bookmark are read (the bound is a literal,
    so it reaches the scan or the database), ``full`` ignores it, and the new
    bookmark is saved only after the data and the ledger row are written. Rows without a
    key are above no bookmark: they are set aside under ``_rejects`` (those of now, in the
    place of earlier ones) and the others are landed. ``rejects`` are cells or rows that the
    source could not type (``sheet_rejects``, ``majority_rejects``): landed beside the table
    under ``_rejects/<stream>.cells`` and counted. ``audit`` is the file audit of a Parquet tree
    (``land.read_audited``): files left out are listed under ``_rejects/<stream>.files`` and their
    number is in the ledger row. ``run_id`` as in :func:`run`."""
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    t0 = time.time()
    ledger_path = ledger_path or f"{lake_root}/_ledger"
    bookmarks_path = bookmarks_path or f"{lake_root}/_bookmarks/{pipeline}"
    if done := _recorded(spark, ledger_path, pipeline, run_id):
        return done
    run_id = _run_id(t0) if run_id is None else run_id
    res = RunResult(pipeline=pipeline, success=False, run_id=run_id)
    new_bookmark, landed_schema, raw_rows, skipped = None, None, None, None
    try:
        rows, metrics = df, [F.count(F.lit(1)).alias("n")]
        if bookmark_key:
            if B.has_null_keys(df, bookmark_key):
                nulls = df.where(qcol(bookmark_key).isNull())
                keyless = f"{lake_root}/{source}/_rejects/{K.folder_of(stream)}"
                replace(spark, keyless, lambda aside: nulls.write.parquet(aside))
                res.rejected_lines = spark.read.parquet(keyless).count()  # footers only
                df = df.where(qcol(bookmark_key).isNotNull())
            old = None if full else B.value_for(B.load(spark, bookmarks_path), stream)
            rows = B.newer_than(df, bookmark_key, old)
            # observed in the write itself: what a later read of the source shows may not have landed
            metrics.append(B.largest(df, bookmark_key).alias("largest"))
        path = f"{lake_root}/{source}/{K.folder_of(stream)}"
        if audit is not None:
            broken = f"{lake_root}/{source}/_rejects/{K.folder_of(stream)}.files"
            replace(spark, broken, lambda aside: audit.where("not readable").write.parquet(aside))
            skipped = spark.read.parquet(broken).count()  # footers only
        if rejects is not None:
            cells = f"{lake_root}/{source}/_rejects/{K.folder_of(stream)}.cells"
            replace(spark, cells, lambda aside: rejects.write.parquet(aside))
            res.rejected_lines += spark.read.parquet(cells).count()  # footers only

        def land(out):
            if incremental:
                K.land_incremental(out, path, run_date or started.date().isoformat(), compression, run=str(run_id))
            else:
                K.land_full(out, path, compression)

        raw_obs, out_obs, out, err = land_observed(rows, transform, land, *metrics)
        res.streams = {stream: int(out_obs.get["n"])}
        raw_rows, landed_schema = int(raw_obs.get["n"]), L.columns_of(out.schema)
        res.streams_raw = {stream: raw_rows}
        res.schemas = {stream: list(out.columns)}
        res.error = err  # a transform that failed: raw rows were landed
        res.success = True
        if bookmark_key and raw_obs.get["largest"] is not None:
            new_bookmark = spark.createDataFrame([(stream, bookmark_key, raw_obs.get["largest"])], B.BOOKMARK_DDL)
    except Exception as e:  # noqa: BLE001 - a failed run is recorded, not raised
        res.error = f"{type(e).__name__}: {e}" if str(e) else type(e).__name__
    duration = round(time.time() - t0, 3)
    mode = "incremental" if incremental else "full"
    status = "success" if res.success else "failure"
    row = (run_id, pipeline, source, stream, started, duration, status, res.streams.get(stream, 0), res.error, mode,
           raw_rows, res.rejected_lines, landed_schema, skipped)
    L.append_runs(spark.createDataFrame([row], LEDGER_DDL), ledger_path)
    if res.success and new_bookmark is not None:
        B.save(new_bookmark, bookmarks_path)
    return res


def run_entities(
    spark: SparkSession, entities: dict, lake_root: str, source: str, pipeline: str, *, transform=None, **options
) -> dict[str, RunResult]:
    """One run per CSV entity (name -> path or ``delimited.Entity``); ``transform(df, name, keys)`` gets the entity's keys."""
    out = {}
    for name, df in delimited.read_entities(spark, entities).items():
        keys = getattr(entities[name], "keys", ())
        fn = (lambda rows, name=name, keys=keys: transform(rows, name, keys)) if transform else None
        out[name] = run_table(spark, df, lake_root, source, name, pipeline, transform=fn, **options)
    return out
