"""WARC archives with duplicate payloads resolved into revisit records.

Payloads are digested once, where they are read, and staged with a key of
their row; only headers (key, id, digest, length) are shuffled by digest to
find each payload's first record, and the decision is joined back by key, so
that however many share a digest, payloads are dealt evenly. Each task then
streams its records into gzip-per-record archives with fresh headers; a
revisit carries no payload but names the record it refers to. Archives are
written under a name of the task attempt, and only those of the attempts
that succeeded are in the manifest, so a lost executor leaves no half
archive behind that is read. Rows go through Python one by one.

Reading streams each archive record by record. A revisit's payload facts
come from its own headers; ``with_payloads`` joins revisit records to the
response that holds their payload.

Defined results: null html is the empty payload; repeated rows and equal
ids are records each, with record ids of their own, and of rows that share
payload and smallest id the first read is the response; a null id is never a
revisit nor revisited; null url becomes an empty target; line breaks in urls
are percent-encoded; extra columns are ignored; an empty table writes no
archive. Payloads of any length are written whole.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.common import written
from feedlake.session import scratch_path

RECORDS = "record_id string, page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, refers_to_record string, archive string"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"  # a parameter of write(): the tables carry no crawl time


def digest_of(payload) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _staged(pages: DataFrame) -> DataFrame:
    """``row, page_id, url, html, digest, size`` of every row, written."""

    def run(batches):
        for batch in batches:
            html = batch.column(2).fill_null("")
            # views of the batch's own bytes, no copies
            digests = [digest_of(x.as_buffer()) for x in html]
            size = pc.binary_length(html).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), html, pa.array(digests, pa.string()), size], ["page_id", "url", "html", "digest", "size"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    staged = rows.mapInArrow(run, "page_id bigint, url string, html string, digest string, size bigint")
    return written(staged.withColumn("row", F.monotonically_increasing_id()), "pages-staged", "zstd")


def resolve(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages with ``row, digest, size, record_type, refers_to, refers_to_row``.

    Of records with equal payloads of at least ``min_bytes`` bytes the one
    with the smallest id is the response. Digest and size are compared.
    """
    staged = _staged(pages)
    heads = staged.select("row", "page_id", "digest", "size").filter(F.col("page_id").isNotNull() & (F.col("size") >= min_bytes))
    first = heads.groupBy("digest", "size").agg(F.min(F.struct("page_id", "row")).alias("first"))
    revisits = heads.select("row", "digest", "size").join(first, ["digest", "size"]).filter("row <> first.row")
    revisits = revisits.select("row", F.col("first.page_id").alias("refers_to"), F.col("first.row").alias("refers_to_row"))
    kind = F.when(F.col("refers_to_row").isNotNull(), "revisit").otherwise("response")
    return staged.join(revisits, "row", "left").withColumn("record_type", kind)


def record_id(run: str, row: int) -> str:
    """A record's own id: the same for whoever refers to it, and in no other run."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{run}/{row}')}"


def _record(run, date, row, page_id, url, html, digest, size, kind, refers_to, refers_to_row) -> bytes:
    payload = html.as_buffer() if kind == "response" else b""
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id(run, row)}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(payload)}",
    ]
    if kind == "revisit":
        head[5:5] = [f"WARC-Refers-To: <{record_id(run, refers_to_row)}>", f"WARC-Profile: {REVISIT_PROFILE}", f"X-Refers-To-Page: {refers_to}"]
    if page_id is not None:
        head.append(f"X-Page: {page_id}")
    return b"".join(["\r\n".join(head).encode(), b"\r\n\r\n", payload, b"\r\n\r\n"])


def write(resolved: DataFrame, path: str, date: str = DATE) -> DataFrame:
    """Write archives under ``path``; returns the manifest ``archive, records, bytes`` (written too)."""
    spark = resolved.sparkSession
    run_id = uuid.uuid4().hex

    def run(batches):
        out = None
        name, records = "", 0
        for batch in batches:
            html = batch.column(columns.index("html"))
            rest = batch.drop_columns(["html"])
            for i in range(batch.num_rows):
                row = rest.slice(i, 1).to_pylist()[0]
                if out is None:
                    store, root = pafs.FileSystem.from_uri(path)
                    store.create_dir(root, recursive=True)
                    task = TaskContext.get()
                    name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz"
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                record = _record(run_id, date, **row, html=html[i])
                out.write(gzip.compress(record, compresslevel=6, mtime=0))  # a member per record
                records += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{path}/{name}"]), pa.array([records], pa.int64()), pa.array([size], pa.int64())], ["archive", "records", "bytes"])

    columns = ["row", "page_id", "url", "html", "digest", "size", "kind", "refers_to", "refers_to_row"]
    done = resolved.withColumnRenamed("record_type", "kind").select(*columns).mapInArrow(run, "archive string, records bigint, bytes bigint")
    done.write.parquet(f"{path}-manifest")
    return spark.read.schema(done.schema).parquet(f"{path}-manifest")


def _stream(archive: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and payload of each record, one at a time."""
    store, name = pafs.FileSystem.from_uri(archive)
    with store.open_input_stream(name, compression=None) as raw, io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) as f:
        while True:
            line = f.readline()
            if not line:
                return
            if line in (b"\r\n", b"\n"):
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"{archive}: no record starts at {line[:40]!r}")
            head: dict[str, str] = {}
            while (line := f.readline()) not in (b"\r\n", b"\n", b""):
                key, _, value = line.decode().rstrip("\r\n").partition(":")
                head[key.strip().lower()] = value.strip()
            size = int(head["content-length"])
            payload = f.read(size)
            if len(payload) != size or f.read(4) != b"\r\n\r\n":
                raise ValueError(f"{archive}: record {head.get('warc-record-id')} is cut short")
            yield head, payload


def _number(value: str | None) -> int | None:
    return int(value) if value else None


def read(spark: SparkSession, manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """Records (``RECORDS``, and ``html`` if asked for) of the archives in ``manifest``.

    A response's size and digest are taken from the payload read, and must
    agree with its headers.
    """

    def run(batches):
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                rows, held = [], 0
                for head, payload in _stream(archive):
                    kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
                    size = int(head["x-payload-length"])
                    if kind == "response" and (digest_of(payload), len(payload)) != (digest, size):
                        raise ValueError(f"{archive}: payload of {head['warc-record-id']} does not match its digest")
                    own, other = head["warc-record-id"].strip("<>"), head.get("warc-refers-to", "").strip("<>") or None
                    row = (own, _number(head.get("x-page")), head["warc-target-uri"], kind, size, digest, _number(head.get("x-refers-to-page")), other, archive)
                    rows.append(row + ((payload.decode() if kind == "response" else None),) * payloads)
                    held += len(payload) * payloads + 200
                    if held > 1 << 20:
                        yield _batch(rows, payloads)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, payloads)

    names = manifest.select("archive").repartition(max(1, spark.sparkContext.defaultParallelism), "archive")
    return names.mapInArrow(run, RECORDS + (", html string" if payloads else ""))


def _batch(rows: list[tuple], payloads: bool) -> pa.RecordBatch:
    fields = (RECORDS + (", html string" if payloads else "")).split(", ")
    names, kinds = zip(*(f.split() for f in fields), strict=True)
    kinds = [pa.int64() if k == "bigint" else pa.string() for k in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], list(names))


def with_payloads(records: DataFrame) -> DataFrame:
    """Revisit records joined to the response they refer to: every record with its ``html``."""
    found = records.filter("record_type = 'response'").select(F.col("record_id").alias("r_id"), F.col("html").alias("r_html"))
    out = records.join(found, F.col("refers_to_record") == F.col("r_id"), "left")
    html = F.when(F.col("record_type") == "response", F.col("html")).otherwise(F.col("r_html"))
    return out.withColumn("html", html).drop("r_id", "r_html")


def archive_pages(pages: DataFrame, path: str | None = None, min_bytes: int = 0, date: str = DATE) -> DataFrame:
    """Write all pages to archives and read them back: ``RECORDS`` per page."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    return read(spark, write(resolve(pages, min_bytes), path, date))
