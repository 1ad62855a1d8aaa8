"""Small file-system helpers over the Hadoop FileSystem of the session.

They touch metadata or a handful of bytes only; data always moves through
Spark readers and writers.
"""

from __future__ import annotations

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def has_root_files(spark: SparkSession, path: str) -> bool:
    """True when ``path`` is a folder holding visible files directly (not only sub-folders)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    return any(st.isFile() and _visible(st.getPath().getName()) for st in fs.listStatus(p))


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, s = _fs(spark, src)
    return bool(fs.rename(s, spark._jvm.org.apache.hadoop.fs.Path(dst)))


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def delete_empty(spark: SparkSession, path: str) -> None:
    """Delete the folder ``path`` if nothing is in it; others may delete it or fill it meanwhile."""
    fs, p = _fs(spark, path)
    try:
        if fs.exists(p) and not len(fs.listStatus(p)):
            fs.delete(p, False)
    except Py4JJavaError as e:
        if not is_instance_of(spark.sparkContext._gateway, e.java_exception, "java.io.IOException"):
            raise


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match, in path order."""
    fs, p = _fs(spark, pattern)
    return sorted(st.getPath().toString() for st in fs.globStatus(p) or [])


def _visible(name: str) -> bool:
    return not name.startswith(".") and (not name.startswith("_") or "=" in name)


def iter_files(spark: SparkSession, root: str, suffix: str = ".parquet"):
    """Data files under ``root`` in path order, listed lazily one directory at a time."""
    fs, p = _fs(spark, root)

    def walk(cur):
        for st in sorted(fs.listStatus(cur), key=lambda s: s.getPath().getName()):
            name = st.getPath().getName()
            if not _visible(name):
                continue
            if st.isDirectory():
                yield from walk(st.getPath())
            elif name.endswith(suffix):
                yield st.getPath().toString()

    yield from walk(p)


def first_file(spark: SparkSession, root: str, suffix: str = ".parquet") -> str | None:
    """First data file under ``root`` in path order; the walk stops at the first match,
    so the cost is the depth of the tree, not the number of files."""
    return next(iter_files(spark, root, suffix), None)


def source_fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Length and modification time of inputs, to key derived fixtures."""
    parts = []
    for path in paths:
        fs, p = _fs(spark, path)
        if fs.exists(p):
            st = fs.getFileStatus(p)
            parts.append(f"{path}:{st.getLen()}:{st.getModificationTime()}")
        else:
            parts.append(f"{path}:missing")
    return "|".join(parts)
