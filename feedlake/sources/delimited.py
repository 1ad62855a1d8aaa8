"""Delimited-text sources and their type inference.

S5 header cleaning, S6/S7 spreadsheet inference and casting, S8/S9 majority
inference, S10 entities with key columns, S11 files under a prefix matched by
regex.

Every file is read by its own header: one job looks for the first line of
each file, files with the same header share a reader, and the readers are
united by column name. That job splits all text into lines once; it is
skipped when the columns are given.

Both inferences read every row: one aggregate with a few buffers per column,
no unpivot, no window. Only one row per column reaches the driver.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.functions import BOOL_TOKENS, TRUE_TOKENS, decimal_comma, qcol, strip


def clean_header(names: list[str]) -> list[str]:
    """Header names without BOM and blanks; an empty one is ``_c<place>``, a repeated one gets its place."""
    names = [n.replace("\ufeff", "").strip() for n in names]
    return [f"_c{i}" if not n else n if names.count(n) == 1 else f"{n}{i}" for i, n in enumerate(names)]


def file_headers(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """``file, header``: the first line with any text of each CSV file under ``path`` (whose path matches ``pattern``).

    Only rows of a file's first split compete, and a split sends one row. Files that do not match are
    pruned by the file index before any is opened; empty files have no header.
    Beside ``collect_set`` (no ``n`` is below 0) text may stand in a hash aggregate: alone it would be a sort
    aggregate, which sorts and spills all lines of the first splits."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    if pattern is not None:
        lines = lines.where(F.col("_metadata.file_path").rlike(pattern))
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"), "value")
    text = F.translate("value", "\ufeff", "")
    lines = lines.where((F.col("block") == 0) & text.rlike(r"\S")).groupBy("file")
    found = lines.agg(F.min_by("value", "n").alias("header"), F.collect_set(F.when(F.col("n") < 0, 0)).alias("none"))
    return found.where(F.size("none") == 0).select("file", "header")  # without the filter the set would be pruned


def read_csv(
    spark: SparkSession, path: str | list[str], with_pos: bool = True, *, pattern: str | None = None,
    multi_line: bool = False, columns: list[str] | None = None,
) -> DataFrame:
    """Header CSV as all-text columns; BOM and blanks removed from header names.

    Files may have their columns in any order, or not all of them: each is read by its own header, a
    column it lacks is null there. ``columns`` says that all files have these columns in this order.
    A doubled quote inside a quoted field is one quote; with ``multi_line`` a quoted field may hold line
    breaks (such files are not split). ``pattern`` keeps files whose path matches it (S11). With
    ``with_pos`` a ``pos`` column gives the line order (file, block, row id).
    """
    if columns is not None:
        by_header = {tuple(columns): None}
    else:
        by_header = {}
        for r in file_headers(spark, path, pattern).collect():  # a row per file, as in the file index
            names = tuple(clean_header(next(csv.reader([r["header"]], doublequote=True))))
            by_header.setdefault(names, []).append(r["file"])
    if not by_header:
        return spark.createDataFrame([], T.StructType([T.StructField("pos", T.StructType([T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("n", T.LongType())]))] if with_pos else []))
    out = None
    for nth, (names, files) in enumerate(sorted(by_header.items())):
        r = spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
        r = r.options(header=True, recursiveFileLookup="true", quote='"', escape='"', multiLine=multi_line)
        # one header, the usual case: the folder itself, so that no list of files is handed over
        df = r.csv(path if len(by_header) == 1 else sorted(files))
        if pattern is not None:
            df = df.where(F.col("_metadata.file_path").rlike(pattern))
        cols = [qcol(n) for n in names]
        if with_pos:
            cols.append(F.struct(
                F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("n"),
            ).alias("pos"))
        df = df.select(*cols)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if with_pos and len(by_header) > 1:
        out = out.select(*[qcol(c) for c in out.columns if c != "pos"], "pos")
    return out


def _misfits(df: DataFrame, bad: dict[str, Column], order: str) -> DataFrame:
    """(seq, column_name, val) of the cells for which ``bad`` holds; rows without any send nothing on."""
    cells = [F.when(b, F.struct(F.lit(c).alias("column_name"), qcol(c).cast("string").alias("val"))) for c, b in bad.items()]
    if not cells:
        return df.select(qcol(order).alias("seq"), F.lit("").alias("column_name"), F.lit("").alias("val")).limit(0)
    found = df.select(qcol(order).alias("seq"), F.explode(F.array_compact(F.array(*cells))).alias("c"))
    return found.select("seq", "c.column_name", "c.val")


# A failed try_cast costs an exception inside Spark, and most cells of a text
# column fail a numeric cast: a regex on the text decides first, the cast confirms.
_INT_RE = r"^\s*[+-]?\d+\s*$"
_NUM_RE = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def _is_int(v: Column) -> Column:
    return v.rlike(_INT_RE) & v.try_cast("bigint").isNotNull()


def _is_num(v: Column) -> Column:
    return v.rlike(_NUM_RE) & v.try_cast("double").isNotNull()


def _per_column(df: DataFrame, columns: list[str], aggs, choose, values: list[Column] | None = None) -> DataFrame:
    """(column_name, json_type) rows in column order, from one aggregate over all rows.

    ``aggs(v)`` names the aggregates of a column's text (or what ``values`` gives for it);
    ``choose(a)`` makes its type from their results."""
    made = [aggs(v) for v in values or [qcol(c).cast("string") for c in columns]]
    wide = df.agg(*[x.alias(f"{k}{i}") for i, m in enumerate(made) for k, x in m.items()])
    pairs = []
    for i, (c, m) in enumerate(zip(columns, made)):
        pairs += [F.lit(c), choose({k: F.col(f"{k}{i}") for k in m})]
    return wide.select(F.stack(F.lit(len(columns)), *pairs).alias("column_name", "json_type"))


def sheet_types(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column, over all its non-empty values: all integers -> integer; else all
    numbers after ``,``->``.`` -> number; else all boolean tokens -> boolean; else (or
    no values) string. Returns (column_name, json_type)."""

    def aggs(v):
        filled = strip(F.coalesce(v, F.lit(""))) != ""
        return {
            "i": F.bool_and(F.when(filled, _is_int(v))),
            "n": F.bool_and(F.when(filled, _is_num(F.replace(v, F.lit(","), F.lit("."))))),
            "b": F.bool_and(F.when(filled, F.lower(v).isin(*BOOL_TOKENS))),
        }

    def choose(a):
        return F.when(a["i"], "integer").when(a["n"], "number").when(a["b"], "boolean").otherwise("string")

    return _per_column(df, columns, aggs, choose)


def sheet_cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Values by inferred type; empty -> null; booleans are the true tokens.

    A value that does not fit its column's type is null here (the reference
    keeps the text and fails later at write); :func:`sheet_rejects` lists them."""
    cols = []
    for c, t in types.items():
        v = F.nullif(strip(qcol(c)), F.lit(""))
        if t == "integer":
            v = v.try_cast("bigint")
        elif t == "number":
            v = decimal_comma(v)
        elif t == "boolean":
            v = F.when(v.isNotNull(), F.lower(v).isin(*TRUE_TOKENS))
        cols.append(v.alias(c))
    return df.select(*cols)


def sheet_rejects(df: DataFrame, types: dict[str, str], order: str = "pos") -> DataFrame:
    """The non-empty cells that do not fit their column's inferred type,
    as (seq, column_name, val) rows, so they can be quarantined instead of
    failing the run later."""
    bad = {}
    for c, t in types.items():
        v = strip(qcol(c).cast("string"))
        ok = {"integer": _is_int(v), "number": decimal_comma(v).isNotNull(), "boolean": F.lower(v).isin(*BOOL_TOKENS)}.get(t)
        if ok is not None:
            bad[c] = (v != "") & ~ok
    return _misfits(df, bad, order)


def _cell_kind(v: Column) -> Column:
    return (
        F.when(_is_int(v), "integer")
        .when(_is_num(v), "number")
        .when(F.lower(v).isin("true", "false"), "boolean")
        .otherwise("string")
    )


def majority_types(df: DataFrame, columns: list[str], order: str = "pos") -> DataFrame:
    """Over all rows, each non-empty cell is integer / number / boolean / string; a
    column with any string is string, else its most frequent kind (ties: the kind seen
    first), none -> string. Returns (column_name, json_type)."""
    kinds = ("integer", "number", "boolean")
    # the kind of a cell is asked for seven times: worked out once, behind a barrier that the optimizer does not inline
    found = [F.when(F.coalesce(qcol(c).cast("string"), F.lit("")) != "", _cell_kind(qcol(c).cast("string"))).alias(f"k{i}") for i, c in enumerate(columns)]
    staged = df.select(qcol(order).alias("_at"), F.inline(F.array(F.struct(*found))))

    def aggs(kind):
        out = {"s": F.count_if(kind == "string")}
        for k in kinds:
            out[f"n_{k}"] = F.count_if(kind == k)
            out[f"at_{k}"] = F.min(F.when(kind == k, F.col("_at")))
        return out

    def choose(a):
        ranked = F.array(*[F.struct((-a[f"n_{k}"]).alias("n"), a[f"at_{k}"].alias("at"), F.lit(k).alias("kind")) for k in kinds])
        best = F.array_min(F.filter(ranked, lambda r: r["n"] < 0))
        return F.when((a["s"] > 0) | best.isNull(), "string").otherwise(best["kind"])

    return _per_column(staged, columns, aggs, choose, [F.col(f"k{i}") for i in range(len(columns))])


def majority_rejects(df: DataFrame, types: dict[str, str], order: str = "pos") -> DataFrame:
    """The non-empty cells that :func:`majority_cast` makes null, as (seq, column_name, val)."""
    bad = {}
    for c, t in types.items():
        v = qcol(c).cast("string")
        if t in ("integer", "number"):
            bad[c] = (v != "") & v.try_cast("bigint" if t == "integer" else "double").isNull()
    return _misfits(df, bad, order)


def majority_cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Values by majority type; a failed cast is null; boolean = text is ``true``."""
    cols = []
    for c, t in types.items():
        v = F.nullif(qcol(c), F.lit(""))
        if t == "integer":
            v = v.try_cast("bigint")
        elif t == "number":
            v = v.try_cast("double")
        elif t == "boolean":
            v = F.when(v.isNotNull(), F.lower(v) == "true")
        cols.append(v.alias(c))
    return df.select(*cols)


@dataclass(frozen=True)
class Entity:
    """A CSV table of its own and the columns that tell its rows apart."""

    path: str | list[str]
    keys: tuple[str, ...] = ()


def read_entities(spark: SparkSession, entities: dict[str, str | Entity]) -> dict[str, DataFrame]:
    """One header CSV reader per entity (name -> path or :class:`Entity`); its keys must be columns of it.

    ``pipeline.run_entities`` lands them and hands the keys to the transform (T1)."""
    out = {}
    for name, e in entities.items():
        e = e if isinstance(e, Entity) else Entity(e)
        out[name] = read_csv(spark, e.path, with_pos=False)
        missing = [k for k in e.keys if k not in out[name].columns]
        if missing:
            raise ValueError(f"{name} has no key column {', '.join(missing)}")
    return out


def read_matching(spark: SparkSession, prefix: str, pattern: str, **options) -> DataFrame:
    """CSV files under ``prefix`` whose path matches the regex ``pattern``.

    The test is on ``_metadata.file_path``, a constant per file: Spark hands it to
    the file index, so files that do not match are pruned before any header is
    looked for and any task is planned (the scan's ``numFiles`` metric counts only
    matching files)."""
    return read_csv(spark, prefix, with_pos=False, pattern=pattern, **options)
