"""The Parquet source's record view of a table.

Columns are re-typed coarsely (integral types are integers, floating ones
numbers, booleans booleans, all else text) and temporal values go as ISO
text. That view is an explicit projection; the default path keeps real
types (D12).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.functions import iso_text, qcol


_COARSE = (
    ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), "integer"),
    ((T.FloatType, T.DoubleType), "number"),
    (T.BooleanType, "boolean"),
)


def coarse_type(dt: T.DataType) -> str:
    """JSON type of a column by its Spark type class; an array goes by its elements,
    decimals, temporal and other nested types as text."""
    while isinstance(dt, T.ArrayType):
        dt = dt.elementType
    return next((name for kinds, name in _COARSE if isinstance(dt, kinds)), "string")


def coarse_types(df: DataFrame) -> DataFrame:
    """(column_name, json_type, n_values) per column: the declared coarse type and the
    number of non-null values, from one aggregate pass over the table."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(qcol(f.name)).alias(f"n{i}") for i, f in enumerate(fields)])
    triples = [x for i, f in enumerate(fields) for x in (F.lit(f.name), F.lit(coarse_type(f.dataType)), F.col(f"n{i}"))]
    return counts.select(F.stack(F.lit(len(fields)), *triples).alias("column_name", "json_type", "n_values"))


def iso_projection(df: DataFrame) -> DataFrame:
    """Timestamps as ISO text (fraction only when non-zero), dates as ``YYYY-MM-DD``, decimals as text."""
    cols = []
    for f in df.schema.fields:
        c = qcol(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = iso_text(c)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)
