"""Round trip: every driver table -> synthesised feed -> decode == the table
(integers widen to bigint, floats to double, as JSON Schema declares them)."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.operators.decode import spark_to_json_schema
from feedlake.operators.ingest import decode_stream
from feedlake.plans.feeds import record_lines, schema_line, table, write_segments
from feedlake.sources.feed import read_feed

from .conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _widen(df):
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.FloatType):
            c = c.cast("array<float>")
        cols.append(c.alias(f.name))
    return df.select(*cols)


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")
@pytest.mark.parametrize("name", TABLES)
def test_table_feed_round_trip(spark, scratch, name):
    df = table(spark, SF_SMALL, name)
    head = spark.createDataFrame([(schema_line(name, spark_to_json_schema(df.schema)),)], "value string")
    path = write_segments([head, record_lines(df, name)], scratch(f"rt_{name}"))
    back = decode_stream(read_feed(spark, path), name).rows
    for f in df.schema.fields:  # float arrays come back as double: compare at float precision
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.FloatType):
            back = back.withColumn(f.name, F.col(f.name).cast("array<float>"))
    want = _widen(df)
    assert back.count() == want.count()
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0
