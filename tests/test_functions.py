"""Scalar helpers against the Python behaviour they stand for (property-based where it helps)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake import functions as X

WS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2005\u200a\u2028\u2029\u202f\u205f\u3000"


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet=WS + "ab é", max_size=12), min_size=200, max_size=200))
def test_strip_matches_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(X.strip("t")).collect()]
    assert got == [t.strip() for t in texts]


def test_clean_text_lower_and_strip(spark):
    df = spark.createDataFrame([("\u3000 ÉTÉ Mixed\t",), (None,)], "t string")
    assert [r[0] for r in df.select(X.clean_text("t")).collect()] == ["été mixed", None]


def test_iso_text_matches_isoformat(spark):
    values = [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 120000),
              dt.datetime(1999, 12, 31, 23, 59, 59, 1)]
    df = spark.createDataFrame([(v.isoformat(sep=" "),) for v in values], "t string")
    got = [r[0] for r in df.select(X.iso_text(F.col("t").cast("timestamp_ntz"))).collect()]
    assert got == [v.isoformat() for v in values]


def test_decimal_comma_and_numeric_fill(spark):
    df = spark.createDataFrame([("1,5",), ("-0,25",), ("1,234.5",), ("x",), (None,)], "t string")
    got = df.select(X.decimal_comma("t").alias("d"), X.numeric_fill(F.replace("t", F.lit(","), F.lit("."))).alias("n")).collect()
    assert [r["d"] for r in got] == [1.5, -0.25, None, None, None]
    assert [r["n"] for r in got] == [1.5, -0.25, 0.0, 0.0, 0.0]


def test_bool_tokens(spark):
    toks = ["true", "False", "SIM", "nao", "yes", "no", "1", "0", "maybe", None]
    df = spark.createDataFrame([(t,) for t in toks], "t string")
    got = [r[0] for r in df.select(X.bool_token("t")).collect()]
    assert got == [True, False, True, False, True, False, True, False, None, None]


def test_url_parts(spark):
    df = spark.createDataFrame([("https://m.site.example.net/en/25?page=3#top",), ("http://a.example.com/fr/7.html",)],
                               "u string")
    got = df.select(*[X.url_part("u", p) for p in (X.URL_SCHEME, X.URL_HOST, X.URL_LANG, X.URL_ID, X.URL_PAGE)]).collect()
    assert tuple(got[0]) == ("https", "m.site.example.net", "en", "25", "3")
    assert tuple(got[1]) == ("http", "a.example.com", "fr", "7", None)


def test_month_day_nan(spark):
    df = spark.createDataFrame([("2024-03-09 10:00:00", float("nan")), ("1999-12-31 23:59:59", 2.5)], "t string, v double")
    got = df.select(X.month_text(F.col("t").cast("timestamp_ntz")), X.to_day(F.col("t").cast("timestamp_ntz")),
                    X.nan_to_default("v")).collect()
    assert [tuple(r) for r in got] == [("2024-03", dt.date(2024, 3, 9), 0.0), ("1999-12", dt.date(1999, 12, 31), 2.5)]
