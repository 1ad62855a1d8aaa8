"""Cleaning and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlake import functions as X
from feedlake.operators import clean as C
from feedlake.operators.parquet_text import coarse_types, iso_projection
from feedlake.plans.feeds import table
from feedlake.plans.registry import query

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


# fixed values: the columns of the driver tables (only used to write the oracle SQL)
TABLE_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}

_COUNTS_SQL = "\n  UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS n_values FROM {t}"
    for t in TABLES for c in TABLE_COLUMNS[t]
)


@query(
    "parquet_stringify",
    f"""
WITH counts AS (
  {_COUNTS_SQL})
SELECT c.table_name, c.column_name,
       CASE WHEN upper(i.data_type) LIKE '%INT%' THEN 'integer'
            WHEN upper(i.data_type) LIKE '%FLOAT%' OR upper(i.data_type) LIKE '%DOUBLE%' THEN 'number'
            WHEN upper(i.data_type) LIKE '%BOOL%' THEN 'boolean'
            ELSE 'string' END AS json_type,
       c.n_values
FROM counts c JOIN information_schema.columns i ON i.table_name = c.table_name AND i.column_name = c.column_name
""",
)
def parquet_stringify(spark, sf_dir):
    """The coarse JSON type the Parquet source declares for every column of every
    table, with the number of values it would send (one aggregate pass per table)."""
    out = None
    for t in TABLES:
        df = coarse_types(table(spark, sf_dir, t)).select(F.lit(t).alias("table_name"), "*")
        out = df if out is None else out.unionByName(df)
    return out


@query(
    "parquet_iso_text",
    """
SELECT event_id,
       CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS ts,
       user_id, event_type, value, props
FROM events
""",
)
def parquet_iso_text(spark, sf_dir):
    """Temporal values as ISO text (fraction only when non-zero), other types kept."""
    return iso_projection(table(spark, sf_dir, "events"))


@query(
    "parquet_iso_text_dates",
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS o_orderdate FROM orders
""",
)
def parquet_iso_text_dates(spark, sf_dir):
    return iso_projection(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))


@query("clean_filter_ne", "SELECT * FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'")
def clean_filter_ne(spark, sf_dir):
    return C.filter_ne(table(spark, sf_dir, "orders"), "o_orderstatus", "F")


@query("clean_filter_eq", "SELECT * FROM orders WHERE o_orderstatus = 'O'")
def clean_filter_eq(spark, sf_dir):
    return C.filter_eq(table(spark, sf_dir, "orders"), "o_orderstatus", "O")


@query("clean_drop_pii", "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def clean_drop_pii(spark, sf_dir):
    """PII columns removed; ``email``/``phone`` are absent and ignored."""
    return C.drop_columns(table(spark, sf_dir, "customer"), ["c_name", "email", "phone"])


@query(
    "clean_rename",
    """
SELECT p_partkey AS part_id, p_name AS name, p_brand AS brand, p_type AS type, p_size AS size,
       p_retailprice AS price FROM part
""",
)
def clean_rename(spark, sf_dir):
    mapping = {"p_partkey": "part_id", "p_name": "name", "p_brand": "brand", "p_type": "type",
               "p_size": "size", "p_retailprice": "price", "p_comment": "comment"}
    return C.rename(table(spark, sf_dir, "part"), mapping)


@query(
    "clean_computed",
    "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem",
)
def clean_computed(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    out = C.computed(li, "revenue", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return out.select("l_orderkey", "l_linenumber", "revenue")


@query(
    "filter_month_range",
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, o_totalprice FROM orders
WHERE strftime(o_orderdate, '%Y-%m') >= '1998-07'
""",
)
def filter_month_range(spark, sf_dir):
    """P20: ``month >= '1998-07'``, planned as a timestamp bound so it reaches the Parquet scan."""
    o = table(spark, sf_dir, "orders")
    return C.month_at_least(o, "o_orderdate", "1998-07").select(
        "o_orderkey", X.month_text("o_orderdate").alias("month"), "o_totalprice"
    )


@query(
    "clean_text",
    f"""
SELECT doc_id,
       regexp_replace(regexp_replace(lower(text), '^{X.PY_WHITESPACE}+', ''), '{X.PY_WHITESPACE}+$', '') AS text
FROM documents
""",
)
def clean_text(spark, sf_dir):
    """whole documents lower-cased and stripped."""
    return table(spark, sf_dir, "documents").select("doc_id", X.clean_text("text").alias("text"))


@query(
    "clean_parse_datetime",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate FROM orders",
)
def clean_parse_datetime(spark, sf_dir):
    """F2 on dates sent as text, every 17th key unparsable."""
    o = table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 17 == 0, F.lit("not a date")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    )
    return o.select("o_orderkey", X.parse_datetime(text).alias("o_orderdate"))


@query("clean_month", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def clean_month(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", X.month_text("o_orderdate").alias("month"))


@query(
    "clean_numeric_fill",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS value FROM events",
)
def clean_numeric_fill(spark, sf_dir):
    """amounts as text, error rows carry junk text -> 0."""
    ev = table(spark, sf_dir, "events")
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    return ev.select("event_id", X.numeric_fill(text).alias("value"))


@query("parse_decimal_comma", "SELECT c_custkey, c_acctbal FROM customer")
def parse_decimal_comma(spark, sf_dir):
    """balances written with a decimal comma parse back to the same numbers."""
    c = table(spark, sf_dir, "customer")
    text = F.replace(F.col("c_acctbal").cast("string"), F.lit("."), F.lit(","))
    return c.select("c_custkey", X.decimal_comma(text).alias("c_acctbal"))


@query(
    "parse_bool_token",
    "SELECT doc_id, quality = 1 AS is_quality, toxic = 1 AS is_toxic FROM labels",
)
def parse_bool_token(spark, sf_dir):
    """0/1 flags spelled sim/nao and yes/no."""
    lab = table(spark, sf_dir, "labels")
    q = F.when(F.col("quality") == 1, "sim").when(F.col("quality") == 0, "nao")
    t = F.when(F.col("toxic") == 1, "Yes").when(F.col("toxic") == 0, " no ")
    return lab.select("doc_id", X.bool_token(q).alias("is_quality"), X.bool_token(t).alias("is_toxic"))


def _re(p: str) -> str:
    return p.replace("'", "''")


@query(
    "url_extract",
    f"""
SELECT page_id,
       nullif(regexp_extract(url, '{_re(X.URL_SCHEME)}', 1), '') AS scheme,
       nullif(regexp_extract(url, '{_re(X.URL_HOST)}', 1), '') AS host,
       nullif(regexp_extract(url, '{_re(X.URL_LANG)}', 1), '') AS lang,
       nullif(regexp_extract(url, '{_re(X.URL_ID)}', 1), '') AS item_id,
       nullif(regexp_extract(url, '{_re(X.URL_PAGE)}', 1), '') AS page
FROM pages
""",
)
def url_extract(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        X.url_part("url", X.URL_SCHEME).alias("scheme"),
        X.url_part("url", X.URL_HOST).alias("host"),
        X.url_part("url", X.URL_LANG).alias("lang"),
        X.url_part("url", X.URL_ID).alias("item_id"),
        X.url_part("url", X.URL_PAGE).alias("page"),
    )


@query(
    "nan_to_default",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS value FROM events",
)
def nan_to_default(spark, sf_dir):
    """error rows carry NaN amounts; NaN -> 0 before writing."""
    ev = table(spark, sf_dir, "events")
    v = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return ev.select("event_id", X.nan_to_default(v).alias("value"))
