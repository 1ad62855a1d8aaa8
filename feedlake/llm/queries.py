"""Registered queries of the text operators, and their DuckDB SQL where SQL can express them.

Each query applies its operator with production parameters to its whole
table and derives the report columns from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import bpe, embedding_dedup, exact_dedup, hard_negatives, jaccard_join, langid, merkle, mixing, quality, secrets, substring_dedup, toxicity, warc
from feedlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql:
            ORACLE[key] = sql.strip()
        return fn

    return deco


def remainder(n: int):
    """crc32 of the id as text, modulo ``n``: the folds of the learned operators."""
    return F.crc32(F.col("doc_id").cast("string")) % n


@query(
    "op1_substring_dedup",
    r"""
    WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ 	-
]+'), lambda x: x <> '') AS ws
               FROM documents),
    g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k
          FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
    m AS (SELECT k, min(doc_id) AS first_id FROM g GROUP BY k HAVING count(DISTINCT doc_id) > 1),
    gone AS (SELECT DISTINCT doc_id, i + j AS p
             FROM (SELECT doc_id, i FROM g JOIN m USING (k) WHERE doc_id > first_id), range(0, 13) r(j)),
    gl AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
    SELECT doc_id, len(ws) AS n_words, coalesce(len(ps), 0) AS n_removed,
           sha256(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE
             list_transform(list_filter(range(1, len(ws) + 1), lambda i: NOT list_contains(ps, i)), lambda i: ws[i]) END, ' '))
             AS kept_sha256
    FROM w LEFT JOIN gl USING (doc_id)
    """,
)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.digest_columns(bpe.round_trip(table(spark, sf_dir, "documents"), path, pattern))


@query("op3_source_mix")
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


@query("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest_columns(secrets.secret_scan(table(spark, sf_dir, "documents")))


@query(
    "op5_jaccard_components",
    r"""
    WITH RECURSIVE
    w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'), lambda x: x <> '') AS ws
          FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
            ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY 1),
    common AS (SELECT g FROM s GROUP BY 1 HAVING count(*) > 1),
    t AS (SELECT doc_id, g FROM s SEMI JOIN common USING (g)),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id
          GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 80 * (x.c + y.c - m)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT doc_id, doc_id AS o FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.o = e.a)
    SELECT r.doc_id, coalesce(any_value(n.c), 0)::BIGINT AS n_shingles, min(o) AS component_id
    FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
    """,
)
def op5_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents"))


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


@query(
    "op7_warc_revisits",
    r"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, strlen(html) AS n, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
    SELECT page_id, n AS payload_bytes,
           list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
             (('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT, 1)), 'string_agg', '')
             AS payload_digest,
           CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM d
    """,
)
def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_pages(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(remainder(5) != 0))
    scored = toxicity.toxicity(docs, model)
    return scored.select("doc_id", (remainder(5) == 0).alias("held_out"), "score", "predicted", *toxicity.FEATURES)


@query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(remainder(3) != 1))
    found = langid.identify(docs, model)
    return found.select("doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", "score")


@query(
    "op10_exact_dedup",
    r"""
    WITH d AS (
      SELECT doc_id, length(coalesce(text, '')) AS n,
             sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS h
      FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
           doc_id = first_value(doc_id) OVER w AS kept, h AS text_sha256, false AS seen_before
    FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)
    """,
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query(
    "op11_merkle_manifest",
    r"""
    WITH RECURSIVE
    f AS (SELECT doc_id, lang, crc.c % 3 = 0 AS tampered,
            [coalesce(strlen(x) || ':' || x, '-') FOR x IN [doc_id::VARCHAR, source, lang, n_chars::VARCHAR]].list_aggregate('string_agg', '') AS head,
            text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS folded
          FROM documents, LATERAL (SELECT xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
            lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda v, k: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END)),
            4294967295::BIGINT), 4294967295::BIGINT) AS c) crc),
    l AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
            CASE WHEN tampered THEN sha256(head || coalesce(strlen(folded) || ':' || folded, '-')) END AS claimed,
            row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS p FROM f),
    t AS (SELECT lang, 0 AS lvl, p, leaf AS d FROM l
          UNION ALL
          SELECT lang, lvl + 1, p // 8, sha256(string_agg(d, '' ORDER BY p))
          FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM t) WHERE n > 1 GROUP BY lang, lvl, p // 8),
    s AS (SELECT lang, arg_max(d, lvl) AS subroot, max(lvl) AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS sp FROM t GROUP BY lang),
    u AS (SELECT 0 AS lvl, sp AS p, subroot AS d FROM s
          UNION ALL
          SELECT lvl + 1, p // 8, sha256(string_agg(d, '' ORDER BY p))
          FROM (SELECT *, count(*) OVER () AS n FROM u) WHERE n > 1 GROUP BY lvl, p // 8),
    r AS (SELECT arg_max(d, lvl) AS root FROM u),
    nodes AS (SELECT t.lang, t.lvl, t.p, t.d FROM t JOIN s ON t.lang IS NOT DISTINCT FROM s.lang WHERE t.lvl < s.height
              UNION ALL SELECT s.lang, s.height + u.lvl, u.p, u.d FROM s, u WHERE u.lvl < (SELECT max(lvl) FROM u)),
    sides AS (SELECT a.lang, a.lvl, a.p,
                coalesce(string_agg(b.d, '' ORDER BY b.p) FILTER (b.p < a.p), '') AS lft,
                coalesce(string_agg(b.d, '' ORDER BY b.p) FILTER (b.p > a.p), '') AS rgt
              FROM nodes a JOIN nodes b ON a.lang IS NOT DISTINCT FROM b.lang AND a.lvl = b.lvl AND a.p // 8 = b.p // 8
              GROUP BY a.lang, a.lvl, a.p),
    w AS (SELECT l.doc_id, l.lang, 0 AS lvl, l.p, coalesce(l.claimed, l.leaf) AS d, '' AS proof FROM l
          UNION ALL
          SELECT w.doc_id, w.lang, w.lvl + 1,
            CASE WHEN w.lvl + 1 = s.height THEN s.sp ELSE w.p // 8 END, sha256(x.lft || w.d || x.rgt), w.proof || x.lft || x.rgt
          FROM (SELECT w.* REPLACE (CASE WHEN s.height = 0 AND w.lvl = 0 THEN s.sp ELSE w.p END AS p) FROM w JOIN s ON w.lang IS NOT DISTINCT FROM s.lang) w
          JOIN s ON w.lang IS NOT DISTINCT FROM s.lang
          JOIN sides x ON x.lang IS NOT DISTINCT FROM w.lang AND x.lvl = w.lvl AND x.p = w.p),
    e AS (SELECT doc_id, arg_max(d, lvl) AS folded_root, sha256(arg_max(proof, lvl)) AS proof_sha256 FROM w GROUP BY doc_id)
    SELECT l.doc_id, l.leaf, s.subroot, r.root, e.proof_sha256, e.folded_root, e.folded_root = r.root AS verified
    FROM l JOIN s ON l.lang IS NOT DISTINCT FROM s.lang JOIN e ON e.doc_id = l.doc_id, r
    """,
)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = merkle.leaf(text=F.translate("text", ascii_uppercase, ascii_lowercase))
    return merkle.prove(table(spark, sf_dir, "documents"), claimed=F.when(remainder(3) == 0, lowered))


@query(
    "op12_hard_negatives",
    """
    WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
               FROM embeddings
               WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
          FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT p.anchor_id, p.vec_id AS positive_id,
           row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
           n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
      AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
    QUALIFY rank <= 5
    """,
)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


@query(
    "op13_embedding_dedup",
    """
    WITH RECURSIVE
    e AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
          AND list_cosine_similarity(a.x, b.x) >= 0.95),
    r AS (SELECT vec_id, vec_id AS o FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.o = l.a),
    n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
    SELECT r.vec_id, coalesce(any_value(n.n_links), 0)::BIGINT AS n_links, min(o) AS component_id, r.vec_id = min(o) AS kept
    FROM r LEFT JOIN n USING (vec_id) GROUP BY r.vec_id
    """,
)
def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(table(spark, sf_dir, "embeddings"))
