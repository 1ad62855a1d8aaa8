"""The pipeline's stages against brute force, and the registered SQL on the small tables."""

import pytest

from feedlake.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_compare import duck, rows_of


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_oracle(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    res = duck(SF_SMALL).execute(ORACLE[key])
    names = [d[0] for d in res.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, res.fetchall())


def test_stages(spark):
    import corpus_pipeline as cp
    from feedlake.llm.common import table, written

    docs, kept = table(spark, SF_SMALL, "documents"), []
    assert [n for n, _ in cp.STAGES] and 4 <= len(cp.STAGES) <= 5
    for n, (_, stage) in enumerate(cp.STAGES):
        out = written(stage(spark, docs, SF_SMALL), "stage-test")
        if n < len(cp.STAGES) - 1:
            assert out.columns == docs.columns
        kept.append(out.count())
        docs = out
    assert kept[0] >= 0.98 * table(spark, SF_SMALL, "documents").count()
    assert kept[1] >= kept[2] and kept[3] == kept[4]
    assert cp.run(spark, SF_SMALL).count() == kept[-1]


def test_stages_decide_per_row(spark):
    """Null ids, repeated ids and whole-row copies."""
    from collections import Counter

    import corpus_pipeline as cp
    from feedlake.llm import mixing

    text = lambda n, k=60: " ".join(f"w{n}x{i}" for i in range(k))
    rows = [(None, text(0)), (None, text(0)), (None, text(1)), (5, text(1)), (None, text(2)), (6, None), (None, "")]
    rows += [(7, text(3))] * 3 + [(8, text(4)), (8, text(5)), (9, text(5) + " "), (4, text(4))]
    rows += [(None, text(6)), (None, text(6, 58)), (3, text(7)), (3, text(7, 58)), (2, text(7, 59)), (2, text(8))]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id bigint, text string, source string").repartition(3)
    got = lambda df: Counter((r.doc_id, r.text) for r in df.collect())

    out = cp.exact(spark, docs, "")
    assert out.columns == docs.columns
    want = [(None, text(0)), (5, text(1)), (None, text(2)), (6, None), (7, text(3)), (4, text(4)), (9, text(5) + " ")]
    want += [(None, text(6)), (None, text(6, 58)), (3, text(7)), (3, text(7, 58)), (2, text(7, 59)), (2, text(8))]
    assert got(out) == Counter(want)

    out = list(got(cp.near(spark, docs, "")).elements())
    assert Counter(i for i, t in out if not (t or "").strip()) == Counter([6, None])  # no shingles: nothing to link by
    out = [(i, t.strip()) for i, t in out if (t or "").strip()]
    assert [t for i, t in out if i is None and t.startswith("w6x")] in ([text(6)], [text(6, 58)])
    rest = [(i, t) for i, t in out if not t.startswith("w6x")]
    want = [(None, text(0)), (5, text(1)), (None, text(2)), (7, text(3)), (4, text(4)), (8, text(5)), (2, text(7, 59)), (2, text(8))]
    assert Counter(rest) == Counter(want)

    many = spark.createDataFrame([(1 if i % 2 else None, text(i), "s") for i in range(80)], docs.schema)
    out = got(cp.mixed(spark, many, ""))
    assert max(out.values()) <= 2 and {i for i, _ in out} == {1, None}
    drawn = mixing.mix(many).collect()
    assert sum(out.values()) == sum(round(r.taken / max(r.size, 1)) for r in drawn)


def test_learning_languages_starts_no_second_kind_of_worker(spark, monkeypatch):
    """Rows of Python objects would go through a Python RDD, whose workers then wait beside those of the stages."""
    from pyspark import SparkContext

    from feedlake.llm import langid

    docs = spark.createDataFrame([(i, f"alpha beta {'gamma' if i % 2 else 'delta'}", "ab"[i % 2]) for i in range(40)], "doc_id long, text string, lang string")

    def refuse(*_, **__):
        raise AssertionError("rows of Python objects")

    monkeypatch.setattr(SparkContext, "parallelize", refuse)
    model = langid.train(docs)
    assert model.languages == ["a", "b"] and model.slices.any()
    best, _, known = langid.score(["beta delta", "gamma"], model)
    assert list(best) == [0, 1] and known.all()


def test_waiting_workers_hold_no_encoder(spark):
    import pyarrow as pa

    import corpus_pipeline as cp
    from feedlake.llm import bpe

    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(64)], "doc_id long, text string").repartition(16, "doc_id")
    assert cp.tokens(spark, docs, "").count() == 64

    def held(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([bpe.encoder.cache_info().currsize])], ["n"])

    assert {r.n for r in spark.range(0, 640, 1, 32).mapInArrow(held, "n long").collect()} == {0}


@pytest.mark.parametrize("stage", ["language", "exact", "near", "mixed", "tokens"])
def test_stages_read_without_vectored_buffers(spark, stage):
    import corpus_pipeline as cp

    key = "parquet.hadoop.vectored.io.enabled"
    docs = spark.createDataFrame([(1, "a text of words", "en", "s")], "doc_id long, text string, lang string, source string")
    spark.conf.unset(key)
    getattr(cp, stage)(spark, docs, "")
    assert spark.conf.get(key) == "false"


def test_stages_keep_no_copy_of_a_table(spark, tmp_path, monkeypatch):
    """Rows of a table just read are known by their place in its files; others are written once."""
    import corpus_pipeline as cp

    rows = [(i % 40, f"t{i} " * 9, "s") for i in range(90)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(7).write.parquet(f"{tmp_path}/docs")
    read, copies = spark.read.parquet(f"{tmp_path}/docs"), []
    monkeypatch.setattr(cp, "written", lambda df, name, *a, f=cp.written: copies.append(name) or f(df, name, *a))
    keys = {r.text: r[cp.ROW] for r in cp.keyed(read).collect()}
    assert not copies and len(set(keys.values())) == len(keys) == 90
    some = cp.keyed(read).select(cp.ROW, "text").filter("doc_id = 3").repartition(2)
    assert all(keys[r.text] == r[cp.ROW] for r in some.collect())
    for stage in (cp.exact, cp.near, cp.mixed):
        assert stage(spark, read, "").columns == read.columns
    assert "rows" not in copies
    for df in (read.repartition(3), read.union(read)):
        assert len({r[cp.ROW] for r in cp.keyed(df).collect()}) == df.count()
    assert copies[-2:] == ["rows", "rows"]
