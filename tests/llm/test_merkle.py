"""The manifest against a recursive version, on small trees of every shape and on several blocks."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from feedlake.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars int, text string, leaf string, node string, tree string, pos string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, lower=False):
    fields = list(row[:5])
    if lower and fields[4] is not None:
        fields[4] = "".join(c.lower() if "A" <= c <= "Z" else c for c in fields[4])
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def path(nodes, i):
    """Top of the tree, and the (left, right) siblings of node ``i``, by plain recursion."""
    if len(nodes) == 1:
        return nodes[0], []
    runs = [nodes[k : k + 8] for k in range(0, len(nodes), 8)]
    top, above = path([h(*r) for r in runs], i // 8)
    return top, [(runs[i // 8][: i % 8], runs[i // 8][i % 8 + 1 :]), *above]


def expected(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    tops = {}
    for lang in order:
        trees[lang].sort(key=lambda x: x[:3])
        tops[lang] = path([x[2] for x in trees[lang]], 0)[0]
    out = []
    for k, lang in enumerate(order):
        root, above = path([tops[x] for x in order], k)
        for i, (_, _, own, row) in enumerate(trees[lang]):
            witness = path([x[2] for x in trees[lang]], i)[1] + above
            claim = leaf(row, lower=row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0)
            for left, right in witness:
                claim = h(*left, claim, *right)
            proof = h(*(x for left, right in witness for x in left + right))
            out.append((row[0], own, tops[lang], root, proof, claim, claim == root))
    return sorted(out, key=repr)


def proved(spark, rows):
    df = spark.createDataFrame([r + ("x", "y", "z", "w") for r in rows], SCHEMA).repartition(7)
    lowered = merkle.leaf(text=F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return merkle.prove(df, claimed=F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lowered))


AWKWARD = [
    (5, "s", "en", 3, "Abc"), (5, "s", "en", 3, "Abc"), (5, "s", "en", 3, "ABC"), (None, None, "en", None, None), (None, "s", None, 1, "É A"),
    (2, "s", None, 0, ""), (0, "s", "", 5, "Große Welt" * 30_000), (7, "s", "Ä", 1, "Z"), (8, "s", "z\U0001f600", 1, "Z"), (9, "s", "z￿", 1, "plain"),
]


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8}, {"en": 9, "de": 1}, {"en": 64, "de": 65, None: 7}, {str(i): i for i in range(1, 12)}, {"en": 1100, None: 513, "fr": 512}])
def test_trees_of_any_shape(spark, sizes):
    rows = [(i * 7 % 5003, "s", lang, i % 9, f"Text {i}" if i % 3 else "low") for i, lang in enumerate(x for lang, n in sizes.items() for x in [lang] * n)]
    assert sorted((tuple(r) for r in proved(spark, rows).collect()), key=repr) == expected(rows)


def test_awkward_rows(spark):
    got = sorted((tuple(r) for r in proved(spark, AWKWARD).collect()), key=repr)
    assert got == expected(AWKWARD)
    assert {r[6] for r in got} == {True, False}


def test_empty_and_siblings(spark):
    assert merkle.prove(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([r + ("x",) * 4 for r in AWKWARD], SCHEMA)
    for r in merkle.prove(df, siblings=True).collect():
        sides = [s.encode() for s in r.siblings]
        assert merkle.fold(r.leaf.encode(), list(zip(sides[::2], sides[1::2]))).decode() == r.root and r.verified
        assert h(*r.siblings) == r.proof_sha256


def test_frontier_is_incremental():
    """A witness is whole as soon as its run is, and later completions only extend it."""
    tree, nodes = merkle.Frontier(), [h(str(i)).encode() for i in range(70)]
    seen = []
    for n in nodes:
        seen.append(tree.append(n))
    assert [len(w) for w in seen] == [2] * 64 + [0] * 6
    assert tree.close(3).decode() == path([n.decode() for n in nodes], 0)[0]
    assert all(merkle.fold(n, w) == tree.open[3][0][0] for n, w in zip(nodes, seen))
