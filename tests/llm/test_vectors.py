"""Vector operators against brute force, with awkward rows, ties, copies and several matrices."""

import math
import random

import pytest

from feedlake.llm import embedding_dedup, hard_negatives

SCHEMA = "vec_id bigint, embedding array<double>, label int, score string, id string, cls string"


def rows_of(seed=3, n=420, dim=6):
    """Few distinct directions, so that scores tie; a crowd of copies; rows that take no part."""
    rng = random.Random(seed)
    base = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(25)]
    out = []
    for i in range(n):
        x = [round(v, 1) for v in rng.choice(base)] if i % 3 else list(base[0])
        if i % 5 == 0:
            x[rng.randrange(dim)] += 0.25
        out.append((i, x, rng.randrange(4) if i % 2 else 1))
    out += [(500, None, 1), (600, [1.0, None] + [0.0] * (dim - 2), 1), (700, [math.nan] * dim, 1), (800, [math.inf] * dim, 2), (900, base[1], None)]
    out += [(None, base[1], 1), (100, base[2], 1), (100, out[100][1], out[100][2]), (200, [0.0] * dim, 9), (1000, [], 1), (1001, [], 2), (1002, [], 1), (1100, [2.0], 1), (1101, [1.9], 3), (1102, [2.0], 1)]
    out += [(-300, [-v for v in base[3]], 2)]
    return out


def frame(spark, rows, parts=5):
    return spark.createDataFrame([r + ("x", "y", "z") for r in rows], SCHEMA).repartition(parts)


def clamp(x):
    return max(-(2**63), min(2**63 - 1, x))


def mined(rows):
    fine = []
    for i, x, label in rows:
        if i is not None and label is not None and x is not None and all(v is not None and math.isfinite(v) for v in x):
            fine.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * v) for v in x]))
    out = []
    for k, (a, label, q) in enumerate(fine):
        if a % 100:
            continue
        s = sorted((-clamp(sum(u * v for u, v in zip(q, r))), i, y) for j, (i, y, r) in enumerate(fine) if j != k and len(r) == len(q))
        for p, pid, _ in [x for x in s if x[2] == label][:5]:
            found = [(i, -n) for n, i, y in s if y != label and 80 * -p <= 100 * -n <= 100 * -p][:5]
            out += [(a, pid, rank, i, -p, n) for rank, (i, n) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("matrix_bytes", [32 << 20, 700])
def test_hard_negatives(spark, matrix_bytes):
    rows = rows_of()
    got = hard_negatives.hard_negatives(frame(spark, rows), matrix_bytes).collect()
    assert sorted(tuple(r) for r in got) == mined(rows) and got


@pytest.mark.parametrize("matrix_bytes", [32 << 20, 700])
def test_hard_negatives_meet_in_any_partition(spark, matrix_bytes):
    # small shuffles are put together in one task, where both sides meet whatever their hashes
    rows, key = rows_of(), "spark.sql.adaptive.coalescePartitions.enabled"
    was = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        got = hard_negatives.hard_negatives(frame(spark, rows), matrix_bytes).collect()
    finally:
        spark.conf.set(key, was)
    assert sorted(tuple(r) for r in got) == mined(rows) and got


def test_hard_negatives_of_large_numbers_and_nothing(spark):
    rows = [(i, [1e17 * (i % 3), -3e14 + i, 1e308 if i == 9 else 5.0], i % 2) for i in list(range(0, 30)) + [100, 200, 300]]
    got = hard_negatives.hard_negatives(frame(spark, rows)).collect()
    want = mined([(i, [min(v, 1e300 / 256) for v in x], y) for i, x, y in rows])
    assert sorted(tuple(r) for r in got) == want and got
    assert hard_negatives.hard_negatives(frame(spark, [])).count() == 0
    assert hard_negatives.hard_negatives(frame(spark, [(100, None, 1), (100, [1.0], None)])).count() == 0
    assert hard_negatives.hard_negatives(frame(spark, [(0, [1.0], 1)])).count() == 0


def test_keys_sort_by_falling_score(spark):
    import itertools

    values = [-(2**63), -5, -1, 0, 1, 7, 2**63 - 1]
    rows = [(1, 9, s, i, p) for s, i, p in itertools.product(values, values[:5], [True, False])]
    df = spark.createDataFrame(rows, "anchor bigint, anchor_id bigint, score bigint, id bigint, positive boolean")
    keys = sorted(r.key for r in hard_negatives.packed_keys(df).collect())
    back = [hard_negatives.KEY.unpack(bytes(k)) for k in keys]
    assert [(1, -1 - (f - 2**63), not n, i - 2**63) for _, f, n, i in back] == sorted(((1, s, p, i) for _, _, s, i, p in rows), key=lambda r: (-r[1], not r[2], r[3]))


def near_rows(seed=7, n=260, dim=20):
    """Loose and tight clusters, pairs just above and below 0.95, scaled and exact copies, rows that link with nothing."""
    rng = random.Random(seed)
    unit = lambda: [rng.gauss(0, 1) for _ in range(dim)]
    base, out = [unit() for _ in range(12)], []
    for i in range(n):
        b, noise = rng.choice(base[: 3 if i % 2 else 12]), unit()
        size = rng.choice([0.0, 0.02, 0.1, 0.15, 0.2, 0.25, 0.3])
        out.append((i * 7 % 1009, [u + size * v for u, v in zip(b, noise)], i % 3))
    out += [(2000 + i, [v * 3.0 for v in out[i][1]], 1) for i in range(0, 40, 4)] + [(3000, list(out[5][1]), None), (out[6][0], list(out[6][1]), 2), (out[7][0], unit(), 2)]
    # chains: neighbours link, ends do not
    for k in range(12):
        a = 0.25 * k
        out.append((4000 - k, [math.cos(a), math.sin(a)] + [0.0] * (dim - 2), 1))
    out += [(5000, None, 1), (5001, [0.0] * dim, 1), (5002, [0.0] * dim, 1), (5003, [None] + [1.0] * (dim - 1), 1), (5004, [math.nan] * dim, 1), (5005, [math.inf] * dim, 1)]
    out += [(5006, [], 1), (5007, [], 1), (5008, [2.0], 1), (5009, [5e-324], 1), (5010, [-1e308], 1), (5011, [1e308, 1e308], 1), (5012, [1e-300, 1e-300], 1), (5013, out[0][1][:-1], 1)]
    out += [(None, list(out[8][1]), 1), (None, unit(), 1), (None, None, 1)]
    return out


def linked(rows, least=0.95):
    units = []
    for i, x, _ in rows:
        u = None
        if x and all(v is not None and math.isfinite(v) for v in x) and any(x):
            top = max(map(abs, x))
            y = [v / top for v in x]
            norm = math.sqrt(sum(v * v for v in y))
            u = [v / norm for v in y]
        units.append(u)
    up, degree = list(range(len(rows))), [0] * len(rows)

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if units[a] and units[b] and len(units[a]) == len(units[b]):
                cosine = sum(u * v for u, v in zip(units[a], units[b]))
                assert abs(cosine - least) > 1e-9  # the fixture holds no pair that rounding could decide
                if cosine > least:
                    degree[a] += 1
                    degree[b] += 1
                    up[find(a)] = find(b)
    lows = {}
    for a, (i, _, _) in enumerate(rows):
        if i is not None:
            lows[find(a)] = min(i, lows.get(find(a), i))
    return sorted(((i, degree[a], lows.get(find(a)), i is not None and lows[find(a)] == i) for a, (i, _, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("chunk_rows, block_dims", [(1 << 15, 16), (40, 4), (7, 1)])
def test_embedding_dedup(spark, chunk_rows, block_dims):
    rows = near_rows()
    got = embedding_dedup.embedding_dedup(frame(spark, rows), chunk_rows=chunk_rows, block_dims=block_dims).collect()
    want = linked(rows)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert max(r[1] for r in want) > 20 and len({r[2] for r in want}) > 10


def test_embedding_dedup_of_floats_crowds_and_nothing(spark):
    rng = random.Random(1)
    base = [rng.gauss(0, 1) for _ in range(8)]
    rows = [(i, [v + 0.01 * rng.gauss(0, 1) for v in base] if i % 3 else base, 0) for i in range(900)]
    df = frame(spark, rows).selectExpr("vec_id", "cast(embedding as array<float>) embedding", "label")
    got = embedding_dedup.embedding_dedup(df, chunk_rows=100).collect()
    assert {tuple(r)[1:3] for r in got} == {(899, 0)} and [r.vec_id for r in got if r.kept] == [0]
    assert embedding_dedup.embedding_dedup(frame(spark, [])).count() == 0
    assert [tuple(r) for r in embedding_dedup.embedding_dedup(frame(spark, [(3, None, 1)])).collect()] == [(3, 0, 3, True)]


def test_rotation_keeps_lengths():
    import numpy as np

    x = np.random.default_rng(0).normal(size=(5, 20))
    r = embedding_dedup.rotated(x)
    assert r.shape == (5, 32) and np.allclose(x @ x.T, r @ r.T)
