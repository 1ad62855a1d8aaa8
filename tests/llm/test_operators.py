"""Each operator against a brute-force version on small tables with the awkward rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import bpe, exact_dedup, jaccard_join, langid, mixing, quality, secrets, spans, substring_dedup, toxicity, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = "ab cde fgh ij kl mno pq rst uvw xyz alpha beta gamma delta".split()


def words(rng, n):
    return " ".join(rng.choice(LETTERS) + str(rng.randint(0, 30)) for _ in range(n))


def corpus():
    """Copies, near copies, shared passages, nulls, blanks, a long text; a column that clashes."""
    rng = random.Random(5)
    base = [words(rng, n) for n in (1, 3, 12, 13, 14, 40, 120, 400)]
    passage, long = words(rng, 30), words(rng, 6000)
    rows = [None, "", " \t\n", "éß " * 3, long, long + " end"]
    rows += base * 3 + [f"{words(rng, 50)} {passage} {words(rng, 60)}" for _ in range(12)]
    for b in base[4:]:
        for _ in range(4):
            w = b.split()
            w[rng.randrange(len(w))] = "edited"
            rows.append("  ".join(w).upper())
    return [(i * 3 % 101, t, ["en", "de", None][i % 3], ["s1", "s2", None][i % 3], i, "x") for i, t in enumerate(rows)]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_words bigint, kept string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_substring_dedup(docs, empty):
    texts = {r[0]: (r[1] or "") for r in corpus()}
    first = {}
    for i in sorted(texts):
        w = WORD.findall(texts[i])
        for p in range(len(w) - 12):
            first.setdefault(tuple(w[p : p + 13]), i)
    want = {}
    for i, t in texts.items():
        w = WORD.findall(t)
        gone = {q for p in range(len(w) - 12) if first[tuple(w[p : p + 13])] < i for q in range(p, p + 13)}
        want[i] = (len(w), len(gone), " ".join(x for q, x in enumerate(w) if q not in gone))
    # small blocks, so that copies lie in different ones
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup.substring_dedup(docs, block_bytes=700).collect()}
    assert got == want and any(n for _, n, _ in want.values())
    assert substring_dedup.substring_dedup(empty).count() == 0


@pytest.mark.parametrize("window", [3, 13, 30])
@pytest.mark.parametrize(
    "texts, parts",
    [
        (["a b c"], 1),
        ([f"{words(random.Random(i), 40)} only{i}" for i in range(40)], 4),  # nothing repeats
        ([None, None, ""], 2),
        ([words(random.Random(i % 3 if i < 12 else i), 60) for i in range(40)] + [None, "x"], 8),  # blocks with and without repeats
    ],
)
def test_substring_blocks_without_repeats(spark, texts, parts, window):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(parts)
    first, want = {}, {}
    for i, t in enumerate(texts):
        w = WORD.findall(t or "")
        starts = [tuple(w[p : p + window]) for p in range(len(w) - window + 1)]
        gone = {q for p, g in enumerate(starts) if first.get(g, i) < i for q in range(p, p + window)}
        for g in starts:
            first.setdefault(g, i)
        want[i] = (len(w), len(gone))
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(df, window=window, block_bytes=400).collect()}
    assert got == want


@pytest.mark.parametrize("window", [5, 7, 30])
def test_substring_levels(docs, window):
    texts = {r[0]: (r[1] or "") for r in corpus()}
    first, want = {}, {}
    for i in sorted(texts):
        w = WORD.findall(texts[i])
        for p in range(len(w) - window + 1):
            first.setdefault(tuple(w[p : p + window]), i)
    for i, t in texts.items():
        w = WORD.findall(t)
        want[i] = len({q for p in range(len(w) - window + 1) if first[tuple(w[p : p + window])] < i for q in range(p, p + window)})
    got = substring_dedup.substring_dedup(docs, window=window, block_bytes=700)
    assert {r.doc_id: r.n_removed for r in got.collect()} == want


def test_words_of_a_batch():
    raw = [b"", b" a  bc\n", b"\xc3\xa9", b"\t", b"d"]
    w = spans.Words(raw)
    assert [bytes(w.data[a:b]) for a, b in zip(w.start, w.end)] == [b"a", b"bc", b"\xc3\xa9", b"d"]
    assert w.text.tolist() == [1, 1, 2, 4] and w.first.tolist() == [0, 0, 2, 3, 3, 4]
    assert (spans.Words([b"AB cd"]).hashes(1, fold=True) == spans.Words([b"ab", b"CD"]).hashes(1, fold=True)).all()


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers as p

    return p.path("byte_bpe_multi_50k.tiktoken"), p.PATTERN


def test_bpe_equals_the_library(docs, empty, vocabulary):
    import tiktoken

    path, pattern = vocabulary
    lib = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    rows = bpe.decode(bpe.encode(docs, path, pattern), path).collect()
    assert sorted(bpe.round_trip(docs, path, pattern).collect()) == sorted(rows)
    texts = {r[0]: (r[1] or "") for r in corpus()}
    assert len(rows) == len(texts)
    for r in rows:
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == lib.encode_ordinary(texts[r.doc_id])
        assert bytes(r.decoded).decode() == texts[r.doc_id]
    assert bpe.encode(empty, path, pattern).count() == 0
    enc, rng = bpe.encoder(path, pattern), random.Random(3)
    parts = ["ab", " the", "  ", "\n", " \t", "'s", "'LL", "012", "é", "漢", "\U0001f600", "<|endoftext|>", "er", "ation", "\x1c", " "]
    for _ in range(3000):
        s = "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))
        assert np.frombuffer(enc.encode(s), "<u4").tolist() == lib.encode_ordinary(s), s


def test_mix(docs, empty):
    got = mixing.mix(docs, block_words=16).collect()
    again = mixing.mix(docs.repartition(3), block_words=16).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    size = Counter()
    for r in corpus():
        size[r[3]] += len(WORD.findall(r[1] or ""))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    closed = set()
    while True:
        level = (1.5 * sum(size.values()) - sum(2 * size[s] for s in closed)) / sum(weight[s] for s in names if s not in closed)
        over = {s for s in names if s not in closed and weight[s] * level > 2 * size[s]}
        if not over:
            break
        closed |= over
    target = {s: 2 * size[s] if s in closed else weight[s] * level for s in names}
    taken = Counter()
    for r in got:
        assert r.taken <= 2 * r["size"] and r.target == pytest.approx(target[r.source]) and r.source_size == size[r.source]
        taken[r.source] += r.taken
    for s in names:
        assert taken[s] == pytest.approx(target[s], abs=4 * 16)
    assert mixing.mix(empty).count() == 0


def test_secrets(spark, empty):
    texts = [
        None, "", 'password = "abcdefghijkl" x', "password: secret: abcdefghijklm", "API_KEY=AKIA" + "A1" * 8, "token==abcdefghijkl",
        "\U0001f600 token: 0123456789abcdef0123 " * 300, "AKIAAKIA AKIA1234567890ABCD", "deadbeef" * 3 + "x" + "0" * 15, "SeCrEt':'aaaaaaaaaaaa",
        "-----BEGIN RSA PRIVATE KEY-----",
    ]
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts + texts)], "doc_id bigint, text string, blob string")
    rules = [
        ("assign", re.compile(secrets.BASE[0].pattern), lambda m: len(m[2]) >= 12),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16),
    ]
    ledger = secrets.BlobLedger(spark)
    rows = {r.doc_id: r for r in secrets.digest_columns(secrets.secret_scan(docs, ledger)).collect()}
    for i, t in enumerate(texts + texts):
        found = sorted((m.start(), n, k, m.end()) for n, (k, p, ok) in enumerate(rules) for m in p.finditer(t or "") if ok(m))
        text = ",".join(f"{k}:{a}:{b}" for a, _, k, b in found)
        assert rows[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest(), (i, rows[i].spans, text)
        assert (rows[i].n_assign, rows[i].n_access, rows[i].n_hex) == tuple(sum(f[2] == k for f in found) for k, _, _ in rules)
    assert rows[10].spans.startswith("pem:0:")
    logins = [f"https://x:{'p' * 93}@host.org ok", f"{'s' * 40}://{'u' * 80}:secret@h", "ftp://u:short@h", "a://b:c@d://u:longenough@h"]
    found = secrets.secret_scan(spark.createDataFrame(list(enumerate(logins)), "doc_id bigint, text string"))
    got = {r.doc_id: [(s.start, s.end) for s in r.spans or [] if s.kind == "url_login"] for r in found.collect()}
    assert got == {0: [(8, 112)], 1: [(43, 132)], 2: [], 3: [(12, 26)]}
    pairs = ledger.scanned().count()
    assert ledger.scan(docs) == 0 and ledger.scanned().count() == pairs  # nothing unseen
    newer = secrets.BlobLedger(spark, ledger.path, secrets.BASE + (secrets.Rule("hex", 2, "[0-9a-f]{20,}"),))
    assert newer.scan(docs) == pairs // len(secrets.RULES)  # one new rule version
    assert secrets.secret_scan(empty).count() == 0


def test_components(docs, empty):
    texts = {r[0]: r[1] for r in corpus()}
    s = {}
    for i, t in texts.items():
        w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        s[i] = {tuple(w[p : p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in s}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in s:
        for b in s:
            if a < b and s[a] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.components(docs).collect()}
    assert got == {i: (len(s[i]), find(i)) for i in s}
    assert jaccard_join.components(empty).count() == 0


def test_components_of_cut_copies(spark):
    """Families whose smallest id is often too long or too short for members that are similar to each other."""
    rng, rows = random.Random(11), []
    for _ in range(60):
        text = words(rng, 320).split()
        for _ in range(14):
            n = rng.randint(60, 320)
            at = rng.choice([0, rng.randint(0, 320 - n)])
            rows.append(" ".join(text[at : at + n]))
    ids = rng.sample(range(10 * len(rows)), len(rows))
    rows = list(zip(ids, rows, strict=True))
    sets = {i: set(spans_of(t)) for i, t in rows}
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for f in range(0, len(rows), 14):
        family = [i for i, _ in rows[f : f + 14]]
        for i in family:
            for j in family:
                both = len(sets[i] & sets[j])
                if i < j and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    x, y = sorted((root(i), root(j)))
                    parent[y] = x
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    for chunk_shingles, chunk_sets in ((1 << 20, 2048), (4000, 2048), (1 << 20, 3)):  # clusters in one tile, and in many
        got = jaccard_join.components(df, chunk_shingles=chunk_shingles, chunk_sets=chunk_sets).collect()
        assert {r.doc_id: r.component_id for r in got} == {i: root(i) for i in ids}


def test_components_of_edited_copies(spark):
    """Families whose members are 60 to 95 % similar, above and below the threshold, with a passage in a third of all texts."""
    rng, rows = random.Random(12), []
    passage = words(rng, 50).split()
    for f in range(30):
        base = words(rng, rng.choice([12, 40, 90, 220])).split()
        for _ in range(14):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 45))):
                w[rng.randrange(len(w))] = f"e{rng.random()}"
            rows.append(" ".join(w + passage if f % 3 == 0 else w))
    ids = rng.sample(range(10 * len(rows)), len(rows))
    rows = list(zip(ids, rows, strict=True))
    sets = {i: set(spans_of(t)) for i, t in rows}
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    assert 30 < len({root(i) for i in ids}) < len(ids) - 30
    got = jaccard_join.components(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7), chunk_shingles=2000).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: root(i) for i in ids}


def near_copies(rng, families, copies, n=300, edits=1):
    """Texts that differ in a few words from ``copies - 1`` others."""
    out = []
    for _ in range(families):
        base = words(rng, n).split()
        for _ in range(copies):
            w = list(base)
            for _ in range(edits):
                w[rng.randrange(n)] = f"e{rng.random()}"
            out.append(" ".join(w))
    return list(enumerate(rng.sample(out, len(out))))


def test_components_scratch_of_near_copies(spark, tmp_path, monkeypatch):
    """Tables of every text with near copies: what stays written is less than the texts, and pairs are few beside their signatures."""
    docs = spark.createDataFrame(near_copies(random.Random(21), 60, 8), "doc_id bigint, text string").repartition(4)
    docs.write.parquet(f"{tmp_path}/docs")
    size = lambda at: sum(p.stat().st_size for p in (tmp_path / at).rglob("*.parquet"))
    monkeypatch.setattr("feedlake.session.scratch_root", lambda spark: f"{tmp_path}/scratch")
    got = jaccard_join.components(spark.read.parquet(f"{tmp_path}/docs")).collect()
    assert sorted(Counter(r.component_id for r in got).values()) == [8] * 60
    assert size("scratch") < 1.5 * size("docs")
    assert sum(spark.read.parquet(str(p)).count() for p in (tmp_path / "scratch/feedlake").glob("pairs-star-*")) < len(got)


def test_written_leaves_no_shuffle_files(spark):
    from feedlake.llm.common import bucketed, written

    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", found))

    rows, before = spark.range(5000).withColumn("k", F.col("id") % 700), files()
    once = written(rows.groupBy("k").agg(F.sum("id").alias("n")).repartition(5, "n"), "test-left")
    dealt = bucketed(rows, "test_left", "id", once.select(F.col("k").alias("id")))
    assert not files() - before
    assert sorted(r.id for r in dealt.collect()) == list(range(700)) and once.count() == 700


def test_rounds_send_all_tiles():
    for load in ({}, {1: 100}, {1: 100, 2: 40, 3: 90, 8: 500, 9: 70}, {64: 1000}):
        for most in (0, 300, 10**9):
            runs = jaccard_join.rounds(load, most)
            assert [d for lo, hi in runs for d in range(lo, hi + 1)] == list(range(max(load, default=0) // 2 + 1))
    assert len(jaccard_join.rounds({64: 1000}, 0)) == 33 and len(jaccard_join.rounds({64: 1000}, 10**9)) == 1


def test_components_by_rounds(spark, monkeypatch):
    """Large families of loosely similar texts, their tiles sent in several rounds."""
    rows, names = near_copies(random.Random(22), 2, 60, n=120, edits=2), []
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    whole = {r.doc_id: r.component_id for r in jaccard_join.components(df).collect()}
    monkeypatch.setattr(jaccard_join, "written", lambda df, name, f=jaccard_join.written: names.append(name) or f(df, name))
    got = jaccard_join.components(df, chunk_shingles=800, round_shingles=0).collect()
    assert 2 < len(set(whole.values())) < len(rows) and names.count("links-2") > 2
    assert {r.doc_id: r.component_id for r in got} == whole


def test_shared_counts():
    rng = np.random.default_rng(5)
    sets_ = [np.unique(rng.integers(0, rng.choice([60, 4000]), n).astype(np.uint64)) for n in rng.integers(0, 200, 150)]
    left, right = sets_[:70], sets_[70:]
    want = [[len(np.intersect1d(x, y)) for y in right] for x in left]
    assert (jaccard_join.shared_counts(left, right) == want).all()


def spans_of(text):
    w = text.split()
    return [tuple(w[p : p + 5]) for p in range(len(w) - 4)]


@pytest.mark.parametrize("common", [0, 40])
def test_similar_sets_share_keys(common):
    rng = np.random.default_rng(1)
    for n in [*range(1, 60), 150, 700]:
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        drop = n * 20 // 100  # a subset at the border
        for b in (a[drop:], np.concatenate([a[n // 9 :], rng.integers(0, 1 << 63, n // 9).astype(np.uint64)])):
            x, y = np.unique(a), np.unique(b)
            both = len(np.intersect1d(x, y))
            if 100 * both >= 80 * (len(x) + len(y) - both):
                hot = np.sort(x[:common])
                assert len(np.intersect1d(jaccard_join.keys_of(x, hot), jaccard_join.keys_of(y, hot))) >= 1, n


def test_quality_statistics(docs, empty):
    got = {r.doc_id: r for r in quality.quality(docs).collect()}
    for i, t, *_ in corpus():
        t = t or ""
        w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        tri = Counter(zip(w, w[1:], w[2:]))
        covered = {q for p, g in enumerate(zip(w, w[1:], w[2:])) if tri[g] > 1 for q in (p, p + 1, p + 2)}
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 50 or 2 * len(covered) > len(w)) and not (r.base_failed and r.kept)
    assert quality.quality(empty).count() == 0


def test_quality_outlier(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, 80) + f" {'#' * rng.randint(0, 1)}", "en", "s") for i in range(300)]
    rows += [(1000, "### $$$ *** " * 40 + words(rng, 60), "en", "s")]
    got = {r.doc_id: r.kept for r in quality.quality(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()}
    assert sum(not got[i] for i in range(300)) <= 3 and not got[1000]


def test_quality_window_words_are_compared(docs):
    plain = {r.doc_id: r.n_repeat_words for r in quality.base_stats(docs, "doc_id").collect()}
    # a hash of very few bits: almost all windows of a text fall together
    for spare in (44, 48, 52):
        assert {r.doc_id: r.n_repeat_words for r in quality.base_stats(docs, "doc_id", spare_bits=spare).collect()} == plain


def robust(x):
    """Brute force: location and Cholesky factor of one group, by the documented steps."""
    quantile = lambda v, q: np.sort(v, axis=0)[max(0, int(np.ceil(q * len(v))) - 1)]
    floor = np.array(quality.FLOOR)

    def factor(s):
        low = np.zeros((4, 4))
        for j in range(4):
            low[j, j] = np.sqrt(max(s[j, j] - low[j, :j] @ low[j, :j], floor[j] ** 2))
            for i in range(j + 1, 4):
                low[i, j] = (s[i, j] - low[i, :j] @ low[j, :j]) / low[j, j]
        return low

    def step(m, low):
        d2 = (np.linalg.solve(low, (x - m).T) ** 2).sum(0)
        near = x[d2 <= quantile(d2, quality.SUBSET) * (1 + 1e-12)]
        return near.mean(0), factor(quality.CONSISTENCY * np.cov(near.T, bias=True))

    det = lambda low: np.log(np.diag(low)).sum()
    m = quantile(x, 0.5)
    scale = np.maximum(1.4826 * quantile(np.abs(x - m), 0.5), floor)
    z = (x - m) / scale
    t = np.tanh(z)
    varies = t.std(0) > 0
    corr = np.eye(4)
    corr[np.ix_(varies, varies)] = np.atleast_2d(np.corrcoef(t[:, varies].T)) if varies.any() else 0
    norm = np.maximum((z**2).sum(1), 1e-300)
    sign = 4 * (z / norm[:, None]).T @ z / len(z)
    found = []
    for r in (np.eye(4), corr, sign):
        now = (m, factor(r * np.outer(scale, scale)))
        for _ in range(quality.EARLY):
            now = step(*now)
        found.append(now)
    now = min(found, key=lambda e: det(e[1]))
    for _ in range(quality.MOST_STEPS):
        new = step(*now)
        moved, now = abs(det(new[1]) - det(now[1])), new
        if moved <= quality.SETTLED:
            break
    return now


@pytest.mark.parametrize("small", [100, 0])
def test_quality_verdicts_by_brute_force(spark, small):
    """Broadcast and salted alike; a group of its own, a null one, two small ones that share the pooled estimate."""
    rng = random.Random(7)

    def text():
        body = words(rng, rng.randint(60, 140)) + " #" * rng.randint(0, 6) + " $" * rng.randint(0, 3)
        line = words(rng, 3)
        return body + f"\n{line}" * rng.choice([0, 0, 1, 2, 3]) + (" ### *** $$$" * 60 if rng.random() < 0.03 else "")

    of = [("en", "s")] * 260 + [(None, None)] * 150 + [("de", "s")] * 40 + [("fr", None)] * 50
    rows = [(i, text(), *g) for i, g in enumerate(of)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(4)
    got = {r.doc_id: r for r in quality.quality(docs, small=small).collect()}
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for i, _, *g in rows:
        if not got[i].base_failed:
            groups[tuple(g) if g in (["en", "s"], [None, None]) else "pooled"].append(got[i])
    # the determinant's last moves are below the bar; all groups stop together, so one may go further than alone
    for members in groups.values():
        x = np.array(
            [[np.log((r.word_chars + 1) / (r.n_words + 1)), *(np.log1p(100 * c / r.n_words) for c in (r.n_symbols, r.n_dup_lines, r.n_repeat_words))] for r in members]
        )
        m, low = robust(x)
        d2 = (np.linalg.solve(low, (x - m).T) ** 2).sum(0)
        for r, d in zip(members, d2, strict=True):
            assert abs(r.distance2 - d) <= 0.05 * d + 0.05 and (r.kept == (d <= quality.CUTOFF) or abs(d - quality.CUTOFF) < 0.05 * d)
    assert 5 <= sum(not r.kept for r in got.values()) <= 60


def test_warc_round_trip(spark):
    rows = [(5, "u5", "<p>a"), (2, "u2", "<p>a"), (7, None, None), (8, "", ""), (9, "u\r\nX: y", "WARC/1.1\r\n\r\nb" * 50), (11, "u", "<p>a"), (None, "n", "<p>a")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id bigint, url string, html string, digest string").repartition(3)
    from feedlake.session import scratch_path

    records = warc.read(spark, warc.write(warc.resolve(pages), scratch_path(spark, "warc-test")), payloads=True)
    got = {r.page_id: r for r in warc.with_payloads(records).collect()}
    first = {}
    for i, _, h in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        first.setdefault(h or "", i)
    for i, _, h in rows:
        r = got[i]
        assert r.html == (h or "") and r.payload_digest == warc.digest_of((h or "").encode()) and r.payload_bytes == len((h or "").encode())
        if i is not None:
            assert (r.record_type, r.refers_to) == (("response", None) if first[h or ""] == i else ("revisit", first[h or ""]))
    assert records.select("record_id").distinct().count() == len(rows)
    small = warc.archive_pages(pages, min_bytes=100)
    assert {r.record_type for r in small.collect()} == {"response"}
    assert warc.archive_pages(pages.filter("false")).count() == 0


def test_warc_repeated_and_null_ids(spark):
    rows = [(3, "a", "x"), (3, "b", "x"), (3, "c", "other"), (None, "d", "x"), (None, "e", "x"), (4, "f", "x"), (4, "f", "x"), (9, "g", "long " * 100_000), (8, "h", "long " * 100_000)]
    pages = spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id bigint, url string, html string, record_type string, row int").repartition(4)
    from feedlake.session import scratch_path

    records = warc.read(spark, warc.write(warc.resolve(pages), scratch_path(spark, "warc-test")), payloads=True)
    got = warc.with_payloads(records).collect()
    assert len({r.record_id for r in got}) == len(rows)
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in got) == Counter(
        [(3, "response", None), (3, "revisit", 3), (3, "response", None), (None, "response", None), (None, "response", None)]
        + [(4, "revisit", 3)] * 2 + [(8, "response", None), (9, "revisit", 8)]
    )
    html_of = {(r[0], r[1]): r[2] for r in rows}
    assert all(r.html == html_of[r.page_id, r.url] for r in got)


SF = "/root/testdata/sf0.01"


def test_language_held_out(spark, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = langid.train(docs.filter(~held))
    got = langid.identify(docs.filter(held), model, "lang").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "é"), (5, "the")], "doc_id bigint, text string")
    pred = {r.doc_id: r for r in langid.identify(odd, model).collect()}
    assert [pred[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and {pred[4].lang_pred, pred[5].lang_pred} <= set(model.languages)
    assert all(0 <= r.score <= 1 for r in [*pred.values(), *got])
    nothing = langid.train(empty)
    assert {r.lang_pred for r in langid.identify(odd, nothing).collect()} == {"und"}


def test_language_filters_equal_sets(spark):
    """The filters hold every n-gram of a language's set, and others at their false-positive rate only."""
    rng = random.Random(8)
    tongues = {k: ["".join(rng.choice(abc) for _ in range(rng.randint(2, 9))) for _ in range(300)] for k, abc in (("x", "abcdeé"), ("y", "efghij"), ("z", "klmnoß"))}
    text = lambda k: " ".join(rng.choice(tongues[k]) for _ in range(30)) + " 12!"
    rows = [(i, text(k), k) for i, k in enumerate(k for k in "xyz" for _ in range(60))] + [(900, None, "x"), (901, text("x"), None), (None, text("y"), "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    model = langid.train(docs, per_language=1000, min_count=3, share=0.125)

    def grams(t):
        for w in re.findall(r"[^\W\d_]+", t.lower()):
            for n in langid.SIZES:
                yield from (f" {w} "[i : i + n] for i in range(len(w) + 3 - n))

    counts = {k: Counter(g for _, t, lang in rows if lang == k and t for g in grams(t)) for k in "xyz"}
    rate = {k: {g: n / sum(c.values()) for g, n in c.items()} for k, c in counts.items()}
    sets = {k: {g for g, n in counts[k].items() if n >= 3 and rate[k][g] >= 0.125 * max(rate[j].get(g, 0) for j in "xyz")} for k in "xyz"}
    assert model.languages == ["x", "y", "z"]

    def holders(g):
        seq = np.array([ord(c) if c != " " else 0 for c in g], np.uint64)
        h = np.full(1, len(g), np.uint64)
        for c in seq:
            h = h * np.uint64(0x100000001B3) + c
        h = langid._mix(h)[0]
        spots = [int(h >> np.uint64(20 * j)) % len(model.slices) for j in range(langid.HASHES)]
        mask = np.bitwise_and.reduce(model.slices[spots, 0])
        return {k for i, k in enumerate("xyz") if int(mask) >> i & 1}

    every = set().union(*counts.values())
    assert all(k in holders(g) for k in "xyz" for g in sets[k])
    false = sum(k in holders(g) for k in "xyz" for g in every - sets[k])
    assert false <= 3 + 3 * sum(float(model.false_rate[i]) * len(every - sets[k]) for i, k in enumerate("xyz"))
    # the score is the corrected share of the winner's hits
    sample = spark.createDataFrame([(i, text(k), "w") for i, k in enumerate("xyz" * 5)], "doc_id bigint, text string, score string")
    for r in langid.identify(sample, model, "text").collect():
        gs = list(grams(r.text))
        share = {k: (sum(k in holders(g) for g in gs) / len(gs) - model.false_rate[i]) / (1 - model.false_rate[i]) for i, k in enumerate("xyz")}
        assert r.lang_pred == "xyz"[r.doc_id % 3] == max("xyz", key=share.get) and r.score == pytest.approx(share[r.lang_pred])


def test_language_sample_is_bounded(spark):
    docs = spark.range(6000).selectExpr("if(id % 4 = 0, null, id) as doc_id", "concat('w', id) as text", "if(id % 3 = 0, 'b', 'a') as lang")
    picked = langid.sampled(docs, 500).groupBy("lang").count().collect()
    assert {r["lang"]: abs(r["count"] - 500) < 120 for r in picked} == {"a": True, "b": True}
    assert langid.sampled(docs, 5000).count() == 6000  # all of what is less than asked for


def test_matcher_equals_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    terms = ["idiot", "moron", "disgusting", "abcd"]
    m = toxicity.Matcher(toxicity.Lexicon({**dict.fromkeys(terms, 1.0), "vequ*": 1.0}, dict.fromkeys(terms, 1.0)))
    rng = random.Random(4)
    for _ in range(4000):
        w = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            p = rng.randrange(len(w) + 1)
            w[p : p + rng.randint(0, 1)] = rng.choice(["", "x", "i", "o"])
        w = "".join(w)
        best = min(((distance(w, t), t) for t in terms if distance(w, t) <= toxicity.edits_for(t)), default=None)
        assert m.match(w) == (best and (best[1], best[0])), w
    assert m.match("vequille") == ("vequ*", 0) and m.match("veq") is None
    # an automaton that forgets its states finds the same
    small = toxicity.Matcher(toxicity.Lexicon({**dict.fromkeys(terms, 1.0), "vequ*": 1.0}, dict.fromkeys(terms, 1.0)), room=50)
    most = 0
    for _ in range(2000):
        w = "".join(rng.choice("idotmrnçßqvequ") for _ in range(rng.randint(1, 10))) if rng.random() < 0.5 else rng.choice(terms)
        assert small.match(w) == m.match(w), w
        most = max(most, small.held)
    assert most < 50 + 10 * 40  # what one word of ten letters may add


def test_toxicity_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.train(docs, labels.filter(~held))
    got = toxicity.toxicity(docs, model).join(labels.filter(held & F.col("toxic").isNotNull()), "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in got) >= 0.95 * len(got)
    odd = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert all(0 <= r.score < 0.5 for r in toxicity.toxicity(odd, model).collect())
    none = toxicity.train(docs, labels.filter("false"))
    assert all(r.predicted == 0 for r in toxicity.toxicity(odd, none).collect())


def test_toxicity_of_rare_misspelled_terms(spark):
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(n))
    terms, plain = [letters(9) for _ in range(60)], [letters(6) for _ in range(200)]
    clean = lambda: [rng.choice(plain) for _ in range(20)]
    rows = [(" ".join([*clean(), terms[i % 60]]), 1) for i in range(600)]  # each term in under 2 % of the toxic texts
    rows += [(" ".join([*clean(), terms[0][:-1] + "e"] if i % 2 else clean()), 0) for i in range(600)]
    texts = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id bigint, toxic int")
    model = toxicity.train(texts, labels)
    spelled = model.lexicon.fuzzy_weight
    assert all(t in spelled for t in terms[1:]) and terms[0] not in spelled  # its near matches are in clean texts
    wrong = [t[:1] + "e" + t[2:] for t in terms[1:]]
    matcher = toxicity.Matcher(model.lexicon)
    abuse, quotation, misspelled = toxicity.features(f"one two {wrong[0]} three", matcher, model.lexicon)[:3]
    assert abuse == misspelled > 0 == quotation
    abuse, quotation, misspelled = toxicity.features(f'he said "one {wrong[0]} two"', matcher, model.lexicon)[:3]
    assert abuse == misspelled == 0 < quotation
    got = toxicity.toxicity(spark.createDataFrame([(i, " ".join([*clean(), w])) for i, w in enumerate(wrong)], "doc_id bigint, text string"), model)
    assert sum(r.predicted for r in got.collect()) >= 0.95 * len(wrong)
    stem = toxicity.Lexicon({"vequor*": 1.0}, {"vequor*": 1.0})
    assert [toxicity.Matcher(stem).match(w) for w in ("vequorum", "vecuorum", "vecuurum")] == [("vequor*", 0), ("vequor*", 1), None]


def test_exact_dedup(spark, docs, empty):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = defaultdict(list)
    for i, t, *_ in corpus():
        groups[norm(t)].append((-len(t or ""), i))
    index = exact_dedup.DigestIndex(spark, buckets=4)
    got = {r.doc_id: r for r in index.add(docs).collect()}
    for t, members in groups.items():
        keep = min(members)[1]
        for _, i in members:
            r = got[i]
            assert (r.keep_id, r.group_size, r.kept) == (keep, len(members), i == keep)
            assert r.text_sha256 == hashlib.sha256(t.encode()).hexdigest()
    more = spark.createDataFrame([(500, "brand new"), (501, corpus()[10][1]), (502, "brand  new ")], "doc_id bigint, text string")
    again = exact_dedup.DigestIndex(spark, index.path, buckets=4)  # as a later session opens it
    later = {r.doc_id: r for r in again.add(more).collect()}
    assert later[501].seen_before and not later[501].kept and later[501].keep_id == got[corpus()[10][0]].keep_id
    assert later[502].kept and not later[500].kept and later[500].keep_id == 502
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_of_a_batch_given_again(spark):
    rows = [(1, "a  b"), (1, "a b"), (2, "ab"), (None, "a b c d"), (None, "abcd"), (3, "x"), (3, "x"), (None, "x"), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    index = exact_dedup.DigestIndex(spark, buckets=4)

    def kept(batch, df=docs):
        # columns that are kept may have any name
        df = df.withColumns({"own": F.col("text"), "row": F.lit(7), "chars": F.lit("c"), "__row": F.lit(1)})
        found = index.add(df, "own", "row", "chars", "__row", batch=batch).collect()
        assert len(found) == df.count() and {(r.row, r.chars, r["__row"]) for r in found} == {(7, "c", 1)}
        return Counter((r.doc_id, r.own) for r in found if r.kept), {r.seen_before for r in found}

    first, seen = kept("one")
    assert seen == {False} and sum(first.values()) == 4  # one row of each group, the longest
    assert first[1, "a  b"] == first[None, "a b c d"] == first[3, "x"] == 1
    size = index.rows().count()
    assert kept("one") == (first, {False}) and index.rows().count() == size  # as after a lost driver
    assert kept("two") == (Counter(), {True})
    more = docs.union(spark.createDataFrame([(9, "new")], docs.schema))
    assert kept("three", more)[0] == Counter({(9, "new"): 1}) and index.rows().count() == size + 1
    assert kept("one") == (first, {False})
    with pytest.raises(ValueError, match="4 buckets"):
        exact_dedup.DigestIndex(spark, index.path, buckets=8)
