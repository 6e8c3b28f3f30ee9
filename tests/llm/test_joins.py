"""Spelling variants, Jaccard components and centroids against plain Python, on tables with nulls, copies, ties and long texts."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from agrospark.llm import centroids as C
from agrospark.llm import jaccard as J
from agrospark.llm import spelling as S
from brute import collect, lower, words

# ---- spelling ----


def vocabulary(docs, one_in=31):
    n = Counter()
    for i, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = lower(w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if one_in and h % one_in == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def variants(vocab):
    near = defaultdict(list)
    for a, b in combinations(vocab, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w in near:
        best = min(near[w], key=lambda x: (-vocab[x], x))
        if vocab[best] >= 10 * vocab[w]:
            form[w] = best
    out = []
    for w in vocab:
        root = w
        while root in form:
            root = form[root]
        out.append((w, vocab[w], len(near[w]), form.get(w), vocab.get(form.get(w)), root))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def spelled():
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(7, 10))) for _ in range(40)]
    rows = []
    for i in range(150):
        body = [rng.choice(base[:8] if rng.random() < 0.7 else base) for _ in range(rng.randint(1, 60))]
        for k, w in enumerate(body):
            if rng.random() < 0.15:
                at = rng.randrange(len(w))
                body[k] = w[:at] + rng.choice(["", "x", "ü" + w[at], "É"]) + w[at + 1:]
        rows.append((i, " ".join(body).title() if i % 5 else "|".join(body)))
    long = "xy" * 30_000
    rows += [(900, None), (901, ""), (None, "anonymous anonymous anonymouse"), (None, None), (902, f"{long} {long}a {long}"), (903, long + "a"), (904, "×÷×÷×÷×÷ ×÷×÷×÷×")]
    rows += [(920 + i, "changing " * 90 + "changingg " * 6 + "changinggg" * (i < 3)) for i in range(8)]                # a form of a form
    rows += [(905, "repeated repeatedd")] * 12 + [(906, "ßßßßßßß 東京 ßßßßßßß ßßßßßßßß ßßßßßßßß")]
    return rows


def _spelling(spark, rows, **k):
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, n int, word string").repartition(7)
    got, pairs = S.spelling_variants(S.vocabulary(docs), **k)
    return collect(got, "word", "n", "n_near", "form", "form_n", "root"), pairs


def test_spelling(spark, spelled):
    want = variants(vocabulary(spelled))
    got, pairs = _spelling(spark, spelled)
    assert got == want and sum(x[3] is not None for x in want) > 20 and any(x[5] != x[3] for x in want if x[3])
    assert pairs.filter("word = other").count() == 0
    assert 2 * pairs.count() == 2 * pairs.select(F.least("word", "other"), F.greatest("word", "other")).distinct().count() == sum(x[2] for x in want)


@pytest.mark.parametrize("levels", [(2, 3, 0), (1, 0), (0,)])
def test_spelling_with_crowded_forms(spark, spelled, levels):
    got, _ = _spelling(spark, spelled, levels=levels, crowd=1)
    assert got == variants(vocabulary(spelled))


def test_spelling_of_nothing(spark):
    assert _spelling(spark, [])[0] == [] and _spelling(spark, [(1, None), (2, "short words")])[0] == []


def test_neighbourhood_is_the_full_one(spelled):
    for w in ["abcabca", "aaaaaaa", "abé"]:
        for q in (3, 0):
            letters = sorted({"abcdé"[i] for i in range(5)}) if q else [chr(c) for c in S.LETTERS]
            edits = {w} | {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + x + w[i + 1:] for i in range(len(w)) for x in letters} | {w[:i] + x + w[i:] for i in range(len(w) + 1) for x in letters}
            have = set(np.concatenate([h for _, h in S.neighbours([w], q)]).tolist())
            assert set(S.forms(sorted(edits), q).tolist()) <= have
            if not q:
                assert len(have) == len(edits)


# ---- Jaccard ----

def gram_set(t):
    w = [x for x in re.split("[\x20\x09-\x0D]+", lower(t or "")) if x]
    return frozenset([" ".join(w)] if 0 < len(w) < 3 else [" ".join(w[i:i + 3]) for i in range(len(w) - 2)])


def jaccard(docs, share=90):
    sets = [gram_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(docs)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(docs):
        least[find(k)].append(i)
    return sorted([(i, len(sets[k]), min((x for x in least[find(k)] if x is not None), default=None)) for k, (i, _) in enumerate(docs)], key=repr)


def _near(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = words(rng, 1)
    return " ".join(w)


@pytest.fixture(scope="module")
def family():
    """Crowds of near copies around several centres, at distances on both sides of the limit, and chains of small steps."""
    rng = random.Random(11)
    rows, k = [], 1000
    for centre in range(3):
        base = words(rng, 120)
        for e in range(70):
            rows.append((k, _near(rng, base, e % 6)))
            k += 1
    chain = words(rng, 90)
    for _ in range(40):
        chain = _near(rng, chain, 1)
        rows.append((k, chain))
        k += 1
    shared = words(rng, 80)
    for _ in range(60):
        rows.append((k, words(rng, 30) + " " + shared))
        k += 1
    return rows


def _jaccard(spark, rows, **k):
    docs = spark.createDataFrame([(i, t, 1, "k", 2) for i, t in rows], "doc_id long, text string, n int, node string, _k1 int").repartition(5)
    got, _ = J.jaccard_components(docs, **k)
    return collect(got, "id", "n_shingles", "component_id")


def test_jaccard(docs, corpus):
    got, links = J.jaccard_components(docs)
    assert collect(got, "id", "n_shingles", "component_id") == jaccard([(i, t) for i, t, _ in corpus[0]])


def test_jaccard_recursion(spark, family):
    want = jaccard(family)
    assert len({c for _, _, c in want}) > 60
    assert _jaccard(spark, family, small=6, pivots=2, depth=3) == want


@pytest.mark.parametrize("options", [{"small": 10_000}, {"small": 2, "depth": 0}])
def test_jaccard_in_pairs_only(spark, family, options):
    assert _jaccard(spark, family, **options) == jaccard(family)


def test_jaccard_of_another_share(spark, family):
    assert _jaccard(spark, family, share=80, small=6, pivots=3, depth=2) == jaccard(family, 80)


def test_jaccard_of_nothing(spark):
    assert _jaccard(spark, []) == []
    assert _jaccard(spark, [(1, None), (2, " "), (3, None)]) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
    assert _jaccard(spark, [(5, "A b"), (4, "a  B"), (3, "a b c"), (None, "x"), (None, "x")]) == sorted([(5, 1, 4), (4, 1, 4), (3, 1, 3), (None, 1, None), (None, 1, None)], key=repr)


def test_members_outside_meet_all_others_once(spark):
    rows = spark.range(100).select(F.lit(1).cast("long").alias("region"), F.struct(F.col("id").alias("d1"), F.col("id").alias("d2")).alias("node"),
                                   F.lit(100).cast("long").alias("n"), F.lit(0).alias("pos"), F.when(F.col("id") < 40, F.col("id")).otherwise(-1).alias("label"), (F.col("id") < 40).alias("out"))
    got = sorted((r["a"]["d1"], r["b"]["d1"]) for r in J._apart(rows, 90, block=16).collect())
    assert got == sorted({(a, b) for a in range(40) for b in range(100) if a < b})


def test_shingles_of_long_words():
    import pyarrow as pa
    long = "y" * 3_000_000
    texts = [f"a {long} b c", f"a x{long[1:]} b c", "", None, "b c"]
    h, at = J.shingles(pa.array(texts), 3)
    assert at.tolist() == [0, 2, 4, 4, 4, 5] and len(set(h.tolist())) == 5


# ---- centroids ----

def kmeans(rows, k, rounds, seed="2"):
    v = [(i, [int(np.floor(256.0 * float(x))) for x in e]) for i, e in rows
         if e is not None and len(e) == 64 and all(x is not None and np.isfinite(x) for x in e)]
    first = sorted(v, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    cs = [r[1] for r in first]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [min((dist(x, c), n) for n, c in enumerate(cs)) for _, x in v]
    for _ in range(rounds):
        by = defaultdict(list)
        for (_, x), (_, n) in zip(v, assign()):
            by[n].append(x)
        cs = [[sum(c) // len(by[n]) for c in zip(*by[n])] if n in by else cs[n] for n in range(len(cs))]
    a = assign()
    per = Counter()
    for d, n in a:
        per[n] += d
    return sorted([(i, n, d, per[n], sum(per.values()), hashlib.sha256(",".join(map(str, cs[n])).encode()).hexdigest()) for (i, _), (d, n) in zip(v, a)], key=repr)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (6, 64))
    rows = [(i, (centres[i % 6] + rng.normal(0, 0.3, 64)).astype(np.float32).tolist()) for i in range(150)]
    rows += [(i, rows[3][1]) for i in range(200, 230)] + [(7, rows[7][1])] * 2 + [(None, rows[9][1])]
    rows += [(300, None), (301, []), (302, [0.0] * 63), (303, [0.0] * 63 + [None]), (304, [0.0] * 63 + [float("nan")]), (305, [float("inf")] + [0.0] * 63), (306, [0.0] * 64), (307, [-0.001] * 64)]
    return rows


def _centroids(spark, rows, k, rounds):
    df = spark.createDataFrame([(i, e, 1, "x") for i, e in rows], "vec_id long, embedding array<float>, cluster int, v string").repartition(4)
    got, c = C.centroid_clusters(df, k=k, rounds=rounds)
    return collect(got.withColumn("sha", C.digest_of(c)), "id", "cluster", "distance", "cluster_inertia", "inertia", "sha")


@pytest.mark.parametrize("k, rounds", [(12, 4), (500, 1), (1, 2), (12, 0)])
def test_centroids(spark, vectors, k, rounds):
    assert _centroids(spark, vectors, k, rounds) == kmeans(vectors, k, rounds)


def test_centroids_of_nothing(spark):
    assert _centroids(spark, [], 5, 2) == [] and _centroids(spark, [(1, None), (2, [1.0])], 5, 2) == []


def test_search_rejects_much_and_nothing_wrongly():
    rng = np.random.default_rng(8)
    c = rng.integers(-300, 300, (40, 64)) + rng.integers(-200, 200, (40, 1))
    x = c[rng.integers(0, 40, 3000)] + rng.integers(-40, 40, (3000, 64))
    x[:200] = c[rng.integers(0, 40, 200)]
    s = C.Search(np.vstack([c, c[:3]]))                                  # equal centroids: the smaller number wins
    who, d = s.nearest(x)
    full = ((x[:, None, :] - np.vstack([c, c[:3]])[None]) ** 2).sum(axis=2)
    assert (who == full.argmin(axis=1)).all() and (d == full.min(axis=1)).all()
    assert s.measured < 0.5 * len(x) * 43 and s.by_mean and s.by_deviation


def test_search_of_the_largest_integers():
    x = np.array([[C.LARGEST] * 64, [-C.LARGEST] * 64, [0] * 64, [C.LARGEST, -C.LARGEST] * 32], np.int64)
    who, d = C.Search(x).nearest(x)
    assert who.tolist() == [0, 1, 2, 3] and d.tolist() == [0] * 4
    who, d = C.Search(x[1:2]).nearest(x[:1])
    assert d[0] == 64 * (2 * C.LARGEST) ** 2
