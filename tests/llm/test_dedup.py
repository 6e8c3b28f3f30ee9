"""Exact, line, near and substring dedup against plain Python, on a table with nulls, copies, ties and long texts."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from agrospark.llm import line_dedup as L
from agrospark.llm import simhash as S
from agrospark.llm import substring_dedup as U
from agrospark.llm.components import components
from agrospark.llm.exact_dedup import exact_dedup, fuse_build, fuse_contains
from agrospark.llm.queries import snapshot_rule
from brute import collect, words


def test_fuse_filter_has_no_false_negatives_and_few_false_positives():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 10, 1000, 70_000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        f = fuse_build(keys)
        assert fuse_contains(keys, *f).all()
        other = rng.integers(1 << 63, (1 << 64) - 1, 50_000, dtype=np.uint64)
        assert fuse_contains(other, *f).mean() < 0.02


def test_exact(docs, corpus):
    rule = snapshot_rule(docs)
    got = exact_dedup(docs.filter(rule), docs.filter(~rule)).cache()
    want = brute.exact([(i, t) for i, t, _ in corpus[0]])
    assert collect(got, "id", "keep_id", "group_size", "text_sha256") == want
    stays = got.filter("kept").select("text_sha256", "id").distinct()
    assert stays.count() == got.select("text_sha256").distinct().count()          # one per group; 511 is a repeated row
    assert got.filter("kept and not (id <=> keep_id)").count() == 0


@pytest.mark.parametrize("side", ["snapshot", "batch", "both"])
def test_exact_with_empty_sides(docs, empty, corpus, side):
    a, b = (empty if side in ("snapshot", "both") else docs), (empty if side in ("batch", "both") else docs)
    got = exact_dedup(a, b)
    want = brute.exact([(i, t) for i, t, _ in corpus[0]]) if side != "both" else []
    assert collect(got, "id", "keep_id", "group_size", "text_sha256") == want


def test_exact_weak_digest_is_told_apart(docs, empty, corpus):
    got = exact_dedup(docs, empty, digest=lambda c: F.lit("same"))
    assert [x[:3] for x in collect(got, "id", "keep_id", "group_size")] == sorted([x[:3] for x in brute.exact([(i, t) for i, t, _ in corpus[0]])], key=repr)


def test_lines(docs, corpus):
    got = L.line_dedup(docs).withColumn("sha", F.sha2("kept_text", 256))
    assert collect(got, "id", "n_lines", "n_dropped", "sha") == brute.lines([(i, t) for i, t, _ in corpus[0]])


def test_lines_without_heavy_keys(docs, corpus, monkeypatch):
    monkeypatch.setattr(L, "SHARES", 1)                                             # no key is heavy: all go through the range exchange
    got = L.line_dedup(docs).withColumn("sha", F.sha2("kept_text", 256))
    assert collect(got, "id", "n_lines", "n_dropped", "sha") == brute.lines([(i, t) for i, t, _ in corpus[0]])


def test_bitmaps_round_trip(spark):
    rows = [(n, sorted(set(d))) for n, d in [(1, [0]), (9, [8]), (300, [0, 1, 63, 64, 65, 299]), (5000, list(range(0, 5000, 3)))]]
    df = spark.createDataFrame(rows, "n int, dropped array<int>").withColumn("bitmap", L.pack_bits(F.col("dropped"))).withColumn("flags", L.keep_flags(F.col("bitmap"), F.col("n")))
    for r in df.collect():
        assert len(r["flags"]) == r["n"] and [i for i, x in enumerate(r["flags"]) if x == "0"] == r["dropped"]
        assert len(r["bitmap"]) <= r["n"] // 8 + 1


def test_lines_empty(empty):
    assert L.line_dedup(empty).count() == 0


@pytest.mark.parametrize("dense", [None, 1])
def test_near_pairs_equal_all_pairs(spark, dense):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 40, dtype=np.int64)
    fps = set(base.tolist())
    for b in base[:20]:
        for _ in range(12):
            flip = np.uint64(0)
            for bit in rng.choice(64, rng.integers(1, 4), replace=False):
                flip |= np.uint64(1) << np.uint64(bit)
            fps.add(int((np.uint64(b) ^ flip).view(np.int64)))
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for r, m in ((2, 2), (3, 2), (2, 3), (1, 2)):
        want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= r}
        got = [tuple(x) for x in S.near_pairs(df, r, m, dense).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_near_pairs_broadcast_no_probes(spark):
    """The probes are exploded from the fingerprints, so their size is misjudged: they must not be gathered on the driver, however small the table looks."""
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    fps = spark.range(300).select(F.xxhash64("id").alias("fp"))
    plan = S.near_pairs(fps, 2, 2)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    crowded = spark.range(100).select(F.col("id").alias("fp"))                       # one value in the upper segment: the search by balls
    plan = S.near_pairs(crowded, 2, 2, 5)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "BroadcastHashJoin" in x and "[b#" in x]


def test_simhash(docs, corpus):
    got = S.simhash_dedup(docs).cache()
    assert collect(got, "id", "fingerprint", "component_id") == brute.simhash([(i, t) for i, t, _ in corpus[0]])
    assert got.filter("stays").select("component_id").distinct().count() == got.select("component_id").distinct().count()


def test_simhash_empty(empty):
    assert S.simhash_dedup(empty).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1001 + i) for i in range(40)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[1000 + i] == 1000 for i in range(41))


def plain_hash(word):
    """The operator's word hash, over Python's integers: it only decides where sentences are cut."""
    m = (1 << 64) - 1
    h = sum((ord(c) + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, c in enumerate(word)) + len(word) & m
    h = (h ^ h >> 32) * 0xD6E8FEB86659FD93 & m
    return h ^ h >> 32


def plain_parts(text, window=8):
    """[(start, stop, words)] of a text, word by word."""
    def small(c):
        return c.lower() if ord(c) < 1 << 16 and len(c.lower()) == 1 else c

    def dense(c):
        return any(a <= ord(c) <= b for a, b in [*U._DENSE_RANGES, U._DENSE_PLANES])

    found, i = [], 0                                                                # [start, stop, word, sentence ends]
    while i < len(text):
        j = i + 1
        if not text[i].isspace():
            while j < len(text) and not dense(text[i]) and not text[j].isspace() and not dense(text[j]) and j - i < U.LONG:
                j += 1
            found.append([i, j, "".join(map(small, text[i:j])), text[j - 1] in ".!?。！？"])
        elif text[i] == "\n" and found:
            found[-1][3] = True
        i = j
    out, sentence = [], []
    for n, w in enumerate(found):
        sentence.append(w)
        if w[3] or n == len(found) - 1:
            hashes = [plain_hash(x[2]) for x in sentence]
            cuts = {m + min(range(window), key=lambda j: (hashes[m + j], j)) for m in range(len(sentence) - window + 1)} | {len(sentence) - 1}
            first = 0
            for c in sorted(cuts):
                out.append((sentence[first][0], [x[2] for x in sentence[first:c + 1]]))
                first = c + 1
            sentence = []
    begins = [0] + [a for a, _ in out[1:]] + [len(text)]
    return [(begins[i], begins[i + 1], ws) for i, (_, ws) in enumerate(out)]


def substring_brute(rows, run=2, min_words=12):
    """{row: set of removed code points} of distinct rows (order key, id, text), in order; runs are compared as words."""
    place = {}
    for d, (_, _, text) in enumerate(rows):
        parts = plain_parts(text or "")
        for i in range(len(parts)):
            for j in range(i + run, len(parts) + 1):
                ws = [w for p in parts[i:j] for w in p[2]]
                if len(ws) >= min_words:
                    place.setdefault(tuple(ws), []).append((d, parts[i][0], parts[j - 1][1]))
                    break
    cut = {}
    for spots in place.values():
        for d, a, b in sorted(spots)[1:]:
            cut.setdefault(rows[d], set()).update(range(a, b))
    return cut


@pytest.mark.parametrize("together", [U.TOGETHER, 2000])
def test_substring(docs, corpus, together):
    """All rows: null ids, ids with two texts, repeated rows; texts combined in one or many tables."""
    keyed = {(r["doc_id"], r["text"]): r["k"] for r in docs.select("doc_id", "text", U.text_key("doc_id", "text")).collect()}
    rows = [(k, i, t) for (i, t), k in keyed.items()]
    rows = [((r[1] is not None, r[1] or 0, r[0]), r[1], r[2]) for r in rows]
    rows.sort(key=lambda r: r[0])
    cut = substring_brute(rows)
    kept = {(i, t): "".join(c for j, c in enumerate(t or "") if j not in cut.get((o, i, t), ())) for o, i, t in rows}
    want = sorted(((i, kept[i, t]) for i, t, _ in corpus[0]), key=repr)
    assert cut and collect(U.substring_dedup(docs, together=together), "id", "kept_text") == want


def test_hot_runs_are_combined_before_the_shuffle(spark):
    """3000 copies give rows by tables of texts, not by copies; the first copy stays."""
    rng = random.Random(4)
    text = ". ".join(words(rng, 9) for _ in range(20)) + "."
    df = spark.createDataFrame([(i, text) for i in range(3000)], "doc_id long, text string").repartition(4)
    got = U.spans(df, 2, 12, "doc_id", "text").groupBy("later").count().collect()
    assert {r["later"]: r["count"] for r in got}[False] <= 8 * len(U.runs([text], 2, 12)[0])
    assert U.substring_dedup(df).filter("kept_text <> ''").collect()[0]["id"] == 0
    assert U.substring_dedup(df).filter("kept_text <> ''").count() == 1


def test_substring_passage_over_50_words(docs, corpus):
    passage = corpus[1]
    got = {r["id"]: r["kept_text"] for r in U.substring_dedup(docs).filter("id between 400 and 404").collect()}
    core = " ".join(passage.split()[10:50])
    assert core in got[400] and all(core not in got[i] for i in range(401, 405))
    whole = {i: t for i, t, _ in corpus[0] if i is not None and 400 <= i < 405}
    for i in range(401, 405):                                                       # the documents' own text stays
        assert got[i].startswith(whole[i][:40]) and got[i].endswith(whole[i][-40:])


def removed(first, second):
    """Code points of the second text that its runs share with the first one's."""
    doc, start, stop, h1, h2 = (x.tolist() for x in U.runs([first, "", second], 2, 12))
    known = {h for d, h in zip(doc, zip(h1, h2)) if d == 0}
    return {c for d, a, b, h in zip(doc, start, stop, zip(h1, h2)) if d == 2 and h in known for c in range(a, b)}


def test_substring_passages_mid_line():
    rng = random.Random(8)
    for i in range(600):
        n = rng.randint(50, 60)
        passage = words(rng, n) if i % 2 else f"{words(rng, 27)}. {words(rng, 27)}."
        lead, tail = words(rng, rng.randint(0, 30)), words(rng, rng.randint(0, 30))
        a, b = f"{lead} {passage} {tail}", f"{passage} {words(rng, 5)}" if i % 3 else f"{words(rng, 15)} {passage} {words(rng, 9)}"
        cut, at = removed(a, b), b.index(passage)
        core = range(at + len(" ".join(passage.split()[:15])) + 1, at + len(" ".join(passage.split()[:-15])))
        assert cut.issuperset(core)
        assert not [c for c in cut if c < at or c > at + len(passage)]
    dense = "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(60))
    assert removed(f"一二三{dense}四五", f"六{dense}七八九") >= set(range(16, 46))


def test_parts_cover_the_text():
    texts = ["", "one", "A b. C d!\n\nE f?  g", "  lead. \t.. x", "w " * 300, "\n\n", "日本語。テキスト x", "y" * 150_000 + " z", "İ \U00010400 ẞ."]
    doc, start, stop, _, _ = (x.tolist() for x in U.runs(texts, 1, 1))
    for d, t in enumerate(texts):
        assert [(a, b) for x, a, b in zip(doc, start, stop) if x == d] == [(a, b) for a, b, _ in plain_parts(t)]
        assert not t.strip() or "".join(t[a:b] for x, a, b in zip(doc, start, stop) if x == d) == t


def test_substring_empty(empty):
    assert U.substring_dedup(empty).count() == 0


def test_sha_of_normalised_text(docs):
    row = exact_dedup(docs.limit(0), docs.filter("doc_id = 501")).first()
    assert row["text_sha256"] == hashlib.sha256(b"").hexdigest()
