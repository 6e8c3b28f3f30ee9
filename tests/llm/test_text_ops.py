"""Toxicity, decontamination, PII, mixing, archive and URL lists against plain Python."""

import gzip
import itertools
import math
import random
import re
import time
import zlib
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from agrospark.llm import mixing, pii, toxicity, url_filters, warc
from agrospark.llm.common import scratch
from agrospark.llm.decontam import contaminated, decontaminate
from brute import collect, words


# ------------------------------------------------------------------ decontamination
@pytest.fixture(scope="module")
def items(spark, corpus):
    item = corpus[2]
    rows = [(7, item, "x"), (8, item, "x"), (70, " ".join(item.split()[5:20]), "x"), (9, "line that many documents share", "x"), (10, None, "x"), (11, "", "x"), (None, "tie text", "x"), (12, "!!!", "x")]
    return spark.createDataFrame(rows, "item_id long, text string, id string"), [r[:2] for r in rows]


def test_decontaminate(docs, corpus, items):
    rows, spans = decontaminate(docs, items[0])
    got = rows.select("id", "n_words", "n_hit", F.size("items").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("sha"), contaminated(rows).alias("c"))
    assert collect(got, *got.columns) == brute.decontam([(i, t) for i, t, _ in corpus[0]], items[1])
    assert spans.filter("first > last").count() == 0


@pytest.mark.parametrize("window,k", [(13, 13), (13, 1), (5, 3)])
def test_decontaminate_other_windows(docs, corpus, items, window, k):
    rows, _ = decontaminate(docs, items[0], window=window, k=k)
    got = [x[:3] for x in collect(rows, "id", "n_words", "n_hit")]
    assert got == sorted([x[:3] for x in brute.decontam([(i, t) for i, t, _ in corpus[0]], items[1], window)], key=repr)


def test_decontaminate_empty(docs, empty, items):
    assert decontaminate(empty, items[0])[0].count() == 0
    rows, _ = decontaminate(docs, items[0].limit(0))
    assert rows.filter("n_hit > 0 or size(items) > 0").count() == 0 and rows.count() == docs.count()


# ------------------------------------------------------------------ toxicity
def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    m = toxicity.Field(first=-1.0, step=np.array([-2.0, 0.7]))
    n, begins = 11, np.zeros(11, bool)
    begins[[0, 4]] = True
    odds = np.exp(rng.normal(0, 2, n))
    p = toxicity.forward_backward(m, odds, begins)[2]
    for a, b in ((0, 4), (4, 11)):
        total, per = 0.0, np.zeros(b - a)
        for ys in itertools.product((0, 1), repeat=b - a):
            v = math.exp(m.first) if ys[0] else 1.0
            for t, y in enumerate(ys):
                v *= odds[a + t] if y else 1.0
                if t:
                    v *= math.exp(m.step[ys[t - 1]]) if y else 1.0
            total += v
            per += v * np.array(ys)
        assert np.allclose(p[a:b], per / total, atol=1e-9)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(700):
        toxic = i % 5 == 0
        w = words(rng, rng.randint(5, 80), "aeiklmnorst").split()
        if toxic:
            for _ in range(rng.randint(1, 4)):
                w.insert(rng.randint(0, len(w)), rng.choice(["Vile!", "gross", "slur" + words(rng, 1, "aeo")]))
        rows.append((i, " ".join(w), "en", str(i % 3)))
        labels.append((i, 1, int(toxic), "x"))
    rows += [(900, None, "en", "0"), (901, "", "en", "0"), (None, "a vile text", "en", "0"), (902, "vile " * 3, "en", "0"), (902, "vile " * 3, "en", "0")]
    labels += [(None, 1, 1, "x"), (903, 0, None, "x"), (902, 1, 1, "x")]
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string, score string").repartition(4),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int, y string"), rows)


def test_toxicity_held_out(labelled):
    docs, labels, rows = labelled
    got = toxicity.toxicity(docs, labels).cache()
    assert got.count() == len(rows)
    for r in got.collect():
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (r["id"] is not None and zlib.crc32(str(r["id"]).encode()) % 4 == 2)
    test = [r for r in got.collect() if r["held_out"] and r["id"] < 700]
    assert np.mean([r["predicted"] == (r["id"] % 5 == 0) for r in test]) > 0.97
    by = {r["id"]: r for r in got.collect()}
    assert by[900]["predicted"] == by[901]["predicted"] == 0 and by[902]["predicted"] == 1 and by[None]["predicted"] == 1
    text = {i: t for i, t, *_ in rows}
    for r in got.collect():
        for s in r["spans"]:
            assert re.search("vile|gross|slur", text[r["id"]][s["start"]:s["end"]].lower())


def test_toxicity_scores_do_not_depend_on_id_or_label(labelled):
    docs, labels, _ = labelled
    m = toxicity.fit(docs, labels)
    a = {r["id"]: r["score"] for r in toxicity.score(docs, m).collect()}
    moved = docs.withColumn("doc_id", F.col("doc_id") + 10_000).withColumn("lang", F.lit("zz"))
    b = {r["id"]: r["score"] for r in toxicity.score(moved, m).collect()}
    assert all(b[i + 10_000] == s for i, s in a.items() if i is not None)


def test_toxicity_without_labels(labelled, spark):
    docs, labels, rows = labelled
    got = toxicity.toxicity(docs, labels.limit(0))
    assert got.count() == len(rows) and got.filter("predicted = 1").count() == 0
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    assert toxicity.toxicity(docs, labels.filter("toxic = 0")).filter("predicted = 1").count() == 0


def hashed(spark, texts):
    return {r["t"]: r["h"] for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("h")).collect()}


def trained(spark, texts):
    """The field fitted on (text, toxic) rows, none of them held out, and scores of some probes by text."""
    ids = [i for i in range(4 * len(texts) + 40) if zlib.crc32(str(i).encode()) % 4 != 2]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in zip(ids, texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in zip(ids, texts)], "doc_id long, toxic int")
    probes = spark.createDataFrame(list(enumerate(["here a blorg stands", "here a vile one stands", "here nothing stands"])), "doc_id long, text string")
    return [r["score"] >= 0.3 for r in toxicity.score(probes, toxicity.fit(docs, labels)).orderBy("id").collect()]


def test_toxicity_trains_on_late_documents(spark):
    rng = random.Random(2)
    clean = [(words(rng, 12_000, "aeiklmnorst"), 0) for _ in range(60)]
    early = [(words(rng, 20, "aeiklmnorst") + " vile", 1) for _ in range(20)]
    late = [t for t, h in hashed(spark, [words(rng, 20, "aeiklmnorst") + " blorg" for _ in range(60)]).items() if h > 1 << 62]
    assert len(late) >= 6 and sum(len(t.split()) for t, h in hashed(spark, [t for t, _ in clean]).items() if h < 1 << 62) > 300_000
    assert trained(spark, clean + early + [(t, 1) for t in late]) == [True, True, False]


@pytest.mark.parametrize("label", [0, 1])
def test_toxicity_with_a_very_long_first_text(spark, label):
    rng = random.Random(6)
    texts = [(words(rng, 20, "aeiklmnorst") + (" vile" if i % 2 else ""), i % 2) for i in range(120)]
    later = hashed(spark, [t for t, _ in texts])
    long_ = hashed(spark, [f"{'word ' * 320_000}{i}" + " vile" * label for i in range(24)])
    first = min(long_, key=long_.get)
    kept = [(t, y) for t, y in texts if later[t] > long_[first]]
    assert len(kept) > 90
    assert trained(spark, [(first, label), *kept]) == [False, True, False]


def test_toxicity_warns_when_a_class_has_no_text(labelled):
    docs, labels, _ = labelled
    for y, name in ((0, "clean"), (1, "toxic")):
        only = docs.join(labels.filter(f"toxic = {y}").select("doc_id"), "doc_id", "left_anti")
        with pytest.warns(UserWarning, match=f"no labelled {name} document"):
            m = toxicity.fit(only, labels)
        assert not len(m.keys) and not m.curve[1:].any() and 0.15 < 1 / (1 + math.exp(-m.curve[0])) < 0.25


# ------------------------------------------------------------------ mixing
def test_mix(docs, corpus):
    got = mixing.pareto_mix(docs, [1, 2, 3]).cache()
    rows = [r.asDict() for r in got.collect()]
    size = lambda t: len(re.findall("[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s in corpus[0]:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = brute.targets(sizes)
    assert len(rows) == len(corpus[0])
    assert sorted(((r["id"], r["size"]) for r in rows), key=repr) == sorted(((i, size(t)) for i, t, _ in corpus[0]), key=repr)
    for s, target in want.items():
        mine = [r for r in rows if r["source"] == s]
        assert all(abs(r["target"] - target) < 1e-6 * max(1, target) and r["source_size"] == sizes[s] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - target) <= max(r["size"] for r in mine)
    assert all(r["taken"] <= 3 * r["size"] and r["copies"] <= 3 for r in rows)
    again = mixing.pareto_mix(docs.repartition(3), [1, 2, 3])
    assert collect(again, "id", "size", "taken") == collect(got, "id", "size", "taken")


def test_mix_takes_low_pareto_ranks(docs):
    for s in ("s0", "s1", "s2"):
        rows = [r for r in mixing.pareto_mix(docs, [1, 2, 3]).filter(F.col("source") == s).withColumn("u", mixing.uniform(20, F.col("id"))).collect() if r["size"]]
        low = min(r["copies"] for r in rows)
        more = [r["u"] for r in rows if r["copies"] > low]
        assert not more or max(more) <= min([1.0, *[r["u"] for r in rows if r["copies"] == low]])


@pytest.mark.parametrize("sizes", [{"a": 100}, {"a": 1, "b": 1, "c": 1000}, {"a": 5, None: 5, "b": 0}, {f"s{i:02}": i * i for i in range(12)}, {"a": 10, "b": 1000, "c": 10, "d": 3}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, 1, n) for s, n in sizes.items()], "source string, n_docs long, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df, [1, 2, 3], 3).collect()}
    want = brute.targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_mix_weights_and_empty(docs, empty):
    assert mixing.pareto_mix(empty, [1, 2, 3]).count() == 0
    got = mixing.pareto_mix(docs.withColumn("v", F.when(F.col("doc_id") < 60, 2.0).otherwise(0.5)), [1, 1, 1, 1], weight_col="v")
    per = {r["heavy"]: r["m"] for r in got.filter("size > 0 and id < 120").groupBy((F.col("id") < 60).alias("heavy")).agg(F.avg("copies").alias("m")).collect()}
    assert per[True] > per[False]


# ------------------------------------------------------------------ archive
PAGES = [(5, "http://a.example/x", "<p>" + "same " * 40), (3, "http://b.example/", "<p>" + "same " * 40), (9, None, "<p>" + "same " * 40), (4, "u", "short"), (2, "u", "short"), (7, "u", None), (8, "u", ""),
         (11, "u\r\nX-Evil: 1", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 5), (12, "ü", "é😀" * 80), (12, "ü", "é😀" * 80), (None, "n", "é😀" * 80), (13, "long", "y" * 300_000)]


def read_warc(data):
    """(headers, payload) of each record."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        assert first == "WARC/1.1"
        head = dict(x.split(": ", 1) for x in lines)
        n = int(head["Content-Length"])
        yield head, data[end + 4:end + 4 + n]
        assert data[end + 4 + n:end + 8 + n] == b"\r\n\r\n"
        at = end + 8 + n


def test_archive_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, payload string, n_refs int")
    path = scratch(spark, "test-warc")
    warc.write_archive(pages, path)
    got = warc.read_archive(spark, path).cache()
    assert spark.read.parquet(f"{path}/payloads").count() == len({p[2] or "" for p in PAGES})             # bytes are stored once
    key = lambda x: (x[0] is None, x)
    want = []
    for i, _, html in PAGES:
        body = (html or "").encode()
        same = [p[0] for p in PAGES if (p[2] or "") == (html or "") and p[0] is not None]
        revisit = len(body) >= 100 and i != min(same)
        want.append((i, len(body), brute.sha(html or ""), "revisit" if revisit else "response", min(same) if revisit else None))
    rows = [tuple(r) for r in got.select("id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, want)) and got.filter("not verified").count() == 0
    assert {bytes(r["payload"]) for r in got.collect()} == {(p[2] or "").encode() for p in PAGES}
    warc.export_warc(got, f"file://{tmp_path}/out")
    records = [x for f in sorted((tmp_path / "out").glob("part-*.gz")) for x in read_warc(gzip.decompress(f.read_bytes()))]
    assert len(records) == len(PAGES)
    assert sorted(p for h, p in records if h["WARC-Type"] == "response") == sorted((p[2] or "").encode() for p, w in zip(PAGES, want) if w[3] == "response")
    assert key and all(p == b"" for h, p in records if h["WARC-Type"] == "revisit")


def test_archive_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive(pages).count() == 0


# ------------------------------------------------------------------ URL lists
def test_url_lists_as_of(spark):
    rng = random.Random(4)
    day = lambda n: date(2024, 1, 1) + timedelta(n)
    entries = ["d:example.com", "d:a.example.com", "u:a.example.com/x", "d:other.org", "u:other.org/p/q"]
    events = [(rng.choice(["spam", "adult", "ok"]), rng.choice(entries), day(rng.randint(0, 60)), rng.choice(["add", "remove", "ADD"])) for _ in range(150)]
    events += events[:5] + [(None, "d:x", day(1), "add"), ("spam", None, day(1), "add"), ("spam", "d:example.com", None, "add")]
    urls = ["http://a.example.com/x/y?q", "https://user@A.Example.com:8080/x", "http://b.example.com", "http://example.com./", "//other.org/p/q/r", "http://other.org/p/qq", "http://notexample.com/x", "junk", "", None]
    caps = [(i, rng.choice(urls), day(rng.randint(-3, 65)) if i % 17 else None) for i in range(300)] + [(1000 + i, urls[0], day(i % 60)) for i in range(200)]
    got = url_filters.evaluate(spark.createDataFrame([(*c, "z") for c in caps], "page_id long, url string, day date, entry string"),
                               spark.createDataFrame(events, "list string, entry string, day date, action string"), allow=["ok"])

    def active(lst, entry, at):
        on = False
        for d in sorted({e[2] for e in events if e[:2] == (lst, entry) and e[2] and e[2] <= at}):
            acts = {e[3].lower() for e in events if e[:3] == (lst, entry, d)}
            on = False if "remove" in acts else True
        return on

    def keys(url):
        m = re.match(r"(?:[a-z]+:)?//([^/?#]*)([^?#]*)", url or "")
        if not m:
            return []
        host = re.sub(r"\.$", "", re.sub(r":\d*$", "", m[1].split("@")[-1].lower()))
        labels, parts = host.split("."), m[2].rstrip("/").split("/")
        return ["d:" + ".".join(labels[i:]) for i in range(len(labels))] + ["u:" + host + "/".join(parts[:i + 1]) for i in range(len(parts))]

    want = []
    for i, url, at in caps:
        hits = {(lst, e) for e in keys(url) if at for lst in ("spam", "adult", "ok") if active(lst, e, at)}
        block, allow = sorted({x for x, _ in hits} - {"ok"}), sorted({x for x, _ in hits} & {"ok"})
        want.append((i, block, allow, sorted({e for _, e in hits}), "allow" if allow else "block" if block else "none"))
    assert collect(got, "id", "blocked_by", "allowed_by", "entries", "verdict") == sorted(want, key=repr)


def test_url_lists_empty(spark):
    caps = spark.createDataFrame([(1, "http://a.b/", date(2024, 1, 1))], "page_id long, url string, day date")
    none = spark.createDataFrame([], "list string, entry string, day date, action string")
    assert url_filters.evaluate(caps, none, allow=[]).first()["verdict"] == "none"
    assert url_filters.evaluate(caps.limit(0), none, allow=["ok"]).count() == 0


# ------------------------------------------------------------------ PII
def test_feistel_is_a_permutation():
    for n in (1, 2, 10, 97, 1000):
        p = pii.Permutation(b"k", "t", n)
        out = [p(x) for x in range(n)]
        assert sorted(out) == list(range(n)) and all(p.inverse(y) == x for x, y in enumerate(out))


def test_pseudonyms_keep_format_and_links(spark):
    card = "4111 1111 1111 1111"
    text = f"Card {card} or 4111-1111-1111-1111, not 4111 1111 1111 1112; born 1984-02-29, 31.12.1999, 12/31/1999; IP 93.184.216.34 and 10.0.0.1; IBAN DE89 3704 0044 0532 0130 00; call +1 (212) 555-0147; SSN 123-45-6789, 000-45-6789; mail Ann.Lee7@mail.example.com; 2023-02-30."
    rows = [(1, text), (2, f"again {card.replace(' ', '')} here"), (3, None), (4, ""), (5, "x" * 100_000 + " 1984-02-29"), (5, "x" * 100_000 + " 1984-02-29"), (None, "93.184.216.34")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, finds string")
    got = {r["id"]: r for r in pii.pseudonymise(df, b"key").collect()}
    one = got[1]
    kinds = sorted(f["kind"] for f in one["finds"])
    assert kinds == sorted(["card", "card", "date", "date", "date", "ip", "iban", "phone", "ssn", "email"])
    out = one["masked_text"]
    assert len(out) >= 100 and "4111 1111 1111 1112" in out and "10.0.0.1" in out and "000-45-6789" in out and "2023-02-30" in out and "@mail.example.com" in out
    for f in one["finds"]:
        old = text[f["start"]:f["stop"]]
        assert f["pseudonym"] != old and old not in out
        if f["kind"] != "ip":
            assert re.sub(r"\d", "9", f["pseudonym"]) == re.sub(r"\d", "9", old) or f["kind"] in ("email", "iban")
    cards = [re.sub(r"\D", "", f["pseudonym"]) for f in one["finds"] if f["kind"] == "card"]
    assert len(set(cards)) == 1 and pii.luhn_digit(cards[0][:-1]) == cards[0][-1] and cards[0] in got[2]["masked_text"]
    iban = next(f["pseudonym"] for f in one["finds"] if f["kind"] == "iban").replace(" ", "")
    assert pii.iban_rest(iban[:2], iban[2:4], iban[4:]) == 1
    dates = [f["pseudonym"] for f in one["finds"] if f["kind"] == "date"]
    iso, dots, us = date.fromisoformat(dates[0]), dates[1].split("."), dates[2].split("/")
    assert 1900 <= iso.year < 2100 and date(int(dots[2]), int(dots[1]), int(dots[0])) and date(int(us[2]), int(us[0]), int(us[1]))
    assert got[3]["masked_text"] is None and got[4]["masked_text"] == "" and got[5]["masked_text"].endswith(dates[0])
    assert pii.pseudonymise(df, b"other").filter("doc_id = 1" if False else "id = 1").first()["masked_text"] != out
    assert pii.pseudonymise(df.limit(0), b"key").count() == 0


def test_values_followed_or_preceded_by_digits_and_capitals():
    kinds = frozenset(pii.KINDS)
    card, iban = "4111 1111 1111 1111", "BE68 5390 0754 7034"
    for value, texts in {card: ["{} 123", "{} 50 EUR", "no. 12 {} 12", "{} 12/28", "20 {}", "AB12 {}", "{}-123", "000-45-6789 {}"],
                         card.replace(" ", ""): ["{} 12/28", "{} 123", "7 {} 99"], card.replace(" ", "-"): ["{}-123", "{} 123"],
                         "3782 822463 10005": ["{} 1234"],
                         iban: ["{} BIC", "{} OK", "{} BIC GKCCBEBB", "{} 1234 5678"], iban.replace(" ", ""): ["{} OK", "{}EUR"],
                         "+33 6 12 34 56 78": ["{}", "{} 12 rue", "Tel. {}."], "+33612345678": ["{}"], "+49 (30) 901820": ["{}"], "+34 612-345-678": ["{}, {}"]}.items():
        alone = pii.rewrite(value, b"key", kinds)[0]
        assert alone != value and re.sub(r"\d", "9", alone) == re.sub(r"\d", "9", value)
        for t in texts:
            old = t.replace("{}", value)
            new, finds = pii.rewrite(old, b"key", kinds)
            assert new == t.replace("{}", alone), old
            assert all(old[a:b] == value for _, a, b, _ in finds)
    for t in ("4111 1111 1111 1112", "DE89 3704 0044 0532 0130 01", "10.0.0.1", "2023-02-30", "000-45-6789", "+12", "x +1234"):
        assert pii.rewrite(t, b"key", kinds) == (t, [])
    assert pii.rewrite(f"{card} 12/28 {iban} OK", b"key", frozenset(["iban"]))[0].startswith(f"{card} 12/28 BE")


@pytest.mark.parametrize("text", ["x" * 1_000_000, "7" * 1_000_000, "qZ9+/" * 200_000, "a." * 500_000, "x" * 500_000 + "@"])
def test_pii_of_one_long_run_takes_linear_time(text):
    begin = time.process_time()
    assert pii.rewrite(text, b"key", frozenset(pii.KINDS)) == (text, [])
    assert time.process_time() - begin < 5


def test_pii_addresses_behind_other_values_and_short_ibans():
    kinds = frozenset(pii.KINDS)
    for before in ("1/2/2020", "192.168.1.1 ", "BE68 5390 0754 7034 ", "BE68 5390 0754 "):
        _, finds = pii.rewrite(before + "jane.roe@mail.example", b"key", kinds)
        assert [f[:1] + f[2:3] for f in finds if f[0] == "email"] == [("email", len(before) + 21)], before
    assert pii.rewrite("BE68 5390 0754", b"key", kinds)[1] == []
