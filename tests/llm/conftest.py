import random

import pytest

from brute import words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, n int, kept string, _k1 int, digest int, w int, h1 string, size string"


def make_docs():
    """(doc_id, text, source) with copies, near copies, nulls, blanks, ties, repeated rows, shared lines and long texts."""
    rng = random.Random(5)
    passage = words(rng, 60).capitalize() + "."
    item = words(rng, 30)
    rows = []
    for i in range(120):
        body = ". ".join(words(rng, rng.randint(3, 15)).capitalize() for _ in range(rng.randint(1, 12))) + "."
        rows.append((i, body, f"s{i % 4}"))
    rows += [(200 + i, rows[3][1].replace(" ", "  ") if i % 2 else rows[3][1], "s0") for i in range(60)]          # a third of all: copies
    near = words(rng, 400)
    rows += [(300 + i, near + f" tail{i}", "s1") for i in range(8)]
    rows += [(320 + i, f"{words(rng, 9)}.\nA line that many documents share, again\n{words(rng, 5)}.", "s2") for i in range(30)]
    rows += [(360 + i, f"  a LINE that many documents share, again\t\n\n{words(rng, 8)}", None) for i in range(3)]
    rows += [(400 + i, words(rng, 20) + ".\n" + passage + "\n" + words(rng, 20) + ".", "s3") for i in range(5)]
    rows += [(420, words(rng, 10) + " " + item + " " + words(rng, 10), "s3"), (421, " ".join(item.split()[4:25]), "s3"), (422, words(rng, 900) + " " + " ".join(item.split()[:13]), "s3")]
    rows += [(500, None, "s0"), (501, "", "s1"), (502, " \t\n ", None), (None, "no id at all here", "s2"), (None, None, None)]
    rows += [(510, "tie text", "s0"), (511, "tie text", "s0"), (511, "tie text", "s0"), (512, "tietext", "s0"), (510, "t ie text", "s0")]
    rows += [(600, words(rng, 30_000), "é"), (601, "日本語 テキスト 😀 " * 40, "é"), (602, "x" * 200_000, "z")]
    return rows, passage, item


@pytest.fixture(scope="session")
def corpus():
    return make_docs()


@pytest.fixture(scope="session")
def docs(spark, corpus):
    rows = [(i, t, None, s, None, "clash", 1, "no", 9, 8, None, "h", "big") for i, t, s in corpus[0]]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
