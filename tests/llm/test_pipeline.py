"""Every stage of the corpus pipeline against plain Python, on a small table with clashing column names."""

import os
import sys

import pytest
from pyspark.sql import functions as F

import brute

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline as P  # noqa: E402


@pytest.fixture(scope="module")
def sf_dir(spark, docs, corpus, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    ids = sorted({i for i, _, _ in corpus[0] if i is not None})
    labels = [(i, 1, int(i % 7 == 0 and i < 120)) for i in ids]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    item = corpus[2]
    spark.createDataFrame([(7, item), (8, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def rows(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_stages_are_in_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "decontamination", "source_mix"]


@pytest.mark.parametrize("stage", [f for _, f in P.STAGES], ids=[n for n, _ in P.STAGES])
def test_empty(spark, empty, sf_dir, stage):
    got = stage(spark, empty, sf_dir)
    assert got.count() == 0 and got.columns[:len(empty.columns)] == empty.columns


def test_toxicity_keeps_clean_rows(spark, docs, sf_dir):
    got = P.drop_toxic(spark, docs, sf_dir)
    assert got.columns == docs.columns and got.exceptAll(docs).count() == 0
    assert got.count() > 0.7 * docs.count()                       # the labels here follow no words


def test_exact(spark, docs, corpus, sf_dir):
    got = P.drop_exact_copies(spark, docs, sf_dir)
    assert got.columns == docs.columns and got.exceptAll(docs).count() == 0
    keep = {(k, sha) for _, k, _, sha in brute.exact([(i, t) for i, t, _ in corpus[0]])}
    assert sorted(((i, brute.sha(brute.BLANK.sub("", t or ""))) for i, t in rows(got)), key=repr) == sorted(keep, key=repr)


def test_near(spark, docs, corpus, sf_dir):
    ids = [i for i, _, _ in corpus[0]]
    one_text = [i for i in set(ids) if i is not None and ids.count(i) == 1]      # ids with several texts may name several components
    got = P.drop_near_copies(spark, docs.filter(F.col("doc_id").isin(one_text)), sf_dir)
    want = {c for _, _, c in brute.simhash([(i, t) for i, t, _ in corpus[0] if i in one_text])}
    assert sorted((i for i, _ in rows(got)), key=repr) == sorted(want, key=repr)


def test_contaminated(spark, docs, corpus, sf_dir):
    got = P.drop_contaminated(spark, docs, sf_dir)
    item = [(7, corpus[2]), (8, None)]
    want = sorted(((i, t) for i, t, _ in corpus[0] if not brute.decontam([(i, t)], item)[0][-1]), key=repr)
    assert rows(got) == want and len(want) < len(corpus[0])


def test_mix(spark, docs, sf_dir):
    once = docs.dropDuplicates(["doc_id", "text"])
    got = P.mix_sources(spark, once, sf_dir).cache()
    assert got.columns[:len(docs.columns)] == docs.columns and "mix_size" in got.columns and "copies" in got.columns
    assert got.filter("copies < 1 or copies > 3 or taken <> mix_size * copies").count() == 0
    for r in got.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("target"), F.max("mix_size").alias("m")).collect():
        assert abs(r["t"] - r["target"]) <= max(r["m"], 200)      # off by one document at most (the largest may be left out)


def test_repeated_rows_become_one(spark, docs, sf_dir):
    twice = docs.filter("doc_id = 511").union(docs.filter("doc_id = 511"))
    got = P.mix_sources(spark, twice, sf_dir)
    assert twice.count() == 4 and got.count() <= 1


def test_run_and_columns(spark, docs, sf_dir, tmp_path):
    docs.write.parquet(f"{sf_dir}/documents.parquet", mode="overwrite")
    got = P.run(spark, sf_dir)
    ids = [r["doc_id"] for r in got.collect()]
    assert got.columns[:len(docs.columns)] == docs.columns and len(ids) > 20
    assert 421 not in ids                                          # a piece of the benchmark item
    assert len([i for i in ids if i is not None and 200 <= i < 260]) <= 1      # a group of copies
