"""Corpus pipeline: toxicity, exact dedup, SimHash near-dedup, benchmark decontamination, source mix.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps with their own columns (the last one
adds the mix's, as ``mix_...`` where a document column has the name). A stage's verdicts are joined back by a content key of the row. Null texts count as empty, empty
tables pass through, rows that repeat in every column are one document from exact dedup on, and other
columns than (doc_id, text) only ever travel along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrospark.llm.common import BROADCAST_ROWS, row_key, scratch, within, written
from agrospark.llm.decontam import contaminated, decontaminate
from agrospark.llm.exact_dedup import exact_dedup
from agrospark.llm.mixing import pareto_mix
from agrospark.llm.queries import snapshot_rule, table
from agrospark.llm.simhash import simhash_dedup
from agrospark.llm.toxicity import toxicity

TOXIC_FROM = 0.3
SHINGLE, MAX_BITS = 3, 2
WINDOW = 13
WEIGHTS, MAX_COPIES = [1, 2, 3], 3


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def _keyed(docs: DataFrame, cols: list[str]) -> tuple[DataFrame, list[str]]:
    """``docs`` with two key columns at the end, and their names (which no column of ``docs`` has)."""
    names = ["_k1", "_k2"]
    while {n.lower() for n in names} & {c.lower() for c in docs.columns}:
        names = [f"_{n}" for n in names]
    k1, k2 = row_key(*[F.col(f"`{c}`") for c in cols])
    return docs.select(*_columns(docs), k1.alias(names[0]), k2.alias(names[1])), names


def _without(docs: DataFrame, gone: DataFrame, cols: list[str]) -> DataFrame:
    """``docs`` but for the rows whose content key is in ``gone``."""
    rows, names = _keyed(docs, cols)
    gone = written(gone.select("_k1", "_k2").distinct().toDF(*names), "stage-gone")
    return within(rows, gone, names, anti=True).select(*_columns(docs))


def _once(docs: DataFrame, keys: DataFrame, cols: list[str]) -> DataFrame:
    """``docs`` with one row per content key; ``keys`` has the key of every row, so nothing moves unless one repeats."""
    rows, names = _keyed(docs, cols)
    twice = written(keys.groupBy("_k1", "_k2").count().filter("count > 1").select("_k1", "_k2").toDF(*names), "stage-twice")
    if not twice.limit(1).count():
        return docs
    single = within(rows, twice, names, anti=True)
    return single.unionByName(within(rows, twice, names).dropDuplicates(names)).select(*_columns(docs))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of at least TOXIC_FROM go."""
    got = toxicity(docs, table(spark, sf_dir, "labels"), threshold=TOXIC_FROM)
    return _without(docs, got.filter("predicted = 1"), ["doc_id", "text"])


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for blanks, the longest stays, then the smallest doc_id, then the smallest content key."""
    old = snapshot_rule(docs)
    got = written(exact_dedup(docs.filter(old), docs.filter(~old), key_cols=docs.columns), "stage-exact")
    return _once(_without(docs, got.filter("not kept"), docs.columns), got.filter("kept"), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the smallest doc_id stays."""
    got = written(simhash_dedup(docs, shingle=SHINGLE, max_bits=MAX_BITS), "stage-near")
    return _once(_without(docs, got.filter("not stays"), ["doc_id", "text"]), got.filter("stays"), ["doc_id", "text"])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least one word in 20 inside shared windows of benchmark items go."""
    rows, _ = decontaminate(docs, table(spark, sf_dir, "benchmark"), window=WINDOW)
    return _without(docs, rows.filter(contaminated(rows)), ["doc_id", "text"])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every taken document once, with ``copies`` (how often it is taken), ``size``, ``source_size``, ``target``
    and ``taken`` (words). Rows that share doc_id and text become one row with their copies added up."""
    got = written(pareto_mix(docs, weights=WEIGHTS, max_copies=MAX_COPIES), "stage-mix")
    mix = ["size", "source_size", "target", "copies", "taken"]
    rows, names = _keyed(_once(docs, got, ["doc_id", "text"]), ["doc_id", "text"])
    taken = got.groupBy("_k1", "_k2").agg(*[F.max(c).alias(c) for c in mix[:3]], *[F.sum(c).alias(c) for c in mix[3:]]).filter("copies > 0")
    used = {c.lower() for c in docs.columns}
    taken = written(taken.toDF(*names, *[f"mix_{c}" if c in used else c for c in mix]), "stage-taken")
    few = taken.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(taken) if few else taken, names).drop(*names)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("source_mix", mix_sources),
]

#: The first stage is a trained model, which SQL can't express; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
