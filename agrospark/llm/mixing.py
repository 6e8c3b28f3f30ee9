"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words. The wanted copies of a document are target / source
size (times its importance, if a weight column is given), at most ``max_copies``. The whole part of that
is taken for certain; the fraction p is its inclusion probability for one more copy. For that copy
documents are ranked by Q = (u / (1 - u)) / (p / (1 - p)), u a uniform number hashed from the
document, and the lowest ranks are taken until the source's remaining words are reached. The
document on the edge is taken if that brings the total nearer. The rank of the edge is found by two
levels of histograms over Q, so that no source is ever sorted in one task.

Defined results: null text has no words; a document without words is taken 0 times; a null source is a source of its own,
last in order; ties in Q fall to the smaller id, then to the text's hash; identical rows are ranked
one after the other; an empty table gives an empty mix; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrospark.llm.common import lookup, row_key, written

#: histogram cells per level; the edge cell of the second level holds about 1/BINS^2 of a source
BINS = 4096


def word_count(text: Column) -> Column:
    """Number of runs of [^\\x20\\x09-\\x0D]."""
    flat = F.coalesce(text, F.lit(""))
    for b in ("\t", "\n", "\x0b", "\x0c", "\r"):
        flat = F.replace(flat, F.lit(b), F.lit(" "))
    return F.size(F.filter(F.split(flat, " "), lambda w: w != "")).cast("long")


def uniform(seed: int, *cols: Column) -> Column:
    """A number in (0, 1) from the first 13 hex digits of an MD5: the same in every run and engine."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("~")) for c in cols])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: list[float], max_copies: float, share: float = 1.0) -> DataFrame:
    """``source, n_docs, source_size, target``: one row per source of ``sizes`` (source, n_docs, source_size).

    Sources in code point order, null last, weigh ``weights`` in turn. Targets are min(max_copies *
    size, weight * level), the level such that they add up to ``share`` of all words. With sources
    sorted by the level at which they are full, that level has a closed form over running sums.
    (Windows here run over one row per source, never over documents.)
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(max_copies)))
    every = Window.partitionBy(F.lit(0))
    upto = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(every) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(upto.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
    # the first source, in the order of filling up, that its level does not fill: the level holds for all after it
    place = F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source"))
    s = s.withColumn("level", F.min_by(F.when(F.col("open"), F.col("level")), place).over(every))
    return s.select("source", "n_docs", "source_size",
                    F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def _edge(cells: DataFrame, by: list[str], bin_col: str) -> DataFrame:
    """Per source, the cell in which the running words reach what is left to take, and the words before it."""
    w = Window.partitionBy(*by).orderBy(bin_col)
    run = cells.withColumn("upto", F.sum("words").over(w))
    return (run.filter((F.col("upto") - F.col("words") < F.col("need")) & (F.col("upto") >= F.col("need")))
            .withColumn("need", F.col("need") - (F.col("upto") - F.col("words"))))


def pareto_mix(docs: DataFrame, weights: list[float], max_copies: int = 3, share: float = 1.0, seed: int = 20,
               id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight_col: str | None = None) -> DataFrame:
    """One row per document: ``id, _k1, _k2, size, source, source_size, target, copies, taken``.

    ``weight_col`` (positive, null counts as 1) makes wanted copies unequal within a source; they are
    scaled so that their words still add up to the target before the limit of ``max_copies``.
    ``_k1, _k2`` are the content key of (id, text), for a join back to the rows. Of identical rows that the last rank
    cuts apart, as many extra copies as fit are shared: all of them are taken.
    """
    rel = F.coalesce(F.col(weight_col).cast("double"), F.lit(1.0)) if weight_col else F.lit(1.0)
    base = docs.select(F.col(id_col).alias("id"), *row_key(id_col, text_col), word_count(F.col(text_col)).alias("size"),
                       F.col(source_col).cast("string").alias("source"), rel.alias("rel"))
    base = written(base, "mix-sizes")
    totals = base.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"),
                                        F.sum(F.col("size") * F.col("rel")).alias("rel_size"))
    per_source = written(targets(totals.drop("rel_size"), weights, max_copies, share)
                         .join(totals.select(F.col("source").alias("s"), "rel_size"), F.col("source").eqNullSafe(F.col("s")))
                         .drop("s"), "mix-targets")
    want = F.least(F.lit(float(max_copies)), F.when(F.col("rel_size") > 0, F.col("target") / F.col("rel_size") * F.col("rel")).otherwise(0.0))
    whole = F.floor(F.col("want") + 1e-9)
    p = F.greatest(F.col("want") - F.col("whole"), F.lit(0.0))
    u = uniform(seed, F.col("id"))
    odds = (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))
    ranked = (lookup(base, per_source, ["source"], "n_docs", ["_k1"]).withColumn("want", want).withColumn("whole", whole.cast("long"))
              .withColumn("p", p).withColumn("q", F.when((F.col("p") > 0) & (F.col("size") > 0), odds))
              .withColumn("v", F.col("q") / (1 + F.col("q")) * BINS)
              .withColumn("b1", F.least(F.floor("v"), F.lit(BINS - 1)))
              .withColumn("b2", F.least(F.floor((F.col("v") - F.col("b1")) * BINS), F.lit(BINS - 1))))
    ranked = written(ranked.drop("v", "want", "rel"), "mix-ranks")
    key = F.col("source").eqNullSafe(F.col("e_source"))
    need = (ranked.groupBy("source", "target").agg(F.sum(F.col("whole") * F.col("size")).alias("sure"))
            .select(F.col("source").alias("e_source"), (F.col("target") - F.col("sure")).alias("need")))

    def cells(of: DataFrame, bin_col: str) -> DataFrame:
        return of.filter(F.col("q").isNotNull()).groupBy("source", bin_col).agg(F.sum("size").alias("words"))

    e1 = _edge(cells(ranked, "b1").join(need, key).filter("need > 0"), ["e_source"], "b1")
    e1 = written(e1.select("e_source", F.col("b1").alias("e_b1"), "need"), "mix-edge1")
    inside = ranked.join(F.broadcast(e1) if e1.count() < 10_000 else e1, key & (F.col("b1") == F.col("e_b1")))
    e2 = _edge(cells(inside, "b2").join(e1, key), ["e_source"], "b2")
    e2 = written(e2.select("e_source", F.col("b2").alias("e_b2"), "need"), "mix-edge2")
    # the few rows of the edge cell, one after the other
    last = (inside.drop("need", "e_source").join(e2, key & (F.col("b2") == F.col("e_b2")))
            .withColumn("upto", F.sum("size").over(Window.partitionBy("e_source").orderBy(
                "q", F.col("id").asc_nulls_last(), "_k1", "_k2").rowsBetween(Window.unboundedPreceding, 0)))
            .filter(F.col("upto") - F.col("size") / 2 <= F.col("need"))
            .groupBy("source", "id", "_k1", "_k2").agg(F.count("*").alias("edge")))
    last = written(last, "mix-last")
    bounds = written(need.withColumnRenamed("e_source", "n_source").alias("n").join(
        e1.drop("need").alias("a"), F.expr("n.n_source <=> a.e_source"), "left").join(
        e2.drop("need").alias("b"), F.expr("n.n_source <=> b.e_source"), "left").join(
        per_source.select("source", "n_docs").alias("c"), F.expr("n.n_source <=> c.source"))
        .select("source", "n_docs", "e_b1", "e_b2", F.col("need").alias("left_words")), "mix-bounds")
    got = lookup(ranked, bounds, ["source"], "n_docs", ["_k1"])
    before = F.coalesce(F.when(F.col("e_b1").isNull(), F.col("left_words") > 0)   # nothing to cut: all are taken
                        .otherwise((F.col("b1") < F.col("e_b1")) | (F.col("b1") == F.col("e_b1")) & (F.col("b2") < F.col("e_b2"))), F.lit(False))
    edge = last.select(F.col("id").alias("l_id"), F.col("_k1").alias("l_k1"), F.col("_k2").alias("l_k2"), "edge")
    edge = F.broadcast(edge) if last.count() < 100_000 else edge
    got = got.join(edge, F.col("id").eqNullSafe(F.col("l_id")) & (F.col("_k1") == F.col("l_k1")) & (F.col("_k2") == F.col("l_k2")), "left")
    extra = F.col("q").isNotNull() & (before | F.col("edge").isNotNull())
    copies = (F.col("whole") + F.when(extra, 1).otherwise(0)).cast("long")
    return (got.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0).cast("long")))
            .select("id", "_k1", "_k2", "size", "source", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))
