"""Global statistics broadcast back to the facts.

A global statistic is a one-row DataFrame: broadcasting it is size-safe by construction, and all
moments of all columns come from a single aggregation pass.

Quantiles: ``method="rank"`` (default) is exact. Each order statistic is bracketed by two approximate
quantiles, the rows below the bracket are counted exactly, the counts show whether it holds the wanted ranks (else it
is widened), and a bracket with too many distinct values is bracketed again. Only the distinct values of
the final bracket, with their counts, are sorted: at most ``limit`` rows per quantile. Nothing is shuffled but
sketches, counts and those few rows, and nothing depends on how rows fall into partitions. The value columns are
written once to the shared checkpoint folder, so the input is evaluated once.
``method="agg"`` uses Spark's exact ``percentile`` aggregate (simple, but its final merge holds every distinct
value in one task); ``method="approx"`` uses ``percentile_approx`` (bounded memory, approximate).
All use linear interpolation between order statistics (pandas' default).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agrospark.session import cut_lineage


def index_stats(df: DataFrame, cols) -> DataFrame:
    """One row: mean, sample std and max of every column."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"), F.max(c).alias(f"{c}_max")]
    return df.agg(*aggs)


def qname(col: str, q: float) -> str:
    return f"{col}_q{int(round(q * 100)):02d}"


def threshold_quantiles(df: DataFrame, spec: dict[str, list[float]], method: str = "rank",
                        slices: int | None = None, accuracy: int = 100000, tie_cols=None, stored: bool = False) -> DataFrame:
    """One row with a column ``{col}_q{pp}`` per requested quantile (nulls and NaN skipped).
    ``stored``: ``df`` is a table or cheap to evaluate again, so no copy of its columns is made (``method="rank"``).
    ``slices`` and ``tie_cols`` are accepted for older callers; the result never depended on them and needs neither now."""
    if method == "agg":
        return df.agg(*[F.expr(f"percentile(`{c}`, {q})").alias(qname(c, q)) for c, qs in spec.items() for q in qs])
    if method == "approx":
        return df.agg(*[F.percentile_approx(c, q, accuracy).alias(qname(c, q)) for c, qs in spec.items() for q in qs])
    return exact_quantiles(df, spec, stored=stored)


@dataclass
class _Rank:
    """One wanted quantile: ranks ``lo`` and ``hi`` (0-based) lie in [a, b], which has ``below`` smaller values."""

    col: str
    q: float
    n: int = 0
    a: float = float("-inf")
    b: float = float("inf")
    below: int = 0
    inside: int = 0
    slack: float = 0.0
    open: bool = True

    @property
    def pos(self) -> float:
        return self.q * (self.n - 1)

    @property
    def lo(self) -> int:
        return math.floor(self.pos)

    @property
    def hi(self) -> int:
        return math.ceil(self.pos)


def _take(data: DataFrame, ranks: list[_Rank], edges: list, limit: int) -> None:
    """Exact counts around the proposed brackets; those that hold the ranks are taken, others are widened next time."""
    counts = data.agg(*[x for i, (r, (a, b)) in enumerate(zip(ranks, edges)) for x in (
        F.count(F.when(F.col(r.col) < a, 1)).alias(f"below{i}"), F.count(F.when(F.col(r.col).between(a, b), 1)).alias(f"in{i}"),
        F.approx_count_distinct(F.when(F.col(r.col).between(a, b), F.col(r.col))).alias(f"kinds{i}"))]).first()
    for i, (r, (a, b)) in enumerate(zip(ranks, edges)):
        below, rows = counts[f"below{i}"], counts[f"in{i}"]
        if not (below <= r.lo and r.hi < below + rows):
            r.slack *= 4                                     # the sketch missed the ranks: a wider bracket
            continue
        shrunk = rows < r.inside
        r.a, r.b, r.below, r.inside = a, b, below, rows
        r.open = counts[f"kinds{i}"] > limit and shrunk


def _narrow_brackets(data: DataFrame, ranks: list[_Rank], limit: int, accuracy: int) -> None:
    """A further round: approximate quantiles inside each open bracket, then exact counts around them."""
    todo = [r for r in ranks if r.open]
    inside = lambda r: F.when(F.col(r.col).between(r.a, r.b), F.col(r.col))
    share = lambda r, rank: min(1.0, max(0.0, (rank - r.below) / r.inside))
    found = data.agg(*[F.percentile_approx(inside(r), F.array(F.lit(max(0.0, share(r, r.lo) - r.slack)), F.lit(min(1.0, share(r, r.hi + 1) + r.slack))),
                                           accuracy).alias(f"e{i}") for i, r in enumerate(todo)]).first()
    _take(data, todo, [found[f"e{i}"] for i in range(len(todo))], limit)


#: share of the rows to either side of a quantile in its first bracket
FIRST_SLACK = 0.002


def exact_quantiles(df: DataFrame, spec: dict[str, list[float]], limit: int = 100_000, accuracy: int = 10_000, stored: bool = False) -> DataFrame:
    """The first pass counts and sketches at once; a second one counts around the brackets; where a bracket misses or holds over ``limit`` distinct
    values, further rounds follow. ``stored``: read ``df`` itself each time instead of a copy of its columns."""
    spark = df.sparkSession
    value = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    data = df.select(*[value(c).alias(c) for c in spec])
    data = data if stored else cut_lineage(data)
    wanted = [(c, q) for c, qs in spec.items() for q in qs]
    first = data.agg(*[F.count(c).alias(f"n_{c}") for c in spec], *[F.percentile_approx(c, F.array(F.lit(max(0.0, q - FIRST_SLACK)), F.lit(min(1.0, q + FIRST_SLACK))), accuracy).alias(f"e{i}")
                                                                     for i, (c, q) in enumerate(wanted)]).first()
    ranks = [_Rank(c, q, first[f"n_{c}"], inside=first[f"n_{c}"], slack=FIRST_SLACK) for c, q in wanted]
    some = [r for r in ranks if r.n]
    if some:
        _take(data, some, [first[f"e{i}"] for i, r in enumerate(ranks) if r.n], limit)
    while any(r.open for r in some):
        _narrow_brackets(data, some, limit, accuracy)
    got = {}
    if some:
        # distinct values of the brackets with their counts; ranks by a running sum over them
        hits = F.filter(F.array(*[F.struct(F.lit(i).alias("i"), F.col(r.col).alias("v"), F.col(r.col).between(r.a, r.b).alias("ok"))
                                  for i, r in enumerate(some)]), lambda x: x["ok"])
        cells = data.select(F.explode(hits).alias("x")).groupBy("x.i", "x.v").agg(F.count(F.lit(1)).alias("c"))
        upto = F.sum("c").over(Window.partitionBy("i").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
        wanted = F.create_map(*[x for i, r in enumerate(some) for x in (F.lit(i), F.struct(F.lit(r.lo - r.below).alias("lo"), F.lit(r.hi - r.below).alias("hi")))])[F.col("i")]
        ranked = cells.withColumn("to", upto).withColumn("from", F.col("to") - F.col("c")).withColumn("w", wanted)
        holds = lambda k: (F.col("from") <= F.col(f"w.{k}")) & (F.col(f"w.{k}") < F.col("to"))
        rows = ranked.filter(holds("lo") | holds("hi")).select("i", "v", holds("lo").alias("lo"), holds("hi").alias("hi")).collect()  # two per quantile
        for i, r in enumerate(some):
            vlo = next(x["v"] for x in rows if x["i"] == i and x["lo"])
            vhi = next(x["v"] for x in rows if x["i"] == i and x["hi"])
            got[qname(r.col, r.q)] = vlo + (r.pos - r.lo) * (vhi - vlo)
    names = [qname(r.col, r.q) for r in ranks]
    return spark.createDataFrame([tuple(got.get(x) for x in names)], ", ".join(f"`{x}` double" for x in names))


def with_stats(df: DataFrame, stats_row: DataFrame) -> DataFrame:
    """Attach a one-row statistics frame to every row (broadcast nested-loop of 1 row)."""
    return df.crossJoin(F.broadcast(stats_row))


def zscore(x, mean, std):
    """(x - mean) / std; a zero or null std gives null (no division error under ANSI)."""
    return F.when(std != F.lit(0.0), (x - mean) / std)
