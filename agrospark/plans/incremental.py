"""C6, D1-D4 as a store that is loaded day by day: a load rewrites only the blocks whose rows it changes.

A block is one region and calendar month. The store holds, each by generation (one per load):

* ``ranked``: per merge key and source the smallest values (the first step of the merge). Minima merge, so appended rows
  meet only the old rows of their own blocks;
* ``panel``: the finished rows of the blocks that the generation wrote;
* ``blocks``: one row per block: the digest of its raw rows, the digest of its merged rows, its summary (rows, first and last known
  value of each measure with their distances from the edges), the digest of what its gaps take from outside, and the generations that hold its rows;
* ``log``: one row per finished load, written last. What no logged generation names is invisible, so a load
  that broke off leaves the store as it was and is simply run again.

Interpolation reaches across blocks: a gap at a block's edge takes the nearest known value and its distance in rows. Summaries go up
a tree (month, year, region) and those carries come down again; the bottom row of the tree is one row per block, never the facts.
A block is rewritten if its merged rows changed or if a carry that one of its edge gaps uses did. The result equals a full build.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agrospark.operators import blocked as B
from agrospark.operators import clean as C
from agrospark.operators import fill as D
from agrospark.plans.panel import MERGE_KEYS
from agrospark.session import written

BLOCK = ["region", "block"]
MEASURES = [c for c in C.PANEL_NUMERIC if c not in MERGE_KEYS]
_DIGEST = "decimal(38,0)"


def _block(date: str = "date") -> Column:
    return F.trunc(date, "month").alias("block")


def _digests(*cols) -> list[Column]:
    """Sums of two hashes: equal for equal multisets of rows, and the digest of a union is the sum of the digests."""
    return [F.sum(F.xxhash64(F.lit(i), *cols).cast("decimal(20,0)")).cast(_DIGEST).alias(f"h{i}") for i in (1, 2)]


def raw_rows(obs: DataFrame, rank: str = "source_rank") -> DataFrame:
    """The rows that the merge sees: numeric measures, no null key; with their block."""
    df = C.coerce_numeric(C.normalize_names(obs), C.PANEL_NUMERIC)
    have = [c for c in MEASURES if c in df.columns]
    missing = [F.lit(None).cast("double").alias(c) for c in MEASURES if c not in have]
    known = F.col("region").isNotNull() & F.col("date").isNotNull() & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return df.filter(known).select(*MERGE_KEYS, F.col(rank).cast("int").alias("rank"), *have, *missing, _block()).select(*MERGE_KEYS, "rank", *MEASURES, "block")


def _ranked(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*MERGE_KEYS, "rank", "block").agg(*[F.min(c).alias(c) for c in MEASURES])


def _keyed(ranked: DataFrame, labels) -> DataFrame:
    """One row per region and day: the merge by rank, then the smallest location."""
    m = C.merge_by_rank(ranked, [*MERGE_KEYS, "block"], "rank", MEASURES, labels, "data_source")
    return C.dedup_first_in_series(m, "region", "date", ("latitude", "longitude"), by_key=True)


# ---- the tree of summaries ----

def summarise(keyed: DataFrame) -> DataFrame:
    """Per block: rows ``n``, digest, and for each measure ``s_<c>``: distance and value of its first and last known rows (null if none)."""
    at = Window.partitionBy(*BLOCK)
    d = keyed.withColumns({"_i": F.row_number().over(at.orderBy("date")), "_n": F.count("*").over(at)})
    aggs = []
    for c in MEASURES:
        known = F.when(F.col(c).isNotNull(), F.col("_i"))
        first, last = F.struct(F.min(known).alias("i"), F.min_by(c, known).alias("v")), F.struct(F.max(known).alias("i"), F.max_by(c, known).alias("v"))
        aggs.append(F.when(F.count(c) > 0, F.struct((first["i"] - 1).cast("long").alias("fd"), first["v"].alias("fv"),
                                                    (F.max("_n") - last["i"]).cast("long").alias("ld"), last["v"].alias("lv"))).alias(f"s_{c}"))
    return d.groupBy(*BLOCK).agg(F.count("*").alias("n"), *_digests("date", "latitude", "longitude", "data_source", *MEASURES), *aggs)


def _carry(s: DataFrame, part: list[str], order: str) -> DataFrame:
    """For each node (``n, s``), what its siblings offer: ``p`` the last known value before it and ``x`` the first after it, each with the rows
    between; and ``_off``, ``_after``: rows of earlier and later siblings."""
    before = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*part).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    s = s.withColumns({"_off": F.coalesce(F.sum("n").over(before), zero), "_after": F.coalesce(F.sum("n").over(after), zero)})
    p = F.last(F.when(F.col("s").isNotNull(), F.struct((F.col("_off") + F.col("n") - F.col("s.ld")).alias("at"), F.col("s.lv").alias("v"))), True).over(before)
    x = F.last(F.when(F.col("s").isNotNull(), F.struct((F.col("_after") + F.col("n") - F.col("s.fd")).alias("at"), F.col("s.fv").alias("v"))), True).over(after)
    s = s.withColumns({"p": p, "x": x})
    return s.withColumns({k: F.when(F.col(k).isNotNull(), F.struct((F.col(o) - F.col(f"{k}.at")).alias("d"), F.col(f"{k}.v").alias("v"))) for k, o in (("p", "_off"), ("x", "_after"))})


def _rollup(s: DataFrame, part: list[str], order: str) -> DataFrame:
    """The parents' summaries, from nodes with ``_off`` and ``_after``."""
    known = F.when(F.col("s").isNotNull(), F.col(order))
    got = s.groupBy(*part).agg(F.sum("n").alias("n"), F.min_by(F.struct((F.col("_off") + F.col("s.fd")).alias("d"), F.col("s.fv").alias("v")), known).alias("f"),
                               F.max_by(F.struct((F.col("_after") + F.col("s.ld")).alias("d"), F.col("s.lv").alias("v")), known).alias("l"))
    return got.select(*part, "n", F.when(F.col("f").isNotNull(), F.struct(F.col("f.d").alias("fd"), F.col("f.v").alias("fv"), F.col("l.d").alias("ld"), F.col("l.v").alias("lv"))).alias("s"))


def carries(blocks: DataFrame) -> DataFrame:
    """``region, block, e, carry``: ``e`` maps a measure to what the block's edge gaps take from outside (null where it has no such gap); ``carry`` is its digest.

    The tree has a row per block (or year, or region) and measure."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("m"), F.col(f"s_{c}").alias("s")) for c in MEASURES])).alias("x")
    leaf = blocks.select(*BLOCK, "n", each).select(*BLOCK, F.year("block").alias("year"), "n", "x.m", "x.s")
    leaf = written(_carry(leaf, ["region", "m", "year"], "block"))
    year = _carry(_rollup(leaf, ["region", "m", "year"], "block"), ["region", "m"], "year")
    root = written(_rollup(year, ["region", "m"], "year"))
    # a measure that a whole region lacks takes the first value of the next region that has one
    follow = None
    if root.filter("s is null").limit(1).count():
        flat = written(root.groupBy("region").agg(F.first("n").alias("n"), *[F.max(F.when(F.col("m") == c, F.col("s.fv"))).alias(c) for c in MEASURES]))
        edge = D._series_edges(flat, MEASURES, ["region"], ["n"], B.resolve(flat, None, "region"))
        follow = edge.select("region", F.explode(F.array(*[F.struct(F.lit(c).alias("m"), F.col(f"_next_{c}").alias("r")) for c in MEASURES])).alias("y")).select("region", "y.m", "y.r")
    j = leaf.join(year.select("region", "m", "year", F.col("p").alias("yp"), F.col("x").alias("yx")), ["region", "m", "year"])
    j = j.join(follow, ["region", "m"]) if follow is not None else j.withColumn("r", F.lit(None).cast("double"))
    up = lambda k, o: F.coalesce(k, F.when(F.col(f"y{k}").isNotNull(), F.struct((F.col(f"y{k}.d") + F.col(o)).alias("d"), F.col(f"y{k}.v").alias("v"))))
    p, x, s = up("p", "_off"), up("x", "_after"), F.col("s")
    # a gap at one edge also needs the value behind it: that one is inside unless the block knows none
    e = F.struct(F.when(s.isNull() | (F.col("s.fd") > 0), p).alias("p"), F.when(s.isNull() | (F.col("s.ld") > 0), x).alias("x"), F.when(s.isNull() & p.isNull() & x.isNull(), F.col("r")).alias("r"))
    e = j.select(*BLOCK, "m", e.alias("e"))
    # one row per measure: a block's list is as long as MEASURES
    got = e.groupBy(*BLOCK).agg(F.array_sort(F.collect_list(F.struct("m", "e"))).alias("list"))
    return got.select(*BLOCK, F.map_from_entries("list").alias("e"), F.xxhash64("list").alias("carry"))


def finish(keyed: DataFrame, carry: DataFrame) -> DataFrame:
    """Panel rows of whole blocks: positional interpolation with the carries, then the panel's row functions."""
    d = keyed.join(carry.drop("carry"), BLOCK)
    at = Window.partitionBy(*BLOCK)
    d = d.withColumns({"_i": F.row_number().over(at.orderBy("date")).cast("long"), "_n": F.count("*").over(at)})
    back = at.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    fwd = at.orderBy(F.col("date").desc()).rowsBetween(Window.unboundedPreceding, 0)
    i, out = F.col("_i"), {}
    for c in MEASURES:
        x, e = F.col(c), F.col("e")[c]
        known = F.when(x.isNotNull(), i)
        p_at, p_v = F.coalesce(F.max(known).over(back), -e["p"]["d"]), F.coalesce(F.last(x, True).over(back), e["p"]["v"])
        n_at, n_v = F.coalesce(F.min(known).over(fwd), F.col("_n") + 1 + e["x"]["d"]), F.coalesce(F.last(x, True).over(fwd), e["x"]["v"])
        inner = (n_v - p_v) / (n_at - p_at).cast("double") * (i - p_at).cast("double") + p_v
        out[c] = F.coalesce(x, F.when(p_at.isNotNull() & n_at.isNotNull(), inner), p_v, n_v, e["r"])
    d = d.withColumns(out)
    return C.repair_ssm(C.season4(C.calendar_parts(C.kelvin_to_celsius(d)))).select(*C.PANEL_COLUMNS, "block")


class PanelStore:
    """The panel under ``path`` (a folder that driver and executors share), loaded by one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, labels=None):
        from agrospark.sources.adapters import SOURCES
        self.spark, self.path, self.labels = spark, path.rstrip("/"), labels or SOURCES

    # -- reading --

    def log(self) -> DataFrame:
        """One row per finished load."""
        return self.spark.read.parquet(f"{self.path}/log")

    def generation(self) -> int:
        try:
            return int(self.log().agg(F.max("generation")).first()[0])
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0

    def blocks(self, generation: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/blocks/generation={self.generation() if generation is None else generation}")

    def _live(self, layer: str, blocks: DataFrame, only: DataFrame | None = None) -> DataFrame:
        """Rows of ``layer`` that ``blocks`` names (of the blocks in ``only``)."""
        rows = self.spark.read.option("basePath", f"{self.path}/{layer}").parquet(f"{self.path}/{layer}")
        keys = blocks.select(*BLOCK, F.col(f"{layer}_generation").alias("generation"))
        keys = keys if only is None else keys.join(only.select(*BLOCK), BLOCK, "left_semi")
        return rows.join(keys, [*BLOCK, "generation"], "left_semi").drop("generation")

    def panel(self, generation: int | None = None) -> DataFrame:
        """The clean panel as of a load, the last one if not given."""
        return self._live("panel", self.blocks(generation)).select(*C.PANEL_COLUMNS)

    # -- loading --

    def append(self, obs: DataFrame, rank: str = "source_rank") -> dict:
        """Load further raw rows, given without the earlier ones."""
        raw = raw_rows(obs, rank)
        new = written(raw.groupBy(*BLOCK).agg(F.count("*").alias("raw"), *_digests(*raw.drop("block").columns)))
        return self._load(raw, new, True)

    def refresh(self, obs: DataFrame, rank: str = "source_rank") -> dict:
        """Load the whole raw table as it is now: blocks whose raw digest is the stored one are not read beyond the digest, blocks that are gone go."""
        raw = raw_rows(obs, rank)
        new = written(raw.groupBy(*BLOCK).agg(F.count("*").alias("raw"), *_digests(*raw.drop("block").columns)))
        return self._load(raw, new, False)

    def _write(self, df: DataFrame, layer: str, generation: int) -> DataFrame:
        path = f"{self.path}/{layer}/generation={generation}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _load(self, raw: DataFrame, new: DataFrame, adds: bool) -> dict:
        g = self.generation()
        old = self.blocks(g) if g else None
        g += 1
        digest = F.struct("raw", "h1", "h2")
        if old is None:
            touched = new
        elif adds:                                # digests add up
            was = old.select(*BLOCK, *[F.col(f"raw_digest.{c}").alias(f"_{c}") for c in ("raw", "h1", "h2")])
            touched = new.join(was, BLOCK, "left").select(*BLOCK, *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).cast(t).alias(c) for c, t in (("raw", "long"), ("h1", _DIGEST), ("h2", _DIGEST))])
        else:
            same = old.select(*BLOCK, "raw_digest")
            touched = new.withColumn("raw_digest", digest).join(same, [*BLOCK, "raw_digest"], "left_anti").drop("raw_digest")
        touched = written(touched.withColumn("raw_digest", digest).drop("raw", "h1", "h2"))
        rows = raw.join(touched.select(*BLOCK), BLOCK, "left_semi")
        if old is not None and adds:
            before = self._live("ranked", old, touched)
            rows = before.select(*raw.columns).unionByName(rows)
        ranked = self._write(_ranked(rows).repartition(*BLOCK).sortWithinPartitions("region", "date"), "ranked", g)
        summary = summarise(_keyed(ranked, self.labels))
        state = summary.join(touched, BLOCK).withColumns({"digest": F.struct("h1", "h2"), "ranked_generation": F.lit(g)}).drop("h1", "h2")
        if old is not None:
            kept = old.join(touched.select(*BLOCK), BLOCK, "left_anti")
            if not adds:
                kept = kept.join(new.select(*BLOCK), BLOCK, "left_semi")
            state = state.unionByName(kept.drop("panel_generation", "carry"))
        state = written(state)
        carry = written(carries(state))
        now = state.join(carry.select(*BLOCK, "carry"), BLOCK)
        if old is None:
            judged = now.withColumns({"rows_changed": F.lit(True), "carry_changed": F.lit(False), "_was": F.lit(None).cast("int")})
        else:
            was = old.select(*BLOCK, F.col("digest").alias("_d"), F.col("carry").alias("_c"), F.col("panel_generation").alias("_was"))
            rows_differ = F.col("_was").isNull() | ~F.col("digest").eqNullSafe(F.col("_d"))
            judged = now.join(was, BLOCK, "left").withColumns({"rows_changed": rows_differ, "carry_changed": F.col("_was").isNotNull() & (F.col("carry") != F.col("_c"))}).drop("_d", "_c")
        rewrite = F.col("rows_changed") | F.col("carry_changed")
        judged = judged.withColumn("panel_generation", F.when(rewrite, F.lit(g)).otherwise(F.col("_was")).cast("int")).drop("_was")
        judged = written(judged)
        out = judged.filter(rewrite).select(*BLOCK)
        live = self._live("ranked", judged, out)
        done = finish(_keyed(live, self.labels), carry.join(out, BLOCK, "left_semi"))
        self._write(done.repartition(*BLOCK).sortWithinPartitions("region", "date"), "panel", g)
        self._write(judged.drop("rows_changed", "carry_changed"), "blocks", g)
        one = F.lit(1)
        report = judged.agg(F.lit(g).alias("generation"), F.count(one).alias("blocks"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"),
                            F.count(F.when(F.col("rows_changed"), one)).alias("blocks_changed"), F.count(F.when(F.col("carry_changed") & ~F.col("rows_changed"), one)).alias("blocks_carried"),
                            F.coalesce(F.sum(F.when(rewrite, F.col("n"))), F.lit(0)).cast("long").alias("rows_rewritten"))
        r = report.first().asDict()
        self.spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in r.items()]).coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        return r

    def compact(self) -> int:
        """Write all live rows into one new generation; older generations are then unnamed. Returns the generation."""
        g = self.generation() + 1
        blocks = self.blocks(g - 1)
        for layer in ("ranked", "panel"):
            self._write(self._live(layer, blocks).repartition(*BLOCK).sortWithinPartitions("region", "date"), layer, g)
        self._write(blocks.withColumns({"ranked_generation": F.lit(g), "panel_generation": F.lit(g)}), "blocks", g)
        r = blocks.agg(F.count("*").alias("blocks"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows")).first()
        row = {"generation": g, "blocks": r["blocks"], "rows": r["rows"], "blocks_changed": 0, "blocks_carried": 0, "rows_rewritten": r["rows"]}
        self.spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in row.items()]).coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        return g
