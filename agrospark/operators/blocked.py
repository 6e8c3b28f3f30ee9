"""Row-position blocked windows: per-series window semantics without one task per series.

A plain ``Window.partitionBy(region)`` puts a whole series in one task, so a region holding a
third of the rows becomes a third of the job on one core. Here a series is cut into blocks of
``block_rows`` consecutive positions, and the block (not the series) is the window partition:

1. positions: rows are counted per (series, calendar bucket) - a table of #series x #buckets
   rows - and a running sum over that small table gives each bucket's offset; a row's position
   is offset + its row number inside the bucket (bounded by the bucket length);
2. bounded frames (strict rolling n, lag k, lead k) copy the last / first ``halo`` rows of each
   block into its neighbour, evaluate inside blocks, and drop the copies; one pass, via explode;
3. unbounded carries (last wet day, last / next known value) come from a per-block summary, a
   window over that summary (#blocks rows per series), and an equi-join on (series, block).

Results equal the per-series windows exactly (see tests); the price is one aggregation and one
join of small tables plus halo duplication of (halo / block_rows) of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

POS, BLK, HALO = "_pos", "_blk", "_halo"


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``on`` where null equals null: series without a name and rows without a date stay."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in right.columns if c not in on])
    cond = None
    for c in on:
        eq = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        cond = eq if cond is None else cond & eq
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in on])


def _bucket(df: DataFrame, order: str, span_days: int) -> Column:
    dt = df.schema[order].dataType
    if isinstance(dt, T.DateType):
        days = F.unix_date(F.col(order))
    elif isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        days = F.floor(F.unix_micros(F.col(order).cast("timestamp")) / F.lit(86400 * 1000000))
    else:
        days = F.col(order)
    return F.floor(days / F.lit(span_days))


def positions(df: DataFrame, part: str = "region", order: str = "date", span_days: int = 31) -> DataFrame:
    """Adds the 1-based position of each row in its series (``order`` unique within a series)."""
    b = df.withColumn("_cb", _bucket(df, order, span_days))
    counts = b.groupBy(part, "_cb").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(part).orderBy("_cb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(part, "_cb", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    j = join_null_safe(b, offsets, [part, "_cb"], "inner")
    local = F.row_number().over(Window.partitionBy(part, "_cb").orderBy(order))
    return j.withColumn(POS, F.col("_off") + local).drop("_off", "_cb")


def with_blocks(df: DataFrame, block_rows: int, back: int = 0, fwd: int = 0) -> DataFrame:
    """Block id per row plus halo copies: the last ``back`` rows of a block are copied into the
    next block and the first ``fwd`` rows into the previous one (flagged ``_halo``)."""
    if back > block_rows or fwd > block_rows:
        raise ValueError("halo wider than a block")
    p0 = F.col(POS) - F.lit(1)
    blk = F.floor(p0 / F.lit(block_rows))
    r = p0 - blk * F.lit(block_rows)
    copies = F.array(
        F.struct(blk.alias("b"), F.lit(False).alias("h"), F.lit(True).alias("keep")),
        F.struct((blk + 1).alias("b"), F.lit(True).alias("h"),
                 ((F.lit(back) > 0) & (r >= F.lit(block_rows - back))).alias("keep")),
        F.struct((blk - 1).alias("b"), F.lit(True).alias("h"),
                 ((F.lit(fwd) > 0) & (r < F.lit(fwd)) & (blk > 0)).alias("keep")))
    e = df.withColumn("_c", F.explode(F.filter(copies, lambda s: s["keep"])))
    return e.withColumns({BLK: F.col("_c.b"), HALO: F.col("_c.h")}).drop("_c")


def _bw(part: str) -> Window:
    return Window.partitionBy(part, BLK).orderBy(POS)


def bounded(df: DataFrame, exprs, part: str = "region", order: str = "date", block_rows: int = 100000,
            back: int = 0, fwd: int = 0, positioned: bool = False) -> DataFrame:
    """Evaluate bounded-frame window columns per block. ``exprs(window)`` returns {name: Column}
    built on the given window spec (partitioned by series and block, ordered by position)."""
    positioned = positioned or POS in df.columns      # positions computed once upstream are reused
    d = df if positioned else positions(df, part, order)
    # a halo only reaches into the neighbouring block: blocks are at least as long as the frame
    d = with_blocks(d, max(block_rows, back, fwd), back, fwd)
    d = d.withColumns(exprs(_bw(part)))
    out = d.filter(~F.col(HALO)).drop(BLK, HALO)
    return out if positioned else out.drop(POS)


def ensure_positions(df: DataFrame, part: str = "region", order: str = "date") -> DataFrame:
    """Add ``_pos`` unless present: a chain of blocked operators then shares one position pass."""
    return df if POS in df.columns else positions(df, part, order)


def _block_carry(d: DataFrame, part: str, aggs: dict, windows: dict) -> DataFrame:
    """Per (series, block) summary -> window over the summary -> carries keyed by (series, block)."""
    s = d.groupBy(part, BLK).agg(*[v.alias(k) for k, v in aggs.items()])
    return s.select(part, BLK, *[v.alias(k) for k, v in windows.items()])


def dry_run(df: DataFrame, col: str = "total_precipitation_sum", threshold: float = 0.1,
            out: str = "consecutive_dry_days", part: str = "region", order: str = "date",
            block_rows: int = 100000) -> DataFrame:
    """Blocked ``consecutive_dry_days``: position - position of the last wet day (0 if none)."""
    had_pos = POS in df.columns
    d = ensure_positions(df, part, order)
    d = d.withColumn(BLK, F.floor((F.col(POS) - F.lit(1)) / F.lit(block_rows)))
    dry = F.coalesce(F.col(col) < F.lit(threshold), F.lit(False))
    d = d.withColumn("_dry", dry)
    wet_pos = F.when(~F.col("_dry"), F.col(POS))
    prev = Window.partitionBy(part).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    carry = _block_carry(d, part, {"_lw": F.max(wet_pos)}, {"_carry": F.max("_lw").over(prev)})
    run = _bw(part).rowsBetween(Window.unboundedPreceding, 0)
    j = join_null_safe(d, carry, [part, BLK])
    last_wet = F.coalesce(F.max(wet_pos).over(run), F.col("_carry"), F.lit(0))
    res = j.withColumn(out, F.when(F.col("_dry"), F.col(POS) - last_wet).otherwise(F.lit(0)).cast("int")) \
        .drop("_dry", "_carry", BLK)
    return res if had_pos else res.drop(POS)


def interpolate(df: DataFrame, cols: Sequence[str], part: str = "region", order: str = "date",
                block_rows: int = 100000) -> DataFrame:
    """Blocked positional interpolation (same result as ``fill.interpolate_linear``)."""
    d = positions(df, part, order)
    d = d.withColumn(BLK, F.floor((F.col(POS) - F.lit(1)) / F.lit(block_rows)))
    aggs, wins = {}, {}
    prev = Window.partitionBy(part).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    nxt = Window.partitionBy(part).orderBy(F.col(BLK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    for c in cols:
        known = F.when(F.col(c).isNotNull(), F.col(POS))
        aggs[f"_lp_{c}"] = F.max(known)
        aggs[f"_lv_{c}"] = F.max_by(F.col(c), known)
        aggs[f"_fp_{c}"] = F.min(known)
        aggs[f"_fv_{c}"] = F.min_by(F.col(c), known)
        # carry of the nearest earlier / later block that has a value
        wins[f"_cpp_{c}"] = F.max(f"_lp_{c}").over(prev)
        wins[f"_cpv_{c}"] = F.max_by(f"_lv_{c}", f"_lp_{c}").over(prev)
        wins[f"_cnp_{c}"] = F.min(f"_fp_{c}").over(nxt)
        wins[f"_cnv_{c}"] = F.min_by(f"_fv_{c}", f"_fp_{c}").over(nxt)
    carry = _block_carry(d, part, aggs, wins)
    j = join_null_safe(d, carry, [part, BLK])
    back = _bw(part).rowsBetween(Window.unboundedPreceding, 0)
    fwd = Window.partitionBy(part, BLK).orderBy(F.col(POS).desc()).rowsBetween(Window.unboundedPreceding, 0)
    pos = F.col(POS)
    out = {}
    for c in cols:
        x = F.col(c)
        known = F.when(x.isNotNull(), pos)
        p_rn = F.coalesce(F.max(known).over(back), F.col(f"_cpp_{c}"))
        p_v = F.coalesce(F.last(x, True).over(back), F.col(f"_cpv_{c}"))
        n_rn = F.coalesce(F.min(known).over(fwd), F.col(f"_cnp_{c}"))
        n_v = F.coalesce(F.last(x, True).over(fwd), F.col(f"_cnv_{c}"))
        inner = (n_v - p_v) / (n_rn - p_rn).cast("double") * (pos - p_rn).cast("double") + p_v
        out[c] = F.coalesce(x, F.when(p_rn.isNotNull() & n_rn.isNotNull(), inner), p_v, n_v)
    return j.withColumns(out).select(*df.columns)


def series_fills(df: DataFrame, cols: Sequence[str], part: str = "region", order: str = "date",
                 block_rows: int = 100000) -> DataFrame:
    """Adds ``_ff_<c>`` (last known value at or before the row within its series) and ``_bf_<c>``
    (first known value at or after it), evaluated per block with carries from neighbouring blocks.
    These are the in-series legs of ffill / bfill; table-order fills add the cross-series carry."""
    d = ensure_positions(df, part, order)
    d = d.withColumn(BLK, F.floor((F.col(POS) - F.lit(1)) / F.lit(block_rows)))
    aggs, wins = {}, {}
    prev = Window.partitionBy(part).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    nxt = Window.partitionBy(part).orderBy(F.col(BLK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    for c in cols:
        known = F.when(F.col(c).isNotNull(), F.col(POS))
        aggs[f"_lp_{c}"] = F.max(known)
        aggs[f"_lv_{c}"] = F.max_by(F.col(c), known)
        aggs[f"_fp_{c}"] = F.min(known)
        aggs[f"_fv_{c}"] = F.min_by(F.col(c), known)
        wins[f"_cpv_{c}"] = F.max_by(f"_lv_{c}", f"_lp_{c}").over(prev)
        wins[f"_cnv_{c}"] = F.min_by(f"_fv_{c}", f"_fp_{c}").over(nxt)
    carry = _block_carry(d, part, aggs, wins)
    j = join_null_safe(d, carry, [part, BLK])
    back = _bw(part).rowsBetween(Window.unboundedPreceding, 0)
    fwd = Window.partitionBy(part, BLK).orderBy(F.col(POS).desc()).rowsBetween(Window.unboundedPreceding, 0)
    out = {}
    for c in cols:
        out[f"_ff_{c}"] = F.coalesce(F.last(c, True).over(back), F.col(f"_cpv_{c}"))
        out[f"_bf_{c}"] = F.coalesce(F.last(c, True).over(fwd), F.col(f"_cnv_{c}"))
    return j.withColumns(out).select(*df.columns, *out.keys())


#: rows of the largest series from which per-series windows give way to blocks, and the rows of a block
HOT_SERIES_ROWS, BLOCK_ROWS = 2_000_000, 1_000_000
#: series from which a window over their summary is too much for one task
MANY_SERIES = 1_000_000
_CHOICE: dict = {}


def resolve(df: DataFrame, block_rows: int | None, part="region") -> int:
    """Rows per block, 0 for one window group per series. Both give the same result.

    An explicit ``block_rows`` holds; else the session's ``agrospark.window.blockRows``; else the largest series and the number of series are
    measured (one map-side combined count of the key column per plan and session): from HOT_SERIES_ROWS
    rows on, windows are evaluated in blocks, so that a hot series is spread over many tasks; from MANY_SERIES series on too, since
    blocked operators also spread the summary of the series.
    """
    if block_rows is not None:
        return block_rows
    conf = df.sparkSession.conf.get("agrospark.window.blockRows", None)
    if conf:
        return int(conf)
    if df.isStreaming:
        return 0
    part = [part] if isinstance(part, str) else list(part)
    key = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), *part)
    if key not in _CHOICE:
        largest, series = df.groupBy(*part).count().agg(F.max("count"), F.count(F.lit(1))).first()
        _CHOICE[key] = BLOCK_ROWS if (largest or 0) >= HOT_SERIES_ROWS or series >= MANY_SERIES else 0
    return _CHOICE[key]
