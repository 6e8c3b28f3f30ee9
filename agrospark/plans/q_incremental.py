"""Registered queries: the panel as a store that is loaded in steps."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from agrospark.functions.numeric import snap
from agrospark.operators import indices as H
from agrospark.operators.summaries import SummaryStore
from agrospark.plans.incremental import BLOCK, PanelStore
from agrospark.plans.panel_sql import dedup_sql, merged_sql, panel_ctes
from agrospark.plans.q_features import _drought_label_sql
from agrospark.plans.q_panel import panel
from agrospark.plans.registry import register
from agrospark.plans.sqlkit import snap as ssnap
from agrospark.session import checkpoint_dir
from agrospark.sources import adapters as A

#: days from which on rows come in the second load, and the source whose rows of the month before come late
CUT, LATE, LATE_FROM = "1998-01-01", 5, "1997-12-01"


def store(spark) -> PanelStore:
    return PanelStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/panel-store-{uuid.uuid4().hex}")


def loads(obs):
    """The raw rows of the first load and of the second: new days, and late rows of one source."""
    second = (F.col("date") >= F.lit(CUT).cast("date")) | ((F.col("source_rank") == LATE) & (F.col("date") >= F.lit(LATE_FROM).cast("date")))
    second = F.coalesce(second, F.lit(False))
    return obs.filter(~second), obs.filter(second)


def _loaded(spark, sf):
    s = store(spark)
    first, second = loads(A.obs(spark, sf))
    s.append(first)
    s.append(second)
    return s


@register("panel_incremental", f"{panel_ctes()} select * from panel")
def q_panel_incremental(spark, sf):
    """The panel after two loads; the SQL builds it at once."""
    return _loaded(spark, sf).panel()


@register("panel_incremental_blocks", f"""with merged as ({merged_sql()}), keyed as ({dedup_sql('merged')}),
b as (select region, date_trunc('month', date)::date as block, count(*) as n from keyed group by all),
r as (select region, date_trunc('month', date)::date as block, count(*) as raw_rows,
        count(*) filter (where date >= date '{CUT}' or (source_rank = {LATE} and date >= date '{LATE_FROM}')) as late_rows
      from ({A.OBS_SQL}) o group by all)
select region, cast(block as varchar) as block, n, raw_rows, late_rows > 0 as loaded_twice, 2 as loads from b join r using (region, block)""")
def q_panel_incremental_blocks(spark, sf):
    """Per block: merged rows, raw rows of both loads, and whether the second load had rows for it (the block's digests know)."""
    s = _loaded(spark, sf)
    was = s.blocks(1).select(*BLOCK, F.col("raw_digest").alias("was"))
    got = s.blocks().join(was, BLOCK, "left")
    return got.select("region", F.col("block").cast("string").alias("block"), "n", F.col("raw_digest.raw").alias("raw_rows"),
                      (~F.col("raw_digest").eqNullSafe(F.col("was"))).alias("loaded_twice"), F.lit(s.generation()).alias("loads"))


def summarised(spark, sf):
    """(label inputs of the whole panel, summaries of them after two loads: the days before CUT, then the others)."""
    rows = H.drought_inputs(panel(spark, sf))
    late = F.coalesce(F.col("date") >= F.lit(CUT).cast("date"), F.lit(False))
    s = SummaryStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/summaries-{uuid.uuid4().hex}", H.DROUGHT_SPEC, margin=0.05)
    s.append(rows.filter(~late))
    s.append(rows.filter(late))
    if s.drifted():
        s.rebracket(rows)
    return rows, s


_COLUMNS = list(H.DROUGHT_SPEC)


@register("summary_moments", f"""with {_drought_label_sql()[5:]},
m as ({' union all '.join(f"select '{c}' as column, count({c}) as n, {ssnap(f'avg({c})')} as mean, {ssnap(f'stddev_samp({c})')} as std, min({c}) as lo, max({c}) as hi from labelled" for c in _COLUMNS)})
select * from m""")
def q_summary_moments(spark, sf):
    """Moments merged from two loads' summaries."""
    _, s = summarised(spark, sf)
    return s.moments().select("column", "n", snap(F.col("mean")).alias("mean"), snap(F.col("std")).alias("std"), "lo", "hi")


@register("drought_label_summaries", f"""{_drought_label_sql()}
select region, date, drought_score, drought_class from labelled""")
def q_drought_label_summaries(spark, sf):
    """Drought labels from thresholds that two loads' summaries give; the SQL takes quantiles of all rows."""
    rows, s = summarised(spark, sf)
    got = H.drought_label(rows.drop("precip_sum_30"), thresholds=s.quantiles())
    return got.select("region", "date", "drought_score", "drought_class")
