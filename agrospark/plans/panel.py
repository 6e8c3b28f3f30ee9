"""C6 build_panel: stacked sparse satellite rows -> clean daily (region, date) panel.

Plan shape: scan -> partial hash agg -> Exchange(keys, rank) -> hash agg -> Exchange(keys) ->
hash agg (the merge) -> Exchange(region) -> Sort(region, date, lat, lon) -> key dedup + all
interpolation windows -> join with the per-region edge summary -> projection. The merge
aggregations combine map-side, so a hot region/date key is reduced before it is shuffled.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame

from agrospark.operators import clean as C
from agrospark.operators import fill as D

MERGE_KEYS = ["region", "date", "latitude", "longitude"]
PANEL_MEASURES = [c for c in C.PANEL_NUMERIC if c not in ("latitude", "longitude")]


def merge_stage(obs: DataFrame, rank: str = "source_rank", labels=None, by_key: bool = False) -> DataFrame:
    """C2 + C3: coalescing merge per (region, date, lat, lon) by source priority (two hash
    aggregations), then one row per (region, date): the smallest (lat, lon), chosen inside the
    region partitioning that the interpolation windows use (no extra shuffle)."""
    from agrospark.sources.adapters import SOURCES
    df = C.normalize_names(obs)
    df = C.coerce_numeric(df, C.PANEL_NUMERIC)
    value_cols = [c for c in C.PANEL_NUMERIC if c in df.columns and c not in MERGE_KEYS]
    merged = C.merge_by_rank(df, MERGE_KEYS, rank, value_cols, labels or SOURCES, "data_source")
    return C.dedup_first_in_series(merged, "region", "date", ("latitude", "longitude"), by_key=by_key)


def build_panel(obs: DataFrame, rank: str = "source_rank", labels=None, block_rows: int | None = None) -> DataFrame:
    """``block_rows`` (see ``blocked.resolve``; decided by the largest region if not given): row-block evaluation of
    the per-region steps (dedup per (region, date), blocked interpolation); same result."""
    from agrospark.operators.blocked import resolve
    block_rows = resolve(obs, block_rows)
    df = merge_stage(obs, rank, labels, by_key=bool(block_rows))
    num = [c for c in C.PANEL_NUMERIC if c in df.columns]
    if block_rows:
        # the blocked steps (positions, block carries, edges) each consume the merged frame: cut
        # lineage once with a reliable checkpoint in the shared folder, so the raw scan and the
        # merge run once and a lost executor does not replay them
        from agrospark.session import cut_lineage
        df = cut_lineage(df)
    keyed = df
    df = D.interpolate_linear(keyed, num, "region", "date", block_rows=block_rows)
    # interpolation keeps each region's first/last known values: take the edge summary from the
    # keyed frame, so the interpolation windows run once
    df = D.fallback_fill(df, num, "region", "date", edges_from=keyed, series_complete=True, block_rows=block_rows)
    df = C.kelvin_to_celsius(df)
    df = C.calendar_parts(df)
    df = C.season4(df)
    df = C.repair_ssm(df)
    return C.project_known(df, C.PANEL_COLUMNS)


def source_version(spark, sf_dir: str, table: str = "lineitem") -> tuple:
    """Identifies the data behind a folder: its path and a digest of its files' names, sizes and times (metadata only)."""
    import os

    from pyspark.sql import functions as F
    path = f"{sf_dir.split('/#')[0].rstrip('/')}/{table}.parquet"
    files = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    r = files.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*files.columns).cast("decimal(20,0)")).alias("h")).first()
    return (os.path.abspath(sf_dir), r["n"], int(r["h"] or 0))


_TABLES: dict = {}
_LOCK = threading.Lock()      # queries run from several threads write a table once


def materialize(spark, key: str, build, buckets: int | None = None, name: str = "panel", sized: DataFrame | None = None):
    """Write ``build()`` once per session and key, bucketed by region and sorted by (region, date),
    under the shared checkpoint folder, and return it as a table.

    This is the ETL's "load" step: downstream feature, label and scoring jobs read the clean
    table instead of recomputing the merge / interpolation plan in every branch. A written table
    also cuts lineage: losing an executor later does not replay the ETL. Because the table is
    bucketed by region, windows partitioned by region read it without a shuffle. ``sized``: the raw rows; if
    their largest region is hot (``blocked.resolve``), the table is dealt by region and month instead.
    """
    ident = (spark.sparkContext.applicationId, name, *source_version(spark, key))   # new or changed files: a new table
    with _LOCK:
        return spark.table(_materialize_locked(spark, ident, build, buckets, name, sized))


def _materialize_locked(spark, ident, build, buckets, name, sized):
    import hashlib

    from agrospark.session import checkpoint_dir
    table = _TABLES.get(ident)
    if table is None or not spark.catalog.tableExists(table):
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        digest = hashlib.sha1(repr(ident).encode()).hexdigest()[:12]
        table = f"agrospark_{name}_{digest}"
        path = f"{checkpoint_dir(spark).rstrip('/')}/{table}"
        df = build()
        from pyspark.sql import functions as F

        from agrospark.operators.blocked import resolve
        if sized is not None and resolve(sized, None):
            # a hot region: windows run in blocks, so rows are dealt by region and month and no file holds a whole region
            df.repartition(buckets, "region", F.trunc("date", "month")).write.mode("overwrite").option("path", path).saveAsTable(table)
            _TABLES[ident] = table
            return table
        (df.repartition(buckets, "region").write.mode("overwrite").bucketBy(buckets, "region")
         .sortBy("region", "date").option("path", path).saveAsTable(table))
        _TABLES[ident] = table
    return table
