"""Helpers shared by the training-data operators.

* ``written``   cuts lineage with a parquet table under the shared ``spark.checkpoint.dir``.
* ``lookup``    joins rows with a one-row-per-key table although one key may hold a third of the rows.
* ``within``    semi-join with a key set: broadcast when its measured size allows, shuffled beyond.
* ``row_key``   128-bit content key of a row: a pure function of its values, so it survives
  recomputation after a lost executor (unlike ids that depend on partitions).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agrospark.session import checkpoint_dir

#: keys holding more than 1/SHARES of all rows are heavy; there are fewer than SHARES of them
SHARES = 1000
#: largest key set that is broadcast (two longs a row); larger sets are joined by a shuffle
BROADCAST_ROWS = 1_000_000


#: rows per Arrow batch where the session keeps Spark's default: whole texts are long, and a batch is held on both sides
ARROW_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application, and keep Arrow batches of texts small."""
    sc = spark.sparkContext
    name, default, fewer = ARROW_ROWS
    if spark.conf.get(name, default) == default:
        spark.conf.set(name, fewer)
    if getattr(sc, "_agrospark_shipped", False):
        return
    base = os.path.join(tempfile.mkdtemp(prefix="agrospark-ship-"), "agrospark_package")   # on the driver; addPyFile copies it to executors
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    with zipfile.ZipFile(f"{base}.zip", "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "agrospark")):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), root))
    sc.addPyFile(f"{base}.zip")
    sc._agrospark_shipped = True


def scratch(spark: SparkSession, name: str) -> str:
    """A new path for a written table in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (lineage cut that outlives executors)."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(*cols) -> list[Column]:
    """Two longs that identify a row by its content (128 bits): columns ``_k1`` and ``_k2``.

    A null is told from an empty string: each column enters with its own null flag.
    """
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    flags = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in cs])
    return [F.xxhash64(flags, *cs).alias("_k1"), F.xxhash64(F.lit(7), flags, *cs).alias("_k2")]


def hash128(col: Column, a: str, b: str) -> list[Column]:
    return [F.xxhash64(col).alias(a), F.xxhash64(F.lit(7), col).alias(b)]


def same(left: DataFrame, right: DataFrame, pairs) -> Column:
    """Null-safe equality over (left name, right name) pairs."""
    cond = None
    for a, b in pairs:
        c = left[a].eqNullSafe(right[b])
        cond = c if cond is None else cond & c
    return cond


def lookup(rows: DataFrame, table: DataFrame, on: list[str], weight: str, spread: list[str]) -> DataFrame:
    """Left join of ``rows`` with ``table`` (one row per key, null keys equal) that no hot key can slow.

    ``weight`` is the table's column with the number of ``rows`` that carry the key. Keys above
    1/SHARES of the total are fewer than SHARES, so their table rows are broadcast; all other
    keys meet in a shuffle join, where none has more than 1/SHARES of the rows. Rows that the
    broadcast served are dealt out by a hash of ``spread`` and match nothing there.
    ``table`` is read twice: pass a written one.
    """
    values = [c for c in table.columns if c not in on]
    total = table.agg(F.sum(weight)).first()[0] or 0
    heavy = F.coalesce(F.col(weight) * SHARES > total, F.lit(False))
    packed = lambda t, name: t.select(*[F.col(c).alias(f"{name}_{i}") for i, c in enumerate(on)],
                                      F.struct(*values).alias(name))
    h = packed(table.filter(heavy), "_h")
    light = packed(table.filter(~heavy), "_l").withColumn("_l_s", F.lit(0).cast("long"))
    got = rows.join(F.broadcast(h), same(rows, h, [(c, f"_h_{i}") for i, c in enumerate(on)]), "left")
    got = got.withColumn("_s", F.when(F.col("_h").isNull(), F.lit(0).cast("long"))
                         .otherwise(F.lit(1) + F.pmod(F.xxhash64(*spread), F.lit(1 << 40))))
    cond = same(got, light, [*[(c, f"_l_{i}") for i, c in enumerate(on)]]) & (got["_s"] == light["_l_s"])
    got = got.join(light, cond, "left")
    best = F.coalesce(F.col("_h"), F.col("_l"))
    return got.select(*rows.columns, *[best[c].alias(c) for c in values])


def within(rows: DataFrame, keys: DataFrame, on: list[str], limit: int = BROADCAST_ROWS, anti: bool = False) -> DataFrame:
    """``rows`` whose key is in ``keys`` (distinct, written). Keys are counted first: up to
    ``limit`` they are broadcast, more are joined by a shuffle."""
    k = keys.select(*on)
    k = F.broadcast(k) if k.count() <= limit else k
    return rows.join(k, on, "left_anti" if anti else "left_semi")
