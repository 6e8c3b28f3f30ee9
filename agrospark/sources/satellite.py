"""Satellite sources re-expressed as Spark jobs.

The platform asked a remote catalogue for per-region daily means. Here the same reduction is a
job over a pixel table: a point-in-box range join of pixels to region boxes, then a grouped mean.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack_sources(dfs: Sequence[DataFrame], source_names: Sequence[str] | None = None) -> DataFrame:
    """Union of per-source frames into one sparse schema (absent columns -> null), tagged by source."""
    out = None
    for i, d in enumerate(dfs):
        if source_names is not None:
            d = d.withColumn("data_source", F.lit(source_names[i]))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def region_boxes(regions: DataFrame) -> DataFrame:
    """Bounding box = centre +/- buffer degrees."""
    return regions.select(
        "region",
        (F.col("lon") - F.col("buffer")).alias("lon_min"), (F.col("lat") - F.col("buffer")).alias("lat_min"),
        (F.col("lon") + F.col("buffer")).alias("lon_max"), (F.col("lat") + F.col("buffer")).alias("lat_max"))


def zonal_mean(pixels: DataFrame, boxes: DataFrame, bands: Sequence[str], start: str, end: str,
               cell: float = 1.0) -> DataFrame:
    """Per region and day, the mean of each band over pixels inside the region's box.

    Dates are filtered as [start, end) (end exclusive, as the catalogue filter was). The range
    join is turned into an equi-join: each box is exploded into the integer grid cells it
    touches (few per box, bounded by box area / cell^2) and each pixel carries its own cell, so
    the join is a hash join on (cell_x, cell_y) followed by the exact containment test. The
    exploded box table is small and fixed by the region set, not by the pixel count.
    """
    p = pixels.filter((F.col("date") >= F.to_date(F.lit(start))) & (F.col("date") < F.to_date(F.lit(end))))
    p = p.withColumns({"_cx": F.floor(F.col("lon") / F.lit(cell)), "_cy": F.floor(F.col("lat") / F.lit(cell))})
    b = boxes.withColumns({
        "_cx": F.explode(F.sequence(F.floor(F.col("lon_min") / F.lit(cell)), F.floor(F.col("lon_max") / F.lit(cell)))),
    }).withColumn("_cy", F.explode(F.sequence(F.floor(F.col("lat_min") / F.lit(cell)),
                                               F.floor(F.col("lat_max") / F.lit(cell)))))
    j = p.join(b, ["_cx", "_cy"]).filter(
        F.col("lon").between(F.col("lon_min"), F.col("lon_max")) & F.col("lat").between(F.col("lat_min"),
                                                                                         F.col("lat_max")))
    return j.groupBy("region", "date").agg(*[F.avg(c).alias(c) for c in bands],
                                           F.count(F.lit(1)).alias("n_pixels"))


def _area(lat_a: Column, lat_b: Column, width: Column) -> Column:
    """Share of the sphere between two parallels over ``width`` degrees, up to a constant: its area grows with the sine of latitude."""
    return (F.sin(F.radians(lat_b)) - F.sin(F.radians(lat_a))) * width


def _cells(df: DataFrame, cell: float) -> DataFrame:
    """One row per grid cell that the rectangle lon_min .. lat_max touches."""
    at = lambda c: F.floor(F.col(c) / F.lit(cell))
    return df.withColumn("_cx", F.explode(F.sequence(at("lon_min"), at("lon_max")))).withColumn("_cy", F.explode(F.sequence(at("lat_min"), at("lat_max"))))


def zonal_mean_weighted(pixels: DataFrame, boxes: DataFrame, bands: Sequence[str], pixel: float, start: str, end: str, cell: float = 1.0,
                        keys: Sequence[str] = ("region",)) -> DataFrame:
    """Per region and day, the mean of each band weighted by the area that a pixel covers inside the region's rectangles.

    A pixel is the square of ``pixel`` degrees about its centre (``pixel`` up to ``cell``), so one at the border counts by its covered share, and pixels
    nearer to the equator count for their larger ground. ``boxes``: ``lon_min, lat_min, lon_max, lat_max`` per key; a region may have many
    disjoint rows (``polygon_cover``). A null band value leaves out that band's weight alone; latitudes beyond the poles are cut there.
    Returns ``keys``, ``date``, the bands, ``covered`` (sum of covered shares, in pixels) and ``n_pixels`` (pixel-rectangle pairs).

    Each pixel-rectangle pair is met once, in the grid cell that holds the lower left corner of their intersection: rectangles are exploded into the cells
    they touch and pixels into the at most four that they touch, which is an equi-join whatever the number of pixels.
    """
    half = F.lit(pixel / 2.0)
    p = pixels.filter((F.col("date") >= F.to_date(F.lit(start))) & (F.col("date") < F.to_date(F.lit(end)))).select("date", "lon", "lat", *bands)
    p = p.withColumns({"lon_min": F.col("lon") - half, "lon_max": F.col("lon") + half,
                       "lat_min": F.greatest(F.col("lat") - half, F.lit(-90.0)), "lat_max": F.least(F.col("lat") + half, F.lit(90.0))})
    p = _cells(p.filter("lat_min < lat_max"), cell).select("date", *bands, "_cx", "_cy", *[F.col(c).alias(f"p_{c}") for c in ("lon_min", "lon_max", "lat_min", "lat_max")])
    j = p.join(_cells(boxes.select(*keys, "lon_min", "lon_max", "lat_min", "lat_max"), cell), ["_cx", "_cy"])
    j = j.withColumns({"a": F.greatest("lon_min", "p_lon_min"), "b": F.least("lon_max", "p_lon_max"), "c": F.greatest("lat_min", "p_lat_min"), "d": F.least("lat_max", "p_lat_max")})
    j = j.filter((F.col("a") < F.col("b")) & (F.col("c") < F.col("d")) & (F.floor(F.col("a") / F.lit(cell)) == F.col("_cx")) & (F.floor(F.col("c") / F.lit(cell)) == F.col("_cy")))
    j = j.withColumn("w", _area(F.col("c"), F.col("d"), F.col("b") - F.col("a")))
    whole = _area(F.col("p_lat_min"), F.col("p_lat_max"), F.col("p_lon_max") - F.col("p_lon_min"))
    mean = [(F.sum(F.col(x) * F.col("w")) / F.sum(F.when(F.col(x).isNotNull(), F.col("w")))).alias(x) for x in bands]
    return j.groupBy(*keys, "date").agg(*mean, F.sum(F.col("w") / whole).alias("covered"), F.count(F.lit(1)).alias("n_pixels"))


def polygon_cover(polygons: DataFrame, pixel: float, levels: int = 4, key: str = "region", ring: str = "ring") -> DataFrame:
    """Disjoint rectangles (``key, lon_min, lat_min, lon_max, lat_max``) whose union approximates each polygon, by a quadtree.

    ``ring``: array of (lon, lat) structs, closed or not, without crossings. The root is a grid of squares of ``pixel`` degrees over the ring's extent; a square that
    an edge crosses is halved both ways up to ``levels`` times, one that lies inside stays whole, one outside goes. At the last level
    the centre decides, so the error in area is at most the border's squares of ``pixel / 2^levels`` degrees. The squares are rows and
    each level is one projection over them; the edges of a ring travel with its squares and are the only thing that is held per row. Fewer than three points or a null: no rows.
    """
    first = F.get(F.col(ring), 0)
    closed = F.when(F.size(ring) >= 3, F.concat(F.col(ring), F.array(first)))
    edges = F.transform(F.slice(closed, 1, F.size(ring)), lambda p, i: F.struct(p["lon"].alias("x1"), p["lat"].alias("y1"), F.get(closed, i + 1)["lon"].alias("x2"),
                                                                                 F.get(closed, i + 1)["lat"].alias("y2")))
    low = lambda c: F.floor(F.array_min(F.transform(ring, lambda p: p[c])) / F.lit(pixel))
    high = lambda c: F.floor(F.array_max(F.transform(ring, lambda p: p[c])) / F.lit(pixel))
    sq = polygons.filter(F.size(ring) >= 3).select(key, edges.alias("e"), F.explode(F.sequence(low("lon"), high("lon"))).alias("_x"), low("lat").alias("_a"), high("lat").alias("_b"))
    sq = sq.withColumn("_y", F.explode(F.sequence("_a", "_b"))).select(key, "e", (F.col("_x") * F.lit(pixel)).alias("x"), (F.col("_y") * F.lit(pixel)).alias("y"))

    def inside(px: Column, py: Column) -> Column:
        """Even-odd rule."""
        hits = F.filter("e", lambda s: ((s["y1"] > py) != (s["y2"] > py)) & (px < (s["x2"] - s["x1"]) * (py - s["y1"]) / (s["y2"] - s["y1"]) + s["x1"]))
        return F.size(hits) % 2 == 1

    def crossed(size: float) -> Column:
        """Some edge may touch the square: their extents meet and the corners are not all strictly on one side of the edge's line."""
        def side(s, dx, dy):
            return (s["x2"] - s["x1"]) * (F.col("y") + F.lit(dy) - s["y1"]) - (s["y2"] - s["y1"]) * (F.col("x") + F.lit(dx) - s["x1"])

        def meets(s):
            c = [side(s, dx, dy) for dx in (0.0, size) for dy in (0.0, size)]
            return ((F.least(s["x1"], s["x2"]) <= F.col("x") + F.lit(size)) & (F.greatest(s["x1"], s["x2"]) >= F.col("x")) & (F.least(s["y1"], s["y2"]) <= F.col("y") + F.lit(size))
                    & (F.greatest(s["y1"], s["y2"]) >= F.col("y")) & (F.least(*c) <= 0) & (F.greatest(*c) >= 0))
        return F.exists("e", meets)

    out, size = [], float(pixel)
    for level in range(levels + 1):
        center = inside(F.col("x") + F.lit(size / 2), F.col("y") + F.lit(size / 2))
        sq = sq.withColumn("hit", crossed(size) if level < levels else F.lit(False))
        out.append(sq.filter(~F.col("hit") & center).select(key, F.col("x").alias("lon_min"), F.col("y").alias("lat_min"), (F.col("x") + F.lit(size)).alias("lon_max"),
                                                             (F.col("y") + F.lit(size)).alias("lat_max")))
        size /= 2
        corners = F.array(*[F.struct((F.col("x") + F.lit(dx * size)).alias("x"), (F.col("y") + F.lit(dy * size)).alias("y")) for dx in (0, 1) for dy in (0, 1)])
        sq = sq.filter("hit").select(key, "e", F.explode(corners).alias("q")).select(key, "e", "q.x", "q.y")
    got = out[0]
    for o in out[1:]:
        got = got.unionByName(o)
    return got


def cells_per_box(lon_span: float, lat_span: float, cell: float = 1.0) -> int:
    """Upper bound of grid cells one box explodes into (documents the join's fan-out)."""
    return (math.floor(lon_span / cell) + 2) * (math.floor(lat_span / cell) + 2)
