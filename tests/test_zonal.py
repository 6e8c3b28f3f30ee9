"""Area-weighted zonal means and the quadtree cover of polygons, against plain Python."""

import datetime as dt
import math
import random

import pytest

from agrospark.sources.satellite import polygon_cover, zonal_mean_weighted

DAY = dt.date(2024, 3, 1)


def area(a, b, width):
    return (math.sin(math.radians(b)) - math.sin(math.radians(a))) * width


def plain(pixels, boxes, size):
    out = {}
    for day, lon, lat, v in pixels:
        for region, x1, y1, x2, y2 in boxes:
            a, b, c, d = max(x1, lon - size / 2), min(x2, lon + size / 2), max(y1, lat - size / 2), min(y2, lat + size / 2)
            if a < b and c < d:
                w, whole = area(c, d, b - a), area(lat - size / 2, lat + size / 2, size)
                s = out.setdefault((region, day), [0.0, 0.0, 0.0, 0])
                s[0], s[1], s[2], s[3] = s[0] + (w * v if v is not None else 0), s[1] + (w if v is not None else 0), s[2] + w / whole, s[3] + 1
    return {k: (s[0] / s[1] if s[1] else None, s[2], s[3]) for k, s in out.items()}


def test_weighted_means(spark):
    rng = random.Random(1)
    pixels = [(DAY + dt.timedelta(rng.randint(0, 2)), rng.uniform(-18, -10), rng.uniform(11, 17), rng.choice([None, rng.uniform(0, 9)])) for _ in range(1500)]
    boxes = [("A", -17.9, 12.03, -14.2, 14.6), ("B", -15.0, 12.0, -12.0, 13.0), ("B", -12.0, 12.0, -11.0, 16.5), ("tiny", -13.004, 14.001, -13.0, 14.004), ("far", 50.0, 1.0, 51.0, 2.0)]
    p = spark.createDataFrame(pixels, "date date, lon double, lat double, v double")
    b = spark.createDataFrame(boxes, "region string, lon_min double, lat_min double, lon_max double, lat_max double")
    for size, cell in ((0.5, 1.0), (0.05, 0.25), (1.0, 1.0)):
        got = {(r["region"], r["date"]): (r["v"], r["covered"], r["n_pixels"]) for r in zonal_mean_weighted(p, b, ["v"], size, "2024-03-01", "2024-03-04", cell).collect()}
        want = plain(pixels, boxes, size)
        assert set(got) == set(want)
        for k, (v, c, n) in want.items():
            assert got[k][0] == (None if v is None else pytest.approx(v)) and got[k][1] == pytest.approx(c) and got[k][2] == n
    assert zonal_mean_weighted(p.limit(0), b, ["v"], 0.5, "2024-03-01", "2024-03-04").count() == 0
    assert zonal_mean_weighted(p, b.limit(0), ["v"], 0.5, "2024-03-01", "2024-03-04").count() == 0


def shoelace(ring):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))) / 2


def even_odd(ring, x, y):
    return sum((b > y) != (d > y) and x < (c - a) * (y - b) / (d - b) + a for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1])) % 2 == 1


def test_polygon_cover(spark):
    rings = {"square": [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)],
             "concave": [(-16.3, 12.1), (-13.2, 12.4), (-14.6, 13.2), (-13.1, 15.3), (-16.0, 14.1)],
             "sliver": [(5.0, 5.0), (6.9, 5.02), (5.1, 5.31)], "line": [(1.0, 1.0), (2.0, 2.0)]}
    df = spark.createDataFrame([(k, [{"lon": x, "lat": y} for x, y in r]) for k, r in rings.items()] + [("none", None)], "region string, ring array<struct<lon: double, lat: double>>")
    got = {}
    for r in polygon_cover(df, 0.5, levels=4).collect():
        got.setdefault(r["region"], []).append(tuple(r)[1:])
    assert set(got) == {"square", "concave", "sliver"}
    rng = random.Random(2)
    for k, squares in got.items():
        ring, fine = rings[k], 0.5 / 16
        border = sum(math.dist(a, b) for a, b in zip(ring, ring[1:] + ring[:1]))
        assert sum((c - a) * (d - b) for a, b, c, d in squares) == pytest.approx(shoelace(ring), abs=border * fine)
        for _ in range(400):                                        # disjoint; right away from the border
            x, y = rng.uniform(min(p[0] for p in ring), max(p[0] for p in ring)), rng.uniform(min(p[1] for p in ring), max(p[1] for p in ring))
            hits = sum(a <= x < c and b <= y < d for a, b, c, d in squares)
            near = {even_odd(ring, x + dx * fine, y + dy * fine) for dx in (-1, 0, 1) for dy in (-1, 0, 1)}
            assert hits <= 1 and (len(near) > 1 or hits == even_odd(ring, x, y))
