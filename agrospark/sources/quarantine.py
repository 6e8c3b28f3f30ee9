"""Landed payloads that don't hold what their feed needs: told apart with a reason before they are parsed (A1-A4).

``from_json`` turns a broken payload into nulls, and the parsers then return defaults or nothing. Here each payload is read once as a
VARIANT and its first fault named; good payloads go on to the parsers, the others to a quarantine table, so both add up to the input.
Both sides are projections over the payloads: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrospark.sources import json_feeds as J

#: per feed: kind of the root; numbers that must be there; numbers that may be; lists (path, whether it must be there, numbers that each entry must have)
FEEDS = {
    "onecall": ("OBJECT", (), ("current.dt", "current.temp", "current.humidity", "current.pressure", "current.wind_speed"),
                (("hourly", False, ("dt", "temp")), ("daily", False, ("dt", "temp.day")))),
    "current": ("OBJECT", ("main.temp", "main.humidity", "main.pressure"), ("wind.speed", "wind.deg", "clouds.all", "visibility"), ()),
    "forecast": ("OBJECT", (), (), (("list", True, ("dt", "main.temp")),)),
    "geocode": ("ARRAY", (), (), (("", True, ("lat", "lon")),)),
}
PARSERS = {"onecall": J.parse_onecall, "current": J.parse_current, "forecast": J.parse_forecast, "geocode": J.parse_geocode}
_NUMBER = "^(BIGINT|DECIMAL|DOUBLE|FLOAT)"


def _kind(v: Column, path: str) -> Column:
    """Type of the value at a path as Spark names it; null where there is none (a JSON null counts as none)."""
    k = F.schema_of_variant(F.try_variant_get(v, f"$.{path}" if path else "$", "variant"))
    return F.when(k != "VOID", k)


def _lacks(path: str):
    """Of an entry: whether it has no number at the path."""
    return lambda e: ~F.coalesce(F.rlike(_kind(e, path), F.lit(_NUMBER)), F.lit(False))


def reason(v: Column, payload: Column, feed: str) -> Column:
    """First fault of a payload, null if it has none: ``empty``, ``malformed`` (no JSON, or a key twice), ``not an object`` / ``not an array``,
    ``missing <path>``, ``not a number: <path>``, ``not an array: <path>``, ``entry of <path>: <field>`` (an entry without that number).

    Text that holds a number is no number, as for the parsers. Further fields are ignored."""
    root, needed, allowed, lists = FEEDS[feed]
    checks = [F.when(payload.isNull() | F.rlike(payload, F.lit(r"^\s*$")), F.lit("empty")), F.when(v.isNull(), F.lit("malformed")),
              F.when(~F.coalesce(F.startswith(_kind(v, ""), F.lit(root)), F.lit(False)), F.lit(f"not an {root.lower()}"))]
    checks += [F.when(_kind(v, p).isNull(), F.lit(f"missing {p}")) for p in needed]
    checks += [F.when(~F.rlike(_kind(v, p), F.lit(_NUMBER)), F.lit(f"not a number: {p}")) for p in (*needed, *allowed)]
    for path, must, fields in lists:
        entries = F.try_variant_get(v, f"$.{path}" if path else "$", "array<variant>")
        if must:
            checks.append(F.when(_kind(v, path).isNull(), F.lit(f"missing {path}")))
        checks.append(F.when(_kind(v, path).isNotNull() & entries.isNull(), F.lit(f"not an array: {path}")))
        for f in fields:
            checks.append(F.when(F.exists(entries, _lacks(f)), F.lit(f"entry of {path or 'root'}: {f}")))
    return F.coalesce(*checks)


def checked(df: DataFrame, feed: str, json_col: str = "payload", out: str = "reason") -> DataFrame:
    """``df`` with the fault of each payload (null: none).

    Both columns come out of ``explode`` over one element: a filter on the reason is then not pushed into them, which would copy the parsing into every check."""
    parsed = df.select("*", F.explode(F.array(F.try_parse_json(F.col(json_col)))).alias("_variant"))
    return parsed.select(*df.columns, F.explode(F.array(reason(F.col("_variant"), F.col(json_col), feed))).alias(out))


def split(df: DataFrame, feed: str, json_col: str = "payload", **parser) -> tuple[DataFrame, DataFrame]:
    """(parsed rows of the good payloads, quarantined input rows with their ``reason``). ``parser``: further arguments of the feed's parser."""
    tagged = checked(df, feed, json_col)
    return PARSERS[feed](tagged.filter("reason is null").drop("reason"), json_col=json_col, **parser), tagged.filter("reason is not null")
