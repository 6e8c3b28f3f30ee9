"""URL filters that hold at fetch time: a temporal join of captures with dated lists.

List events (add or remove an entry on a day) become validity intervals; every capture is evaluated as of
its own day against the intervals of its candidate entries: each domain suffix of its host and each
path prefix of its URL. Allow lists overrule block lists.

A host with a third of all captures is one hot key on the capture side; its intervals (bounded by the list's
dates) are one table row, joined by ``lookup``. Repeated events are collapsed before intervals are built,
so a history is at most two events per list, entry and day.

Defined results: an add on an active entry and a remove on an inactive one change nothing; of an add and a remove on
one day the remove comes last; an entry is active from the day it is added to the day before it is removed. A null or
unparseable URL has no candidates (verdict ``none``, host null), a null day neither. Events with a null entry, day or
list count for nothing. Repeated captures share a result; empty tables work; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrospark.llm.common import lookup, row_key, written

_URL = r"^[\x00-\x20]*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; null if there is none."""
    h = F.regexp_replace(F.regexp_extract(url, _URL, 1), "^.*@", "")
    h = F.regexp_replace(F.regexp_replace(F.lower(h), ":[0-9]*$", ""), "[.]$", "")
    return F.when(h != "", h)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 2)


def domain_keys(host: Column) -> Column:
    """``d:`` + each suffix of the host at a label boundary, itself included."""
    labels = F.split(host, "[.]")
    return F.transform(labels, lambda _, i: F.concat(F.lit("d:"), F.array_join(F.slice(labels, i + 1, F.size(labels)), ".")))


def prefix_keys(host: Column, path: Column) -> Column:
    """``u:`` + host + each prefix of the path at a segment boundary (without a final slash)."""
    parts = F.split(F.regexp_replace(path, "/+$", ""), "/")
    return F.transform(parts, lambda _, i: F.concat(F.lit("u:"), host, F.array_join(F.slice(parts, 1, i + 1), "/")))


def intervals(events: DataFrame) -> DataFrame:
    """``list, entry, valid_from, valid_to`` (end excluded, null while active) from ``list, entry, day, action``."""
    e = (events.select("list", "entry", "day", F.lower("action").alias("action"))
         .filter(F.col("list").isNotNull() & F.col("entry").isNotNull() & F.col("day").isNotNull() & F.col("action").isin("add", "remove")).distinct())
    w = Window.partitionBy("list", "entry").orderBy("day", "action")            # 'add' < 'remove'
    was = F.lag("action").over(w)
    turns = e.withColumn("was", was).filter(F.when(F.col("action") == "add", F.col("was").isNull() | (F.col("was") == "remove"))
                                            .otherwise(F.col("was") == "add"))
    ends = turns.withColumn("valid_to", F.lead("day").over(w))
    return ends.filter("action = 'add'").select("list", "entry", F.col("day").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, events: DataFrame, allow: list[str], id_col: str = "page_id", url_col: str = "url", day_col: str = "day") -> DataFrame:
    """One row per capture: ``id, url, host, day, blocked_by, allowed_by`` (sorted lists active on that day), ``entries``
    (matching entries) and ``verdict`` (allow, block or none)."""
    url = F.col(url_col).cast("string")
    c = captures.select(*row_key(id_col, url_col, day_col), F.col(id_col).alias("id"), url.alias("url"), F.col(day_col).cast("date").alias("day")).withColumn("host", host_of(F.col("url")))
    keys = c.filter("host is not null and day is not null").select(
        "_k1", "_k2", "day", F.explode(F.concat(domain_keys(F.col("host")), prefix_keys(F.col("host"), path_of(F.col("url"))))).alias("entry")).distinct()
    spans = (intervals(events).groupBy("entry").agg(F.collect_list(F.struct("list", "valid_from", "valid_to")).alias("spans")))
    keys = written(keys, "url-keys")
    weight = keys.groupBy("entry").agg(F.count("*").alias("w"))
    table = written(spans.join(weight, "entry"), "url-intervals")
    hit = lookup(keys, table, ["entry"], "w", ["_k1"]).filter("spans is not null").select(
        "_k1", "_k2", "entry", F.explode("spans").alias("s"), "day").filter(
        (F.col("s.valid_from") <= F.col("day")) & (F.col("s.valid_to").isNull() | (F.col("day") < F.col("s.valid_to"))))
    allowed = F.col("s.list").isin(*allow)
    per = hit.groupBy("_k1", "_k2").agg(
        F.array_sort(F.collect_set(F.when(~allowed, F.col("s.list")))).alias("blocked_by"),
        F.array_sort(F.collect_set(F.when(allowed, F.col("s.list")))).alias("allowed_by"),
        F.array_sort(F.collect_set("entry")).alias("entries"))
    none = F.array().cast("array<string>")
    got = c.join(per, ["_k1", "_k2"], "left").select("id", "url", "host", "day", *[F.coalesce(x, none).alias(x) for x in ("blocked_by", "allowed_by", "entries")])
    return got.withColumn("verdict", F.when(F.size("allowed_by") > 0, "allow").when(F.size("blocked_by") > 0, "block").otherwise("none"))
