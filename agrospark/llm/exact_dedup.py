"""Exact dedup against immutable snapshots.

A snapshot keeps, per bucket of the digest space, its groups of equal texts and one static binary
fuse filter over their digests. An incoming batch is grouped by digest first (its own duplicates),
its distinct digests are screened bucket by bucket by the filters, and only positives are joined
with the snapshot's exact buckets. Groups with more than one row are then checked byte by byte:
whole normalised texts are compared, combined map-side so that a group of copies shrinks before it
is shuffled. Texts that no filter or group singles out are never moved.

Defined results: null text counts as empty; a null id ranks after all ids; of rows that tie in code points and
id, the one with the smallest content key (``row_key`` of ``key_cols``) stays; rows equal in all of
``key_cols`` share one decision; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrospark.llm.common import lookup, row_key, within, written

#: deleted before texts are compared: [\x20\x09-\x0D]
BLANKS = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]
#: distinct digests that one filter aims to hold, and the least number of buckets
BUCKET_KEYS, MIN_BUCKETS = 65_536, 64
KEY = ["digest", "alt", "n_bytes"]


def normalised(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for b in BLANKS:
        out = F.replace(out, F.lit(b), F.lit(""))
    return out


# ------------------------------------------------------------------ binary fuse filter (3-wise, 8 bit)
def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser of key + seed."""
    h = keys.astype(np.uint64) + np.uint64(seed)
    for shift, mult in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(mult)
    return h ^ (h >> np.uint64(33))


def _shape(n: int) -> tuple[int, int]:
    """(segment length, segments that a first position may fall in) for ``n`` keys."""
    length = 1 << max(2, min(18, int(math.floor(math.log(max(n, 2)) / math.log(3.33) + 2.25))))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    return length, max(1, math.ceil(max(n, 2) * factor / length) - 2)


def _slots(h: np.ndarray, length: int, count: int) -> np.ndarray:
    """The three slots of each hash, one in each of three consecutive segments: shape (3, n)."""
    first = ((h >> np.uint64(32)) * np.uint64(length * count)) >> np.uint64(32)
    mask = np.uint64(length - 1)
    second = (first + np.uint64(length)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * length)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64)


def _tag(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(32))).astype(np.uint8)


def fuse_build(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segment count, fingerprints) of a filter over distinct uint64 keys.

    Slots that one key alone touches are peeled in rounds; keys of one round own different slots
    that no other key of the round touches, so each round is assigned at once, last round first.
    """
    length, count = _shape(len(keys))
    size = (count + 2) * length
    for seed in range(1, 1000):
        h = _mix(keys, seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        slots = _slots(h, length, count)
        left = np.arange(len(keys))
        rounds = []
        while len(left):
            degree = np.bincount(slots[:, left].ravel(), minlength=size)
            alone = degree[slots[:, left]] == 1
            done = alone.any(axis=0)
            if not done.any():
                break
            rounds.append((left[done], alone[:, done].argmax(axis=0)))
            left = left[~done]
        if not len(left):
            table = np.zeros(size, np.uint8)
            for who, own in reversed(rounds):
                at = slots[:, who]
                value = _tag(h[who])
                for j in range(3):
                    value ^= np.where(own == j, 0, table[at[j]]).astype(np.uint8)
                table[at[own, np.arange(len(who))]] = value
            return seed, length, count, table.tobytes()
    raise ValueError("no seed gives a filter: keys repeat")


def fuse_contains(keys: np.ndarray, seed: int, length: int, count: int, table: bytes) -> np.ndarray:
    t = np.frombuffer(table, np.uint8)
    h = _mix(keys, seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    at = _slots(h, length, count)
    return (t[at[0]] ^ t[at[1]] ^ t[at[2]]) == _tag(h)


# ------------------------------------------------------------------ snapshot and batch
def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=None, key_cols: list[str] | None = None) -> DataFrame:
    """One narrow row per document: id, code points, digest of the normalised text, and a second
    hash and the length, which together with the digest name a text (``digest`` is replaceable)."""
    digest = digest or (lambda c: F.sha2(c, 256))
    return docs.select(*row_key(*(key_cols or [id_col, text_col])), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).select(
        "id", "_k1", "_k2", F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_cp"),
        digest(normalised(F.col("text"))).alias("digest"), F.xxhash64(normalised(F.col("text"))).alias("alt"),
        F.octet_length(normalised(F.col("text"))).cast("long").alias("n_bytes"))


def groups(prints: DataFrame) -> DataFrame:
    """Groups of one digest: size and the row that stays (most code points, then smallest id)."""
    best = F.max(F.struct(F.col("n_cp"), F.col("id").isNotNull().alias("known"),
                          F.bitwise_not(F.col("id")).alias("low"), "_k1", "_k2"))    # ~id falls as id rises
    return (prints.groupBy(*KEY).agg(F.count("*").alias("n"), best.alias("best"))
            .withColumn("filter_key", F.xxhash64("digest", "alt")))


def build_snapshot(prints: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(groups, filters, buckets): the exact buckets and one filter per bucket, both written.

    The number of buckets follows the number of distinct digests, so that a filter and its keys
    stay small at any size.
    """
    g = written(groups(prints), "snapshot-groups")
    n = g.count()
    buckets = max(MIN_BUCKETS, 1 << math.ceil(math.log2(max(1, n / BUCKET_KEYS))))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(pdf["filter_key"].to_numpy(np.int64).view(np.uint64))
        seed, length, count, table = fuse_build(keys)
        return pd.DataFrame([(pdf["bucket"].iloc[0], seed, length, count, table)],
                            columns=["bucket", "seed", "length", "count", "fuse"])

    f = (g.select(F.pmod("filter_key", F.lit(buckets)).alias("bucket"), "filter_key").groupBy("bucket")
         .applyInPandas(build, "bucket long, seed long, length long, count long, fuse binary"))
    return g, written(f, "snapshot-filters"), buckets


def screen(batch_groups: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """Batch groups that the snapshot's filters can't rule out. Each bucket's digests meet its one
    filter in a cogroup; buckets of a batch larger than the snapshot are dealt over more salts."""
    salts = max(1, math.ceil(batch_groups.count() / (buckets * BUCKET_KEYS)))

    def probe(pdf: pd.DataFrame, fuse: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf) or not len(fuse):
            return pdf[[*KEY]].iloc[:0]
        f = fuse.iloc[0]
        hit = fuse_contains(pdf["filter_key"].to_numpy(np.int64).view(np.uint64), int(f["seed"]), int(f["length"]), int(f["count"]), f["fuse"])
        return pdf.loc[hit, [*KEY]]

    keyed = batch_groups.select(*KEY, "filter_key", F.pmod("filter_key", F.lit(buckets)).alias("bucket"),
                                F.pmod(F.xxhash64(F.lit(1), "filter_key"), F.lit(salts)).alias("salt"))
    salted = filters.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return (keyed.groupBy("bucket", "salt").cogroup(salted.groupBy("bucket", "salt"))
            .applyInPandas(probe, batch_groups.select(*KEY).schema))


def byte_check(texts: DataFrame, keys: DataFrame, id_col: str, text_col: str, digest=None) -> int:
    """Number of keys under which ``texts`` holds more than one normalised text (expected: 0).

    Whole texts are grouped by (key, text); copies are combined before the shuffle.
    """
    norm = normalised(F.col(text_col))
    d = (digest or (lambda c: F.sha2(c, 256)))(norm)
    t = texts.select(d.alias("digest"), F.xxhash64(norm).alias("alt"),
                     F.octet_length(norm).cast("long").alias("n_bytes"), norm.alias("norm"))
    distinct = within(t, keys, KEY).groupBy(*KEY, "norm").agg(F.count("*").alias("c"))
    return distinct.groupBy(*KEY).count().filter("count > 1").count()


def exact_dedup(snapshot_docs: DataFrame, batch_docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest=None, key_cols: list[str] | None = None) -> DataFrame:
    """One row per document of both sides: ``id, _k1, _k2, keep_id, group_size, kept, text_sha256, in_snapshot``.

    ``snapshot_docs`` is the immutable snapshot, ``batch_docs`` the incoming batch. Digests that the
    snapshot and the batch share, and digests that repeat, are checked on whole texts; should two
    different texts ever share digest, second hash and length, the job stops with an error.
    """
    old = written(fingerprints(snapshot_docs, id_col, text_col, digest, key_cols), "snapshot-prints")
    new = written(fingerprints(batch_docs, id_col, text_col, digest, key_cols), "batch-prints")
    exact, filters, buckets = build_snapshot(old)
    own = written(groups(new), "batch-groups")                       # new-batch duplicates on their own
    positive = screen(own, filters, buckets)
    met = own.join(positive, KEY, "left_semi").join(                 # positives meet the exact buckets
        exact.select(*KEY, F.col("n").alias("old_n"), F.col("best").alias("old_best")), KEY)
    merged = met.select(*KEY, (F.col("n") + F.col("old_n")).alias("n"), F.greatest("best", "old_best").alias("best"))
    merged = written(merged, "met-groups")
    once = exact.unionByName(own).select(*KEY, "n", "best").join(merged.select(*KEY), KEY, "left_anti")
    table = written(once.unionByName(merged), "groups")
    repeated = written(table.filter("n > 1").select(*KEY), "repeated")
    clash = byte_check(snapshot_docs.select(id_col, text_col).unionByName(batch_docs.select(id_col, text_col)),
                       repeated, id_col, text_col, digest)
    if clash:
        raise ValueError(f"{clash} digests stand for more than one text")
    rows = old.withColumn("in_snapshot", F.lit(True)).unionByName(new.withColumn("in_snapshot", F.lit(False)))
    got = lookup(rows, table, KEY, "n", ["id"])
    keep = F.when(F.col("best.known"), F.bitwise_not(F.col("best.low")))
    return got.select("id", "_k1", "_k2", keep.alias("keep_id"), F.col("n").alias("group_size"),
                      ((F.col("_k1") == F.col("best._k1")) & (F.col("_k2") == F.col("best._k2"))).alias("kept"),
                      F.col("digest").alias("text_sha256"), "in_snapshot")
