"""SimHash near-dedup by multi-index hashing.

A fingerprint's bits are majority votes over the XXH64 hashes of the text's word shingles. Two distinct fingerprints
within ``max_bits`` = r of each other agree in some segment up to floor(r / m) bits, m the number of segments; by
the refined pigeonhole, with r = m * r' + a, the first a + 1 segments need radius r' and the others r' - 1.
Every distinct fingerprint is stored once per segment; probes enumerate the small Hamming ball of
the segment value, fetch the table's matches and verify the whole distance. A segment value shared
by more distinct fingerprints than a ball over the rest of the bits holds is searched by that
ball instead (exact too), so no bucket is ever paired with itself in full. Copies share one
fingerprint and are never paired.

Defined results: null or blank text has fingerprint zero and links like any other; a null id is ignored
by the component's smallest id; identical rows share a result; an empty table gives an empty result;
further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrospark.llm.common import lookup, row_key, written
from agrospark.llm.components import components
from agrospark.llm.decontam import by_bytes

BITS = 64
#: shingles whose votes are added at once; bounds a task's memory on very long texts
VOTES_AT_ONCE = 1 << 16


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Majority fingerprint (unsigned) of the A-Z lower-cased text's shingles of ``shingle`` words [^\\x20\\x09-\\x0D]+."""
    words = (text or "").encode().lower().split()          # bytes: ASCII blanks and letters only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    join, digest = b" ".join, xxhash.xxh64_intdigest
    votes = np.zeros(BITS, np.int64)
    for start in range(0, n, VOTES_AT_ONCE):
        part = words[start:min(n, start + VOTES_AT_ONCE) + shingle - 1]
        grams = zip(*[part[i:] for i in range(shingle)]) if len(part) >= shingle else [part]
        h = np.fromiter((digest(join(g), seed) for g in grams), np.uint64)
        votes += _votes(h)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def _votes(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, lowest bit first."""
    return np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``id, _k1, _k2, fp``: the fingerprint as a signed long (the same 64 bits), with the row's content key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches):
            fp = np.fromiter((simhash(t, shingle) for t in b.column("text").to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("id", "_k1", "_k2")], pa.array(fp.view(np.int64))], names=["id", "_k1", "_k2", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), *row_key(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, _k1 long, _k2 long, fp long")


def segments(max_bits: int, count: int) -> list[tuple[int, int, int]]:
    """(first bit, width, radius) of each of ``count`` segments; a radius of -1 needs no search."""
    radius, rest = divmod(max_bits, count)
    cuts = [BITS * i // count for i in range(count + 1)]
    return [(cuts[i], cuts[i + 1] - cuts[i], radius if i <= rest else radius - 1) for i in range(count)]


def _masks(bits: list[int], radius: int) -> list[int]:
    """Signed longs with up to ``radius`` of the given bits set, the empty mask first."""
    out = [sum(1 << b for b in c) for k in range(radius + 1) for c in combinations(bits, k)]
    return [x - (1 << BITS) if x >> (BITS - 1) else x for x in out]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def near_pairs(fps: DataFrame, max_bits: int = 2, count: int = 2, dense: int | None = None) -> DataFrame:
    """``a, b``: all pairs a < b of distinct fingerprints (``fp``, written) that differ in at most ``max_bits`` bits.

    ``dense``: size from which a segment value's bucket is searched by balls over the other bits.
    Probes and table meet in a sort-merge join by hint: the planner takes a probe table for as small as the fingerprints that it is
    exploded from, and would gather its rows, some dozens a fingerprint, on the driver to broadcast them.
    """
    found = None
    for first, width, radius in segments(max_bits, count):
        if radius < 0:
            continue
        inside = list(range(first, first + width))
        outside = [b for b in range(BITS) if b not in set(inside)]
        mask = F.lit(_signed(sum(1 << b for b in inside)))
        balls = _masks(outside, max_bits)
        limit = dense or len(balls)
        table = fps.select(F.col("fp").bitwiseAND(mask).alias("key"), F.col("fp").alias("b"))
        probes = fps.select(F.col("fp").alias("a"), F.explode(F.array(*[F.lit(m) for m in _masks(inside, radius)])).alias("flip"))
        probes = probes.select("a", "flip", F.col("a").bitwiseXOR(F.col("flip")).bitwiseAND(mask).alias("key"))
        crowded = written(table.groupBy("key").count().filter(F.col("count") > limit).select("key"), "crowded")
        some = crowded.limit(1).count() > 0
        if some:
            table = table.join(crowded, "key", "left_anti")
        sparse = probes.join(table.hint("merge"), "key").filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select("a", "b")
        found = sparse if found is None else found.unionByName(sparse)
        if some:
            # the same search where buckets are crowded: all fingerprints of the ball, looked up by their full value
            left = F.lit(max_bits) - F.bit_count("flip")
            full = (probes.join(crowded, "key", "left_semi")
                    .select("a", F.explode(F.array(*[F.lit(m) for m in balls])).alias("more"), "flip", left.alias("left"))
                    .filter(F.bit_count("more") <= F.col("left"))
                    .select("a", F.col("a").bitwiseXOR(F.col("flip")).bitwiseXOR(F.col("more")).alias("b")).filter("a < b"))
            found = found.unionByName(full.join(fps.select(F.col("fp").alias("b")).hint("merge"), "b", "left_semi").select("a", "b"))
    return found.distinct()


def simhash_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id, _k1, _k2, fp, fingerprint`` (16 lower-case hex digits), ``component_id`` (smallest id reachable),
    ``n_links`` (linked other fingerprints) and ``stays`` (the component's row of smallest id, then content key)."""
    prints = written(fingerprints(docs, id_col, text_col, shingle), "simhash")
    place = F.struct(F.col("id").isNull().alias("unknown"), "id", "_k1", "_k2")
    classes = written(prints.groupBy("fp").agg(F.count("*").alias("n"), F.min(place).alias("first")), "simhash-classes")
    pairs = written(near_pairs(classes.select("fp"), max_bits), "simhash-pairs")
    roots = components(pairs)
    degree = pairs.select(F.explode(F.array("a", "b")).alias("fp")).groupBy("fp").agg(F.count("*").alias("n_links"))
    linked = written(classes.join(roots, classes["fp"] == roots["node"], "left").join(degree, "fp", "left")
                     .select("fp", "n", "first", F.coalesce("root", "fp").alias("root"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")), "simhash-linked")
    least = written(linked.groupBy("root").agg(F.min("first").alias("head"), F.count("*").alias("w")), "simhash-least")
    table = written(lookup(linked, least, ["root"], "w", ["fp"]).select("fp", "n", "head", "n_links"), "simhash-table")
    return lookup(prints, table, ["fp"], "n", ["_k1"]).select(
        "id", "_k1", "_k2", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("head.id").alias("component_id"), "n_links",
        ((F.col("_k1") == F.col("head._k1")) & (F.col("_k2") == F.col("head._k2"))).alias("stays"))
