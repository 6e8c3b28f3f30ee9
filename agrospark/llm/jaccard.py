"""N-gram Jaccard join: a metric-space join over distinct word shingles.

Jaccard distance d is a metric. Two documents are linked when d <= t (t = 0.1 for a similarity of 0.9).

*Regions.* Nearly all pairs of documents share nothing, so to any document chosen as a pivot they are at the same distance 1 and windows around
it would hold everything. The first diagram therefore has the shingles themselves as pivots, as singleton sets: d(x, {s}) is below 1 only
where x holds s, and of the pivots that x holds, the rarest counts as nearest. A linked pair differs in so few shingles that y holds one of the first
n - ceil((1 - t) n) + 1 pivots of x, and the other way round: these are the boundary regions that x is replicated to. Rarity is read off
a table of hashed counts of all shingles (``CELLS`` cells, a byte each once aggregated); any order of shingles gives the same links.

*Recursion.* A region of up to ``small`` documents is joined in pairs, by size and by the positions of the shared pivot. A larger one gets
documents as pivots: every member is measured against them, belongs to the Voronoi cell of the nearest, and is replicated to each
cell i with d(x, p_i) <= d(x, home) + 2t. By the triangle inequality a linked pair meets in the home cell of either. In a cell, members within t of the pivot
are linked to it, so pairs among them add nothing to the components; only members beyond t (the shell), and those members that the inequality lets be within t
of the nearest of the shell, go on. Cells are split again in the same way; what is still large after ``depth`` levels is joined in pairs, in blocks.

Equal sets are one class (128-bit digest) throughout, so copies are never paired. Shingles are 64-bit hashes.

Defined results: null and blank text has no shingle and is linked with nothing, not even with its like; a null id is ignored by the component's
smallest id; repeated rows share a result; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrospark.llm.common import SHARES, lookup, row_key, ship, written
from agrospark.llm.components import components
from agrospark.llm.decontam import _columns, by_bytes, gram_hashes, screen_table, word_hashes

CELL_BITS = 22
CELLS = 1 << CELL_BITS
#: cells in a row of the count table
CHUNK = 1 << 14
#: words up to this many bytes are hashed in numpy, longer ones whole by BLAKE2
LONG_WORD = 1 << 16
_U = np.uint64
_BLANK = np.zeros(256, bool)
_BLANK[9:14] = _BLANK[32] = True


# ---- sets of shingles ----

def _spans(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the runs of non-blank bytes; none goes across ``breaks``."""
    inside = ~_BLANK[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[breaks] = cut[len(data)] = True
    starts = np.flatnonzero(inside & (cut[:-1] | ~np.concatenate([[False], inside[:-1]])))
    return starts, np.flatnonzero(inside & (cut[1:] | ~np.concatenate([inside[1:], [False]]))) + 1


def shingles(text: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the texts' shingles after one another, offsets of each text); a text of fewer words has one shingle, without words none."""
    data, offsets = _columns(text)
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, _U), np.zeros(n + 1, np.int64)
    starts, ends = _spans(data, offsets[:-1][offsets[:-1] < len(data)])
    owner = np.searchsorted(offsets, starts, "right") - 1
    words = word_hashes(data, starts, ends)
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        words[i] = int.from_bytes(hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    n_words = np.bincount(owner, minlength=n)
    first = np.cumsum(n_words) - n_words
    grams = gram_hashes(words, k)
    ok = owner[:len(grams)] == owner[k - 1:k - 1 + len(grams)]
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    whole = np.array([gram_hashes(words[first[i]:first[i] + n_words[i]], int(n_words[i]))[0] + _U(n_words[i]) for i in short], _U)
    who = np.concatenate([owner[:len(grams)][ok], short])
    place = np.argsort(who, kind="stable")
    return np.concatenate([grams[ok], whole])[place], np.concatenate([[0], np.cumsum(np.bincount(who, minlength=n))])


def rarity(docs: DataFrame, k: int, text_col: str = "text") -> np.ndarray:
    """A byte per cell of shingle hashes: eight times the binary logarithm of the occurrences in it. Tasks count into an array of their own; a chunk's
    arrays are added up as a stream. CELLS bytes, whatever the input."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = None, [], 0

        def added(total):
            got = np.bincount((np.concatenate(held) >> _U(64 - CELL_BITS)).astype(np.int64), minlength=CELLS).astype(np.uint32)
            held.clear()
            return got if total is None else total + got

        for b in by_bytes(batches):
            h, _ = shingles(b.column("text"), k)
            held.append(h)
            size += len(h)
            if size > 1 << 22:
                total, size = added(total), 0
        if held:
            total = added(total)
        for c in range(CELLS // CHUNK if total is not None else 0):
            part = total[c * CHUNK:(c + 1) * CHUNK]
            if part.any():
                width = 1 if part.max() < 256 else 4
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([part.astype(f"<u{width}").tobytes()])], names=["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for c, x in zip(b.column("chunk").to_pylist(), b.column("counts").to_pylist()):
                sums[c] = sums.get(c, 0) + np.frombuffer(x, f"<u{len(x) // CHUNK}").astype(np.int64)
        for c, x in sums.items():
            level = np.minimum(np.rint(8 * np.log2(np.maximum(x, 1))), 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([level.tobytes()])], names=["chunk", "counts"])

    parts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "chunk int, counts binary")
    out = np.zeros(CELLS, np.uint8)
    for r in parts.repartition("chunk").mapInArrow(add, "chunk int, counts binary").toLocalIterator():       # CELLS bytes in all
        out[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(r["counts"], np.uint8)
    return out


def _digest(u: np.ndarray) -> tuple[int, int]:
    """128 bits of a set: two sums of differently mixed members."""
    a = (u ^ (u >> _U(31))) * _U(0x9FB21C651E98DF25)
    b = (u ^ (u >> _U(27))) * _U(0xD6E8FEB86659FD93)
    a, b = (a ^ (a >> _U(28))).sum(dtype=_U), (b ^ (b >> _U(30))).sum(dtype=_U)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _least_overlap(n: int, share: int) -> int:
    return -(-share * n // 100)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), *row_key(id_col, text_col), F.col(text_col).cast("string").alias("text"))


def summaries(docs: DataFrame, k: int, share: int, levels: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, _k1, _k2, n, node, pivots``: set size, set digest and the pivots of the regions that the document goes to, nearest first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches):
            h, at = shingles(b.column("text"), k)
            sizes, d1, d2, pivots = [], [], [], []
            for i in range(b.num_rows):
                u = np.unique(h[at[i]:at[i + 1]])
                x, y = _digest(u)
                order = np.lexsort((u, levels[(u >> _U(64 - CELL_BITS)).astype(np.int64)]))
                sizes.append(len(u))
                d1.append(x)
                d2.append(y)
                pivots.append(u[order[:len(u) - _least_overlap(len(u), share) + 1]].view(np.int64))
            ends = np.cumsum([0, *map(len, pivots)]).astype(np.int32)
            node = pa.StructArray.from_arrays([pa.array(d1, pa.int64()), pa.array(d2, pa.int64())], names=["d1", "d2"])
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("id", "_k1", "_k2")], pa.array(sizes, pa.int64()), node,
                                              pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(pivots)))], names=["id", "_k1", "_k2", "n", "node", "pivots"])

    rows = _keyed(docs, id_col, text_col)
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, _k1 long, _k2 long, n long, node struct<d1: bigint, d2: bigint>, pivots array<bigint>")


# ---- distances and joins ----

#: pairs of a node whose set is made at once
TOGETHER = 64
#: rows (a node and up to TOGETHER pairs each) that are broadcast to the texts; more are joined by a shuffle
NODE_ROWS = 250_000


def overlaps(pairs: DataFrame, docs: DataFrame, reps: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """``a, b, na, nb, o`` of distinct pairs ``a, b`` (written): set sizes and the size of the intersection, written.

    ``reps``: ``node, _k1, _k2``, a row of each class. A class's text is read again and its whole set made where the text lies; the set goes to each pair of the node, so a
    pair's two sets meet in a group of their own, however many pairs a node has.
    """
    rows = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("node"))
    table = written(rows.groupBy("node").agg(F.count("*").alias("w")).join(reps, "node"), "to-read")
    rows = lookup(rows, table, ["node"], "w", ["a", "b"])
    part = F.pmod(F.xxhash64("a", "b"), F.ceil(F.col("w") / TOGETHER))
    rows = written(rows.groupBy("node", "_k1", "_k2", part.alias("part")).agg(F.collect_list(F.struct("a", "b")).alias("pairs")).drop("part"), "pairs-of")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches):
            h, at = shingles(b.column("text"), k)
            sets = [np.unique(h[at[i]:at[i + 1]]).view(np.int64) for i in range(b.num_rows)]
            count = pc.list_value_length(b.column("pairs")).to_numpy(zero_copy_only=False)
            owner = pa.array(np.repeat(np.arange(b.num_rows), count))
            own, pair = b.column("node").take(owner), b.column("pairs").flatten()
            first = pc.and_(*[pc.equal(pc.struct_field(own, d), pc.struct_field(pair, ["a", d])) for d in ("d1", "d2")])
            for lo in range(0, len(pair), 1024):
                items = [sets[i] for i in owner.slice(lo, 1024).to_pylist()]
                ends = np.cumsum([0, *map(len, items)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*[pc.struct_field(pair.slice(lo, 1024), x) for x in "ab"], first.slice(lo, 1024),
                                                  pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(items)))], names=["a", "b", "first", "items"])

    texts = docs.select(*row_key(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    read = texts.join(F.broadcast(rows) if rows.count() <= NODE_ROWS else rows, ["_k1", "_k2"]).select("node", "pairs", "text")
    kind = "struct<d1: bigint, d2: bigint>"
    sent = read.mapInArrow(run, f"a {kind}, b {kind}, first boolean, items array<bigint>")
    met = sent.groupBy("a", "b").agg(F.first(F.when(F.col("first"), F.col("items")), True).alias("x"), F.first(F.when(~F.col("first"), F.col("items")), True).alias("y"))
    return written(met.select("a", "b", F.size("x").cast("long").alias("na"), F.size("y").cast("long").alias("nb"), F.size(F.array_intersect("x", "y")).cast("long").alias("o")), "overlaps")


def _linked(share: int):
    return F.col("o") * 100 >= (F.col("na") + F.col("nb") - F.col("o")) * share


def _least_common(na, nb, share: int):
    """Members that two linked sets of these sizes have in common at least."""
    return F.ceil(F.lit(share) * (na + nb) / F.lit(100 + share) - F.lit(1e-6))


def _region_rows(classes: DataFrame, share: int) -> DataFrame:
    """``region, node, n, pos, label`` of the first diagram: the regions where a linked pair can meet, and in them the members that have a possible partner.

    The smaller one of a linked pair holds the shared pivot so early that it could link to its like (``core``); the larger one leaves
    room for the smallest such member. A bit table of the regions (bounded) spares the rows of all others, the join decides.
    """
    core = F.col("n") - F.col("pos") >= _least_common(F.col("n"), F.col("n"), share)
    some = classes.filter("n > 0")
    places = some.select("n", F.posexplode("pivots").alias("pos", "region"))
    shared = places.groupBy("region").agg(F.count("*").alias("size"), F.min(F.when(core, F.col("n"))).alias("least"))
    shared = written(shared.filter("size > 1 and least is not null").withColumnRenamed("region", "h"), "regions")
    screen, bits = screen_table(shared)
    table = np.frombuffer(screen, np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("pivots")
            ends = np.cumsum(np.concatenate([[0], pc.list_value_length(lists).to_numpy(zero_copy_only=False)]))
            h = lists.flatten().to_numpy(zero_copy_only=False)
            at = (h.view(_U) >> _U(64 - bits)).astype(np.int64)
            hit = np.flatnonzero(table[at >> 3] >> (at & 7).astype(np.uint8) & 1)
            owner = np.searchsorted(ends, hit, "right") - 1
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays([b.column("node").take(rows), b.column("n").take(rows), pa.array((hit - ends[owner]).astype(np.int32)), pa.array(h[hit])],
                                             names=["node", "n", "pos", "h"])

    rows = some.select("node", "n", "pivots").mapInArrow(run, "node struct<d1: bigint, d2: bigint>, n long, pos int, h long")
    got = lookup(written(rows, "region-places"), shared, ["h"], "size", ["node"]).filter("size is not null")
    room = (F.col("n") - F.col("pos")) * F.lit(100 + share) / F.lit(share) - F.col("n") + F.lit(1e-6)
    got = got.filter(core | (room >= F.col("least")))
    return got.select(F.col("h").alias("region"), "node", "n", "pos", F.xxhash64("node").alias("label"))


def _allowed(share: int):
    """Sizes and positions of a pair ``a, b`` that may be linked; members with the same label are known to be connected."""
    sizes = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * share
    return sizes & (F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) >= _least_common(F.col("na"), F.col("nb"), share)) & (F.col("la") != F.col("lb"))


def _sides(rows: DataFrame, *more):
    side = lambda i: rows.select("region", *more, F.col("node").alias(i), *[F.col(c).alias(f"{c[0]}{i}") for c in ("n", "pos", "label")])
    return side("a"), side("b")


def _paired(rows: DataFrame, share: int) -> DataFrame:
    """``a, b``: the allowed pairs within the (small) regions of ``rows``."""
    x, y = _sides(rows)
    return x.join(y, "region").filter((F.col("a") < F.col("b")) & _allowed(share)).select("a", "b")


def _apart(rows: DataFrame, share: int, block: int = 64) -> DataFrame:
    """``a, b``: the allowed pairs with at least one member outside of its region's main label (``out``). Members outside are dealt into blocks, and every
    block meets the region's other rows in a task of its own, so that no task holds a region; rows in the main label never meet each other."""
    blocks = rows.groupBy("region").agg(F.ceil(F.count(F.when(F.col("out"), 1)) / block).alias("blocks")).filter("blocks > 0")
    r = rows.join(blocks, "region")
    x = _sides(r.filter("out").withColumn("part", F.pmod(F.xxhash64("node"), F.col("blocks"))), "part")[0]
    y = _sides(r.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))), "part", "out")[1]
    pair = x.join(y, ["region", "part"]).filter(_allowed(share) & (~F.col("out") | (F.col("a") < F.col("b"))))
    return pair.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _labels(near: DataFrame, slots: int) -> DataFrame:
    """``region, slot, group``: the pivots' groups, from ``region, slot, other``: pivots within t of each other. A region has at most slots^2 rows."""
    got = near.select("region", "slot", F.least("slot", "other").alias("group"))
    got = written(got.groupBy("region", "slot").agg(F.min("group").alias("group")), "groups")
    for _ in range(max(1, (slots - 1).bit_length())):
        step = near.join(got.select("region", F.col("slot").alias("other"), "group"), ["region", "other"]).groupBy("region", "slot").agg(F.min("group").alias("group"))
        jump = got.select("region", F.col("slot").alias("group"), F.col("group").alias("further"))
        got = written(step.join(jump, ["region", "group"]).select("region", "slot", F.least("group", "further").alias("group")), "groups")
    return got


def jaccard_links(docs: DataFrame, classes: DataFrame, k: int = 3, share: int = 90, small: int = 24, pivots: int = 8, depth: int = 4,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``a, b``: links between classes (``node, n, pivots, _k1, _k2``, written) with the same components as all pairs at ``share`` percent or more.

    A document pivot that links a crowd is spread over virtual nodes (``salt`` above 0), so no node has a large share of the links.
    """
    t = 1 - share / 100
    node = lambda c, salt: F.struct(F.col(f"{c}.d1").alias("d1"), F.col(f"{c}.d2").alias("d2"), salt.alias("salt"))
    none = F.lit(0).cast("long")
    rows = written(_region_rows(classes, share).withColumns({"main": F.lit(False), "out": F.lit(True)}), "region-rows")
    pairs, links = [], []
    reps = classes.select("node", "_k1", "_k2")
    for level in range(depth + 1):
        sizes = rows.groupBy("region").agg(F.count("*").alias("size"), F.count(F.when(F.col("out"), 1)).alias("n_out"))
        large = written(sizes.filter(F.col("size") > small), "large")
        if not large.limit(1).count():
            pairs.append(_paired(rows, share))
            break
        pairs.append(_paired(rows.join(large.select("region"), "region", "left_anti"), share))
        inside = written(rows.join(large.select("region"), "region", "left_semi"), "large-rows")
        if level:                                 # with few members outside of the main label, each simply meets the rest
            few = large.filter(F.col("n_out") <= small).select("region")
            pairs.append(_apart(inside.join(few, "region", "left_semi"), share))
            large = written(large.filter(F.col("n_out") > small), "larger")
            inside = inside.join(large.select("region"), "region", "left_semi")
            if not large.limit(1).count():
                break
        if level == depth:
            pairs.append(_apart(inside, share))
            break
        # pivots: of each slot the member outside that holds the region's own pivot earliest, so has least of its own; then by hash
        mixed = F.xxhash64(F.lit(level), "node.d1", "node.d2")
        chosen = (inside.filter("out").groupBy("region", F.pmod(mixed, F.lit(pivots)).alias("slot"))
                  .agg(F.min(F.struct("pos", mixed.alias("h"), "node")).alias("p")).select("region", "slot", F.col("p.node").alias("b")))
        chosen = chosen.groupBy("region").agg(F.collect_list(F.struct("slot", "b")).alias("ps"))        # at most ``pivots`` a region
        table = written(chosen.join(large.select("region", F.col("size").alias("w")), "region"), "pivots")
        met = lookup(inside, table, ["region"], "w", ["node"]).filter("ps is not null").select("region", "node", "n", "pos", "label", "main", "out", F.explode("ps").alias("p"))
        met = written(met.select("region", F.col("node").alias("a"), "n", "pos", "label", "main", "out", "p.slot", "p.b"), "met")
        want = written(met.filter("a <> b").select("a", "b").distinct(), "to-measure")
        far = overlaps(want, docs, reps, k, id_col, text_col)
        hit = far.filter(_linked(share)).select("a", "b")
        salt = F.pmod(F.xxhash64("a"), F.lit(SHARES)) + 1
        links += [hit.select(node("a", none).alias("a"), node("b", salt).alias("b")), hit.select(node("b", none).alias("a"), node("b", salt).alias("b")).distinct()]
        d = F.when(F.col("a") == F.col("b"), 0.0).otherwise(1 - F.col("o") / (F.col("na") + F.col("nb") - F.col("o")))
        linked = (F.col("a") == F.col("b")) | _linked(share)
        got = written(met.join(far, ["a", "b"], "left").select("region", "a", "b", "n", "pos", "label", "main", "slot", d.alias("d"), linked.alias("linked")), "distances")
        rows = written(_cells(got, pivots, t), "cell-rows")
        # cells that spare less than half of the pairs are not split further
        pairs.append(_apart(rows.filter("stop").drop("stop"), share))
        rows = rows.filter("not stop").drop("stop")
    want = pairs[0]
    for p in pairs[1:]:
        want = want.unionByName(p)
    want = written(want.distinct(), "pairs")
    out = overlaps(want, docs, reps, k, id_col, text_col).filter(_linked(share)).select(node("a", none).alias("a"), node("b", none).alias("b"))
    for x in links:
        out = out.unionByName(x)
    return out


def _cells(got: DataFrame, pivots: int, t: float) -> DataFrame:
    """The next level's rows, from the distances ``region, a, b, n, pos, label, main, slot, d, linked`` of members to pivots.

    Members linked to a pivot, and groups of pivots linked to each other, are one component: they share a label (an earlier main label
    that a pivot links to stays). The region's ``main`` label is its most frequent one. A linked pair of different labels has a member outside of it; in
    the cell where that one is at home (``out``) the other one is too, by the inequality. Of a cell's other members, those that the inequality keeps apart from all such go.
    ``stop``: the region's cells hold more than half of the pairs that the region holds.
    """
    is_pivot = F.col("a") == F.col("b")
    places = got.filter(is_pivot).select("region", F.col("slot").alias("other"), "a")
    near = written(got.filter("linked").join(places, ["region", "a"]).select("region", "slot", "other").distinct(), "pivot-links")
    near = near.unionByName(near.select("region", F.col("other").alias("slot"), F.col("slot").alias("other")))
    named = got.filter("linked").join(_labels(near, pivots), ["region", "slot"])
    kept = named.filter("main").groupBy("region", "group").agg(F.min("label").alias("old"))
    name = named.select("region", "group").distinct().join(kept, ["region", "group"], "left").select(
        "region", "group", F.coalesce("old", F.xxhash64(F.lit("group"), "region", "group")).alias("name"))
    mine = named.join(name, ["region", "group"]).groupBy("region", "a").agg(F.min("name").alias("name"))
    best = got.groupBy("region", "a").agg(F.min(F.struct("d", "slot")).alias("m"))
    rows = got.join(best, ["region", "a"]).join(mine, ["region", "a"], "left").filter(F.col("d") <= F.col("m.d") + 2 * t + 1e-9)
    rows = rows.select("region", "slot", "a", "n", "pos", F.coalesce("name", "label").alias("label"), "d", (F.col("slot") == F.col("m.slot")).alias("home"),
                       is_pivot.alias("is_pivot"))
    rows = written(rows, "cells")
    top = rows.filter("home").groupBy("region", "label").agg(F.count("*").alias("c")).groupBy("region").agg(F.max(F.struct("c", "label")).alias("top"), F.sum("c").alias("all"))
    top = written(top.select("region", F.col("top.label").alias("first"), "all"), "main-labels")
    rows = rows.join(top, "region").withColumn("main", F.col("label") == F.col("first")).withColumn("out", F.col("home") & ~F.col("main") & ~F.col("is_pivot"))
    reach = F.col("d").between(F.col("lo") - t - 1e-9, F.col("hi") + t + 1e-9)
    span = written(rows.filter("out").groupBy("region", "slot").agg(F.min("d").alias("lo"), F.max("d").alias("hi")), "spans")
    rows = rows.filter("not is_pivot").join(span, ["region", "slot"]).filter(reach)
    work = rows.groupBy("region", "slot").agg(F.count("*").alias("size"), F.count(F.when(F.col("out"), 1)).alias("n_out"))
    work = work.groupBy("region").agg(F.sum(F.col("size") * F.col("n_out")).alias("work"), F.sum("n_out").alias("n_out"))
    stop = written(work.join(top, "region").select("region", (F.col("work") * 2 > F.col("n_out") * F.col("all")).alias("stop")), "worth")
    return rows.join(stop, "region").select(F.xxhash64("region", "slot").alias("region"), F.col("a").alias("node"), "n", "pos", "label", "main", "out", "stop")


def jaccard_components(docs: DataFrame, k: int = 3, share: int = 90, small: int = 24, pivots: int = 8, depth: int = 4,
                       id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(rows, links)``. rows: one per document, ``id, _k1, _k2, n_shingles, component_id`` (smallest id reachable). links: as ``jaccard_links``."""
    ship(docs.sparkSession)
    levels = rarity(docs, k, text_col)
    rows = written(summaries(docs, k, share, levels, id_col, text_col), "shingled")
    first = F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "_k1", "_k2")).alias("first")
    some = rows.filter("n > 0")
    classes = written(some.groupBy("node").agg(F.count("*").alias("copies"), F.first("n").alias("n"), first, F.first("pivots").alias("pivots"))
                      .select("node", "copies", "n", "first", "pivots", "first._k1", "first._k2"), "set-classes")
    links = written(jaccard_links(docs, classes, k, share, small, pivots, depth, id_col, text_col), "jaccard-links")
    roots = components(links).filter("node.salt = 0").select(F.struct("node.d1", "node.d2").alias("node"), F.struct("root.d1", "root.d2").alias("root"))
    linked = written(classes.select("node", "copies", "first").join(roots, "node", "left").select("node", "copies", "first", F.coalesce("root", "node").alias("root")), "jaccard-linked")
    least = written(linked.groupBy("root").agg(F.min("first").alias("head"), F.count("*").alias("w")), "jaccard-least")
    table = written(lookup(linked, least, ["root"], "w", ["node"]).select("node", "copies", F.col("head.id").alias("component_id")), "jaccard-table")
    got = lookup(some.drop("pivots"), table, ["node"], "copies", ["_k1"]).select("id", "_k1", "_k2", F.col("n").alias("n_shingles"), "component_id")
    return got.unionByName(rows.filter("n = 0").select("id", "_k1", "_k2", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))), links
