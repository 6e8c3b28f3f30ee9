"""Benchmark decontamination by winnowing.

Words are hashed, then k-grams of words; of every ``window - k + 1`` consecutive k-grams (that is, of every
``window`` words) the least hash is kept, the rightmost of equal ones. Training texts and benchmark
items that share ``window`` words therefore keep the same fingerprint at the same place, so a join on
fingerprints misses no shared span of that length. Items shorter than a window are fingerprinted
whole, by their own length. A hit is extended to the whole window's words, compared as text, and
the windows of a document are merged into spans.

A bit table of the benchmark's fingerprints (at most 2^MAX_SCREEN_BITS bits, whatever its size) goes to
every task and only spares the rows that can't match; the join decides.

Defined results: null text has no words; items without words match nothing; items with a null id count
as the empty string in lists; identical documents share a result; empty tables give no hits; further
columns of both inputs are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agrospark.llm.common import lookup, row_key, written

#: bytes hashed at once (a longer word or text is read in further pieces)
BLOCK = 1 << 20
MAX_SCREEN_BITS = 27
_U = np.uint64
_P, _Q = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95                       # odd multipliers
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing: digits, a-z and all of non-ASCII
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, _U)
    p[:1] = 1
    return np.cumprod(p, dtype=_U)


_UP, _DOWN = _powers(_P, BLOCK + 1), _powers(pow(_P, -1, 1 << 64), BLOCK + 1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


def word_spans(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of lower-cased ``data``; no word goes across ``breaks``."""
    is_word = _WORD[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(data) + 1, bool)
    cut[breaks] = True
    cut = cut[:-1]
    before = np.concatenate([[False], is_word[:-1]])
    starts = np.flatnonzero(is_word & (~before | cut))
    after = np.concatenate([is_word[1:], [False]])
    next_cut = np.concatenate([cut[1:], [True]])
    return starts, np.flatnonzero(is_word & (~after | next_cut)) + 1


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Per block of words: their slice, running polynomial sums of its bytes, and the words' starts and ends in the block.

    A word's hash is ``(run[end] - run[start]) * _DOWN[start]``. A block holds at most BLOCK bytes; of a longer
    word its last BLOCK bytes and its length count.
    """
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + BLOCK, "right")))
        hi = ends[j - 1]
        lo = max(lo, hi - BLOCK)
        run = np.concatenate([[_U(0)], np.cumsum((data[lo:hi].astype(_U) + _U(1)) * _UP[:hi - lo], dtype=_U)])
        yield slice(i, j), run, np.maximum(starts[i:j] - lo, 0), ends[i:j] - lo
        i = j


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.zeros(len(starts), _U)
    for rows, run, s, e in hash_runs(data, starts, ends):
        out[rows] = (run[e] - run[s]) * _DOWN[s] + (ends[rows] - starts[rows]).astype(_U)
    return _mixed(out)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words (position i: words i .. i+k-1)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    h = np.zeros(n, _U)
    for j in range(k):
        h = h * _U(_Q) + words[j:j + n]
    return _mixed(h)


def window_fingerprints(words: np.ndarray, window: int, k: int) -> np.ndarray:
    """Per window of ``window`` words, the fingerprint it keeps: its least k-gram hash (the rightmost of equal ones stands
    for it; equal hashes have the same value, so the value is all that is needed)."""
    g = gram_hashes(words, k)
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, _U)
    least = g[:n]
    for j in range(1, window - k + 1):
        least = np.minimum(least, g[j:j + n])
    return least


def _columns(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts after one another, and the offsets of each."""
    t = pc.fill_null(pc.cast(text, pa.large_string()), "")
    t = pa.concat_arrays([t])
    offsets = np.frombuffer(t.buffers()[1], np.int64)[t.offset:t.offset + len(t) + 1]
    data = np.frombuffer(t.buffers()[2], np.uint8) if t.buffers()[2] is not None else np.zeros(0, np.uint8)
    return _LOWER[data[offsets[0]:offsets[-1]]] if len(t) else data[:0], offsets - offsets[0]


def by_bytes(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about BLOCK bytes of text, so that a task's arrays stay small."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size) // BLOCK
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(size)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def _windows_of(data, offsets, window: int, k: int, short: list[int], screen, whole_only: bool):
    """(text index, first word, words, hash, joined words) of the windows that pass ``screen``, and words per text."""
    starts, ends = word_spans(data, offsets[:-1][offsets[:-1] < len(data)])
    owner = np.searchsorted(offsets, starts, "right") - 1               # empty texts share a start: the last has the bytes
    n_words = np.bincount(owner, minlength=len(offsets) - 1).astype(np.int64)
    hashes = word_hashes(data, starts, ends)
    raw, found = data.tobytes(), []
    for size in [window, *short]:
        fp = window_fingerprints(hashes, window, k) if size == window else gram_hashes(hashes, size)
        if not len(fp):
            continue
        ok = (owner[:len(fp)] == owner[size - 1:size - 1 + len(fp)])
        if whole_only and size != window:
            ok &= n_words[owner[:len(fp)]] == size
        if screen is not None:
            table, bits = screen
            at = (fp >> _U(64 - bits)).astype(np.int64)
            ok &= (table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        first = np.cumsum(n_words) - n_words
        for i in np.flatnonzero(ok):
            words = [raw[s:e] for s, e in zip(starts[i:i + size], ends[i:i + size])]
            found.append((int(owner[i]), int(i - first[owner[i]]), size, int(fp[i].view(np.int64)), b" ".join(words).decode()))
    return found, n_words


_WINS = "array<struct<start: int, len: int, h: bigint, win: string>>"


def windows(texts: DataFrame, window: int, k: int, short: list[int], screen, whole_only: bool) -> DataFrame:
    """``_k1, _k2, id, n_words, wins`` of a table ``_k1, _k2, id, text``."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("len", pa.int32()), ("h", pa.int64()), ("win", pa.string())]))
    table = (np.frombuffer(screen[0], np.uint8), screen[1]) if screen else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            data, offsets = _columns(batch.column("text"))
            found, n_words = _windows_of(data, offsets, window, k, short, table, whole_only)
            per = [[] for _ in range(batch.num_rows)]
            for who, *w in found:
                per[who].append(dict(zip(("start", "len", "h", "win"), w)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("_k1", "_k2", "id")], pa.array(n_words), pa.array(per, kind)],
                                             names=["_k1", "_k2", "id", "n_words", "wins"])

    return texts.mapInArrow(run, f"_k1 long, _k2 long, id {texts.schema['id'].dataType.simpleString()}, n_words long, wins {_WINS}")


def keyed(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return texts.select(*row_key(id_col, text_col), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def benchmark_windows(benchmark: DataFrame, window: int, k: int, id_col: str, text_col: str) -> DataFrame:
    """``h, len, win, class, items``: the distinct windows of all items, written. An item of fewer words is one window."""
    got = windows(keyed(benchmark, id_col, text_col), window, k, list(range(1, window)), None, True)
    w = got.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("item"), F.explode("wins").alias("w")).select("item", "w.*")
    w = w.groupBy("h", "len", "win").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return written(w.withColumn("class", F.xxhash64("len", "win")), "bench-windows")


def screen_table(classes: DataFrame) -> tuple[bytes, int]:
    """(bit table, bits of its index) over the fingerprints; built as 4 KB bitmaps that Spark aggregates."""
    n = classes.count()
    bits = min(MAX_SCREEN_BITS, max(16, math.ceil(math.log2(max(1, n) * 64))))
    at = F.shiftrightunsigned("h", 64 - bits)
    maps = (classes.select((at / 32768).cast("long").alias("bucket"), F.pmod(at, F.lit(32768)).alias("pos"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("pos").alias("bitmap")).collect())   # at most 2^(bits-15) rows of 4 KB
    table = bytearray(1 << max(12, bits - 3))
    for r in maps:
        table[r["bucket"] * 4096:(r["bucket"] + 1) * 4096] = r["bitmap"]
    return bytes(table), bits


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, k: int = 7, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(rows, spans)``.

    rows: one per document, ``id, _k1, _k2, n_words, n_hit, items`` (sorted array of item ids as text).
    spans: ``_k1, _k2, first, last``: merged runs of hit words (0-based, last included).
    """
    classes = benchmark_windows(benchmark, window, k, item_col, item_text_col)
    short = sorted(r["len"] for r in classes.filter(F.col("len") < window).select("len").distinct().collect())   # under ``window`` rows
    screened = written(windows(keyed(docs, id_col, text_col), window, k, short, screen_table(classes), False), "winnowed")
    cand = screened.filter(F.size("wins") > 0).select("_k1", "_k2", F.explode("wins").alias("w")).select("_k1", "_k2", "w.*")
    cand = written(cand.distinct(), "winnow-hits")
    count = cand.groupBy("h", "len", "win").agg(F.count("*").alias("w"))
    met = written(classes.join(count, ["h", "len", "win"]), "winnow-met")
    hits = written(lookup(cand, met.select("h", "len", "win", "class", "w"), ["h", "len", "win"], "w", ["_k1", "start"])
                   .filter("class is not null").select("_k1", "_k2", "start", "len", "class"), "winnow-verified")
    # merged spans: a hit starts a new span where it lies beyond all earlier ends
    w = Window.partitionBy("_k1", "_k2").orderBy("start", "len")
    end = F.col("start") + F.col("len")
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = hits.withColumn("new", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int")).withColumn("span", F.sum("new").over(w))
    spans = runs.groupBy("_k1", "_k2", "span").agg(F.min("start").alias("first"), (F.max(end) - 1).alias("last")).drop("span")
    spans = written(spans, "winnow-spans")
    n_hit = spans.groupBy("_k1", "_k2").agg(F.sum(F.col("last") - F.col("first") + 1).cast("long").alias("n_hit"))
    pairs = written(hits.select("_k1", "_k2", "class").distinct(), "winnow-pairs")
    per_class = pairs.groupBy("class").agg(F.count("*").alias("w"))
    names = written(met.groupBy("class").agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")).join(per_class, "class"), "winnow-items")
    items = (lookup(pairs, names, ["class"], "w", ["_k1"]).groupBy("_k1", "_k2")
             .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
    found = n_hit.join(items, ["_k1", "_k2"])
    rows = screened.select("id", "_k1", "_k2", "n_words").join(found, ["_k1", "_k2"], "left")
    return rows.select("id", "_k1", "_k2", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                       F.coalesce("items", F.array().cast("array<string>")).alias("items")), spans


def contaminated(rows: DataFrame, share: int = 20):
    """The contract's rule: at least one word in ``share`` is hit."""
    return (rows["n_hit"] > 0) & (rows["n_hit"] * share >= rows["n_words"])
