"""Substring dedup by sliding spans of sentence parts.

Every run of several consecutive parts (at least ``run`` of them and ``min_words`` words, whichever needs more) is hashed,
one run from each part on; equal runs meet in one global shuffle, and the parts that any
non-first occurrence covers are removed. First is the occurrence in the smallest id, then the earliest in
its text. A sentence ends after a word that closes with one of .!?。！？ and before a line break. Every sentence, short or long, is
cut into parts after each word whose hash is the least of some ``window`` consecutive words of the sentence (the first, if several
are). So every ``window`` words have a cut, and whether there is one after a word depends on at most ``window - 1`` words on either
side: a passage is cut alike wherever it stands, but for that margin where it starts or ends inside a sentence. Equal sentences have
equal parts, so each repeated run of whole sentences that is long enough goes too, whole. A repeated stretch of
``min_words + 4 * window`` words is always found, in part also a single sentence.

Words are runs of code points without blanks, compared in lower case (letters beyond U+FFFF as they are); in scripts
written without blanks every code point is a word, and of a longer run each ``LONG`` code points.

Span rows are narrow (ids, offsets, 96-bit hash) and are never written. A task hashes some 4 MB of texts at a time with numpy and
sends one row per distinct run, the first occurrence; the others it has already told to be later ones, and sends as merged ranges
dealt by document. So a passage in a third of all documents is one row per 4 MB, and copies that stand together are one range.

Defined results: null text counts as empty, and stays so; a null id comes before all ids; identical rows share a result (they are one
document here: use exact dedup for them); an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrospark.llm.decontam import _mixed, _powers, by_bytes, word_hashes

#: code points of an unbroken run that are one word
LONG = 1 << 16
#: bytes of text whose runs are combined before the shuffle
TOGETHER = 4 << 20
_U = np.uint64
_Q1, _Q2 = 0xD1342543DE82EF95, 0xDA942042E4DD58B5                     # odd multipliers
_OTHER = _U(0x9E3779B97F4A7C15)
_BLANK, _DENSE, _END = 1, 2, 4
#: scripts without blanks between words: Thai, Lao, Burmese, Khmer, kana, Han
_DENSE_RANGES = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF)]
_DENSE_PLANES = (0x20000, 0x3FFFF)
_SPAN = "h1 long, h2 int, later boolean, id long, k long, at long"


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower case of each code point below 65536."""
    kind, lower = np.zeros(1 << 16, np.uint8), np.arange(1 << 16, dtype=np.uint32)
    for c in range(1 << 16):
        kind[c] = _BLANK if chr(c).isspace() else _END if chr(c) in ".!?。！？" else 0
        small = chr(c).lower()
        if len(small) == 1:
            lower[c] = ord(small)
    for a, b in _DENSE_RANGES:
        kind[a:b + 1] |= _DENSE
    return kind, lower


_KIND, _LOWER = _tables()


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``offsets`` of the texts in code points, and of all their words: starts, ends, hashes, and whether a sentence ends there."""
    offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]).astype(np.int64)
    data = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return offsets, none, none, none.astype(_U), none.astype(bool)
    low = np.minimum(data, 0xFFFF)
    kind = _KIND[low]
    kind[(data >= _DENSE_PLANES[0]) & (data <= _DENSE_PLANES[1])] |= _DENSE
    lines = np.flatnonzero(data == 10)
    data = np.where(data < 1 << 16, _LOWER[low], data)
    full, dense = kind & _BLANK == 0, kind & _DENSE != 0
    begin = dense.copy()
    begin[0] = True
    begin[1:] |= ~full[:-1] | dense[:-1]
    begin[offsets[:-1][offsets[:-1] < n]] = True
    begin &= full
    close = np.append(begin[1:] | ~full[1:], True) & full
    starts, ends = np.flatnonzero(begin), np.flatnonzero(close) + 1
    big = np.flatnonzero(ends - starts > LONG)
    if len(big):
        inside = np.concatenate([np.arange(starts[i] + LONG, ends[i], LONG) for i in big])
        starts, ends = np.sort(np.append(starts, inside)), np.sort(np.append(ends, inside))
    if not len(starts):
        return offsets, starts, ends, starts.astype(_U), starts.astype(bool)
    stop = kind[ends - 1] & _END != 0
    upto = np.append(starts[1:], n)
    stop |= np.searchsorted(lines, ends) < np.searchsorted(lines, upto)
    stop |= np.searchsorted(offsets, ends) <= np.searchsorted(offsets, upto, "right") - 1
    stop[-1] = True
    return offsets, starts, ends, word_hashes(data, starts, ends), stop


def cuts_after(hashes: np.ndarray, stop: np.ndarray, window: int) -> np.ndarray:
    """Words with a cut after them: sentence ends, and the first least hash of each ``window`` words of a sentence."""
    last, m = stop.copy(), len(hashes) - window + 1
    if m > 0:
        sentence = np.cumsum(stop) - stop
        least, at = hashes[:m].copy(), np.arange(m)
        for j in range(1, window):
            less = hashes[j:j + m] < least
            least[less] = hashes[j:j + m][less]
            at[less] = np.flatnonzero(less) + j
        last[at[sentence[:m] == sentence[window - 1:]]] = True
    return last


def _run_hashes(words: np.ndarray, a: np.ndarray, b: np.ndarray, base: int) -> np.ndarray:
    """Hash of words a .. b-1, as a difference of running sums."""
    total = np.concatenate([[_U(0)], np.cumsum(words * _powers(base, len(words) + 1)[:-1], dtype=_U)])
    return _mixed((total[b] - total[a]) * _powers(pow(base, -1, 1 << 64), len(words) + 1)[a] + (b - a).astype(_U))


def runs(texts: list[str], run: int, min_words: int, window: int = 8) -> tuple[np.ndarray, ...]:
    """(text, start, stop, h1, h2) of the shortest long enough run of parts from each part on, by text and place.

    Parts cover a text without gaps: blanks belong to the part before, those ahead of all words to the first.
    """
    offsets, starts, _, hashes, stop = words_of(texts)
    closes = np.flatnonzero(cuts_after(hashes, stop, window)) + 1                # parts: words opens[i] .. closes[i]-1
    opens = np.append(0, closes)[:-1]
    owner = np.searchsorted(offsets, starts[opens], "right") - 1
    new = np.append(True, owner[1:] != owner[:-1])[:len(owner)]
    begin = np.where(new, offsets[owner], starts[opens])
    finish = np.where(np.append(new[1:], True)[:len(owner)], offsets[owner + 1], np.append(begin[1:], 0)[:len(owner)])
    i = np.arange(len(opens))
    j = np.maximum(i + run, np.searchsorted(closes, opens + min_words) + 1)
    i, j = i[j <= len(opens)], j[j <= len(opens)]
    ok = owner[i] == owner[j - 1]
    i, j = i[ok], j[ok]
    a, b, base = opens[i], closes[j - 1], offsets[owner[i]]
    h2 = _run_hashes(_mixed(hashes ^ _OTHER), a, b, _Q2) >> _U(32)
    return owner[i], begin[i] - base, finish[j - 1] - base, _run_hashes(hashes, a, b, _Q1).view(np.int64), h2.astype(np.uint32).view(np.int32)


def _first_places(rank: np.ndarray, start: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of these runs, one row of each hash's first place, and flags of the runs that stand at another place."""
    order = np.lexsort((start, rank, h2, h1))
    a, b = order[1:], order[:-1]
    head = np.append(True, (h1[a] != h1[b]) | (h2[a] != h2[b]))[:len(order)]
    first = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    later = np.zeros(len(order), bool)
    later[order] = (rank[order] != rank[first]) | (start[order] != start[first])
    return order[head], later


def _together(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Tables of about ``limit`` bytes of text (a longer text stands with at most as much before it)."""
    held, size = [], 0
    for b in by_bytes(batches):
        held, size = [*held, b], size + (pc.sum(pc.binary_length(b.column("text"))).as_py() or 0)
        if size >= limit:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def spans(docs: DataFrame, run: int, min_words: int, id_col: str, text_col: str, together: int = TOGETHER) -> DataFrame:
    """Rows ``h1, h2, later, id, k, at``: row key (id, k) and code point offsets as start << 32 | stop.

    later false: first occurrence, among the texts hashed together, of the run with that hash. later true: a merged range
    of runs that have an earlier occurrence among these texts; its hash only spreads the rows.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _together(batches, together):
            id_, known, k = (t.column(c).to_numpy() for c in ("id", "known", "k"))
            key, rank = np.unique(np.rec.fromarrays([known, id_, k]), return_inverse=True)
            doc, start, stop, h1, h2 = runs(t.column("text").to_pylist(), run, min_words)
            head, later = _first_places(rank[doc], start, h1, h2)
            i = np.flatnonzero(later)                                # by document and place; stops never decrease in a document
            new = np.append(True, (doc[i][1:] != doc[i][:-1]) | (start[i][1:] > stop[i][:-1]))[:len(i)]
            a, b = i[new], i[np.append(new[1:], True)[:len(i)]]
            d = np.append(doc[head], doc[a])
            spread = k[doc[a]] ^ (start[a] * np.int64(0x9E3779B97F4A7C1))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.append(h1[head], spread)), pa.array(np.append(h2[head], np.zeros(len(a), np.int32))),
                pa.array(np.arange(len(d)) >= len(head)), pa.array(id_[d], mask=~known[d]), pa.array(k[d]),
                pa.array(np.append(start[head], start[a]) << 32 | np.append(stop[head], stop[b]))], names=["h1", "h2", "later", "id", "k", "at"])

    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.col(id_col).isNotNull().alias("known"), text_key(id_col, text_col),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).mapInArrow(work, _SPAN)


def text_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(text_col).isNull(), F.col(id_col).cast("long"), F.col(text_col)).alias("k")


def repeated(docs: DataFrame, run: int = 2, min_words: int = 12, id_col: str = "doc_id", text_col: str = "text", together: int = TOGETHER) -> DataFrame:
    """``id, k, start, stop``: code point ranges (end excluded) of the runs that stand elsewhere before."""
    w = Window.partitionBy("h1", "h2", "later").orderBy(F.col("id").asc_nulls_first(), "k", "at")
    got = spans(docs, run, min_words, id_col, text_col, together).withColumn("place", F.rank().over(w))      # identical rows share a place
    return got.filter("later or place > 1").select("id", "k", F.shiftright("at", 32).cast("int").alias("start"),
                                                   F.col("at").bitwiseAND((1 << 32) - 1).cast("int").alias("stop"))


def merged(ranges: DataFrame) -> DataFrame:
    """``id, k, cuts``: per document, disjoint ranges in order."""
    w = Window.partitionBy("id", "k").orderBy("start", "stop")
    reach = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    r = ranges.withColumn("new", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int")).withColumn("g", F.sum("new").over(w))
    r = r.groupBy("id", "k", "g").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return r.groupBy("id", "k").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("cuts"))


def cut_out(text: Column, cuts: Column) -> Column:
    """The text without the given ranges."""
    begin = F.concat(F.array(F.lit(0)), F.transform(cuts, lambda c: c["stop"]))
    end = F.concat(F.transform(cuts, lambda c: c["start"]), F.array(F.char_length(text)))
    kept = F.zip_with(begin, end, lambda b, e: F.struct(b.alias("b"), e.alias("e")))
    return F.array_join(F.transform(kept, lambda z: F.substr(text, z["b"] + 1, z["e"] - z["b"])), "")


def substring_dedup(docs: DataFrame, run: int = 2, min_words: int = 12, id_col: str = "doc_id", text_col: str = "text",
                    together: int = TOGETHER) -> DataFrame:
    """One row per document: ``id, text, cuts`` (code point ranges removed; null: none), ``n_removed`` (code points), ``kept_text``."""
    cuts = merged(repeated(docs, run, min_words, id_col, text_col, together)).select(F.col("id").alias("c_id"), F.col("k").alias("c_k"), "cuts")
    d = docs.select(F.col(id_col).cast("long").alias("id"), text_key(id_col, text_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    got = d.join(cuts, d["id"].eqNullSafe(cuts["c_id"]) & (d["k"] == cuts["c_k"]), "left")
    n = F.aggregate("cuts", F.lit(0).cast("long"), lambda a, c: a + c["stop"] - c["start"])
    return got.select("id", "text", "cuts", F.coalesce(n, F.lit(0).cast("long")).alias("n_removed"),
                      F.when(F.col("cuts").isNull(), F.col("text")).otherwise(cut_out(F.col("text"), F.col("cuts"))).alias("kept_text"))
