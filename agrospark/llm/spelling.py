"""Spelling variant grouping by reduced-alphabet generation.

Letters are hashed to a few symbols. Of every word's reduced form the full one-edit neighbourhood is generated (itself, every
replacement, deletion and insertion over the small alphabet) and joined with the vocabulary's reduced forms: words
one edit apart have reduced forms at most one edit apart, so no pair is missed. Every pair that meets is verified on the original strings.

Forms are 64-bit polynomial hashes mod 2^64 that numpy derives from prefix sums, so a word of L letters costs O(L), not
O(L^2), however long it is. Two bit tables of the vocabulary's forms (at most 2^27 bits each whatever the vocabulary) go to every task and
spare the neighbours that nobody has; the join decides.

A reduced form that more than ``crowd`` words share is not paired at this level: whoever reaches it tries again at the
next level, whose alphabet is larger, among the crowded words only; at the last level every letter is its own symbol. So either word finds the other
exactly once (one of the two finds is kept), and no bucket is ever paired with itself in full.

Words are counted once per task in Python and combined before the shuffle; a document may be of any length.

Defined results: null or empty text has no runs; a null id counts as empty text in the checksum; repeated rows count again; an empty
table gives an empty result; further columns are ignored; words are compared by code point and ordered by code point.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrospark.llm.common import hash128, lookup, ship, written
from agrospark.llm.decontam import by_bytes, screen_table

#: runs of letters, after A-Z became a-z
RUN = "[a-zÀ-ÿ]"
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
#: distinct words a task holds before it hands their counts on
HELD = 200_000
#: letters of words whose neighbourhoods are generated at once
LETTERS_AT_ONCE = 1 << 14
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def planted(word: bytes, doc_id, one_in: int) -> str | None:
    """The word with one code point deleted where its checksum with the id says so, else None."""
    h = zlib.crc32(word, zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()))
    if h % one_in:
        return None
    w = word.decode()
    return w[:h % len(w)] + w[h % len(w) + 1:]


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = 7, min_count: int = 2, one_in: int = 31) -> DataFrame:
    """``word, n``: runs of letters after the rule of ``planted`` (``one_in`` 0: none), of at least so many code points and occurrences."""
    # a run of min_letters at least can end as a word of min_letters; shorter ones can't
    run_of = re.compile(RUN + "{%d,}" % min_letters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            got = pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return got

        for b in by_bytes(batches):
            for i, t in zip(b.column("id").to_pylist(), b.column("text").to_pylist()):
                if not t:
                    continue
                found = Counter(run_of.findall(t.encode().lower().decode()))      # bytes: ASCII letters only
                if one_in:
                    start = zlib.crc32(f"{'' if i is None else i}:".encode())
                    changed = [w for w in found if not zlib.crc32(w.encode(), start) % one_in]
                    for w in changed:
                        n, new = found.pop(w), planted(w.encode(), i, one_in)
                        if len(new) >= min_letters:
                            held[new] += n
                held.update(found)
                if len(held) > HELD:
                    yield out()
        yield out()

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# ---- reduced forms and their neighbourhoods ----

def symbols(words: list[str], q: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols 1.. of all words' letters after one another, and each word's offset. ``q`` 0: every letter of LETTERS its own."""
    cp = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(_U)
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    if q:
        mixed = cp * _U(_BASE)
        return (mixed >> _U(40)) % _U(q) + _U(1), offsets
    return np.searchsorted(np.array(LETTERS, _U), cp).astype(_U) % _U(len(LETTERS)) + _U(1), offsets


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, _U)
    p[:1] = 1
    return np.cumprod(p, dtype=_U)


def _mix(h: np.ndarray, length) -> np.ndarray:
    """The form's hash from its polynomial and its length."""
    h = h ^ (np.asarray(length, _U) * _U(0xD1342543DE82EF95))
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(29))) * _U(0xA0761D6478BD642F)
    return h ^ (h >> _U(32))


def forms(words: list[str], q: int) -> np.ndarray:
    """Hash of each word's reduced form: the sum of symbol * BASE^position."""
    s, offsets = symbols(words, q)
    lengths = np.diff(offsets)
    position = np.arange(len(s)) - np.repeat(offsets[:-1], lengths)
    run = np.concatenate([[_U(0)], np.cumsum(s * _powers(_BASE, int(lengths.max(initial=0)) + 1)[position], dtype=_U)])
    return _mix(run[offsets[1:]] - run[offsets[:-1]], lengths)


def neighbours(words: list[str], q: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word's index, hash of a form at most one edit away from its own), in pieces; a word may get a hash more than once."""
    size = q or len(LETTERS)
    s, offsets = symbols(words, q)
    lengths = np.diff(offsets)
    most = int(lengths.max(initial=0)) + 2
    up = _powers(_BASE, most)
    position = np.arange(len(s)) - np.repeat(offsets[:-1], lengths)
    owner = np.repeat(np.arange(len(words)), lengths)
    term = s * up[position]
    run = np.concatenate([[_U(0)], np.cumsum(term, dtype=_U)])
    total = run[offsets[1:]] - run[offsets[:-1]]
    yield np.arange(len(words)), _mix(total, lengths)
    for a in range(0, len(s), LETTERS_AT_ONCE):
        b = min(len(s), a + LETTERS_AT_ONCE)
        who, at = owner[a:b], position[a:b]
        before = run[a:b] - run[offsets[who]]
        after = run[offsets[who + 1]] - run[a + 1:b + 1]
        length = lengths[who]
        yield who, _mix(before + after * _U(_BACK), length - 1)
        for x in range(1, size + 1):
            other = s[a:b] != x
            yield who[other], _mix(before + _U(x) * up[at] + after, length)[other]
            # an insertion before each letter; one before an equal letter is the same as one behind it
            yield who[other], _mix(before + _U(x) * up[at] + (term[a:b] + after) * _U(_BASE), length + 1)[other]
    for x in range(1, size + 1):                                          # and at the end
        yield np.arange(len(words)), _mix(total + _U(x) * up[lengths], lengths + 1)


def _formed(words: DataFrame, q: int) -> DataFrame:
    """``_k1, _k2, h``: the hash of each word's reduced form."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches, "word"):
            h = forms(b.column("word").to_pylist(), q)
            yield pa.RecordBatch.from_arrays([b.column("_k1"), b.column("_k2"), pa.array(h.view(np.int64))], names=["_k1", "_k2", "h"])

    return words.select("_k1", "_k2", "word").mapInArrow(run, "_k1 long, _k2 long, h long")


def _screens(formed: DataFrame) -> list[tuple[bytes, int]]:
    """Two bit tables of the forms, by the upper and by the lower bits of their hashes."""
    turned = F.shiftleft("h", 32).bitwiseOR(F.shiftrightunsigned("h", 32))
    return [screen_table(formed.select("h")), screen_table(formed.select(turned.alias("h")))]


def _known(h: np.ndarray, screens: list[tuple[np.ndarray, int]]) -> np.ndarray:
    ok = np.ones(len(h), bool)
    for (table, bits), x in zip(screens, (h, h << _U(32) | h >> _U(32))):
        place = (x >> _U(64 - bits)).astype(np.int64)
        ok &= (table[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
    return ok


def _probes(words: DataFrame, q: int, screens: list[tuple[bytes, int]]) -> DataFrame:
    """``_k1, _k2, h``: of each word, the forms of its neighbourhood that the screens know."""
    tables = [(np.frombuffer(t, np.uint8), bits) for t, bits in screens]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in by_bytes(batches, "word"):
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                who, hits = [], []
                for i, h in neighbours(b.column("word").to_pylist(), q):
                    ok = _known(h, tables)
                    who.append(i[ok])
                    hits.append(h[ok])
                pair = np.unique(np.stack([np.concatenate(who).astype(_U), np.concatenate(hits)]), axis=1)
                rows = pa.array(pair[0].astype(np.int64))
                yield pa.RecordBatch.from_arrays([b.column("_k1").take(rows), b.column("_k2").take(rows), pa.array(pair[1].view(np.int64))], names=["_k1", "_k2", "h"])

    return words.select("_k1", "_k2", "word").mapInArrow(run, "_k1 long, _k2 long, h long")


def near_words(vocab: DataFrame, levels=(16, 0), crowd: int = 32) -> DataFrame:
    """``_k1, _k2, o1, o2``: keys of candidate pairs before verification, the lesser key first, each pair once.

    ``vocab``: ``_k1, _k2, word``, one row per word, written. ``levels``: symbols of each level, the last one 0 (all letters).
    """
    table, tries, found = vocab, vocab, None
    lesser = (F.col("_k1") < F.col("o1")) | ((F.col("_k1") == F.col("o1")) & (F.col("_k2") < F.col("o2")))
    for i, q in enumerate(levels):
        formed = written(_formed(table, q), "reduced")
        hits = _probes(tries, q, _screens(formed))
        last = i + 1 == len(levels)
        crowded = None if last else written(formed.groupBy("h").count().filter(F.col("count") > crowd).select("h"), "crowded")
        some = not last and crowded.limit(1).count() > 0
        hits = written(hits, "probes") if some else hits
        here = formed.join(crowded, "h", "left_anti") if some else formed
        got = hits.join(here.select("h", F.col("_k1").alias("o1"), F.col("_k2").alias("o2")), "h").drop("h").filter(lesser)
        found = got if found is None else found.unionByName(got)
        if not some:
            break
        again = hits.join(crowded, "h", "left_semi").select("_k1", "_k2").distinct()
        inside = formed.join(crowded, "h", "left_semi").select("_k1", "_k2")
        tries = written(vocab.join(again, ["_k1", "_k2"], "left_semi"), "tries")
        table = written(vocab.join(inside, ["_k1", "_k2"], "left_semi"), "crowded-words")
    return found


def spelling_variants(vocab: DataFrame, times: int = 10, levels=(16, 0), crowd: int = 32) -> tuple[DataFrame, DataFrame]:
    """``(words, pairs)`` of a table ``word, n``.

    words: ``word, n, n_near, form, form_n, root``. pairs: ``word, n, other, other_n`` (with keys): the near words, each pair once.
    """
    ship(vocab.sparkSession)
    vocab = written(vocab.select(*hash128(F.col("word"), "_k1", "_k2"), "word", "n"), "vocabulary")
    found = near_words(vocab, levels, crowd)
    other = vocab.select(F.col("_k1").alias("o1"), F.col("_k2").alias("o2"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    # a word has at most a few letters times the alphabet of near words, so no key of these joins is hot
    pairs = written(found.join(vocab, ["_k1", "_k2"]).join(other, ["o1", "o2"]).filter(F.levenshtein("word", "other", 1) == 1), "near-words")
    sides = [F.struct(F.col(a).alias("_k1"), F.col(b).alias("_k2"), F.struct((-F.col(n)).alias("less"), F.col(w).alias("other"), F.col(c).alias("o1"), F.col(d).alias("o2")).alias("b"))
             for a, b, c, d, w, n in (("_k1", "_k2", "o1", "o2", "other", "other_n"), ("o1", "o2", "_k1", "_k2", "word", "n"))]
    best = pairs.select(F.explode(F.array(*sides)).alias("x")).select("x.*").groupBy("_k1", "_k2").agg(F.count("*").alias("n_near"), F.min("b").alias("b"))
    has = -F.col("b.less") >= F.col("n") * times
    words = written(vocab.join(best, ["_k1", "_k2"], "left").select(
        "_k1", "_k2", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("b.other")).alias("form"),
        F.when(has, -F.col("b.less")).alias("form_n"), F.when(has, F.col("b.o1")).alias("f1"), F.when(has, F.col("b.o2")).alias("f2")), "forms")
    roots = _roots(words)
    return words.join(roots, ["_k1", "_k2"], "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")), pairs


def _roots(words: DataFrame) -> DataFrame:
    """``_k1, _k2, root`` of the words that have a form: each round replaces the end of a word's path by that end's own path. Paths are
    short (each step multiplies n), but an end may be shared by many words: the join goes through ``lookup``."""
    paths = written(words.filter("form is not null").select("_k1", "_k2", F.col("f1").alias("e1"), F.col("f2").alias("e2"), F.col("form").alias("root")), "paths")
    while True:
        count = paths.groupBy(F.col("e1").alias("_k1"), F.col("e2").alias("_k2")).agg(F.count("*").alias("w"))
        ends = written(count.join(paths, ["_k1", "_k2"]).select(F.col("_k1").alias("e1"), F.col("_k2").alias("e2"), F.col("e1").alias("t1"), F.col("e2").alias("t2"), F.col("root").alias("to"), "w"), "ends")
        if not ends.limit(1).count():
            return paths.select("_k1", "_k2", "root")
        got = lookup(paths, ends, ["e1", "e2"], "w", ["_k1"])
        paths = written(got.select("_k1", "_k2", F.coalesce("t1", "e1").alias("e1"), F.coalesce("t2", "e2").alias("e2"), F.coalesce("to", "root").alias("root")), "paths")
