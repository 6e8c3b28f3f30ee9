"""Toxic spans by a linear-chain conditional random field.

Two states, clean and toxic, over a document's words. A word's features are hashes of the whole word and of its first
3 to 12 bytes (if it goes on after them); the field has one weight per chosen feature, weights for toxic neighbours, transitions and a start weight.

Labels are given per document, so token labels are derived: features whose documents are toxic with high
confidence are chosen greedily, each from the toxic documents that no earlier one explains (so
words that only ride along in copies of toxic texts are left out); a token is labelled toxic if it is in a toxic document and
carries a chosen feature. The field is then trained on those tokens by its likelihood's gradient.

Scoring runs forward-backward over every token of every text. A document's score comes from its marginals: a
logistic curve, fitted on training documents, over the largest marginal's log-odds and the expected number
of toxic tokens. Neighbouring tokens with a marginal of at least one half form a span.

Fitting uses a bounded sample: at most ``sample_docs`` labelled documents per class, in hash order of their id. The features, the
field and the curve are fitted on all of them, whole texts whatever their length; the likelihood's gradient is summed over groups of
documents of about GROUP_TOKENS tokens, which bounds memory and drops nothing. Everything else covers all rows.

Defined results: null text has no words and gets the score of a text without toxic words; without any toxic or any clean label, or
without a sampled text of one class (which warns), the score is the share of toxic labels (0 without labels); repeated rows score alike; a null label or id
is no training row; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrospark.llm.common import row_key, written
from agrospark.llm.decontam import _DOWN, _columns, _mixed, by_bytes, hash_runs, word_spans

PREFIXES = tuple(range(3, 13))
#: least confidence that documents with a feature are toxic, tried in turn; least number of such documents
LEVELS, MIN_DOCS, Z = (0.95, 0.9, 0.8, 0.65, 0.5), 5, 1.96
SCREEN_BITS = 20
#: tokens of the documents whose gradient is taken at a time (a longer text is a group of its own)
GROUP_TOKENS = 100_000


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text index of the words of lower-cased UTF-8 bytes; typographic marks separate words too."""
    wide = (data[:-2] == 0xE2) & ((data[1:-1] == 0x80) | (data[1:-1] == 0x81)) if len(data) > 2 else np.zeros(0, bool)
    marks = (data[:-1] == 0xC2) & ((data[1:] == 0xA0) | (data[1:] == 0xAB) | (data[1:] == 0xBB)) if len(data) > 1 else np.zeros(0, bool)
    clean = data
    if wide.any() or marks.any():
        clean = data.copy()
        for found, n in ((wide, 3), (marks, 2)):
            at = np.flatnonzero(found)
            for j in range(n):
                clean[at + j] = 32
    starts, ends = word_spans(clean, offsets[:-1][offsets[:-1] < len(data)])
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(kinds, tokens) feature hashes: prefixes, then the whole word. 0: the word does not go on after the prefix."""
    lengths = [*PREFIXES, 1 << 62]
    out = np.zeros((len(lengths), len(starts)), np.uint64)
    for rows, run, s, e in hash_runs(data, starts, ends):
        for kind, n in enumerate(lengths):
            if n < 1 << 62:
                longer = np.flatnonzero(e - s > n)
                at = s[longer]
                out[kind, rows.start + longer] = _mixed((run[at + n] - run[at]) * _DOWN[at] + np.uint64(n))
            else:
                out[kind, rows] = _mixed((run[e] - run[s]) * _DOWN[s])
    return out


# ------------------------------------------------------------------ the field
@dataclass
class Field:
    """Weights, all as log-odds of toxic against clean."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))     # chosen features, sorted
    emit: np.ndarray = field(default_factory=lambda: np.zeros(0))                # their weights
    near: np.ndarray = field(default_factory=lambda: np.zeros(2))                # word before / after carries a chosen feature
    first: float = -8.0
    step: np.ndarray = field(default_factory=lambda: np.array([-8.0, -4.0]))     # into toxic from clean / from toxic
    curve: np.ndarray = field(default_factory=lambda: np.array([0.0, 0.0, 0.0])) # bias, log-odds of the largest marginal, log(1 + expected tokens)


def lexicon_hits(model_keys: np.ndarray, feats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token, index of key) of every chosen feature that a token carries."""
    if not len(model_keys) or not feats.shape[1]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    shift = np.uint64(64 - SCREEN_BITS)
    screen = np.zeros(1 << SCREEN_BITS, bool)
    screen[(model_keys >> shift).astype(np.int64)] = True
    tok, key = [], []
    for f in feats:
        maybe = np.flatnonzero(screen[(f >> shift).astype(np.int64)])
        at = np.minimum(np.searchsorted(model_keys, f[maybe]), len(model_keys) - 1)
        same = model_keys[at] == f[maybe]
        tok.append(maybe[same])
        key.append(at[same])
    return np.concatenate(tok), np.concatenate(key)


def _settle(update, start: np.ndarray) -> np.ndarray:
    """Fixed point of a chain recursion, all positions at once: after n rounds the first n positions of every chain
    are exact; rounds end when nothing moves, which contraction brings about long before."""
    x = start
    while True:
        y = update(x)
        if not len(y) or np.max(np.abs(y - x) / (np.abs(y) + 1e-300)) < 1e-10:
            return y
        x = y


def forward_backward(m: Field, odds: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token, toxic-to-clean ratios of the forward and backward messages, and the toxic marginal.

    ``odds``: emission ratios; ``begins``: True where a chain starts.
    """
    n = len(odds)
    if not n:
        return odds, odds, odds
    t01, t11 = np.exp(m.step)
    ends = np.append(begins[1:], True)
    head = math.exp(m.first)

    def ahead(r):
        prev = np.empty(n)
        prev[0], prev[1:] = 0, r[:-1]
        return odds * np.where(begins, head, (t01 + prev * t11) / (1 + prev))

    def back(b):
        nxt = np.empty(n)
        nxt[-1], nxt[:-1] = 0, odds[1:] * b[1:]
        return np.where(ends, 1.0, (1 + t11 * nxt) / (1 + t01 * nxt))

    r, b = _settle(ahead, odds * t01), _settle(back, np.ones(n))
    both = r * b
    return r, b, both / (1 + both)


def emission(m: Field, n: int, tok: np.ndarray, key: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log emission ratio per token, and whether the word before / after it carries a chosen feature."""
    has = np.zeros(n, bool)
    has[tok] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = has[:-1], has[1:]
    before &= ~begins
    after &= ~np.append(begins[1:], True) if n else after
    e = np.bincount(tok, m.emit[key], minlength=n) if len(tok) else np.zeros(n)
    return np.clip(e + before * m.near[0] + after * m.near[1], -30, 30), before, after


def fit_field(keys: np.ndarray, groups, rounds: int = 60, rate: float = 0.3, l2: float = 1e-3) -> Field:
    """Gradient ascent (Adam) on the regularised log-likelihood of token labels.

    ``groups``: ``(tok, key, begins, y)`` of whole documents each; their gradients add up.
    """
    m = Field(keys=keys, emit=np.full(len(keys), 4.0))
    k = len(keys)
    theta = np.concatenate([m.emit, m.near, [m.first], m.step])
    g1, g2 = np.zeros_like(theta), np.zeros_like(theta)
    n_toxic = max(1, sum(y.sum() for _, _, _, y in groups))
    for i in range(1, rounds + 1):
        m.emit, m.near, m.first, m.step = theta[:k], theta[k:k + 2], theta[k + 2], theta[k + 3:]
        grad = sum((_gradient(m, *g) for g in groups), np.zeros_like(theta)) / n_toxic - l2 * theta
        g1, g2 = 0.9 * g1 + 0.1 * grad, 0.99 * g2 + 0.01 * grad ** 2
        theta = np.clip(theta + rate * (g1 / (1 - 0.9 ** i)) / (np.sqrt(g2 / (1 - 0.99 ** i)) + 1e-6), -12, 12)
    m.emit, m.near, m.first, m.step = theta[:k], theta[k:k + 2], float(theta[k + 2]), theta[k + 3:]
    return m


def _gradient(m: Field, tok, key, begins, y) -> np.ndarray:
    """Gradient of the log-likelihood of token labels ``y``."""
    was = np.append(0, y[:-1])
    inner = ~begins
    e, before, after = emission(m, len(y), tok, key, begins)
    odds = np.exp(e)
    r, b, p = forward_backward(m, odds, begins)
    prev = np.append(0, r[:-1])
    t01, t11 = np.exp(m.step)
    to1 = odds * b
    z = (1 + prev) + (t01 + prev * t11) * to1
    x01, x11 = np.where(inner, t01 * to1 / z, 0), np.where(inner, prev * t11 * to1 / z, 0)
    err = y - p
    return np.concatenate([np.bincount(key, err[tok], minlength=len(m.keys)), [err[before].sum(), err[after].sum()], [err[begins].sum()],
                           [((was == 0) & (y == 1) & inner).sum() - x01.sum(), ((was == 1) & (y == 1) & inner).sum() - x11.sum()]])


def document_inputs(p: np.ndarray, owner: np.ndarray, n_docs: int) -> np.ndarray:
    """(docs, 3) inputs of the score's curve from token marginals; a text without words has the least log-odds."""
    top = np.full(n_docs, 1e-9)
    np.maximum.at(top, owner, np.clip(p, 1e-9, 1 - 1e-9))
    mass = np.bincount(owner, p, minlength=n_docs)
    return np.stack([np.ones(n_docs), np.clip(np.log(top / (1 - top)), -12, 12), np.log1p(mass)], axis=1)


def fit_curve(x: np.ndarray, y: np.ndarray, w: np.ndarray, l2: float = 1e-2) -> np.ndarray:
    """Weighted logistic regression by Newton steps, slopes kept from falling below zero (more toxic marginals never lower a score)."""
    c = np.zeros(x.shape[1])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        grad = x.T @ (w * (y - q)) - l2 * c
        hess = (x * (w * q * (1 - q) + 1e-9)[:, None]).T @ x + l2 * np.eye(len(c))
        c = c + np.clip(np.linalg.solve(hess, grad), -2, 2)
    falling = np.flatnonzero(c[1:] < 0) + 1
    if len(falling):                                       # fit again without inputs whose slope fell below zero
        keep = np.setdiff1d(np.arange(len(c)), falling)
        c[:] = 0
        c[keep] = fit_curve(x[:, keep], y, w, l2)
    return c


# ------------------------------------------------------------------ training rows
def held_out(id_col: str = "doc_id") -> Column:
    """Rows never trained on: crc32(id as text) mod 4 is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))


def _labelled_sample(docs, labels, id_col, text_col, label_col, n):
    """Texts and labels of at most ``n`` training ids per class, in hash order."""
    train = labels.filter(~held_out(id_col) & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("y"))
    size = {r["y"]: r["c"] for r in train.groupBy("y").agg(F.count("*").alias("c")).collect()}
    pick = None
    for y in (0, 1):
        part = train.filter(F.col("y") == y).orderBy(F.xxhash64("l_id"), "l_id").limit(n)
        pick = part if pick is None else pick.unionByName(part)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return written(rows.join(F.broadcast(pick), rows["id"] == pick["l_id"]).select("text", "y"), "toxic-sample"), size   # at most 2n rows are broadcast


def _wilson(hits, n):
    """Lower confidence bound of a share."""
    n = np.maximum(n, 1e-9)
    s = np.minimum(hits / n, 1)
    return (s + Z * Z / (2 * n) - Z * np.sqrt(s * (1 - s) / n + Z * Z / (4 * n * n))) / (1 + Z * Z / n)


def _candidates(sample: DataFrame, clean_weight: float, most: int) -> np.ndarray:
    """Features that enough toxic and few clean sample documents hold; counted in Spark, at most ``most`` of them."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            data, offsets = _columns(batch.column("text"))
            y = batch.column("y").to_numpy(zero_copy_only=False)
            starts, ends, owner = tokens(data, offsets)
            f = features(data, starts, ends)
            pair = np.stack([np.tile(owner, len(f)).astype(np.uint64), f.ravel()], axis=1)
            pair = pair[pair[:, 1] != 0]
            order = np.lexsort((pair[:, 0], pair[:, 1]))
            pair = pair[order]
            new = np.ones(len(pair), bool)
            new[1:] = (pair[1:] != pair[:-1]).any(axis=1)
            pair = pair[new]
            keys, at = np.unique(pair[:, 1], return_inverse=True)
            toxic = np.bincount(at, y[pair[:, 0].astype(np.int64)] == 1, minlength=len(keys)).astype(np.int64)
            total = np.bincount(at, minlength=len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(toxic), pa.array(total - toxic)], names=["f", "t", "c"])

    sums = sample.mapInArrow(count, "f long, t long, c long").groupBy("f").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    rows = (sums.filter((F.col("t") >= MIN_DOCS) & (F.col("t") >= min(LEVELS) * (F.col("t") + F.col("c") * clean_weight)))
            .orderBy(F.col("t").desc(), "f").limit(most).toPandas())
    return np.sort(rows["f"].to_numpy(np.int64).view(np.uint64))


def _encode(sample: DataFrame, keys: np.ndarray) -> pd.DataFrame:
    """Per distinct sample text: label, hash, number of tokens, and its (token, key) pairs. No text leaves the executors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            data, offsets = _columns(batch.column("text"))
            starts, ends, owner = tokens(data, offsets)
            n = np.bincount(owner, minlength=batch.num_rows)
            base = np.cumsum(n) - n
            tok, key = lexicon_hits(keys, features(data, starts, ends))
            order = np.lexsort((key, tok))
            tok, key = tok[order], key[order]
            cuts = np.searchsorted(owner[tok], np.arange(batch.num_rows + 1))
            per = lambda x: pa.array([x[a:b] for a, b in zip(cuts, cuts[1:])], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("h"), pa.array(n.astype(np.int64)), per(tok - base[owner[tok]]), per(key)],
                                             names=["y", "h", "n", "tok", "key"])

    got = sample.select("text", "y", F.xxhash64("text").alias("h")).mapInArrow(run, "y int, h long, n long, tok array<long>, key array<long>")
    return got.toPandas().sort_values(["h", "y"]).drop_duplicates("h", ignore_index=True)


def choose(rows: pd.DataFrame, n_keys: int, clean_weight: float) -> np.ndarray:
    """Indices of the features that explain the toxic documents."""
    y = rows["y"].to_numpy()
    per = [np.unique(k).astype(np.int64) if len(k) else np.zeros(0, np.int64) for k in rows["key"]]
    clean = np.bincount(np.concatenate([np.zeros(0, np.int64), *[k for k, v in zip(per, y) if v == 0]]), minlength=n_keys) * clean_weight
    toxic = [k for k, v in zip(per, y) if v == 1]
    holders = [[] for _ in range(n_keys)]
    for d, k in enumerate(toxic):
        for f in k:
            holders[f].append(d)
    cover = np.array([len(h) for h in holders], np.int64) if n_keys else np.zeros(0, np.int64)
    open_ = np.ones(len(toxic), bool)
    chosen = []
    for level in LEVELS:
        while n_keys:
            ok = (cover >= MIN_DOCS) & (_wilson(cover, cover + clean) >= level)
            if not ok.any():
                break
            best = int(np.argmax(np.where(ok, cover, -1)))
            chosen.append(best)
            for d in holders[best]:
                if open_[d]:
                    open_[d] = False
                    cover[toxic[d]] -= 1
    return np.array(sorted(chosen), np.int64)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample_docs: int = 4000, most_features: int = 20_000) -> Field:
    sample, size = _labelled_sample(docs, labels, id_col, text_col, label_col, sample_docs)
    n0, n1 = size.get(0, 0), size.get(1, 0)
    base = (n1 + 0.0) / max(1, n0 + n1)
    flat = Field(curve=np.array([math.log((base + 1e-6) / (1 - base + 1e-6)), 0.0, 0.0]))
    if not n0 or not n1:
        return flat
    weight = (n0 / min(n0, sample_docs)) / (n1 / min(n1, sample_docs))            # a clean sample row stands for that many
    keys = _candidates(sample, weight, most_features)
    rows = _encode(sample, keys)
    rows = rows[(rows["n"] > 0).to_numpy()].reset_index(drop=True)
    missing = {0, 1} - set(rows["y"])
    if missing:
        names = " or ".join(("clean", "toxic")[y] for y in sorted(missing))
        warnings.warn(f"no labelled {names} document has words: every score is the share of toxic labels, {base:.3f}", stacklevel=2)
        return flat
    chosen = choose(rows, len(keys), weight)
    if not len(chosen):
        return flat
    back = np.full(len(keys), -1)
    back[chosen] = np.arange(len(chosen))
    of = ((rows["n"].cumsum() - rows["n"]) // GROUP_TOKENS).to_numpy()                       # group of each document
    parts = [rows[of == g] for g in np.unique(of)]

    def chain(some: pd.DataFrame):
        n = some["n"].to_numpy()
        base = np.cumsum(n) - n
        tok = np.concatenate([np.zeros(0, np.int64), *[np.asarray(t, np.int64) + b for t, b in zip(some["tok"], base)]])
        key = back[np.concatenate([np.zeros(0, np.int64), *[np.asarray(k, np.int64) for k in some["key"]]])]
        tok, key = tok[key >= 0], key[key >= 0]
        begins = np.zeros(n.sum(), bool)
        begins[base] = True
        y = np.zeros(len(begins), np.int8)
        y[tok] = np.repeat(some["y"].to_numpy(), n)[tok]
        return tok, key, begins, y

    groups = [chain(p) for p in parts]
    m = fit_field(keys[chosen], groups)
    inputs = []
    for part, (tok, key, begins, _) in zip(parts, groups):
        e, _, _ = emission(m, len(begins), tok, key, begins)
        p = forward_backward(m, np.exp(e), begins)[2]
        inputs.append(document_inputs(p, np.cumsum(begins) - 1, len(part)))
    label = rows["y"].to_numpy().astype(float)
    m.curve = fit_curve(np.concatenate(inputs), label, np.where(label == 1, 1.0, weight))
    return m


# ------------------------------------------------------------------ scoring
def _spans(data, offsets, starts, ends, owner, p, n_docs):
    """Per text, merged runs of tokens with a marginal of at least one half: code point offsets and largest marginal."""
    per = [[] for _ in range(n_docs)]
    hot = np.flatnonzero(p >= 0.5)
    if not len(hot):
        return per
    lead = np.cumsum((data & 0xC0) != 0x80)                    # code points up to and with a byte
    at = lambda i: int(lead[i - 1]) if i else 0
    for run in np.split(hot, np.flatnonzero((np.diff(hot) > 1) | (np.diff(owner[hot]) > 0)) + 1):
        d = owner[run[0]]
        zero = at(offsets[d])
        per[d].append({"start": at(starts[run[0]]) - zero, "end": at(ends[run[-1]]) - zero, "p": float(p[run].max())})
    return per


def score(docs: DataFrame, m: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_k1, _k2, id, score, spans`` of every row; spans are code point offsets (end excluded) with their largest marginal."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            data, offsets = _columns(batch.column("text"))
            starts, ends, owner = tokens(data, offsets)
            tok, key = lexicon_hits(m.keys, features(data, starts, ends)) if len(m.keys) else (np.zeros(0, np.int64),) * 2
            begins = np.ones(len(starts), bool)
            begins[1:] = owner[1:] != owner[:-1]
            e, _, _ = emission(m, len(starts), tok, key, begins)
            p = forward_backward(m, np.exp(e), begins)[2]
            s = 1 / (1 + np.exp(-np.clip(document_inputs(p, owner, batch.num_rows) @ m.curve, -30, 30)))
            spans = _spans(data, offsets, starts, ends, owner, p, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("_k1", "_k2", "id")], pa.array(s), pa.array(spans, kind)],
                                             names=["_k1", "_k2", "id", "score", "spans"])

    rows = docs.select(*row_key(id_col, text_col), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"_k1 long, _k2 long, id {rows.schema['id'].dataType.simpleString()}, score double, "
                                "spans array<struct<start: long, end: long, p: double>>")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             threshold: float = 0.3, **bounds) -> DataFrame:
    """Fit on labelled rows outside the held-out quarter and score every document:
    ``_k1, _k2, id, held_out, score, predicted, spans``."""
    got = score(docs, fit(docs, labels, id_col, text_col, label_col, **bounds), id_col, text_col)
    return got.select("_k1", "_k2", "id", held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
