"""Plain Python versions of the contracts, for small tables."""

import hashlib
import re
from collections import defaultdict

import xxhash

BLANK = re.compile("[\x20\x09-\x0D]")


def words(rng, n, alphabet="abcdefgh"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 6))) for _ in range(n))


def collect(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t)


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def none_last(x):
    return (x is None, x if x is not None else 0)


def exact(docs):
    """Sorted (doc_id, keep_id, group_size, text_sha256)."""
    by = defaultdict(list)
    for i, t in docs:
        by[BLANK.sub("", t or "")].append((i, t or ""))
    out = []
    for n, rows in by.items():
        keep = min(rows, key=lambda r: (-len(r[1]), none_last(r[0])))[0]
        out += [(i, keep, len(rows), sha(n)) for i, _ in rows]
    return sorted(out, key=repr)


def targets(sizes):
    """{source: target} by repeated resharing; ``sizes`` {source: words}."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, t, full = float(sum(sizes.values())), {}, set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        t = {s: 3.0 * sizes[s] for s in full} | {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if t[s] > 3 * sizes[s]}
        if not over:
            return t
        full |= over


def decontam(docs, items, window=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    where = defaultdict(set)
    for item, t in items:
        w = words(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            where[tuple(w[i:i + n])].add("" if item is None else str(item))
    sizes = {len(k) for k in where}
    out = []
    for d, t in docs:
        w, hit, names = words(t), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if got := where.get(tuple(w[i:i + n])):
                    hit |= set(range(i, i + n))
                    names |= got
        out.append((d, len(w), len(hit), len(names), sha(",".join(sorted(names))), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def simhash(docs, shingle=3, bits=2):
    def fp(t):
        w = re.findall("[^\x20\x09-\x0D]+", lower(t or ""))
        if not w:
            return 0
        grams = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or [" ".join(w)]
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [(i, fp(t)) for i, t in docs]
    kinds = sorted({f for _, f in fps})
    root = {f: f for f in kinds}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(kinds):
        for b in kinds[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    least = {}
    for i, f in fps:
        r = find(f)
        least[r] = i if least.get(r) is None else least[r] if i is None else min(least[r], i)
    return sorted(((i, f"{f:016x}", least[find(f)]) for i, f in fps), key=repr)


def lines(docs, min_chars=20, min_docs=3):
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, t in docs:
        for x in (t or "").split("\n"):
            holders[key(x)].add(i)
    out = []
    for i, t in docs:
        rows = (t or "").split("\n")
        gone = [len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs and i != max(holders[key(x)], key=lambda v: (v is not None, v or 0)) for x in rows]
        out.append((i, len(rows), sum(gone), sha("\n".join(x for x, g in zip(rows, gone) if not g))))
    return sorted(out, key=repr)
