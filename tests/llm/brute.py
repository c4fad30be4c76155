"""Plain versions of the operators, for small tables: lists of (doc_id, text) and loops."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np

SPACE = re.compile(r"[\x20\x09-\x0D]")


def exact_dedup(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(SPACE.sub("", t or ""), []).append((-len(t or ""), i))
    out = []
    for i, t in rows:
        own = SPACE.sub("", t or "")
        keep = min(groups[own], key=lambda x: (x[0], x[1] is None, x[1] or 0))[1]
        out.append((i, keep, len(groups[own]), i == keep, hashlib.sha256(own.encode()).hexdigest()))
    return out


def shingle_set(t, size=5):
    w = (t or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1)))


def jaccard(rows):
    """Links between rows; a row without key takes the class of an equal set of a row with one, and else has none."""
    sets = sorted({shingle_set(t) for i, t in rows if i is not None}, key=lambda s: sorted(s))
    least = {s: min(i for i, t in rows if i is not None and shingle_set(t) == s) for s in sets}
    root = {s: s for s in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(sets):
        for b in sets[:n]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(a), find(b)), key=least.get)
                root[y] = x
                least[x] = min(least[x], least[y])
    out = []
    for i, t in rows:
        own = shingle_set(t)
        out.append((i, len(own), least[find(own)] if own and own in root else i))
    return out


def suffix_dedup(rows, span=50):
    first = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (t or "").encode()
        for k in range(len(b) - span + 1):
            first.setdefault(b[k:k + span], i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - span + 1):
            f = first[b[k:k + span]]
            if f is not None and (i is None or f < i):
                gone[k:k + span] = b"\1" * span
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for a, c in zip(b"\0" + bytes(gone), gone) if c and not a)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bench_words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def decontaminate(rows, items, window=13):
    windows = {}
    for item, t in items:
        w = bench_words(t)
        for k in range(max(len(w) - window + 1, min(1, len(w)))):
            windows.setdefault(tuple(w[k:k + window]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for i, t in rows:
        w, hit, names = bench_words(t), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k:k + n])):
                    hit.update(range(k, k + n))
                    names |= own
        digest = hashlib.sha256(",".join(sorted(map(str, names))).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(names), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def token_files(rows, tokenizer, end=1):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, end]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def bag(rows):
    return Counter(tuple(round(v, 5) if isinstance(v, float) else v for v in r) for r in rows)
