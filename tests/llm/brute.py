"""Plain versions of the operators, for small tables."""

import base64
import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import xxhash
import zstandard

SPACED, ALNUM = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text):
    return re.findall(SPACED, text or "")


def alnum(text):
    return re.findall(ALNUM, lower(text))


def key(row):
    return tuple((x is None, str(x)) for x in row)


class Sets:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        self.up[self.find(a)] = self.find(b)

    def least(self, ids):
        out = {}
        for k, i in enumerate(ids):
            if i is not None:
                out[self.find(k)] = min(out.get(self.find(k), i), i)
        return [out.get(self.find(k)) for k in range(len(ids))]


def fingerprint(text, size):
    w = spaced(lower(text))
    shingles = [" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash(rows, size=3, distance=2):
    fps, sets = [fingerprint(t, size) for _, t in rows], Sets(len(rows))
    for a, b in combinations(range(len(rows)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= distance:
            sets.join(a, b)
    return sorted(((i, f, c) for (i, _), f, c in zip(rows, fps, sets.least([i for i, _ in rows]))), key=key)


def repeats(rows, size):
    words, first = [spaced(t) for _, t in rows], {}
    ids = [math.inf if i is None else i for i, _ in rows]
    for i, w in zip(ids, words):
        for k in range(len(w) - size + 1):
            x = tuple(w[k : k + size])
            first[x] = min(first.get(x, math.inf), i)
    out = []
    for (i, _), own, w in zip(rows, ids, words):
        gone = {j for k in range(len(w) - size + 1) if first[tuple(w[k : k + size])] < own for j in range(k, k + size)}
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    return sorted(out, key=key)


def contamination(rows, items, size, one_in=20):
    patterns = defaultdict(set)
    for i, t in items:
        w = alnum(t)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            patterns[tuple(w[k : k + n])].add(i)
    out = []
    for i, t in rows:
        w, hit, found = alnum(t), set(), set()
        for n in {len(p) for p in patterns}:
            for k in range(len(w) - n + 1):
                if (x := patterns.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= x
        found = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit) and one_in * len(hit) >= len(w)))
    return sorted(out, key=key)


def phrases(rows, known):
    out = []
    for i, t in rows:
        w = alnum(t)
        at = [(k, label) for p, label in known.items() for q in [p.split()] for k in range(len(w) - len(q) + 1) if w[k : k + len(q)] == q]
        places = [k for k, _ in at]
        out.append((i, len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))))
    return sorted(out, key=key)


def archived(rows, least=0):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= least and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, u, h in rows:
        b = (h or "").encode()
        again = len(b) >= least and i is not None and first[b] < i
        out.append((i, u, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", first[b] if again else None, None if again else b))
    return Counter(out)


def losses(rows, target, weight=0.7, add=0.5):
    texts = [(i, spaced(lower(t)), i in target) for i, t in rows]
    counts = {side: Counter(k for _, x, mine in texts if mine == side for k in [*x, *zip(x, [*x[1:], None])]) for side in (True, False)}
    words = {side: sum(len(x) for _, x, mine in texts if mine == side) for side in (True, False)}
    scale = words[True] / words[False] if words[False] else 0.0
    out = []
    for i, x, mine in texts:
        own = Counter([*x, *zip(x, [*x[1:], None])])

        def loss(k, side):
            n = counts[side][k] - (own[k] if mine == side else 0)
            return -math.log(n + add if side else scale * n + add)

        def step(w, after, side):
            return weight * (loss((w, after), side) - loss(w, side)) + (1 - weight) * loss(w, side)

        total = sum(step(w, v, True) - step(w, v, False) for w, v in zip(x, [*x[1:], None])) if words[True] else 0.0
        out.append((i, len(x), total / len(x) if x else 0.0))
    return sorted(out, key=lambda r: (str(r[0]), r[1:]))


def vectors(rows, threshold=0.95):
    from aerofolio.llm.neighbours import _unit

    unit = [None if v is None or any(x is None for x in v) else _unit(np.array(v, float)) for _, v in rows]
    sets, n = Sets(len(rows)), [0] * len(rows)
    for a, b in combinations([k for k, u in enumerate(unit) if u is not None], 2):
        if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
            sets.join(a, b)
            n[a] += 1
            n[b] += 1
    least = sets.least([i for i, _ in rows])
    return sorted(((i, k, c, i is not None and i == c) for (i, _), k, c in zip(rows, n, least)), key=key)


def extra(spark, rows, columns):
    """A table with columns of no concern that are named as the operators' own."""
    clash = {"id": 1, "text_": None, "n_words": "x", "score": "y", "component": 2, "key": 3, "size": 4.5, "spans": "z", "odd": (1,)}
    names = [c.split()[0] for c in columns.split(", ")]
    more = {k: v for k, v in clash.items() if k not in names}
    kinds = {"id": "long", "text_": "string", "n_words": "string", "score": "string", "component": "int", "key": "int", "size": "double", "spans": "string", "odd": "struct<`a b`:int>"}
    return spark.createDataFrame([(*r, *more.values()) for r in rows], columns + "".join(f", {k} {kinds[k]}" for k in more))


def compressed_features(text, good, bad):
    """Features of the quality score, block by block, with a fresh compressor for each."""
    raw = text.encode()
    blocks = [raw[i : i + 512] for i in range(0, len(raw), 512)]
    if not blocks:
        return 0.0, 0.0, 0.0, 0.0, 0.0

    def sizes(dictionary):
        d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        return [len(zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress(b)) for b in blocks]

    g, b = sizes(good), sizes(bad)
    each = [(y - x) / (y + x) for x, y in zip(g, b)]
    return (sum(b) - sum(g)) / (sum(b) + sum(g)), min(each), max(each), sum(g) / len(raw), math.log1p(len(raw))


def compressed_score(text, model):
    inside = [min(max(x, lo), hi) for x, lo, hi in zip(compressed_features(text, model.good, model.bad), *model.seen)]
    z = model.weights[0] + sum(w * (x - m) / s for w, x, m, s in zip(model.weights[1:], inside, model.mean, model.spread))
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))
