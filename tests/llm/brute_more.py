"""Results of the clustering, resampling and set operators by brute force, in plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

from .brute import words

LETTERS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def clusters(vectors, k, rounds, dims, scale, seed):
    """vectors: (id, components) pairs; sorted rows of the clustering."""
    held = [(i, v) for i, v in vectors if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [max(-(1 << 63), min((1 << 63) - 1, math.floor(scale * x) if math.isfinite(scale * x) else (1 if x > 0 else -1) << 70)) for x in v]) for i, v in held]
    middles = [v for _, v in sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]]

    def assigned():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), n) for n, c in enumerate(middles)) for _, v in kept]

    for _ in range(rounds):
        found = assigned()
        for n in range(len(middles)):
            own = [v for (_, v), (_, m) in zip(kept, found, strict=True) if m == n]
            if own:
                middles[n] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = assigned()
    most = (1 << 63) - 1
    inertia = Counter()
    for d, n in found:
        inertia[n] += min(d, most)
    whole = min(sum(inertia.values()), most)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middles]
    return sorted(
        ((i, n, min(d, most), min(inertia[n], most), whole, names[n]) for (i, _), (d, n) in zip(kept, found, strict=True)), key=lambda r: (r[0] is None, r)
    )


def resampled(docs, target, share=10, runs=1, buckets=10_000, min_words=20, seed=2024):
    """docs: (id, text) pairs; (id, n_features, weight, score, rank) of each, in order."""

    def features(text):
        w = LETTERS.findall(lowered(text).encode())
        return len(w), [zlib.crc32(b" ".join(w[i : i + n])) % buckets for n in range(1, runs + 1) for i in range(len(w) - n + 1)]

    own, wanted = [features(t) for _, t in docs], [features(t) for t in target]
    source, goal = Counter(b for _, f in own for b in f), Counter(b for _, f in wanted for b in f)
    s, t = sum(source.values()) + buckets, sum(goal.values()) + buckets
    rows = []
    for (i, _), (n, f) in zip(docs, own, strict=True):
        weight = sum(math.floor(1000 * math.log((goal[b] + 1) * s / ((source[b] + 1) * t))) for b in f)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    eligible = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    for place, r in enumerate(eligible[: share * len(eligible) // 100]):
        r[4] = place + 1
    return [tuple(r[:5]) for r in rows]


def shingle_set(text, n):
    w = words(lowered(text))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def set_groups(docs, shingle=2, percent=80):
    """docs: (id, text) pairs; (id, n_shingles, component_id, kept) of each, in order."""
    sets = [shingle_set(t, shingle) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    least = {}
    for i, (name, _) in enumerate(docs):
        if name is not None:
            least[find(i)] = min(least.get(find(i), name), name)
    out = []
    for i, (name, _) in enumerate(docs):
        component = least.get(find(i)) if sets[i] else name
        out.append((name, len(sets[i]), component, name == component))
    return out
