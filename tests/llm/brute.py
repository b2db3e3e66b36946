"""The operators' results by brute force, in plain Python."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from functools import cache

import public_tokenizers
import xxhash
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


@cache
def tokenizer(vocabulary):
    t = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    return t


def ids_of(vocabulary, text, end_id=2):
    return tokenizer(vocabulary).encode(text or "", add_special_tokens=False).ids + [end_id]


def plain(line):
    folded = "".join("0" if c in "123456789" else chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)
    return folded.strip(" \t\n\x0b\x0c\r")


def quality(docs, share=0.1, least=20, min_words=20, min_left=0.3, max_repeat_pct=30):
    """docs: (host, text) pairs; per document its statistics and its text without the lines over the limit."""
    texts, holders = {}, {}
    for host, text in docs:
        if text is not None:
            texts.setdefault(host, set()).add(text)
    for host, own in texts.items():
        for text in own:
            for line in {plain(x) for x in text.split("\n")} - {""}:
                holders[host, line] = holders.get((host, line), 0) + 1
    out = []
    for host, text in docs:
        over = {line for (h, line), n in holders.items() if h == host and n > least and n > share * len(texts[host])}
        w, lines = words(text), (text or "").split("\n")
        grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {i + k for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for k in range(8)}
        filled = [x for x in lines if words(x)]
        stay = [x for x in lines if plain(x) not in over]
        left = sum(len(words(x)) for x in stay)
        failed = len(w) < min_words or 100 * len(covered) > max_repeat_pct * len(w)
        out.append(
            {
                "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
                "n_dup_lines": len(filled) - len(set(filled)), "n_repeat_words": len(covered), "base_failed": failed,
                "n_lines_removed": len(lines) - len(stay), "n_words_left": left,
                "kept": not failed and not (len(stay) < len(lines) and left < min_left * len(w)),
                "clean_text": None if text is None else "\n".join(stay),
            }
        )
    return out


def fingerprint(text, shingle=3):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
    ones = Counter(b for g in grams for h in [xxhash.xxh64_intdigest(g.encode(), 42)] for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def groups(prints, k=2):
    """The group of each fingerprint, named by its first member's position."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= k:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def duplicates(texts, length=20):
    """Per text, in order, whether each word lies in a window that starts earlier too."""
    seen, out = set(), []
    for text in texts:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            window = tuple(w[i : i + length])
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        out.append(gone)
    return out


def kept_sha256(text, gone):
    return hashlib.sha256(" ".join(w for w, g in zip(words(text), gone, strict=True) if not g).encode()).hexdigest()


def without(text, gone):
    """The text without the words that are gone, each run of them cut up to the next kept word."""
    if text is None or not any(gone):
        return text
    spans = [m.span() for m in WORD.finditer(text)]
    out, at, k = [], 0, 0
    while k < len(gone):
        if gone[k]:
            stop = k
            while stop < len(gone) and gone[stop]:
                stop += 1
            out.append(text[at : spans[k][0]])
            at = spans[stop][0] if stop < len(gone) else len(text)
            k = stop
        else:
            k += 1
    return "".join(out) + text[at:]


def uniform(*parts):
    return (int(hashlib.md5(":".join(parts).encode()).hexdigest()[:13], 16) + 0.5) / 16**13


def poisson(mean, u):
    k, p = 0, math.exp(-mean)
    c = p
    while c < u:
        k += 1
        p = p * mean / k
        c += p
    return k


def copies(docs, weights=None, temperature=2.0, epochs=1.0, seed=17):
    """docs: (id, source, text); how often each is repeated."""
    sizes = Counter()
    for _, source, text in docs:
        sizes[source] += len(text or "") + 1
    weight = {s: n ** (1 / temperature) if weights is None else weights.get(s, 0.0) for s, n in sizes.items()}
    total = sum(weight.values())
    out = []
    for name, source, _ in docs:
        rate = weight[source] / total * epochs * sum(sizes.values()) / sizes[source] if total else 0.0
        scale = next((float(f"1e{d}") for d in range(6, 27, 3) if rate >= float(f"1e{6 - d}")), 1e27)
        rate = math.floor(rate * scale) / scale
        draws = max(1, math.ceil(rate / 8))
        key = "" if name is None else str(name)
        out.append(sum(poisson(rate / draws, uniform(key, str(seed), str(j))) for j in range(1, draws + 1)))
    return out
