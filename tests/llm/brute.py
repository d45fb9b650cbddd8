"""Plain restatements of the contracts, for small tables."""

from __future__ import annotations

import hashlib
import re

BLANK = re.compile("[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text: str | None) -> str:
    return (text or "").translate(LOWER)


def contamination(docs, items, size: int = 10) -> dict:
    """id -> (n_words, n_hit, n_items, sha256)."""
    windows = {}
    for item, text in items:
        own = ALNUM.findall(lower(text))
        for k in range(max(len(own) - size + 1, min(1, len(own)))):
            windows.setdefault(tuple(own[k:k + size]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        own, hit, found = ALNUM.findall(lower(text)), set(), set()
        for n in lengths:
            for k in range(len(own) - n + 1):
                if (w := tuple(own[k:k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[w]
        out[doc] = (len(own), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest())
    return out


def shingle_set(text: str | None, size: int) -> frozenset:
    own = BLANK.findall(lower(text))
    if len(own) < size:
        return frozenset([tuple(own)] if own else [])
    return frozenset(tuple(own[k:k + size]) for k in range(len(own) - size + 1))


def linked_components(docs, size: int, percent: int) -> dict:
    """id -> (number of shingles, smallest id reachable), by comparing all pairs."""
    sets = {doc: shingle_set(text, size) for doc, text in docs}
    label = {doc: doc for doc in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                common = len(x & y)
                if 100 * common >= percent * (len(x) + len(y) - common):
                    p, q = sorted((root(a), root(b)))
                    label[q] = p
    return {doc: (len(sets[doc]), root(doc)) for doc in ids}
