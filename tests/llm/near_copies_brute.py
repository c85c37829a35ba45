"""Brute force for the operators on near copies."""

import hashlib
import re
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")


def shingle_set(text, size=5):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def roots(nodes, links):
    up = {x: x for x in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}


def components_of(rows, percent=80):
    sets = [(doc, shingle_set(text)) for doc, text in rows if doc is not None]
    links = [
        (a, b) for k, (a, s) in enumerate(sets) for b, t in sets[:k]
        if s and t and 100 * len(s & t) >= percent * len(s | t)
    ]
    return {doc for doc, _ in sets}, roots({doc for doc, _ in sets}, links)


def without_repeats(rows, length=200):
    raw = [(doc, (text or "").encode()) for doc, text in rows]
    seen = Counter(b[s : s + length] for _, b in raw for s in range(len(b) - length + 1))
    out = []
    for doc, b in raw:
        gone, upto = bytearray(len(b)), 0
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[max(s, upto) : s + length] = b"\1" * (s + length - max(s, upto))
                upto = s + length
        kept = bytes(x for x, y in zip(b, gone) if not y)
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((doc, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def pairs_of(rows, items):
    out = {}
    for doc, text in rows:
        if doc is None or text is None:
            continue
        words = WORD.findall(text.lower())
        for item, body in items:
            if item is None or body is None:
                continue
            asked = WORD.findall(body.lower())
            n = min(5, len(asked))
            runs = {tuple(asked[k : k + n]) for k in range(len(asked) - n + 1)} if asked else set()
            held = runs & {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}
            if runs and 10 * len(held) >= 8 * len(runs):
                out[doc, item] = max(out.get((doc, item), (0,)), (len(held) / len(runs), len(runs), len(held)))
    return out
