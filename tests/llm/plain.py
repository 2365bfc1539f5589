"""Plain versions that several tests compare with."""

import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np


def water(sizes, weights=(1, 2, 3), cap=3):
    """Targets by repeated resharing, as the rule says it."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, capped, level = sum(sizes.values()), set(), 0.0
    while True:
        free = [s for s in order if s not in capped]
        if not free:
            break
        level = (total - sum(cap * sizes[s] for s in capped)) / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > cap * sizes[s]}
        if not over:
            break
        capped |= over
    return {s: cap * sizes[s] if s in capped else level * w[s] for s in order}


def shingle_set(t):
    w = re.findall(r"[^\x20\x09-\x0d]+", t)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_classes(texts, threshold=0.8):
    """Component of each text under exact Jaccard links; null texts are alone."""
    sets = [None if t is None else shingle_set(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s or ():
            index[x].append(k)
    shared = Counter(p for members in index.values() for p in combinations(members, 2))
    pairs = [p for p, c in shared.items() if c / (len(sets[p[0]]) + len(sets[p[1]]) - c) >= threshold]
    first = {}
    for k, t in enumerate(texts):
        if t is not None and not sets[k] and first.setdefault(t, k) != k:
            pairs.append((first[t], k))
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(texts))]


def check_packed(rows, texts, tokenizer, capacity):
    """Every piece is there once, in place, and no sequence overflows or has gaps."""
    by, seqs = {}, {}
    for r in rows:
        by.setdefault((r["doc_id"], r["piece"]), []).append(r)
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    want = {}
    for doc, t in texts:
        ids = tokenizer.ids(t or "") + np.array([0], "<u4").tobytes()
        for k, at in enumerate(range(0, len(ids), 4 * capacity)):
            part = ids[at:at + 4 * capacity]
            want.setdefault((doc, k), []).append((at // 4, len(part) // 4, zlib.crc32(part)))
    assert {k: sorted((r["start"], r["length"], r["ids_crc32"]) for r in v) for k, v in by.items()} == {k: sorted(v) for k, v in want.items()}
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs), -(-sum(n for v in want.values() for _, n, _ in v) // capacity)
