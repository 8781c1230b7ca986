"""Plain versions of the operators for small fixtures."""

from __future__ import annotations

import hashlib
import re

BLANKS = re.compile(r"[\x20\x09-\x0D]")


def shingles(text: str | None, gram: int) -> frozenset:
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    gram = min(gram, len(words))
    return frozenset((gram, *words[i:i + gram]) for i in range(len(words) - gram + 1))


def link_classes(rows: list[tuple], gram: int, percent: int) -> dict:
    """(n_shingles, component_id) by doc_id."""
    sets = {d: shingles(t, gram) for d, t in rows}
    parent = {d: d for d in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            shared, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if shared and 100 * shared >= percent * union:
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), top(d)) for d in sets}


def repeats(rows: list[tuple], length: int) -> dict:
    """(n_bytes, n_removed, n_spans, kept_sha256) by doc_id."""
    first: dict[bytes, int] = {}
    raws = [(d, (t or "").encode()) for d, t in rows]
    for d, raw in raws:
        for i in range(len(raw) - length + 1):
            run = raw[i:i + length]
            first[run] = min(first.get(run, d), d)
    out = {}
    for d, raw in raws:
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            if first[raw[i:i + length]] < d:
                gone[i:i + length] = [True] * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def exact_groups(rows: list[tuple]) -> dict:
    """(keep_id, group_size, text_sha256) by doc_id."""
    groups: dict[str, list] = {}
    for d, t in rows:
        groups.setdefault(BLANKS.sub("", t or ""), []).append((-len(t or ""), d))
    return {d: (min(g)[1], len(g), hashlib.sha256(key.encode()).hexdigest())
            for key, g in groups.items() for _, d in g}


def targets(sizes: dict, weights: tuple, cap: float) -> dict:
    """Target of each source by sharing again and again what caps cut off."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    open_, out, left = set(names), {}, sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total >= cap * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
        open_ -= set(over)
        left -= sum(out[s] for s in over)
    return out
