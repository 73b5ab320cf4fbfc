"""Plain versions of the operators, to compare with."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def line_dedup(docs):
    """doc_id -> (n_lines, kept text); docs: list of (id, text) with distinct ids."""
    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for d, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(d)
    out = {}
    for d, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 3 or max(holders[key(x)]) == d]
        out[d] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def shingles(text, n):
    w = words(lower(text or ""))
    return frozenset(zip(*(w[i:] for i in range(n)))) if len(w) >= n else frozenset([tuple(w)] if w else [])


def near_components(docs, n, percent):
    sets = {d: shingles(t, n) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def without_repeats(docs, size=35):
    count = Counter()
    for _, t in docs:
        w = words(t)
        count.update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = {}
    for d, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if count[tuple(w[i:i + size])] > 1:
                gone[i:i + size] = [True] * size
        out[d] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def edit_distance_inside(passage, text):
    """Least word edit distance of a passage to any stretch of a text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(passage, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def pfair(blocks, shares):
    """Source of every slot, by playing the schedule; blocks, shares: dicts by source."""
    left, out = dict(blocks), []
    while any(left.values()):
        active = sorted(s for s in left if left[s])
        q, had, t = sum(shares[s] for s in active), dict.fromkeys(active, 0), 0
        while all(left[s] for s in active):
            ready = [(-(-(had[s] + 1) * q // shares[s]), s) for s in active if had[s] * q // shares[s] <= t]
            s = min(ready)[1]
            out.append((s, t, q, tuple(active), dict(had)))
            had[s] += 1
            left[s] -= 1
            t += 1
    return out
