"""The operators' rules restated plainly, for small inputs."""

from __future__ import annotations

import hashlib
import itertools
import math
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


# --- secrets


def base_spans(text):
    """The three patterns as they read, leftmost matches first, short ones dropped afterwards."""
    text, found = text or "", []
    assign = re.compile(
        r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    found += [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    kinds = ["assign", "access", "hex"]
    return sorted(found, key=lambda s: (s[1], kinds.index(s[0])))


def listed(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- lines


def edits(a, b):
    """Levenshtein distance of two word lists."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def removed_lines(documents, min_words=5):
    """{(id, text): sorted numbers of the lines that go}, comparing every line with all earlier ones.

    `documents` are (id, text, mark); the mark orders rows that share an id.
    """
    lines = []
    for id_, text, mark in documents:
        for number, line in enumerate((text or "").split("\n")):
            if len(words(line)) >= min_words:
                lines.append(((id_ is None, id_ if id_ is not None else 0, mark, number), words(line), (id_, text)))
    lines.sort(key=lambda x: x[0])
    removed = {}
    for i, (place, mine, key) in enumerate(lines):
        for earlier, theirs, _ in lines[:i]:
            ends = mine[0] == theirs[0] or mine[-1] == theirs[-1]  # one edit leaves one end of a line of three words or more
            if ends and earlier < place and abs(len(mine) - len(theirs)) <= 1 and (mine == theirs or edits(mine, theirs) <= 1):
                removed.setdefault(key, set()).add(place[3])
                break
    return {key: sorted(numbers) for key, numbers in removed.items()}


# --- near duplicates


def shingles(text, n):
    found = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not found:
        return frozenset()
    if len(found) < n:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[i : i + n]) for i in range(len(found) - n + 1))


def united(nodes, links):
    """{node: smallest node reachable}."""
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {n: top(n) for n in nodes}


def near_documents(documents, n, percent=80):
    """{id: (set size, component)} over all pairs of (id, text) that share a shingle."""
    sets = [(id_, shingles(text, n)) for id_, text in documents if id_ is not None]
    holders = {}
    for at, (_, s) in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(at)
    links, seen = [], set()
    for held in holders.values():
        for i, j in itertools.combinations(held, 2):
            if (i, j) not in seen:
                seen.add((i, j))
                a, b = sets[i][1], sets[j][1]
                shared = len(a & b)
                if 100 * shared >= percent * (len(a) + len(b) - shared):
                    links.append((sets[i][0], sets[j][0]))
    found = united({id_ for id_, _ in sets}, links)
    return {id_: (len(s), found[id_]) for id_, s in sets}


# --- mixing


def targets(sizes, weights=(3, 1, 2)):
    """{source: target} by sharing 150 % by weight and the excess again until none is above twice its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()) * 1.5, set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(2 * sizes[s] for s in capped)
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level >= 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in capped else weight[s] * level for s in order}
        capped |= over


# --- vectors


def sound(vector, width):
    return (
        vector is not None
        and len(vector) == width
        and all(x is not None and math.isfinite(x) for x in vector)
        and any(x != 0 for x in vector)
    )


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(y * y for y in b))


def near_vectors(rows, width, least=0.9):
    """[(id, links, component)] in the order of `rows`."""
    part = [sound(v, width) and id_ is not None for id_, v in rows]
    links = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if part[i] and part[j] and cosine(rows[i][1], rows[j][1]) >= least]
    count = [0] * len(rows)
    for i, j in links:
        count[i] += 1
        count[j] += 1
    top = united(range(len(rows)), links)
    smallest = {}
    for i, (id_, _) in enumerate(rows):
        smallest[top[i]] = id_ if top[i] not in smallest else min(smallest[top[i]], id_)
    return [(id_, count[i], smallest[top[i]]) for i, (id_, _) in enumerate(rows)]


def nearest(rows, queries, width, k):
    """{query: [(id, distance)]}, nearest first, ties to the smaller id."""
    part = [(id_, v) for id_, v in rows if id_ is not None and sound(v, width)]
    found = {}
    for q in queries:
        for id_, v in part:
            if id_ == q:
                others = sorted((math.dist(v, w), other) for other, w in part if other != q)
                found[q] = [(other, d) for d, other in others[:k]]
    return found
