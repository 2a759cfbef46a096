"""Plain versions of the operators, for small inputs."""

import re
from collections import Counter

WHITE = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WHITE.findall((text or "").translate(UPPER))


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {n: find(n) for n in nodes}


def similar(a, b, percent):
    return bool(a and b) and 100 * len(a & b) >= percent * len(a | b)


def shingles(text, size=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def line_shingles(line, size=12):
    """Every run of characters of the line without its outer blanks; a shorter line is one."""
    plain = line.lower().translate({9: 32, 13: 32, 12: 32, 11: 32}).strip(" ")
    return frozenset(plain[i : i + size] for i in range(max(1, len(plain) - size + 1)))


def line_classes(docs, percent=80):
    """(doc_id, line_no) -> kept place."""
    places = [(d, n, x) for d, t in docs if t is not None for n, x in enumerate(t.split("\n")) if x.strip(" \t\r\f\v")]
    lines = sorted({x for _, _, x in places})
    sets = {x: line_shingles(x) for x in lines}
    of = components(lines, lambda a, b: similar(sets[a], sets[b], percent))
    first = {}
    for d, n, x in sorted(places):
        first.setdefault(of[x], (d, n))
    return {(d, n): first[of[x]] for d, n, x in places}


BENCH = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(text, items, span=13):
    doc = BENCH.findall((text or "").translate(UPPER))
    hit, found = set(), set()
    for item_id, item in items:
        w = BENCH.findall((item or "").translate(UPPER))
        n = min(span, len(w))
        spans = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(doc) - n + 1 if w else 0):
            if tuple(doc[i : i + n]) in spans:
                hit.update(range(i, i + n))
                found.add(str(item_id))
    return len(doc), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(doc)


def repeated_bytes(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        mark = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(mark)))
        out.append((len(r), sum(mark), runs, bytes(c for c, m in zip(r, mark) if not m)))
    return out
