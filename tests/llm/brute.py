"""Plain versions of the operators' results, for small inputs."""

import hashlib
import itertools
import re


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def repeats(rows, length):
    """op1: (doc_id, n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, text)."""
    rank = lambda i: (i is None, i or 0)
    first = {}
    for i, t in sorted(rows, key=lambda r: rank(r[0])):
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            first.setdefault(b[p:p + length], rank(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        mask = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < rank(i):
                mask[p:p + length] = b"\1" * length
        kept = bytes(x for x, m in zip(b, mask) if not m)
        spans = sum(1 for m, _ in itertools.groupby(mask) if m)
        out.append((i, len(b), sum(mask), spans, sha(kept)))
    return out


def shingles(text, size=5):
    words = re.findall(r"\w+", (text or "").lower())
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def classes(rows, similarity=0.8):
    """op2: class id (smallest doc_id) by doc_id, over all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {p for ids in holders.values() for p in itertools.combinations(sorted(ids), 2)}
    for a, b in pairs:
        if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: root(i) for i in sets}


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def personal(text):
    """op7: base spans as (start, place of the kind, end)."""
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def repeated_units(rows, units):
    """op9: removed (start, end) spans by row, for ``units(text)`` of (start, end, key)."""
    seen, out = {}, []
    for k, (i, t) in enumerate(sorted(rows)):
        for start, _, key in units(t or ""):
            seen.setdefault(key, (k, start))
            seen[key] = min(seen[key], (k, start))
    for k, (i, t) in enumerate(sorted(rows)):
        mask = bytearray(len(t or ""))
        for start, end, key in units(t or ""):
            if seen[key] != (k, start):
                mask[start:end] = b"\1" * (end - start)
        out.append((i, sha("".join(c for c, m in zip(t or "", mask) if not m))))
    return out
