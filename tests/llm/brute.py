"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import defaultdict


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def decontaminate(docs, items, window=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wanted = defaultdict(set)
    for i, t in items:
        w = word.findall(lower(t or ""))
        if i is not None and w:
            n = min(len(w), window)
            for k in range(len(w) - n + 1):
                wanted[tuple(w[k:k + n])].add(i)
    sizes = sorted({len(k) for k in wanted})
    out = []
    for d, t in docs:
        w = word.findall(lower(t or ""))
        hit, found = set(), set()
        for k in range(len(w)):
            for n in sizes:
                got = wanted.get(tuple(w[k:k + n])) if k + n <= len(w) else None
                if got:
                    hit.update(range(k, k + n))
                    found |= got
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit)))
    return out


def repeated_bytes(docs, size=100):
    seen, out = {}, []
    for d, t in sorted(docs, key=lambda r: r[0]):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - size + 1):
            s = data[k:k + size]
            if s in seen:
                gone[k:k + size] = b"\1" * size
            else:
                seen[s] = d
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((d, len(data), sum(gone), len(re.findall(b"\1+", gone)), sha(kept)))
    return out


def near_duplicates(docs, size=4, threshold=80):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    sets = {}
    for d, t in docs:
        w = word.findall(lower(t or ""))
        sets[d] = {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    by = defaultdict(list)
    for d in ids:
        for s in sets[d]:
            by[s].append(d)
    tested = set()
    for group in by.values():
        for i, a in enumerate(group):
            for b in group[i + 1:]:
                if (a, b) not in tested:
                    tested.add((a, b))
                    if 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                        x, y = sorted((root(a), root(b)))
                        up[y] = x
    return [(d, len(sets[d]), root(d), root(d) == d) for d in ids]


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
