"""Plain Python versions of the contracts, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict
from zlib import crc32

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def op1(docs, length=200):
    raw = {k: (t or "").encode() for k, t in docs}
    seen = Counter(r[i : i + length] for r in raw.values() for i in range(len(r) - length + 1))
    out = {}
    for k, r in raw.items():
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out[k] = (len(r), sum(gone), runs, sha(kept))
    return out


def op7(docs, percent=85, words=4):
    sets = {}
    for k, t in docs:
        w = WORD.findall((t or "").translate(FOLD))
        sets[k] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    where = defaultdict(set)
    for k, s in sets.items():
        for x in s:
            where[x].add(k)
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, s in sets.items():
        common = Counter(o for x in s for o in where[x] if o < k)
        for o, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[o]) - n):
                a, b = sorted((root(k), root(o)))
                parent[b] = a
    return {k: (len(s), root(k)) for k, s in sets.items()}


def op8(docs, length=20):
    words = {k: WORD.findall(t or "") for k, t in docs}
    seen, out = set(), {}
    for k in sorted(words):
        w = words[k]
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            window = tuple(w[i : i + length])
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        out[k] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def fold(key, n):
    return crc32(str(key).encode()) % n
