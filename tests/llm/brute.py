"""Plain single-machine versions of the operators, written for tests only."""

import hashlib
import re
from collections import Counter, defaultdict

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def repeats(docs: dict, min_words: int) -> dict:
    words = {i: BLANK.findall(t or "") for i, t in docs.items()}
    seen = Counter(tuple(w[k : k + min_words]) for w in words.values() for k in range(len(w) - min_words + 1))
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - min_words + 1):
            if seen[tuple(w[k : k + min_words])] > 1:
                gone.update(range(k, k + min_words))
        out[i] = (len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def lower_ascii(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingle_sets(docs: dict, n: int = 5) -> dict:
    out = {}
    for i, t in docs.items():
        w = BLANK.findall(lower_ascii(t or ""))
        out[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    return out


def similar(docs: dict, n: int = 5, num: int = 80, den: int = 100) -> dict:
    sets, root = shingle_sets(docs, n), {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            holders[x].add(i)
    pairs = set()
    for ids in holders.values():
        ids = sorted(ids)
        pairs.update((a, b) for k, a in enumerate(ids) for b in ids[k + 1 :])
    for a, b in pairs:
        if den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in docs}


def crc(text: str) -> int:
    import zlib

    return zlib.crc32(text.encode())
