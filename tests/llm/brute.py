"""Plain definitions that the operators are held against."""

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text, lower=False):
    b = (text or "").encode()
    return WORD.findall(b.translate(LOWER) if lower else b)


def quality(text):
    ws, t = words(text), text or ""
    grams = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    covered = set()
    for i in range(len(ws) - 2):
        if grams[tuple(ws[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    chars = sum(len(w.decode()) for w in ws)
    failed = len(ws) < 50 or 100 * len(covered) > 50 * len(ws)
    return len(ws), chars, sum(t.count(c) for c in "#*$%&|<>"), dup, len(covered), failed


def shingles(text, n=5):
    ws = words(text, True)
    return {tuple(ws[i:i + n]) for i in range(len(ws) - n + 1)} if len(ws) >= n else ({tuple(ws)} if ws else set())


def near_components(rows, percent=85):
    """id -> smallest linked id, for rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}, sets


def repeated(rows, length=100):
    """id -> (bytes, removed, spans, sha256 of the rest), for rows with distinct ids."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            if w in seen:
                gone[k:k + length] = b"\x01" * length
            seen.add(w)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        rest = bytes(c for c, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return out


def unigrams(texts):
    c = Counter()
    for t in texts:
        c.update(words(t, True) + [b" "])
    return c


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())
