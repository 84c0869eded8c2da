"""Plain-Python versions of the operators' contracts, for small inputs."""

import hashlib
import re

import xxhash

LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(docs, items, window=13, share=20):
    """docs, items: (id, text) pairs; one tuple a document."""
    def words(t):
        return WORD.findall((t or "").translate(LOWER))
    grams = {}
    for item, text in items:
        w = words(text)
        for a in range(max(1, len(w) - window + 1) if w else 0):
            grams.setdefault(tuple(w[a:a + window]), set()).add(str(item))
    sizes = {len(g) for g in grams}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for m in sizes:
            for a in range(len(w) - m + 1):
                if (own := grams.get(tuple(w[a:a + m]))) is not None:
                    hit.update(range(a, a + m))
                    found |= own
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, bool(hit) and share * len(hit) >= len(w)))
    return out


def fingerprint(text, words=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(w[a:a + words]) for a in range(max(1, len(w) - words + 1))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_groups(docs, max_bits=4):
    """(id, fingerprint, smallest id reachable) by comparing all pairs."""
    fps = {d: fingerprint(t) for d, t in docs}
    up = {d: d for d in fps}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= max_bits:
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return [(d, f"{fps[d]:016x}", root(d)) for d in ids]


def repeated_bytes(docs, size=200):
    """(id, bytes, removed, spans, sha256 of what is kept)."""
    raw = [(d, (t or "").encode()) for d, t in docs]
    seen = {}
    for _, b in raw:
        for a in range(len(b) - size + 1):
            seen[b[a:a + size]] = seen.get(b[a:a + size], 0) + 1
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for a in range(len(b) - size + 1):
            if seen[b[a:a + size]] > 1:
                gone[a:a + size] = b"\1" * size
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    """Spans (start, rank, kind, end) of the base kinds."""
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), rank, kind, m.end()))
    return sorted(out)
