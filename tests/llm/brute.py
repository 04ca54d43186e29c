"""Plain implementations that the operators are held against, and odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

DOC = "doc_id long, text string, lang string, source string, n_chars long, k1 long, line string, score string"


def frame(spark, rows):
    """Documents from (doc_id, text[, lang, source]); further columns clash with inner names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0",
             len(r[1] or ""), 7, "x", "y") for r in rows]
    return spark.createDataFrame(full, DOC)


def words(seed: int, n: int, kinds: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(kinds)}" for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls, empties, a repeated row, a long text, odd characters."""
    return [(1, None), (2, ""), (3, " \n\t "), (None, words(1, 60)), (4, words(2, 80)), (4, words(2, 80)),
            (5, words(3, 9000)), (6, "é日本語 ümlaut 🙂 " * 40), (7, "one"), (8, "one two three"), (9, None, None, None),
            (10, words(2, 80))]


def repeated_bytes(texts: list[str | None], depth: int) -> list[tuple[int, int, int, str]]:
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + depth] for r in raws for i in range(len(r) - depth + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - depth + 1):
            if seen[r[i:i + depth]] > 1:
                gone[i:i + depth] = b"\1" * depth
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(r), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return out


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_set(text: str | None) -> frozenset:
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(_LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def jaccard_classes(rows: list[tuple], similarity: int = 80) -> list[tuple]:
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and both and 100 * both >= similarity * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], len(s), least.get(find(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets))]


def by_id(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=repr)
