"""Pre-token splitting and memoised piece encoding, shared by packing and BPE.

A pre-token is one match of the public split pattern.  The pattern never looks
behind, so matching can start afresh at any pre-token boundary; before every
single space that is followed by a non-space there is always such a boundary.
Words cut there are therefore encoded on their own, and a word seen before
costs one dictionary look-up.  The memos are cleared when full, which bounds a
worker's memory and changes no result.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Callable

import numpy as np

#: Entries kept per memo before it is cleared.
MEMO_WORDS = 900_000
MEMO_PIECES = 700_000

_NO_RANK = 1 << 40
_SPACE_THEN_SPACE = re.compile(r" \s")


def split_pattern():
    import public_tokenizers
    import regex
    return regex.compile(public_tokenizers.PATTERN)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_ids(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: merge the lowest-ranked adjacent pair, leftmost first,
    until no pair has a rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > 256:
        return _merge_long(piece, ranks)
    get = ranks.get
    parts = [piece[i:i + 1] for i in range(len(piece))]
    pair = [get(piece[i:i + 2], _NO_RANK) for i in range(len(piece) - 1)]
    while pair:
        low = min(pair)
        if low == _NO_RANK:
            break
        i = pair.index(low)
        parts[i] += parts.pop(i + 1)
        del pair[i]
        if i < len(pair):
            pair[i] = get(parts[i] + parts[i + 1], _NO_RANK)
        if i:
            pair[i - 1] = get(parts[i - 1] + parts[i], _NO_RANK)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap over a linked list, for pieces of any length."""
    n = len(piece)
    part: list[bytes | None] = [piece[i:i + 1] for i in range(n)]
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, part[i] + part[i + 1]) for i in range(n - 1)
            if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, both = heapq.heappop(heap)
        j = nxt[i] if part[i] is not None else n
        if j >= n or part[i] + part[j] != both:
            continue
        part[i], part[j] = both, None
        nxt[i] = nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
        for a, b in ((prv[i], i), (i, nxt[i])):
            if a >= 0 and b < n and (r := ranks.get(part[a] + part[b])) is not None:
                heapq.heappush(heap, (r, a, part[a] + part[b]))
    return [ranks[p] for p in part if p is not None]


class PieceEncoder:
    """Ids of whole texts as packed little-endian uint32 bytes.

    ``encode_pieces`` maps pieces (strings) to lists of ids.
    """

    def __init__(self, encode_pieces: Callable[[list[str]], list[list[int]]]):
        self.pattern = split_pattern()
        self.encode_pieces = encode_pieces
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def pieces_to_bytes(self, found: list[str]) -> bytes:
        """Packed ids of pre-tokens, in order."""
        known = self.pieces
        missing = [p for p in dict.fromkeys(found) if p not in known]
        if missing:
            self._learn(missing)
            known = self.pieces
        return b"".join([known[p] for p in found])

    def _learn(self, missing: list[str]) -> None:
        if len(self.pieces) + len(missing) > MEMO_PIECES:
            self.pieces = {}
            self.words = {}
        for p, ids in zip(missing, self.encode_pieces(missing), strict=True):
            self.pieces[p] = np.asarray(ids, "<u4").tobytes()

    def _one(self, text: str) -> bytes:
        return self.pieces_to_bytes(self.pattern.findall(text))

    def _learn_words(self, new: set[str]) -> None:
        if len(self.words) + len(new) > MEMO_WORDS:
            self.words = {}
        found = [self.pattern.findall(" " + w) for w in new]
        known = self.pieces
        missing = list({p for f in found for p in f if p not in known})
        if len(known) + len(missing) > MEMO_PIECES:
            self.pieces = known = {}
            missing = list({p for f in found for p in f})
        for p, ids in zip(missing, self.encode_pieces(missing), strict=True):
            known[p] = np.asarray(ids, "<u4").tobytes()
        words = self.words
        for w, f in zip(new, found, strict=True):
            words[w] = known[f[0]] if len(f) == 1 else b"".join([known[p] for p in f])

    def encode_many(self, many: list[str]) -> list[bytes]:
        """Packed ids of each text.  The words of all texts that are new to the
        memo are learned first, in bulk."""
        plain = [bool(t) and t[-1] != " " and not _SPACE_THEN_SPACE.search(t) for t in many]
        parts = [t.split(" ") if p else [] for t, p in zip(many, plain, strict=True)]
        seen = set().union(*parts)
        new = seen.difference(self.words)
        new.discard("")
        if len(self.words) + len(new) > MEMO_WORDS:
            self.words = {}
            new = seen - {""}
        if new:
            self._learn_words(new)
        words = self.words
        out = []
        for text, p, own in zip(many, plain, parts, strict=True):
            if not p:
                out.append(self._one(text) if text else b"")
            elif len(own) == 1:
                out.append(self._one(text))
            else:
                first = self._one(own[0]) if own[0] else b""
                del own[0]
                out.append(first + b"".join([words[w] for w in own]))
        return out
