"""Word shingles as 64-bit hashes, for whole batches of texts at a time.

Words are runs of bytes other than white space (0x20, 0x09-0x0D), after A-Z is
lower-cased; these bytes never lie inside a multi-byte character.  A text's set
holds its distinct shingles of ``size`` words; a text with fewer words has the
whole sequence as one; a text without words has the empty set.
"""

from __future__ import annotations

import numpy as np

from tidewatch.llm.hashing import BYTE_VALUE, mix

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_STEP = np.uint64(0xD1342543DE82EF95)


def word_hashes(many: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words of every text)."""
    raws = [(t or "").encode("utf-8", "surrogatepass") for t in many]
    data = np.frombuffer((b" " + b" ".join(raws) + b" ").translate(_LOWER), np.uint8)
    space = _SPACE[data]
    begin = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    end = np.flatnonzero(~space[:-1] & space[1:]) + 1
    edges = np.cumsum([1 + len(r) for r in raws])           # start of each text's separator after it
    words = np.diff(np.searchsorted(begin, np.concatenate(([0], edges)))).astype(np.int64)
    if not len(begin):
        return np.zeros(0, np.uint64), words
    size = end - begin
    first = np.cumsum(size) - size
    letter = BYTE_VALUE[data[~space]]
    place = np.arange(len(letter)) - np.repeat(first, size)
    power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(int(size.max()) - 1, _STEP))), dtype=np.uint64)
    letter = letter * power[place]
    return mix(np.add.reduceat(letter, first) + size.astype(np.uint64)), words


def shingle_sets(many: list[str | None], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of every text, ascending; their number per text)."""
    word, count = word_hashes(many)
    begin = np.cumsum(count) - count
    number = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    factor = [np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 & (2 ** 64 - 1)) for k in range(size)]
    out = np.zeros(int(number.sum()), np.uint64)
    at = np.cumsum(number) - number
    if len(word) >= size:
        all_ = np.zeros(len(word) - size + 1, np.uint64)
        for k, f in enumerate(factor):
            all_ += mix(word[k:k + len(all_)] * f)
        all_ = mix(all_)
    for k in range(len(many)):
        n, a, w = int(number[k]), int(at[k]), int(begin[k])
        if count[k] >= size:
            part = out[a:a + n]
            part[:] = all_[w:w + n]
            part.sort()
        elif n:
            seq = word[w:w + int(count[k])]
            out[a] = mix(np.array([sum(int(mix(seq[i:i + 1] * factor[i])[0]) for i in range(len(seq)))
                                   + len(seq) & (2 ** 64 - 1)], np.uint64))[0]
    text = np.repeat(np.arange(len(many)), number)
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (text[1:] != text[:-1])
    return out[new], np.bincount(text[new], minlength=len(many))


def set_names(shingles: np.ndarray, count: np.ndarray) -> np.ndarray:
    """One 64-bit name per set, from its size and members; 0 for the empty set."""
    names = np.zeros(len(count), np.uint64)
    full = np.flatnonzero(count)
    if len(full):
        begin = (np.cumsum(count) - count)[full]
        names[full] = mix(np.add.reduceat(mix(shingles + np.uint64(3)), begin) + count[full].astype(np.uint64) * _STEP)
    return names
