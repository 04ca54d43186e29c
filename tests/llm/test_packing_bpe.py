"""Packing and byte-level BPE against the tokenizer libraries."""

import base64
import hashlib
import os
import random
import zlib

import numpy as np
import public_tokenizers as vocab
import pytest
from hypothesis import given, settings, strategies as st

from brute import frame, odd_rows, words
from tidewatch.llm import bpe, packing, pieces

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocab.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken
    with open(vocab.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check_packing(rows, found, tokenizer, window=2048):
    ids = [np.asarray(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4") for r in rows]
    want = sorted((str(r[0]), len(x)) for r, x in zip(rows, ids))
    total = {}
    for p in found:
        total[str(p.doc_id), p.doc_tokens] = total.get((str(p.doc_id), p.doc_tokens), 0) + p.length
    assert sorted(total) == sorted(set(want))
    assert sum(total.values()) == sum(len(x) for x in ids)
    known = {str(r[0]): x for r, x in zip(rows, ids)}
    for p in found:
        x = known[str(p.doc_id)]
        if len(x) == p.doc_tokens:
            assert zlib.crc32(x[p.start:p.start + p.length].tobytes()) == p.ids_crc32
    by_sequence = {}
    for p in found:
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for ps in by_sequence.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == ps[0].sequence_tokens <= window


def test_packs_every_id_once(spark, tokenizer):
    rows = [(k, words(k, 5 + 37 * k % 1500)) for k in range(300)] + [(900, "<|endoftext|> a<|endoftext|>")]
    found = packing.pack(frame(spark, rows).coalesce(2)).collect()
    check_packing(rows, found, tokenizer)
    used = {p.sequence_id: p.sequence_tokens for p in found}
    assert sum(used.values()) >= (len(used) - 2) * 2048    # at most one padded window per task


def test_packing_odd_rows(spark, tokenizer):
    rows = odd_rows()
    found = packing.pack(frame(spark, rows)).collect()
    assert sum(p.length for p in found) == sum(
        len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows)
    assert sorted({str(p.doc_id) for p in found}) == sorted({str(r[0]) for r in rows})
    assert packing.pack(frame(spark, rows).where("false")).count() == 0


def test_empty_document_is_its_closing_id(spark):
    (p,) = packing.pack(frame(spark, [(1, None)])).collect()
    assert (p.start, p.length, p.doc_tokens, p.offset) == (0, 1, 1, 0)
    assert p.ids_crc32 == zlib.crc32(np.array([1], "<u4").tobytes())


@pytest.mark.parametrize("seed", range(4))
def test_sum_of_squares_rule(seed):
    """Every placement has the smallest sum of squares among the feasible levels."""
    r = random.Random(seed)
    p, w = packing.Packer(window=16), 16
    for k in range(400):
        s = r.randrange(1, 16)
        before = p.levels.copy()
        p.add(k, np.full(s, k, np.uint32))
        after = p.levels.copy()
        options = []
        for h in range(0, w - s + 1):
            if h == 0 or before[h]:
                x = before.copy()
                x[h] -= h > 0
                x[h + s] += h + s < w
                options.append(int((x[1:w] ** 2).sum()))
        assert int((after[1:w] ** 2).sum()) == min(options)
    p.drain(last=True)
    sizes = [sum(len(x[2]) for x in win) for win in p.take()]
    assert all(n == 16 for n in sizes[:-1]) and 0 < sizes[-1] <= 16


def test_open_windows_are_bounded():
    p = packing.Packer(window=64, max_open=8)
    r, total = random.Random(1), 0
    for k in range(2000):
        s = r.randrange(1, 64)
        total += s
        p.add(k, np.full(s, k, np.uint32))
        assert p.n_open <= 9
    p.drain(last=True)
    assert sum(len(x[2]) for win in p.take() for x in win) == total


def expected(text, enc):
    ids = enc.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


@pytest.mark.parametrize("chunk,overlap", [(65536, 1024), (64, 16), (100, 7), (50, 50)])
def test_encoding_equals_library(spark, tiktoken_encoding, chunk, overlap):
    rows = [*odd_rows(), (20, "a" * 3000), (21, " " * 2000 + "x"), (22, "it's we're they'll " * 200),
            (23, "héé  \n\n foo\t bar " * 100), (24, "x y " * 10 + "<|endoftext|>" * 30)]
    found = bpe.encode(frame(spark, rows), chunk=chunk, overlap=overlap).collect()
    want = sorted((str(r[0]), *expected(r[1], tiktoken_encoding)) for r in rows)
    assert sorted((str(f.doc_id), f.n_tokens, f.ids_sha256, f.decoded_sha256) for f in found) == want


def test_encoding_empty_table(spark):
    assert bpe.encode(frame(spark, [(1, "a")]).where("false")).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab 'srté\n\t1!", max_size=120), st.integers(8, 30), st.integers(1, 12))
def test_stitched_boundaries_equal_whole_text(text, chunk, overlap):
    pattern = pieces.split_pattern()
    n = max(1, -(-len(text) // chunk))
    starts = [k * chunk for k in range(n)]
    ends = [bpe.boundaries(text[s:s + chunk + overlap], k == n - 1, pattern) for k, s in enumerate(starts)]
    assert bpe.stitch(starts, ends, text, pattern) == [m.end() for m in pattern.finditer(text)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab 'sé\n\t1!.", max_size=60), max_size=6))
def test_memoised_words_equal_library(many):
    import tiktoken
    c = bpe.codec("byte_bpe_multi_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks=c.ranks, special_tokens={})
    got = [np.frombuffer(b, "<u4").tolist() for b in c.encoder.encode_many(many)]
    assert got == [enc.encode_ordinary(t) for t in many]


def test_long_piece_merges_alike():
    ranks = bpe.codec("byte_bpe_multi_50k.tiktoken").ranks
    piece = b"abcabdabe" * 60
    short = pieces.merge_ids(piece[:200], ranks)
    assert pieces._merge_long(piece[:200], ranks) == short
    assert b"".join(bpe.codec("byte_bpe_multi_50k.tiktoken").bytes_of[i] for i in pieces.merge_ids(piece, ranks)) == piece
