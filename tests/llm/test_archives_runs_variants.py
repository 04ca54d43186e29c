"""Archives, periodic runs and spelling variants against brute force."""

import gzip
import hashlib
import io
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from brute import by_id, frame, odd_rows
from tidewatch.llm import runs, variants, warc
from tidewatch.llm.queries import ORACLE_SQL, QUERIES, misspell, repeat_tail

# ---- periodic runs ---------------------------------------------------------------------------


def brute_runs(words, min_words=6, min_exponent=4):
    """Every period, every stretch; a stretch with a smaller period is not a run of this one."""
    n, found = len(words), {}
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - a >= max(min_words, min_exponent * q) \
                    and not any(b <= a and i + q <= b + m for b, m, p in found.values() if q % p == 0):
                found[a, q] = (a, i + q - a, q)
    return sorted(found.values(), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = repeat_tail(doc_id, re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode()))
    found = brute_runs(words)
    top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in found)]
    return (doc_id, len(found), *(top or (None, None, None)), top and 1000 * top[1] // top[2],
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(kept)).hexdigest())


def periodic_texts(seed, n):
    r = random.Random(seed)
    out = []
    for k in range(n):
        parts = []
        for _ in range(r.randrange(1, 5)):
            parts += [r.choice("abc") for _ in range(r.randrange(0, 9))]
            parts += [r.choice("ab") for _ in range(r.randrange(1, 8))] * r.randrange(1, 9)
        out.append((k, r.choice([" ", "\t", "\n ", "\v"]).join(parts)))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_periodic_runs_equal_brute_force(seed):
    many = [t.encode().split() for _, t in periodic_texts(seed, 60)]
    assert runs.periodic_runs(many) == [brute_runs(w) for w in many]
    assert runs.periodic_runs(many, min_words=3, min_exponent=3) == [brute_runs(w, 3, 3) for w in many]


def test_runs_over_two_letters_and_nested_periods():
    many = [list(w) for w in (b"aaaaaa", b"a" * 5, b"abababab", b"aabaabaabaabaab" * 3, b"ab" * 9 + b"a", b"",
                              b"aaaaaabaaaaaabaaaaaabaaaaaab", b"x" + b"abcabcabcabc" + b"y")]
    many = [[bytes([b]) for b in w] for w in many]
    assert runs.periodic_runs(many) == [brute_runs(w) for w in many]
    assert runs.periodic_runs(many)[0] == [(0, 6, 1)] and runs.periodic_runs(many)[1] == []
    with pytest.raises(ValueError):
        runs.periodic_runs(many, min_exponent=2)


def test_runs_query(spark, tmp_path):
    rows = [*periodic_texts(9, 80), *[(k + 200 if k is not None else None, t) for k, t, *_ in odd_rows()],
            *[(1000 + k, " ".join(f"w{i * i % 91}" for i in range(5 * k))) for k in range(60)]]
    frame(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_runs"](spark, str(tmp_path))
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint",
                                "period": "bigint", "exponent_milli": "bigint", "runs_sha256": "string",
                                "collapsed_sha256": "string"}
    assert by_id(got.collect()) == by_id(brute_row(*r[:2]) for r in rows)
    assert runs.detect(frame(spark, rows).where("false")).collect() == []


def test_long_text_of_one_word_is_one_run(spark):
    rows = [(1, "la " * 300_000), (2, " ".join(str(k) for k in range(200_000)))]
    got = {r.doc_id: r for r in runs.detect(frame(spark, rows)).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 300_000, 1)] and got[1].collapsed == "la"
    assert got[2].runs == [] and got[2].strongest is None and got[2].n_words == 200_000


# ---- spelling variants -----------------------------------------------------------------------


def edits(word):
    """Patterns of a word: two words are near only if they share one."""
    return {word[:i] + "?" + word[i + 1:] for i in range(len(word))} \
        | {word[:i] + "?" + word[i:] for i in range(len(word) + 1)}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_variants(rows, edit=misspell):
    total = Counter()
    for doc_id, text, *_ in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            if edit is misspell:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % 97 == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    n = {w: c for w, c in total.items() if len(w) >= 5 and c >= 3}
    near = {w: [] for w in n}
    for a in n:
        for b in n:
            if a < b and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in n:
        top = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = top if top and n[top] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), form[w] and n[form[w]]))
    return out


def variant_texts(seed, n):
    r = random.Random(seed)
    base = ["".join(r.choice("abcdéÿ×z") for _ in range(r.randrange(4, 12))) for _ in range(25)]
    out = []
    for k in range(n):
        ws = []
        for _ in range(r.randrange(0, 40)):
            w = base[min(r.randrange(25), r.randrange(25))]
            for _ in range(r.choice((0, 0, 0, 1, 1, 2))):
                i = r.randrange(len(w))
                w = r.choice((w[:i] + w[i + 1:], w[:i] + r.choice("abé") + w[i:], w[:i] + r.choice("abé") + w[i + 1:]))
            ws.append(w.upper() if r.random() < 0.1 else w)
        out.append((k, r.choice((" ", ", ", "-1 ")).join(ws)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_brute_force(spark, seed, tmp_path):
    rows = [*variant_texts(seed, 160), *odd_rows(), (None, "Überraschung " * 3), (77, "abcde " * 4 + "abcdé " * 9)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_spelling_variants"](spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert by_id(got.collect()) == by_id(brute_variants(rows))


def test_variants_without_broadcast_small_dictionaries_and_empty(spark):
    rows = variant_texts(3, 120) + [(999, "chainword " * 40 + "chainwor " * 12 + "chainwo " * 4)]
    got = variants.group(frame(spark, rows), held=7, broadcast_rows=0)
    want = by_id(brute_variants(rows, None))
    assert by_id(got.collect()) == want and any(x[4] > 2 for x in want) and ("chainwo", "chainwor", "chainword", 4, 1, 12) in want
    assert variants.group(frame(spark, rows).where("false")).collect() == []


def test_variants_very_long_words(spark):
    long = "ab" * 40_000
    rows = [(1, " ".join([long] * 6 + [long[:500] + "c" + long[500:]] * 3 + [long[:-1] + "z"] * 3 + ["ab" * 39_000] * 3))]
    got = {r.n_near: r for r in variants.group(frame(spark, rows)).orderBy("n").collect()}
    assert sorted(got) == [0, 1, 2] and got[2].n == 6 and got[1].root == long and got[0].root == "ab" * 39_000


# ---- archives --------------------------------------------------------------------------------

PAGE = "page_id long, url string, html string, digest string, size int, split string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", 5, "s") for i, u, h in rows], PAGE)


def page_rows(seed, n):
    r = random.Random(seed)
    common = ["<p>" + "x" * 1200 + str(k) for k in range(3)] + ["small page", "y" * 999, "é" * 500, "z" * 1000]
    return [(k, f"http://h{k % 7}/é?q={k}\r\nX: y", r.choice(common) if r.random() < 0.5 else f"<b>{k}</b>" * r.randrange(400))
            for k in range(n)]


ODD_PAGES = [(5000, None, None), (5001, "", ""), (None, "u", "q" * 2000), (5002, "u", "q" * 2000), (5003, "v", "q" * 2000),
             (5003, "v", "q" * 2000), (None, "w", "n" * 1500), (None, None, "n" * 1500), (5004, "big", "<i>é</i>\r\n\r\n" * 90_000)]


def brute_pages(rows):
    top = {}
    for i, _, h in rows:
        if i is not None:
            top[h or ""] = max(top.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= 1000 and top.get(h or "", i) != i
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response",
                    top[h or ""] if again else None))
    return out


ROW = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_archives_round_trip(spark, broadcast_rows, tmp_path):
    rows = page_rows(1, 300) + ODD_PAGES
    root = f"file://{tmp_path}/a"
    warc.write(pages(spark, rows).repartition(3), root, shard_bytes=100_000, roll_bytes=4_000, broadcast_rows=broadcast_rows)
    got = warc.read(spark, root)
    assert by_id(got.select(*ROW).collect()) == by_id(brute_pages(rows))
    kept = {r.page_id: bytes(r.payload) for r in got.where("record_type = 'response' AND page_id IS NOT NULL").collect()}
    assert all(kept[i] == (h or "").encode() for i, _, h in rows if i in kept)
    names = sorted(os.listdir(f"{tmp_path}/a"))
    assert "_temporary" not in names and len([x for x in names if x.endswith(".warc.gz")]) == warc.manifest(spark, root).count() > 5


def test_archives_are_the_same_bytes_again_and_valid_gzip(spark, tmp_path):
    df = pages(spark, page_rows(2, 200)).repartition(2, "page_id")
    for name in "ab":
        warc.write(df, f"{tmp_path}/{name}", shard_bytes=60_000, roll_bytes=6_000)
    a, b = ({x: open(f"{tmp_path}/{n}/{x}", "rb").read() for x in os.listdir(f"{tmp_path}/{n}") if x.endswith("gz")} for n in "ab")
    assert a == b and a
    sizes = {r.name: (r.bytes, r.sha256) for r in warc.manifest(spark, f"{tmp_path}/a").collect()}
    assert sizes == {x: (len(raw), hashlib.sha256(raw).hexdigest()) for x, raw in a.items()}
    for raw in a.values():
        plain = gzip.decompress(raw)
        assert plain.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        listed = list(warc.records(io.BytesIO(raw)))
        assert len({f["WARC-Record-ID"] for f, _ in listed}) == len(listed) == plain.count(b"WARC/1.1\r\nWARC-Type")
        assert sum(len(gzip.decompress(x)) for x in [raw]) == len(plain)


def test_moves_are_repeatable_and_damage_is_found(spark, tmp_path):
    rows = page_rows(3, 50)
    warc.write(pages(spark, rows), f"{tmp_path}/a")
    name = warc.manifest(spark, f"{tmp_path}/a").first()["name"]
    raw = open(f"{tmp_path}/a/{name}", "rb").read()
    parts = bytearray(gzip.decompress(raw))
    at = parts.index(b"<b>")
    parts[at + 1] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        list(warc.records(io.BytesIO(gzip.compress(bytes(parts)))))
    with pytest.raises(ValueError, match="ends within"):
        list(warc.records(io.BytesIO(gzip.compress(gzip.decompress(raw)[:-3]))))
    open(f"{tmp_path}/a/{name}.orphan", "wb").write(raw)      # what no manifest names does not count
    assert warc.read(spark, f"{tmp_path}/a").count() == len(rows)


def test_archive_query_equals_sql_and_empty(spark, tmp_path):
    rows = [r for r in page_rows(4, 150) + ODD_PAGES if r[0] is not None]
    pages(spark, rows).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    got = QUERIES["op11_warc"](spark, str(tmp_path))
    assert got.columns == list(ROW)
    assert by_id(got.collect()) == by_id(con.execute(ORACLE_SQL["op11_warc"]).fetchall()) == by_id(brute_pages(rows))
    assert warc.archive(pages(spark, rows).where("false")).collect() == []
