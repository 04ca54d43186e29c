"""Repeated bytes, Jaccard classes and line removal against brute force."""

import hashlib
import random

import duckdb
import numpy as np
import pytest

from pyspark.sql import functions as F
from brute import by_id, frame, jaccard_classes, odd_rows, repeated_bytes, words
from tidewatch.llm import lines, partenum, shingles, suffix
from tidewatch.llm.components import components
from tidewatch.llm.queries import ORACLE_SQL


def removed(df, **settings):
    depth = settings.get("depth", 200)
    spans = suffix.repeated_spans(df, **settings)
    out = suffix.remove(df, spans, columns=("doc_id", "n_bytes"), broadcast_rows=settings.get("broadcast_rows", 1000))
    assert depth and out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    return by_id(out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect())


def want_removed(rows, depth=200):
    return by_id([(r[0], *x) for r, x in zip(rows, repeated_bytes([r[1] for r in rows], depth))])


def passages(seed, n_docs=40):
    """Texts that share passages at random places, with copies and edits."""
    r = random.Random(seed)
    shared = [words(100 + k, 50) for k in range(4)]
    rows = []
    for k in range(n_docs):
        t = words(seed * 1000 + k, r.randrange(5, 120))
        if r.random() < 0.6:
            s = r.choice(shared)
            t = t[:r.randrange(len(t))] + s[r.randrange(60):len(s) - r.randrange(60)] + t
        if rows and r.random() < 0.2:
            t = rows[r.randrange(len(rows))][1]
            if r.random() < 0.5:
                at = r.randrange(len(t))
                t = t[:at] + "EDIT" + t[at:]
        rows.append((k, t))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_bytes(spark, seed):
    rows = passages(seed)
    assert removed(frame(spark, rows)) == want_removed(rows)


def test_repeated_bytes_without_broadcast_and_large_groups(spark):
    rows = passages(3)
    assert removed(frame(spark, rows), broadcast_rows=0, max_group=1) == want_removed(rows)


@pytest.mark.parametrize("depth,gram,digit", [(12, 4, 5), (8, 8, 3)])
def test_repeated_bytes_small_depth(spark, depth, gram, digit):
    r = random.Random(depth)
    rows = [(k, "".join(r.choice("ab") for _ in range(r.randrange(0, 60)))) for k in range(60)]
    assert removed(frame(spark, rows), depth=depth, gram=gram, digit=digit) == want_removed(rows, depth)


def test_repeated_bytes_within_one_text_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(suffix, "BLOCK", 700)
    rows = [(1, words(5, 700)), (2, "xyz" * 500), (3, words(6, 100) + words(5, 700)[1000:2200])]
    assert removed(frame(spark, rows)) == want_removed(rows)


def test_repeated_bytes_odd_rows(spark):
    rows = odd_rows()
    assert removed(frame(spark, rows)) == want_removed(rows)
    assert removed(frame(spark, rows).where("false")) == []


def test_radix_passes_equal_sorted_windows():
    r = np.random.default_rng(3)
    data = r.integers(0, 2, 4000).astype(np.uint8)
    size = np.full(20, 200)
    a, c, t, s, n, m = suffix.runs_of(data, size, 12, 4)
    begin = t * 200 + s
    flags = suffix.repeated_windows(a, data, begin, n + 1, m, 12, 5)
    run = np.repeat(np.arange(len(s)), n + 1)
    start = begin[run] + np.arange(len(run)) - np.repeat(np.cumsum(n + 1) - (n + 1), n + 1)
    keys = [data[x:x + 12].tobytes() for x in start]
    assert [keys.count(k) > 1 for k in keys] == flags.tolist()


def near_copies(seed, n=60, length=120):
    """Texts at many similarities around the limit, small ones included."""
    r = random.Random(seed)
    rows = []
    for k in range(n):
        if rows and r.random() < 0.7:
            w = r.choice(rows)[1].split()
            for _ in range(r.randrange(0, 4)):
                w[r.randrange(len(w))] = f"e{r.randrange(50)}"
            if r.random() < 0.3:
                w = w[:max(1, len(w) - r.randrange(0, 8))]
            rows.append((k, " ".join(w)))
        else:
            rows.append((k, words(seed * 77 + k, r.randrange(3, length))))
    return rows


def found_classes(df, **settings):
    return by_id(partenum.classes(df, **settings).select("doc_id", "n_shingles", "component_id").collect())


@pytest.mark.parametrize("seed,settings", [(1, {}), (2, {"sub": (2, 1)}), (3, {"weak": 0.0, "hot": 0.0}),
                                           (4, {"sub": (3, 2), "broadcast_rows": 0})])
def test_jaccard_classes(spark, seed, settings):
    rows = near_copies(seed)
    assert found_classes(frame(spark, rows), **settings) == by_id(jaccard_classes(rows))


def test_jaccard_odd_rows(spark):
    rows = [*odd_rows(), (11, "ONE two Three"), (12, "one")]
    assert found_classes(frame(spark, rows)) == by_id(jaccard_classes(rows))
    assert found_classes(frame(spark, rows).where("false")) == []


def rows_made(df):
    """Rows that Generate and MapInArrow made when ``df`` was collected."""
    def nodes(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return nodes(plan.executedPlan())
        if kind.endswith("QueryStageExec"):
            return nodes(plan.plan())
        kids = plan.children()
        return [plan, *(n for k in range(kids.size()) for n in nodes(kids.apply(k)))]

    names = {"GenerateExec": "numOutputRows", "MapInArrowExec": "pythonNumRowsReceived"}
    return [n.metrics().apply(names[kind]).value() for n in nodes(df._jdf.queryExecution().executedPlan())
            if (kind := n.getClass().getSimpleName()) in names]


@pytest.mark.parametrize("chunk", [None, 120])
def test_shingles_of_a_large_group_are_counted_once_a_task(spark, monkeypatch, chunk):
    if chunk:
        monkeypatch.setattr(partenum, "SHARED", chunk)
    n, common = 200, 50
    members = {k: [*range(1000, 1000 + common), *range(10_000 + 100 * k, 10_000 + 100 * k + (2 if k % 2 else 40))] for k in range(n)}
    members[n] = [7, *members[0][-30:]]                    # most of it is in one other set only
    sets = spark.createDataFrame([(k, bytearray(np.array(m, np.int64).tobytes())) for k, m in members.items()],
                                 "ref long, members binary")
    rest = spark.createDataFrame([(s, k, 0, k) for k in members for s in (1, 2)], "sig long, ref long, lead long, label long")
    out = partenum._shared(rest, sets, 80)
    got = {r.ref: (r.size, r.common) for r in out.collect()}
    held = [h for m in members.values() for h in m]
    times = {h: held.count(h) for h in set(held)}
    want = {k: (len(m), sum(times[h] > 1 for h in m)) for k, m in members.items()}
    assert got == {k: (size, both) for k, (size, both) in want.items() if 100 * both >= 80 * size}
    if not chunk:                                          # each task makes a row for what its sets share once
        assert sum(rows_made(out)) <= 8 * common + len(set(held)) < len(held) / 2


def test_signatures_meet_within_the_limit():
    """Any two sets similar enough share a signature after the weak ones are left out."""
    r = np.random.default_rng(5)
    bands = partenum.Bands.of(80, (1, 1), 0.2, 0.08)
    for n in (5, 9, 30, 200):
        for _ in range(40):
            common = r.integers(1, 2 ** 63, n, dtype=np.uint64)
            extra = r.integers(1, 2 ** 63, n // 4 + 1, dtype=np.uint64)
            cut = int(r.integers(0, n // 4 + 1))
            a, b = np.unique(common), np.unique(np.concatenate((common, extra[:cut])))
            if 100 * len(np.intersect1d(a, b)) < 80 * len(np.union1d(a, b)) or len(a) == len(b):
                continue
            sig, number = partenum.signatures(np.concatenate((a, b)), np.array([len(a), len(b)]), bands, (1, 1))
            assert set(sig[:number[0]].tolist()) & set(sig[number[0]:].tolist())


def test_shingle_sets_match_plain_words():
    from brute import shingle_set
    many = [r[1] for r in odd_rows()] + ["A b\tC\x0bd e F", "a b c d e f", "a a a a a a a a"]
    h, count = shingles.shingle_sets(many)
    assert count.tolist() == [len(shingle_set(t)) for t in many]
    ends = np.cumsum(count)
    parts = [frozenset(h[e - n:e].tolist()) for e, n in zip(ends, count)]
    plain = [shingle_set(t) for t in many]
    for i in range(len(many)):
        for j in range(len(many)):
            assert len(parts[i] & parts[j]) == len(plain[i] & plain[j])


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(20)] + [(100, 100 + k) for k in range(1, 9)] + [(50, 49), (49, 50)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(21)}, **{100 + k: 100 for k in range(9)}, 49: 49, 50: 49}


def line_rows():
    rows = []
    for k in range(30):
        body = [words(k * 31 + j, 12) for j in range(6)]
        rows.append((k, "\n".join(["Accept all cookies ", *body, "", "(c) site"]), "en", f"s{k % 12}"))
    rows += [(40, "Accept all cookies", "en", "s1"), (41, None, "en", "s1"), (42, "", "en", None),
             (43, "Accept all cookies\n" + words(999, 30), "en", None), (None, "(c) site\n" + words(998, 40), "en", "s2")]
    return rows


@pytest.mark.parametrize("broadcast_lines", [0, 1000])
def test_line_spread(spark, broadcast_lines):
    out = lines.remove(frame(spark, line_rows()), broadcast_lines=broadcast_lines).collect()
    text = {r.doc_id: r for r in out}
    assert len(out) == 35
    assert text[0].n_removed == 2 and "cookies" not in text[0].text and text[0].text.count("\n") == 6
    assert text[40].n_removed == 1 and text[40].text == ""                  # nothing else: no document is exempt
    assert text[40].line_bytes == text[40].removed_bytes == 18
    assert text[41].text is None and text[41].n_lines == 1 and text[42].text == ""
    assert text[43].n_removed == 1 and text[None].n_removed == 1
    assert text[0].k1 == 7 and text[0].line == "x"                          # other columns stay


def test_line_spread_threshold_is_exact(spark):
    rows = [(k, f"nine\nten\n{words(k, 20)}" if k < 9 else f"ten\n{words(k, 20)}", "en", f"s{k}") for k in range(10)]
    out = {r.doc_id: r.n_removed for r in lines.remove(frame(spark, rows)).collect()}
    assert out == {k: 1 for k in range(10)}
    assert lines.remove(frame(spark, rows).where("false")).count() == 0


def test_line_spread_sketch_beyond_twice_the_threshold(spark):
    rows = [(k, f"all over\n{words(k, 20)}", "en", f"s{k}") for k in range(50)]
    out = {r.n_removed for r in lines.remove(frame(spark, rows), min_sites=10).collect()}
    assert out == {1}


def test_copies_of_a_text_vote_once(spark):
    copied = "\n".join(words(70 + j, 12) for j in range(5))
    rows = [(k, copied, "en", f"s{k}") for k in range(40)]
    rows += [(100 + k, f"shared line\n{words(k, 30)}", "en", f"s{k}") for k in range(10)]
    out = {r.doc_id: r for r in lines.remove(frame(spark, rows)).collect()}
    assert all(out[k].text == copied and out[k].n_removed == 0 for k in range(40))
    assert all(out[100 + k].n_removed == 1 for k in range(10))


def test_hashes_in_python_are_those_of_spark(spark):
    many = ["a", "Accept all cookies", "é日本語 🙂", "x" * 1000, " inner  space"]
    df = spark.createDataFrame([(t,) for t in many], "line string")
    assert [tuple(r) for r in df.select(*lines._hashes(F.col("line"))).collect()] == [lines.line_name(t) for t in many]


@pytest.mark.parametrize("broadcast_lines", [0, 1000])
def test_a_text_of_many_lines_takes_linear_time(spark, broadcast_lines):
    import time
    rows = [(k, f"notice\n{words(k, 20)}", "en", f"s{k}") for k in range(12)]
    rows += [(50, "notice\n" * 60_000 + "\n".join(str(j) for j in range(60_000)), "en", "s50")]
    docs = frame(spark, rows)
    found = lines.cut(lines.boilerplate(docs))
    began = time.time()
    out = {r.doc_id: r for r in lines._without(docs, found, broadcast_lines).collect()}
    assert time.time() - began < 20
    assert out[50].n_removed == 60_000 and out[50].n_lines == 120_000
    assert out[50].text == "\n".join(str(j) for j in range(60_000))


def test_line_query_equals_sql(spark, tmp_path):
    frame(spark, line_rows()).where("doc_id IS NOT NULL").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    from tidewatch.llm.queries import QUERIES
    got = QUERIES["op10_line_dedup"](spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    cur = con.execute(ORACLE_SQL["op10_line_dedup"])
    names = [c[0] for c in cur.description]
    assert by_id([tuple(r[n] for n in names) for r in got]) == by_id(cur.fetchall())
    assert hashlib.sha256(b"").hexdigest() in {r.kept_sha256 for r in got}


def test_pages_of_boilerplate_are_cleaned_and_copies_are_not(spark):
    """A page that is mostly boilerplate loses it; a text copied to many sites stays."""
    import corpus_pipeline
    body = [words(5000 + j, 12) for j in range(8)]
    rows = line_rows() + [(50, f"Accept all cookies\n{words(997, 2)}\n(c) site", "en", "s3")]
    rows += [(60 + k, "\n".join([*body[:7], f"{body[7]} edit{k}"]), "en", f"t{k}") for k in range(12)]
    rows += [(80, f"{body[0]}\nmine", "en", "s4")]
    docs = frame(spark, rows)
    assert {r.doc_id for r in lines.remove(docs).where("2 * removed_bytes > line_bytes").collect()} >= {40, 50, 60, 71}
    out = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert out[50] == words(997, 2) and out[40] == ""
    assert all(out[r[0]] == r[1] for r in rows if r[0] is not None and r[0] >= 60)
    assert out[0] == "\n".join([*[words(j, 12) for j in range(6)], ""])
