"""The pipeline's stages against brute force, one after the other."""

import random

import pytest

import corpus_pipeline as pipeline
from brute import by_id, jaccard_classes, repeated_bytes, words
from tidewatch.llm import lines
from tidewatch.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(spark):
    r = random.Random(9)
    rows = [(k, r_.text, r_.lang, f"src{k % 20}") for k, r_ in enumerate(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) > 300").orderBy("doc_id").collect()[:80])]
    shared = words(7, 60)
    rows = [(k, f"{t}\nCookie notice: accept all" + ("\n" + shared if k % 5 == 0 else ""), a, b) for k, t, a, b in rows]
    for k in range(100, 130):                              # exact and near copies
        t = rows[r.randrange(60)]
        w = t[1].split(" ")
        if k % 2:
            w[r.randrange(len(w))] = "edited"
        rows.append((k, " ".join(w), t[2], t[3]))
    rows += [(200, None, "en", "s"), (201, "", "en", "s"), (202, "12345 67", None, None), (203, "Привет мир, как дела? " * 40, None, "s")]
    return rows


def documents(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOCS)


def test_stages_against_brute_force(spark):
    rows = corpus(spark)
    docs = documents(spark, rows)
    one = pipeline.language_id(spark, docs, "").cache()
    assert one.columns == docs.columns
    kept = {r.doc_id for r in one.collect()}
    assert kept == {r[0] for r in rows} - {200, 201, 202, 203}
    two = pipeline.line_dedup(spark, one, "").cache()
    text = {r.doc_id: r for r in two.collect()}
    assert set(text) == kept and two.columns == docs.columns
    assert not any("Cookie notice" in r.text for r in text.values()) and all(len(r.text) == r.n_chars for r in text.values())
    three = pipeline.ngram_jaccard(spark, two, "").cache()
    pairs = [(d, r.text) for d, r in text.items()]
    assert {r.doc_id for r in three.collect()} == {c for _, _, c in jaccard_classes(pairs)}
    four = pipeline.suffix_dedup(spark, three, "").cache()
    assert four.columns == docs.columns
    before = sorted((r.doc_id, r.text) for r in three.collect())
    want = {d: x[0] - x[1] for (d, _), x in zip(before, repeated_bytes([t for _, t in before], 200))}
    after = {r.doc_id: r for r in four.collect()}
    assert {d: len(r.text.encode()) for d, r in after.items()} == pytest.approx(want, abs=3)   # cut characters go
    assert sum(want.values()) < sum(len(t.encode()) for _, t in before)
    five = pipeline.pack(spark, four, "").collect()
    assert {p.doc_id for p in five} == set(after)
    for df in (one, two, three, four):
        df.unpersist()


def test_pipeline_query_and_odd_tables(spark, tmp_path):
    rows = [(1, None, None, None), (2, "", "en", "a"), (None, words(1, 50), "en", "a"), (4, words(2, 60), "en", "a"),
            (4, words(2, 60), "en", "a"), (5, words(2, 60), "en", "b")]
    documents(spark, rows).coalesce(1).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    found = pipeline.run(spark, str(tmp_path / "a")).collect()
    assert by_id({(p.doc_id,) for p in found}) == by_id({(None,), (4,)})
    assert sum(p.doc_id == 4 for p in found) == 1
    documents(spark, rows).where("false").write.parquet(str(tmp_path / "b" / "documents.parquet"))
    assert pipeline.run(spark, str(tmp_path / "b")).count() == 0


def test_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names) and [n for n, _ in pipeline.STAGES][-1] == "packing"
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert lines.RESULT[1] == "n_removed"
