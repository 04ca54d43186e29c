"""Registered queries of this package, over the driver's tables, and their SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.llm import bpe, language, lines, nndescent, packing, partenum, quality, runs, suffix, topk, toxicity, \
    variants, warc
from tidewatch.llm.common import remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


def _held(divisor: int, at: int):
    return F.coalesce(remainder("doc_id", divisor) == at, F.lit(False)).alias("held_out")


def _verdict(scored: DataFrame, divisor: int, at: int, *more: str) -> DataFrame:
    return scored.select("doc_id", _held(divisor, at), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         *more)


@query
def op1_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    index = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _verdict(toxicity.score(docs, index), 5, 0, "evidence")


@query
def op3_bpe(spark, sf_dir):
    return bpe.encode(table(spark, sf_dir, "documents"))


@query
def op5_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    forest = quality.fit(docs, table(spark, sf_dir, "labels"))
    return _verdict(quality.score(docs, forest), 3, 1)


@query
def op6_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.fit(docs))
    return found.select(F.col("doc_id").cast("long"), _held(4, 2), "lang_pred", F.col("lang_score").alias("score"),
                        F.col("lang_rejected").alias("rejected"))


@query
def op9_exact_topk(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"))


ORACLE_SQL["op9_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
       vec_id, score
FROM p QUALIFY rank <= 5
"""


@query
def op10_line_dedup(spark, sf_dir):
    cleaned = lines.remove(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE_SQL["op10_line_dedup"] = """
WITH t AS (
  SELECT coalesce(text, '') AS text, min(source) AS site FROM documents WHERE source IS NOT NULL GROUP BY 1),
v AS (SELECT trim(line) AS k, site FROM (SELECT site, unnest(string_split(text, chr(10))) AS line FROM t)),
b AS (SELECT k FROM v WHERE k <> '' GROUP BY k HAVING count(DISTINCT site) >= 10),
l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents)
SELECT doc_id, count(*) AS n_lines, count(k) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE k IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN b ON trim(line) = k GROUP BY doc_id
"""


@query
def op4_suffix_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    left = suffix.remove(docs, suffix.repeated_spans(docs), columns=("doc_id",))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL["op4_suffix_dedup"] = """
WITH b AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, unnest(range(0, n - 199)) AS i, h FROM b WHERE n >= 200),
k AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 400)) AS m FROM w),
r AS (SELECT doc_id, i FROM k QUALIFY count(*) OVER (PARTITION BY m) > 1),
f AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS fresh FROM r),
g AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM f),
spans AS (SELECT doc_id, s, min(i) AS a, max(i) + 200 AS z FROM g GROUP BY 1, 2),
kept AS (
  SELECT doc_id, s, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS lo, a AS hi FROM spans
  UNION ALL
  SELECT b.doc_id, 1000000000, coalesce(max(z), 0), any_value(n) FROM b LEFT JOIN spans USING (doc_id) GROUP BY b.doc_id),
rest AS (
  SELECT doc_id, string_agg(substr(h, 2 * lo + 1, 2 * (hi - lo)), '' ORDER BY s) AS left_over
  FROM kept JOIN b USING (doc_id) GROUP BY doc_id)
SELECT b.doc_id, n AS n_bytes, coalesce(sum(z - a), 0)::BIGINT AS n_removed, count(s) AS n_spans,
       sha256(unhex(any_value(left_over))) AS kept_sha256
FROM b JOIN rest USING (doc_id) LEFT JOIN spans USING (doc_id) GROUP BY b.doc_id, n
"""


@query
def op7_ngram_jaccard(spark, sf_dir):
    return partenum.classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


ORACLE_SQL["op7_ngram_jaccard"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g
  FROM w),
d AS (SELECT DISTINCT doc_id, g FROM s),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM d a JOIN d b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
c(node, label) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT l.b, c.label FROM c JOIN l ON l.a = c.node)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(label) AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN c ON c.node = w.doc_id GROUP BY w.doc_id
"""


@query
def op8_nn_descent(spark, sf_dir):
    return nndescent.search(table(spark, sf_dir, "embeddings"))


@query
def op11_warc(spark, sf_dir):
    return warc.archive(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                              "refers_to")


ORACLE_SQL["op11_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM p),
r AS (SELECT *, payload_bytes >= 1000 AND top IS NOT NULL AND page_id IS DISTINCT FROM top AS again FROM m)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN top END AS refers_to
FROM r
"""


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's planted periods: in some documents the words from a place on repeat."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a:a + p]
    return words[:a] + (tail * ((n - a) // p + 1))[:n - a]


@query
def op12_runs(spark, sf_dir):
    found = runs.detect(table(spark, sf_dir, "documents"), edit=repeat_tail)
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                     r["period"].cast("string")))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"strongest.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * strongest.length DIV strongest.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def misspell(doc_id: int | None, counts: dict[str, int]) -> dict[str, int]:
    """The contract's planted variants: of some words of some documents one code point goes."""
    begun = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: dict[str, int] = {}
    for word, n in counts.items():
        h = zlib.crc32(word.encode(), begun)
        if h % 97 == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
        out[word] = out.get(word, 0) + n
    return out


@query
def op13_spelling_variants(spark, sf_dir):
    return variants.group(table(spark, sf_dir, "documents"), edit=misspell)
