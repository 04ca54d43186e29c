"""Exact top-k and NN-descent against brute force."""

import math

import duckdb
import numpy as np
import pytest

from tidewatch.llm import nndescent, topk
from tidewatch.llm.queries import ORACLE_SQL, QUERIES

VEC = "vec_id long, embedding array<float>, label int, node long, x string, block int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "a", 2) for i, v in rows], VEC)


def random_rows(seed, n, width=8, step=1):
    r = np.random.default_rng(seed)
    return [(k * step, [float(x) for x in r.normal(size=width).astype(np.float32)]) for k in range(n)]


ODD = [(900, None), (901, []), (902, [None, 1.0]), (903, [math.nan] * 8), (904, [math.inf] * 8), (None, [1.0] * 8)]


def usable(rows, zero):
    return [(i, v) for i, v in rows if i is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))]


def dot(a, b):
    return sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b))


def brute_topk(rows, k, every):
    rows = usable(rows, True)
    out = []
    for q, a in rows:
        if q % every == 0:
            best = sorted((-dot(a, b), i) for i, b in rows if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block_rows,query_rows", [(16_384, 2_048), (40, 5)])
def test_exact_topk(spark, block_rows, query_rows):
    rows = random_rows(1, 200) + ODD + [(950, [0.0] * 8), (951, [0.25, -0.5])] + [(960 + k, [1.0] * 8) for k in range(9)]
    got = topk.search(vectors(spark, rows), every=10, block_rows=block_rows, query_rows=query_rows).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute_topk(rows, 5, 10)


def test_exact_topk_few_rows_repeats_and_huge_values(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0, 4.0]), (0, [1.0, 2.0])]
    got = topk.search(vectors(spark, rows), every=1).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 256 * 256 * 11), (1, 1, 0, 256 * 256 * 11)]
    (a, b) = topk.search(vectors(spark, [(0, [3e38]), (1, [3e38])]), every=1).collect()
    assert a.score == b.score == 2 ** 63 - 1
    assert topk.search(vectors(spark, [])).count() == 0


def test_topk_query_equals_sql(spark, tmp_path):
    rows = random_rows(2, 120) + ODD[2:5]
    vectors(spark, rows).coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = QUERIES["op9_exact_topk"](spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    cur = con.execute(ORACLE_SQL["op9_exact_topk"])
    names = [c[0] for c in cur.description]
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(cur.fetchall())


def brute_near(rows, k, every):
    rows = usable(rows, False)
    width = max(len(v) for _, v in rows)
    x = np.array([v + [0.0] * (width - len(v)) for _, v in rows], float)
    ids = np.array([i for i, _ in rows])
    out = {}
    for q in sorted(set(ids[ids % every == 0].tolist())):
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        best = sorted({(round(float(d[j]), 9), int(ids[j])) for j in range(len(ids)) if ids[j] != q})[:k]
        out[q] = best
    return out


def grouped(got):
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((round(r.score, 9), r.vec_id))
    return out


def test_small_tables_are_searched_whole(spark):
    rows = random_rows(3, 60, step=5) + ODD + [(950, [0.0] * 8), (951, [0.25, -0.5])]
    got = grouped(nndescent.search(vectors(spark, rows)).collect())
    assert got == brute_near(rows, 10, 100)
    assert nndescent.search(vectors(spark, [])).count() == 0
    two = nndescent.search(vectors(spark, [(0, [1.0, 0.0]), (7, [0.0, 1.0])])).collect()
    assert [(r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in two] == [(0, 1, 7, round(2 ** 0.5, 12))]


def test_copies_are_answered_by_smallest_ids(spark):
    rows = [(k, [1.0, 2.0, 3.0]) for k in range(300)] + random_rows(4, 5, width=3, step=1000)[1:] + [(300, [1.0, 2.0, 3.0])] * 2
    got = grouped(nndescent.search(vectors(spark, rows)).collect())
    assert got == brute_near(rows, 10, 100)


def test_recall_on_the_graph(spark):
    rows = random_rows(6, 3000, width=16)
    got = grouped(nndescent.search(vectors(spark, rows), leaf=100).collect())
    want = brute_near(rows, 10, 100)
    hit = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert set(got) == set(want) and hit >= 0.9 * 10 * len(want)
    assert all(len(v) == 10 for v in got.values())


def recall(rows, got, want):
    return sum(len({i for _, i in got.get(q, [])} & {i for _, i in want[q]}) for q in want) / sum(map(len, want.values()))


def clustered(seed, n, width):
    """A third of the vectors in one narrow cluster far from the rest."""
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, width))
    x[:n // 3] = 50 + 0.01 * r.normal(size=(n // 3, width))
    return [(k, [float(v) for v in row]) for k, row in enumerate(x[r.permutation(n)])]


@pytest.mark.parametrize("shift,n", [(0.0, 2500), (100.0, 4000), (1000.0, 6000), (1e25, 2000)])
def test_recall_with_production_settings(spark, shift, n):
    r = np.random.default_rng(int(shift) % 97 + n)
    scale = 1e24 if shift > 1e20 else 1.0                  # finite components whose squares are not
    rows = [(k, [float(v) for v in row]) for k, row in enumerate((shift + scale * r.normal(size=(n, 32))).astype(np.float32))]
    got = grouped(nndescent.search(vectors(spark, rows)).collect())
    want = brute_near(rows, 10, 100)
    assert set(got) == set(want) and recall(rows, got, want) >= 0.9


def test_recall_with_a_third_in_one_cluster(spark):
    rows = clustered(8, 4500, 16)
    got = grouped(nndescent.search(vectors(spark, rows)).collect())
    want = brute_near([(i, [float(np.float32(x)) for x in v]) for i, v in rows], 10, 100)
    assert recall(rows, got, want) >= 0.9


def test_one_outlier_does_not_blur_the_rest(spark):
    rows = random_rows(9, 2000, width=16) + [(5000, [3e38] * 16), (5001, [-3e38] * 16)]
    got = grouped(nndescent.search(vectors(spark, rows)).collect())
    want = brute_near(rows, 10, 100)
    inner = {q: w for q, w in want.items() if q < 5000}
    assert recall(rows, got, inner) >= 0.9


def test_buckets_of_one_place_are_parted(spark):
    """More vectors on one side of every plane than leaves hold are split until they fit."""
    rows = [(k, v) for k, v in clustered(3, 3000, 8)]
    base = nndescent.cut(nndescent.nodes_of(vectors(spark, rows), 10))
    centre, spread = nndescent.centre_of(base, 4096)
    nodes = spark.createDataFrame([(r.node, nndescent._codes(np.array([r.x]), centre, spread)[0].tobytes()) for r in base.collect()],
                                  "node long, code binary")
    out = nndescent._buckets(nodes, 3000, 8, 2, 50).groupBy("bucket", "part").count().collect()
    assert max(r["count"] for r in out) <= 100 and sum(r["count"] for r in out) == 2 * nodes.count()


def test_exact_topk_of_an_id_on_a_third_of_the_rows(spark):
    rows = random_rows(12, 90) + [(0, [float(x) for x in v]) for _, v in random_rows(13, 45)]
    least = {}
    for i, v in rows:
        least[i] = min(least.get(i, v), v)
    got = topk.search(vectors(spark, rows).repartition(5), k=5, every=10, block_rows=20).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute_topk(sorted(least.items()), 5, 10)
