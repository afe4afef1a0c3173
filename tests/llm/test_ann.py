import numpy as np
from pyspark.sql import functions as F

from surestar.llm import ann
from surestar.llm.queries import QUERIES


def exact(ids, x, queries, k):
    out = {}
    for q, v in queries:
        score = np.sqrt(((x - v) ** 2).sum(1))
        rows = sorted({(s, i) for s, i in zip(score, ids, strict=True) if i != q})[:k]
        out[q] = rows
    return out


def test_walk_visits_pairs_by_summed_distance():
    rng = np.random.default_rng(1)
    near, far, counts = rng.random(7), rng.random(5), rng.integers(0, 4, (7, 5))
    found = ann.walk(near, far, counts, 10**9)
    sums = [near[p // 5] + far[p % 5] for p in found]
    assert sums == sorted(sums) and set(found) == set(np.flatnonzero(counts.ravel()))
    few = ann.walk(near, far, counts, 6)
    assert few == found[: len(few)] and counts.ravel()[few].sum() >= 6 > counts.ravel()[few[:-1]].sum()


def test_all_candidates_is_exact_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(120, 6)), np.tile([1.0, 0, 0, 0, 0, 0], (60, 1)), [[-0.0, 1, 2, 3, 4, 5], [0.0, 1, 2, 3, 4, 5]]])
    ids = rng.permutation(len(x)).tolist()
    rows = [(i, v.tolist()) for i, v in zip(ids, x, strict=True)]
    rows += [rows[0], rows[0], rows[150], rows[150]]
    odd = [(1000, None), (1010, []), (1020, [0.0] * 6), (1030, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1040, [float("nan")] * 6), (1050, [float("inf")] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr("*", "1 AS cell", "'v' AS v", "2 AS rank")
    want = exact(ids, x, [(i, v) for i, v in zip(ids, x, strict=True) if i % 10 == 0], 5)
    out = {}
    for r in ann.search(df, F.col("vec_id") % 10 == 0, 5, cells=4, candidates=10**6).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert out.keys() == want.keys()
    for q, found in out.items():
        assert [i for _, i in found] == [i for _, i in want[q]]
        assert np.allclose([s for s, _ in found], [s for s, _ in want[q]], rtol=1e-12)


def test_an_id_with_many_near_vectors_finds_the_others(spark):
    rng = np.random.default_rng(4)
    rows = [(0, (np.array([1.0, 0, 0, 0]) + 1e-3 * rng.normal(size=4)).tolist()) for _ in range(15)]
    rows += [(i, rng.normal(size=4).tolist()) for i in range(1, 40)] + [(7, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = {}
    for r in ann.search(df, F.col("vec_id") == 0, 10, cells=2, candidates=10**6, share=1.0).collect():
        out.setdefault(r.score, []).append((r.rank, r.vec_id))
    others = [(i, np.array(v)) for i, v in rows if i != 0]
    want = []
    for _, v in rows[:15]:
        near = sorted((float(np.sqrt(((np.array(v) - x) ** 2).sum())), i) for i, x in others)[:10]
        want += [(rank, i) for rank, (_, i) in enumerate(near, 1)]
    assert sorted(x for found in out.values() for x in found) == sorted(want) and len(want) == 150


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert ann.search(spark.createDataFrame([], schema), F.lit(True)).count() == 0
    one = spark.createDataFrame([(1, [1.0])], schema)
    assert ann.search(one, F.lit(True)).count() == 0
    two = spark.createDataFrame([(1, [1.0]), (2, [3.0])], schema)
    assert sorted(map(tuple, ann.search(two, F.lit(True)).collect())) == [(1, 1, 2, 2.0), (2, 1, 1, 2.0)]
    assert ann.search(two, F.lit(False)).count() == 0


def test_recall(spark, folder):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    want = exact(ids, x, [(i, v) for i, v in zip(ids, x, strict=True) if i % 100 == 0], 10)
    out = {}
    for r in QUERIES["op5_ann"](spark, "/root/testdata/sf0.1").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert all(sorted(r for r, _, _ in found) == list(range(1, 11)) for found in out.values())
    hits = sum(len({v for _, v, _ in out[q]} & {i for _, i in found}) for q, found in want.items())
    assert hits >= 0.9 * 10 * len(want)
