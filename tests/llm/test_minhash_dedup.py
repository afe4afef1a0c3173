"""MinHash near-duplicates against all pairs, and against their SQL."""

import random
from types import SimpleNamespace

import numpy as np
import pytest

from surestar.llm import minhash_dedup as m
from surestar.llm.queries import QUERIES, SQL
from tests.oracle import compare


def words_of(text):
    return (text or "").encode().translate(m._LOWER).split()


def brute(rows, percent=85):
    """Size of the set and smallest id reachable of each (id, text) row."""
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in least[find(i)] if x is not None]
        out.append((doc_id, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc_id))
    return sorted(map(str, out))


def found(df):
    return sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in df.collect())


def families(seed, groups, copies, words=60):
    """Near copies of some texts: with 0 to 8 words replaced each, so similarities lie on both sides of the bound."""
    rng = random.Random(seed)
    rows, doc_id = [], 1000
    for g in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(words + 40 * (g % 4))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(5)):
                text[rng.randrange(len(text))] = f"new{rng.randrange(10**6)}"
            rows.append((doc_id, " ".join(text)))
            doc_id += 1
    rng.shuffle(rows)
    return rows


def test_like_all_pairs(spark):
    rows = families(1, 12, 14)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(m.near_duplicates(df)) == brute(rows)


def test_odd_rows(spark, docs, documents):
    assert found(m.near_duplicates(docs)) == brute([(r[0], r[1]) for r in documents])


def test_slices_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(m, "SLICE_ROWS", 4)
    monkeypatch.setattr(m, "SLICE_SHINGLES", 600)
    rows = families(2, 3, 40) + [(i, "one text that many rows repeat word for word") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(m.near_duplicates(df)) == brute(rows)


def test_higher_similarity(spark):
    rows = families(3, 6, 8)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(m.near_duplicates(df, percent=95)) == brute(rows, 95)
    with pytest.raises(ValueError):
        m.near_duplicates(df, percent=50)


def test_no_rows(spark, no_docs):
    assert m.near_duplicates(no_docs).count() == 0


def test_keys_meet_all_pairs_within_the_radius(spark):
    rng = np.random.default_rng(5)
    rows, pairs = [], []
    for k in range(60):
        a = rng.integers(0, 2**16, m.POSITIONS).astype(np.uint16)
        b = a.copy()
        off = rng.choice(m.POSITIONS, m.RADIUS, replace=False)
        b[off] ^= rng.integers(1, 2**16, m.RADIUS).astype(np.uint16)
        for x in (a, b):
            rows.append((len(rows), *x.view(np.int64).tolist()))
        pairs.append((2 * k, 2 * k + 1))
    df = spark.createDataFrame(rows, ["row", *m._SIGNATURE])
    keys = {}
    for r in df.select("row", m._keys().alias("key")).collect():
        keys.setdefault(r.row, set()).add(r.key)
    assert all(keys[a] & keys[b] for a, b in pairs)
    joined = df.alias("a").join(df.alias("b"), (m.F.col("b.row") == m.F.col("a.row") + 1) & (m.F.col("a.row") % 2 == 0))
    assert {r[0] for r in joined.select(m._distance("a", "b")).collect()} == {m.RADIUS}


def test_rarest_members_are_shared():
    rng = np.random.default_rng(6)
    base = np.unique(rng.integers(0, 2**60, 100).astype(np.uint64))
    sets = []
    for k in range(40):
        keep = base[rng.random(len(base)) > 0.004 * k]
        sets.append(np.unique(np.concatenate((keep, rng.integers(0, 2**60, k // 4).astype(np.uint64)))))
    rare = [set(x) for x in m._rarest(sets, 85)]
    for i in range(40):
        for j in range(i):
            if m.similar(sets[i], sets[j]):
                assert rare[i] & rare[j]


def test_query_like_its_sql(spark, folder):
    name = "op13_minhash"
    assert compare(spark, folder, SimpleNamespace(run=QUERIES[name], sql=SQL[name])) == []
