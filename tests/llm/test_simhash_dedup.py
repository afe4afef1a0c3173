import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from surestar.llm import simhash_dedup as sd
from surestar.llm.common import connected_components, merged_components
from surestar.llm.queries import QUERIES


def slow_fingerprint(text, n):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, radius, label):
    """Smallest label reachable from each value by brute force."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(values)):
        groups.setdefault(find(i), []).append(label[i])
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(values))]


def family(rng, n, flips=9):
    base = [int(x) for x in rng.integers(0, 2**63, max(1, n // 20))]
    out = []
    for _ in range(n):
        x = base[rng.integers(len(base))]
        for b in rng.integers(0, 64, rng.integers(0, flips)):
            x ^= 1 << int(b)
        out.append(x)
    return out


def test_bucket_links_connect_like_brute_force():
    rng = np.random.default_rng(5)
    for radius in range(1, 7):
        values = sorted(set(family(rng, 400)))
        bucket = rng.integers(0, 4, len(values))
        u, v = sd.bucket_links(bucket, np.array(values, np.uint64), radius)
        for k in range(4):
            own = [x for x, b in zip(values, bucket, strict=True) if b == k]
            root = {x: x for x in own}

            def find(x, root=root):
                while root[x] != x:
                    x = root[x]
                return x

            for a, b in zip(u.tolist(), v.tolist(), strict=True):
                if a in root:
                    assert (b in root) and a != b
                    root[find(a)] = find(b)
            want = components(own, radius, own)
            got = {x: min(y for y in own if find(y) == find(x)) for x in own}
            assert [got[x] for x in own] == want


def test_near_links_over_slices(spark):
    rng = np.random.default_rng(6)
    values = sorted(set(family(rng, 700, 5)))
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    for radius, slice_rows in ((3, 512), (3, 16), (1, 8), (6, 64)):
        links = sd.near_links(frame, radius, slice_rows).collect()
        assert all((r.u ^ r.v).bit_count() and ((r.u & (2**64 - 1)) ^ (r.v & (2**64 - 1))).bit_count() <= 64 for r in links)
        root = connected_components(sd.near_links(frame, radius, slice_rows)).collect()
        found = {r.node: r.root for r in root}
        want = components(values, radius, signed)
        assert [found.get(x, x) for x in signed] == want


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (7, 6), (300, 301), (301, 300)]
    rows = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    found = {r.node: r.root for r in rows}
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}, 301: 300}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def _jobs(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = sorted(map(tuple, run().collect()))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_edges_that_are_stars_cost_one_aggregate(spark):
    edges = spark.createDataFrame([(9, 1), (1, 5), (7, 1), (8, 3), (4, 4)], "u long, v long")
    found, jobs = _jobs(spark, "stars", lambda: connected_components(edges))
    assert found == [(5, 1), (7, 1), (8, 3), (9, 1)]
    chain, more = _jobs(spark, "chain", lambda: connected_components(spark.createDataFrame([(i, i + 1) for i in range(20)], "u long, v long")))
    assert chain == [(i, 0) for i in range(1, 21)]
    assert jobs <= 7 < more


def test_merged_components(spark):
    frame = lambda rows: spark.createDataFrame(rows, "u long, v long")
    edges, between = [(1, 2), (2, 3), (10, 11), (20, 21), (30, 31)], [(10, 1), (20, 10), (30, 40), (50, 60)]
    merged = merged_components(connected_components(frame(edges)), frame(between)).collect()
    assert sorted(merged) == sorted(connected_components(frame(edges + between)).collect())
    assert sorted(merged_components(connected_components(frame([])), frame(between)).collect()) == sorted(connected_components(frame(between)).collect())
    assert sorted(merged_components(connected_components(frame(edges)), frame([])).collect()) == sorted(connected_components(frame(edges)).collect())


def test_documents(docs, documents, no_docs):
    out = sd.near_duplicates(docs).collect()
    values = [slow_fingerprint(r[1], 3) for r in documents]
    want = components(values, 3, [r[0] for r in documents])
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in out), key=key) == sorted(zip([r[0] for r in documents], signed, want, strict=True), key=key)
    kept = sd.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({w for w in want if w is not None})
    assert ids.count(None) == 1  # the text without an id is like no other; the empty one is like document 3
    assert sd.keep_first(no_docs).count() == 0 and sd.near_duplicates(no_docs).count() == 0


def test_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    values = [slow_fingerprint(r.text, 3) for r in docs]
    want = components(values, 3, [r.doc_id for r in docs])
    out = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op7_simhash_dedup"](spark, folder).collect()}
    assert out == {r.doc_id: (f"{v:016x}", w) for r, v, w in zip(docs, values, want, strict=True)}


def test_fingerprint_of_a_column(spark):
    texts = [None, "", "a", "A b", "The É x  y\tz Q", "w " * 50]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(sd.simhash(F.col("text"), 3).alias("fp")).collect()
    assert [r.fp & (2**64 - 1) for r in rows] == [slow_fingerprint(t, 3) for t in texts]


def test_an_id_with_different_texts_keeps_each_of_them(spark):
    rng = np.random.default_rng(5)
    new = lambda: " ".join(f"w{n}" for n in rng.integers(0, 10**6, 40))
    shared, texts = new(), [new() for _ in range(30)]
    rows = [(3, shared), (5, shared), (5, texts[0]), (5, texts[0]), (None, texts[1]), (None, texts[1].upper()), *[(9, t) for t in texts[2:]]]
    want = sorted([(3, shared), (5, texts[0]), *[(9, t) for t in texts[2:]]])
    for parts in (1, 7):
        kept = sd.keep_first(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
        assert sorted((r.doc_id, r.text) for r in kept if r.doc_id is not None) == want
        assert [r.text.lower() for r in kept if r.doc_id is None] == [texts[1]]
