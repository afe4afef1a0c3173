import hashlib
import random

import numpy as np

from surestar.llm import fingerprints as fp
from surestar.llm.queries import QUERIES


def test_next_is_the_next_id(docs, documents, spark, no_docs):
    out = [(r.doc_id, r.text, r.next_id, r.next_text) for r in fp.with_next(docs).collect()]
    numbered = sorted((r[0], r[1] or "") for r in documents if r[0] is not None)
    assert len(out) == len(documents)
    found = sorted((a, b, c, d) for a, b, c, d in out if a is not None and c is not None)
    want = sorted((*x, *y) for x, y in zip(numbered, numbered[1:], strict=False))
    assert found == want
    nameless = [x for x in out if x[0] is None]
    assert sorted(x[1] for x in nameless) == ["", "nameless text without an id"]
    assert [x[2:] for x in nameless if x[2] is not None] == [numbered[0]]
    assert fp.with_next(no_docs).count() == 0


def test_next_over_sparse_ids(spark):
    rng = random.Random(3)
    ids = sorted({rng.randint(-(2**62), 2**62) for _ in range(300)} | set(range(1000, 2300)) | {2**63 - 1, -(2**63)})
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    out = {r.doc_id: (r.next_id, r.next_text) for r in fp.with_next(df).collect()}
    assert out == {a: (b, f"t{b}") for a, b in zip(ids, ids[1:] + ids[:1], strict=True)}


def test_within_radius_equals_brute_force(spark):
    rng = np.random.default_rng(9)

    def some(n):
        base = rng.integers(-(2**63), 2**63, (4, 2))
        out = set()
        for _ in range(n):
            a, b = (int(x) & (2**64 - 1) for x in base[rng.integers(4)])
            value = a | b << 64
            for bit in rng.integers(0, 128, rng.integers(0, 7)):
                value ^= 1 << int(bit)
            out.add(value)
        return out

    def frame(values, names):
        rows = [(np.uint64(v & (2**64 - 1)).view(np.int64).item(), np.uint64(v >> 64).view(np.int64).item()) for v in values]
        return spark.createDataFrame(rows, f"{names[0]} long, {names[1]} long")

    index = some(150)
    queries = set(list(index)[:60]) | some(20)
    for radius in (0, 1, 3, 6):
        rows = fp.within_radius(frame(queries, ("q0", "q1")), frame(index, ("f0", "f1")), radius).collect()
        whole = lambda a, b: (a & (2**64 - 1)) | (b & (2**64 - 1)) << 64
        found = [(whole(r.q0, r.q1), whole(r.f0, r.f1)) for r in rows]
        want = {(q, f) for q in queries for f in index if (q ^ f).bit_count() <= radius}
        assert len(found) == len(set(found)) and set(found) == want


def test_rows_and_votes(docs, documents, no_docs):
    rows = fp.edited_fingerprints(docs).collect()
    assert len(rows) == len(documents)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and len(r.fingerprint) == len(r.edited_fingerprint) == 32
    assert by_id[1][0].fingerprint == by_id[2][0].fingerprint  # equal but for case and white space
    assert by_id[3][0].fingerprint == "0" * 32 and by_id[3][0].near_edited == 1
    assert len(by_id[7]) == 2 and by_id[7][0].fingerprint == by_id[7][1].fingerprint
    assert fp.edited_fingerprints(no_docs).count() == 0


def test_plan_is_native(spark, folder):
    plan = fp.simhash(spark.read.parquet(f"{folder}/documents.parquet"), ["doc_id"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query(spark, folder):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    out = {r.doc_id: r for r in QUERIES["op8_fingerprints"](spark, folder).collect()}
    number = {i: int(r.fingerprint, 16) for i, r in out.items()}
    better = 0
    for (i, text), (j, following) in zip(docs, docs[1:] + docs[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        got = out[i]
        assert (got.n_chars, got.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(got.near_next - (1 - (number[i] ^ number[j]).bit_count() / 128)) < 1e-12
        edit = int(got.edited_fingerprint, 16)
        assert abs(got.near_edited - (1 - (number[i] ^ edit).bit_count() / 128)) < 1e-12
        assert got.edited_hits == sum((edit ^ x).bit_count() <= 3 for x in number.values())
        better += got.near_edited > got.near_next
    assert better > 0.95 * len(docs)
