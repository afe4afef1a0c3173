import zlib
from collections import Counter

import corpus_pipeline as cp
from surestar.llm import simhash_dedup as sd
from surestar.llm.common import store
from surestar.llm.queries import QUERIES
from tests.llm.test_mixing_packing import WORD, brute_mix, check_packing
from tests.llm.test_simhash_dedup import components, slow_fingerprint


def test_stages_one_by_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(cp.STAGES)
    assert list(stages) == ["quality", "simhash_dedup", "mixing", "packing"]

    kept = store(stages["quality"](spark, docs, folder))
    assert kept.columns == docs.columns
    predicted = {r.doc_id: r.predicted for r in QUERIES["op10_quality"](spark, folder).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, p in predicted.items() if p)

    single = store(stages["simhash_dedup"](spark, kept, folder))
    rows = kept.collect()
    want = components([slow_fingerprint(r.text, 3) for r in rows], 3, [r.doc_id for r in rows])
    assert single.columns == docs.columns and sorted(r.doc_id for r in single.collect()) == sorted(set(want))

    mixed = store(stages["mixing"](spark, single, folder))
    taken, _ = brute_mix([(r.doc_id, r.text, r.source) for r in single.collect()])
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
    assert mixed.columns == docs.columns and words == +Counter({i: n for i, _, _, n in taken})

    packed = stages["packing"](spark, mixed, folder).collect()
    check_packing([(r.doc_id, r.text, r.source) for r in mixed.collect()], packed, 2048, 1)

    key = lambda r: str(tuple(r))
    assert sorted(map(key, cp.run(spark, folder).collect())) == sorted(map(key, packed))


def test_stages_take_empty_tables(spark, folder, no_docs):
    for _, stage in cp.STAGES:
        assert stage(spark, no_docs, folder).count() == 0


def test_stages_take_odd_rows(spark, folder, docs):
    got = docs
    for _, stage in cp.STAGES[:-1]:
        got = store(stage(spark, got, folder))
        assert got.columns == cp.COLUMNS
    assert cp.STAGES[-1][1](spark, got, folder).count() >= got.count()


def test_held_out_labels_are_not_learned():
    assert zlib.crc32(b"0") % 5 != 0  # the sample in the query leaves ids with remainder 0 out
    assert sd.SEED == 42 and cp.ORACLE_SQL is None
