import random
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from surestar.llm import quality
from surestar.llm.queries import QUERIES


def made(n, seed=1):
    """Clean texts and texts in which half the words carry marks."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("aeioubcdlmnrst", k=rng.randint(2, 9))) for _ in range(500)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 80))]
        if good := rng.random() < 0.7:
            text[0] = text[0].capitalize()
        else:
            text = [w.upper() + "!!" if rng.random() < 0.5 else w for w in text]
        rows.append((i, " ".join(text) + ".", int(good)))
    return rows


def test_held_out_accuracy(spark):
    rows = made(600)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, bool(g)) for i, _, g in rows if i % 3], "doc_id long, good boolean")
    model = quality.fit_quality(docs, labels, max_rows=300)
    scores = {r.doc_id: r.s for r in docs.select("doc_id", quality.quality_score(model, F.col("text")).alias("s")).collect()}
    held = [(scores[i] >= 0.5) == bool(g) for i, _, g in rows if i % 3 == 0]
    assert np.mean(held) > 0.97


def test_dual_coordinate_descent_finds_the_minimum():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 4))
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=60) > 0, 1.0, -1.0)
    w = quality.dual_coordinate_descent([(np.arange(4), r) for r in x], y, 4, 0.5, 400)

    def loss(v):
        return 0.5 * v @ v + 0.5 * np.maximum(0, 1 - y * (x @ v)).sum()

    assert all(loss(w) <= loss(w + d) + 1e-3 for d in rng.normal(scale=0.05, size=(200, 4)))


def test_features_are_ngrams_of_the_whole_text():
    places = np.zeros(1 << quality.BITS, np.int32)
    text = "ab " * 3
    found = quality.features(text, places)
    assert len(found) == len(set(found)) > 0
    far = "x" * 1_500_000 + " ###"
    assert set(quality.features("###", places)) - set(quality.features("x" * 1_500_000, places)) <= set(quality.features(far, places)) | set(
        quality.features("###", places)
    )
    assert len(set(quality.features(far, places)) - set(quality.features("x" * 1_500_000, places))) > 3


def test_odd_rows_and_labels(spark, docs, no_docs):
    empty = spark.createDataFrame([], "doc_id long, good boolean")
    model = quality.fit_quality(docs, empty)
    found = docs.select(quality.quality_score(model, F.col("text")).alias("p")).collect()
    assert {round(r.p, 6) for r in found} == {0.5} and len(found) == docs.count()
    one_class = spark.createDataFrame([(1, True), (2, True), (None, True), (3, None), (1, True)], "doc_id long, good boolean")
    model = quality.fit_quality(docs, one_class)
    assert model.score(pd.Series([None, "", "x"])).tolist() == [0.75] * 3
    both = spark.createDataFrame([(1, True), (5, False), (2, True), (6, False), (13, True)], "doc_id long, good boolean")
    model = quality.fit_quality(docs, both)
    scores = model.score(pd.Series([None, "", "a b"]))
    assert scores[0] == scores[1] and ((scores >= 0) & (scores <= 1)).all()
    assert no_docs.select(quality.quality_score(model, F.col("text"))).count() == 0


def test_query(spark, folder):
    out = QUERIES["op10_quality"](spark, folder).toPandas()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas().set_index("doc_id").quality
    assert sorted(out.columns) == ["doc_id", "held_out", "predicted", "score"]
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]).all()
    assert (out.predicted == (out.score >= 0.3)).all()
    known = out[out.doc_id.isin(labels.index)].set_index("doc_id")
    assert (known.predicted == labels[known.index]).mean() > 0.9


def test_a_repeated_id_is_fitted_once(spark):
    rows = made(200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, bool(g)) for i, _, g in rows], "doc_id long, good boolean")
    once = quality.fit_quality(docs, labels, max_rows=100)
    again = docs.unionByName(spark.createDataFrame([r[:2] for r in rows[:100] for _ in range(20)], docs.schema)).repartition(5)
    more = quality.fit_quality(again, labels, max_rows=100)
    assert np.allclose(once.weights, more.weights) and np.allclose([once.bias, once.slope, once.offset], [more.bias, more.slope, more.offset])
