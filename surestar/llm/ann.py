"""Approximate nearest neighbours with an inverted multi-index.

Each half of the vectors has its own codebook, so ``cells`` squared pairs of centroids divide the space. The index holds every
vector under its pair. A query walks the pairs in the order of the sum of both squared distances, with a heap over the two
sorted lists, until the pairs it has seen hold enough vectors; these are reranked by the exact distance. Queries and index meet in blocks
of bounded size, in which a query looks at the entries of its own pairs only and keeps the nearest few.

The codebooks are fitted on a bounded sample (``sample_rows`` vectors, in the order of a hash); the index holds all rows. Equal
vectors are one entry that keeps its smallest ids, one more than are wanted: ties go to the smaller id, so no other copy can
be among the nearest, and a vector that a third of all rows share is read once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surestar.llm.common import lowest_by_hash, store


def usable(vector: Column) -> Column:
    """Whether a vector has components, all finite, and is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)[None, :], 0)


def fit_codebook(x: np.ndarray, cells: int, rounds: int = 12) -> np.ndarray:
    """Centroids of the rows by k-means; at most as many as there are different rows."""
    x = np.unique(x, axis=0)
    rng = np.random.default_rng(11)
    centres = x[rng.choice(len(x), min(cells, len(x)), replace=False)].copy()
    for _ in range(rounds):
        nearest = _squared(x, centres).argmin(1)
        for k in range(len(centres)):
            if (own := nearest == k).any():
                centres[k] = x[own].mean(0)
    return centres


def walk(near: np.ndarray, far: np.ndarray, counts: np.ndarray, candidates: int) -> list[int]:
    """Numbers of the pairs of centroids in the order of the summed distance, until they hold enough vectors.

    ``near`` and ``far`` are the distances to the centroids of both halves, ``counts`` the vectors per pair (first half by rows).
    """
    a, b = np.argsort(near, kind="stable"), np.argsort(far, kind="stable")
    heap, seen, found, held = [(near[a[0]] + far[b[0]], 0, 0)], {(0, 0)}, [], 0
    while heap and held < candidates:
        _, i, j = heapq.heappop(heap)
        if n := counts[a[i], b[j]]:
            found.append(int(a[i]) * counts.shape[1] + int(b[j]))
            held += int(n)
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (near[a[x]] + far[b[y]], x, y))
    return found


def nearest_in_block(queries: pd.DataFrame, entries: pd.DataFrame, k: int) -> pd.DataFrame:
    """For each query the ``k`` nearest entries, and all that tie with the last, among those in pairs it visits.

    Entries that hold the query's own id and no other are left out before, so each entry that counts gives a candidate.
    """
    names = ["query_id", "which", "score", "ids"]
    if not len(queries) or not len(entries):
        return pd.DataFrame({n: pd.Series([], dtype=object) for n in names})
    entries = entries.sort_values("cell", kind="stable")
    q, v = np.array(queries.q.tolist()), np.array(entries.v.tolist())
    visits = np.unpackbits(np.stack([np.frombuffer(x, np.uint8) for x in queries.visits]), axis=1).astype(bool)
    met = np.full((len(q), len(v)), np.inf)
    cells, begins = np.unique(entries.cell.to_numpy(), return_index=True)
    for cell, start, stop in zip(cells, begins, [*begins[1:], len(v)], strict=True):
        if len(own := np.flatnonzero(visits[:, cell])):
            met[own, start:stop] = _squared(q[own], v[start:stop])
    ids = entries.ids.to_numpy()
    alone: dict[int, list[int]] = {}
    for at, own in enumerate(ids):
        if len(own) == 1:
            alone.setdefault(int(own[0]), []).append(at)
    for at, query in enumerate(queries.query_id.tolist()):
        met[at, alone.get(query, [])] = np.inf
    last = min(k, len(v)) - 1
    slack = 1e-9 * (1 + (q**2).sum(1).max() + (v**2).sum(1).max())  # these distances are rounded, the returned ones are not
    rows, found = np.nonzero((met <= np.partition(met, last, axis=1)[:, last : last + 1] + slack) & np.isfinite(met))
    score = np.sqrt(((q[rows] - v[found]) ** 2).sum(1))
    return pd.DataFrame({
        "query_id": queries.query_id.to_numpy()[rows], "which": queries.which.to_numpy()[rows], "score": score,
        "ids": pd.Series(list(ids[found]), dtype=object),
    })


def search(
    vectors: DataFrame, is_query: Column, k: int = 10, cells: int = 32, candidates: int = 2000, share: float = 0.5,
    sample_rows: int = 8000, block_rows: int = 1024,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k`` nearest found for each query, itself left out.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` chooses the queries among its rows. Rows without id, and
    vectors that are null, empty, zero or hold null, NaN or infinite components take no part; all others have to be of one
    length. An id with several vectors is a candidate with each; only rows with the query's id are left out of its result, and a
    repeated query is answered once per different vector. Rows that repeat an id and its vector count once. Fewer candidates than
    ``k``: all of them. No queries: no rows. ``cells`` per half; a query reads whole pairs until they hold ``candidates``
    different vectors and at least ``share`` of all. Vectors without clusters need a large share: there neighbours are
    hardly nearer than others, and the recall is little more than the share.
    """
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0)).alias("v"), is_query.alias("query")
    )
    sample = lowest_by_hash(rows.select("vec_id", "v"), "vec_id", sample_rows).toPandas()
    if not len(sample):
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    x = np.array(sample.v.tolist())
    half = (x.shape[1] + 1) // 2
    books = fit_codebook(x[:, :half], cells), fit_codebook(x[:, half:], cells) if x.shape[1] > half else np.zeros((1, 0))
    width = len(books[1])

    @F.pandas_udf("int")
    def cell(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            v = np.array(batch.tolist()).reshape(len(batch), -1)
            yield pd.Series(_squared(v[:, :half], books[0]).argmin(1) * width + _squared(v[:, half:], books[1]).argmin(1))

    # of equal vectors only the smallest ids go on: Spark limits the groups before it shuffles them
    order = Window.partitionBy(F.xxhash64("v"), "v").orderBy("vec_id")
    least = rows.select("v", "vec_id").withColumn("place", F.dense_rank().over(order)).where(F.col("place") <= k + 1)
    entries = least.groupBy("v").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    index = store(entries.withColumn("cell", cell("v")))
    sizes = index.groupBy("cell").count().collect()  # at most cells squared rows
    counts = np.zeros((len(books[0]), width), np.int64)
    for row in sizes:
        counts[divmod(row["cell"], width)] = row["count"]

    total = int(counts.sum())
    wanted = max(candidates, int(np.ceil(share * total)))

    @F.pandas_udf("binary")
    def pairs(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            v = np.array(batch.tolist()).reshape(len(batch), -1)
            near, far = _squared(v[:, :half], books[0]), _squared(v[:, half:], books[1])
            marks = np.zeros((len(batch), counts.size), bool)
            for mark, a, b in zip(marks, near, far, strict=True):
                mark[walk(a, b, counts, wanted)] = True
            yield pd.Series([x.tobytes() for x in np.packbits(marks, axis=1)])

    queries = rows.where("query").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")).distinct()
    queries = store(queries.withColumns({"which": F.xxhash64("q"), "visits": pairs("q")}))
    blocks, sides = max(1, -(-total // block_rows)), max(1, -(-queries.count() // block_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("side", F.pmod(F.xxhash64("query_id"), F.lit(sides)).cast("int")).withColumn("block", every(blocks))
    right = index.withColumn("block", F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int")).withColumn("side", every(sides))
    met = left.groupBy("side", "block").cogroup(right.groupBy("side", "block")).applyInPandas(
        lambda some, held: nearest_in_block(some, held, k), "query_id long, which long, score double, ids array<long>"
    )
    met = met.withColumn("vec_id", F.explode("ids")).where("vec_id != query_id")
    nearest = F.row_number().over(Window.partitionBy("query_id", "which").orderBy("score", "vec_id"))
    return met.withColumn("rank", nearest).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
