"""Quality classifier: Naive Bayes support vectors.

Features are indicators of hashed n-grams: character n-grams of the UTF-8 bytes (1 to 3) and n-grams (1 to 4) of word shapes
(letter case, last character class, same word as before). Each indicator is scaled by the log ratio of its smoothed counts in
the two classes; on the scaled, length-normalised vectors a linear hinge-loss model is fitted by dual coordinate descent.
A quarter of the sample is held back to turn margins into probabilities.

The model is fitted on a bounded sample of the labelled rows (``max_rows``, taken in order of a hash of the id), in one
task; scoring reads every whole text where it lies and shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surestar.llm.common import lowest_by_hash

BITS = 18
#: Classes of bytes: 0 lower case and beyond ASCII, 1 upper case, 2 digit, 3 other, 4 white space.
_CLASS = np.zeros(256, np.uint8)
_CLASS[:128] = 3
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[32, *range(9, 14)]] = 4


def _hashed(codes: np.ndarray, kind: int) -> np.ndarray:
    """Ids of n-grams from 32-bit codes; ``kind`` keeps the kinds apart."""
    mixed = (codes + np.uint32(0x3C6EF35F * (kind + 1) & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
    return (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(32 - BITS)


def _shapes(text: bytes, data: np.ndarray) -> np.ndarray:
    """A small code for each word: case of its first byte, any lower case, class of its last byte, same as the word before."""
    classes = _CLASS[data]
    gap = np.ones(len(data) + 2, bool)
    np.equal(classes, 4, out=gap[1:-1])
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint32)
    first, last, lengths = data[starts], data[ends - 1], ends - starts
    like = (lengths[1:] == lengths[:-1]) & (first[1:] == first[:-1]) & (last[1:] == last[:-1])
    same = np.zeros(len(starts), np.uint32)
    for i in np.flatnonzero(like) + 1:
        same[i] = text[starts[i] : ends[i]] == text[starts[i - 1] : ends[i - 1]]
    lower = np.add.reduceat(classes == 0, starts, dtype=np.uint32) > 0
    return _CLASS[first] + np.uint32(4) * _CLASS[last] + np.uint32(16) * lower + np.uint32(32) * same


def features(text: str | None, places: np.ndarray) -> np.ndarray:
    """Ids of the n-grams that occur in a text, each once; null and empty have none. ``places`` is scratch, int32."""
    whole, found = (text or "").encode("utf-8", "surrogatepass"), np.zeros(0, np.uint32)
    for at in range(0, len(whole), 1 << 20):  # memory stays bounded for very long texts; pieces overlap for n-grams
        piece, ids = whole[max(0, at - 4096) : at + (1 << 20)], [found]
        data = np.frombuffer(piece, np.uint8)
        for kind, codes, width, longest in ((0, data.astype(np.uint32), 8, 3), (4, _shapes(piece, data), 6, 4)):
            grams = codes
            for n in range(longest):
                if n:
                    grams = (grams[:-1] << np.uint32(width)) | codes[n:]
                ids.append(_hashed(grams, kind + n))
        every = np.concatenate(ids)
        order = np.arange(len(every), dtype=np.int32)
        places[every] = order
        found = every[places[every] == order]
    return found


@dataclass(frozen=True)
class QualityModel:
    """Weights and squared scales by n-gram id, the weight of the constant, and the line from margins to log odds."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, texts: pd.Series) -> np.ndarray:
        places, out = np.zeros(1 << BITS, np.int32), np.empty(len(texts))
        for i, text in enumerate(texts):
            ids = features(text, places)
            out[i] = self.weights[ids].sum() / np.sqrt(self.squares[ids].sum() + 1e-9) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * out + self.offset, -30, 30)))


def dual_coordinate_descent(rows: list, labels: np.ndarray, size: int, cost: float, epochs: int) -> np.ndarray:
    """Weights of the linear model with hinge loss; ``rows`` are pairs of ids and values, ``labels`` are -1 or 1."""
    w, alpha, order = np.zeros(size), np.zeros(len(rows)), np.random.default_rng(7)
    diagonal = np.array([float(x @ x) for _, x in rows])
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            ids, x = rows[i]
            gradient = labels[i] * float(w[ids] @ x) - 1
            new = min(max(alpha[i] - gradient / diagonal[i], 0.0), cost)
            if (step := new - alpha[i]) != 0:
                w[ids] += step * labels[i] * x
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3 * cost:
            break
    return w


def _line(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the log odds over the margin, by Newton steps with smoothed targets."""
    up, down = good.sum(), len(good) - good.sum()
    target = np.where(good, (up + 1) / (up + 2), 1 / (down + 2))
    x, beta = np.column_stack([margins, np.ones(len(margins))]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * (beta - [1, 0]))
        beta = beta - step
        if np.abs(step).max() < 1e-6:
            break
    return float(max(beta[0], 1e-3)), float(beta[1])


def fit(rows: list[np.ndarray], good: np.ndarray, cost: float, epochs: int, mixing: float = 0.25) -> QualityModel:
    """Fit on lists of n-gram ids; with a single class, or no rows, every text gets the smoothed share of good rows."""
    size = 1 << BITS
    if good.all() or not good.any():
        p = (good.sum() + 1) / (len(good) + 2)
        return QualityModel(np.zeros(size, np.float32), np.zeros(size, np.float32), 0.0, 1.0, float(np.log(p / (1 - p))))
    fitted = np.arange(len(rows)) % 4 != 3
    if len(set(good[fitted])) < 2 or not (~fitted).any():
        fitted[:] = True
    counts = np.ones((2, size))
    for ids, up in zip(rows, good, strict=True):
        counts[int(up), ids] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    vectors = []
    for ids in rows:
        x = ratio[ids]
        vectors.append((np.append(ids, size), np.append(x / np.sqrt(x @ x + 1e-9), 1.0)))
    signs = np.where(good, 1.0, -1.0)
    chosen = np.flatnonzero(fitted)
    w = dual_coordinate_descent([vectors[i] for i in chosen], signs[chosen], size + 1, cost, epochs)
    w[:size] = (1 - mixing) * np.abs(w[:size]).mean() + mixing * w[:size]
    w[size] *= mixing
    held = np.flatnonzero(~fitted) if (~fitted).any() else chosen
    slope, offset = _line(np.array([float(w[vectors[i][0]] @ vectors[i][1]) for i in held]), good[held])
    return QualityModel((w[:size] * ratio).astype(np.float32), (ratio**2).astype(np.float32), float(w[size]), slope, offset)


def fit_quality(
    docs: DataFrame, labels: DataFrame, max_rows: int = 6000, cost: float = 1.0, epochs: int = 20
) -> QualityModel:
    """Fit on at most ``max_rows`` rows of ``labels`` (``doc_id``, ``good``) with the texts of ``docs``.

    Rows without id or label are left out; of several labels of one id the smallest counts, and of several rows of one id the one
    whose features have the smallest hash. The chosen ids, at most ``max_rows``, are the only broadcast, so no text is shuffled; one
    task fits.
    """
    known = labels.where("doc_id IS NOT NULL AND good IS NOT NULL").groupBy("doc_id").agg(F.min(F.col("good").cast("int")).alias("good"))
    chosen = lowest_by_hash(known, "doc_id", max_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def as_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places = np.zeros(1 << BITS, np.int32)
        for pdf in batches:
            ids = [features(t, places).astype(np.int32).tobytes() for t in pdf.text]
            hashes = np.array([xxhash.xxh64_intdigest(x) for x in ids], np.uint64).view(np.int64)
            made = pd.DataFrame({"doc_id": pdf.doc_id.to_numpy(), "good": pdf.good.to_numpy(), "hash": hashes, "ids": ids})
            yield made.sort_values(["doc_id", "hash", "ids"]).drop_duplicates("doc_id")  # less to hand on where an id is repeated

    def as_model(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"doc_id": [], "good": [], "ids": []}), *batches])
        rows = rows.assign(at=pd.util.hash_array(rows.doc_id.to_numpy(np.int64))).sort_values(["at", "doc_id", "ids"])
        model = fit([np.frombuffer(x, np.int32) for x in rows.ids], rows.good.to_numpy(np.int64) > 0, cost, epochs)
        numbers = np.array([model.bias, model.slope, model.offset]).tobytes()
        yield pd.DataFrame({"w": [model.weights.tobytes()], "s": [model.squares.tobytes()], "n": [numbers]})

    found = sample.mapInPandas(as_features, "doc_id long, good int, hash long, ids binary")
    least = F.min_by("ids", F.struct("hash", "ids"))
    found = found.groupBy("doc_id", "good").agg(least.alias("ids")).repartition(1)
    row = found.mapInPandas(as_model, "w binary, s binary, n binary").first()
    numbers = np.frombuffer(bytes(row.n))
    return QualityModel(np.frombuffer(bytes(row.w), np.float32), np.frombuffer(bytes(row.s), np.float32), *map(float, numbers))


def quality_score(model: QualityModel, text: Column) -> Column:
    """Probability from 0 to 1 that a text is good; null counts as empty, and empty texts get the score of no n-grams."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.score(texts))

    return score(text)
