"""SimHash near-duplicates with bit-sliced comparison.

A text's fingerprint takes a majority vote, bit by bit, over the XXH64 hashes of its word shingles. Two different fingerprints
within ``radius`` bits agree on one of ``radius + 1`` parts, and the rest of their bits agree on one of as many parts again:
rows that share a part and a part of the rest are compared, no others. Inside such a bucket the fingerprints lie as bit planes,
one bit vector per position; the vector of all rows is compared with itself shifted by one, two, ... rows, differences are
added with carry-save bitwise counters, and a block of words is left as soon as every lane has more than ``radius`` differences.

Buckets with many different fingerprints are cut into slices and every two slices meet in a task of their own. A bucket gives at
most one link per row, to the smallest row it can be reached from, and the links meet in a connected-components job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surestar.llm.common import connected_components, store

SEED = 42
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def text_fingerprint(text: str | None, shingle: int) -> int:
    """Fingerprint of a text, unsigned; a text of fewer words is one shingle, a text without words has fingerprint 0."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined, hash64 = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hash64(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    starts, ends = starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist()
    votes = np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 15):
        spans = zip(starts[at : at + (1 << 15)], ends[at : at + (1 << 15)], strict=True)
        votes += _votes(np.array([hash64(joined[a:b], SEED) for a, b in spans], np.uint64))
    return int(np.packbits(votes * 2 > len(starts), bitorder="little").view(np.uint64)[0])


def _votes(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set; eight byte counters share a number, 255 numbers fill them at most."""
    padded = np.zeros(-(-len(hashes) // 255) * 255, np.uint64)
    padded[: len(hashes)] = hashes
    eighths = (padded >> np.arange(8, dtype=np.uint64)[:, None]) & np.uint64(0x0101010101010101)
    sums = eighths.reshape(8, -1, 255).sum(axis=2)
    return sums.view(np.uint8).reshape(8, -1, 8).sum(axis=1, dtype=np.int64).T.ravel()


def simhash(text: Column, shingle: int) -> Column:
    """Fingerprint as a signed 64-bit number; whole texts, null counts as empty."""

    @F.pandas_udf("long")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([text_fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return fingerprints(text)


def _shifted(planes: np.ndarray, words: np.ndarray, shift: int) -> np.ndarray:
    q, r = divmod(shift, 64)
    low = planes[:, words + q]
    if not r:
        return low
    return (low >> np.uint64(r)) | (planes[:, words + q + 1] << np.uint64(64 - r))


def _close(planes: np.ndarray, lanes: np.ndarray, shift: int, radius: int) -> np.ndarray:
    """Rows, among the lanes that are set, within ``radius`` bits of the row ``shift`` places on."""
    words = np.flatnonzero(lanes)
    over = ~lanes[words]
    counters = np.zeros((max(1, radius.bit_length()), len(words)), np.uint64)
    for first in range(0, 64, 8):
        differ = planes[first : first + 8, words] ^ _shifted(planes[first : first + 8], words, shift)
        for x, y in zip(differ[::2], differ[1::2], strict=True):
            both = counters[0] ^ x
            carry = (counters[0] & x) | (both & y)
            counters[0] = both ^ y
            for k in range(1, len(counters)):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            over |= carry
        alive = np.flatnonzero(over != _ALL)
        if not len(alive):
            return alive
        if 2 * len(alive) <= len(words):
            words, over, counters = words[alive], over[alive], counters[:, alive]
    equal = ~over
    for k in reversed(range(len(counters))):  # counts that fit the counters but exceed the radius
        if radius >> k & 1:
            equal &= counters[k]
        else:
            over |= equal & counters[k]
            equal &= ~counters[k]
    rows, lane = np.nonzero(np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return words[rows] * 64 + lane


def _pack(bits: np.ndarray, words: int) -> np.ndarray:
    packed = np.packbits(bits, axis=-1, bitorder="little")
    padded = np.zeros((*packed.shape[:-1], words * 8), np.uint8)
    padded[..., : packed.shape[-1]] = packed
    return padded.view(np.uint64)


def bucket_links(bucket: np.ndarray, fingerprint: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the rows of each bucket that are within ``radius`` bits, directly or over others.

    ``bucket`` holds any codes, ``fingerprint`` is uint64. A row is linked to one row at most.
    """
    _, code, sizes = np.unique(bucket, return_inverse=True, return_counts=True)
    order = np.lexsort((fingerprint, code, -sizes[code]))
    value, code = fingerprint[order], code[order]
    n = len(value)
    begins = np.concatenate(([True], code[1:] != code[:-1]))
    rank = np.arange(n) - np.maximum.accumulate(np.where(begins, np.arange(n), 0))
    left = sizes[code] - rank - 1  # rows of the bucket that follow
    root = np.arange(n)
    bits = np.unpackbits(value.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    width = (n + 63) // 64
    planes = _pack(bits.T, width + int(left.max(initial=0)) // 64 + 2)
    for shift in range(1, int(left.max(initial=0)) + 1):
        lanes = _pack(left >= shift, width)
        rows = _close(planes, lanes, shift, radius)
        while len(rows):
            a, b = root[rows], root[rows + shift]
            if not len(rows := rows[a != b]):
                break
            a, b = root[rows], root[rows + shift]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
        if shift & (shift - 1) == 0:  # nothing is left to find in buckets that are connected already
            apart = np.bincount(code, weights=root == np.arange(n)) > 1
            left = np.where(apart[code], left, 0)
            if not left.any():
                break
    linked = np.flatnonzero(root != np.arange(n))
    return value[linked], value[root[linked]]


def _keys(fingerprint: Column, radius: int) -> Column:
    """Numbers of the buckets of a fingerprint: one for each part and each part of the rest."""
    parts = radius + 1
    mask = lambda bits: F.lit((1 << bits) - 1).cast("long")
    keys = []
    for i in range(parts):
        low, high = 64 * i // parts, 64 * (i + 1) // parts
        part = F.shiftrightunsigned(fingerprint, low).bitwiseAND(mask(high - low))
        above = F.shiftleft(F.shiftrightunsigned(fingerprint, high), low) if high < 64 else F.lit(0).cast("long")
        rest = fingerprint.bitwiseAND(mask(low)).bitwiseOR(above) if low else above
        width = 64 - (high - low)
        for j in range(parts):
            a, b = width * j // parts, width * (j + 1) // parts
            some = F.shiftrightunsigned(rest, a).bitwiseAND(mask(b - a))
            number = F.shiftleft(part, b - a).bitwiseOR(some)
            keys.append(F.shiftleft(F.lit(i * parts + j).cast("long"), 56).bitwiseOR(number))
    return F.explode(F.array(*keys))


def near_links(fingerprints: DataFrame, radius: int, slice_rows: int = 512) -> DataFrame:
    """Links ``u``, ``v`` that connect different fingerprints within ``radius`` bits; all components, not all pairs.

    ``fingerprints`` has one column ``fp`` of different 64-bit numbers. The radius may be 1 to 6.
    """
    if not 1 <= radius <= 6:
        raise ValueError("the radius must be 1 to 6")
    rows = fingerprints.select("fp", _keys(F.col("fp"), radius).alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    slices = F.ceil(F.col("n") / slice_rows).cast("int")
    rows = rows.join(shared, "key").select("key", "fp", slices.alias("k"), F.pmod(F.xxhash64("fp"), slices).cast("int").alias("s"))
    other = F.explode(F.when(F.col("k") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("k") - 1)))
    rows = rows.select("key", "fp", "k", "s", other.alias("t")).where("k = 1 OR s != t")
    rows = rows.select(F.xxhash64("key", F.least("s", "t"), F.greatest("s", "t")).alias("bucket"), "fp")

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting = pd.DataFrame({"bucket": np.zeros(0, np.int64), "fp": np.zeros(0, np.int64)})

        def linked(pdf: pd.DataFrame) -> pd.DataFrame:
            u, v = bucket_links(pdf.bucket.to_numpy(), np.ascontiguousarray(pdf.fp.to_numpy()).view(np.uint64), radius)
            return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

        for pdf in batches:
            pdf = pd.concat([waiting, pdf], ignore_index=True)
            whole = (pdf.bucket != pdf.bucket.iloc[-1]).to_numpy() if len(pdf) else np.zeros(0, bool)
            if len(pdf) < 20_000 or not whole.any():
                waiting = pdf
                continue
            yield linked(pdf[whole])
            waiting = pdf[~whole]
        if len(waiting):
            yield linked(waiting)

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(links, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, carry: tuple[Column, ...] = ()) -> DataFrame:
    """``doc_id``, ``fp``, ``root`` and ``component_id`` of every row: its fingerprint, the smallest fingerprint and the
    smallest id that it is connected with. ``carry`` are more columns of the row, which are handed on.

    Rows without words have fingerprint 0 and are linked like any other. Rows that repeat an id stay apart rows. A null id is
    never the smallest; a component without any id has a null ``component_id``. An empty table gives no rows.
    """
    marked = store(docs.select("doc_id", simhash(F.col("text"), shingle).alias("fp"), *carry))
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    least = store(least)
    roots = connected_components(near_links(least.select("fp"), radius))
    least = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    least = least.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    component = least.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(least.join(component, "root").select("fp", "root", "component_id"), "fp")


def keep_first(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``docs`` that stand for their component, one each, with all its columns: the one with the smallest id.

    Of several rows of a component with that id, or of one without ids, the one with the smallest hash of the text, then of all
    columns, stays. An id whose rows have different texts may so stand for several components.
    """
    found = near_duplicates(docs, shingle, radius)
    kept = found.where("doc_id <=> component_id").select(F.col("doc_id").alias("__id"), F.col("fp").alias("__fp2"), F.col("root").alias("__root")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("__row"), simhash(F.col("text"), shingle).alias("__fp"))
    rows = rows.join(kept, F.col("__row.doc_id").eqNullSafe(F.col("__id")) & (F.col("__fp") == F.col("__fp2")))
    order = F.struct(F.xxhash64("__row.text"), F.xxhash64("__row"))
    return rows.groupBy("__root").agg(F.min_by("__row", order).alias("__row")).select("__row.*")
