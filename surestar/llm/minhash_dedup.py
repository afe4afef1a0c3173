"""MinHash near-duplicates by a multi-index Hamming join over b-bit signatures.

A text's set holds its distinct word shingles as 64-bit hashes. Its signature has ``POSITIONS`` minima, of each of which 16 bits
are kept; the distance of two signatures is the number of positions in which they differ. A signature is split into chunks so
that, by the pigeonhole principle, two signatures within ``RADIUS`` differences agree on some chunk but for ``ERRORS`` positions.
The allowed errors of a chunk are enumerated by leaving positions out: each choice of positions that are left is one key, and
rows within the radius share a key. A pair with a Jaccard similarity of 0.85 has a larger distance with a probability of
4e-6; pairs that are more alike have less.

No key hands on all its pairs. First each row meets the smallest row of each of its keys; rows near it form groups. Only keys
that hold several groups go on: the rows of the first row's group (the core) and the others (the rest) are cut into slices, every
slice of the rest meets every other slice in a task of its own, and a task gives no more links than connect its groups. What
is connected so far is a cluster; a near pair never lies in two. Then full sets decide: first the links found so far, then, in clusters
that these do not connect, all pairs of rows that are not connected yet, again by slices of a core and a rest.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surestar.llm.common import connected_components, merged_components, store, whole_groups

SHINGLE = 5
SIMILAR = 85  # percent
POSITIONS = 32
RADIUS = 15
ERRORS = 1
CHUNKS = (RADIUS + 1) // (ERRORS + 1)
SLICE_ROWS = 2048
SLICE_SHINGLES = 1 << 20

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(42)
_XOR = _random.integers(0, 2**64, POSITIONS, np.uint64)
_TIMES = _random.integers(0, 2**64, POSITIONS, np.uint64) | np.uint64(1)
_SIGNATURE = [f"s{i}" for i in range(POSITIONS // 4)]


def text_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted different hashes of the shingles; of fewer words the whole sequence is one, without words there are none."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    known = {w: xxhash.xxh64_intdigest(w) for w in set(words)}
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(shingle, len(words))
    codes = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        codes = codes * _ODD + hashes[i : i + len(codes)]
        codes ^= codes >> np.uint64(29)
    return np.unique(codes)


def signature(codes: np.ndarray) -> np.ndarray:
    """16 bits of each of the minima of a set that is not empty."""
    least = np.full(POSITIONS, 2**64 - 1, np.uint64)
    for at in range(0, len(codes), 4096):
        part = (codes[at : at + 4096, None] ^ _XOR) * _TIMES
        np.minimum(least, (part ^ (part >> np.uint64(32))).min(axis=0), out=least)
    return ((least * _ODD) >> np.uint64(48)).astype(np.uint16)


def _sketch(text: Column, shingle: int) -> Column:
    """Size of the set, 128 bits that stand for it, and the signature in numbers of four positions each."""
    schema = ", ".join(f"{name} long" for name in ("n", "h1", "h2", *_SIGNATURE))

    @F.pandas_udf(schema)
    def sketches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = np.zeros((len(texts), 3 + len(_SIGNATURE)), np.int64)
            for row, text in zip(out, texts, strict=True):
                codes = text_set(text, shingle)
                row[0] = len(codes)
                row[1:3] = np.frombuffer(xxhash.xxh3_128_digest(codes.tobytes()), np.int64)
                if len(codes):
                    row[3:] = signature(codes).view(np.int64)
            yield pd.DataFrame(out, columns=["n", "h1", "h2", *_SIGNATURE])

    return sketches(text)


def _keys() -> Column:
    """Numbers of the keys of a signature: one for each chunk and each choice of the positions left in it."""
    at = [F.shiftrightunsigned(_SIGNATURE[i // 4], 16 * (i % 4)).bitwiseAND(F.lit(0xFFFF)) for i in range(POSITIONS)]
    keys = []
    for c in range(CHUNKS):
        chunk = range(POSITIONS * c // CHUNKS, POSITIONS * (c + 1) // CHUNKS)
        for left in itertools.combinations(chunk, len(chunk) - ERRORS):
            keys.append(F.xxhash64(F.lit(len(keys)), *[at[i] for i in left]))
    return F.explode(F.array(*keys))


def _distance(a: str, b: str) -> Column:
    """Number of positions in which the signatures of two aliased rows differ."""
    total = F.lit(0)
    for name in _SIGNATURE:
        bits = F.col(f"{a}.{name}").bitwiseXOR(F.col(f"{b}.{name}"))
        for shift in (8, 4, 2, 1):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, shift))
        total = total + F.bit_count(bits.bitwiseAND(F.lit(0x0001000100010001)))
    return total


def _with_labels(rows: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """Add the component of ``row``, which is the row itself where it has no link."""
    found = roots.select(F.col("node").alias("row"), F.col("root").alias("__root"))
    return rows.join(found, "row", "left").select(*rows.columns, F.coalesce("__root", "row").alias(name))


def _deal(rows: DataFrame, by: str, core: Column, weight: Column, most: int) -> DataFrame:
    """Rows of each group ``by`` dealt to tasks so that every row of the rest meets every other row of the group once or more.

    ``core`` says which rows need not meet each other. The result has the columns of ``rows``, ``task`` and ``side``: true for
    rows of the core, false for those of the rest, null in tasks in which only rows of the rest meet.
    """
    marked = rows.withColumn("__core", core)
    sizes = marked.groupBy(by).agg(
        F.ceil(F.sum(F.when(F.col("__core"), weight).otherwise(0)) / most).cast("int").alias("__kc"),
        F.ceil(F.sum(F.when(F.col("__core"), 0).otherwise(weight)) / most).cast("int").alias("__kr"),
    )
    marked = marked.join(sizes.where("__kr > 0"), by)
    own = F.pmod(F.xxhash64("row"), F.when(F.col("__core"), F.col("__kc")).otherwise(F.col("__kr"))).cast("int")
    up_to = lambda n: F.sequence(F.lit(0), n - 1)
    marked = marked.withColumn("__own", own)
    met = F.when(F.col("__core"), F.transform(up_to(F.col("__kr")), lambda r: F.struct(F.col("__own").alias("c"), r.alias("r"))))
    with_core = F.when(F.col("__kc") > 0, F.transform(up_to(F.col("__kc")), lambda c: F.struct(c.alias("c"), F.col("__own").alias("r"))))
    among = F.transform(
        up_to(F.col("__kr")),
        lambda r: F.struct((-1 - F.greatest(r, F.col("__own"))).alias("c"), F.least(r, F.col("__own")).alias("r")),
    )
    alone = (F.col("__kr") == 1) & (F.col("__kc") > 0)  # the one slice of the rest then meets itself beside the core
    nothing = F.array().cast("array<struct<c:int,r:int>>")
    met = F.coalesce(met, F.concat(F.coalesce(with_core, nothing), F.when(alone, nothing).otherwise(among)))
    dealt = marked.withColumn("__met", F.explode(met))
    side = F.when(F.col("__met.c") >= 0, F.col("__core"))
    return dealt.select(*rows.columns, F.xxhash64(by, "__met.c", "__met.r").alias("task"), side.alias("side"))


def links_across(
    label: np.ndarray, sig: np.ndarray, core: np.ndarray, sets: list[np.ndarray] | None = None, percent: int = SIMILAR
) -> list[tuple[int, int]]:
    """Links between rows with different labels that are within the radius and, with ``sets``, confirmed by them; no more than
    connect the labels. Rows of the core are not compared with each other."""
    _, code = np.unique(label, return_inverse=True)
    root = np.arange(code.max(initial=-1) + 1)
    rest = np.flatnonzero(~core)
    before, links = np.flatnonzero(core), []
    known: dict[int, list[int]] = {}
    rare = _rarest(sets, percent) if sets is not None else []
    for a in before if sets is not None else ():
        for x in rare[a]:
            known.setdefault(x, []).append(a)
    for k, b in enumerate(rest):
        if sets is None:
            others = np.concatenate((before, rest[:k]))
        else:
            others = np.unique(np.fromiter(itertools.chain.from_iterable(known.get(x, ()) for x in rare[b]), np.int64))
            for x in rare[b]:
                known.setdefault(x, []).append(b)
        others = others[root[code[others]] != root[code[b]]]
        distance = (sig[others] != sig[b]).sum(axis=1)
        for a in others[np.argsort(distance, kind="stable")[: np.count_nonzero(distance <= RADIUS)]]:
            if root[code[a]] != root[code[b]] and (sets is None or similar(sets[a], sets[b], percent)):
                links.append((a, b))
                root[root == root[code[b]]] = root[code[a]]
    return links


def _rarest(sets: list[np.ndarray], percent: int) -> list[list[int]]:
    """Of each set as many of its rarest members that every set as similar as asked shares one of them."""
    if not sets:
        return []
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = count[at] * np.int64(len(count)) + at
    out, begin = [], 0
    for x in sets:
        own = np.sort(order[begin : begin + len(x)])[: len(x) - -(-percent * len(x) // 100) + 1]
        out.append((own % len(count)).tolist())
        begin += len(x)
    return out


def similar(a: np.ndarray, b: np.ndarray, percent: int = SIMILAR) -> bool:
    """Whether two sorted sets have the Jaccard similarity."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _linked_tasks(dealt: DataFrame, label: str, percent: int | None) -> DataFrame:
    """Links ``u``, ``v`` between rows of different labels ``a``, ``b`` that meet in a task; with ``percent``, full sets confirm them."""

    def links(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in whole_groups(batches, "task"):
            group = group.drop_duplicates("row").reset_index(drop=True)
            rows, sig = group["row"].to_numpy(), np.ascontiguousarray(group[_SIGNATURE].to_numpy()).view(np.uint16)
            sets = None if percent is None else [np.frombuffer(x, np.uint64) for x in group["codes"]]
            core = (group["side"] == True).to_numpy(bool)  # noqa: E712  null is no core
            labels = group[label].to_numpy()
            found = links_across(labels, sig, core, sets, percent or SIMILAR)
            if found:
                u, v = np.array(found).T
                yield pd.DataFrame({"u": rows[u], "v": rows[v], "a": labels[u], "b": labels[v]})

    columns = ["task", "row", label, "side", *_SIGNATURE, *(["codes"] if percent is not None else [])]
    placed = dealt.select(columns).repartition("task").sortWithinPartitions("task", "row")
    return placed.mapInPandas(links, "u long, v long, a long, b long")


def _between(links: DataFrame) -> DataFrame:
    """The links of ``_linked_tasks`` as edges between the labels of their ends."""
    return links.select(F.col("a").alias("u"), F.col("b").alias("v"))


def _codes(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """Full sets of the wanted rows, made anew from the texts."""

    @F.pandas_udf("binary")
    def codes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([text_set(t, shingle).tobytes() for t in texts])

    texts = docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text"), F.xxhash64("text").alias("t"))
    met = texts.join(wanted, (F.col("__id").eqNullSafe(F.col("least"))) & (texts["t"] == wanted["t"]))
    return met.select("row", "n", *_SIGNATURE, codes("__text").alias("codes"))


def _confirmed(links: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The links whose sets are alike. A row's set is sent once for each link, that of the smaller end once per slice of them."""
    slots = links.withColumn("slot", F.xxhash64("u", F.pmod(F.xxhash64("v"), F.lit(4096 // 16))))
    ends = slots.select("slot", F.col("u").alias("row"), F.lit(0).alias("end")).distinct()
    ends = ends.union(slots.select("slot", F.col("v").alias("row"), F.lit(1).alias("end")))
    met = ends.join(members.select("row", "codes"), "row")

    def check(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in whole_groups(batches, "slot"):
            centre = group[group["end"] == 0].iloc[0]
            own = np.frombuffer(centre["codes"], np.uint64)
            others = group[group["end"] == 1].drop_duplicates("row")
            good = [similar(own, np.frombuffer(x, np.uint64), percent) for x in others["codes"]]
            yield pd.DataFrame({"u": centre["row"], "v": others["row"][good]}).astype("int64")

    return met.repartition("slot").sortWithinPartitions("slot", "end").mapInPandas(check, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = SIMILAR) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row: the size of its set and the smallest id connected with it.

    Rows without words, null texts included, are linked with nothing. Equal sets are one row of the search. Rows that repeat an id
    stay apart rows; a null id is never the smallest, and a component without any id has a null ``component_id``. An empty table
    gives no rows. Other columns are not read.
    """
    if percent < SIMILAR:
        raise ValueError(f"the radius is made for similarities of {SIMILAR} percent or more")
    narrow = docs.select("doc_id", F.xxhash64("text").alias("t"), _sketch(F.col("text"), shingle).alias("__s"))
    marked = store(narrow.select("doc_id", "t", "__s.*"))
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("one")
    reps = marked.where("n > 0").groupBy("h1", "h2").agg(one, F.min("n").alias("n"), *[F.min(s).alias(s) for s in _SIGNATURE])
    reps = reps.select("h1", "h2", F.col("one.doc_id").alias("least"), F.col("one.t").alias("t"), "n", *_SIGNATURE)
    reps = store(reps.withColumn("row", F.monotonically_increasing_id()))

    keyed = reps.select("row", _keys().alias("key"))
    centres = keyed.groupBy("key").agg(F.min("row").alias("centre"), F.count("*").alias("rows")).where("rows > 1")
    keyed = store(keyed.join(centres, "key").select("key", "row", "centre"))
    stars = keyed.where("row != centre").select(F.col("centre").alias("u"), F.col("row").alias("v")).distinct()
    signed = reps.select("row", *_SIGNATURE)
    met = stars.join(signed.alias("a"), F.col("u") == F.col("a.row")).join(signed.alias("b"), F.col("v") == F.col("b.row"))
    stars = store(met.where(_distance("a", "b") <= RADIUS).select("u", "v"))

    groups = connected_components(stars)
    labelled = _with_labels(keyed, groups, "label")
    apart = labelled.groupBy("key").agg(F.min("label").alias("__a"), F.max("label").alias("__b"), F.max(F.when(F.col("row") == F.col("centre"), F.col("label"))).alias("__first"))
    labelled = labelled.join(apart.where("__a < __b").select("key", "__first"), "key")
    dealt = _deal(labelled, "key", F.col("label") == F.col("__first"), F.lit(1), SLICE_ROWS)
    more = store(_linked_tasks(dealt.join(signed, "row"), "label", None))
    links = stars.union(more.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")))

    clusters = store(merged_components(groups, _between(more)))
    ends = clusters.select(F.col("node").alias("row")).union(clusters.select(F.col("root").alias("row"))).distinct()
    members = store(_codes(docs, reps.join(ends, "row").select("row", "least", "t", "n", *_SIGNATURE), shingle))

    sure = store(_confirmed(links, members, percent))
    parts = connected_components(sure)
    placed = _with_labels(_with_labels(members.select("row", "n").distinct(), clusters, "cluster"), parts, "part")
    counts = placed.groupBy("cluster", "part").agg(F.count("*").alias("rows"))
    largest = counts.groupBy("cluster").agg(F.max(F.struct("rows", "part"))["part"].alias("__first"), F.count("*").alias("__parts"))
    placed = placed.join(largest.where("__parts > 1").select("cluster", "__first"), "cluster")
    dealt = _deal(placed, "cluster", F.col("part") == F.col("__first"), F.col("n") + 64, SLICE_SHINGLES)
    more = _linked_tasks(dealt.join(members.drop("n"), "row"), "part", percent)

    final = _with_labels(reps.select("row", "h1", "h2", "least"), merged_components(parts, _between(more)), "root")
    final = store(final)
    least = final.groupBy("root").agg(F.min("least").alias("__least"))
    by_set = final.join(least, "root").select("h1", "h2", F.col("__least"))
    found = marked.select("doc_id", "n", "h1", "h2").join(by_set, ["h1", "h2"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("__least"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
