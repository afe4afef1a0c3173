"""Conflict-constrained best-fit packing of documents into sequences of a fixed number of words.

Documents are cut into pieces of at most ``capacity`` words. Full pieces are sequences of their own. The other pieces, one per
document at most, are dealt to shards by a hash, and each shard packs its pieces in one task, largest first: open bins stand
in the order of the room they have left, each with a bitmap of its sources and one of its duplicate clusters. The search starts
at the smallest room that fits and goes on to the next larger one until it finds a bin without a conflict; else it opens a bin.
The number of shards follows the number of pieces, so a shard stays as small at every size of the input.

Conflicts: a sequence holds a cluster once, and a source at most ``per_source`` times.
"""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surestar.llm.common import lower_ascii, store, word_count


def text_cluster(text: Column) -> Column:
    """Number that equal texts share, whatever their case and white space."""
    return F.xxhash64(F.regexp_replace(F.trim(F.translate(lower_ascii(text), "\t\n\x0b\f\r", "     ")), " +", " "))


def pack_pieces(sizes: list[int], sources: list, clusters: list, capacity: int, per_source: int = 1) -> list[int]:
    """Bin of each piece, by best fit in the given order.

    Bins of equal room form a stack. A bit set over the rooms tells where bins are; for each source and cluster the number of
    its bins per room tells where none without it is left, so that a frequent source is not searched for in vain.
    """
    source_bit: dict = {}
    seen, repeated = set(), set()
    for c in clusters:
        (repeated if c in seen else seen).add(c)
    cluster_bit = {c: 1 << i for i, c in enumerate(sorted(repeated))}
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    filled = 0  # bit r: a bin with room r is open
    full: dict[tuple, list[int]] = defaultdict(lambda: [0] * (capacity + 1))  # bins per room in which a label is barred
    spent: dict[tuple, int] = defaultdict(int)  # bit r: a label is barred in every bin with room r
    bar_sources, bar_clusters, members, labels = [], [], [], []
    placed = []

    def update(label: tuple, room: int) -> None:
        if stacks[room] and full[label][room] == len(stacks[room]):
            spent[label] |= 1 << room
        else:
            spent[label] &= ~(1 << room)

    by_room: list[dict] = [defaultdict(int) for _ in range(capacity + 1)]  # labels with barred bins, per room

    def enter(b: int, room: int, step: int) -> None:
        nonlocal filled
        if step > 0:
            stacks[room].append(b)
        else:
            stacks[room].remove(b) if stacks[room][-1] != b else stacks[room].pop()
        for label in labels[b]:
            full[label][room] += step
            by_room[room][label] += step
            if not by_room[room][label]:
                del by_room[room][label]
                spent[label] &= ~(1 << room)
        for label in by_room[room]:
            update(label, room)
        filled = filled | 1 << room if stacks[room] else filled & ~(1 << room)

    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        s = source_bit.setdefault(source, 1 << len(source_bit))
        c = cluster_bit.get(cluster, 0)
        open_rooms = filled & ~spent.get(("s", s), 0) & ~(spent.get(("c", c), 0) if c else 0)
        open_rooms = open_rooms >> size << size
        found = -1
        while open_rooms:
            room = (open_rooms & -open_rooms).bit_length() - 1
            for b in reversed(stacks[room]):
                if not (bar_sources[b] & s or bar_clusters[b] & c):
                    found = b
                    break
            if found >= 0:
                break
            open_rooms &= open_rooms - 1
        if found < 0:
            found, room = len(members), capacity
            members.append(defaultdict(int))
            labels.append([])
            bar_sources.append(0)
            bar_clusters.append(0)
        else:
            enter(found, room, -1)
        members[found][s] += 1
        if members[found][s] == per_source:
            bar_sources[found] |= s
            labels[found].append(("s", s))
        if c:
            bar_clusters[found] |= c
            labels[found].append(("c", c))
        if room - size > 0:
            enter(found, room - size, 1)
        placed.append(found)
    return placed


def pack(
    docs: DataFrame, capacity: int = 2048, per_source: int = 1, shard_pieces: int = 10_000, cluster: Column | None = None, words: Column | None = None
) -> DataFrame:
    """One row per piece: ``doc_id``, ``source``, ``piece``, ``start_word``, ``n_words``, ``bin_id``, ``slot``, ``bin_words``.

    ``docs`` has ``doc_id``, ``text`` and ``source``. Words are those of ``common.WORD``. A document without words (null
    included) is one piece of no words in no bin. A null source counts as a source. Repeated rows are pieces of their own
    and, being copies, never share a bin. Equal inputs get equal bins: the order is by size, then by id, cluster and source.

    ``cluster`` is a long, never null, that duplicates share; without it those of ``text_cluster`` do, which are exact copies only.
    ``words`` is the number of words; with both, ``text`` isn't read.
    """
    cluster = text_cluster(F.col("text")) if cluster is None else cluster
    words = word_count(F.col("text")) if words is None else words
    sized = docs.select("doc_id", "source", cluster.alias("cluster"), words.alias("words"))
    pieces = store(sized).withColumn("full", F.floor(F.col("words") / capacity).cast("long"))
    long = lambda n: F.lit(n).cast("long")
    columns = ["doc_id", "source", "piece", "start_word", "n_words", "bin_id", "slot", "bin_words"]

    whole = pieces.where("full > 0").groupBy("doc_id", "source", "cluster", "full").agg(F.count("*").alias("rows"))
    whole = whole.withColumn("copy", F.explode(F.sequence(long(1), "rows")))
    whole = whole.withColumn("piece", F.explode(F.sequence(long(0), F.col("full") - 1)))
    name = F.concat_ws("-", F.lit("full"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.hex("cluster"), "source", "full", "copy", "piece")
    whole = whole.withColumns({"start_word": F.col("piece") * capacity, "n_words": long(capacity), "bin_id": name, "slot": long(0), "bin_words": long(capacity)})

    empty = pieces.where("words = 0").withColumns({n: long(0) for n in ("piece", "start_word", "n_words", "slot", "bin_words")})
    empty = empty.withColumn("bin_id", F.lit(None).cast("string"))

    rest = pieces.withColumn("n_words", F.col("words") - F.col("full") * capacity).where("n_words > 0")
    shards = max(1, -(-rest.count() // shard_pieces))
    rest = rest.select(
        F.pmod(F.xxhash64("cluster", "doc_id"), F.lit(shards)).alias("shard"), F.coalesce("doc_id", long(0)).alias("doc_id"),
        F.col("doc_id").isNull().alias("nameless"), "source", "cluster", F.col("full").alias("piece"), "n_words",
    )

    def pack_shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_words", "nameless", "doc_id", "cluster", "source", "piece"], ascending=[False, True, True, True, True, True])
        sources = [s if isinstance(s, str) else None for s in pdf.source]
        pdf["bin"] = pack_pieces(pdf.n_words.tolist(), sources, pdf.cluster.tolist(), capacity, per_source)
        pdf["slot"] = pdf.groupby("bin").cumcount()
        pdf["bin_words"] = pdf.groupby("bin").n_words.transform("sum")
        pdf["bin_id"] = "mix-" + pdf["shard"].astype(str) + "-" + pdf["bin"].astype(str)
        return pdf[["nameless", "doc_id", "source", "piece", "n_words", "bin_id", "slot", "bin_words"]]

    schema = "nameless boolean, doc_id long, source string, piece long, n_words long, bin_id string, slot long, bin_words long"
    rest = rest.groupBy("shard").applyInPandas(pack_shard, schema)
    rest = rest.withColumn("doc_id", F.when(~F.col("nameless"), F.col("doc_id"))).withColumn("start_word", F.col("piece") * capacity)
    return rest.select(columns).unionByName(whole.select(columns)).unionByName(empty.select(columns))
