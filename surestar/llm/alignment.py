"""Cross-tokenizer alignment in Arrow.

Two tokenizers cut the same bytes at different places. ``align`` writes one row per document: how many tokens it has, into how many
groups the places cut them at which tokens of both end, which pairs of ids overlap, and a digest of the groups. Inside a task all is
done on Arrow columns: token lists are flattened, their parent indices name the document, cumulative sums of token lengths less that
of the document's start are the ends, a hash join on (document, end) finds the places where both end, and a table aggregate counts the
links of each pair of ids. ``score_links`` counts in how many documents each pair is linked (table aggregates per batch, merged by Spark) and
gives every document the sums over its links.

The counts of the most frequent pairs, at most ``HEAD`` rows, and the highest count of each first id, one row for each entry of a vocabulary,
are sent to the tasks; links of rarer pairs meet their counts in a join. The sums do not depend on the bound.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surestar.llm.common import store
from surestar.llm.token_files import PATTERN

HEAD = 1 << 19
SLICE_CHARS = 1 << 20
#: Texts of these letters only give equal tokens with either library; the quicker one takes them up to a length, as it is slow or fails on
#: long runs of one kind of letter.
_PLAIN = re.compile(r"[\t\n\r -~¡-¬®-ɏ]*")
QUICK_CHARS = 50_000
_SPACE = "▁"


def _byte_letters() -> dict[str, int]:
    """Letters of the byte-level alphabet: printable bytes stand for themselves, the others for letters from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_level_tokens(definition: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary; special entries have none."""
    parsed, letters = json.loads(definition), _byte_letters()
    special = {entry["id"] for entry in parsed["added_tokens"]}
    vocabulary = parsed["model"]["vocab"]
    out = [b""] * (1 + max([*vocabulary.values(), *special]))
    for text, i in vocabulary.items():
        if i not in special:
            out[i] = bytes(letters[c] for c in text)
    return out


def piece_tokens(processor) -> list[bytes]:
    """Bytes of each id of a piece vocabulary."""
    out = []
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        if processor.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        else:
            out.append(b"" if processor.is_control(i) or processor.is_unknown(i) else piece.replace(_SPACE, " ").encode())
    return out


@dataclass
class Encoders:
    """Both tokenizers, the bytes of their ids and the texts that digests are made of."""

    byte_level: object
    quick: object
    pieces: object
    a_bytes: list[bytes]
    b_bytes: list[bytes]

    def __post_init__(self) -> None:
        self.a_lengths, self.b_lengths = (pa.array(map(len, x), pa.int64()) for x in (self.a_bytes, self.b_bytes))
        texts = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.comma, self.bar, self.semicolon = (np.array([t + end for t in texts], object) for end in (",", "|", ";"))

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        plain = [len(t) <= QUICK_CHARS and bool(_PLAIN.fullmatch(t)) for t in texts]
        others = iter(self.byte_level.encode_batch([t for t, p in zip(texts, plain) if not p], add_special_tokens=False))
        return [self.quick.encode_ordinary(t) if p else next(others).ids for t, p in zip(texts, plain)]


@functools.lru_cache(maxsize=2)
def _encoders(definition: str, model: bytes) -> Encoders:
    import sentencepiece
    import tiktoken
    from tokenizers import Tokenizer

    byte_level = Tokenizer.from_str(definition)
    byte_level.encode_special_tokens = True  # their texts inside a text are plain text
    a_bytes = byte_level_tokens(definition)
    ranks = {token: i for i, token in enumerate(a_bytes) if token}
    quick = tiktoken.Encoding("byte level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    return Encoders(byte_level, quick, pieces, a_bytes, piece_tokens(pieces))


def _ends(ids: list[list[int]], lengths: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Flat ids, the document of each and the byte of the document after each token."""
    lists = pa.array(ids, pa.list_(pa.int64()))
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    summed = pc.cumulative_sum(pc.take(lengths, flat))
    before = np.concatenate(([0], summed.to_numpy()))[lists.offsets.to_numpy()[:-1]]
    return flat, parent, pc.subtract(summed, pc.take(pa.array(before, pa.int64()), parent))


def align_texts(texts: list[str | None], encoders: Encoders) -> pa.Table:
    """A row per text: numbers of tokens, groups and links, the digest of the groups, its linked pairs and how often each is linked."""
    n, whole = len(texts), [" " + (t or "") for t in texts]
    a_ids = encoders.encode_a(whole)
    b_ids = encoders.pieces.encode([t or "" for t in texts], num_threads=1)
    for k, text in enumerate(whole):  # byte-level tokens always join to the text
        if not texts[k] or b"".join(map(encoders.b_bytes.__getitem__, b_ids[k])) != text.encode():
            a_ids[k], b_ids[k] = [], []
    (a, a_doc, a_end), (b, b_doc, b_end) = _ends(a_ids, encoders.a_lengths), _ends(b_ids, encoders.b_lengths)
    left = pa.table({"doc": a_doc, "end": a_end, "in_a": pa.repeat(True, len(a))})
    right = pa.table({"doc": b_doc, "end": b_end, "in_b": pa.repeat(True, len(b))})
    ends = left.join(right, ["doc", "end"], join_type="full outer", use_threads=False)
    # Each place where a token ends closes one link; where both end, a group as well. Both tokenizers cover the same bytes.
    base = np.cumsum([0, *(len(t.encode()) if x else 0 for t, x in zip(whole, a_ids))])
    place = np.argsort(base[ends["doc"].to_numpy()] + ends["end"].to_numpy(), kind="stable")
    in_a, in_b = (pc.is_valid(ends[name]).to_numpy()[place] for name in ("in_a", "in_b"))
    doc, cut = ends["doc"].to_numpy()[place], in_a & in_b
    i, j, group = (np.cumsum(x) - x for x in (in_a, in_b, cut))
    a, b, a_doc, b_doc = a.to_numpy(), b.to_numpy(), a_doc.to_numpy(), b_doc.to_numpy()
    pairs = pa.table({"doc": doc, "pair": a[i] * len(encoders.b_bytes) + b[j]})
    pairs = pairs.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    pairs = pairs.sort_by([("doc", "ascending"), ("pair", "ascending")])
    per_doc = lambda doc: np.bincount(doc, minlength=n).astype(np.int64)
    offsets = pa.array(np.concatenate(([0], np.cumsum(per_doc(pairs["doc"].to_numpy())))), pa.int32())
    return pa.table({
        "n_a": per_doc(a_doc), "n_b": per_doc(b_doc), "n_groups": per_doc(doc[cut]), "n_links": per_doc(doc),
        "groups_sha256": _digests(a, b, group[in_a], group[in_b], per_doc(a_doc) + per_doc(b_doc), encoders),
        "pairs": pa.ListArray.from_arrays(offsets, pairs["pair"].combine_chunks().cast(pa.int64())),
        "times": pa.ListArray.from_arrays(offsets, pairs["count_all"].combine_chunks().cast(pa.int32())),
    })


def _digests(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, tokens: np.ndarray, encoders: Encoders) -> list[str]:
    """Digest of ``a1,a2|b1;a3|b2,b3`` for each document; the empty text, undigested, where it has no tokens."""
    groups = int(a_group[-1]) + 1 if len(a_group) else 0
    a_before, b_before = (np.concatenate(([0], np.cumsum(np.bincount(g, minlength=groups)))) for g in (a_group, b_group))
    texts = np.empty(len(a) + len(b), object)
    a_last = np.append(a_group[1:] != a_group[:-1], True) if len(a) else np.zeros(0, bool)
    b_last = np.append(b_group[1:] != b_group[:-1], True) if len(b) else np.zeros(0, bool)
    texts[np.arange(len(a)) + b_before[a_group]] = np.where(a_last, encoders.bar[a], encoders.comma[a])
    texts[np.arange(len(b)) + a_before[b_group + 1]] = np.where(b_last, encoders.semicolon[b], encoders.comma[b])
    out, begin = [], 0
    for size in tokens.tolist():
        text = "".join(texts[begin : begin + size].tolist())[:-1]
        out.append(hashlib.sha256(text.encode()).hexdigest() if size else "")
        begin += size
    return out


def align(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Aligned documents, written once: ``doc_id``, a number ``row`` of the row, and the columns of :func:`align_texts`.

    ``byte_level`` and ``pieces`` are the paths of the two vocabulary files on the driver; their content, of fixed size, goes to the tasks.
    Texts that are null, empty or not rendered byte by byte by both tokenizers have no tokens: zeros, no digest, no pairs. Whole texts
    are encoded, a slice of about a million characters or one text at a time. Other columns are not read; rows may repeat.
    """
    with open(byte_level, encoding="utf-8") as lines:
        definition = lines.read()
    with open(pieces, "rb") as lines:
        model = lines.read()
    sent = docs.sparkSession.sparkContext.broadcast((definition, model))
    id_type = docs.schema["doc_id"].dataType

    def aligned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = _encoders(*sent.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sizes = np.cumsum([len(t or "") for t in texts])
            begin = 0
            while begin < len(texts):
                done = sizes[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(sizes, done + SLICE_CHARS, side="right")))
                table = align_texts(texts[begin:end], encoders)
                ids = batch.column("doc_id").slice(begin, end - begin)
                yield from table.add_column(0, "doc_id", ids).combine_chunks().to_batches()
                begin = end

    names = ["n_a", "n_b", "n_groups", "n_links"]
    schema = T.StructType([T.StructField("doc_id", id_type), *[T.StructField(name, T.LongType()) for name in names]])
    schema = schema.add("groups_sha256", "string").add("pairs", T.ArrayType(T.LongType())).add("times", T.ArrayType(T.IntegerType()))
    rows = docs.select("doc_id", "text").mapInArrow(aligned, schema)
    return store(rows.withColumn("row", F.monotonically_increasing_id()))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """In how many documents each pair of ids is linked: ``pair``, ``n``."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0

        def merged(tables: list[pa.Table]) -> pa.Table:
            table = pa.concat_tables(tables).group_by("pair", use_threads=False).aggregate([("n", "sum")])
            return table.rename_columns({"n_sum": "n"}).select(["pair", "n"])

        for batch in batches:
            flat = pa.table({"pair": pc.list_flatten(batch.column("pairs"))})
            counted = flat.group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns({"count_all": "n"})
            waiting.append(counted.select(["pair", "n"]))
            rows += len(counted)
            if rows > 1 << 20:
                waiting = [merged(waiting)]
                if len(waiting[0]) > 1 << 19:
                    yield from waiting[0].to_batches()
                    waiting = []
                rows = sum(map(len, waiting))
        if waiting:
            yield from merged(waiting).to_batches()

    partials = aligned.select("pairs").mapInArrow(partial, "pair long, n long")
    return partials.groupBy("pair").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, most: int) -> DataFrame:
    """The pairs above a count that at most ``most`` pairs reach. Counts are compared on a scale of eighths of a power of two."""
    step = F.floor(F.log2("n") * 8)
    sizes = sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True)  # a row for each of 500 steps at most
    least, total = None, 0
    for row in sizes:
        total += row["count"]
        if total > most:
            break
        least = row["step"]
    return counts.where(F.lit(False)) if least is None else counts.where(step >= least)


def score_links(aligned: DataFrame, b_size: int, head: int = HEAD) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` of every row.

    ``n_best`` are the links whose pair has the highest count of all pairs with the same first id, ties included; ``count_sum`` is the
    sum of the counts over all links. ``b_size`` is the size of the second vocabulary.
    """
    spark = aligned.sparkSession
    counts = store(pair_counts(aligned))
    best = store(counts.groupBy(F.floor(F.col("pair") / b_size).alias("a")).agg(F.max("n").alias("best")))
    frequent = _frequent(counts, head).toArrow().sort_by("pair")
    highest = best.toArrow()
    top = np.zeros(1 + max([0, *highest["a"].to_pylist()]), np.int64)
    top[highest["a"].to_numpy()] = highest["best"].to_numpy()
    sent = spark.sparkContext.broadcast((frequent["pair"].to_numpy(), frequent["n"].to_numpy(), top))
    kept = [name for name in aligned.columns if name not in ("pairs", "times")]
    schema = T.StructType([aligned.schema[name] for name in kept])
    link = T.StructType().add("pair", T.LongType()).add("times", T.IntegerType())
    schema = schema.add("n_best", T.LongType()).add("count_sum", T.LongType()).add("rare", T.ArrayType(link))

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, top = sent.value
        for batch in batches:
            lists = batch.column("pairs")
            pair = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
            times = pc.list_flatten(batch.column("times")).to_numpy(zero_copy_only=False).astype(np.int64)
            parent = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
            found = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
            n = np.where(found, values[at] if len(keys) else 0, 0)
            highest = found & (n == top[pair // b_size])
            total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[bounds])
            bounds = np.searchsorted(parent, np.arange(len(batch) + 1))
            rare = pa.StructArray.from_arrays([pa.array(pair[~found]), pa.array(times[~found], pa.int32())], ["pair", "times"])
            offsets = np.concatenate(([0], np.cumsum(~found)))[bounds]
            columns = [batch.column(name) for name in kept]
            columns += [pa.array(total(times * highest)), pa.array(total(times * n))]
            columns += [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rare)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_best", "count_sum", "rare"])

    sums = store(aligned.mapInArrow(scored, schema))
    rare = sums.select("row", F.explode("rare").alias("link")).select("row", "link.*")
    rare = rare.join(counts, "pair").withColumn("a", F.floor(F.col("pair") / b_size)).join(best, "a")
    rare = rare.groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"),
    )
    every = sums.drop("rare").join(rare, "row", "left")
    return every.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).cast("long").alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).cast("long").alias("count_sum"),
        "groups_sha256",
    )


def align_documents(docs: DataFrame, byte_level: str, pieces: str, head: int = HEAD) -> DataFrame:
    """Both steps: documents aligned and their links scored. An empty table gives no rows."""
    import sentencepiece

    b_size = sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()
    return score_links(align(docs, byte_level, pieces), b_size, head)
