"""Language-model scoring by online logistic context mixing over the bytes of whole texts.

A text is its lower-case words, joined by single spaces, and an end mark. It is coded bit by bit. Four hashed contexts predict each
bit together with the bits of the byte so far: the last two, four and six bytes, whatever words they are in, and the byte that followed the last
five bytes where they stood last, with how often in a row such a guess was right. A context's counts of zeros and ones give log odds, weighted by a gate (how often the context was seen). A second set of weights, gated by the place of
the bit in its byte, mixes the contexts and is refined online within each text, block by block, from the bits already coded.

Texts of any length are coded in windows of ``WINDOW`` bytes: contexts start afresh in each, the mix goes on, so memory doesn't grow
with a text. A byte falls into one cell for its upper and one for its lower half in each context; the counts of all its bits are
sums of cells. The corpus is gathered by Spark in one pass: cells and word counts of all training texts are summed by shuffles. The gate weights
are fitted on the summed cells, so on every training bit. Tables of a fixed size are broadcast: the weighted log odds, and the counts
of the ``frequent`` most common words, which only ``n_known`` and ``base_score`` use; other words are looked up for them by a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surestar.llm.common import store

GROUP_BITS = (15, 16, 16, 13)  # of the last two, four and six bytes, and of the guess
KINDS = len(GROUP_BITS)
OFFSETS = tuple(int(x) for x in np.cumsum([0, *[16 << b for b in GROUP_BITS]]))
CELLS, SEGMENT = OFFSETS[-1], 1 << 16
WINDOW, BATCH = 1 << 16, 1 << 17  # bytes of a text coded with the same contexts, least bytes of a batch
GATES, STEPS, START = 16, 12, 0.3  # gates, steps of the log odds to one, weight of each context when a text begins
BLOCKS = np.array([32 << i for i in range(11)])  # ends of the blocks of a text after which its mix is refined, then each window
PRIOR, CURVE, BOUND = 60.0, 10.0, 10.0  # the mix moves by push / (PRIOR + CURVE * spread); log odds stay within the bound
PIECE = 1 << 21  # bytes of text whose words are counted or looked up at once
LONG_WORD = 64  # words of more bytes are never among the frequent ones

PLACE_BITS = (2 * BATCH).bit_length() - 1
_ODD, _PLACES = np.uint64(0x9E3779B97F4A7C15), np.uint64((1 << PLACE_BITS) - 1)
_A, _B, _C = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)
_AT = np.arange(2 * BATCH, dtype=np.int32)
_NODES = (1 << np.arange(4)) | (np.arange(16)[:, None] >> (4 - np.arange(4)))  # of the four bits of half a byte
_SIGNS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.float32) * 2 - 1


def normalised(text: bytes) -> tuple[list[bytes], bytes]:
    """The lower-case words of a text, and what is coded of it."""
    words = text.lower().split()
    return words, b" ".join(words) + b"\n"


def words_of(lines: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of what ``normalised`` codes, one after the other, and the number of words of each line."""
    whole = pa.array(lines, pa.large_binary())
    texts = pa.Array.from_buffers(pa.large_string(), len(whole), whole.buffers())  # bytes that are no UTF-8 are split alike
    parts = pc.ascii_split_whitespace(texts)
    flat, ends = parts.flatten(), np.diff(parts.offsets.to_numpy())
    real = pc.greater(pc.binary_length(flat), 0)  # the end mark leaves an empty part
    long = np.add.reduceat(real.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(ends) - ends) if len(lines) else ends
    return flat.filter(real).cast(pa.large_binary()), long


def pieces(lines: list[bytes]) -> Iterator[list[bytes]]:
    """The lines in runs of ``PIECE`` bytes or a line more, so that the arrays of their words stay small."""
    begin, size = 0, 0
    for i, line in enumerate(lines, 1):
        size += len(line)
        if size >= PIECE or i == len(lines):
            yield lines[begin:i]
            begin, size = i, 0


def cut(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Windows of the texts with the place of each one's text in the list, as batches of bounded size.

    Windows of one text come in order, and only one of them lies in a batch.
    """
    places, windows, size = [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text), WINDOW):
            if at or size + min(len(text), WINDOW) > BATCH:
                yield places, windows
                places, windows, size = [], [], 0
            places.append(i)
            windows.append(text[at : at + WINDOW])
            size += len(windows[-1])
    if windows:
        yield places, windows


def _guesses(flat: np.ndarray, owner: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each byte the one that followed the same five bytes of this window before, with the number of right guesses up to here."""
    n, at = len(flat), _AT[: len(flat)]
    key = (owner.astype(np.uint64) << np.uint64(32) | last) * _ODD  # no two windows and hashes of five bytes have one product
    key &= ~_PLACES
    key |= at.astype(np.uint64)
    key.sort()
    order = (key & _PLACES).astype(np.int32)
    key >>= np.uint64(PLACE_BITS)
    earlier = np.full(n, -1, np.int32)
    earlier[order[1:]] = np.where(key[1:] == key[:-1], order[:-1], np.int32(-1))
    guess, made = flat.take(earlier), earlier >= 0
    wrong = np.maximum.accumulate(np.where((guess == flat) & made, np.int32(-1), at))
    run = np.zeros(n, np.int32)
    np.subtract(at[:-1], wrong[:-1], out=run[1:])
    np.minimum(run, 15, out=run)
    run <<= 8
    run += guess
    run += 1
    run *= made
    return run.view(np.uint32)


def contexts(windows: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """The hashed contexts of every byte of the windows, the bytes, the window of each byte and its place there."""
    flat = np.frombuffer(b"".join(windows), np.uint8)
    n, lengths = len(flat), np.fromiter(map(len, windows), np.int64, len(windows))
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(_AT[: len(windows)], lengths)
    place = _AT[:n] - np.repeat(starts.astype(np.int32), lengths)
    wide = flat.astype(np.uint32)
    four = np.zeros(n, np.uint32)
    for back in range(1, 5):
        four[back:] |= wide[:-back] << np.uint32(8 * (back - 1))
    for done in range(4):  # a window begins with zeros before it
        four[starts[lengths > done] + done] &= np.uint32((1 << (8 * done)) - 1)
    longer = [four * _A]
    for back in (5, 6):
        earlier = np.zeros(n, np.uint32)
        earlier[back:] = wide[:-back] * _B
        for done in range(back):
            earlier[starts[lengths > done] + done] = 0
        longer.append(longer[-1] * _C + earlier)
    return [four & np.uint32(0xFFFF), four, longer[2], _guesses(flat, owner, longer[1])], flat, owner, place


def halves(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Upper and lower half of each byte, and what the upper half adds to a hash."""
    upper = (flat >> 4).astype(np.uint32)
    return upper, (flat & np.uint8(15)).astype(np.uint32), (upper + np.uint32(1)) * _C


def cells(kind: int, context: np.ndarray, half: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The cells of the upper and the lower half of each byte in the table of one kind of context."""
    shift, four = np.uint32(32 - GROUP_BITS[kind]), np.uint32(4)
    hashed = context * _A
    hashed ^= hashed >> np.uint32(15)
    hashed *= _B
    lower = hashed ^ half[2]
    lower ^= lower >> np.uint32(13)
    lower *= _A
    for x, leaf in ((hashed, half[0]), (lower, half[1])):
        x >>= shift
        x <<= four
        x |= leaf
    return hashed, lower


def count_cells(texts: list[bytes], totals: np.ndarray) -> None:
    """Add the cells of all bytes of the texts to ``totals``."""
    waiting: list[list[np.ndarray]] = [[] for _ in range(KINDS)]

    def add() -> None:
        for k, parts in enumerate(waiting):
            if parts:
                totals[OFFSETS[k] : OFFSETS[k + 1]] += np.bincount(np.concatenate(parts), minlength=16 << GROUP_BITS[k])
                parts.clear()

    size = 0
    for _, windows in cut(texts):
        found, flat, _, _ = contexts(windows)
        half = halves(flat)
        for k in range(KINDS):
            waiting[k] += cells(k, found[k], half)
        size += len(flat)
        if size >= 4 * BATCH:
            add()
            size = 0
    add()


def node_counts(leaves: np.ndarray) -> np.ndarray:
    """Zeros and ones seen at the nodes 1 to 15 of every group, from the counts of its 16 cells; 2 x groups x 16."""
    out, level = np.zeros((2, *leaves.shape), np.float32), leaves.astype(np.float32)
    for depth in (3, 2, 1, 0):
        pairs = level.reshape(len(leaves), -1, 2)
        out[:, :, 1 << depth : 2 << depth] = np.moveaxis(pairs, 2, 0)
        level = pairs.sum(2)
    return out


def log_odds(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of a one from counts, and the gate of each node."""
    odds = np.log((ones + np.float32(0.3)) / (zeros + np.float32(0.3)))
    return odds, np.minimum(GATES - 1, 2 * np.log2(1 + zeros + ones)).astype(np.uint8)


def gate_weights(zeros: np.ndarray, ones: np.ndarray, rounds: int = 8) -> np.ndarray:
    """Weight per gate that predicts every counted bit best from the odds of its node without that bit."""
    (up, high), (down, low) = log_odds(zeros, np.maximum(ones - 1, 0)), log_odds(np.maximum(zeros - 1, 0), ones)
    x, gate, n = np.concatenate([up, -down]), np.concatenate([high, low]), np.concatenate([ones, zeros])
    used = (n > 0) & (x != 0)
    x, gate, n, weights = x[used], gate[used], n[used], np.full(GATES, 0.5)
    for _ in range(rounds):
        wrong = 1 / (1 + np.exp(np.clip(weights[gate] * x, -30, 30)))
        push = np.bincount(gate, weights=n * wrong * x, minlength=GATES)
        size = np.bincount(gate, weights=n * wrong * (1 - wrong) * x * x, minlength=GATES)
        weights = np.clip(weights + push / (size + 50), 0, 2)
    return weights


def odds_tables(counts: np.ndarray) -> list[np.ndarray]:
    """Weighted log odds of every node in ``STEPS`` to one, a table per kind of context; groups x 16."""
    tables = []
    for k in range(KINDS):
        zeros, ones = node_counts(counts[OFFSETS[k] : OFFSETS[k + 1]].reshape(-1, 16))
        weights = gate_weights(zeros.ravel(), ones.ravel()).astype(np.float32)
        odds, gates = log_odds(zeros, ones)
        tables.append(np.clip(np.rint(odds * weights[gates] * STEPS), -127, 127).astype(np.int8))
    return tables


def paths(tables: list[np.ndarray]) -> list[np.ndarray]:
    """For each cell the log odds at the four nodes on the way to it, in ``STEPS`` to one, as one value of four bytes."""
    return [np.ascontiguousarray(t[:, _NODES].reshape(-1, 4)).view(np.uint32).ravel() for t in tables]


def _inputs(way: np.ndarray, kind: int, context: np.ndarray, half: tuple) -> np.ndarray:
    """Log odds of the eight bits of each byte, in steps."""
    both = np.empty((len(context), 2), np.uint32)
    both[:, 0], both[:, 1] = map(way.take, cells(kind, context, half))
    return both.view(np.int8).astype(np.float32).reshape(-1, 8)


class Mix:
    """What is carried on within ``n`` texts: the weights, how far they are fixed, the bytes coded, the natural log of the probability."""

    def __init__(self, n: int):
        self.weights = np.full((KINDS, n, 8), START / STEPS, np.float32)
        self.bias = np.zeros((n, 8), np.float32)
        self.spread = np.zeros((n, 8), np.float32)
        self.coded = np.zeros(n, np.int64)
        self.score = np.zeros(n)

    def add(self, ways: list[np.ndarray], texts: np.ndarray, windows: list[bytes]) -> None:
        """Code one window of each of some texts, block by block; ``ways`` are ``paths``."""
        found, flat, owner, place = contexts(windows)
        start = self.coded[texts]
        block = np.searchsorted(BLOCKS, place if not start.any() else place + start.take(owner), "right").astype(np.uint8)
        order = np.argsort(block, kind="stable").astype(np.int32)
        flat, owner, found = flat.take(order), owner.take(order), [c.take(order) for c in found]
        ends = np.cumsum(np.bincount(block))
        for begin, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            # a block of one text is never split: its bytes are all predicted before the weights move
            news = np.flatnonzero(np.diff(owner[begin:end], prepend=-1))
            if len(news):
                self._blocks(ways, texts, flat[begin:end], owner[begin:end], [c[begin:end] for c in found], news)
        self.coded[texts] += np.fromiter(map(len, windows), np.int64, len(windows))

    def _blocks(self, ways: list, texts: np.ndarray, flat: np.ndarray, owner: np.ndarray, found: list, news: np.ndarray) -> None:
        own = texts[owner.take(news)]
        push = np.zeros((KINDS + 2, len(own), 8), np.float32)
        bounds = np.append(news, len(flat))
        step = 1 << 12  # rows at a time, so that they stay in the processor's cache
        for a in range(0, len(flat), step):
            b = min(a + step, len(flat))
            i, j = np.searchsorted(news, a, "right") - 1, np.searchsorted(news, b, "left")
            some, marks = own[i:j], np.maximum(news[i:j] - a, 0)
            long = np.minimum(bounds[i + 1 : j + 1], b) - np.maximum(bounds[i:j], a)
            half = halves(flat[a:b])
            inputs = [_inputs(ways[k], k, found[k][a:b], half) for k in range(KINDS)]
            mixed = np.repeat(self.bias[some], long, axis=0)
            for k in range(KINDS):
                mixed += np.repeat(self.weights[k, some], long, axis=0) * inputs[k]
            np.clip(mixed, -BOUND, BOUND, out=mixed)
            signs = _SIGNS.take(flat[a:b], axis=0)
            mixed *= signs
            np.negative(mixed, out=mixed)
            odds = np.exp(mixed, out=mixed)
            whole = odds + np.float32(1)
            wrong = odds / whole
            self.score[some] -= np.add.reduceat(np.log(whole), marks).sum(1, dtype=np.float64)
            error = wrong * signs
            for k in range(KINDS):
                push[k, i:j] += np.add.reduceat(error * inputs[k], marks)
            push[KINDS, i:j] += np.add.reduceat(error, marks)
            push[KINDS + 1, i:j] += np.add.reduceat(wrong / whole, marks)
        self.spread[own] += push[KINDS + 1]
        rate = np.float32(1) / (np.float32(PRIOR) + np.float32(CURVE) * self.spread[own])
        for k in range(KINDS):
            self.weights[k, own] += rate * push[k] / np.float32(STEPS**2)
        self.bias[own] += rate * push[KINDS]


def log10_scores(ways: list[np.ndarray], texts: list[bytes]) -> np.ndarray:
    """Log10 of the probability of each normalised text."""
    mix = Mix(len(texts))
    for places, windows in cut(texts):
        mix.add(ways, np.array(places), windows)
    return mix.score / np.log(10)


_GATHERED = pa.schema([("segment", pa.int32()), ("counts", pa.binary()), ("word", pa.binary()), ("c", pa.int64())])


def gathered(texts: DataFrame) -> DataFrame:
    """One pass over ``texts`` (binary ``text``): each task's counts of cells, in segments, and of words, a row for each word of a
    piece of the texts."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(CELLS, np.int64)

        def counted(lines: list[bytes]) -> pa.RecordBatch:
            found = words_of(lines)[0].value_counts()
            none = [pa.nulls(len(found), t) for t in _GATHERED.types[:2]]
            arrays = [*none, found.field(0).cast(pa.binary()), found.field(1)]
            return pa.RecordBatch.from_arrays(arrays, schema=_GATHERED)

        for batch in batches:
            coded = [normalised(text)[1] for text in batch.column(0).to_pylist()]
            yield from map(counted, pieces(coded))
            count_cells(coded, totals)
        for at in range(0, CELLS, SEGMENT):
            piece = totals[at : at + SEGMENT]
            if piece.any():
                yield pa.RecordBatch.from_pydict({"segment": [at], "counts": [piece.astype(np.uint32).tobytes()], "word": [None], "c": [None]}, _GATHERED)

    return texts.select("text").mapInArrow(gather, "segment int, counts binary, word binary, c long")


def cell_counts(parts: DataFrame) -> np.ndarray:
    """The segments that tasks have handed on, summed by a shuffle."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[segment] = sums.get(segment, 0) + np.frombuffer(part, np.uint32).astype(np.uint64)
        for segment, total in sums.items():
            yield pa.RecordBatch.from_pydict({"segment": pa.array([segment], pa.int32()), "counts": [total.astype(np.float32).tobytes()]})

    counts = np.zeros(CELLS, np.float32)
    segments = parts.where("segment IS NOT NULL").select("segment", "counts")
    for row in segments.repartition("segment").mapInArrow(add, "segment int, counts binary").collect():  # CELLS / SEGMENT rows at most
        counts[row.segment : row.segment + SEGMENT] = np.frombuffer(row.counts, np.float32)
    return counts


def frequent_words(vocabulary: DataFrame, most: int) -> Column:
    """Condition that holds for at most ``most`` words, the most frequent ones, found from a histogram of the counts.

    The histogram has at most a thousand steps; the words of the last step that still fits are all frequent.
    """
    step = F.floor(F.log2("c") * 16).cast("int")
    steps = vocabulary.where("c > 0").groupBy(step.alias("step")).count().collect()
    words, least = 0, None
    for row in sorted(steps, reverse=True):
        words += row["count"]
        if words > most:
            break
        least = row["step"]
    return F.lit(False) if least is None else (F.col("c") > 0) & (step >= least)


def looked_up(known: pa.Array, often: np.ndarray, floor: int, lines: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """For each line the number of its words, how many are known, the sum of their log10 probabilities, and the other words."""
    words, long = words_of(lines)
    at = pc.index_in(words, known)
    missed = pc.is_null(at).to_numpy(zero_copy_only=False)
    logs = np.log10((often.take(at.drop_null().to_numpy()) + 1) / floor)
    ends = np.concatenate(([0], np.cumsum(long)))
    rare = np.concatenate(([0], np.cumsum(missed)))[ends]  # up to the end of each line
    own = (ends - rare).tolist()
    base = np.array([logs[i:j].sum() for i, j in zip(own[:-1], own[1:], strict=True)])
    others = pa.ListArray.from_arrays(pa.array(rare, pa.int32()), words.filter(pa.array(missed)).cast(pa.binary()))
    return long, np.diff(own), base, others


def score_texts(docs: DataFrame, training: Column, frequent: int = 200_000) -> DataFrame:
    """Scores of every row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score``, ``bits_per_byte``.

    ``training`` chooses the rows that the model learns from. Tokens are lower-case words and one end per text; null is the
    empty text, which has its end only. Without training rows all contexts are empty. Scores are log10 probabilities; ``score`` is that
    of all bytes of the text by the mixer and doesn't depend on ``frequent``; ``bits_per_byte`` is over the bytes that were coded, the end among them. Repeated rows are scored alike.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"), training.alias("training"))
    learned = rows.where("training")
    parts = store(gathered(learned))
    vocabulary = store(parts.where("word IS NOT NULL").groupBy("word").agg(F.sum("c").alias("c")))
    total, kinds = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends = learned.count()
    n, v = total + ends, kinds + (ends > 0)

    tables = spark.sparkContext.broadcast(odds_tables(cell_counts(parts)))
    common = vocabulary.where(F.octet_length("word") <= LONG_WORD)
    common = common.where(frequent_words(common, frequent)).toPandas()  # so many words of so many bytes at most
    table = spark.sparkContext.broadcast((pa.array(map(bytes, common.word), pa.large_binary()), common.c.to_numpy(np.float64)))
    floor = n + v + 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        (known, often), ways = table.value, paths(tables.value)
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            coded = [normalised(text)[1] for text in batch.column(2).to_pylist()]
            if coded:
                found = [looked_up(known, often, floor, lines) for lines in pieces(coded)]
                long, hits, base = (np.concatenate(x) for x in list(zip(*found, strict=True))[:3])
                made = {
                    "n_tokens": long + 1, "n_bytes": np.fromiter(map(len, coded), np.int64, len(coded)), "n_known": hits + (ends > 0),
                    "base": base + np.log10((ends + 1) / floor), "score": log10_scores(ways, coded), "key": key + np.arange(len(coded)),
                    "rare": pa.concat_arrays([x[3] for x in found]),
                }
                arrays = [batch.column(0), batch.column(1), *(pa.array(made[f.name], f.type) for f in list(schema)[2:])]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)
                key += len(coded)

    whole = [(name, pa.int64()) for name in ("n_tokens", "n_bytes", "n_known")]
    schema = pa.schema([
        ("id", pa.int64()), ("none", pa.bool_()), *whole, ("base", pa.float64()), ("rare", pa.list_(pa.binary())), ("score", pa.float64()),
        ("key", pa.int64()),
    ])
    keyed = rows.select(F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.col("doc_id").isNull().alias("none"), "text")
    scored = store(keyed.mapInArrow(
        score, "id long, none boolean, n_tokens long, n_bytes long, n_known long, base double, rare array<binary>, score double, key long"
    ))
    rare = scored.select("key", F.explode("rare").alias("word")).join(vocabulary, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    added = rare.groupBy("key").agg(
        F.sum(F.log10((F.col("c") + 1) / F.lit(float(floor)))).alias("base2"), F.sum((F.col("c") > 0).cast("long")).alias("known2")
    )
    both = scored.drop("rare").join(added, "key", "left")
    return both.select(
        F.when(~F.col("none"), F.col("id")).alias("doc_id"), "n_tokens", (F.col("n_known") + F.coalesce("known2", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("base2", F.lit(0.0))).alias("base_score"), "score",
        (-F.col("score") * F.lit(float(np.log2(10))) / F.col("n_bytes")).alias("bits_per_byte"),
    )
