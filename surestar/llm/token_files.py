"""Token counts of flat, unindexed token files by separator scan.

A token file is a run of little-endian 16-bit or 32-bit identifiers; each document ends with the separator. ``scan`` lists the
files with Spark, deals their blocks to tasks, which read those ranges of bytes only, and searches each block for separators with one
vector comparison. A block says how many separators it has, how many tokens stand before its first and after its last one, and the lengths between them. A
prefix scan over the blocks of a file then gives each block the number of documents before it and the tokens that an open document brings
along, so a document may reach over any number of blocks.

``write`` makes such files from texts with a public byte-level tokenizer whose path is a parameter.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surestar.llm.common import shared_folder, store

SEPARATOR = 50256
#: Bytes of token files that a task reads, block by block.
TASK_BYTES = 256 << 20
#: Fixed value: the splitting pattern published with the byte-level vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fixed value: the characters with the Unicode property White_Space.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Runs of this many characters are split here, since the library needs stack for spaces and the square of the time for words.
LONG_RUN = 4096
_LONG = re.compile(rf"(?<![{SPACE}])[{SPACE}]{{{LONG_RUN},}}|(?<![^{SPACE}])[^{SPACE}]{{{LONG_RUN},}}")
_NOT_SPACE = re.compile(f"[^{SPACE}]")
_PIECES = regex.compile(PATTERN)


def load_ranks(path: str) -> dict[bytes, int]:
    """Vocabulary file of one token and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_piece(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Tokens of one piece of the splitting pattern by byte-pair merges, lowest rank and leftmost first, with a heap of the pairs."""
    n = len(data)
    after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
    pair = array("q", (ranks.get(data[i : i + 2], -1) if i + 1 < n else -1 for i in range(n)))
    heap = [rank << 40 | i for i, rank in enumerate(pair) if rank >= 0]
    heapq.heapify(heap)

    def look(i: int) -> None:
        j = after[i]
        pair[i] = ranks.get(data[i : after[j]], -1) if j < n else -1
        if pair[i] >= 0:
            heapq.heappush(heap, pair[i] << 40 | i)

    while heap:
        top = heapq.heappop(heap)
        i = top & ((1 << 40) - 1)
        if pair[i] != top >> 40:
            continue
        j = after[i]
        pair[j], after[i] = -1, after[j]
        if after[i] < n:
            before[after[i]] = i
        look(i)
        if before[i] >= 0:
            look(before[i])
    tokens, i = [], 0
    while i < n:
        tokens.append(ranks[data[i : after[i]]])
        i = after[i]
    return tokens


def encode_text(encoding, ranks: dict[bytes, int], text: str) -> list[int]:
    """Tokens of a text of any length, those of ``encoding.encode_ordinary``.

    No piece of the pattern reaches from other characters into white space, and a run of white space before other characters leaves
    its last one to them; so long runs are cut out there. A long run of other characters is split by the same pattern here.
    """
    if len(text) < LONG_RUN:
        return encoding.encode_ordinary(text)
    tokens, done = [], 0
    for m in _LONG.finditer(text):
        start, stop = m.span()
        blank = not _NOT_SPACE.match(text, start)
        if blank:
            stop -= stop < len(text)
        else:
            start = max(done, start - 1)
        tokens += encoding.encode_ordinary(text[done:start])
        for piece in (text[start:stop],) if blank else _PIECES.findall(text, start, stop):
            tokens += encoding.encode_ordinary(piece) if len(piece) < LONG_RUN // 8 else merge_piece(piece.encode("utf-8"), ranks)
        done = stop
    return tokens + encoding.encode_ordinary(text[done:])


def file_system(uri: str):
    """File system of a path or URI for pyarrow, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write(docs: DataFrame, folder: str, vocabulary: str, rows_per_file: int = 8192, separator: int = SEPARATOR) -> DataFrame:
    """Write the texts of ``docs`` as token files below ``folder`` and return ``file``, ``place`` and ``doc_id``.

    ``folder`` is one that all executors can write. Null is the empty text. Each task writes files of at most
    ``rows_per_file`` documents; a file has the name of its task and is moved into place when complete, so a repeated task
    replaces it by the same bytes. The vocabulary, a file of bounded size, is read on the driver. An empty table gives no files.
    """
    ranks = load_ranks(vocabulary)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken
        from pyspark import TaskContext

        encoding = tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        store_at, base = file_system(folder)
        store_at.create_dir(base, recursive=True)
        context, number = TaskContext.get(), 0
        for batch in batches:
            for at in range(0, len(batch), rows_per_file):
                pdf = batch.iloc[at : at + rows_per_file]
                name = f"part-{context.partitionId():06d}-{number:05d}.bin"
                number += 1
                partial = f"{base}/_{name}.{context.taskAttemptId()}"
                with store_at.open_output_stream(partial) as out:
                    for text in pdf.text:
                        tokens = encode_text(encoding, ranks, text or "")
                        tokens.append(separator)
                        out.write(np.array(tokens, "<u2").tobytes())
                store_at.move(partial, f"{base}/{name}")
                yield pd.DataFrame({
                    "file": name, "place": np.arange(len(pdf)), "id": pdf.id.to_numpy(), "none": pdf.none.to_numpy()
                })

    rows = docs.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), "text")
    manifest = store(rows.mapInPandas(encode, "file string, place long, id long, none boolean"))
    return manifest.select("file", "place", F.when(~F.col("none"), F.col("id")).alias("doc_id"))


def block_summary(tokens: np.ndarray, separator: int) -> tuple[int, int, int, bytes]:
    """Separators of a block, tokens before the first and after the last of them, and the lengths between them."""
    found = np.flatnonzero(tokens == separator)
    if not len(found):
        return 0, len(tokens), len(tokens), b""
    return len(found), int(found[0]), int(len(tokens) - 1 - found[-1]), (np.diff(found) - 1).astype("<i8").tobytes()


def scan(spark: SparkSession, folder: str, separator: int = SEPARATOR, width: int = 2, block_tokens: int = 1 << 19) -> DataFrame:
    """``file``, ``place`` and ``n_tokens`` of every document of the token files of a folder, separators not counted.

    ``place`` counts from 0 in each file. Tokens behind the last separator of a file are a document too. Files without
    tokens, and a folder without files, give no rows. Files may be of any size and have any number of blocks; a file whose
    length is not a multiple of ``width`` is refused.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder).select("path", "length")  # names only, no content
    size = block_tokens * width
    tasks = max(spark.sparkContext.defaultParallelism, -(-(files.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES))
    refused = F.raise_error(F.concat(F.lit("not a whole number of tokens: "), "path")).cast("boolean")
    files = files.where(F.when(F.col("length") % width == 0, F.lit(True)).otherwise(refused)).where("length > 0")
    last = F.floor((F.col("length") - 1) / size)
    blocks = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block")).repartition(tasks, "path", "block")

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, length, block in pdf.itertuples(index=False):
                store_at, place = file_system(path)
                with store_at.open_input_file(place) as data:
                    held = data.read_at(min(size, length - block * size), block * size)
                made = block_summary(np.frombuffer(held, f"<u{width}"), separator)
                yield pd.DataFrame([(path.rsplit("/", 1)[-1], block, *made)], columns=["file", "block", "n", "head", "tail", "between"])

    found = store(blocks.mapInPandas(summarise, "file string, block long, n long, head long, tail long, between binary"))
    # the prefix scan is over one narrow row per block
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    open_since = F.coalesce(F.sum("head").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    scanned = found.select("file", "block", "n", "head", "tail").withColumn("since", open_since)
    carried = F.struct("block", "since", "tail")
    scanned = scanned.withColumn("last", F.max(F.when(F.col("n") > 0, carried)).over(upto))
    scanned = scanned.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    # tokens before the first separator of a block: its own head, the heads of blocks without one, the tail of the last block with one
    first = F.col("since") - F.coalesce(F.col("last.since"), F.lit(0)) + F.coalesce(F.col("last.tail"), F.lit(0))
    scanned = scanned.withColumn("first", first).withColumn("final", F.max("block").over(whole) == F.col("block"))

    def lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                n = np.frombuffer(row.between, "<i8")
                if row.n:
                    n = np.concatenate(([row.first], n))
                rest = row.tail if row.n else row.first
                if row.final and rest:
                    n = np.concatenate((n, [rest]))
                yield pd.DataFrame({"file": row.file, "place": row.before + np.arange(len(n)), "n_tokens": n.astype(np.int64)})

    joined = found.select("file", "block", "between").join(scanned.select("file", "block", "n", "tail", "first", "before", "final"), ["file", "block"])
    return joined.mapInPandas(lengths, "file string, place long, n_tokens long")


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every row of ``docs``, counted from token files that are written for it."""
    folder = shared_folder(docs.sparkSession)
    written = write(docs, folder, vocabulary)
    if written.limit(1).count() == 0:
        return written.select("doc_id", F.lit(0).cast("long").alias("n_tokens"))
    return written.join(scan(docs.sparkSession, folder), ["file", "place"]).select("doc_id", "n_tokens")
