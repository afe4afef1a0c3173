"""Delimited extracts with a header, read as text only."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surestar.functions.text import clean_header
from surestar.schemas import FEEDS, FeedSpec
from surestar.session import materialise
from surestar.sources.files import exists, join_path

ORDINAL = "_ordinal"
MALFORMED = "_malformed"

# Cell texts that count as null in every extract.
NULL_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

BOM = "\ufeff"
SINGLE_BYTE = "ISO-8859-1"  # each byte is a letter, so nothing is lost
UTF8_ROWS, OTHER_ROWS = "rows with UTF-8 letters", "rows that are not UTF-8"


def read_csv(
    spark: SparkSession,
    path: str,
    encoding: str | None = "UTF-8",
    null_cells: Iterable[str] = NULL_CELLS,
    multi_line: bool = False,
) -> DataFrame:
    """Read a file or folder with all columns as text, cleaned headers, a row ordinal and the raw text of broken rows.

    Quotes in quoted cells are doubled. A row with more or fewer cells than the header has is broken: its text is in
    ``_malformed``, which is null for all others. The files of a folder need the same header; another one fails.
    Line breaks inside quotes need ``multi_line``, otherwise such a row becomes broken rows.

    The ordinal is one number that grows with the file (by its full path) and with the place in it. Store the rows as they are
    read: the ordinal is only right in the query that reads the file, and broken rows are only found where all cells are read.

    Without an encoding, cells and broken rows hold a letter per byte. Count while the rows are stored what they are
    (:func:`encoding_counts`), and read them back with :func:`decoded`. Headers are decoded at once.
    """
    named = encoding or SINGLE_BYTE
    options = {"header": True, "encoding": named, "escape": '"', "multiLine": multi_line}
    header = spark.read.options(**options).csv(path).columns
    names = [clean_header(name if encoding else _header_text(name)) for name in header]
    if len(set(names)) != len(names):
        raise ValueError(f"{path}: two columns have the same name after cleaning: {names}")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*header, MALFORMED]])
    reader = spark.read.schema(schema).options(**options, enforceSchema=False, columnNameOfCorruptRecord=MALFORMED)
    raw = reader.csv(path)
    nulls = list(null_cells)
    cells = [F.col(f"`{old}`") for old in header]
    columns = [F.when(~c.isin(*nulls), c).alias(name) for c, name in zip(cells, names)]
    return _with_ordinal(raw, path, [*columns, F.col(MALFORMED)])


def _header_text(name: str) -> str:
    raw = name.encode("latin-1")
    try:
        return raw.decode("utf-8-sig")
    except UnicodeDecodeError:
        return name


def file_offsets(files: Iterable[tuple[str, int]]) -> list[tuple[str, int]]:
    """Each path with the room that all files before it take, in the order of the full paths: a file's size and 2^33 rows."""
    out, total = [], 0
    for path, size in sorted(files):
        out.append((path, total))
        total += size + 2**33
    return out


def _with_ordinal(raw: DataFrame, path: str, columns: list[Column]) -> DataFrame:
    """Add the room of the files before this one, plus the offset of the split, plus the number of the row in its partition.

    Splits of the full size are partitions of their own, in which a row takes a byte at least, so the sum stays below the offset of the
    next split. What is left of a file, or a small one, may come after others in a partition; the 2^33 rows of a partition fit in the
    room of a file. So one number does, up to a billion files, whatever their names. The offsets are a table keyed by the
    full path that the optimizer joins.
    """
    place = F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    spark = raw.sparkSession
    if len(raw.inputFiles()) < 2:
        return raw.select(*columns, place.alias(ORDINAL))
    # The listing alone: the content of the files is a column that is not read.
    listed = spark.read.format("binaryFile").load(path).select("_metadata.file_path", "_metadata.file_size")
    offsets = spark.createDataFrame(file_offsets(map(tuple, listed.collect())), "_path string, _before long")
    placed = raw.select(*columns, place.alias("_place"), F.col("_metadata.file_path").alias("_file"))
    joined = placed.join(offsets, F.col("_file") == F.col("_path"), "left")
    came = F.raise_error(F.concat(F.col("_file"), F.lit(" came while the folder was read"))).cast("long")
    number = F.coalesce("_before", came) + F.col("_place")
    return joined.withColumn(ORDINAL, number).drop("_file", "_path", "_before", "_place")


def _text_columns(df: DataFrame) -> list[str]:
    return [name for name in df.columns if name != ORDINAL]


def _as_utf8(c: Column) -> Column:
    """The text that the bytes of a cell read in a single-byte encoding are in UTF-8."""
    return F.encode(c, SINGLE_BYTE).cast("string")


def encoding_counts(df: DataFrame) -> list[Column]:
    """Aggregates over a feed read in the single-byte encoding: rows with letters beyond ASCII that are UTF-8, and rows that are not."""
    whole = F.concat_ws("", *[F.col(f"`{name}`") for name in _text_columns(df)])
    valid = F.is_valid_utf8(_as_utf8(whole))
    return [F.count_if(valid & whole.rlike("[\\x80-\\xFF]")).alias(UTF8_ROWS), F.count_if(~valid).alias(OTHER_ROWS)]


def found_encoding(counts: Mapping[str, int]) -> str:
    """UTF-8 unless some row is not."""
    return SINGLE_BYTE if counts.get(OTHER_ROWS) else "UTF-8"


def decoded(df: DataFrame, encoding: str) -> DataFrame:
    """A feed that was read in the single-byte encoding as the texts it holds."""
    if encoding == SINGLE_BYTE:
        return df
    return df.withColumns({name: _as_utf8(F.col(f"`{name}`")) for name in _text_columns(df)})


def guessed(cell: Column) -> Column:
    """The text of one cell before the encoding of its feed is known."""
    return F.when(F.is_valid_utf8(_as_utf8(cell)), _as_utf8(cell)).otherwise(cell)


def read_csv_any_encoding(spark: SparkSession, path: str) -> DataFrame:
    """Read UTF-8 or, if some row is not, Latin-1. The file is read once, into the shared folder; what it is comes out on the way."""
    raw, seen = read_csv(spark, path, None), Observation()
    stored = materialise(raw.observe(seen, *encoding_counts(raw)))
    return decoded(stored, found_encoding(seen.get))


def conform(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Fail on a missing required column, add missing optional ones as null, keep all others."""
    missing = [name for name in spec.required if name not in df.columns]
    if missing:
        raise ValueError(f"feed {spec.name}: missing columns {missing}")
    absent = [name for name in spec.optional if name not in df.columns]
    return df.withColumns({name: F.lit(None).cast("string") for name in absent}) if absent else df


def read_feed(spark: SparkSession, folder: str, spec: FeedSpec) -> DataFrame | None:
    """The feed, or ``None`` if its file is not there. See :func:`read_csv` for one whose encoding is not known."""
    path = join_path(folder, spec.file)
    if not exists(spark, path):
        return None
    return conform(read_csv(spark, path, spec.encoding, multi_line=spec.multi_line), spec)


def read_all_feeds(spark: SparkSession, folder: str) -> dict[str, DataFrame | None]:
    return {spec.name: read_feed(spark, folder, spec) for spec in FEEDS}


def write_csv(df: DataFrame, path: str) -> None:
    """Write a CSV folder whose files start with a UTF-8 byte-order mark in the header."""
    first, *others = df.columns
    marked = df.withColumnRenamed(first, BOM + first)
    marked.select(BOM + first, *others).write.mode("overwrite").option("header", True).csv(path)
