"""Text cleaning as native column expressions (no Python code runs per row)."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Mapping, Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that stand for "nothing known" in a location (compared in lower case).
JUNK_TOKENS = (
    "-", ".", "..", "000", "999", "?", "n/d", "s/d", "test", "xxx", "pendiente",
    "", "none", "nan",
)

ZERO_WIDTH_SPACE = "\u200b"
NULL_SENTINEL = "<null>"

# White space: the Unicode property plus the four information separators. The look-behind starts an attempt only
# where a run begins, so long inner runs cost no more than their length.
_SPACE = r"[\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_RARE_SPACE = _SPACE.replace(r"\x1c- ", r"\x1c-\x1f")


@lru_cache(maxsize=1)
def accent_map() -> tuple[str, str]:
    """Accented characters and, position by position, the base character of each.

    Built from the Unicode tables: a character belongs here when its canonical decomposition
    holds exactly one character that is not a non-spacing mark.
    """
    accented, plain = [], []
    for code in range(0xC0, sys.maxunicode + 1):
        char = chr(code)
        decomposed = unicodedata.normalize("NFD", char)
        if decomposed == char:
            continue
        bases = [part for part in decomposed if unicodedata.category(part) != "Mn"]
        if len(bases) == 1:
            accented.append(char)
            plain.append(bases[0])
    return "".join(accented), "".join(plain)


@lru_cache(maxsize=1)
def whitespace() -> str:
    """Every character that counts as white space."""
    return "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def _trim_ends(c: Column) -> Column:
    # Works from both ends; a pattern would look at every run of blanks inside a long text.
    return F.btrim(c, F.lit(whitespace()))


def trim_all(c: Column) -> Column:
    """Trim every kind of white space; Spark's plain ``trim`` removes blanks only.

    The plain one is far cheaper and enough for a text without rare white space.
    """
    return F.when(c.rlike(_RARE_SPACE), _trim_ends(c)).otherwise(F.trim(c))


def blank_to_null(c: Column) -> Column:
    """Trimmed text; empty text becomes null."""
    return F.nullif(trim_all(c), F.lit(""))


def canonical(c: Column) -> Column:
    """Accents removed, upper case, trimmed. Null stays null.

    Pure ASCII text (as many bytes as characters) has no accents, so it skips the two costly passes.
    """
    stripped = F.regexp_replace(F.translate(c, *accent_map()), r"\p{Mn}+", "")
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only, F.upper(trim_all(c))).otherwise(_trim_ends(F.upper(stripped)))


def canonical_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Apply :func:`canonical` to those of the named columns that exist."""
    present = [name for name in columns if name in df.columns]
    return df.withColumns({name: canonical(F.col(name)) for name in present})


def title(c: Column) -> Column:
    """Every run of letters starts in upper case and goes on in lower case.

    ``initcap`` starts words at blanks only; here ``o'higgins`` and ``san-juan`` get two capitals.
    """
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(
        F.transform(runs, lambda run: F.concat(F.upper(F.substring(run, 1, 1)), F.substring(run, 2, 2**31 - 1))),
        "",
    )


def clean_junk(c: Column) -> Column:
    """Location text without invisible characters and closing dots, in title case; junk is null."""
    visible = F.translate(c, ZERO_WIDTH_SPACE + "\t", "")
    # One pattern for: trim, drop the closing dots, trim again.
    closing = rf"^{_SPACE}+|(?<!{_SPACE}){_SPACE}*+\.*{_SPACE}*+$"
    undotted = F.regexp_replace(visible, closing, "")
    return F.when(~F.lower(undotted).isin(*JUNK_TOKENS), title(undotted))


def full_name(first: Column, last: Column) -> Column:
    """``LAST, FIRST``; a missing part leaves no stray comma, two missing parts give null."""
    joined = F.concat(F.coalesce(last, F.lit("")), F.lit(", "), F.coalesce(first, F.lit("")))
    return F.nullif(F.btrim(joined, F.lit(", ")), F.lit(""))


def capitalise(c: Column) -> Column:
    """First character in upper case, the others in lower case, after a trim."""
    trimmed = trim_all(c)
    return F.concat(F.upper(F.substring(trimmed, 1, 1)), F.lower(F.substring(trimmed, 2, 2**31 - 1)))


def location_key(c: Column) -> Column:
    """Form in which location texts are compared: upper case and trimmed."""
    return F.upper(trim_all(c))


def map_values(c: Column, mapping: Mapping[str, Sequence[str]], default: str | None = None) -> Column:
    """Replace listed spellings; ``mapping`` names the result and then its spellings."""
    result: Column | None = None
    for value, spellings in mapping.items():
        hit = c.isin(*spellings)
        result = F.when(hit, value) if result is None else result.when(hit, value)
    return result.otherwise(F.lit(default))


def keyword_class(c: Column, classes: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """First class with a keyword contained in the canonical text; null and blank get the default."""
    text = canonical(c)
    result: Column | None = None
    for value, keywords in classes:
        hit = F.lit(False)
        for keyword in keywords:
            hit = hit | text.contains(keyword)
        result = F.when(hit, value) if result is None else result.when(hit, value)
    return result.otherwise(default)


def row_hash(columns: Sequence[Column]) -> Column:
    """MD5 of the bar-joined texts, with one spelling for null."""
    texts = [F.coalesce(c.cast("string"), F.lit(NULL_SENTINEL)) for c in columns]
    return F.md5(F.concat_ws("|", *texts))


def row_json(columns: Sequence[str]) -> Column:
    """Whole row as JSON text, null fields included."""
    return F.to_json(F.struct(*[F.col(f"`{name}`") for name in columns]), {"ignoreNullFields": "false"})


def clean_header(name: str) -> str:
    """Column name as the rest of the package expects it."""
    return name.strip().lower().replace(" ", "_").replace(".", "")
