"""Lenient parsing: bad input becomes null or a default and never fails the job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surestar.functions.text import blank_to_null, trim_all

MONEY = "decimal(12,2)"  # what the warehouse stores
RAW_MONEY = "decimal(20,2)"  # what curation keeps, so that an overflow is seen later and not lost
MEASURE = "decimal(24,6)"  # other numbers

# Texts that mean "no reference" besides null and blank.
NULL_PLACEHOLDERS = ("nan", "None", "<NA>", "NaN")
TRUE_TOKENS = ("true", "1")
FALSE_TOKENS = ("false", "0")

# Default date texts: ISO with dashes or slashes, days and months with one digit too, optionally with a time to the
# minute, second or fraction and a zone.
_ZONE = r"(Z|[+-][01]\d:?[0-5]\d)"
_TIME = rf"[ T]([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{{1,9}})?)?{_ZONE}?"
_ISO = rf"^\d{{4}}([-/])\d{{1,2}}\1\d{{1,2}}({_TIME})?$"

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def lenient_timestamp(c: Column, formats: Sequence[str] | None = None) -> Column:
    """Timestamp, null for a text that fits none of the formats.

    Without formats ISO texts are taken. Their shape is checked first, because a cast alone would take ``2011``
    for a date; a cast is several times faster than a pattern that fails.
    """
    text = trim_all(c)
    if formats is None:
        # The day and time as written count, whatever the zone.
        written = F.regexp_replace(F.translate(text, "/", "-"), rf"(:\d\d(\.\d+)?){_ZONE}$", "$1")
        return F.when(text.rlike(_ISO), written.try_cast("timestamp"))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats])


def lenient_date(c: Column, formats: Sequence[str] | None = None) -> Column:
    return lenient_timestamp(c, formats).cast("date")


def lenient_dates(df: DataFrame, columns: Iterable[str], formats: Sequence[str] | None = None) -> DataFrame:
    present = [name for name in columns if name in df.columns]
    return df.withColumns({name: lenient_date(F.col(name), formats) for name in present})


def parsed_number(c: Column, type_name: str = RAW_MONEY) -> Column:
    """Number, or null for anything that is not one.

    The pattern comes first because a cast alone would take ``1d`` and ``nan`` for numbers.
    """
    text = trim_all(c)
    return F.when(text.rlike(_NUMBER), text.try_cast(type_name))


def lenient_number(c: Column, type_name: str = RAW_MONEY, default: str | int = 0) -> Column:
    """Number, or the default for null and for anything that is not a number."""
    return F.coalesce(parsed_number(c, type_name), F.lit(default).cast(type_name))


def number_coerced(c: Column, type_name: str = RAW_MONEY) -> Column:
    """True where :func:`lenient_number` replaced a non-blank text by the default."""
    return blank_to_null(c).isNotNull() & parsed_number(c, type_name).isNull()


def lenient_integer(c: Column, default: int = 0) -> Column:
    """Whole number (fractions are cut off), or the default."""
    return F.coalesce(parsed_number(c, MEASURE).try_cast("bigint"), F.lit(default).cast("bigint"))


def lenient_numbers(
    df: DataFrame, columns: Iterable[str], type_name: str = RAW_MONEY, default: str | int = 0
) -> DataFrame:
    present = [name for name in columns if name in df.columns]
    return df.withColumns({name: lenient_number(F.col(name), type_name, default) for name in present})


def has_token(c: Column, tokens: Sequence[str] = TRUE_TOKENS) -> Column:
    """True if the trimmed lower-case text is one of the tokens; null counts as false."""
    return F.coalesce(F.lower(trim_all(c)).isin(*tokens), F.lit(False))


def token_flag(c: Column) -> Column:
    """True or false for the known tokens, null for any other text."""
    return F.when(has_token(c, TRUE_TOKENS), True).when(has_token(c, FALSE_TOKENS), False)


def token_unknown(c: Column) -> Column:
    """True where :func:`token_flag` met a text it does not know."""
    return blank_to_null(c).isNotNull() & token_flag(c).isNull()


def clean_id(c: Column) -> Column:
    """Identifier as trimmed text; blank is null."""
    return blank_to_null(c.cast("string"))


def not_placeholder(c: Column) -> Column:
    """Trimmed text; blank and the texts that mean "no reference" are null."""
    return F.when(~c.isin("", *NULL_PLACEHOLDERS), c)


def clean_reference(c: Column) -> Column:
    """Identifier of another row; blank and the placeholder texts are null."""
    return not_placeholder(trim_all(c.cast("string")))


def date_key(c: Column) -> Column:
    """Date as the integer ``yyyymmdd``."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.day(c)).cast("int")
