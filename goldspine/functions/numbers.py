"""Lenient parsing, ratios and rounding."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F, types as T

from goldspine.functions.text import _BLANK, _FOOTNOTE

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
_DECIMALS = {
    T.ByteType: "decimal(19,0)",
    T.ShortType: "decimal(19,0)",
    T.IntegerType: "decimal(19,0)",
    T.LongType: "decimal(19,0)",
}


def to_integer(value: Column, dtype: T.DataType) -> Column:
    """BIGINT from text that may hold separators, or from any numeric column.

    Text keeps its digits and minus signs. Numbers are rounded instead, so a
    float is never read through its decimal point. Unparsable is null.
    """
    if isinstance(dtype, T.StringType):
        return F.regexp_replace(value, "[^0-9-]", "").try_cast("bigint")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.round(F.nanvl(value, F.lit(None))).try_cast("bigint")
    return F.round(value).try_cast("bigint")


def to_double(value: Column, dtype: T.DataType) -> Column:
    """DOUBLE from text with blanks or a decimal comma; unparsable is null."""
    if isinstance(dtype, T.StringType):
        text = F.replace(F.replace(value, F.lit(" "), F.lit("")), F.lit(","), F.lit("."))
        text = F.regexp_replace(text, f"^[{_BLANK}]+|[{_BLANK}]+$", "")
        return F.when(text.rlike(_NUMBER), text.try_cast("double"))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return nan_to_null(value.cast("double"))
    return value.try_cast("double")


def nan_to_null(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


@lru_cache(maxsize=1)
def _decimal_digits() -> tuple[str, str]:
    digits = [chr(p) for p in range(0x80, sys.maxunicode + 1) if unicodedata.category(chr(p)) == "Nd"]
    return "".join(digits), "".join(str(unicodedata.decimal(d)) for d in digits)


def grouped_integer(value: Column) -> Column:
    """BIGINT from a displayed count: footnotes, blanks and commas dropped.

    Null unless only decimal digits remain. Digits of other scripts count.
    """
    text = F.translate(F.regexp_replace(value, f"{_FOOTNOTE}|[{_BLANK},]", ""), *_decimal_digits())
    return F.when(text.rlike(r"^[0-9]+\z"), text.try_cast("bigint"))


def as_decimal(value: Column, dtype: T.DataType) -> Column:
    """Exact form for ratios; six decimals are kept so small areas survive."""
    if isinstance(dtype, T.DecimalType):
        return value
    return value.try_cast(_DECIMALS.get(type(dtype), "decimal(24,6)"))


def ratio(
    numerator: Column,
    denominator: Column,
    numerator_type: T.DataType,
    denominator_type: T.DataType,
    places: int = 2,
) -> Column:
    """numerator / denominator rounded half-up; null for a null or zero divisor."""
    top = as_decimal(numerator, numerator_type)
    bottom = as_decimal(denominator, denominator_type)
    return F.round(F.try_divide(top, F.nullif(bottom, F.lit(0).cast("decimal(1,0)"))), places)


def frame_ratio(df, numerator: str, denominator: str, places: int = 2) -> Column:
    """``ratio`` of two columns of ``df``, with their types looked up."""
    return ratio(
        F.col(numerator),
        F.col(denominator),
        df.schema[numerator].dataType,
        df.schema[denominator].dataType,
        places,
    )
