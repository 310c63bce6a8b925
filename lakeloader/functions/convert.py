"""Value conversion: every converter gives a value and an error flag.

A converter never raises and never guesses: a value that doesn't fit its kind
gives null with the flag set, and the caller decides what a flag means. All of
it is expressions, so a stream's conversion is one projection. A flag can only
be set where the value is null, so callers need to look at it only there.

Two kinds of input exist. A *cell* is text with a one-letter tag in front, as
the text lanes hand it over: `s` text, `i` integer, `f` float, `b` boolean. A
*native* value is a typed Parquet column.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloader.functions import kinds as K
from lakeloader.functions.datetimes import iso_datetime, iso_timestamp
from lakeloader.functions.jsontext import float_text, json_text, quoted

_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]*"
# What counts as number text. `007`, `1.` and `1,000` don't.
INTEGER_TEXT = rf"^{_SPACE}[+-]?(?:0|[1-9][0-9]*){_SPACE}\z"
NUMBER_TEXT = (
    rf"^{_SPACE}[+-]?(?:(?:0|[1-9][0-9]*)(?:\.[0-9]+)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?{_SPACE}\z"
)
_TRUE_FALSE = rf"(?i)^{_SPACE}(true|false){_SPACE}\z"


class Converted(NamedTuple):
    """A converted value, and whether the input was no value of the kind."""

    value: Column
    failed: Column
    can_fail: bool = True


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{_SPACE}|{_SPACE}\z", "")


def is_number_text(text: Column) -> Column:
    """Text that is a plain decimal number."""
    return text.rlike(NUMBER_TEXT)


def is_not_finite(value: Column) -> Column:
    """A double that is NaN or infinite."""
    return F.isnan(value) | (F.abs(value) == F.lit(float("inf")))


def _finite(value: Column) -> Column:
    return F.when(~is_not_finite(value), value)


def _integral(text: Column, target: T.DataType) -> Column:
    """Integer text in a type, null past its range."""
    return _strip(text).try_cast(target)


def _whole_double(value: Column, target: T.DataType) -> Column:
    whole = F.when(value % F.lit(1.0) == 0, value)
    if isinstance(target, T.LongType):
        # 2^63 itself is no long, but casting it would saturate.
        return F.when(F.abs(whole) < F.lit(2.0**63), whole).try_cast(target)
    return whole.try_cast(target)


def convert_text(text: Column, kind: str) -> Converted:
    """Convert plain text, as read from a delimited file or a JSON string.

    Empty text is null in every column that is no string.
    """
    if kind in (K.STRING, K.EMPTY, K.DATE):
        value = text if kind != K.DATE else F.nullif(text, F.lit(""))
        return _no_error(value)
    given = F.when(text != "", text)
    if kind in (K.INTEGER, K.WIDE_INTEGER):
        value = F.when(given.rlike(INTEGER_TEXT), _integral(given, K.spark_type(kind)))
        return Converted(value, given.isNotNull() & value.isNull())
    if kind == K.NUMBER:
        fits = given.rlike(NUMBER_TEXT)
        # 1e400 overflows to infinity: null, but no error.
        return Converted(_finite(F.when(fits, _strip(given).try_cast("double"))), ~fits)
    if kind == K.BOOLEAN:
        value = F.when(given.rlike(_TRUE_FALSE), F.lower(_strip(given)) == "true")
        return Converted(value, given.isNotNull() & value.isNull())
    if kind == K.DATE_TIME:
        value = iso_datetime(given)
        return Converted(value, given.isNotNull() & value.isNull())
    if kind == K.ANY:
        return Converted(F.try_parse_json(quoted(text)), F.lit(False))
    return Converted(F.lit(None).cast(K.spark_type(kind)), given.isNotNull())


def _no_error(value: Column) -> Converted:
    return Converted(value, F.lit(False), False)


# Cells that hold no value in any column.
_NO_VALUE = ("fnan", "finf", "f-inf")


def convert_cell(cell: Column, kind: str) -> Converted:
    """Convert a tagged cell."""
    tag, text = F.substring(cell, 1, 1), F.substring(cell, 2, 1 << 30)
    from_text = convert_text(text, kind)
    given = ~cell.isin(*_NO_VALUE)
    if kind in (K.STRING, K.EMPTY):
        return _no_error(F.when(given, text))
    if kind == K.ANY:
        return _no_error(F.when(tag == "s", from_text.value).when(given, F.try_parse_json(text)))
    value = F.when(tag == "s", from_text.value)
    failed = F.when(tag == "s", from_text.failed)
    if kind in (K.INTEGER, K.WIDE_INTEGER):
        target = K.spark_type(kind)
        value = value.when(tag == "i", text.try_cast(target)).when(
            tag == "f", _whole_double(text.try_cast("double"), target)
        )
    elif kind == K.NUMBER:
        value = value.when(tag.isin("i", "f"), _finite(text.try_cast("double")))
        failed = failed.when(tag == "i", F.lit(False))
    elif kind == K.BOOLEAN:
        value = value.when(tag == "b", text == "true")
    return Converted(
        value.cast(K.spark_type(kind)),
        value.isNull() & F.coalesce(failed.otherwise(given), F.lit(False)),
    )


def _native_text(value: Column, data_type: T.DataType) -> Column:
    """The text of a typed value, as a string column shows it."""
    if isinstance(data_type, (T.StringType, T.IntegralType, T.BooleanType)):
        return value.cast("string")
    if isinstance(data_type, T.BinaryType):
        return F.base64(value)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return iso_timestamp(value)
    if isinstance(data_type, T.DecimalType):
        if K.kind_of_type(data_type) == K.INTEGER:
            return value.cast("string")
        return float_text(value.cast("double"))
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return float_text(_finite(value.cast("double")))
    if isinstance(data_type, T.StructType):
        return json_text(value, data_type)
    # A list without a non-null item, and an empty map, are null.
    if isinstance(data_type, T.ArrayType):
        filled = F.exists(value, lambda item: item.isNotNull())
        return F.when(filled, json_text(value, data_type))
    if isinstance(data_type, T.MapType):
        return F.when(F.size(value) > 0, json_text(value, data_type))
    return value.cast("string")


def convert_native(value: Column, data_type: T.DataType, kind: str) -> Converted:
    """Convert a typed Parquet value."""
    target = K.spark_type(kind)
    own = K.kind_of_type(data_type)
    if isinstance(data_type, T.StringType):
        return convert_text(value, kind)
    if isinstance(data_type, T.NullType):
        return _no_error(F.lit(None).cast(target))
    if kind in (K.STRING, K.EMPTY):
        return _no_error(_native_text(value, data_type))
    if own == K.STRING:
        # Binary, time, and containers kept whole: they are text by now.
        return convert_text(_native_text(value, data_type), kind)
    given = value.isNotNull()
    if own == K.NUMBER:
        number = value.cast("double")
        given = given & ~is_not_finite(number)
        if kind == K.NUMBER:
            return _no_error(_finite(number))
        if kind in (K.INTEGER, K.WIDE_INTEGER):
            if isinstance(data_type, T.DecimalType):
                converted = F.when(value == F.floor(value), value).try_cast(target)
            else:
                converted = _whole_double(number, target)
            return Converted(converted, given & converted.isNull())
    if own == K.INTEGER:
        if kind in (K.INTEGER, K.WIDE_INTEGER):
            converted = value.try_cast(target)
            return Converted(converted, given & converted.isNull())
        if kind == K.NUMBER:
            return _no_error(value.cast("double"))
    if own == K.BOOLEAN and kind == K.BOOLEAN:
        return _no_error(value)
    if own == K.DATE_TIME and kind == K.DATE_TIME:
        return _no_error(iso_timestamp(value))
    if own in (K.DATE_TIME, K.DATE) and kind == K.DATE:
        return _no_error(value.cast("date").cast("string"))
    if own == K.DATE and kind == K.DATE_TIME:
        return _no_error(F.concat(value.cast("string"), F.lit("T00:00:00+00:00")))
    if kind == K.ANY:
        if own in (K.DATE_TIME, K.DATE):
            return _no_error(F.try_parse_json(quoted(_native_text(value, data_type))))
        return _no_error(F.try_parse_json(F.when(given, value.cast("string"))))
    return Converted(F.lit(None).cast(target), given)


def error_text(column: str, kind: str, shown: Column) -> Column:
    """The message for a value that doesn't fit its column."""
    return F.concat(
        F.lit(f"column '{column}': value "), F.coalesce(shown, F.lit("?")), F.lit(f" is not a valid {kind}")
    )


def typed_view(value: Column, kind: str) -> Column:
    """A date or date-time text column as a date or timestamp."""
    if kind == K.DATE_TIME:
        return value.cast("timestamp")
    return value.cast("date") if kind == K.DATE else value
