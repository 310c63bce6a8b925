"""Date-time text as DataFrame expressions. Results keep their own offset."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted ISO layout. A fraction needs seconds, and has three
# digits, or six and more (cut to six).
_DAY = r"(?!0000)\d{4}-\d{2}-\d{2}"
_CLOCK = r"(?:[01]\d|2[0-3]):[0-5]\d"
_SECONDS = r"[0-5]\d"
_ZONE = r"Z|[+-](?:[01]\d|2[0-3])(?::?[0-5]\d)?"
ISO_PATTERN = (
    rf"(?is)^[\s\x1c-\x1f\x85\p{{Z}}]*({_DAY})"
    rf"(?:[T ]({_CLOCK})(?::({_SECONDS})(\.\d{{6,}}|\.\d{{3}})?)?({_ZONE})?)?"
    r"[\s\x1c-\x1f\x85\p{Z}]*\z"
)


# The usual form, in UTC or without a zone, needs no taking apart.
_USUAL = (
    r"^(?!0000)\d{4}-\d{2}-\d{2}T(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:\.\d{3}|\.\d{6})?(?:Z|\+00:00)?\z"
)
_MARK = "\x01"


def iso_datetime(text: Column) -> Column:
    """Normalize an ISO date or date-time. Null for any other text.

    No zone means UTC, and a date alone is midnight, so the result always has
    the form `2026-09-01T12:00:00[.ffffff]+00:00`.
    """
    clock = F.substring_index(F.substring_index(text, "Z", 1), "+", 1)
    micros = F.rpad(F.substring(clock, 20, 7), 7, "0")
    no_micros = (F.length(clock) == 19) | (micros == ".000000")
    usual = F.when(
        F.substring(text, 1, 10).try_cast("date").isNotNull(),
        F.concat(F.substring(text, 1, 19), F.when(no_micros, "").otherwise(micros), F.lit("+00:00")),
    )
    # One match gives all parts; text that doesn't match comes back unchanged.
    marked = F.regexp_replace(text, ISO_PATTERN, _MARK.join(f"${n}" for n in range(1, 6)))
    parts = F.transform(F.array(F.split(marked, _MARK)), _from_parts)
    any_form = F.when(text.rlike(ISO_PATTERN), F.get(parts, F.lit(0)))
    return F.when(text.rlike(_USUAL), usual).otherwise(any_form)


def _from_parts(parts: Column) -> Column:
    day, clock, seconds, fraction, zone = (F.get(parts, F.lit(n)) for n in range(5))
    micros = F.rpad(F.substring(fraction, 1, 7), 7, "0")
    digits = F.translate(zone, "Zz+-:", "")
    offset = F.concat(
        F.substring(zone, 1, 1), F.substring(digits, 1, 2), F.lit(":"),
        F.rpad(F.substring(digits, 3, 2), 2, "0"),
    )
    whole = F.concat(
        day,
        F.lit("T"),
        F.when(clock == "", "00:00").otherwise(clock),
        F.lit(":"),
        F.when(seconds == "", "00").otherwise(seconds),
        F.when(F.translate(micros, ".0", "") == "", "").otherwise(micros),
        F.when(F.translate(digits, "0", "") == "", "+00:00").otherwise(offset),
    )
    return F.when(day.try_cast("date").isNotNull(), whole)


def is_iso_datetime(text: Column) -> Column:
    """Whether text is an ISO date or date-time."""
    return F.coalesce(iso_datetime(text).isNotNull(), F.lit(False))


def iso_timestamp(value: Column) -> Column:
    """A timestamp as ISO text with the UTC offset; micros only when non-zero."""
    text = F.replace(value.cast("string"), F.lit(" "), F.lit("T"))
    return F.concat(F.when(F.length(text) == 19, text).otherwise(F.rpad(text, 26, "0")), F.lit("+00:00"))


def parse_bookmark(text: Column) -> Column:
    """A bookmark or start date as a timestamp. No zone means UTC."""
    return F.to_timestamp(F.regexp_replace(F.trim(text), "(?i)z$", "+00:00"))
