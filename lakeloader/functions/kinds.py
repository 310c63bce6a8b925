"""Column kinds, how they merge, and their Spark types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The kinds a column can have.
INTEGER, NUMBER, BOOLEAN = "integer", "number", "boolean"
DATE_TIME, DATE, STRING = "date-time", "date", "string"
OBJECT, ARRAY, EMPTY = "object", "array", "empty"
# A column of a hand-edited catalog with several non-null types.
ANY = "any"

# A kind this library adds for integers past 64 bits.
WIDE_INTEGER = "wide-integer"

_SPARK_TYPES: dict[str, T.DataType] = {
    INTEGER: T.LongType(),
    WIDE_INTEGER: T.DecimalType(38, 0),
    NUMBER: T.DoubleType(),
    BOOLEAN: T.BooleanType(),
    OBJECT: T.VariantType(),
    ARRAY: T.VariantType(),
    ANY: T.VariantType(),
}


def spark_type(kind: str) -> T.DataType:
    """The Spark type of a kind. Dates stay ISO text, to keep their offset."""
    return _SPARK_TYPES.get(kind, T.StringType())


def spark_field(name: str, kind: str, nullable: bool = True) -> T.StructField:
    """A schema field; dates and date-times carry their format as metadata."""
    metadata = {"format": kind} if kind in (DATE_TIME, DATE) else {}
    return T.StructField(name, spark_type(kind), nullable, metadata)


def kind_of_type(data_type: T.DataType) -> str:
    """The kind of a scalar Parquet column."""
    if isinstance(data_type, T.BooleanType):
        return BOOLEAN
    if isinstance(data_type, T.IntegralType):
        return INTEGER
    if isinstance(data_type, T.DecimalType):
        # Unsigned 64-bit integers are read as decimal(20,0).
        return INTEGER if (data_type.precision, data_type.scale) == (20, 0) else NUMBER
    if isinstance(data_type, T.FractionalType):
        return NUMBER
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return DATE_TIME
    if isinstance(data_type, T.DateType):
        return DATE
    return STRING


def json_property(kind: str, nullable: bool = True) -> dict:
    """The JSON schema of a kind."""
    base = {WIDE_INTEGER: INTEGER, EMPTY: STRING}.get(kind, kind)
    if base == ANY:
        return {}
    declared = "string" if base in (DATE_TIME, DATE, STRING) else base
    schema: dict = {"type": [declared, "null"] if nullable else [declared]}
    if base in (DATE_TIME, DATE):
        schema["format"] = base
    if kind == WIDE_INTEGER:
        schema["maximum"] = 10**38 - 1
    return schema


def kind_of_property(schema: dict) -> str:
    """The kind a JSON schema property declares."""
    declared = schema.get("type", [])
    types = [declared] if isinstance(declared, str) else list(declared)
    named = [name for name in types if name != "null"]
    if len(named) != 1:
        return ANY
    if named[0] == "string":
        return schema["format"] if schema.get("format") in (DATE_TIME, DATE) else STRING
    if named[0] == INTEGER and schema.get("maximum", 0) > 2**63 - 1:
        return WIDE_INTEGER
    return named[0] if named[0] in (INTEGER, NUMBER, BOOLEAN, OBJECT, ARRAY) else ANY


def merged_kind(kinds: Column) -> Column:
    """Merge an array of distinct kinds into the narrowest that holds all.

    `empty` is the identity, an integer and a number make a number, and any
    other mix is a string. The order never matters, so the kinds can come
    from a `collect_set`, which Spark combines before the shuffle.
    """
    known = F.array_remove(kinds, EMPTY)
    integers = F.array(F.lit(INTEGER), F.lit(WIDE_INTEGER))
    numeric = F.array(F.lit(INTEGER), F.lit(WIDE_INTEGER), F.lit(NUMBER))
    return (
        F.when(F.size(known) == 0, EMPTY)
        .when(F.size(known) == 1, F.element_at(known, 1))
        .when(F.size(F.array_except(known, integers)) == 0, WIDE_INTEGER)
        .when(F.size(F.array_except(known, numeric)) == 0, NUMBER)
        .otherwise(STRING)
    )
