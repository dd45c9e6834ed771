"""Typed reading of dynamic values (VARIANT) and of text literals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

OBJECT = "map<string,variant>"
LIST = "array<variant>"

# Value-type names used in profiles, by leading word of the VARIANT schema.
TYPE_NAMES = {
    "STRING": "str",
    "BIGINT": "int",
    "DECIMAL": "float",
    "DOUBLE": "float",
    "FLOAT": "float",
    "BOOLEAN": "bool",
    "VOID": "NoneType",
    "OBJECT": "dict",
    "ARRAY": "list",
    "TIMESTAMP": "datetime",
    "DATE": "datetime",
}
# One bit per type name, so that a set of types is one integer and merges with bit_or.
TYPE_BITS = {name: 1 << i for i, name in enumerate(dict.fromkeys(TYPE_NAMES.values()))}

NESTED_MASK = TYPE_BITS["dict"] | TYPE_BITS["list"]


def literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def lookup(mapping: dict, key: Column) -> Column:
    return F.try_element_at(literal_map(mapping), key)


def type_name(value: Column) -> Column:
    """Type name of a VARIANT; a SQL NULL (absent) gives NULL."""
    return lookup(TYPE_NAMES, F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0))


def column_type_name(dtype: T.DataType) -> str:
    """Type name of a typed column."""
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return "str"
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, T.IntegralType):
        return "int"
    if isinstance(dtype, T.NumericType):
        return "float"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(dtype, T.ArrayType):
        return "list"
    return "dict"


def is_object(value: Column) -> Column:
    # Read as a struct of no fields, the members are not taken apart just to ask.
    return F.try_variant_get(value, "$", "struct<>").isNotNull()


def as_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", OBJECT)


def as_list(value: Column) -> Column:
    return F.try_variant_get(value, "$", LIST)


def is_object_list(value: Column) -> Column:
    """A non-empty list whose first element is an object (a child table)."""
    return F.try_variant_get(value, "$[0]", "struct<>").isNotNull()


def plain_text(value: Column, kind: Column) -> Column:
    """Text of a scalar as the profile counts it; NULL for lists and objects.

    Null reads ``None``, booleans ``True``/``False``, and a float always shows a point,
    so that ``1`` and ``1.0`` stay two values.
    """
    text = value.cast("string")
    return (
        F.when(kind == "NoneType", F.lit("None"))
        .when(kind == "bool", F.initcap(text))
        .when((kind == "float") & ~text.rlike("[.EIN]"), F.concat(text, F.lit(".0")))
        .when(kind.isin("dict", "list"), F.lit(None).cast("string"))
        .otherwise(text)
    )


def fingerprint(text: Column, plain_limit: int = 64) -> Column:
    """Short stand-in for a text in distinct counts: the text itself while short, else its
    SHA-256, so whole documents are never shuffled just to be counted."""
    return F.when(F.length(text) <= plain_limit, F.concat(F.lit("t"), text)).otherwise(
        F.concat(F.lit("h"), F.sha2(text, 256))
    )


def types_in(mask: Column) -> Column:
    """The single type name held by a type mask, or ``mixed``."""
    return F.when(F.bit_count(mask) == 1, lookup({b: n for n, b in TYPE_BITS.items()}, mask)).otherwise("mixed")


def coerce_literal(text: Column) -> Column:
    """Command-line literal to a VARIANT: quotes are dropped first, then true/false,
    null/none, integer, float, and text are tried in that order."""
    trimmed = F.trim(text)
    quoted = trimmed.rlike("""^(".*"|'.*')$""") & (F.length(trimmed) >= 2)
    bare = F.when(quoted, F.substr(trimmed, F.lit(2), F.length(trimmed) - 2)).otherwise(trimmed)
    word = F.lower(bare)
    whole = bare.try_cast("bigint")
    real = bare.try_cast("double")
    return (
        F.when(bare.isNull(), F.lit(None).cast("variant"))
        .when(word.isin("true", "false"), (word == "true").cast("variant"))
        .when(word.isin("null", "none"), F.parse_json(F.lit("null")))
        .when(whole.isNotNull() & ~bare.rlike("[.]"), whole.cast("variant"))
        .when(real.isNotNull() & ~bare.rlike("[dDfF]$"), real.cast("variant"))
        .otherwise(bare.cast("variant"))
    )


# Store column types and the Spark types that carry them.
STORE_TYPES = {
    "TEXT": "string",
    "VARCHAR(255)": "string",
    "VARCHAR(36)": "string",
    "INT": "bigint",
    "BIGINT": "bigint",
    "FLOAT": "double",
    "BOOLEAN": "boolean",
    "DATETIME": "timestamp",
}


def typed(value: Column, store_type: str) -> Column:
    """A VARIANT read as a store column; a value that does not fit becomes NULL."""
    return F.try_variant_get(value, "$", STORE_TYPES.get(store_type, "string"))


def fits(value: Column, store_type: str) -> Column:
    """Does a store column hold the value as it is?  The kind must be that of the column and the
    typed reading must say the same: ``2.5`` or ``"1"`` do not fit an integer column.  Null fits, as NULL."""
    kind, read = type_name(value), typed(value, store_type)
    spark_type = STORE_TYPES.get(store_type, "string")
    same = {
        "string": kind == "str",
        "boolean": kind == "bool",
        "timestamp": kind.isin("str", "datetime"),
        "bigint": kind == "int",
        # A double holds an integer or a decimal only if it gives it back.
        "double": (kind == "float") & (F.schema_of_variant(value).startswith("DOUBLE") | (read.cast("string") == value.cast("string"))
                                       | (read.cast("decimal(38,18)") == F.try_variant_get(value, "$", "decimal(38,18)")))
                  | (kind == "int") & (F.abs(F.try_variant_get(value, "$", "bigint")) <= 2**53),
    }[spark_type]
    return (kind == "NoneType") | F.coalesce(same & read.isNotNull(), F.lit(False))


def typed_if_fits(value: Column, store_type: str) -> Column:
    """The store column's value; a text column also shows other values as text."""
    read = typed(value, store_type)
    return read if STORE_TYPES.get(store_type, "string") == "string" else F.when(fits(value, store_type), read)


def _as_variant(name: str, dtype: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(dtype, (T.VariantType,)):
        return column
    if isinstance(dtype, (T.StructType, T.MapType, T.ArrayType)):
        return F.to_variant_object(column)
    return column.cast("variant")


def row_fields(schema: T.StructType, names: list[str]) -> Column:
    """Columns of a typed row as record fields; NULL counts as absent."""
    if not names:
        return F.create_map().cast(OBJECT)
    pairs = [x for n in names for x in (F.lit(n), _as_variant(n, schema[n].dataType))]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())
