"""Reads over one store: filters, projections, limits, counts."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.either_side import matching
from ..functions.filters import document_filter, field_of, filter_conditions, structured_filter
from ..functions.values import plain_text, type_name

# Row limits of the read calls.
DEFAULT_LIMIT, MAX_LIMIT = 50, 100
REPORT_CAP = 100_000


def filter_rows(df: DataFrame, spec: dict[str, Any]) -> DataFrame:
    """Structured rows that satisfy a filter object; the test is pushed to the scan."""
    return df.filter(structured_filter(spec))


def is_stored(documents: DataFrame) -> bool:
    """Are documents one ``VARIANT`` each, as shredded files hold them, and not maps of fields?"""
    return dict(documents.dtypes)["doc"] == "variant"


def filter_documents(documents: DataFrame, spec: dict[str, Any]) -> DataFrame:
    """Documents that satisfy a filter object.  Of shredded files only the fields of the filter are read."""
    return documents.filter(document_filter(spec, stored=is_stored(documents)))


def filter_by_conditions(df: DataFrame, conditions: list[dict[str, Any]], documents: bool = False) -> DataFrame:
    return df.filter(filter_conditions(conditions, documents))


def filter_records(structured: DataFrame, documents: DataFrame, spec: dict[str, Any]) -> DataFrame:
    """Structured rows of the records that satisfy a filter object, wherever each of its fields has its value."""
    return matching(structured, documents, spec)


def project_fields(df: DataFrame, fields: Sequence[str] | None) -> DataFrame:
    """Requested columns that exist, in request order; all when none are requested."""
    return df.select(*[f for f in fields if f in df.columns]) if fields else df


def project_document_fields(documents: DataFrame, fields: Sequence[str], keep: Sequence[str] = ("uuid",)) -> DataFrame:
    """Requested document fields as text, NULL where a document lacks one.  Of shredded files only these fields are read."""
    stored = is_stored(documents)

    def text(name: str) -> Column:
        value = field_of(F.col("doc"), name, stored)
        kind = type_name(value)
        return F.when(kind.isin("dict", "list"), F.to_json(value)).when(kind != "NoneType", plain_text(value, kind))

    return documents.select(*keep, *[text(f).alias(f) for f in fields])


def read_fields(structured: DataFrame, documents: DataFrame, routes: dict[str, str], fields: Sequence[str],
                order_by: str = "uuid", limit: int | None = None) -> tuple[DataFrame | None, DataFrame | None]:
    """A field list answered by each store that holds some of it: all rows, or if the caller sets a
    ``limit``, the first so many by ``order_by``."""
    unknown = [f for f in fields if f not in routes]
    if unknown:
        raise ValueError(f"unknown fields: {', '.join(unknown)}")
    left = [f for f in fields if routes[f] in ("SQL", "BOTH")]
    right = [f for f in fields if routes[f] in ("MONGO", "BOTH")]
    a = _first(structured, order_by, limit).select(order_by, *[f for f in left if f != order_by]) if left else None
    b = project_document_fields(_first(documents, order_by, limit), [f for f in right if f != order_by],
                                (order_by,)) if right else None
    return a, b


def _first(df: DataFrame, order_by: str, limit: int | None) -> DataFrame:
    return df if limit is None else df.orderBy(order_by).limit(limit)


def list_values(df: DataFrame, field: str, order_by: str, limit: int | None = None) -> DataFrame:
    """Non-null values of one field, of all rows or among the first ``limit``."""
    return _first(df.select(order_by, F.col(field).alias("value")), order_by, limit).filter("value IS NOT NULL")


def distinct_values(df: DataFrame, field: str, limit: int | None = None) -> DataFrame:
    """The distinct values of a field, all or the first ``limit`` in sort order."""
    return _first(df.select(field).distinct(), field, limit)


def count_preview(df: DataFrame, condition: Column | None = None, cap: int = REPORT_CAP) -> DataFrame:
    """Matching rows, reported up to ``cap`` with a flag beyond it."""
    matched = df if condition is None else df.filter(condition)
    n = F.col("n")
    return matched.agg(F.count(F.lit(1)).alias("n")).select(
        F.least(n, F.lit(cap).cast("bigint")).alias("count"),
        (n > cap).alias("truncated"),
        F.when(n <= cap, n).alias("actual_count"),
    )


def count_for_key(df: DataFrame, field: str, value: Any) -> DataFrame:
    return df.filter(F.col(field) == F.lit(value)).agg(F.count(F.lit(1)).alias("rows"))


def clamp_limit(limit: Any, default: int = DEFAULT_LIMIT, highest: int = MAX_LIMIT) -> int:
    """A requested limit kept within 1 and ``highest``; nonsense gives the default."""
    try:
        wanted = int(limit)
    except (TypeError, ValueError):
        wanted = default
    return max(1, min(wanted, highest))


def first_available_table(tables: dict[str, DataFrame], columns: Sequence[str]) -> tuple[str, DataFrame]:
    """The first table, in the given order, that has every requested column."""
    for name, df in tables.items():
        if all(c in df.columns for c in columns):
            return name, df.select(*columns) if columns else df
    raise LookupError(f"no table has the columns {', '.join(columns)}")


def order_rows(df: DataFrame, order_by: str, order: str = "asc") -> DataFrame:
    column = F.col(order_by)
    return df.orderBy(column.desc() if order.lower() == "desc" else column.asc())
