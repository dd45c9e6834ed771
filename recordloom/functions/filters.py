"""Filter objects compiled to Column expressions.

Two semantics: ``structured_filter`` follows SQL (a comparison with NULL drops the row),
``document_filter`` follows document stores (a missing field satisfies ``$ne``, a scalar
equality also matches an element of a list, ranges compare within one type).
"""

from __future__ import annotations

import json
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import as_list, type_name

# The operators each kind of filter accepts, and the size limits.
STRUCTURED_OPS = ("$eq", "$gt", "$gte", "$lt", "$lte", "$ne", "$in")
DOCUMENT_OPS = ("$eq", "$gt", "$gte", "$lt", "$lte", "$in", "$nin", "$ne", "$and", "$or", "$not", "$exists", "$size")
CONDITION_OPS = ("eq", "gt", "gte", "lt", "lte", "in")
MAX_FILTER_DEPTH = 8
MAX_FILTER_LIST = 500

COMPARE = {
    "$gt": lambda c, v: c > v,
    "$gte": lambda c, v: c >= v,
    "$lt": lambda c, v: c < v,
    "$lte": lambda c, v: c <= v,
}


class FilterError(ValueError):
    pass


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def structured_filter(spec: dict[str, Any]) -> Column:
    """AND over fields of a typed table; a bare value means equality, ``{}`` keeps all rows."""
    conditions = []
    for field, test in spec.items():
        column = F.col(f"`{field}`")
        for op, value in (test.items() if isinstance(test, dict) else [("$eq", test)]):
            if op == "$eq":
                conditions.append(column == F.lit(value))
            elif op == "$ne":
                conditions.append(column != F.lit(value))
            elif op == "$in":
                conditions.append(column.isin(*(value if isinstance(value, (list, tuple)) else [value])))
            elif op in COMPARE:
                conditions.append(COMPARE[op](column, F.lit(value)))
            else:
                raise FilterError(f"operator not allowed: {op}")
    return _all(conditions)


def conditions_to_spec(conditions: list[dict[str, Any]]) -> list[dict[str, Any]]:
    """``[{field, op, value}, …]`` to one filter object each, so that none replaces another."""
    for c in conditions:
        if c["op"] not in CONDITION_OPS:
            raise FilterError(f"operator not allowed: {c['op']}")
    return [{c["field"]: {"$" + c["op"]: c["value"]}} for c in conditions]


def filter_conditions(conditions: list[dict[str, Any]], documents: bool = False) -> Column:
    """A list of conditions for either side; all must hold."""
    return _all([(document_filter if documents else structured_filter)(s) for s in conditions_to_spec(conditions)])


def check_filter(spec: Any, depth: int = 0, max_depth: int = MAX_FILTER_DEPTH, max_list: int = MAX_FILTER_LIST) -> None:
    """Refuse unknown operators, and filters nested deeper or with longer lists than allowed."""
    if depth > max_depth:
        raise FilterError("filter is nested too deeply")
    if isinstance(spec, dict):
        for key, value in spec.items():
            if isinstance(key, str) and key.startswith("$") and key not in DOCUMENT_OPS:
                raise FilterError(f"operator not allowed: {key}")
            check_filter(value, depth + 1, max_depth, max_list)
    elif isinstance(spec, (list, tuple)):
        if len(spec) > max_list:
            raise FilterError("list in filter is too long")
        for value in spec:
            check_filter(value, depth + 1, max_depth, max_list)


def document_filter(spec: dict[str, Any], doc: str = "doc", max_depth: int = MAX_FILTER_DEPTH,
                    max_list: int = MAX_FILTER_LIST, stored: bool = False) -> Column:
    """A document filter over a ``MAP<STRING, VARIANT>`` column, or with ``stored`` over a ``VARIANT`` column, of which a scan
    then reads only the fields asked for; dotted names reach into nested objects, also through lists."""
    check_filter(spec, 0, max_depth, max_list)
    conditions = []
    for key, test in spec.items():
        if key == "$and":
            conditions.append(_all([document_filter(s, doc, max_depth, max_list, stored) for s in test]))
        elif key == "$or":
            any_of = F.lit(False)
            for s in test:
                any_of = any_of | document_filter(s, doc, max_depth, max_list, stored)
            conditions.append(any_of)
        elif key.startswith("$"):
            raise FilterError(f"{key} needs a field")
        else:
            conditions.append(_field_test(_values_at(F.col(doc), key, stored), test))
    return _all(conditions)


def _quoted(name: str) -> str:
    return "$['" + name.replace("'", "\\'") + "']"


def field_of(doc: Column, name: str, stored: bool) -> Column:
    """One field of a document, as a ``VARIANT``; SQL NULL where it is missing."""
    return F.try_variant_get(doc, _quoted(name), "variant") if stored else F.try_element_at(doc, F.lit(name))


def _values_at(doc: Column, path: str, stored: bool) -> Column:
    """The values a dotted path reaches, none when it is missing."""
    head, *rest = path.split(".")
    found = F.array_compact(F.array(field_of(doc, head, stored)))
    for part in rest:
        found = F.array_compact(F.flatten(F.transform(found, _member_reader(_quoted(part)))))
    return found


def _member_reader(path: str):
    """Reads a member of an object, or of every object in a list."""

    def read(v: Column) -> Column:
        inner = F.coalesce(as_list(v), F.array(v))
        return F.transform(inner, lambda x: F.try_variant_get(x, path, "variant"))

    return read


def _leaves(values: Column) -> Column:
    """Values and, for lists, also their elements."""
    return F.flatten(
        F.transform(values, lambda v: F.concat(F.array(v), F.coalesce(as_list(v), F.array().cast("array<variant>"))))
    )


def _number_test(value: Column, kind: Column, like: int, compare) -> Column:
    """Compare a number with a whole number by the value's own type: whole numbers as such, decimals at a
    scale that holds their digits, doubles as doubles.  Beyond that scale's range the double decides."""
    right = F.lit(like) if -(2**63) <= like < 2**63 else F.lit(float(like))
    schema = F.schema_of_variant(value)
    scale = F.regexp_extract(schema, r"^DECIMAL\(\d+,\s*(\d+)\)", 1).try_cast("int")
    as_double = compare(F.try_variant_get(value, "$", "double"), F.lit(float(like)))

    def decimal(digits: int) -> Column:
        return F.coalesce(compare(F.try_variant_get(value, "$", f"decimal(38,{digits})"), right), as_double)

    whole = F.coalesce(compare(F.try_variant_get(value, "$", "bigint"), right), as_double)
    exact = F.when(scale <= 9, decimal(9)).when(scale <= 18, decimal(18)).when(scale <= 28, decimal(28)).otherwise(decimal(37))
    return F.when(kind == "int", whole).when(scale.isNotNull(), exact).otherwise(as_double)


def _compared(value: Column, like: Any, compare) -> Column:
    """Compare a dynamic value with ``like``; values of another kind do not match."""
    kind = type_name(value)
    if isinstance(like, bool):
        right_type, hit = kind == "bool", compare(F.try_variant_get(value, "$", "boolean"), F.lit(like))
    elif isinstance(like, int):
        right_type, hit = kind.isin("int", "float"), _number_test(value, kind, like, compare)
    elif isinstance(like, float):
        right_type, hit = kind.isin("int", "float"), compare(F.try_variant_get(value, "$", "double"), F.lit(like))
    elif isinstance(like, (datetime, date)):
        right_type, hit = kind.isin("str", "datetime"), compare(F.try_variant_get(value, "$", "timestamp"), F.lit(like))
    else:
        right_type, hit = kind == "str", compare(F.try_variant_get(value, "$", "string"), F.lit(like))
    return F.coalesce(right_type & hit, F.lit(False))


def _equals(value: Column, like: Any) -> Column:
    if like is None:
        return F.is_variant_null(value)
    if isinstance(like, (dict, list)):
        return F.to_json(value) == F.to_json(F.parse_json(F.lit(json.dumps(like))))
    return _compared(value, like, lambda a, b: a == b)


def _ranged(value: Column, op: str, like: Any) -> Column:
    return _compared(value, like, COMPARE[op])


def equal_value(value: Column, like: Any) -> Column:
    """A dynamic value equals ``like``, or is a list with such an element."""
    return F.exists(_leaves(F.array(value)), lambda v: _equals(v, like))


def compared_value(value: Column, op: str, like: Any) -> Column:
    """A dynamic value, or an element of it, lies on one side of ``like``."""
    return F.exists(_leaves(F.array(value)), lambda v: _ranged(v, op, like))


def _sized(value: Column, op: str, like: int) -> Column:
    return F.coalesce(F.size(as_list(value)) == like, F.lit(False))


def _some(values: Column, test, op: str, like: Any) -> Column:
    return F.exists(values, lambda v: test(v, op, like))


def _matches(values: Column, like: Any) -> Column:
    hit = F.exists(_leaves(values), lambda v: _equals(v, like))
    return (F.size(values) == 0) | hit if like is None else hit


def _field_test(values: Column, test: Any) -> Column:
    if not (isinstance(test, dict) and any(str(k).startswith("$") for k in test)):
        return _matches(values, test)
    parts = []
    for op, like in test.items():
        if op == "$eq":
            parts.append(_matches(values, like))
        elif op == "$ne":
            parts.append(~_matches(values, like))
        elif op in ("$in", "$nin"):
            hit = F.lit(False)
            for one in like if isinstance(like, (list, tuple)) else [like]:
                hit = hit | _matches(values, one)
            parts.append(hit if op == "$in" else ~hit)
        elif op in COMPARE:
            parts.append(_some(_leaves(values), _ranged, op, like))
        elif op == "$not":
            parts.append(~_field_test(values, like))
        elif op == "$exists":
            parts.append((F.size(values) > 0) == F.lit(bool(like)))
        elif op == "$size":
            parts.append(_some(values, _sized, op, like))
        else:
            raise FilterError(f"operator not allowed: {op}")
    return _all(parts)
