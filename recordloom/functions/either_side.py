"""Conditions on a field whose value may be in a typed column or, where the column does not hold it, in the document.

A record's value of a field is its document's if the document has the field, else the column's.  Conditions follow
``structured_filter``: a field without a value satisfies none.  Values compare by their own type on both sides, so
``"abc"`` and ``2.5`` find the records that have them, though the column is an integer.
"""

from __future__ import annotations

import math
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import STRUCTURED_OPS, FilterError, compared_value, equal_value

WHOLE = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}


def tests_of(spec: dict[str, Any]) -> list[tuple[str, str, Any]]:
    """(field, operator, value) of a filter object; all of them must hold."""
    out = []
    for field, test in spec.items():
        if field.startswith("$"):
            raise FilterError(f"operator not allowed: {field}")
        for op, value in (test.items() if isinstance(test, dict) and any(str(k).startswith("$") for k in test) else [("$eq", test)]):
            if op not in STRUCTURED_OPS:
                raise FilterError(f"operator not allowed: {op}")
            if op == "$in" and not isinstance(value, (list, tuple)):
                value = [value]
            out.append((field, op, value))
    return out


def _whole(column: Column, op: str, like: int | float, bits: int) -> Column:
    """An integer column against any number, as a comparison of integers, which a scan can use."""
    if isinstance(like, float) and not math.isfinite(like):
        always = {"$gt": like < 0, "$gte": like < 0, "$lt": like > 0, "$lte": like > 0}.get(op, False)
        return F.lit(always) & column.isNotNull()
    floor = math.floor(like)
    if op == "$eq":
        return column == F.lit(floor) if floor == like and -(1 << bits) <= floor < 1 << bits else F.lit(False)
    # Above 2.5 is above 2, from 2.5 on is above 2, below 2.5 is up to 2.
    above = op in ("$gt", "$gte")
    strict = op in ("$gt", "$lt") if floor == like else above
    if floor < -(1 << bits):
        return F.lit(above) & column.isNotNull()
    if floor >= 1 << bits:
        return F.lit(not above) & column.isNotNull()
    edge = F.lit(floor)
    return (column > edge if strict else column >= edge) if above else (column < edge if strict else column <= edge)


def _real(column: Column, op: str, like: int | float) -> Column:
    """A double column against any number; one that no double equals lies between two of them."""
    try:
        near = float(like)
    except OverflowError:
        near = math.copysign(math.inf, like)
    if near == like:
        test = {"$eq": column == F.lit(near), "$gt": column > F.lit(near), "$gte": column >= F.lit(near), "$lt": column < F.lit(near),
                "$lte": column <= F.lit(near)}[op]
    elif op == "$eq":
        return F.lit(False)
    elif op in ("$gt", "$gte"):
        test = column >= F.lit(near) if near > like else column > F.lit(near)
    else:
        test = column <= F.lit(near) if near < like else column < F.lit(near)
    return test & ~F.isnan(column)


def _of_column(column: Column, kind: str, op: str, like: Any) -> Column:
    """One comparison with a typed column, by the kind of ``like``; other kinds do not match."""
    simple = {"$eq": lambda c, v: c == v, "$gt": lambda c, v: c > v, "$gte": lambda c, v: c >= v, "$lt": lambda c, v: c < v,
              "$lte": lambda c, v: c <= v}[op]
    if isinstance(like, bool):
        return simple(column, F.lit(like)) if kind == "boolean" else F.lit(False)
    if isinstance(like, (int, float)):
        if kind in WHOLE:
            return _whole(column, op, like, WHOLE[kind])
        if kind in ("double", "float"):
            return _real(column.cast("double"), op, like)
        return simple(column, F.lit(like)) if kind.startswith("decimal") else F.lit(False)
    if isinstance(like, (datetime, date)):
        if kind.startswith(("timestamp", "date")):
            return simple(column, F.lit(like))
        return simple(column.try_cast("timestamp"), F.lit(like)) if kind == "string" else F.lit(False)
    if isinstance(like, str):
        if kind == "string":
            return simple(column, F.lit(like))
        return simple(column, F.lit(like).try_cast("timestamp")) if kind.startswith(("timestamp", "date")) else F.lit(False)
    return F.lit(False)


def column_hit(column: Column, kind: str, op: str, like: Any) -> Column:
    """Whether a typed column satisfies one condition; NULL satisfies none."""
    if op == "$in":
        hit = F.lit(False)
        for one in like:
            hit = hit | _of_column(column, kind, "$eq", one)
    elif op == "$ne":
        hit = column.isNotNull() & ~F.coalesce(_of_column(column, kind, "$eq", like), F.lit(False))
    else:
        hit = _of_column(column, kind, op, like)
    return F.coalesce(hit, F.lit(False))


def document_hit(value: Column, op: str, like: Any) -> Column:
    """Whether a document's value satisfies one condition; a missing one (SQL NULL) satisfies none.  ``None`` equals a null that is there."""
    if op == "$in":
        hit = F.lit(False)
        for one in like:
            hit = hit | equal_value(value, one)
    elif op == "$eq":
        hit = equal_value(value, like)
    elif op == "$ne":
        hit = ~F.is_variant_null(value) & ~equal_value(value, like)
    else:
        hit = compared_value(value, op, like)
    return F.coalesce(value.isNotNull() & hit, F.lit(False))


def matching(structured: DataFrame, documents: DataFrame, spec: dict[str, Any], key: str = "uuid") -> DataFrame:
    """``structured`` rows of the records that satisfy all conditions.

    One scan of either side.  A document counts only where it has a tested field, so what is joined are a key and two flags a field of
    those documents; records whose documents have none of the fields are decided by their columns alone.
    Where the column is filled and the document has the field too, the document decides.
    """
    tests = tests_of(spec)
    if not tests:
        return structured
    kinds = dict(structured.dtypes)
    fields = list(dict.fromkeys(f for f, _, _ in tests))
    has = [F.map_contains_key("doc", f).alias(f"_has{i}") for i, f in enumerate(fields)]
    hits = [document_hit(F.try_element_at("doc", F.lit(f)), op, like).alias(f"_hit{i}") for i, (f, op, like) in enumerate(tests)]
    theirs = documents.select(key, *has, *hits)
    any_has = F.lit(False)
    for i in range(len(fields)):
        any_has = any_has | F.col(f"_has{i}")
    joined = structured.join(theirs.filter(any_has), key, "left")
    keep = F.lit(True)
    for i, (field, op, like) in enumerate(tests):
        own = column_hit(F.col(f"`{field}`"), kinds[field], op, like) if field in kinds else F.lit(False)
        held = F.coalesce(F.col(f"_has{fields.index(field)}"), F.lit(False))
        keep = keep & F.when(held, F.col(f"_hit{i}")).otherwise(own)
    return joined.filter(keep).select(*[F.col(f"`{c}`") for c in structured.columns])
