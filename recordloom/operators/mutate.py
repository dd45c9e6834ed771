"""Writes as table transforms: each call returns the new state of the tables it touches."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.either_side import matching
from ..functions.values import OBJECT
from .route import route_records


class Changed(NamedTuple):
    structured: DataFrame
    documents: DataFrame
    affected: DataFrame


class Deleted(NamedTuple):
    tables: dict[str, DataFrame]
    counts: DataFrame


def insert_records(structured: DataFrame, documents: DataFrame, records: DataFrame,
                   decisions: DataFrame, default: str = "MONGO") -> tuple[DataFrame, DataFrame]:
    """Append records to both sides by their routing; new columns appear on old rows as NULL.
    ``default`` is the target of fields without a decision."""
    new = route_records(records, decisions, default)
    return (
        structured.unionByName(new.structured, allowMissingColumns=True),
        documents.unionByName(new.documents),
    )


def _tests(spec: dict[str, Any]) -> dict[str, list]:
    """Field -> allowed values; every field must match."""
    if not spec:
        raise ValueError("no filter")
    out = {}
    for field, value in spec.items():
        if isinstance(value, dict):
            if set(value) != {"$in"}:
                raise ValueError("only equality and $in are supported")
            value = value["$in"]
        out[field] = list(value) if isinstance(value, (list, tuple)) else [value]
    return out


def chosen_ids(structured: DataFrame, documents: DataFrame, spec: dict[str, Any]) -> DataFrame:
    """Ids of the records that satisfy all conditions.  Each field is looked up where its value is: in the record's
    document if that has it, else in its column, by the value's own type."""
    checked = {field: {"$in": values} for field, values in _tests(spec).items()}
    return matching(structured, documents, checked).select("uuid").withColumn("_hit", F.lit(True))


def update_where(structured: DataFrame, documents: DataFrame, spec: dict[str, Any], changes: dict[str, Any],
                 routes: dict[str, str], default: str = "MONGO") -> Changed:
    """Set fields on the side or sides they route to, in records chosen by equality or ``$in`` on any fields
    of either side, all of which must hold.

    A changed field has one value afterwards: a value that its column's type would not hold as it is goes to the document, by the
    router's rule, and the column becomes NULL; a value that the column holds takes an older one out of the document.
    A record without a document gets one if it needs it.
    """
    if not changes:
        raise ValueError("no data to update")
    kinds = dict(structured.dtypes)
    left: dict[str, Any] = {}
    right: dict[str, Any] = {}
    for name, value in changes.items():
        route = routes.get(name, default)
        held = route in ("SQL", "BOTH") and (name not in kinds or _holds(kinds[name], value))
        if held:
            left[name] = value
        elif name in kinds:
            left[name] = None
        if route != "SQL" or not held:
            right[name] = value
    ids = chosen_ids(structured, documents, spec)
    updated = structured
    if left:
        hit = F.coalesce(F.col("_hit"), F.lit(False))
        updated = structured.join(ids, "uuid", "left").select(
            *[F.when(hit, F.lit(left[c]).cast(kinds[c])).otherwise(F.col(f"`{c}`")).alias(c) if c in left else F.col(f"`{c}`")
              for c in structured.columns],
            *[F.when(hit, F.lit(v)).alias(k) for k, v in left.items() if k not in kinds])
    new = F.create_map(*[x for k, v in right.items() for x in (F.lit(k), _variant(v))]) if right else F.create_map().cast(OBJECT)
    kept = F.map_filter("doc", lambda k, v: ~k.isin(*changes))
    docs = documents.join(ids, "uuid", "left").select(
        *[F.when(F.col("_hit"), F.map_concat(kept, new)).otherwise(F.col("doc")).alias("doc") if c == "doc" else c
          for c in documents.columns])
    if right:
        bare = ids.join(documents.select("uuid"), "uuid", "left_anti")
        docs = docs.unionByName(bare.select("uuid", new.alias("doc")), allowMissingColumns=True)
    return Changed(updated, docs, ids.agg(F.count(F.lit(1)).alias("affected")))


def _holds(kind: str, value: Any) -> bool:
    """Does a column of this type hold the value as it is?"""
    if value is None:
        return True
    if kind == "boolean":
        return isinstance(value, bool)
    if kind in ("tinyint", "smallint", "int", "bigint"):
        bits = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}[kind]
        return isinstance(value, int) and not isinstance(value, bool) and -(1 << bits) <= value < 1 << bits
    if kind in ("double", "float"):
        return isinstance(value, (int, float)) and not isinstance(value, bool) and float(value) == value
    if kind == "string":
        return isinstance(value, str)
    return True


def delete_ids(tables: dict[str, DataFrame], root: str, documents: DataFrame, spec: dict[str, Any],
               links: Sequence[tuple[str, str, str, str]]) -> Deleted:
    """``delete_where`` by conditions on fields of either side."""
    ids = chosen_ids(tables[root], documents, spec).select("uuid")
    doomed = tables[root].join(ids, "uuid", "left_semi")
    return _cascade(tables, root, doomed, tables[root].join(ids, "uuid", "left_anti"), links)


def _variant(value: Any) -> Column:
    return F.parse_json(F.lit("null")) if value is None else F.lit(value).cast("variant")


def delete_where(tables: dict[str, DataFrame], root: str, condition: Column,
                 links: Sequence[tuple[str, str, str, str]], cascade: bool = True) -> Deleted:
    """Delete matching root rows and all rows that depend on them.

    ``links`` lists ``(child, fk, parent, key)`` parents first, so grandchildren follow their
    parents; document and side collections are children like any other.  Every table loses
    rows by an anti join, and ``counts`` says how many per table.
    """
    kept = tables[root].filter(~F.coalesce(condition, F.lit(False)))
    return _cascade(tables, root, tables[root].filter(condition), kept, links if cascade else [])


def _cascade(tables: dict[str, DataFrame], root: str, gone: DataFrame, left: DataFrame,
             links: Sequence[tuple[str, str, str, str]]) -> Deleted:
    doomed, kept = {root: gone}, {root: left}
    for child, fk, parent, key in links:
        keys = doomed[parent].select(F.col(key).alias(fk)).distinct()
        doomed[child] = tables[child].join(keys, fk, "left_semi")
        kept[child] = tables[child].join(keys, fk, "left_anti")
    counts = None
    for name, rows in doomed.items():
        n = rows.agg(F.count(F.lit(1)).alias("deleted")).select(F.lit(name).alias("table"), "deleted")
        counts = n if counts is None else counts.unionByName(n)
    return Deleted({**tables, **kept}, counts)


def delete_by_id(tables: dict[str, DataFrame], root: str, key: str, value: Any,
                 links: Sequence[tuple[str, str, str, str]]) -> Deleted:
    """``delete_where`` by id; the counts carry ``status`` ``404`` when there is no such row."""
    done = delete_where(tables, root, F.col(key) == F.lit(value), links)
    hits = done.counts.filter(F.col("table") == root).select("deleted").scalar()
    return Deleted(done.tables, done.counts.withColumn("status", F.when(hits > 0, "success").otherwise("404")))


def validate_unique(batch: DataFrame, stored: DataFrame, field: str) -> DataFrame:
    """Batch rows that would break uniqueness of ``field``, with the reason.

    Repeats are found by a count per value (combined before the shuffle), not by a window
    over all rows of a value.
    """
    valued = batch.filter(F.col(field).isNotNull())
    repeated = valued.groupBy(field).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(
        field, F.lit("repeated in batch").alias("reason")
    )
    taken = valued.select(field).distinct().join(stored.select(field), field, "left_semi").select(
        field, F.lit("already stored").alias("reason")
    )
    reasons = repeated.unionByName(taken).groupBy(field).agg(F.min("reason").alias("reason"))
    return valued.join(reasons, field)


def idempotent_append(stored: DataFrame, batch: DataFrame, key: Sequence[str], order_by: str) -> DataFrame:
    """Rows of ``batch`` still to be appended: keys already stored are skipped, and of rows
    that repeat a key the first by ``order_by`` is kept."""
    names = [c for c in batch.columns if c not in key]
    once = batch.groupBy(*key).agg(F.min_by(F.struct(*names), order_by).alias("_row"))
    return once.join(stored.select(*key), list(key), "left_anti").select(*key, "_row.*").select(*batch.columns)
