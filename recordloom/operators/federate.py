"""Reads that join the structured and the document side."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.either_side import matching
from ..functions.plan import let, once
from ..functions.values import type_name
from .route import resolve_references
from .shred import child_lists, reconstruct

# Fields tried in turn as the merge key.
MERGE_KEYS = ("username", "sys_ingested_at", "user_id")


def read_by_id(structured: DataFrame, documents: DataFrame, uuid: str,
               children: dict[str, tuple[DataFrame, str, Sequence[str]]] | None = None,
               side: DataFrame | None = None) -> DataFrame:
    """One logical record by id, with ``status`` ``success`` or ``404``.

    The id reaches every scan as a filter; ``children`` maps a table name to (frame, foreign
    key, order columns).
    """
    docs = documents.filter(F.col("uuid") == uuid)
    if side is not None:
        docs = resolve_references(docs, side, nested=True).documents
    lists = {
        name: child_lists(df.filter(F.col(fk) == uuid).withColumnRenamed(fk, "uuid"), "uuid", name, order)
        for name, (df, fk, order) in (children or {}).items()
    }
    own = structured.filter(F.col("uuid") == uuid)
    found = reconstruct(own, "uuid", docs, lists).withColumn("status", F.lit("success"))
    unknown = own.agg(F.count(F.lit(1))).scalar() == 0
    missing = structured.sparkSession.range(1).filter(unknown).select(F.lit(uuid).alias("uuid"), F.lit("404").alias("status"))
    return found.unionByName(missing, allowMissingColumns=True)


def read_by_filter(structured: DataFrame, condition: Column | dict[str, Any], documents: DataFrame,
                   children: dict[str, tuple[DataFrame, str, Sequence[str]]] | None = None,
                   side: DataFrame | None = None) -> DataFrame:
    """Structured rows that match, each completed with its document and child lists.

    A ``Column`` is tested on the structured side alone and reaches its scan; a filter object finds its fields on either side.
    The other sides are first reduced to the matching ids by semi joins, for which Spark
    broadcasts the ids when they turn out small.
    """
    matched = matching(structured, documents, condition) if isinstance(condition, dict) else structured.filter(condition)
    ids = matched.select("uuid")
    docs = documents.join(ids, "uuid", "left_semi")
    if side is not None:
        docs = resolve_references(docs, side, nested=True).documents
    lists = {}
    for name, (df, fk, order) in (children or {}).items():
        mine = df.withColumnRenamed(fk, "uuid").join(ids, "uuid", "left_semi")
        lists[name] = child_lists(mine, "uuid", name, order)
    return reconstruct(matched, "uuid", docs, lists)


def merge_key(fields: Column, names: Sequence[str] = MERGE_KEYS) -> Column:
    """First of the key fields that holds something: not null, empty, zero or false.  The key keeps its type,
    so the number 5 and the text ``"5"`` differ, while 1 and 1.0 are one number."""

    def usable(name: str) -> Column:
        def text(value: Column) -> Column:
            kind, plain = type_name(value), F.try_variant_get(value, "$", "string")
            number = F.try_variant_get(value, "$", "double")
            whole = F.when(kind == "int", plain).when(
                (number == F.floor(number)) & (F.abs(number) < 2**53), number.cast("bigint").cast("string")).otherwise(plain)
            return (
                F.when((kind == "str") & (plain != ""), F.concat(F.lit("s:"), plain))
                .when(kind.isin("int", "float") & (number != 0), F.concat(F.lit("n:"), whole))
                .when(~kind.isin("str", "int", "float") & ~plain.isin("false", "[]", "{}"), F.concat(F.lit("o:"), plain))
            )

        return let(F.try_element_at(fields, F.lit(name)), text)

    return F.coalesce(*[usable(n) for n in names])


def federated_merge(structured: DataFrame, documents: DataFrame, seq: str = "seq") -> DataFrame:
    """Merge ``fields`` rows of both sides by key: ``(source, merge_key, fields)``.

    A structured row takes the first matching document in ``seq`` order, whose fields win even
    when null; keyed documents without a structured row follow; documents without a key
    only appear when there is no structured row at all.  ``merge_key`` is the key's text.

    The first document of a key is found from keys and positions alone (``min`` in a hash aggregate); whole documents are
    joined once, after that.  Spark splits a crowded key of the structured side.
    """
    left = once(structured.select(F.col("fields").alias("own")), merge_key=merge_key(F.col("own")))
    right = once(documents.select("fields", F.col(seq).alias("_seq")), merge_key=merge_key(F.col("fields")))
    keyed = right.filter(F.col("merge_key").isNotNull())
    at = keyed.groupBy("merge_key").agg(F.min("_seq").alias("_seq"))
    # Rows may share a position; one of them is taken.
    first = keyed.join(at, ["merge_key", "_seq"], "left_semi").dropDuplicates(["merge_key", "_seq"]).select(
        "merge_key", F.col("fields").alias("doc"))
    rest = F.map_filter("own", lambda k, v: ~F.map_contains_key("doc", k))
    merged = left.join(first, "merge_key", "left").select(
        F.when(F.col("doc").isNull(), "structured").otherwise("both").alias("source"),
        "merge_key",
        F.when(F.col("doc").isNull(), F.col("own")).otherwise(F.map_concat(rest, F.col("doc"))).alias("fields"),
    )
    known = left.filter(F.col("merge_key").isNotNull()).select("merge_key").distinct()
    unmatched = keyed.join(known, "merge_key", "left_anti")
    no_rows = structured.limit(1).agg(F.count(F.lit(1))).scalar() == 0
    keyless = right.filter(F.col("merge_key").isNull() & no_rows)
    others = unmatched.select("merge_key", "fields").unionByName(keyless.select("merge_key", "fields"))
    out = merged.unionByName(others.select(F.lit("document").alias("source"), "merge_key", "fields"))
    return out.withColumn("merge_key", F.substring("merge_key", 3, 2**31 - 1))


def enrich(rows: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Every row with its lookup columns, by one join instead of a query per row."""
    return rows.join(lookup, key, "left")


def orphans(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no parent."""
    return rows.join(parents.select(key).distinct(), key, "left_anti")


def exists_check(keys: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Keys that are present in ``rows``."""
    return keys.join(rows.select(key), key, "left_semi")
