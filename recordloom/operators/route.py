"""Vertical split of records, decomposition of large documents, and reference resolution.

Splitting and decomposing work inside each row: the routing catalog is small and becomes
literals of the plan, so no cell is exploded, shuffled or pivoted.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.naming import LINK_FIELDS
from ..functions.plan import let, once
from ..functions.values import fits, typed, typed_if_fits
from ..sources.records import to_document

# Decomposition limits and the reference format.
LARGE_DOCUMENT_CHARS = 1024
LARGE_FIELD_SHARE = 0.10
REFERENCE_PREFIX = "REF::MONGO::"
SIDE_PREFIX = "decomposed_"


class Routed(NamedTuple):
    structured: DataFrame
    documents: DataFrame


class Decomposed(NamedTuple):
    documents: DataFrame
    side: DataFrame


class Resolved(NamedTuple):
    """``payloads``: rows (uuid, stub, pos, data) of the references with several payloads that stay stubs."""

    documents: DataFrame
    payloads: DataFrame


def route_records(records: DataFrame, decisions: DataFrame, default: str = "MONGO") -> Routed:
    """Split ``(uuid, fields)`` by decision; link fields go to both sides.

    A field without a decision goes to the documents, or with ``default="SQL"`` becomes a
    text column; it is never dropped.  A value that its column would not hold as it is (a text or a
    fraction for an integer column) stays in the document; the column is NULL, or its text in a text column.  Only structured decisions come to the driver (see
    ``evolve_schema`` for the bound), and with ``default="SQL"`` the names of the columns to add.
    """
    if default not in ("MONGO", "SQL"):
        raise ValueError(f"unknown default target: {default}")
    chosen = {
        r.field: (r.target, r.sql_type)
        for r in decisions.filter(F.col("target") != "MONGO").select("field", "target", "sql_type").collect()
    }
    if default == "SQL":
        names = records.select(F.explode(F.map_keys("fields")).alias("field")).distinct()
        unknown = names.join(decisions.select("field"), "field", "left_anti").collect()
        chosen.update({r.field: ("SQL", "TEXT") for r in unknown})
    link = [c for c in LINK_FIELDS if c != "uuid"]
    link_columns = [typed(F.col("fields")[c], "TEXT").alias(c) for c in link]
    columns = [
        typed_if_fits(F.try_element_at("fields", F.lit(name)), store_type).alias(name)
        for name, (_, store_type) in sorted(chosen.items())
        if name not in LINK_FIELDS
    ]
    by_type: dict[str, list[str]] = {}
    for name, (target, store_type) in sorted(chosen.items()):
        if target == "SQL" and name not in LINK_FIELDS:
            by_type.setdefault(store_type, []).append(name)
    doc = F.col("fields")
    if by_type:
        def left_over(k: Column, v: Column) -> Column:
            stored = F.lit(False)
            for store_type, names in by_type.items():
                stored = stored | (k.isin(*names) & fits(v, store_type))
            return ~stored

        doc = F.map_filter("fields", left_over)
    return Routed(
        records.select("uuid", *link_columns, *columns),
        records.select("uuid", doc.alias("doc")),
    )


def is_reference(text: Column) -> Column:
    return text.startswith(REFERENCE_PREFIX)


def escape(part: Column) -> Column:
    """A name or id with its colons written ``%3A`` (and ``%`` as ``%25``), so that ``::`` only separates."""
    return F.replace(F.replace(part, F.lit("%"), F.lit("%25")), F.lit(":"), F.lit("%3A"))


def unescape(part: Column) -> Column:
    return F.replace(F.replace(part, F.lit("%3A"), F.lit(":")), F.lit("%25"), F.lit("%"))


def stub_reference(field: Column, uuid: Column) -> Column:
    """``REF::MONGO::decomposed_<field>::<uuid>``, colons inside field and uuid escaped."""
    return F.concat(F.lit(REFERENCE_PREFIX + SIDE_PREFIX), escape(field), F.lit("::"), escape(uuid))


def decompose_large(documents: DataFrame, created_at: Column | None = None, mark: bool = False) -> Decomposed:
    """Move big fields of big documents to side collections and leave reference stubs.

    With ``mark`` the documents get a column ``stubs``, the stubs that were left in each: a text of the user's that only looks like one
    is then told apart when references are resolved.

    A document above 1024 characters loses every field above a tenth of its size (so at
    most nine per document); link fields always stay.
    """
    created = F.current_timestamp() if created_at is None else created_at
    sized = once(documents, _size=F.length(to_document(F.col("doc"))))
    big = F.map_keys(
        F.map_filter(
            "doc",
            lambda k, v: ~k.isin(*LINK_FIELDS) & (F.length(F.to_json(v)) > F.col("_size") * LARGE_FIELD_SHARE),
        )
    )
    none = F.array().cast("array<string>")
    split = once(sized, _moved=F.when(F.col("_size") > LARGE_DOCUMENT_CHARS, big).otherwise(none))
    stubbed = F.transform_values(
        "doc",
        lambda k, v: F.when(
            F.array_contains(F.col("_moved"), k), stub_reference(k, F.col("uuid")).cast("variant")
        ).otherwise(v),
    )
    side = split.select("uuid", "doc", F.explode("_moved").alias("_field")).select(
        F.concat(F.lit(SIDE_PREFIX), F.col("_field")).alias("collection"),
        F.col("uuid").alias("parent_uuid"),
        F.to_json(F.col("doc")[F.col("_field")]).alias("data"),
        created.alias("created_at"),
    )
    marks = [F.transform("_moved", lambda k: stub_reference(k, F.col("uuid"))).alias("stubs")] if mark else []
    return Decomposed(split.select("uuid", stubbed.alias("doc"), *marks), side)


# A stub as the whole value of an object member in compact JSON.  Inside a text the quote
# after a colon would be escaped, and list elements follow a bracket or comma, so a match
# is always a member value.
MEMBER_STUB = r':"(REF::MONGO::[^"\\]*)"'


def _payloads(refs: DataFrame, side: DataFrame, unwrap: bool, lists: bool) -> tuple[DataFrame, DataFrame]:
    """Payload text by stub for each document ``(uuid, _found)``, and the payload rows of references
    that hold several and are not asked for as lists."""
    parts = F.split("stub", "::")
    located = once(refs, _parts=parts).filter(F.size("_parts") == 4).select(
        "uuid", "stub", unescape(F.col("_parts")[2]).alias("collection"), unescape(F.col("_parts")[3]).alias("parent_uuid")
    )
    key = ["collection", "parent_uuid"]
    if lists:
        rows = located.join(side.select(*key, "data"), key, "left")
        many = rows.filter(F.lit(False)).select("uuid", "stub", F.lit(0).alias("pos"), "data")
    else:
        # Counted without the payloads, so that none is gathered only to be counted.
        counted = located.join(side.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")), key, "left")
        rows = counted.filter(F.coalesce("_n", F.lit(0)) < 2).join(side.select(*key, "data"), key, "left")
        by_stub = Window.partitionBy("uuid", "stub").orderBy("data")
        many = counted.filter("_n > 1").join(side.select(*key, "data"), key).select(
            "uuid", "stub", (F.row_number().over(by_stub) - 1).alias("pos"), "data")

    def payload(data: Column) -> Column:
        as_list = F.concat(F.lit("["), F.array_join(data, ","), F.lit("]"))
        return F.when(F.size(data) == 1, data[0]).otherwise(as_list) if unwrap else as_list

    def entry(stub: Column) -> Column:
        own = F.filter("_rows", lambda r: (r["stub"] == stub) & r["data"].isNotNull())
        return F.struct(stub.alias("stub"), let(F.transform(own, lambda r: r["data"]), payload).alias("payload"))

    gathered = rows.groupBy("uuid").agg(F.sort_array(F.collect_list(F.struct("stub", "data"))).alias("_rows"))
    stubs = F.array_distinct(F.transform("_rows", lambda r: r["stub"]))
    return gathered.select("uuid", F.map_from_entries(F.transform(stubs, entry)).alias("_found")), many


def resolve_references(documents: DataFrame, side: DataFrame, unwrap: bool = True, nested: bool = False,
                       lists: bool = True) -> Resolved:
    """Put decomposed payloads back in place of their stubs.

    ``unwrap`` writes a single payload as itself, so that decompose and resolve are
    inverse; otherwise every reference becomes a list of payloads, ``[]`` when none is found.
    A malformed stub stays as it is.  If the documents have a column ``stubs`` (see ``decompose_large``), only the stubs listed
    there are references; without it everything that looks like one is.  ``nested`` also resolves stubs inside objects and
    inside objects in lists; payloads are not resolved again and plain texts in lists are
    left alone.

    Several payloads become a list inside their document, all of them; with ``lists=False`` such a
    stub stays and its payloads come as ``payloads`` rows, for references too crowded for one row.
    Documents without a stub skip the joins altogether.
    """
    if nested:
        stubs = F.array_distinct(F.regexp_extract_all(to_document(F.col("doc")), F.lit(MEMBER_STUB), F.lit(1)))
    else:
        # Only a text can begin like a stub: other values read as numbers, words or JSON.
        texts = F.transform(F.map_values("doc"), lambda v: v.cast("string"))
        stubs = F.array_distinct(F.filter(texts, is_reference))
    if "stubs" in documents.columns:
        stubs = F.array_intersect(stubs, F.coalesce("stubs", F.array().cast("array<string>")))
    marked = once(documents, _stubs=stubs)
    plain = marked.filter(F.size("_stubs") == 0).select("uuid", "doc")
    linked = marked.filter(F.size("_stubs") > 0)
    found, many = _payloads(linked.select("uuid", F.explode("_stubs").alias("stub")), side, unwrap, lists)
    joined = linked.join(found, "uuid", "left").withColumn(
        "_found", F.coalesce("_found", F.create_map().cast("map<string,string>"))
    )
    return Resolved(plain.unionByName(joined.select("uuid", _filled(nested).alias("doc"))), many)


def _filled(nested: bool) -> Column:
    if not nested:
        return F.transform_values(
            "doc",
            lambda k, v: F.coalesce(F.parse_json(F.try_element_at("_found", v.cast("string"))), v),
        )
    # Cut the text at every stub and fill all gaps at once, so payload text is never scanned.
    def woven(text: Column) -> Column:
        gaps = F.regexp_extract_all(text, F.lit(MEMBER_STUB), F.lit(1))
        filled = F.transform(
            gaps,
            lambda s: F.concat(
                F.lit(":"),
                F.coalesce(F.try_element_at(F.col("_found"), s), F.concat(F.lit('"'), s, F.lit('"'))),
            ),
        )
        pieces = F.split(text, MEMBER_STUB)
        rest = F.zip_with(filled, F.slice(pieces, F.lit(2), F.size(pieces)), lambda a, b: F.concat(a, b))
        return F.concat(F.element_at(pieces, 1), F.array_join(rest, ""))

    return F.from_json(let(to_document(F.col("doc")), woven), "map<string,variant>")
