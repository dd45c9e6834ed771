"""Relational shredding of nested records and their reconstruction."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import walk
from ..functions.naming import singular, snake_case
from ..functions.plan import once
from ..functions.values import (
    as_list,
    as_object,
    is_object_list,
    plain_text,
    row_fields,
    type_name,
    typed,
)
from .levels import split_nodes, table_nodes
from .profile import cells


class Shredded(NamedTuple):
    """Rows of all tables in one long frame, and the M:N tables."""

    rows: DataFrame
    dimensions: DataFrame
    junctions: DataFrame


def shred(records: DataFrame, root: str = "root", depth: int | None = None) -> DataFrame:
    """Records ``(uuid, fields)`` to the rows of all their tables:
    ``(table, uuid, parent_table, parent_id, list_key, pos, depth, fields, rest, names)``.

    No shuffle and no join: level by level (see ``levels``), lists of objects become ``<parent>_<key>`` rows whose id is derived from
    parent, key and position, at all depths or down to ``depth``.  What columns and child rows cannot hold in full stays beside the row
    in ``rest``: lists of other or mixed values, empty lists and objects, members whose column name clashes, and
    lists below ``depth``.  ``names`` maps a column to the member path it came from where that differs, and
    ``list_key`` is the member a child row was an element of.
    """
    nodes = once(split_nodes(records, root, depth), _columns=walk.columns_of(F.col("fields")))
    nodes = once(nodes, _clashes=walk.clashing(F.col("_columns")))
    cut = F.lit(False) if depth is None else F.col("depth") >= depth
    return nodes.select(
        "table", "uuid", "parent_table", "parent_id", "list_key", "pos", "depth",
        walk.row_of(F.col("_columns")).alias("fields"),
        walk.remainder(F.col("fields"), F.col("_columns"), F.col("_clashes"), cut).alias("rest"),
        walk.member_paths(F.col("_columns"), F.col("_clashes")).alias("names"))


def flatten_object(fields: Column) -> Column:
    """One row's columns: nested objects one level deep as ``key_sub``."""
    return walk.flat_fields(fields)


def table_frame(rows: DataFrame, table: str, columns: dict[str, str], parent: str | None = None) -> DataFrame:
    """One typed table from the long frame; ``columns`` maps names to store types."""
    own = rows.filter(F.col("table") == table)
    keys = [F.col("uuid")]
    if parent:
        keys.append(F.col("parent_id").alias(f"{parent}_id"))
        keys.append(F.col("pos"))
    return own.select(*keys, *[typed(F.col("fields")[c], t).alias(c) for c, t in columns.items() if c != "uuid"])


def _scalar_lists(records: DataFrame, entity: str) -> DataFrame:
    """One row per element of each top-level list of scalars."""
    entries = F.filter(
        F.map_entries("fields"),
        lambda e: type_name(F.try_variant_get(e["value"], "$[0]", "variant")).isin("str", "int", "float", "bool"),
    )
    lists = records.select("uuid", F.explode_outer(entries).alias("e")).select(
        "uuid", snake_case(F.col("e.key")).alias("key"), F.posexplode(as_list(F.col("e.value"))).alias("pos", "value")
    )
    return lists.select(
        F.col("uuid").alias("entity_id"),
        F.concat_ws("_", F.lit(entity), F.col("key")).alias("junction"),
        singular(F.col("key")).alias("dimension"),
        "pos",
        F.coalesce(plain_text(F.col("value"), type_name(F.col("value"))), F.to_json("value")).alias("name"),
    )


def _dimension_id() -> Column:
    return F.substring(F.sha2(F.concat_ws("|", "dimension", "name"), 256), 1, 32)


def shred_m2m(records: DataFrame, entity: str = "root") -> tuple[DataFrame, DataFrame]:
    """Top-level lists of scalars to dimension rows ``(dimension, id, name)``, one per
    distinct text over all records, and junction rows ``(junction, entity_id, dimension,
    dimension_id, pos)``, not de-duplicated.

    The dimension id is a digest of its value, so the junction needs no join back.
    """
    elements = _scalar_lists(records, entity)
    dimensions = elements.select("dimension", "name").distinct().withColumn("id", _dimension_id())
    junctions = elements.select("junction", "entity_id", "dimension", _dimension_id().alias("dimension_id"), "pos")
    return dimensions, junctions


def shred_all(records: DataFrame, entity: str = "root") -> Shredded:
    return Shredded(shred(records, entity), *shred_m2m(records, entity))


def structure_map(records: DataFrame, root: str = "root") -> DataFrame:
    """Tables, flattened columns and child tables found anywhere in the records:
    ``(table, column, kind, child_table)`` with kind ``column`` or ``child``."""
    nodes = table_nodes(records, root, False, ids=False).select("table", F.explode("fields").alias("key", "value"))
    key, value = F.col("key"), F.col("value")
    sub = F.transform(F.map_keys(as_object(value)), lambda s: F.concat_ws("_", key, s))
    names = (
        F.when(is_object_list(value), F.array(key))
        .when(as_list(value).isNotNull(), F.array().cast("array<string>"))
        .when(as_object(value).isNotNull(), sub)
        .otherwise(F.array(key))
    )
    kind = F.when(is_object_list(value), "child").otherwise("column")
    found = nodes.select("table", kind.alias("kind"), F.explode(names).alias("column")).distinct()
    return found.select(
        "table", "column", "kind",
        F.when(F.col("kind") == "child", F.concat_ws("_", "table", "column")).alias("child_table"),
    )


def table_catalog(rows: DataFrame) -> DataFrame:
    """Per shredded table and column: store type, the part it plays (``primary_key``,
    ``foreign_key`` with the table it references, or ``column``), and whether it is unique."""
    per_column = cells(rows, keep=("table",)).groupBy("table", "key").agg(F.collect_set("type_name").alias("types"))
    real = F.array_remove("types", "NoneType")

    def only(*kinds: str) -> Column:
        return F.size(F.array_except(real, F.array(*[F.lit(k) for k in kinds]))) == 0

    key, table = F.col("key"), F.col("table")
    col_type = (
        F.when(key.endswith("_id") | (key == "uuid"), "VARCHAR(36)")
        .when(F.size(real) == 0, "VARCHAR(255)")
        .when(only("bool"), "BOOLEAN")
        .when(only("int"), "BIGINT")
        .when(only("int", "float"), "FLOAT")
        .otherwise("VARCHAR(255)")
    )
    is_fk = key.endswith("_id") & (key != F.concat(table, F.lit("_id")))
    columns = per_column.filter(key != "uuid").select(
        "table",
        key.alias("column"),
        col_type.alias("type"),
        F.when(is_fk, "foreign_key").otherwise("column").alias("role"),
        F.when(is_fk, F.regexp_replace("key", "_id$", "")).alias("references"),
        F.lit(False).alias("is_unique"),
    )
    tables = rows.select("table", "parent_table").distinct()
    own = _catalog_row(F.lit("uuid"), "primary_key", None, True)
    parent = _catalog_row(F.concat("parent_table", F.lit("_id")), "foreign_key", F.col("parent_table"), False)
    return columns.unionByName(tables.select("table").distinct().select("table", *own)).unionByName(
        tables.filter(F.col("parent_table").isNotNull()).select("table", *parent)
    )


def _catalog_row(column: Column, role: str, references: Column | None, unique: bool, kind: str = "VARCHAR(36)") -> list[Column]:
    refers = F.lit(None).cast("string") if references is None else references
    return [column.alias("column"), F.lit(kind).alias("type"), F.lit(role).alias("role"), refers.alias("references"),
            F.lit(unique).alias("is_unique")]


def m2m_catalog(dimensions: DataFrame, junctions: DataFrame, entity: str = "root") -> DataFrame:
    """Catalog rows of the M:N tables: a dimension has its id as key and a unique name; a
    junction has both its foreign keys as a composite key."""
    dims = dimensions.select("dimension").distinct()
    own = F.concat("dimension", F.lit("_id"))
    links = junctions.select("junction", "dimension").distinct()
    out = dims.select(F.col("dimension").alias("table"), *_catalog_row(own, "primary_key", None, True))
    out = out.unionByName(dims.select(
        F.col("dimension").alias("table"),
        *_catalog_row(F.concat("dimension", F.lit("_name")), "column", None, True, "VARCHAR(255)")))
    out = out.unionByName(links.select(
        F.col("junction").alias("table"), *_catalog_row(F.lit(f"{entity}_id"), "primary_key", F.lit(entity), False)))
    return out.unionByName(links.select(
        F.col("junction").alias("table"), *_catalog_row(own, "primary_key", F.col("dimension"), False)))


def verify_foreign_keys(tables: dict[str, DataFrame], links: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Per declared link ``(child, fk, parent, key)``: child rows, and rows whose parent is
    missing.  The child is reduced to its distinct keys before the anti join."""
    out = None
    for child, fk, parent, key in links:
        uses = tables[child].groupBy(F.col(fk).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
        known = tables[parent].select(F.col(key).alias("_k")).distinct().withColumn("_hit", F.lit(True))
        row = (
            uses.join(known, "_k", "left")
            .agg(
                F.sum("n").alias("child_rows"),
                F.coalesce(F.sum(F.when(F.col("_hit").isNull() & F.col("_k").isNotNull(), F.col("n"))), F.lit(0))
                .alias("orphans"),
            )
            .select(F.lit(child).alias("child"), F.lit(fk).alias("fk"), F.lit(parent).alias("parent"),
                    "child_rows", "orphans")
        )
        out = row if out is None else out.unionByName(row)
    return out


def child_rows(root: DataFrame, key: str, children: dict[str, tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Children of the root rows as rows ``(key, child, order, data)``, one shape at every size: nothing is
    gathered, so a parent may have any number of them.  ``children`` maps table names to (frame, foreign key, order columns);
    ``order`` is a struct's JSON text of the order columns, ``data`` the child without its foreign key."""
    ids = root.select(key)
    out = None
    for table, (frame, fk, order) in children.items():
        mine = frame.withColumnRenamed(fk, key).join(ids, key, "left_semi")
        payload = [c for c in mine.columns if c != key]
        one = mine.select(key, F.lit(table.removeprefix("root_")).alias("child"),
                          F.to_json(F.struct(*order)).alias("order"), F.to_json(F.struct(*payload)).alias("data"))
        out = one if out is None else out.unionByName(one)
    return out


def child_lists(children: DataFrame, fk: str, name: str, order: Sequence[str]) -> DataFrame:
    """Children gathered per parent as one ordered JSON list ``(fk, n, name)``.

    For callers that ask for lists inside records: a list takes a row, so a parent's children must fit in
    one.  Where they may not, use ``child_rows``.
    """
    payload = [c for c in children.columns if c != fk]
    row = F.struct(*[F.col(c) for c in order], F.to_json(F.struct(*payload)).alias("_json"))
    listed = children.groupBy(fk).agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    texts = F.transform("_rows", lambda r: r["_json"])
    return listed.select(fk, F.size("_rows").alias("n"), F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")).alias(name))


def reconstruct(root: DataFrame, key: str, documents: DataFrame | None = None,
                children: dict[str, DataFrame] | None = None) -> DataFrame:
    """One logical record per root row: structured columns, document fields (which win on a
    clash), and each child as a JSON list named without the ``root_`` prefix.

    ``documents`` is ``(key, doc)``; ``children`` maps table names to the output of
    ``child_lists`` keyed by ``key``; children without a root row are left out.
    """
    base = root.select(key, row_fields(root.schema, [c for c in root.columns if c != key]).alias("_own"))
    if documents is not None:
        # A document per root row: shuffled, never broadcast through the driver.
        base = base.join(documents.select(key, "doc").hint("merge"), key, "left")
        rest = F.map_filter("_own", lambda k, v: ~F.map_contains_key("doc", k))
        base = base.select(
            key, F.when(F.col("doc").isNull(), F.col("_own")).otherwise(F.map_concat(rest, F.col("doc"))).alias("_own")
        )
    names = []
    for table, frame in (children or {}).items():
        names.append(table.removeprefix("root_"))
        base = base.join(frame.select(key, F.col(frame.columns[-1]).alias(names[-1])), key, "left")
    return base.select(
        key, F.to_json(F.to_variant_object("_own")).alias("record"), *[F.coalesce(c, F.lit("[]")).alias(c) for c in names])


def _over(first: Column, second: Column) -> Column:
    """Two maps as one; the second wins."""
    return F.map_concat(F.map_filter(first, lambda k, v: ~F.map_contains_key(second, k)), second)


def rebuild_records(rows: DataFrame, depth: int | None = None) -> DataFrame:
    """Undo ``shred``: ``(uuid, fields)`` with columns back in their members and every child list back in its
    parent, deepest level first, one shuffle per level.

    ``rows`` should be a stored table, as every level reads it.  A record was one row before it was
    shredded, so its lists fit in a row again.
    """
    if depth is None:
        depth = rows.agg(F.max("depth")).first()[0] or 0
    lists = None
    for level in range(depth, -1, -1):
        here = once(rows.filter(F.col("depth") == level), _own=_over(walk.members_of(F.col("fields"), F.col("names")), F.col("rest"))).select(
            walk.packed_id(F.col("uuid")).alias("_id"), walk.packed_id(F.col("parent_id")).alias("_parent"), "list_key", "pos", "_own")
        whole = F.col("_own")
        if lists is not None:
            here = here.join(lists, "_id", "left")
            # A list kept in the remainder is complete; child rows add to it nothing.
            whole = F.when(F.col("_lists").isNull(), whole).otherwise(_over(F.col("_lists"), whole))
        if level == 0:
            return here.select(walk.unpacked_id(F.col("_id")).alias("uuid"), whole.alias("fields"))
        item = F.struct("pos", F.to_json(F.to_variant_object(whole)).alias("json"))
        # Dealt by parent alone, so that both steps and the join above find the rows in place.
        per_list = here.select("_parent", "list_key", item.alias("item")).repartition("_parent").groupBy("_parent", "list_key").agg(
            F.array_join(F.transform(F.sort_array(F.collect_list("item")), lambda r: r["json"]), ",").alias("items"))
        value = F.parse_json(F.concat(F.lit("["), F.col("items"), F.lit("]")))
        lists = per_list.groupBy(F.col("_parent").alias("_id")).agg(
            F.map_from_entries(F.collect_list(F.struct("list_key", value.alias("value")))).alias("_lists"))
    return rows.select("uuid", "fields")


#: Records meet by a hash of their id in so many parts, whatever the number of tasks.
CHECK_PARTS = 65_536


def lossless_check(source: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """Compare source records ``(uuid, fields)`` with rebuilt ones, member by member: per member the records
    that have it on either side, and how many values are on one side only.  One shuffle of a row per record, no join:
    its member names and, end to end, 128 bits of each member's SHA-256.  Records with a like one on the other side
    are settled whole, and only the others are compared by member."""

    def digests(df: DataFrame, side: int) -> DataFrame:
        # VARIANT objects keep their members sorted, so equal values have equal texts.
        text = lambda v: F.concat_ws("|", F.col("uuid"), F.coalesce(F.to_json(F.to_variant_object(F.array(v))), F.lit("")))
        members = F.array_sort(F.transform(F.map_entries("fields"), lambda e: F.struct(
            e["key"].alias("field"), F.substring(F.sha2(text(e["value"]), 256), 1, 32).alias("digest"))))
        packed = once(df.select("uuid", "fields"), members=members)
        return packed.select(
            F.pmod(F.xxhash64("uuid"), F.lit(CHECK_PARTS)).cast("int").alias("part"), F.col("members.field").alias("names"),
            F.unhex(F.array_join("members.digest", "")).alias("digests"), F.lit(side).alias("side"))

    def counted(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy("part", *keys).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))

    # All three steps below group within parts, so the rows stay where this shuffle puts them.
    both = digests(source, 1).unionByName(digests(rebuilt, -1)).repartition("part")
    whole = counted(both.withColumns({"a": (F.col("side") == 1).cast("bigint"), "b": (F.col("side") == -1).cast("bigint")}), "names", "digests")
    # As often on either side adds nothing to a difference: such members need no digest, and make one row a part.
    open_ = F.col("a") != F.col("b")
    members = whole.select("part", "a", "b", F.inline(F.transform("names", lambda n, i: F.struct(
        n.alias("field"), F.when(open_, F.substring(F.col("digests"), i * 16 + 1, F.lit(16))).alias("digest")))))
    return counted(members, "field", "digest").groupBy("field").agg(
        F.sum("a").alias("records_before"), F.sum("b").alias("records_after"),
        F.sum(F.greatest(F.col("a") - F.col("b"), F.lit(0))).alias("missing"),
        F.sum(F.greatest(F.col("b") - F.col("a"), F.lit(0))).alias("extra"),
    )


def describe_table(df: DataFrame) -> DataFrame:
    """Columns, types and observed nullability of a table, in one pass over it."""
    fields = df.schema.fields
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.when(F.col(f"`{f.name}`").isNull(), 1)).alias(f"_n{i}") for i, f in enumerate(fields)],
    )
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
            F.col("_rows").alias("rows"), F.col(f"_n{i}").alias("nulls"), (F.col(f"_n{i}") > 0).alias("nullable"),
        )
        for i, f in enumerate(fields)
    ])
    return counted.select(F.inline(rows))


def table_info(structure: DataFrame, table: str) -> DataFrame:
    """Columns and children of one table in the structure map."""
    return structure.filter(F.col("table") == table)
