"""Recursion over rows: nested values are taken apart level by level until a level is empty.

In ``all_levels`` each level is a table of rows in the shared folder, made from the rows of the level above that have something below
them.  So a job reads only what it takes apart, a record of any size is spread over rows (nothing is gathered in one), and the number of
jobs is the depth of the deepest record, whatever its texts hold.  Every such row still holds all that lies below it, so what is stored
grows with the depth.  Where a row gives its lists away to its child rows, ``split_nodes`` takes a record apart inside its row and stores nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import walk
from ..functions.naming import snake_case
from ..functions.plan import once
from ..functions.values import as_list, as_object, is_object, is_object_list
from ..session import landed

#: Whether a row has something below it; kept beside each row, so the end is found by one flag column.
OPEN = "_open"


def all_levels(first: DataFrame, below: Callable[[DataFrame], DataFrame], purpose: str, depth: int | None = None) -> DataFrame:
    """``first`` and, again and again, what ``below`` makes of the open rows of the last level; down to ``depth`` or to the end."""
    level = landed(first, purpose)
    out, reached = level, 0
    while (depth is None or reached < depth) and not level.filter(OPEN).isEmpty():
        level = landed(below(level.filter(OPEN)), purpose)
        out, reached = out.unionByName(level), reached + 1
    return out.drop(OPEN)


def table_nodes(records: DataFrame, root: str = "root", rename: bool = True, depth: int | None = None, ids: bool = True) -> DataFrame:
    """Every row that records ``(uuid, fields)`` shred into: the root, and one row per object in each list of objects:
    ``(table, uuid, parent_table, parent_id, list_key, pos, depth, fields)``.  Without ``ids`` the rows carry none."""
    none = F.lit(None).cast("string")
    name: Callable[[Column], Column] = snake_case if rename else (lambda c: c)
    top = records.select(
        F.lit(root).alias("table"), (F.col("uuid") if ids else none).alias("uuid"), none.alias("parent_table"), none.alias("parent_id"),
        none.alias("list_key"), F.lit(0).alias("pos"), F.lit(0).alias("depth"), "fields")

    def below(rows: DataFrame) -> DataFrame:
        lists = rows.select(
            F.col("table").alias("parent_table"), F.col("uuid").alias("parent_id"), (F.col("depth") + 1).alias("depth"),
            F.explode(F.filter(F.map_entries("fields"), lambda e: is_object_list(e["value"]))).alias("e"))
        items = lists.select("parent_table", "parent_id", "depth", F.col("e.key").alias("list_key"), F.posexplode(as_list(F.col("e.value"))).alias("pos", "item"))
        key = name(F.col("list_key"))
        return _marked(once(items, fields=as_object(F.col("item"))).filter(F.col("fields").isNotNull()).select(
            F.concat_ws("_", "parent_table", key).alias("table"),
            (walk.child_id(F.col("parent_id"), key, F.col("pos")) if ids else none).alias("uuid"),
            "parent_table", "parent_id", "list_key", "pos", "depth", "fields"), walk.has_child_rows)

    return all_levels(_marked(top, walk.has_child_rows), below, "nodes", depth)


def split_nodes(records: DataFrame, root: str = "root", depth: int | None = None) -> DataFrame:
    """The rows of ``table_nodes``, without the lists that child rows hold in full, so that a record's rows together are about as large
    as the record.  Lists with an element that is no object stay, and so do all lists of rows at ``depth``.

    A level is an array inside the row, and a record takes as many steps as brackets stand inside each other in it (two a level).
    """
    none = F.lit(None).cast("string")
    top = F.struct(F.lit(root).alias("table"), F.col("uuid"), none.alias("parent_table"), none.alias("parent_id"), none.alias("list_key"),
                   F.lit(0).alias("pos"), F.lit(0).alias("depth"), F.col("fields"))
    # The record's own brackets are no level.
    levels = F.when(walk.has_child_rows(F.col("fields")), F.floor((walk.real_depth(F.to_variant_object("fields")) - 1) / 2)).otherwise(0)
    steps = F.greatest(F.lit(0), levels if depth is None else F.least(levels, F.lit(depth))).cast("int")
    counted = once(records.select("uuid", "fields"), _steps=steps)

    # Few lambdas inside each other here: Spark copies what each of them returns.
    def kids(node: Column) -> Column:
        lists = F.transform(F.filter(F.map_entries(node["fields"]), lambda e: is_object_list(e["value"])), lambda e: F.struct(
            e["key"].alias("key"), snake_case(e["key"]).alias("name"), as_list(e["value"]).alias("items")))
        return F.flatten(F.transform(lists, lambda x: F.filter(F.transform(x["items"], lambda item, pos: F.struct(
            F.concat_ws("_", node["table"], x["name"]).alias("table"), walk.child_id(node["uuid"], x["name"], pos).alias("uuid"),
            node["table"].alias("parent_table"), node["uuid"].alias("parent_id"), x["key"].alias("list_key"), pos.alias("pos"),
            (node["depth"] + 1).alias("depth"), as_object(item).alias("fields"))), lambda c: c["fields"].isNotNull())))

    def own(node: Column) -> Column:
        rest = F.map_filter(node["fields"], lambda k, v: ~is_object_list(v) | F.exists(as_list(v), lambda i: ~is_object(i)))
        return F.struct(*[node[c] for c in ("table", "uuid", "parent_table", "parent_id", "list_key", "pos", "depth")], rest.alias("fields"))

    def step(acc: Column, level: Column) -> Column:
        # The last level has no lists to give away, or keeps them.
        return F.when(level == F.col("_steps"), F.struct(F.concat(acc["rows"], acc["open"]).alias("rows"), F.slice(acc["open"], 1, 0).alias("open"))).otherwise(
            F.struct(F.concat(acc["rows"], F.transform(acc["open"], own)).alias("rows"), F.flatten(F.transform(acc["open"], kids)).alias("open")))

    first = F.array(top)
    nodes = F.aggregate(F.sequence(F.lit(0), F.col("_steps")), F.struct(F.slice(first, 1, 0).alias("rows"), first.alias("open")), step, lambda acc: acc["rows"])
    return counted.select(F.inline(nodes))


def object_nodes(records: DataFrame, root: str = "root") -> DataFrame:
    """Every nested object reached through lists of objects and plain objects:
    ``(path, parent, child, level, is_list, fields)``, the record itself at level 0."""
    none = F.lit(None).cast("string")
    top = records.select(F.lit(root).alias("path"), none.alias("parent"), none.alias("child"), F.lit(0).alias("level"),
                         F.lit(False).alias("is_list"), "fields")

    def below(rows: DataFrame) -> DataFrame:
        value = F.col("value")
        members = rows.select("path", F.coalesce("child", F.lit(root)).alias("parent"), "level", F.explode("fields").alias("child", "value"))
        listed = once(members, is_list=F.when(is_object_list(value), True).when(is_object(value), False)).filter(F.col("is_list").isNotNull())
        items = listed.select(F.concat_ws(".", "path", "child").alias("path"), "parent", "child", (F.col("level") + 1).alias("level"), "is_list",
                              F.explode(F.when(F.col("is_list"), as_list(value)).otherwise(F.array(value))).alias("item"))
        return _marked(once(items, fields=as_object(F.col("item"))).filter(F.col("fields").isNotNull()).drop("item"), walk.has_objects)

    return all_levels(_marked(top, walk.has_objects), below, "objects")


def _marked(rows: DataFrame, test: Callable[[Column], Column]) -> DataFrame:
    return once(rows, **{OPEN: test(F.col("fields"))})
