"""Expressions over nested values: child rows, columns of a shredded row, and depth."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .naming import snake_case
from .plan import last_wins, let
from .values import as_list, as_object, is_object, is_object_list


def real_depth(value: Column) -> Column:
    """How deep brackets stand inside each other in a value's JSON text; those inside texts do not count.

    Linear in the text: texts go first, then all but brackets, and what is left is counted once.
    """
    outside = F.regexp_replace(F.to_json(value), r'"(?:[^"\\]++|\\.)*+"', "")
    marks = F.split(F.regexp_replace(F.translate(outside, "{}", "[]"), r"[^\[\]]++", ""), "")
    deepest = F.aggregate(
        marks, F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda acc, mark: let(
            acc["now"] + F.when(mark == "[", 1).when(mark == "]", -1).otherwise(0),
            lambda now: F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))),
        lambda acc: acc["most"])
    return F.coalesce(deepest, F.lit(0))


def child_id(parent: Column, key: Column, pos: Column) -> Column:
    """Deterministic id of a child row."""
    return F.substring(F.sha2(F.concat_ws("|", parent, key, pos.cast("string")), 256), 1, 32)


def packed_id(ident: Column) -> Column:
    """An id for a shuffle: 32 hex digits, as ``child_id`` makes them, take 16 bytes; any other text stays as it is.
    The leading byte tells the two apart."""
    return F.when(ident.rlike("^[0-9a-f]{32}$"), F.concat(F.unhex(F.lit("01")), F.unhex(ident))).otherwise(
        F.concat(F.unhex(F.lit("00")), ident.cast("binary")))


def unpacked_id(packed: Column) -> Column:
    """Undo ``packed_id``."""
    ident = F.substring(packed, 2, 1 << 30)
    return F.when(F.substring(packed, 1, 1) == F.unhex(F.lit("01")), F.lower(F.hex(ident))).otherwise(ident.cast("string"))


def has_child_rows(fields: Column) -> Column:
    """Does a record have a list of objects?"""
    return F.coalesce(F.exists(F.map_values(fields), is_object_list), F.lit(False))


def has_objects(fields: Column) -> Column:
    """Does a record have an object or a list of objects?"""
    return F.coalesce(F.exists(F.map_values(fields), lambda v: is_object_list(v) | is_object(v)), F.lit(False))


def columns_of(fields: Column, rename: bool = True) -> Column:
    """Columns of one shredded row as ``(key, path, value)``: scalars as they are, an object one level
    deep as ``key_sub``, lists left out.  ``path`` holds the member names a column came from."""
    name = snake_case if rename else (lambda c: c)

    def made(entry: Column) -> Column:
        own = F.array(F.struct(name(entry["key"]).alias("key"), F.array(entry["key"]).alias("path"), entry["value"].alias("value")))
        sub = F.transform(
            F.map_entries(as_object(entry["value"])),
            lambda s: F.struct(
                F.concat_ws("_", name(entry["key"]), name(s["key"])).alias("key"),
                F.array(entry["key"], s["key"]).alias("path"), s["value"].alias("value"),
            ),
        )
        return F.coalesce(sub, own)

    kept = F.filter(F.map_entries(fields), lambda e: as_list(e["value"]).isNull())
    return F.flatten(F.transform(kept, made))


def row_of(columns: Column) -> Column:
    """Columns ``(key, path, value)`` as a map; the last of a name wins."""
    return last_wins(F.transform(columns, lambda c: F.struct(c["key"], c["value"])))


def flat_fields(fields: Column, rename: bool = True) -> Column:
    """Columns of one shredded row as a map."""
    return row_of(columns_of(fields, rename))


def _repeated(keys: Column) -> Column:
    return F.filter(F.array_distinct(keys), lambda k: F.size(F.filter(keys, lambda x: x == k)) > 1)


def clashing(columns: Column) -> Column:
    """Column names that several members of a row ask for."""

    def found(keys: Column) -> Column:
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.array().cast("array<string>")).otherwise(_repeated(keys))

    return let(F.transform(columns, lambda c: c["key"]), found)


def member_paths(columns: Column, clashes: Column) -> Column:
    """Column -> the member path it came from, where that is not its name; an empty path for a name that clashes."""
    none = F.array().cast("array<string>")
    odd = F.filter(columns, lambda c: (c["path"] != F.array(c["key"])) & ~F.array_contains(clashes, c["key"]))
    return F.map_from_entries(F.concat(
        F.transform(odd, lambda c: F.struct(c["key"].alias("key"), c["path"].alias("path"))),
        F.transform(clashes, lambda k: F.struct(k.alias("key"), none.alias("path")))))


def remainder(fields: Column, columns: Column, clashes: Column, cut: Column) -> Column:
    """Members that columns and child rows do not hold in full: empty lists and objects, lists with an element that
    is no object, members whose column name clashes, and where ``cut``, all lists."""
    members = F.transform(F.filter(columns, lambda c: F.array_contains(clashes, c["key"])), lambda c: c["path"][0])

    def left(key: Column, value: Column) -> Column:
        listed = let(as_list(value), lambda x: cut & x.isNotNull() | F.coalesce(
            (F.size(x) == 0) | F.exists(x, lambda i: as_object(i).isNull()), F.lit(False)))
        return listed | F.coalesce(F.size(as_object(value)) == 0, F.lit(False)) | F.array_contains(members, key)

    return F.map_filter(fields, left)


def members_of(fields: Column, names: Column) -> Column:
    """Undo ``row_of``: members under their first names, objects put together again."""
    items = F.transform(F.map_entries(fields), lambda e: F.struct(
        F.coalesce(F.try_element_at(names, e["key"]), F.array(e["key"])).alias("path"), e["value"].alias("value")))

    def built(all_items: Column) -> Column:
        single = F.transform(F.filter(all_items, lambda e: F.size(e["path"]) == 1), lambda e: F.struct(
            e["path"][0].alias("key"), e["value"].alias("value")))

        def objects(spread: Column) -> Column:
            def whole(key: Column) -> Column:
                own = F.filter(spread, lambda e: e["path"][0] == key)
                inner = F.map_from_entries(F.transform(own, lambda e: F.struct(e["path"][1].alias("key"), e["value"].alias("value"))))
                return F.struct(key.alias("key"), F.to_variant_object(inner).alias("value"))

            return F.transform(F.array_distinct(F.transform(spread, lambda e: e["path"][0])), whole)

        return F.concat(single, let(F.filter(all_items, lambda e: F.size(e["path"]) == 2), objects))

    return F.map_from_entries(let(items, built))


def nesting_depth(value: Column) -> Column:
    """Depth of a value: each object or list adds one; a list is judged by its first element."""

    def inner(v: Column) -> Column:
        as_obj, as_arr = as_object(v), as_list(v)
        return F.coalesce(F.map_values(as_obj), F.slice(as_arr, 1, 1), F.array().cast("array<variant>"))

    grown = F.aggregate(
        F.sequence(F.lit(0), real_depth(value)),
        F.struct(F.array(value).alias("frontier"), F.lit(0).alias("depth")),
        lambda acc, _: let(
            F.flatten(F.transform(acc["frontier"], inner)),
            lambda nxt: F.struct(
                nxt.alias("frontier"), (acc["depth"] + (F.size(nxt) > 0).cast("int")).alias("depth")
            ),
        ),
    )
    return grown["depth"]
