"""Design analysis: repeating groups, nesting, dependencies, keys, embed or reference.

Every finding looks at all records; per-field results are aggregates whose partial step
runs in each task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import walk
from ..functions.naming import singular
from ..functions.plan import once
from ..functions.values import (
    TYPE_BITS,
    as_list,
    as_object,
    column_type_name,
    fingerprint,
    is_object_list,
    lookup,
    plain_text,
    type_name,
    types_in,
)
from .levels import object_nodes
from .profile import column_cells, record_total, value_partials

# Name parts that make a candidate key the preferred one.
KEY_WORDS = ("email", "username", "code", "id", "identifier", "ssn", "isbn")
# Size, depth, share and length limits of the embed-or-reference rules.
SMALL_OBJECT, LARGE_OBJECT, SHALLOW, HIGH_CARDINALITY = 500, 2000, 2, 0.8
LONG_LIST, LARGE_LIST, MANY_OBJECTS = 1000, 5000, 20
# Highest confidence given to a dependency.
MAX_CONFIDENCE = 0.99


def _entries(records: DataFrame) -> DataFrame:
    return records.select("rec_id", F.explode("fields").alias("key", "value"))


def _lists(records: DataFrame) -> DataFrame:
    return once(_entries(records), items=as_list(F.col("value"))).filter(F.col("items").isNotNull())


def repeating_groups(records: DataFrame) -> DataFrame:
    """List fields: objects make a 1:N group with its attributes, scalars an M:N list with a
    sample of three values from the first record."""
    lists = _lists(records)
    sample = F.transform(F.slice("items", 1, 3), lambda v: plain_text(v, type_name(v)))
    facts = lists.groupBy("key").agg(
        F.count(F.lit(1)).alias("lists"),
        F.avg(F.size("items")).alias("avg_occurrences"),
        F.max(is_object_list(F.col("value"))).alias("has_objects"),
        F.min_by(F.array_join(sample, ", ", "None"), F.when(F.size("items") > 0, F.col("rec_id"))).alias("_sample"),
    )
    attributes = (
        lists.select("key", F.explode_outer(F.array_distinct(F.flatten(F.transform("items", _attribute_names)))).alias("a"))
        .filter(F.col("a").isNotNull())
        .distinct()
        .groupBy("key")
        .agg(F.array_join(F.sort_array(F.collect_list("a")), ", ").alias("_attributes"))
    )
    return facts.join(attributes, "key", "left").select(
        F.col("key").alias("group_name"),
        "lists",
        F.when(F.col("has_objects"), "1:N").otherwise("M:N").alias("cardinality"),
        F.when(F.col("has_objects"), F.col("_attributes")).otherwise(F.concat("key", F.lit("_value"))).alias("attributes"),
        "avg_occurrences",
        F.when(~F.col("has_objects"), F.col("_sample")).alias("values_sample"),
    )


def _attribute_names(item: Column) -> Column:
    return F.coalesce(F.map_keys(as_object(item)), F.array().cast("array<string>"))


def nesting_paths(records: DataFrame) -> DataFrame:
    """Paths of nested lists of objects with level, parent, child and attributes."""
    listed = object_nodes(records).filter("is_list")
    base = listed.groupBy("path", "level", "parent", "child").agg(F.count(F.lit(1)).alias("objects"))
    names = (
        listed.select("path", F.explode(F.map_keys("fields")).alias("a")).distinct().groupBy("path")
        .agg(F.array_join(F.sort_array(F.collect_list("a")), ", ").alias("attributes"))
    )
    return base.join(names, "path", "left")


def deepest_level(paths: DataFrame) -> DataFrame:
    return paths.agg(F.coalesce(F.max("level"), F.lit(0)).alias("deepest_level"), F.count(F.lit(1)).alias("paths"))


def _dependency_verdicts(df: DataFrame, names: Sequence[str], wanted: dict[int, set[int]], mode: str) -> DataFrame:
    """``(x, y, values, rows)`` for wanted pairs that hold over all rows of ``df``.

    Each row is repeated once per determinant, never per pair: a group keeps the least and
    greatest 128-bit digest of the other columns, which merge before the shuffle, and Y
    depends on X when they agree in all groups.
    """
    targets = sorted(set().union(*wanted.values()))
    texts = [F.col(c).cast("string") for c in names]
    digests = []
    for y in targets:
        # NULL is a value of its own, unlike any text.
        null = texts[y].isNull()
        digests += [F.xxhash64(null, texts[y]).alias(f"a{y}"), F.xxhash64(F.lit(y), null, F.reverse(texts[y])).alias(f"b{y}")]
    dets = F.array(*[F.struct(F.lit(x).alias("x"), fingerprint(texts[x]).alias("xv")) for x in sorted(wanted)])
    long = once(df.select(*names), _dets=dets).select(F.inline("_dets"), *digests).filter(F.col("xv").isNotNull())
    spread = []
    for y in targets:
        # A digest is only carried for determinants that still ask for it.
        asked = F.col("x").isin(*[x for x, ys in wanted.items() if y in ys])
        for d in ("a", "b"):
            value = F.when(asked, F.col(f"{d}{y}"))
            spread += [F.min(value).alias(f"l{d}{y}"), F.max(value).alias(f"h{d}{y}")]
    groups = long.groupBy("x", "xv").agg(F.count(F.lit(1)).alias("n"), *spread)
    fold = F.bool_and if mode == "strict" else F.bool_or
    verdict = groups.groupBy("x").agg(
        F.count(F.lit(1)).alias("values"),
        F.sum("n").alias("rows"),
        *[fold((F.col(f"la{y}") == F.col(f"ha{y}")) & (F.col(f"lb{y}") == F.col(f"hb{y}"))).alias(f"d{y}") for y in targets],
    )
    pairs = F.array(*[F.struct(F.lit(y).alias("y"), F.col(f"d{y}").alias("holds")) for y in targets])
    return verdict.select("x", "values", "rows", F.inline(pairs)).filter(F.col("holds") & (F.col("x") != F.col("y"))).drop("holds")


def functional_dependencies(df: DataFrame, columns: Sequence[str] | None = None, mode: str = "strict") -> DataFrame:
    """Dependencies X -> Y between columns: ``(determinant, dependent, values, rows, confidence)``.

    ``strict``: every X value has exactly one Y (NULL is a value of Y); ``any``: some X value does.

    Strict mode settles most pairs by one distinct count per column, over all rows: a column without repeats determines every
    other, a constant is determined by every other, and a column without NULLs never determines one of more values.
    Only the pairs then open go through the full comparison, also over all rows.  What comes to the
    driver are counts, one row per column.
    """
    names = list(columns) if columns is not None else [
        f.name for f in df.schema.fields if column_type_name(f.dataType) not in ("dict", "list")
    ]
    every = {x: {y for y in range(len(names)) if y != x} for x in range(len(names))}
    if mode != "strict":
        found = _dependency_verdicts(df, names, every, mode)
    else:
        counts = {r["field"]: r for r in key_analysis(df, names).collect()}
        facts, wanted = [], {}
        for x, ys in every.items():
            if names[x] not in counts or not counts[names[x]]["unique_count"]:
                continue
            values, nulls = counts[names[x]]["unique_count"], counts[names[x]]["null_count"]
            rows = counts[names[x]]["total_count"] - nulls
            for y in sorted(ys):
                of_y = counts[names[y]]
                distinct = of_y["unique_count"] + (of_y["null_count"] > 0)
                if values == rows or distinct == 1:
                    facts.append((x, y, values, rows))
                elif nulls or values >= distinct:
                    wanted.setdefault(x, set()).add(y)
        found = df.sparkSession.createDataFrame(facts, "x int, y int, values bigint, rows bigint")
        if wanted:
            found = found.unionByName(_dependency_verdicts(df, names, wanted, mode).select("x", "y", "values", "rows"))
    name_of = {i: c for i, c in enumerate(names)}
    return found.select(
        lookup(name_of, F.col("x")).alias("determinant"),
        lookup(name_of, F.col("y")).alias("dependent"),
        F.col("values").alias("num_determinant_values"),
        F.col("rows").alias("num_samples"),
        F.least(F.col("values") / F.col("rows"), F.lit(MAX_CONFIDENCE)).alias("confidence"),
    )


def many_to_many(records: DataFrame) -> DataFrame:
    """Junction table specification of each scalar list field."""
    first = F.col("items")[0]
    scalar = _lists(records).filter(F.size("items") > 0).withColumn("kind", type_name(first)).filter(
        F.col("kind").isin("str", "int", "float", "bool")
    )
    right = singular(F.col("key"))
    return scalar.groupBy("key").agg(
        F.count(F.lit(1)).alias("lists"),
        F.sum(F.size("items")).alias("pairs"),
        types_in(F.bit_or(lookup(TYPE_BITS, F.col("kind")))).alias("value_type"),
    ).select(
        F.col("key").alias("field"),
        right.alias("right_entity"),
        F.concat(right, F.lit("_id")).alias("right_key"),
        F.concat(F.lit("parent_"), F.col("key")).alias("junction_table"),
        F.lit("M:N").alias("cardinality"),
        "value_type", "lists", "pairs",
    )


def key_analysis(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Uniqueness of every scalar column and whether it can be a key."""
    names = [
        f.name for f in df.schema.fields
        if column_type_name(f.dataType) not in ("dict", "list") and (columns is None or f.name in columns)
    ]
    parts = value_partials(column_cells(df, columns=names, null_is_absent=False))
    is_null = F.col("types").bitwiseAND(TYPE_BITS["NoneType"]) != 0
    facts = parts.groupBy("key").agg(
        F.sum("n").alias("total_count"),
        F.coalesce(F.sum(F.when(is_null, F.col("n"))), F.lit(0)).alias("null_count"),
        F.count(F.when(~is_null, 1)).alias("unique_count"),
    )
    return facts.select(
        F.col("key").alias("field"),
        lookup({c: i for i, c in enumerate(names)}, F.col("key")).alias("position"),
        "unique_count", "total_count", "null_count",
        (F.col("unique_count") / F.col("total_count")).alias("uniqueness_ratio"),
        ((F.col("unique_count") == F.col("total_count")) & (F.col("null_count") == 0)).alias("is_candidate"),
    )


def recommend_key(analysis: DataFrame, entity: str) -> DataFrame:
    """The recommended primary key: a candidate with a telling name, else the first
    candidate, else a surrogate."""
    telling = F.lower("field").rlike("|".join(KEY_WORDS))
    rank = F.struct((~telling).alias("plain"), F.col("position"))
    best = analysis.agg(
        F.min_by("field", F.when(F.col("is_candidate"), rank)).alias("_best"),
        F.count(F.when(F.col("is_candidate"), 1)).alias("candidates"),
    )
    found = F.col("candidates") > 0
    return best.select(
        F.lit(entity).alias("entity"),
        F.when(found, F.col("_best")).otherwise(f"{entity}_id").alias("primary_key"),
        F.when(found, "natural").otherwise("surrogate").alias("strategy"),
        "candidates",
    )


def first_normal_form_check(profile: DataFrame) -> DataFrame:
    """Fields that hold lists or objects, with how often."""
    return profile.filter("is_nested").select("field", "count", "detected_type")


def _digested(records: DataFrame, kinds: Sequence[str]) -> DataFrame:
    cells = once(_entries(records), kind=type_name(F.col("value"))).filter(F.col("kind").isin(*kinds))
    return once(cells.filter(~F.col("key").startswith("_")), json=F.to_json("value"))


def embed_or_reference_object(records: DataFrame) -> DataFrame:
    """Embed or reference each object field, by typical size, presence, depth and variety."""
    cells = _digested(records, ["dict"]).select(
        "key", fingerprint(F.col("json")).alias("fp"), F.length("json").alias("size"),
        walk.nesting_depth(F.col("value")).alias("depth"),
    )
    by_value = cells.groupBy("key", "fp").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"), F.max("size").alias("largest"),
        F.max("depth").alias("depth"),
    )
    total = record_total(records)
    facts = by_value.groupBy("key").agg(
        F.sum("n").alias("n"), (F.sum("size") / F.sum("n")).alias("avg_size"), F.max("largest").alias("max_size"),
        F.max("depth").alias("depth"), F.count(F.lit(1)).alias("distinct_values"),
    ).withColumn("in_all", F.col("n") == total).withColumn("cardinality_ratio", F.col("distinct_values") / total)
    decision = (
        F.when((F.col("avg_size") < SMALL_OBJECT) & F.col("in_all") & (F.col("depth") <= SHALLOW), "EMBED")
        .when((F.col("avg_size") > LARGE_OBJECT) | (F.col("cardinality_ratio") > HIGH_CARDINALITY), "REFERENCE")
        .otherwise("EMBED")
    )
    return facts.select(
        F.col("key").alias("field"), decision.alias("decision"), "avg_size", "max_size", "depth",
        F.col("in_all").alias("appears_in_all"), "cardinality_ratio",
    )


def embed_or_reference_array(records: DataFrame) -> DataFrame:
    """Embed or reference each list field, by length, size and content."""
    facts = (
        _lists(records).filter(~F.col("key").startswith("_"))
        .groupBy("key")
        .agg(
            F.max(F.size("items")).alias("max_length"),
            F.avg(F.size("items")).alias("avg_length"),
            F.avg(F.length(F.to_json("value"))).alias("avg_size"),
            F.max(is_object_list(F.col("value"))).alias("contains_objects"),
        )
    )
    decision = (
        F.when(F.col("max_length") > LONG_LIST, "REFERENCE")
        .when(F.col("avg_size") > LARGE_LIST, "REFERENCE")
        .when(F.col("contains_objects") & (F.col("avg_length") > MANY_OBJECTS), "REFERENCE")
        .otherwise("EMBED")
    )
    growth = F.when(F.col("max_length") > 2 * F.col("avg_length"), "unbounded").otherwise("bounded")
    return facts.select(
        F.col("key").alias("field"), decision.alias("decision"), growth.alias("growth_pattern"), "max_length",
        "avg_length", "avg_size", "contains_objects",
    )


def nesting_depths(records: DataFrame) -> DataFrame:
    """Greatest nesting depth of every field."""
    return (
        _entries(records).groupBy("key").agg(F.max(walk.nesting_depth(F.col("value"))).alias("depth"))
        .select(F.col("key").alias("field"), "depth")
    )


def design_report(records: DataFrame, table: DataFrame, entity: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All findings as rows ``(finding, subject, detail)``: nested findings over ``records``,
    dependencies and keys over the typed ``table``."""
    rows = [
        repeating_groups(records).select(
            F.lit("repeating_group").alias("finding"), F.col("group_name").alias("subject"),
            F.concat_ws(" ", "cardinality", "attributes").alias("detail"),
        ),
        nesting_paths(records).select(
            F.lit("nesting").alias("finding"), F.col("path").alias("subject"),
            F.concat(F.lit("level "), F.col("level").cast("string")).alias("detail"),
        ),
        functional_dependencies(table, columns).select(
            F.lit("dependency").alias("finding"), F.col("determinant").alias("subject"),
            F.col("dependent").alias("detail"),
        ),
        many_to_many(records).select(
            F.lit("junction").alias("finding"), F.col("field").alias("subject"),
            F.col("junction_table").alias("detail"),
        ),
        recommend_key(key_analysis(table, columns), entity).select(
            F.lit("primary_key").alias("finding"), F.col("entity").alias("subject"),
            F.concat_ws(" ", "strategy", "primary_key").alias("detail"),
        ),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
