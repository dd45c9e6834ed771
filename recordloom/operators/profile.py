"""Field profiling: presence, type stability, nesting, uniqueness.

A profile is built in two aggregation steps.  The first groups by (field, value
fingerprint), which spreads even one dominant field over all tasks and collapses repeated
values before the shuffle; the second groups the distinct values by field.  The output of
the first step is itself mergeable across batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.plan import once
from ..functions.values import (
    NESTED_MASK,
    TYPE_BITS,
    column_type_name,
    fingerprint,
    lookup,
    plain_text,
    type_name,
    types_in,
)

UNIQUE_CAP = 100_000
SAMPLE_COUNT = 5
SAMPLE_CHARS = 100


def cells(records: DataFrame, keep: Sequence[str] = ("rec_id",)) -> DataFrame:
    """Records to one row per present field: ``(keep…, key, value, type_name, text)``."""
    exploded = records.select(*keep, F.explode("fields").alias("key", "value"))
    typed = once(exploded, type_name=type_name(F.col("value")))
    return typed.withColumn("text", plain_text(F.col("value"), F.col("type_name")))


def column_cells(df: DataFrame, keep: Sequence[str] = (), columns: Sequence[str] | None = None,
                 null_is_absent: bool = True) -> DataFrame:
    """The same long form from a typed table, without going through JSON."""
    names = list(columns) if columns is not None else [c for c in df.columns if c not in keep]
    parts = []
    for name in names:
        kind = column_type_name(df.schema[name].dataType)
        nested = kind in ("dict", "list")
        text = F.lit(None).cast("string") if nested else F.col(name).cast("string")
        kind_col = F.when(F.col(name).isNull(), F.lit("NoneType")).otherwise(F.lit(kind))
        text = F.when(F.col(name).isNull(), F.lit("None")).otherwise(text)
        parts.append(F.struct(F.lit(name).alias("key"), kind_col.alias("type_name"), text.alias("text")))
    out = df.select(*keep, F.inline(F.array(*parts)))
    return out.filter(F.col("type_name") != "NoneType") if null_is_absent else out


def value_partials(cell_df: DataFrame, by: Sequence[str] = ("key",)) -> DataFrame:
    """First step: ``(by…, fp, n, types)``.  Union and group again to merge batches."""
    return (
        once(cell_df, text=F.col("text"))
        .select(*by, fingerprint(F.col("text")).alias("fp"), lookup(TYPE_BITS, F.col("type_name")).alias("bit"))
        .groupBy(*by, "fp")
        .agg(F.count(F.lit(1)).alias("n"), F.bit_or("bit").alias("types"))
    )


def merge_value_partials(*parts: DataFrame, by: Sequence[str] = ("key",)) -> DataFrame:
    """Accumulate exact partials of several batches."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.groupBy(*by, "fp").agg(F.sum("n").alias("n"), F.bit_or("types").alias("types"))


def sketch_partials(cell_df: DataFrame, by: Sequence[str] = ("key",)) -> DataFrame:
    """Fixed-size mergeable partials: distinct values as an HLL sketch instead of exactly."""
    return cell_df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_or(lookup(TYPE_BITS, F.col("type_name"))).alias("types"),
        F.hll_sketch_agg(fingerprint(F.col("text"))).alias("sketch"),
    )


def merge_sketch_partials(*parts: DataFrame, by: Sequence[str] = ("key",)) -> DataFrame:
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.groupBy(*by).agg(
        F.sum("n").alias("n"), F.bit_or("types").alias("types"), F.hll_union_agg("sketch").alias("sketch")
    )


def field_counts(partials: DataFrame, by: Sequence[str] = ("key",)) -> DataFrame:
    """Second step over either kind of partials: ``(by…, count, types, unique_count)``."""
    if "sketch" in partials.columns:
        return partials.select(
            *by, F.col("n").alias("count"), "types", F.hll_sketch_estimate("sketch").alias("unique_count")
        )
    return partials.groupBy(*by).agg(
        F.sum("n").alias("count"), F.bit_or("types").alias("types"), F.count("fp").alias("unique_count")
    )


def finish_profile(counts: DataFrame, total: Column, keep: Sequence[str] = ("key",),
                   unique_cap: int | None = None) -> DataFrame:
    """Ratios and readable types from field counts; ``total`` is the number of records."""
    unique = F.col("unique_count")
    if unique_cap is not None:
        unique = F.least(unique, F.lit(unique_cap).cast("bigint"))
    return counts.select(
        *[F.col(c).alias("field") if c == "key" else F.col(c) for c in keep],
        "count",
        (F.col("count") / total).alias("frequency_ratio"),
        F.when(F.bit_count("types") == 1, "stable").otherwise("unstable").alias("type_stability"),
        types_in(F.col("types")).alias("detected_type"),
        (F.col("types").bitwiseAND(NESTED_MASK) != 0).alias("is_nested"),
        unique.alias("unique_count"),
        (unique / F.col("count")).alias("unique_ratio"),
    )


def record_total(records: DataFrame) -> Column:
    """Number of records as a scalar subquery; answered from file footers when ``records``
    is a stored table."""
    return records.agg(F.count(F.lit(1))).scalar()


# Key of the one extra cell that stands for the record itself.
RECORD_MARK = "\u0000record"


def _marked(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    mark = F.create_map(F.lit(RECORD_MARK), F.lit(None).cast("variant"))
    return records.select(*keep, F.map_concat("fields", mark).alias("fields"))


def _finish_marked(counts: DataFrame, unique_cap: int | None = None) -> DataFrame:
    """Finish counts in which the record mark gives the total.

    The total is a scalar subquery over the same counts.  It asks for the whole row, so its
    plan equals the main one and Spark reuses the shuffle instead of reading the source twice.
    """
    is_mark = F.col("marks") > 0
    total = counts.filter(is_mark).select(F.struct(*counts.columns)).scalar()["count"]
    fields = counts.filter(~is_mark)
    return finish_profile(fields, total, unique_cap=unique_cap)


def _marked_counts(cell_df: DataFrame, approximate: bool, by: Sequence[str] = ("key",)) -> DataFrame:
    # An aggregate rather than a test of the key, so that filters on it stay above the shuffle.
    marks = F.max((F.col("key") == RECORD_MARK).cast("int")).alias("marks")
    if approximate:
        return cell_df.groupBy(*by).agg(
            F.count(F.lit(1)).alias("count"),
            F.bit_or(lookup(TYPE_BITS, F.col("type_name"))).alias("types"),
            F.hll_sketch_estimate(F.hll_sketch_agg(fingerprint(F.col("text")))).alias("unique_count"),
            marks,
        )
    return value_partials(cell_df, by).groupBy(*by).agg(
        F.sum("n").alias("count"), F.bit_or("types").alias("types"), F.count("fp").alias("unique_count"), marks
    )


def field_profile(records: DataFrame, approximate: bool = False, unique_cap: int | None = None) -> DataFrame:
    """One row per field of a record set, from one scan."""
    return _finish_marked(_marked_counts(cells(_marked(records), keep=()), approximate), unique_cap)


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``field_profile`` of a typed table; NULL counts as absent."""
    partials = value_partials(column_cells(df, columns=columns))
    return finish_profile(field_counts(partials), record_total(df))


def field_profile_capped(records: DataFrame, cap: int = UNIQUE_CAP) -> DataFrame:
    """``field_profile`` whose distinct count stops at ``cap``; the cap is what this report asks for, and
    the counts below it are exact."""
    return field_profile(records, unique_cap=cap)


def sample_values(cell_df: DataFrame, order_col: str = "rec_id", count: int = SAMPLE_COUNT, chars: int = SAMPLE_CHARS) -> DataFrame:
    """The first few distinct scalar values per field in arrival order, shortened for display:
    rows ``(key, rank, sample)``.

    Repeats collapse in each task before the shuffle, and tasks keep no more of a field than
    the ranks asked for (window group limit).
    """
    shown = cell_df.filter(F.col("text").isNotNull()).select(
        "key", F.substring("text", 1, chars).alias("sample"), F.col(order_col).alias("seen")
    )
    firsts = shown.groupBy("key", "sample").agg(F.min("seen").alias("seen"))
    arrival = Window.partitionBy("key").orderBy("seen", "sample")
    ranked = firsts.withColumn("rank", F.row_number().over(arrival))
    return ranked.filter(F.col("rank") <= count).select("key", "rank", "sample")


def sample_lists(samples: DataFrame) -> DataFrame:
    """Sample rows gathered to one list per field (bounded by the sample count)."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", "sample")))
    return samples.groupBy("key").agg(F.transform(ordered, lambda s: s["sample"]).alias("samples"))


def table_profile(rows: DataFrame) -> DataFrame:
    """Field profile per table over shredded rows ``(table, fields)``; ``uuid`` is skipped and
    the denominator is the table's own row count.

    One scan: each row's mark gives the row count, which a window over the table's field
    counts (as many rows as the table has columns) hands to its fields.
    """
    marked = _marked(rows, keep=("table",))
    counts = _marked_counts(cells(marked, keep=("table",)).filter(F.col("key") != "uuid"), False, ("table", "key"))
    total = F.max(F.when(F.col("marks") > 0, F.col("count"))).over(Window.partitionBy("table"))
    fields = counts.withColumn("_rows", total).filter(F.col("marks") == 0)
    return finish_profile(fields, F.col("_rows"), keep=("table", "key"))


def profile_lookup(profile: DataFrame, field: str) -> DataFrame:
    """Profile of one field; empty when the field was never seen."""
    return profile.filter(F.col("field") == field)


def profile_report(profile: DataFrame) -> DataFrame:
    """All fields in name order."""
    return profile.orderBy("field")


def profile_status(records: DataFrame, profile: DataFrame) -> DataFrame:
    """Total records and number of tracked fields."""
    return profile.agg(F.count(F.lit(1)).alias("fields_tracked")).select(
        record_total(records).alias("records_processed"), "fields_tracked"
    )


def schema_changes(old: DataFrame, new: DataFrame, start_version: int = 1) -> DataFrame:
    """History rows between two catalog versions ``(field, target)``: one per added, removed
    or retargeted field, each raising the version by one.

    Numbering runs over catalog rows, which the schema bounds, not over data.
    """
    a = old.select("field", F.col("target").alias("old_target"))
    b = new.select("field", F.col("target").alias("new_target"))
    change = (
        F.when(F.col("old_target").isNull(), "added")
        .when(F.col("new_target").isNull(), "removed")
        .when(F.col("old_target") != F.col("new_target"), "retargeted")
    )
    changed = a.join(b, "field", "full_outer").withColumn("change", change).filter(F.col("change").isNotNull())
    order = Window.partitionBy(F.lit(0)).orderBy("field")
    return changed.withColumn("schema_version", F.row_number().over(order) + F.lit(start_version - 1))
