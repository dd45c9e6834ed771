"""Rules that turn a field profile into storage decisions, and catalog evolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.naming import COMMON_FIELDS
from ..functions.values import STORE_TYPES, lookup

# Frequency thresholds of the hysteresis band.
LOWER, UPPER = 0.75, 0.85
# Sightings and distinct share needed before a text field counts as unique.
MIN_SIGHTINGS, MIN_UNIQUE_RATIO = 1000, 0.95
# Name parts that mark an identifier when the data proves it unique.
IDENTIFIER_PARTS = ("_id", "uuid", "email", "username", "user_name", "phone", "account", "license",
                    "passport", "ssn", "arn", "sku")
# Name parts that keep a rare field structured in the extended rules.
IDENTIFIER_WORDS = ("phone", "email", "id", "uuid", "account", "license", "passport", "ssn", "arn",
                    "sku", "device_id", "session_id")
# Parent keys that make a column a foreign key.
FOREIGN_KEYS = ("customer_id", "product_id", "order_id")
# Store column type by value type; a unique text is bounded.
COLUMN_TYPES = {"str": "TEXT", "int": "INT", "float": "FLOAT", "bool": "BOOLEAN",
                "NoneType": "VARCHAR(255)", "datetime": "DATETIME"}


def _name_has(parts) -> Column:
    return F.lower("field").rlike("|".join(parts))


def sql_type(kind: Column, unique: Column | None = None) -> Column:
    """Store column type of a value type."""
    base = F.coalesce(lookup(COLUMN_TYPES, kind), F.lit("TEXT"))
    if unique is None:
        return base
    return F.when((kind == "str") & unique, "VARCHAR(255)").otherwise(base)


def is_unique_field(min_sightings: int = MIN_SIGHTINGS) -> Column:
    """Over profile columns: a stable text field, often seen, nearly always distinct and
    named like an identifier."""
    return (
        (F.col("detected_type") == "str")
        & (F.col("type_stability") == "stable")
        & (F.col("count") >= min_sightings)
        & (F.col("unique_ratio") >= MIN_UNIQUE_RATIO)
        & _name_has(IDENTIFIER_PARTS)
    )


def decide_targets(profile: DataFrame, previous: DataFrame | None = None, lower: float = LOWER,
                   upper: float = UPPER, min_sightings: int = MIN_SIGHTINGS) -> DataFrame:
    """Decisions ``(field, target, sql_type, is_unique)``.

    ``previous (field, target)`` adds hysteresis: a field already structured stays so down to
    ``lower``; a new one must reach ``upper``.
    """
    if previous is None:
        known = profile.withColumn("_was", F.lit(None).cast("string"))
    else:
        known = profile.join(previous.select("field", F.col("target").alias("_was")), "field", "left")
    bar = F.when(F.col("_was").isin("SQL", "BOTH"), lower).otherwise(upper)
    target = (
        F.when(F.col("field").isin(*COMMON_FIELDS), "BOTH")
        .when(F.col("is_nested"), "MONGO")
        .when(F.col("detected_type") == "NoneType", "MONGO")
        .when(F.col("type_stability") == "unstable", "MONGO")
        .when(F.col("frequency_ratio") >= bar, "SQL")
        .otherwise("MONGO")
    )
    unique = (F.col("target") == "SQL") & is_unique_field(min_sightings)
    column_type = F.when(F.col("target") != "MONGO", sql_type(F.col("detected_type"), F.col("is_unique")))
    return (
        known.withColumn("target", target)
        .withColumn("is_unique", unique)
        .select("field", "target", column_type.alias("sql_type"), "is_unique")
    )


def classify_extended(profile: DataFrame, lower: float = LOWER, upper: float = UPPER,
                      min_sightings: int = MIN_SIGHTINGS) -> DataFrame:
    """The longer rule list; ``rule`` says which one decided."""
    name, kind, freq = F.col("field"), F.col("detected_type"), F.col("frequency_ratio")
    foreign = _name_has(FOREIGN_KEYS) & name.endswith("_id")
    rule = (
        F.when(name.isin(*COMMON_FIELDS), "common")
        .when(foreign, "foreign_key")
        .when(name == "uuid", "uuid")
        .when(F.col("is_nested"), "nested")
        .when(kind == "NoneType", "all_null")
        .when(F.col("type_stability") == "unstable", "unstable")
        .when(kind.isin("int", "float", "bool"), "number")
        .when(freq >= upper, "frequent")
        .when(freq >= lower, "fairly_frequent")
        .when(_name_has(IDENTIFIER_WORDS), "identifier_name")
        .otherwise("rest")
    )
    r = F.col("rule")
    target = (
        F.when(r == "common", "BOTH")
        .when(r.isin("nested", "all_null", "unstable", "rest"), "MONGO")
        .otherwise("SQL")
    )
    unique = (
        F.when(r == "uuid", True)
        .when(r.isin("frequent", "fairly_frequent"), is_unique_field(min_sightings))
        .when(r == "identifier_name", F.col("unique_ratio") >= MIN_UNIQUE_RATIO)
        .otherwise(False)
    )
    fixed_text = r.isin("foreign_key", "uuid", "identifier_name")
    column_type = F.when(fixed_text, "TEXT").when(F.col("target") != "MONGO", sql_type(kind, F.col("is_unique")))
    return (
        profile.withColumn("rule", rule)
        .withColumn("target", target)
        .withColumn("is_unique", unique)
        .select("field", "target", column_type.alias("sql_type"), "is_unique", "rule")
    )


def detect_drift(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Fields that were structured and are now document fields."""
    gone = previous.filter(F.col("target") == "SQL").select("field")
    return current.filter(F.col("target") == "MONGO").join(gone, "field", "left_semi").select("field")


def migrate_drifted(structured: DataFrame, documents: DataFrame, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """Move drifted columns of the structured table into the documents ``(uuid, doc)``.

    ``fields`` are column names, so the list is bounded by the table's schema.  Values the
    document already holds win; rows without a document get one.
    """
    present = [c for c in fields if c in structured.columns]
    moved_values = F.map_from_entries(
        F.filter(
            F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("variant").alias("value")) for c in present]),
            lambda e: e["value"].isNotNull(),
        )
    ) if present else F.lit(None).cast("map<string,variant>")
    moved = structured.select("uuid", moved_values.alias("_moved")).filter(F.size("_moved") > 0)
    joined = documents.join(moved, "uuid", "full_outer")
    doc = F.coalesce("doc", F.create_map().cast("map<string,variant>"))
    extra = F.map_filter("_moved", lambda k, v: ~F.map_contains_key(doc, k))
    merged = F.when(F.col("_moved").isNull(), doc).otherwise(F.map_concat(doc, extra))
    return structured.drop(*present), joined.select("uuid", merged.alias("doc"))


def evolve_schema(table: DataFrame, decisions: DataFrame) -> DataFrame:
    """Add a column for each newly structured field; old rows hold NULL.

    Only structured decisions are read to the driver: a field needs a presence share of
    at least the lower threshold, so their number is bounded by the record width.
    """
    wanted = decisions.filter(F.col("target") != "MONGO").select("field", "sql_type").collect()
    for row in sorted(wanted):
        if row.field not in table.columns:
            table = table.withColumn(row.field, F.lit(None).cast(STORE_TYPES.get(row.sql_type, "string")))
    return table


def routing_summary(decisions: DataFrame) -> DataFrame:
    """Fields grouped by location, in name order (catalog-sized lists)."""
    return decisions.groupBy("target").agg(
        F.count(F.lit(1)).alias("n_fields"),
        F.array_join(F.sort_array(F.collect_list("field")), ", ").alias("fields"),
    )


def logical_schema(structure: DataFrame, decisions: DataFrame, version: int = 1) -> DataFrame:
    """Entities and their fields with type and route; an unrouted field counts as BOTH."""
    fields = structure.filter(F.col("kind") == "column").select(
        F.col("table").alias("entity"), F.col("column").alias("field")
    )
    return fields.join(decisions.select("field", "target", "sql_type"), "field", "left").select(
        "entity",
        "field",
        F.coalesce("sql_type", F.lit("any")).alias("type"),
        F.coalesce("target", F.lit("BOTH")).alias("routed_to"),
        F.lit(version).alias("schema_version"),
    )
