"""Queries over sources, normalisation, profiling and classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.naming import snake_case
from ..functions.values import coerce_literal, type_name
from ..operators import classify as C
from ..operators import profile as P
from ..operators.records import assign_uuid, normalize_keys, stamp_ingest
from ..operators.shred import shred, structure_map
from ..session import work_folder
from ..sources.catalog import load_catalog, save_catalog
from ..sources.records import read_records
from ..sources.tables import (
    document_preview,
    export_results,
    preview_keys,
    store_counts,
    table_preview,
    write_documents,
    write_shredded,
    write_structured,
    write_tables,
)
from . import inputs as I
from .registry import query

ALL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations")


# --- sources and sinks -------------------------------------------------------------------

@query("s1_read_records", f"""
WITH {I.EVENT_SQL}
SELECT event_id AS rec_id, event_type <> 'error' AS accepted,
       CASE WHEN event_type <> 'error' THEN 5 + CAST(event_type = 'view' AS INT) + CAST(NOT (late AND err) AS INT) + 1
       END AS n_fields
FROM ev""")
def s1_read_records(spark, sf):
    raw = I.event_json(I.table(spark, sf, "events"))
    # Error events arrive cut off, so they are malformed.
    broken = F.col("raw").contains('"eventType":"error"')
    cut = raw.withColumn("raw", F.when(broken, F.expr("left(raw, length(raw) - 1)")).otherwise(F.col("raw")))
    parsed = read_records(cut, "raw", "event_id")
    good = parsed.records.select("rec_id", F.lit(True).alias("accepted"), F.size("fields").alias("n_fields"))
    bad = parsed.rejected.select("rec_id", F.lit(False).alias("accepted"), F.lit(None).cast("int").alias("n_fields"))
    return good.unionByName(bad)


@query("s1_read_any_column", f"""WITH {I.EVENT_SQL}
SELECT event_id, event_type, value, late FROM ev""")
def s1_read_any_column(spark, sf):
    """The text may be in a column of any name."""
    lines = I.event_json(I.table(spark, sf, "events")).select("event_id", F.col("raw").alias("value"))
    fields = read_records(lines, "value", "event_id").records
    read = lambda name, kind: F.try_variant_get(F.try_element_at("fields", F.lit(name)), "$", kind)
    return fields.select(F.col("rec_id").alias("event_id"), read("eventType", "string").alias("event_type"), read("value", "double").alias("value"),
                         F.coalesce(read("coupon", "boolean"), F.lit(False)).alias("late"))


@query("s2_stream_records", """
SELECT event_type, COUNT(*) AS events, MIN(event_id) AS first_event, MAX(event_id) AS last_event
FROM events GROUP BY event_type""")
def s2_stream_records(spark, sf):
    base = work_folder(spark, "s2")
    I.event_stream(spark, sf).writeStream.format("parquet").option("path", f"{base}/out").option(
        "checkpointLocation", f"{base}/checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event")
    )


@query("s3_micro_batches", "SELECT COUNT(*) AS rows, COUNT(DISTINCT event_id) AS distinct_events FROM events")
def s3_micro_batches(spark, sf):
    base = work_folder(spark, "s3")

    def step(batch, n):
        batch.select("event_id").write.mode("overwrite").parquet(f"{base}/out/batch_id={n}")

    I.event_stream(spark, sf, files_per_trigger=1).writeStream.foreachBatch(step).option(
        "checkpointLocation", f"{base}/checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("distinct_events")
    )


@query("s4_write_structured", """
SELECT nation, COUNT(*) AS rows, round(SUM(balance), 2) AS balance FROM (
  SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer
  UNION ALL SELECT s_nationkey, s_acctbal FROM supplier) GROUP BY nation""")
def s4_write_structured(spark, sf):
    path = work_folder(spark, "s4")
    customers = I.table(spark, sf, "customer").select(
        F.col("c_name").alias("username"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    # The supplier key is not a column of the stored table, so it stays behind.
    suppliers = I.table(spark, sf, "supplier").select(
        F.col("s_name").alias("username"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"),
        F.col("s_suppkey").alias("supplier_key"))
    write_structured(customers, path)
    write_structured(suppliers, path)
    stored = spark.read.parquet(path)
    return stored.groupBy("nation").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("balance"), 2).alias("balance"))


def _turn_documents(spark, sf):
    return I.table(spark, sf, "conversations").select(
        F.concat(F.lit("turns_"), F.col("role")).alias("collection"),
        F.concat_ws("-", "conv_id", "turn").alias("uuid"),
        F.create_map(
            F.lit("conv_id"), F.col("conv_id").cast("variant"), F.lit("turn"), F.col("turn").cast("variant"),
            F.lit("text"), F.col("text").cast("variant"),
        ).alias("doc"),
    )


@query("s5_write_documents", """
SELECT 'turns_' || role AS collection, COUNT(*) AS documents, CAST(SUM(length(text)) AS BIGINT) AS chars
FROM conversations GROUP BY role""")
def s5_write_documents(spark, sf):
    path = work_folder(spark, "s5")
    write_documents(_turn_documents(spark, sf), path)
    text = F.try_variant_get(F.parse_json("doc"), "$.text", "string")
    return spark.read.parquet(path).groupBy("collection").agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.length(text)).alias("chars"))


@query("s5_write_shredded", """
SELECT 'turns_' || role AS collection, COUNT(*) AS documents, CAST(SUM(length(text)) AS BIGINT) AS chars
FROM conversations GROUP BY role""")
def s5_write_shredded(spark, sf):
    """The same documents as shredded files, and one of their fields."""
    path = work_folder(spark, "s5s")
    write_shredded(_turn_documents(spark, sf), path)
    text = F.try_variant_get("doc", "$.text", "string")
    return spark.read.parquet(path).groupBy("collection").agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.length(text)).alias("chars"))


@query("s6_write_tables", f"""
WITH {I.ORDER_SQL}
SELECT 'root' AS "table", COUNT(*) AS rows, CAST(SUM(cents) AS BIGINT) AS cents, 0 AS orphans FROM o
UNION ALL SELECT 'root_payments', COUNT(*), CAST(SUM(amount) AS BIGINT), 0 FROM pay
UNION ALL SELECT 'root_payments_entries', COUNT(*), CAST(SUM(cents) AS BIGINT), 0 FROM entry""")
def s6_write_tables(spark, sf):
    path = work_folder(spark, "s6")
    write_tables(shred(I.order_records(spark, sf)), path)
    root = spark.read.parquet(f"{path}/root")
    pay = spark.read.parquet(f"{path}/root_payments")
    entry = spark.read.parquet(f"{path}/root_payments_entries")

    def line(name, df, cents, parents=None, fk=None):
        lost = F.lit(0)
        if parents is not None:
            lost = df.join(parents.select(F.col("uuid").alias(fk)), fk, "left_anti").agg(F.count(F.lit(1))).scalar()
        return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(cents).alias("cents")).select(
            F.lit(name).alias("table"), "rows", "cents", lost.cast("int").alias("orphans"))

    return line("root", root, "total_cents").unionByName(
        line("root_payments", pay, "amount_cents", root, "root_id")
    ).unionByName(line("root_payments_entries", entry, "cents", pay, "root_payments_id"))


@query("s7_table_preview", "SELECT * FROM customer ORDER BY c_custkey LIMIT 10")
def s7_table_preview(spark, sf):
    return table_preview(I.table(spark, sf, "customer"), 10, "c_custkey")


@query("s7_document_preview", """
SELECT conv_id || '-' || turn AS uuid, CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, text
FROM conversations ORDER BY 1 LIMIT 10""")
def s7_document_preview(spark, sf):
    docs = _turn_documents(spark, sf)
    return document_preview(docs, sorted(preview_keys(docs, 10)), 10)


@query("s8_store_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", COUNT(*) AS rows FROM {t}" for t in ALL_TABLES))
def s8_store_counts(spark, sf):
    return store_counts({t: I.table(spark, sf, t) for t in ALL_TABLES})


@query("s10_export_results", """
SELECT c_mktsegment AS segment, COUNT(*) AS customers, CAST(COUNT(DISTINCT c_nationkey) AS BIGINT) AS nations
FROM customer GROUP BY c_mktsegment""")
def s10_export_results(spark, sf):
    base = work_folder(spark, "s10")
    result = I.table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("customers"), F.count_distinct("c_nationkey").alias("nations"))
    schema = "segment string, customers bigint, nations bigint"
    export_results(result, f"{base}/text", "text")
    export_results(result, f"{base}/json", "json")
    stored = spark.read.schema(schema).json(f"{base}/json")
    export_results(stored, f"{base}/csv", "csv")
    return spark.read.schema(schema).option("header", True).csv(f"{base}/csv")


# --- normalisation -----------------------------------------------------------------------

@query("n1_snake_case", """
SELECT p_partkey, replace(p_name, ' ', '_') AS from_camel, 'ip_' || lower(p_type) AS from_acronym,
       replace(lower(p_name), ' ', '_') AS from_pascal FROM part""")
def n1_snake_case(spark, sf):
    words = F.split("p_name", " ")
    pascal = F.array_join(F.transform(words, lambda w: F.initcap(w)), "")
    camel = F.concat(F.element_at(words, 1), F.array_join(F.transform(F.slice(words, 2, 10), lambda w: F.initcap(w)), ""))
    return I.table(spark, sf, "part").select(
        "p_partkey", snake_case(camel).alias("from_camel"),
        snake_case(F.concat(F.lit("IP"), F.initcap("p_type"))).alias("from_acronym"),
        snake_case(pascal).alias("from_pascal"),
    )


@query("n2_normalize_keys", """
SELECT o_orderkey AS rec_id, CAST(o_custkey AS VARCHAR) AS order_key, o_orderpriority AS order_priority,
       2 AS n_fields FROM orders""")
def n2_normalize_keys(spark, sf):
    raw = I.table(spark, sf, "orders").select(
        "o_orderkey",
        F.to_json(F.struct(
            F.col("o_orderkey").alias("orderKey"), F.col("o_orderstatus").alias("OrderPriority"),
            F.col("o_custkey").alias("order_key"), F.col("o_orderpriority").alias("orderPriority"),
        )).alias("raw"),
    )
    done = normalize_keys(read_records(raw, "raw", "o_orderkey").records)
    return done.select(
        "rec_id", F.col("fields")["order_key"].cast("string").alias("order_key"),
        F.col("fields")["order_priority"].cast("string").alias("order_priority"), F.size("fields").alias("n_fields"),
    )


@query("n3_stamp_ingest", """
SELECT o_orderkey AS rec_id,
       CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '2024-02-01T00:00:00' END AS sys_ingested_at
FROM orders""")
def n3_stamp_ingest(spark, sf):
    given = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
    raw = I.table(spark, sf, "orders").select(
        "o_orderkey", F.to_json(F.struct(F.col("o_custkey").alias("custKey"), given.alias("sysIngestedAt"))).alias("raw"))
    stamped = stamp_ingest(normalize_keys(read_records(raw, "raw", "o_orderkey").records), "2024-02-01 00:00:00")
    return stamped.select("rec_id", F.col("fields")["sys_ingested_at"].cast("string").alias("sys_ingested_at"))


@query("n4_assign_uuid", """
SELECT o_orderkey AS rec_id,
       CASE WHEN o_orderstatus = 'F' THEN 'o-' || o_orderkey ELSE substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 32) END AS uuid
FROM orders""")
def n4_assign_uuid(spark, sf):
    given = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("o-"), F.col("o_orderkey").cast("string")))
    raw = I.table(spark, sf, "orders").select(
        "o_orderkey", F.to_json(F.struct("o_custkey", given.alias("uuid"))).alias("raw"))
    return assign_uuid(read_records(raw, "raw", "o_orderkey").records).select(
        "rec_id", F.col("fields")["uuid"].cast("string").alias("uuid"))


@query("n5_coerce_literal", """
SELECT o_orderkey,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'bool' WHEN '2' THEN 'NoneType' WHEN '3' THEN 'int' WHEN '4' THEN 'float' ELSE 'str' END AS kind,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'true' WHEN '3' THEN CAST(o_custkey AS VARCHAR) WHEN '5' THEN o_orderstatus || '-5' END AS text
FROM orders""")
def n5_coerce_literal(spark, sf):
    p = F.substring("o_orderpriority", 1, 1)
    literal = (
        F.when(p == "1", "True").when(p == "2", " none ")
        .when(p == "3", F.concat(F.lit('"'), F.col("o_custkey").cast("string"), F.lit('"')))
        .when(p == "4", F.col("o_totalprice").cast("string"))
        .otherwise(F.concat(F.lit("'"), F.col("o_orderstatus"), F.lit("-5'")))
    )
    out = I.table(spark, sf, "orders").select("o_orderkey", coerce_literal(literal).alias("v"))
    kind = type_name(F.col("v"))
    return out.select("o_orderkey", kind.alias("kind"), F.when(~kind.isin("float", "NoneType"), F.col("v").cast("string")).alias("text"))


# --- profiling ---------------------------------------------------------------------------

EVENT_PROFILE = I.rounded(I.profile_sql(I.cells_sql(), "SELECT COUNT(*) FROM ev"))
DOCUMENT_PROFILE = I.profile_sql(I.cells_sql(I.DOCUMENT_FIELDS, "d", "doc_id"), "SELECT COUNT(*) FROM d")


@query("p1_cells", f"WITH {I.EVENT_SQL} {I.cells_sql()}")
def p1_cells(spark, sf):
    return P.cells(I.event_records(spark, sf)).select("rec_id", "key", "type_name", "text")


@query("p2_field_profile", f"WITH {I.EVENT_SQL} {EVENT_PROFILE}")
def p2_field_profile(spark, sf):
    return I.round_profile(P.field_profile(I.event_records(spark, sf)))


@query("p2_document_profile", f"WITH {I.DOCUMENT_SQL} {I.rounded(DOCUMENT_PROFILE)}")
def p2_document_profile(spark, sf):
    return I.round_profile(P.field_profile(I.document_records(spark, sf)))


def _column_sql(table, columns):
    parts = []
    for name, kind in columns:
        parts.append(f"SELECT '{name}' AS key, '{kind}' AS type_name, CAST({name} AS VARCHAR) AS text FROM {table} WHERE {name} IS NOT NULL")
    return I.rounded(I.profile_sql(" UNION ALL ".join(parts), f"SELECT COUNT(*) FROM {table}"))


@query("p2_column_profile", _column_sql("lineitem", [
    ("l_orderkey", "int"), ("l_partkey", "int"), ("l_suppkey", "int"), ("l_linenumber", "int"), ("l_quantity", "float"),
    ("l_extendedprice", "float"), ("l_discount", "float"), ("l_tax", "float"), ("l_returnflag", "str"),
    ("l_linestatus", "str"), ("l_shipdate", "datetime")]))
def p2_column_profile(spark, sf):
    return I.round_profile(P.column_profile(I.spread(I.table(spark, sf, "lineitem"))))


@query("p3_field_profile_capped", f"""WITH {I.DOCUMENT_SQL} {I.rounded(I.profile_sql(
    I.cells_sql(I.DOCUMENT_FIELDS, "d", "doc_id"), "SELECT COUNT(*) FROM d", cap=500))}""")
def p3_field_profile_capped(spark, sf):
    return I.round_profile(P.field_profile_capped(I.document_records(spark, sf), 500))


@query("p4_sample_values", f"""
WITH {I.EVENT_SQL}, s AS (
  SELECT key, substr(text, 1, 100) AS sample, MIN(rec_id) AS seen FROM ({I.cells_sql()}) GROUP BY 1, 2),
r AS (SELECT key, sample, row_number() OVER (PARTITION BY key ORDER BY seen, sample) AS rank FROM s)
SELECT key, CAST(rank AS INT) AS rank, sample FROM r WHERE rank <= 5""")
def p4_sample_values(spark, sf):
    return P.sample_values(P.cells(I.event_records(spark, sf)))


def _row_fields(keys, source):
    return " UNION ALL ".join(
        f"SELECT '{t}' AS tbl, '{k}' AS key, '{ty}' AS type_name, CAST({x} AS VARCHAR) AS text FROM {s}" for t, s, k, ty, x in keys
    )


ORDER_CELLS = _row_fields([
    ("root", "o", "order_key", "int", "o_orderkey"), ("root", "o", "order_status", "str", "o_orderstatus"),
    ("root", "o", "total_cents", "int", "cents"), ("root", "o", "customer_cust_key", "int", "o_custkey"),
    ("root", "o", "customer_order_priority", "str", "o_orderpriority"),
    ("root_payments", "pay", "pay_no", "int", "pay_no"), ("root_payments", "pay", "amount_cents", "int", "amount"),
    ("root_payments_entries", "entry", "entry_code", "str", "entry_code"),
    ("root_payments_entries", "entry", "cents", "int", "cents")], None)


@query("p5_table_profile", f"""
WITH {I.ORDER_SQL}, c AS ({ORDER_CELLS}),
n AS (SELECT 'root' AS tbl, COUNT(*) AS rows FROM o UNION ALL SELECT 'root_payments', COUNT(*) FROM pay
      UNION ALL SELECT 'root_payments_entries', COUNT(*) FROM entry)
SELECT c.tbl AS "table", key AS field, COUNT(*) AS count, round(COUNT(*) / MIN(rows)::DOUBLE, 6) AS frequency_ratio,
  'stable' AS type_stability, MIN(type_name) AS detected_type, false AS is_nested,
  COUNT(DISTINCT text) AS unique_count, round(COUNT(DISTINCT text) / COUNT(*)::DOUBLE, 6) AS unique_ratio
FROM c JOIN n USING (tbl) GROUP BY c.tbl, key""")
def p5_table_profile(spark, sf):
    return I.round_profile(P.table_profile(shred(I.order_records(spark, sf))))


@query("p6_structure_map", """
SELECT t AS "table", c AS "column", k AS kind, CASE WHEN k = 'child' THEN t || '_' || c END AS child_table FROM (VALUES
 ('root','orderKey','column'),('root','orderStatus','column'),('root','totalCents','column'),
 ('root','customer_custKey','column'),('root','customer_orderPriority','column'),('root','payments','child'),
 ('root_payments','payNo','column'),('root_payments','amountCents','column'),('root_payments','entries','child'),
 ('root_payments_entries','entryCode','column'),('root_payments_entries','cents','column')) v(t, c, k)
WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderstatus IN ('F','O'))""")
def p6_structure_map(spark, sf):
    return structure_map(I.order_fields(spark, sf))


@query("p7_merge_profiles", f"WITH {I.EVENT_SQL} {EVENT_PROFILE}")
def p7_merge_profiles(spark, sf):
    early, late = (I.event_records(spark, sf, p) for p in ("early", "late"))
    merged = P.merge_value_partials(P.value_partials(P.cells(early)), P.value_partials(P.cells(late)))
    total = P.record_total(early) + P.record_total(late)
    return I.round_profile(P.finish_profile(P.field_counts(merged), total))


@query("p7_merge_sketches", f"""WITH {I.EVENT_SQL}
SELECT field, count, type_stability, detected_type, true AS near FROM ({EVENT_PROFILE})""")
def p7_merge_sketches(spark, sf):
    early, late = (I.event_records(spark, sf, p) for p in ("early", "late"))
    merged = P.merge_sketch_partials(P.sketch_partials(P.cells(early)), P.sketch_partials(P.cells(late)))
    approx = P.finish_profile(P.field_counts(merged), P.record_total(early) + P.record_total(late))
    exact = P.field_profile(I.event_records(spark, sf)).select("field", F.col("unique_count").alias("exact"))
    near = F.abs(F.col("unique_count") - F.col("exact")) <= F.col("exact") * 0.1
    return approx.join(exact, "field").select("field", "count", "type_stability", "detected_type", near.alias("near"))


@query("p8_profile_lookup", f"WITH {I.EVENT_SQL} SELECT * FROM ({EVENT_PROFILE}) WHERE field = 'k'")
def p8_profile_lookup(spark, sf):
    return P.profile_lookup(I.round_profile(P.field_profile(I.event_records(spark, sf))), "k")


@query("p8_profile_report", f"WITH {I.EVENT_SQL} SELECT * FROM ({EVENT_PROFILE}) ORDER BY field")
def p8_profile_report(spark, sf):
    return P.profile_report(I.round_profile(P.field_profile(I.event_records(spark, sf))))


@query("p8_profile_status", f"""WITH {I.EVENT_SQL}
SELECT (SELECT COUNT(*) FROM ev) AS records_processed, COUNT(*) AS fields_tracked FROM ({EVENT_PROFILE})""")
def p8_profile_status(spark, sf):
    records = I.event_records(spark, sf)
    return P.profile_status(records, P.field_profile(records))


# --- classification ----------------------------------------------------------------------

_UNIQUE = """detected_type = 'str' AND type_stability = 'stable' AND count >= 1000 AND unique_ratio >= 0.95
  AND regexp_matches(lower(field), '_id|uuid|email|username|user_name|phone|account|license|passport|ssn|arn|sku')"""
_TYPE = """CASE detected_type WHEN 'str' THEN 'TEXT' WHEN 'int' THEN 'INT' WHEN 'float' THEN 'FLOAT' WHEN 'bool' THEN 'BOOLEAN'
  WHEN 'NoneType' THEN 'VARCHAR(255)' WHEN 'datetime' THEN 'DATETIME' ELSE 'TEXT' END"""


def decide_sql(profile, bar="0.85"):
    return f"""
    SELECT field, target,
      CASE WHEN target <> 'MONGO' THEN CASE WHEN is_unique THEN 'VARCHAR(255)' ELSE {_TYPE} END END AS sql_type, is_unique
    FROM (SELECT *, target = 'SQL' AND {_UNIQUE} AS is_unique FROM (
      SELECT *, CASE WHEN field IN ('username','timestamp','sys_ingested_at') THEN 'BOTH'
        WHEN is_nested OR detected_type = 'NoneType' OR type_stability = 'unstable' THEN 'MONGO'
        WHEN frequency_ratio >= {bar} THEN 'SQL' ELSE 'MONGO' END AS target FROM ({profile})))"""


def period_profile_sql(period):
    cond = "late" if period == "late" else "NOT late"
    return I.profile_sql(I.cells_sql(source=f"(SELECT * FROM ev WHERE {cond})"), f"SELECT COUNT(*) FROM ev WHERE {cond}")


EARLY = decide_sql(period_profile_sql("early"))
LATE_KEPT = f"""SELECT l.* FROM ({decide_sql(period_profile_sql("late") , bar="0.75")}) l
  JOIN ({EARLY}) e ON e.field = l.field AND e.target = 'SQL'
  UNION ALL SELECT l.* FROM ({decide_sql(period_profile_sql("late"))}) l
  WHERE l.field NOT IN (SELECT field FROM ({EARLY}) WHERE target = 'SQL')"""


def _early(spark, sf):
    return C.decide_targets(P.field_profile(I.event_records(spark, sf, "early")))


def _late(spark, sf):
    return C.decide_targets(P.field_profile(I.event_records(spark, sf, "late")), _early(spark, sf))


@query("c1_decide_targets", f"WITH {I.EVENT_SQL} {decide_sql(I.profile_sql(I.cells_sql(), 'SELECT COUNT(*) FROM ev'))}")
def c1_decide_targets(spark, sf):
    return C.decide_targets(P.field_profile(I.event_records(spark, sf)))


@query("c1_hysteresis", f"WITH {I.EVENT_SQL} {LATE_KEPT}")
def c1_hysteresis(spark, sf):
    return _late(spark, sf)


@query("c1_document_targets", f"WITH {I.DOCUMENT_SQL} {decide_sql(DOCUMENT_PROFILE)}")
def c1_document_targets(spark, sf):
    return C.decide_targets(P.field_profile(I.document_records(spark, sf)))


@query("c2_sql_type", f"""WITH {I.EVENT_SQL}
SELECT field, detected_type, {_TYPE} AS sql_type, CASE WHEN detected_type = 'str' THEN 'VARCHAR(255)' ELSE {_TYPE} END AS unique_sql_type
FROM ({EVENT_PROFILE})""")
def c2_sql_type(spark, sf):
    kind = F.col("detected_type")
    return P.field_profile(I.event_records(spark, sf)).select(
        "field", "detected_type", C.sql_type(kind).alias("sql_type"), C.sql_type(kind, F.lit(True)).alias("unique_sql_type"))


@query("c3_is_unique_field", """
SELECT 'uuid' AS field, COUNT(*) >= 1000 AND COUNT(DISTINCT c_custkey) / COUNT(*)::DOUBLE >= 0.95 AS is_unique FROM customer
UNION ALL SELECT 'username', COUNT(*) >= 1000 AND COUNT(DISTINCT c_name) / COUNT(*)::DOUBLE >= 0.95 FROM customer
UNION ALL SELECT 'segment', false UNION ALL SELECT 'nation', false UNION ALL SELECT 'balance', false""")
def c3_is_unique_field(spark, sf):
    return P.column_profile(I.customer_accounts(spark, sf)).select("field", C.is_unique_field().alias("is_unique"))


@query("c4_classify_extended", f"""WITH {I.DOCUMENT_SQL}, p AS ({DOCUMENT_PROFILE}), r AS (
  SELECT *, CASE WHEN detected_type = 'NoneType' THEN 'all_null' WHEN type_stability = 'unstable' THEN 'unstable'
    WHEN detected_type IN ('int','float','bool') THEN 'number' WHEN frequency_ratio >= 0.85 THEN 'frequent'
    WHEN frequency_ratio >= 0.75 THEN 'fairly_frequent'
    WHEN regexp_matches(field, 'phone|email|id|uuid|account|license|passport|ssn|arn|sku|device_id|session_id') THEN 'identifier_name'
    ELSE 'rest' END AS rule FROM p)
SELECT field, CASE WHEN rule IN ('all_null','unstable','rest') THEN 'MONGO' ELSE 'SQL' END AS target,
  CASE WHEN rule IN ('all_null','unstable','rest') THEN NULL ELSE {_TYPE} END AS sql_type, false AS is_unique, rule FROM r""")
def c4_classify_extended(spark, sf):
    return C.classify_extended(P.field_profile(I.document_records(spark, sf)))


_EXT_EVENTS = f"""
SELECT field, CASE WHEN rule IN ('all_null','unstable','rest') THEN 'MONGO' ELSE 'SQL' END AS target, rule FROM (
 SELECT field, CASE WHEN detected_type = 'NoneType' THEN 'all_null' WHEN type_stability = 'unstable' THEN 'unstable'
   WHEN detected_type IN ('int','float','bool') THEN 'number' WHEN frequency_ratio >= 0.85 THEN 'frequent'
   WHEN frequency_ratio >= 0.75 THEN 'fairly_frequent'
   WHEN regexp_matches(field, 'phone|email|id|uuid|account|license|passport|ssn|arn|sku') THEN 'identifier_name'
   ELSE 'rest' END AS rule FROM ({EVENT_PROFILE}))"""


@query("c4_classify_extended_events", f"WITH {I.EVENT_SQL} {_EXT_EVENTS}")
def c4_classify_extended_events(spark, sf):
    return C.classify_extended(P.field_profile(I.event_records(spark, sf))).select("field", "target", "rule")


@query("c5_detect_drift", f"""WITH {I.EVENT_SQL} SELECT field FROM ({LATE_KEPT}) WHERE target = 'MONGO'
  AND field IN (SELECT field FROM ({EARLY}) WHERE target = 'SQL')""")
def c5_detect_drift(spark, sf):
    return C.detect_drift(_early(spark, sf), _late(spark, sf))


@query("c6_migrate_drifted", """
SELECT CAST(c_custkey AS VARCHAR) AS uuid, CASE WHEN c_acctbal > 0 THEN 'doc' ELSE c_mktsegment END AS segment,
       CAST(c_nationkey AS BIGINT) AS nation, 3 AS columns_left FROM customer""")
def c6_migrate_drifted(spark, sf):
    accounts = I.customer_accounts(spark, sf)
    # Customers in credit already have a document, which holds a segment of its own.
    docs = accounts.filter("balance > 0").select(
        "uuid", F.create_map(F.lit("segment"), F.lit("doc").cast("variant")).alias("doc"))
    left, moved = C.migrate_drifted(accounts, docs, ["segment", "nation"])
    return moved.select(
        "uuid", F.col("doc")["segment"].cast("string").alias("segment"), F.col("doc")["nation"].cast("bigint").alias("nation"),
        F.lit(len(left.columns)).alias("columns_left"))


@query("c7_evolve_schema", f"""WITH {I.EVENT_SQL}
SELECT event_id, user_id, CAST(NULL AS VARCHAR) AS event_type, CAST(NULL AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS ref,
  CAST(NULL AS VARCHAR) AS legacy, CAST(NULL AS BIGINT) AS k FROM events""")
def c7_evolve_schema(spark, sf):
    return C.evolve_schema(I.table(spark, sf, "events").select("event_id", "user_id"), _early(spark, sf))


@query("c8_routing_summary", f"""WITH {I.DOCUMENT_SQL}
SELECT target, COUNT(*) AS n_fields, string_agg(field, ', ' ORDER BY field) AS fields FROM ({decide_sql(DOCUMENT_PROFILE)}) GROUP BY target""")
def c8_routing_summary(spark, sf):
    return C.routing_summary(c1_document_targets(spark, sf))


@query("c9_logical_schema", f"""
SELECT t AS entity, c AS field, y AS type, r AS routed_to, 1 AS schema_version FROM (VALUES
 ('root','orderKey','INT','SQL'),('root','orderStatus','TEXT','SQL'),('root','totalCents','INT','SQL'),
 ('root','customer_custKey','any','BOTH'),('root','customer_orderPriority','any','BOTH'),
 ('root_payments','payNo','any','BOTH'),('root_payments','amountCents','any','BOTH'),
 ('root_payments_entries','entryCode','any','BOTH'),('root_payments_entries','cents','any','BOTH')) v(t, c, y, r)
WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'F')""")
def c9_logical_schema(spark, sf):
    records = I.order_fields(spark, sf)
    return C.logical_schema(structure_map(records), C.decide_targets(P.field_profile(records)))


@query("p9_schema_changes", f"""WITH {I.EVENT_SQL}, a AS ({EARLY}), b AS ({LATE_KEPT}),
c AS (SELECT field, a.target AS old_target, b.target AS new_target, CASE WHEN a.target IS NULL THEN 'added'
   WHEN b.target IS NULL THEN 'removed' WHEN a.target <> b.target THEN 'retargeted' END AS change
   FROM a FULL JOIN b USING (field))
SELECT field, old_target, new_target, change, CAST(row_number() OVER (ORDER BY field) AS INT) AS schema_version
FROM c WHERE change IS NOT NULL""")
def p9_schema_changes(spark, sf):
    return P.schema_changes(_early(spark, sf), _late(spark, sf))


@query("s9_catalog", f"WITH {I.EVENT_SQL} SELECT field, target, sql_type, is_unique FROM ({LATE_KEPT})")
def s9_catalog(spark, sf):
    base = work_folder(spark, "s9")
    save_catalog({"decisions": _early(spark, sf)}, base, 1)
    before = load_catalog(spark, base)["decisions"]
    late = I.event_records(spark, sf, "late")
    profile = P.field_profile(late)
    save_catalog({"profile": profile, "decisions": C.decide_targets(profile, before)}, base, 2)
    return load_catalog(spark, base)["decisions"]
