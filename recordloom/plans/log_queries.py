"""Queries over operational logs and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import oplog as T
from ..operators.profile import field_profile
from ..operators.route import resolve_references
from ..session import work_folder
from ..streaming.ingest import (
    adaptive_ingest,
    current_view,
    ingest_batch,
    read_documents,
    read_side,
    read_structured,
    running_profile,
    stream_profile,
    stream_running_profile,
    streamed_profile,
)
from ..streaming.sessions import once_per_key, stream_sessions
from . import inputs as I
from .ingest_queries import EVENT_PROFILE
from .registry import query


def _log(spark, sf):
    """Events as a call log: type, user, duration in ms, time."""
    return I.table(spark, sf, "events").select(
        "event_id", "user_id", "ts", F.col("event_type").alias("operation"), (F.col("value") * 10).alias("duration_ms"))


_LOG = "log AS (SELECT event_id, user_id, ts, event_type AS operation, value * 10 AS duration_ms FROM events)"


def _stats_sql(key="operation"):
    return f"""
SELECT operation, COUNT(*) AS count, round(SUM(d), 3) AS total_ms, round(AVG(d), 6) AS avg_ms, MIN(d) AS min_ms, MAX(d) AS max_ms,
  list_sort(list(d))[CAST(floor(COUNT(*) * 0.50) AS BIGINT) + 1] AS p50_ms,
  list_sort(list(d))[CAST(floor(COUNT(*) * 0.95) AS BIGINT) + 1] AS p95_ms,
  list_sort(list(d))[CAST(floor(COUNT(*) * 0.99) AS BIGINT) + 1] AS p99_ms
FROM (SELECT {key} AS operation, duration_ms AS d FROM log) GROUP BY operation"""


def _rounded(stats):
    return stats.withColumn("total_ms", F.round("total_ms", 3)).withColumn("avg_ms", F.round("avg_ms", 6))


@query("t1_latency_stats", f"WITH {_LOG} {_stats_sql()}")
def t1_latency_stats(spark, sf):
    return _rounded(T.latency_stats(_log(spark, sf), "operation", "duration_ms"))


@query("t1_latency_stats_two_levels", f"WITH {_LOG} {_stats_sql()}")
def t1_latency_stats_two_levels(spark, sf):
    return _rounded(T.latency_stats(_log(spark, sf), "operation", "duration_ms", steps=4, bound=200))


@query("t2_slow_operations", f"WITH {_LOG} SELECT event_id, operation, duration_ms FROM log WHERE duration_ms > 1000")
def t2_slow_operations(spark, sf):
    return T.slow_operations(_log(spark, sf), "duration_ms").select("event_id", "operation", "duration_ms")


@query("t3_error_split", f"WITH {_LOG} " + _stats_sql("CASE WHEN duration_ms > 2000 THEN operation || '_ERROR' ELSE operation END"))
def t3_error_split(spark, sf):
    split = T.error_split(_log(spark, sf), "operation", F.col("duration_ms") > 2000)
    return _rounded(T.latency_stats(split, "operation", "duration_ms"))


@query("t4_active_sessions", f"""WITH {_LOG}, now AS (SELECT MAX(ts) AS t FROM log),
s AS (SELECT user_id, MIN(ts) AS first_seen, MAX(ts) AS last_seen, arg_max(operation, ts) AS operation,
        arg_max(floor(epoch(ts)) + CAST(floor(duration_ms) AS BIGINT), ts) AS exp FROM log GROUP BY user_id)
SELECT user_id, first_seen, last_seen, operation, CAST(GREATEST(exp - floor(epoch(t)), 0) AS BIGINT) AS expires_in_sec
FROM s, now WHERE floor(epoch(t)) - floor(epoch(last_seen)) <= 7200""")
def t4_active_sessions(spark, sf):
    log = _log(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    now = log.agg(F.max("ts")).scalar()
    expiry = F.unix_timestamp("ts") + F.floor("duration_ms")
    live = T.active_sessions(log, "user_id", "ts", now, ["operation"], expiry)
    return live.withColumn("first_seen", F.col("first_seen").cast("timestamp_ntz")).withColumn(
        "last_seen", F.col("last_seen").cast("timestamp_ntz"))


@query("t5_recent_entries", f"""WITH {_LOG}
SELECT event_id, operation, (SELECT LEAST(COUNT(*), 500) FROM log) AS total FROM log ORDER BY ts DESC, event_id DESC LIMIT 50""")
def t5_recent_entries(spark, sf):
    return T.recent_entries(_log(spark, sf), 50, ["ts", "event_id"]).select("event_id", "operation", "total")


@query("t5_recent_per_key", f"""WITH {_LOG}
SELECT user_id, event_id, CAST(rank AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank FROM log) WHERE rank <= 3""")
def t5_recent_per_key(spark, sf):
    return T.recent_per_key(_log(spark, sf), "user_id", 3, ["ts", "event_id"]).select("user_id", "event_id", "rank")


@query("t6_incomplete_transactions", f"WITH {I.TX_SQL} SELECT DISTINCT tx_id, tx_status AS status FROM op WHERE tx_status IN ('in_progress', 'pending')")
def t6_incomplete_transactions(spark, sf):
    return T.incomplete_transactions(I.transaction_log(spark, sf)).select("tx_id", "status")


def _present(spark, sf):
    """Keys already in the target stores: customers in credit, and orders that have lines."""
    customers = I.table(spark, sf, "customer").filter("c_acctbal > 0").select(
        F.lit("structured_data").alias("collection"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("unique_check"))
    orders = I.table(spark, sf, "lineitem").select(
        F.lit("documents").alias("collection"), F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("unique_check"))
    return customers.unionByName(orders)


_PRESENT = """present AS (SELECT 'structured_data' AS collection, 'c' || c_custkey AS unique_check FROM customer WHERE c_acctbal > 0
  UNION SELECT 'documents', 'o' || l_orderkey FROM lineitem)"""


@query("t7_pending_ops_to_apply", f"""WITH {I.TX_SQL}, {_PRESENT}
SELECT tx_id, op_index, collection, unique_check, op_status AS status FROM op
WHERE tx_status IN ('in_progress', 'pending') AND op_status <> 'done'
  AND (collection, unique_check) NOT IN (SELECT (collection, unique_check) FROM present)""")
def t7_pending_ops_to_apply(spark, sf):
    return T.pending_ops_to_apply(I.transaction_log(spark, sf), _present(spark, sf)).select(
        "tx_id", "op_index", "collection", "unique_check", "status")


def _outcomes(spark, sf):
    """Attempts derived from the order: dear orders fail, others apply or are duplicates."""
    price = F.col("o_totalprice")
    first = F.when(price > 300000, "error").when(price > 200000, "duplicate").otherwise("applied")
    second = F.when(price > 250000, "error").otherwise("applied")
    return I.table(spark, sf, "orders").select(F.col("o_orderkey").alias("tx_id"), F.inline(F.array(
        F.struct(F.lit(0).alias("op_index"), first.alias("outcome")), F.struct(F.lit(1).alias("op_index"), second.alias("outcome")))))


_ADVANCED = f"""
adv AS (SELECT op.*, CASE WHEN op_index = 0 THEN CASE WHEN o_totalprice > 300000 THEN 'error' ELSE 'done' END
                    ELSE CASE WHEN o_totalprice > 250000 THEN 'error' ELSE 'done' END END AS outcome
        FROM op JOIN orders ON o_orderkey = tx_id),
nxt AS (SELECT tx_id, op_index, tx_status, CASE WHEN op_status = 'done' OR outcome = 'done' THEN 'done' WHEN retries + 1 >= 3 THEN 'failed' ELSE 'retrying' END AS status,
          retries + CASE WHEN op_status <> 'done' AND outcome = 'error' THEN 1 ELSE 0 END AS retries FROM adv)"""


@query("t8_advance_op_state", f"WITH {I.TX_SQL}, {_ADVANCED} SELECT tx_id, op_index, status, retries FROM nxt")
def t8_advance_op_state(spark, sf):
    after = T.advance_op_state(I.transaction_log(spark, sf), _outcomes(spark, sf))
    return T.exploded_ops(after).select("tx_id", "op_index", "status", "retries")


@query("t9_transaction_rollup", f"""WITH {I.TX_SQL}, {_ADVANCED}
SELECT tx_id, CASE WHEN bool_and(status = 'done') THEN 'committed' ELSE MIN(tx_status) END AS status FROM nxt GROUP BY tx_id""")
def t9_transaction_rollup(spark, sf):
    after = T.advance_op_state(I.transaction_log(spark, sf), _outcomes(spark, sf))
    return T.transaction_rollup(after).select("tx_id", "status")


@query("t10_op_checksum", f"""WITH {I.TX_SQL}
SELECT tx_id, op_index, sha256('{{"action":"insert","collection":"' || collection || '","type":"' || type || '","unique_check":"' || unique_check || '"}}') AS checksum,
  substr(sha256(tx_id || '|' || op_index), 1, 32) AS idempotency_key, 0 AS retries, 'pending' AS status FROM op""")
def t10_op_checksum(spark, sf):
    noted = T.annotate_ops(I.transaction_log(spark, sf), ["type", "action", "collection", "unique_check"])
    return T.exploded_ops(noted).select("tx_id", "op_index", "checksum", "idempotency_key", "retries", "status")


@query("t11_reconcile_stores", """
WITH s AS (SELECT c_custkey AS key, COUNT(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY 1),
d AS (SELECT o_custkey AS key, COUNT(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT key, COALESCE(s.n, 0) AS structured_rows, COALESCE(d.n, 0) AS document_rows,
  CASE WHEN d.n IS NULL THEN 'structured_only' WHEN s.n IS NULL THEN 'documents_only' ELSE 'both' END AS status
FROM s FULL JOIN d USING (key)""")
def t11_reconcile_stores(spark, sf):
    structured = I.table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("k"))
    documents = I.table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k"))
    return T.reconcile_stores(structured, documents, "k")


# --- streams -----------------------------------------------------------------------------

def _event_stream(spark, sf):
    """The event table as a stream of JSON texts."""
    return I.event_json(I.event_stream(spark, sf))


@query("st1_adaptive_ingest", f"""WITH {I.EVENT_SQL}
SELECT 'structured' AS part, COUNT(*) AS rows, CAST(SUM(event_id) AS BIGINT) AS ids FROM ev
UNION ALL SELECT 'documents', COUNT(*), CAST(SUM(k) AS BIGINT) FROM ev
UNION ALL SELECT 'side', CAST(0 AS BIGINT), CAST(NULL AS BIGINT) FROM ev HAVING COUNT(*) > 0""")
def st1_adaptive_ingest(spark, sf):
    base = work_folder(spark, "st1")
    stream = _event_stream(spark, sf)
    adaptive_ingest(stream, base, "raw", "event_id", available_now=True, ingested_at="2024-02-01 00:00:00").awaitTermination()

    def line(name, df, ids):
        return df.agg(F.count(F.lit(1)).alias("rows"), ids.alias("ids")).select(F.lit(name).alias("part"), "rows", "ids")

    k = F.sum(F.try_variant_get(F.try_element_at("doc", F.lit("k")), "$", "string").cast("bigint"))
    return line("structured", read_structured(spark, base), F.sum("event_id")).unionByName(
        line("documents", read_documents(spark, base), k)
    ).unionByName(line("side", read_side(spark, base), F.lit(None).cast("bigint")))


def _document_texts(spark, sf):
    documents = spark.readStream.schema(I.table(spark, sf, "documents").schema).parquet(f"{sf}/documents.parque[t]")
    return documents.select("doc_id", F.to_json(F.struct("doc_id", F.struct("text").alias("body"), "lang", "source")).alias("raw"))


@query("st1_large_documents", """
SELECT doc_id, md5(text) AS digest, CASE WHEN length(text) > 1400 THEN true WHEN length(text) < 500 THEN false END AS moved FROM documents""")
def st1_large_documents(spark, sf):
    """Documents beyond the decomposition limit pass through the stream and come back whole."""
    base = work_folder(spark, "st1")
    adaptive_ingest(_document_texts(spark, sf), base, "raw", "doc_id", available_now=True,
                    ingested_at="2024-02-01 00:00:00").awaitTermination()
    structured, documents = current_view(spark, base)
    side = read_side(spark, base)
    whole = resolve_references(documents, side).documents.select("uuid", F.try_variant_get(F.col("doc")["body"], "$.text", "string").alias("text"))
    moved = side.select(F.col("parent_uuid").alias("uuid")).distinct().withColumn("m", F.lit(True))
    n = F.length("text")
    return structured.select("uuid", "doc_id").join(whole, "uuid").join(moved, "uuid", "left").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.md5("text").alias("digest"),
        F.when((n > 1400) | (n < 500), F.coalesce("m", F.lit(False))).alias("moved"))


@query("st1_drift", """
SELECT (event_id % 4) AS part, COUNT(*) AS rows, COUNT(*) AS in_documents, false AS in_column,
       CAST(SUM(CASE WHEN event_id % 2 = 0 THEN event_id ELSE length(CAST(event_id AS VARCHAR)) + 1 END) AS BIGINT) AS total FROM events GROUP BY 1""")
def st1_drift(spark, sf):
    """A field that is a number in the first batch and of mixed type in the second: its old values move to the documents."""
    base = work_folder(spark, "st1")
    events = I.table(spark, sf, "events").select("event_id")
    e = F.col("event_id")
    first = events.filter(e % 2 == 0).select("event_id", F.concat(F.lit('{"uid": '), e, F.lit(', "x": '), e, F.lit("}")).alias("raw"))
    second = events.filter(e % 2 == 1).select("event_id", F.concat(F.lit('{"uid": '), e, F.lit(', "x": "t'), e, F.lit('"}')).alias("raw"))
    for n, batch in enumerate((first, second)):
        ingest_batch(batch, n, base, "raw", "event_id", "2024-02-01 00:00:00")
    structured, documents = current_view(spark, base)
    x = F.try_element_at("doc", F.lit("x")).cast("string")
    whole = structured.select("uuid", F.col("uid").cast("bigint").alias("uid")).join(documents.select("uuid", x.alias("x")), "uuid")
    value = F.when(F.col("x").startswith("t"), F.length("x")).otherwise(F.col("x").try_cast("bigint"))
    return whole.groupBy((F.col("uid") % 4).alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("x").alias("in_documents"), F.sum(value.cast("bigint")).alias("total")).withColumn(
        "in_column", F.lit("x" in structured.columns))


@query("st2_stream_profile", f"WITH {I.EVENT_SQL} {EVENT_PROFILE}")
def st2_stream_profile(spark, sf):
    base = work_folder(spark, "st2")
    stream_profile(_event_stream(spark, sf), base, "raw", "event_id").awaitTermination()
    return I.round_profile(streamed_profile(spark, base))


@query("st2_running_profile", f"""WITH {I.EVENT_SQL}
SELECT key AS field, COUNT(*) AS count, round(COUNT(*) / (SELECT COUNT(*) FROM ev)::DOUBLE, 6) AS frequency_ratio,
       CASE WHEN COUNT(DISTINCT type_name) = 1 THEN MIN(type_name) ELSE 'mixed' END AS detected_type, true AS near_unique_count
FROM ({I.cells_sql()}) GROUP BY key""")
def st2_running_profile(spark, sf):
    """The profile kept in the state store; its distinct counts are sketched and must be near the exact ones."""
    base = work_folder(spark, "st2r")
    stream_running_profile(_event_stream(spark, sf), base, "raw", "event_id").awaitTermination()
    exact = field_profile(I.event_records(spark, sf)).select("field", F.col("unique_count").alias("_exact"))
    near = F.abs(F.col("unique_count") - F.col("_exact")) <= 0.1 * F.col("_exact")
    return I.round_profile(running_profile(spark, base)).join(exact, "field").select(
        "field", "count", "frequency_ratio", "detected_type", near.alias("near_unique_count"))


_SESSIONS = """
g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS starts FROM events),
n AS (SELECT *, SUM(starts) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g),
ses AS (SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 2 HOUR AS session_end, COUNT(*) AS events FROM n GROUP BY user_id, s)"""


@query("st3_sessions", f"WITH {_SESSIONS} SELECT * FROM ses")
def st3_sessions(spark, sf):
    return _naive(stream_sessions(I.table(spark, sf, "events"), "user_id", "ts"))


def _naive(sessions):
    for c in ("session_start", "session_end"):
        sessions = sessions.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return sessions


@query("st3_stream_sessions", f"""WITH {_SESSIONS}
SELECT * FROM ses WHERE session_end <= (SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTE""")
def st3_stream_sessions(spark, sf):
    base = work_folder(spark, "st3")
    sessions = stream_sessions(I.event_stream(spark, sf), "user_id", "ts")
    sessions.writeStream.format("parquet").option("path", f"{base}/out").option(
        "checkpointLocation", f"{base}/checkpoint").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return _naive(spark.read.schema(sessions.schema).parquet(f"{base}/out"))


@query("w6_once_per_key_stream", "SELECT DISTINCT user_id, event_type FROM events")
def w6_once_per_key_stream(spark, sf):
    base = work_folder(spark, "w6")
    # The lateness covers the whole span of the events, so each key passes once.
    once = once_per_key(I.event_stream(spark, sf), ["user_id", "event_type"], "ts", late="60 days").select("user_id", "event_type")
    once.writeStream.format("parquet").option("path", f"{base}/out").option(
        "checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(once.schema).parquet(f"{base}/out")
