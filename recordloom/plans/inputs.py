"""Record shapes derived from the given tables, and their SQL counterparts.

Every shape is built row by row (no grouping), so an input costs one scan of its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.plan import spread
from ..operators.records import assign_uuid, normalize_keys
from ..sources.records import Parsed, read_records, stream_records

# Events before this moment form the early period, the others the late one.
PERIOD_CUT = "2024-01-15 00:00:00"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def event_stream(spark: SparkSession, sf: str, files_per_trigger: int | None = None) -> DataFrame:
    """The event table as a stream.  Written as a pattern, the path may be one file or a folder."""
    schema = table(spark, sf, "events").schema
    return stream_records(spark, f"{sf}/events.parque[t]", "parquet", schema, files_per_trigger)


def event_json(events: DataFrame) -> DataFrame:
    """Events as JSON text ``(event_id, ts, raw)`` in camel case.

    ``k`` turns to text in late error events, ``note`` is present with null in views only,
    ``ref`` misses in late error events, ``legacy`` exists early and ``coupon`` late.
    """
    late = F.col("ts") >= F.lit(PERIOD_CUT).cast("timestamp_ntz")
    error = F.col("event_type") == "error"
    k = F.get_json_object("props", "$.k")
    q = F.lit('"')
    parts = [
        F.lit('{"eventId":'), F.col("event_id").cast("string"),
        F.lit(',"userId":'), F.col("user_id").cast("string"),
        F.lit(',"eventType":"'), F.col("event_type"),
        F.lit('","value":'), F.col("value").cast("string"),
        F.lit(',"k":'), F.when(late & error, F.concat(q, k, q)).otherwise(k),
        F.when(F.col("event_type") == "view", ',"note":null').otherwise(""),
        F.when(late & error, "").otherwise(F.concat(F.lit(',"ref":"u'), F.col("user_id").cast("string"), q)),
        F.when(late, ',"coupon":true').otherwise(',"legacy":"yes"'),
        F.lit("}"),
    ]
    return events.select("event_id", "ts", F.concat(*parts).alias("raw"))


def event_records(spark: SparkSession, sf: str, period: str | None = None) -> DataFrame:
    """Normalised event records ``(rec_id, fields)``, of one period or of both."""
    events = spread(table(spark, sf, "events"))
    if period:
        cut = F.lit(PERIOD_CUT).cast("timestamp_ntz")
        events = events.filter(F.col("ts") < cut if period == "early" else F.col("ts") >= cut)
    return normalize_keys(read_records(event_json(events), "raw", "event_id").records)


EVENT_SQL = f"""
ev AS (
  SELECT event_id, user_id, event_type, value, ts, ts >= TIMESTAMP '{PERIOD_CUT}' AS late,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         event_type = 'error' AS err
  FROM events
)"""

# (field, present, text, type) of every event field.
EVENT_FIELDS = [
    ("event_id", "true", "CAST(event_id AS VARCHAR)", "'int'"),
    ("user_id", "true", "CAST(user_id AS VARCHAR)", "'int'"),
    ("event_type", "true", "event_type", "'str'"),
    ("value", "true", "CAST(value AS VARCHAR)", "'float'"),
    ("k", "true", "CAST(k AS VARCHAR)", "CASE WHEN late AND err THEN 'str' ELSE 'int' END"),
    ("note", "event_type = 'view'", "'None'", "'NoneType'"),
    ("ref", "NOT (late AND err)", "'u' || user_id", "'str'"),
    ("coupon", "late", "'True'", "'bool'"),
    ("legacy", "NOT late", "'yes'", "'str'"),
]


def cells_sql(fields=EVENT_FIELDS, source: str = "ev", rec: str = "event_id") -> str:
    return " UNION ALL ".join(
        f"SELECT {rec} AS rec_id, '{f}' AS key, {t} AS type_name, {x} AS text FROM {source} WHERE {p}"
        for f, p, x, t in fields
    )


def profile_sql(cells: str, total: str, nested: str = "false", cap: int | None = None) -> str:
    """Profile rows over a cells subquery."""
    unique = "COUNT(DISTINCT text)" if cap is None else f"LEAST(COUNT(DISTINCT text), {cap})"
    return f"""
      SELECT key AS field, COUNT(*) AS count, COUNT(*) / ({total})::DOUBLE AS frequency_ratio,
             CASE WHEN COUNT(DISTINCT type_name) = 1 THEN 'stable' ELSE 'unstable' END AS type_stability,
             CASE WHEN COUNT(DISTINCT type_name) = 1 THEN MIN(type_name) ELSE 'mixed' END AS detected_type,
             {nested} AS is_nested, {unique} AS unique_count,
             {unique} / COUNT(*)::DOUBLE AS unique_ratio
      FROM ({cells}) GROUP BY key"""


def rounded(sql: str) -> str:
    return f"""SELECT field, count, round(frequency_ratio, 6) AS frequency_ratio, type_stability, detected_type,
      is_nested, unique_count, round(unique_ratio, 6) AS unique_ratio FROM ({sql})"""


def round_profile(profile: DataFrame) -> DataFrame:
    return profile.withColumn("frequency_ratio", F.round("frequency_ratio", 6)).withColumn(
        "unique_ratio", F.round("unique_ratio", 6)
    )


def document_json(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their labels as sparse JSON: a document without labels lacks the keys."""
    docs = spread(table(spark, sf, "documents")).join(table(spark, sf, "labels"), "doc_id", "left")
    fields = ["text", "lang", "source", "n_chars", "quality", "toxic"]
    return docs.select("doc_id", F.to_json(F.struct(*fields)).alias("raw"))


def document_records(spark: SparkSession, sf: str) -> DataFrame:
    return read_records(document_json(spark, sf), "raw", "doc_id").records


DOCUMENT_SQL = "d AS (SELECT documents.*, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))"
DOCUMENT_FIELDS = [
    ("text", "true", "text", "'str'"),
    ("lang", "true", "lang", "'str'"),
    ("source", "true", "source", "'str'"),
    ("n_chars", "true", "CAST(n_chars AS VARCHAR)", "'int'"),
    ("quality", "quality IS NOT NULL", "CAST(quality AS VARCHAR)", "'int'"),
    ("toxic", "toxic IS NOT NULL", "CAST(toxic AS VARCHAR)", "'int'"),
]


def order_json(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as nested JSON ``(o_orderkey, raw)``: an object, a list of payments (two for
    finished orders, one for open ones, none for the rest) each with a list of entries, and
    a list of scalar tags.  Amounts are whole cents."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    n = F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "O", 1).otherwise(0)

    def payment(i):
        amount = F.expr("div(_cents, greatest(_n, 1))") + i
        net = F.floor(amount * 4 / 5).cast("bigint")
        return F.struct(
            i.alias("payNo"),
            amount.alias("amountCents"),
            F.array(
                F.struct(F.lit("net").alias("entryCode"), net.alias("cents")),
                F.struct(F.lit("tax").alias("entryCode"), (amount - net).alias("cents")),
            ).alias("entries"),
        )

    orders = spread(table(spark, sf, "orders")).withColumn("_cents", cents).withColumn("_n", n)
    one_each = F.transform(F.sequence(F.lit(1), F.lit(2)), payment)
    record = F.struct(
        F.col("o_orderkey").alias("orderKey"),
        F.col("o_orderstatus").alias("orderStatus"),
        F.col("_cents").alias("totalCents"),
        F.struct(F.col("o_custkey").alias("custKey"), F.col("o_orderpriority").alias("orderPriority")).alias("customer"),
        F.when(F.col("_n") > 0, F.slice(one_each, 1, F.greatest(F.col("_n"), F.lit(1)))).otherwise(
            F.slice(one_each, 1, 0)
        ).alias("payments"),
        F.array(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("tags"),
    )
    return orders.select("o_orderkey", F.to_json(record).alias("raw"))


def order_parsed(spark: SparkSession, sf: str) -> Parsed:
    return read_records(order_json(spark, sf), "raw", "o_orderkey")


def order_records(spark: SparkSession, sf: str) -> DataFrame:
    """Order records with uuid; names below the top level stay in camel case."""
    return assign_uuid(order_parsed(spark, sf).records)


def order_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Order records without the uuid field."""
    return order_parsed(spark, sf).records


ORDER_SQL = """
o AS (
  SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 0 END AS n
  FROM orders
),
pay AS (
  SELECT o_orderkey, i AS pay_no, (cents // n) + i AS amount
  FROM (SELECT o.*, unnest(range(1, n + 1)) AS i FROM o WHERE n > 0)
),
entry AS (
  SELECT o_orderkey, pay_no, 'net' AS entry_code, CAST(floor(amount * 4 / 5) AS BIGINT) AS cents FROM pay
  UNION ALL
  SELECT o_orderkey, pay_no, 'tax', amount - CAST(floor(amount * 4 / 5) AS BIGINT) FROM pay
)"""


def customer_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Customers under the column names of a user table."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("uuid"),
        F.col("c_name").alias("username"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("bigint").alias("nation"),
        F.col("c_acctbal").alias("balance"),
    )


def transaction_log(spark: SparkSession, sf: str) -> DataFrame:
    """A transaction per order: finished orders are committed, the others in progress or
    pending, with a structured and a document operation each.

    ``(tx_id, status, ops ARRAY<STRUCT<type, action, collection, unique_check, status, retries>>)``
    """
    state = F.col("o_orderstatus")
    key = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))

    def op(kind: str, collection: str, unique, status, retries):
        return F.struct(
            F.lit(kind).alias("type"), F.lit("insert").alias("action"), F.lit(collection).alias("collection"),
            unique.alias("unique_check"), status.alias("status"), retries.alias("retries"),
        )

    first = F.when(state == "P", "pending").otherwise("done")
    second = F.when(state == "F", "done").otherwise("pending")
    retries = F.substring("o_orderpriority", 1, 1).cast("int") % 3
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("tx_id"),
        F.when(state == "F", "committed").when(state == "O", "in_progress").otherwise("pending").alias("status"),
        F.array(
            op("sql", "structured_data", key, first, F.lit(0)),
            op("mongo", "documents", F.concat(F.lit("o"), F.col("o_orderkey").cast("string")), second, retries),
        ).alias("ops"),
    )


TX_SQL = """
op AS (
  SELECT o_orderkey AS tx_id, 0 AS op_index, 'sql' AS type, 'structured_data' AS collection, 'c' || o_custkey AS unique_check,
         CASE o_orderstatus WHEN 'P' THEN 'pending' ELSE 'done' END AS op_status, 0 AS retries,
         CASE o_orderstatus WHEN 'F' THEN 'committed' WHEN 'O' THEN 'in_progress' ELSE 'pending' END AS tx_status
  FROM orders
  UNION ALL
  SELECT o_orderkey, 1, 'mongo', 'documents', 'o' || o_orderkey,
         CASE o_orderstatus WHEN 'F' THEN 'done' ELSE 'pending' END, CAST(substr(o_orderpriority, 1, 1) AS INT) % 3,
         CASE o_orderstatus WHEN 'F' THEN 'committed' WHEN 'O' THEN 'in_progress' ELSE 'pending' END
  FROM orders
)"""
