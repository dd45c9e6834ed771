"""Queries over filters, projections, federated reads and writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.filters import structured_filter
from ..operators import federate as J
from ..operators import mutate as W
from ..operators import query as Q
from ..operators.classify import decide_targets
from ..operators.profile import field_profile
from ..operators.route import decompose_large
from ..session import work_folder
from ..sources.buckets import read_buckets, update_stored, write_buckets
from ..sources.tables import write_shredded
from . import inputs as I
from .registry import SQL, query

_ACCOUNT = """acct AS (SELECT CAST(c_custkey AS VARCHAR) AS uuid, c_name AS username, c_mktsegment AS segment,
  CAST(c_nationkey AS BIGINT) AS nation, c_acctbal AS balance FROM customer)"""


def _order_docs(spark, sf):
    """Order records as documents keyed by order."""
    return I.order_records(spark, sf).select(
        F.col("rec_id").alias("o_orderkey"), "uuid", F.col("fields").alias("doc"))


# --- filters and projections -------------------------------------------------------------

@query("q1_filter_structured", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice >= 100000 AND o_totalprice < 300000 AND o_orderstatus IN ('F', 'O') AND o_orderpriority <> '5-LOW'""")
def q1_filter_structured(spark, sf):
    spec = {"o_totalprice": {"$gte": 100000, "$lt": 300000}, "o_orderstatus": {"$in": ["F", "O"]}, "o_orderpriority": {"$ne": "5-LOW"}}
    return Q.filter_rows(I.table(spark, sf, "orders"), spec).select("o_orderkey", "o_totalprice")


@query("q1_filter_equality", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' AND o_totalprice > 50000 AND o_totalprice <= 400000")
def q1_filter_equality(spark, sf):
    spec = {"o_orderstatus": "P", "o_orderpriority": {"$in": "1-URGENT"}, "o_totalprice": {"$gt": 50000, "$lte": 400000}}
    return Q.filter_rows(I.table(spark, sf, "orders"), spec).select("o_orderkey")


_DOC_TESTS = {
    "equal": ({"orderStatus": "F"}, "o_orderstatus = 'F'"),
    "element": ({"tags": "1-URGENT"}, "o_orderpriority = '1-URGENT'"),
    "not_element": ({"tags": {"$ne": "1-URGENT"}}, "o_orderpriority <> '1-URGENT'"),
    "missing_not_equal": ({"absent": {"$ne": 1}}, "true"),
    "missing_is_null": ({"absent": None}, "true"),
    "nested_range": ({"customer.custKey": {"$gte": 100, "$lt": 700}}, "o_custkey >= 100 AND o_custkey < 700"),
    "list_member_path": ({"payments.entries.entryCode": "tax"}, "o_orderstatus <> 'P'"),
    "size": ({"payments": {"$size": 2}}, "o_orderstatus = 'F'"),
    "exists": ({"customer.orderPriority": {"$exists": True}, "nothing": {"$exists": False}}, "true"),
    "other_type": ({"orderKey": {"$gt": "5"}}, "false"),
    "one_of": ({"orderKey": {"$in": [1, 2, 3, 5000]}}, "o_orderkey IN (1, 2, 3, 5000)"),
    "none_of": ({"orderStatus": {"$nin": ["F", "O"]}}, "o_orderstatus NOT IN ('F', 'O')"),
    "logic": ({"$or": [{"orderStatus": "P"}, {"$and": [{"totalCents": {"$gt": 30000000}}, {"customer.custKey": {"$lte": 300}}]}]},
              "o_orderstatus = 'P' OR (CAST(round(o_totalprice * 100) AS BIGINT) > 30000000 AND o_custkey <= 300)"),
    "negated": ({"totalCents": {"$not": {"$gt": 20000000}}}, "NOT CAST(round(o_totalprice * 100) AS BIGINT) > 20000000"),
    "whole_list": ({"tags": ["F", "1-URGENT"]}, "o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"),
}


@query("q2_filter_documents", " UNION ALL ".join(
    f"SELECT '{n}' AS test, COUNT(*) AS documents, COALESCE(CAST(SUM(o_orderkey) AS BIGINT), 0) AS keys FROM orders WHERE {w}"
    for n, (_, w) in _DOC_TESTS.items()))
def q2_filter_documents(spark, sf):
    docs = _order_docs(spark, sf)
    # One scan answers all tests: each is a condition over the same document.
    from ..functions.filters import document_filter

    flags = F.array(*[F.struct(F.lit(n).alias("test"), document_filter(s).alias("hit")) for n, (s, _) in _DOC_TESTS.items()])
    hits = docs.select("o_orderkey", F.inline(flags))
    return hits.groupBy("test").agg(
        F.count(F.when(F.col("hit"), 1)).alias("documents"),
        F.coalesce(F.sum(F.when(F.col("hit"), F.col("o_orderkey"))), F.lit(0)).alias("keys"))


@query("q2_filter_documents_rows", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey > 1000 AND o_orderpriority = '2-HIGH'")
def q2_filter_documents_rows(spark, sf):
    hit = Q.filter_documents(_order_docs(spark, sf), {"customer.custKey": {"$gt": 1000}, "tags": "2-HIGH"})
    return hit.select("o_orderkey", F.try_variant_get(F.col("doc")["customer"], "$.custKey", "bigint").alias("o_custkey"))


def _shredded_orders(spark, sf):
    """Order documents as shredded files, read back."""
    path = work_folder(spark, "shredded")
    write_shredded(_order_docs(spark, sf), path, "orders")
    return spark.read.parquet(path)


@query("q2_filter_shredded", SQL["q2_filter_documents"])
def q2_filter_shredded(spark, sf):
    """Every test over stored documents: the scan reads the tested fields."""
    from ..functions.filters import document_filter

    flags = _shredded_orders(spark, sf).select(
        "o_orderkey", *[document_filter(s, stored=True).alias(n) for n, (s, _) in _DOC_TESTS.items()])
    hits = flags.select("o_orderkey", F.inline(F.array(*[F.struct(F.lit(n).alias("test"), F.col(n).alias("hit")) for n in _DOC_TESTS])))
    return hits.groupBy("test").agg(
        F.count(F.when(F.col("hit"), 1)).alias("documents"),
        F.coalesce(F.sum(F.when(F.col("hit"), F.col("o_orderkey"))), F.lit(0)).alias("keys"))


@query("q2_filter_shredded_rows", SQL["q2_filter_documents_rows"])
def q2_filter_shredded_rows(spark, sf):
    hit = Q.filter_documents(_shredded_orders(spark, sf), {"customer.custKey": {"$gt": 1000}, "tags": "2-HIGH"})
    return hit.select("o_orderkey", F.try_variant_get("doc", "$.customer.custKey", "bigint").alias("o_custkey"))


@query("q2_filter_numbers", """
SELECT o_orderkey, o_orderkey % 5 AS form FROM orders WHERE o_orderkey % 5 IN (0, 1, 2) OR (o_orderkey % 5 = 3 AND o_custkey > 5)""")
def q2_filter_numbers(spark, sf):
    """``$gt 5`` over every form of number: beyond any fixed scale, just above, whole, and equal."""
    key = F.col("o_orderkey")
    forms = F.element_at(F.array(F.lit("1e30"), F.lit("5.0000000001"), F.lit("12345678901234567890123456789012345678"),
                                 F.col("o_custkey").cast("string"), F.lit("5.0")), (key % 5 + 1).cast("int"))
    raw = I.spread(I.table(spark, sf, "orders")).select("o_orderkey", "o_custkey", F.concat(F.lit('{"x": '), forms, F.lit("}")).alias("raw"))
    docs = raw.select("o_orderkey", F.from_json("raw", "map<string,variant>").alias("doc"))
    return Q.filter_documents(docs, {"x": {"$gt": 5}}).select("o_orderkey", (key % 5).alias("form"))


@query("q3_repeated_conditions", """
SELECT 'structured' AS side, o_orderkey FROM orders WHERE o_custkey > 20 AND o_custkey > 10 AND o_custkey < 90 AND o_custkey < 120
UNION ALL SELECT 'documents', o_orderkey FROM orders WHERE o_custkey > 20 AND o_custkey > 10 AND o_custkey < 90 AND o_custkey < 120""")
def q3_repeated_conditions(spark, sf):
    """Conditions that repeat a field and an operator must all hold."""
    orders = I.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    tests = [{"field": "o_custkey", "op": op, "value": v} for op, v in (("gt", 20), ("gt", 10), ("lt", 90), ("lt", 120))]
    docs = orders.select("o_orderkey", F.create_map(F.lit("o_custkey"), F.col("o_custkey").cast("variant")).alias("doc"))
    left = Q.filter_by_conditions(orders, tests).select(F.lit("structured").alias("side"), "o_orderkey")
    return left.unionByName(Q.filter_by_conditions(docs, tests, documents=True).select(F.lit("documents").alias("side"), "o_orderkey"))


_CONDITIONS = [{"field": "balance", "op": "gte", "value": 0}, {"field": "segment", "op": "in", "value": ["BUILDING", "MACHINERY"]},
               {"field": "nation", "op": "lt", "value": 12}]


@query("q3_filter_conditions", f"""WITH {_ACCOUNT}
SELECT 'structured' AS side, uuid FROM acct WHERE balance >= 0 AND segment IN ('BUILDING', 'MACHINERY') AND nation < 12
UNION ALL SELECT 'documents', uuid FROM acct WHERE balance >= 0 AND segment IN ('BUILDING', 'MACHINERY') AND nation < 12""")
def q3_filter_conditions(spark, sf):
    accounts = I.customer_accounts(spark, sf)
    docs = accounts.select("uuid", F.from_json(F.to_json(F.struct("segment", "nation", "balance")), "map<string,variant>").alias("doc"))
    left = Q.filter_by_conditions(accounts, _CONDITIONS).select(F.lit("structured").alias("side"), "uuid")
    return left.unionByName(Q.filter_by_conditions(docs, _CONDITIONS, documents=True).select(F.lit("documents").alias("side"), "uuid"))


@query("q4_project_fields", f"WITH {_ACCOUNT} SELECT segment, uuid FROM acct")
def q4_project_fields(spark, sf):
    return Q.project_fields(I.customer_accounts(spark, sf), ["segment", "no_such_field", "uuid"])


@query("q4_project_document_fields", """
SELECT o_orderkey, o_orderstatus AS "orderStatus", CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS "totalCents",
       '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS tags, CAST(NULL AS VARCHAR) AS absent FROM orders""")
def q4_project_document_fields(spark, sf):
    return Q.project_document_fields(_order_docs(spark, sf), ["orderStatus", "totalCents", "tags", "absent"], keep=("o_orderkey",))


@query("q4_project_shredded", SQL["q4_project_document_fields"])
def q4_project_shredded(spark, sf):
    return Q.project_document_fields(_shredded_orders(spark, sf), ["orderStatus", "totalCents", "tags", "absent"], keep=("o_orderkey",))


@query("q5_read_fields", f"""WITH {_ACCOUNT}
SELECT * FROM (SELECT 'structured' AS side, uuid, segment, CAST(NULL AS VARCHAR) AS note FROM acct)
UNION ALL SELECT * FROM (SELECT 'documents', uuid, segment, username FROM acct)""")
def q5_read_fields(spark, sf):
    accounts = I.customer_accounts(spark, sf)
    docs = accounts.select("uuid", F.create_map(
        F.lit("segment"), F.col("segment").cast("variant"), F.lit("note"), F.col("username").cast("variant")).alias("doc"))
    left, right = Q.read_fields(accounts, docs, {"segment": "BOTH", "note": "MONGO"}, ["segment", "note"])
    return left.select(F.lit("structured").alias("side"), "uuid", "segment", F.lit(None).cast("string").alias("note")).unionByName(
        right.select(F.lit("documents").alias("side"), "uuid", "segment", "note"))


@query("q6_list_values", "SELECT c_custkey, c_mktsegment AS value FROM customer WHERE c_mktsegment IS NOT NULL")
def q6_list_values(spark, sf):
    return Q.list_values(I.table(spark, sf, "customer"), "c_mktsegment", "c_custkey")


@query("q7_distinct_values", "SELECT DISTINCT o_custkey FROM orders")
def q7_distinct_values(spark, sf):
    return Q.distinct_values(I.table(spark, sf, "orders"), "o_custkey")


@query("q8_count_preview", """
SELECT LEAST(n, 10000) AS count, n > 10000 AS truncated, CASE WHEN n <= 10000 THEN n END AS actual_count FROM (
  SELECT COUNT(*) AS n FROM lineitem WHERE l_quantity > 10)
UNION ALL SELECT LEAST(n, 100000), n > 100000, CASE WHEN n <= 100000 THEN n END FROM (SELECT COUNT(*) AS n FROM orders)""")
def q8_count_preview(spark, sf):
    wide = Q.count_preview(I.table(spark, sf, "lineitem"), structured_filter({"l_quantity": {"$gt": 10}}), cap=10_000)
    return wide.unionByName(Q.count_preview(I.table(spark, sf, "orders")))


@query("q9_count_for_key", "SELECT COUNT(*) AS rows FROM events WHERE user_id = 89")
def q9_count_for_key(spark, sf):
    return Q.count_for_key(I.table(spark, sf, "events"), "user_id", 89)


@query("q10_clamp_limit", """
SELECT * FROM (SELECT 'huge' AS ask, event_id FROM events ORDER BY event_id DESC LIMIT 100)
UNION ALL SELECT * FROM (SELECT 'none', event_id FROM events ORDER BY event_id DESC LIMIT 50)
UNION ALL SELECT * FROM (SELECT 'low', event_id FROM events ORDER BY event_id DESC LIMIT 1)""")
def q10_clamp_limit(spark, sf):
    newest = Q.order_rows(I.table(spark, sf, "events").select("event_id"), "event_id", "desc")
    out = None
    for ask, limit in (("huge", 100_000), ("none", None), ("low", -3)):
        part = newest.limit(Q.clamp_limit(limit)).select(F.lit(ask).alias("ask"), "event_id")
        out = part if out is None else out.unionByName(part)
    return out


@query("q11_first_available_table", "SELECT 'supplier' AS chosen, s_suppkey, s_acctbal FROM supplier")
def q11_first_available_table(spark, sf):
    tables = {n: I.table(spark, sf, n) for n in ("customer", "supplier", "orders")}
    name, df = Q.first_available_table(tables, ["s_suppkey", "s_acctbal"])
    return df.select(F.lit(name).alias("chosen"), "s_suppkey", "s_acctbal")


@query("q12_order_by", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC")
def q12_order_by(spark, sf):
    return Q.order_rows(I.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "desc")


# --- federated reads ---------------------------------------------------------------------

def _account_parts(spark, sf):
    accounts = I.customer_accounts(spark, sf)
    structured = accounts.select("uuid", "username", "segment")
    docs = accounts.select("uuid", F.create_map(
        F.lit("nation"), F.col("nation").cast("variant"), F.lit("segment"), F.lower("segment").cast("variant")).alias("doc"))
    orders = I.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("root_id"), "o_orderkey", "o_totalprice")
    return structured, docs, {"root_orders": (orders, "root_id", ["o_orderkey"])}


def _record_columns(df):
    record = F.parse_json("record")
    get = lambda p, t: F.try_variant_get(record, p, t)
    keys = F.from_json("orders", "array<struct<o_orderkey:bigint>>")
    return [get("$.username", "string").alias("username"), get("$.segment", "string").alias("segment"),
            get("$.nation", "bigint").alias("nation"), F.array_join(F.transform(keys, lambda k: k["o_orderkey"].cast("string")), ",").alias("orders")]


_RECORD_SQL = """
SELECT uuid, username, lower(segment) AS segment, nation, COALESCE((SELECT string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey)
  FROM orders WHERE CAST(o_custkey AS VARCHAR) = uuid), '') AS orders"""


@query("j1_read_by_id", f"""WITH {_ACCOUNT}
SELECT * EXCLUDE (s), s AS status FROM ({_RECORD_SQL}, 'success' AS s FROM acct WHERE uuid = '42')
UNION ALL SELECT 'no-such-id', NULL, NULL, NULL, NULL, '404'""")
def j1_read_by_id(spark, sf):
    structured, docs, children = _account_parts(spark, sf)
    out = None
    for uid in ("42", "no-such-id"):
        one = J.read_by_id(structured, docs, uid, children)
        one = one.select("uuid", *_record_columns(one), "status")
        out = one if out is None else out.unionByName(one)
    return out


@query("j2_read_by_filter", f"WITH {_ACCOUNT} {_RECORD_SQL} FROM acct WHERE segment IN ('BUILDING', 'MACHINERY')")
def j2_read_by_filter(spark, sf):
    structured, docs, children = _account_parts(spark, sf)
    rows = J.read_by_filter(structured, structured_filter({"segment": {"$in": ["BUILDING", "MACHINERY"]}}), docs, children)
    return rows.select("uuid", *_record_columns(rows))


@query("j2_read_with_references", """
SELECT CAST(doc_id AS VARCHAR) AS uuid, lang, md5(text) AS text_digest FROM documents WHERE lang <> 'en'""")
def j2_read_with_references(spark, sf):
    docs = I.document_records(spark, sf).select(F.col("rec_id").cast("string").alias("uuid"), F.col("fields").alias("doc"))
    structured = I.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("uuid"), "lang", "source")
    parts = decompose_large(docs)
    rows = J.read_by_filter(structured, structured_filter({"lang": {"$ne": "en"}}), parts.documents, side=parts.side)
    record = F.parse_json("record")
    return rows.select("uuid", F.try_variant_get(record, "$.lang", "string").alias("lang"),
                       F.md5(F.try_variant_get(record, "$.text", "string")).alias("text_digest"))


@query("j2_read_nested_references", """
SELECT CAST(page_id AS VARCHAR) AS uuid, md5(html) AS inner_digest, CAST(page_id % 3 AS INT) AS payloads FROM pages WHERE page_id % 2 = 0""")
def j2_read_nested_references(spark, sf):
    """A reference inside an object, and one with several payloads, read through a filter."""
    pages = I.table(spark, sf, "pages").withColumn("uuid", F.col("page_id").cast("string"))
    stub = lambda c: F.concat(F.lit(f"REF::MONGO::{c}::"), F.col("uuid"))
    docs = pages.select("uuid", F.from_json(F.to_json(F.struct(
        F.struct(stub("one").alias("html")).alias("body"), stub("many").alias("list"))), "map<string,variant>").alias("doc"))
    one = pages.select(F.lit("one").alias("collection"), F.col("uuid").alias("parent_uuid"), F.to_json(F.col("html").cast("variant")).alias("data"))
    many = pages.select(F.lit("many").alias("collection"), F.col("uuid").alias("parent_uuid"), F.explode(
        F.slice(F.array(F.lit("[1]"), F.lit("[2]")), F.lit(1), (F.col("page_id") % 3).cast("int"))).alias("data"))
    structured = pages.select("uuid", "page_id")
    rows = J.read_by_filter(structured, F.col("page_id") % 2 == 0, docs, side=one.unionByName(many))
    record = F.parse_json("record")
    held = F.to_json(F.try_variant_get(record, "$.list", "variant"))
    return rows.select("uuid", F.md5(F.try_variant_get(record, "$.body.html", "string")).alias("inner_digest"),
                       F.when(held == "[1]", 1).otherwise(F.size(F.from_json(held, "array<string>"))).alias("payloads"))


@query("j3_typed_keys", """
SELECT 'both' AS source, CAST(c_custkey + 1 AS VARCHAR) AS merge_key, c_custkey + 1 AS own, 'number' AS other FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT 'structured', CAST(c_custkey + 1 AS VARCHAR), c_custkey + 1, NULL FROM customer WHERE c_custkey % 2 = 1
UNION ALL SELECT 'document', CAST(c_custkey + 1 AS VARCHAR), NULL, 'text' FROM customer WHERE c_custkey % 2 = 1""")
def j3_typed_keys(spark, sf):
    """Numbers meet numbers, whole or with a point; a text of the same digits does not."""
    customers = I.table(spark, sf, "customer")
    key, even = F.col("c_custkey") + 1, F.col("c_custkey") % 2 == 0
    structured = customers.select(F.create_map(F.lit("user_id"), key.cast("variant"), F.lit("own"), key.cast("variant")).alias("fields"))
    value = F.when(even, key.cast("double").cast("variant")).otherwise(key.cast("string").cast("variant"))
    documents = customers.select(key.alias("seq"), F.create_map(
        F.lit("user_id"), value, F.lit("other"), F.when(even, "number").otherwise("text").cast("variant")).alias("fields"))
    field = lambda n, t: F.try_variant_get(F.try_element_at("fields", F.lit(n)), "$", t).alias(n)
    return J.federated_merge(structured, documents).select("source", "merge_key", field("own", "bigint"), field("other", "string"))


@query("j3_federated_merge", """
WITH s AS (SELECT c_name AS k, c_mktsegment AS segment FROM customer WHERE c_acctbal >= 5000),
d AS (SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL ELSE c_name END AS k, o_orderkey,
        CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderpriority END AS segment
      FROM orders JOIN customer ON c_custkey = o_custkey),
f AS (SELECT k, MIN(o_orderkey) AS o_orderkey FROM d WHERE k IS NOT NULL GROUP BY k)
SELECT CASE WHEN f.k IS NULL THEN 'structured' ELSE 'both' END AS source, s.k AS merge_key,
       CASE WHEN f.k IS NULL THEN s.segment ELSE d.segment END AS segment, d.o_orderkey AS order_key
FROM s LEFT JOIN f ON f.k = s.k LEFT JOIN d ON d.o_orderkey = f.o_orderkey
UNION ALL SELECT 'document', k, segment, o_orderkey FROM d WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM s)""")
def j3_federated_merge(spark, sf):
    customers = I.table(spark, sf, "customer")
    structured = customers.filter("c_acctbal >= 5000").select(F.create_map(
        F.lit("username"), F.col("c_name").cast("variant"), F.lit("segment"), F.col("c_mktsegment").cast("variant")).alias("fields"))
    orders = I.spread(I.table(spark, sf, "orders")).join(customers.select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey")
    # Urgent orders hold a null segment that still overrides; pending low ones have no key.
    segment = F.when(F.col("o_orderpriority") == "1-URGENT", F.parse_json(F.lit("null"))).otherwise(F.col("o_orderpriority").cast("variant"))
    keyless = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    documents = orders.select(
        F.col("o_orderkey").alias("seq"),
        F.create_map(
            F.lit("username"), F.when(keyless, F.lit("")).otherwise(F.col("c_name")).cast("variant"),
            F.lit("segment"), segment, F.lit("orderKey"), F.col("o_orderkey").cast("variant"),
        ).alias("fields"))
    merged = J.federated_merge(structured, documents)
    f = F.col("fields")
    return merged.select("source", "merge_key", F.try_variant_get(f["segment"], "$", "string").alias("segment"),
                         F.try_variant_get(F.try_element_at(f, F.lit("orderKey")), "$", "bigint").alias("order_key"))


@query("j4_enrich", """
SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey""")
def j4_enrich(spark, sf):
    lookup = I.table(spark, sf, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return J.enrich(I.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), lookup, "o_custkey").drop("o_custkey")


@query("j5_orphans", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def j5_orphans(spark, sf):
    parents = I.table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return J.orphans(I.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), parents, "o_custkey")


@query("j6_exists_check", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def j6_exists_check(spark, sf):
    rows = I.table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return J.exists_check(I.table(spark, sf, "customer").select("c_custkey"), rows, "c_custkey")


# --- writes ------------------------------------------------------------------------------

@query("w1_insert_records", f"""WITH {I.EVENT_SQL}
SELECT 'structured' AS side, CASE WHEN late THEN NULL ELSE 'yes' END AS legacy, CASE WHEN late THEN 'True' END AS coupon,
       COUNT(*) AS rows, CAST(SUM(event_id) AS BIGINT) AS ids, false AS has_k FROM ev WHERE late GROUP BY 2, 3
UNION ALL SELECT 'structured', 'yes', NULL, COUNT(*), CAST(SUM(event_id) AS BIGINT), true FROM ev WHERE NOT late
UNION ALL SELECT 'documents', NULL, NULL, COUNT(*), NULL, late FROM ev GROUP BY late""")
def w1_insert_records(spark, sf):
    from ..operators.records import assign_uuid
    from ..operators.route import route_records

    early, late = (I.event_records(spark, sf, p) for p in ("early", "late"))
    first = decide_targets(field_profile(early))
    second = decide_targets(field_profile(late), first)
    stored = route_records(assign_uuid(early), first)
    structured, documents = W.insert_records(stored.structured, stored.documents, assign_uuid(late), second)
    rows = structured.groupBy("legacy", F.initcap(F.col("coupon").cast("string")).alias("coupon"), F.col("k").isNotNull().alias("has_k")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids")).withColumn("side", F.lit("structured"))
    docs = documents.groupBy(F.map_contains_key("doc", "k").alias("has_k")).agg(F.count(F.lit(1)).alias("rows"))
    none = F.lit(None).cast("string")
    return rows.select("side", "legacy", "coupon", "rows", "ids", "has_k").unionByName(docs.select(
        F.lit("documents").alias("side"), none.alias("legacy"), none.alias("coupon"), "rows",
        F.lit(None).cast("bigint").alias("ids"), "has_k"))


@query("w2_update_where", f"""WITH {_ACCOUNT}
SELECT uuid, CASE WHEN segment = 'BUILDING' THEN 'CLOSED' ELSE segment END AS segment,
       CASE WHEN segment = 'BUILDING' THEN 'checked' END AS note, (SELECT COUNT(*) FROM acct WHERE segment = 'BUILDING') AS affected FROM acct""")
def w2_update_where(spark, sf):
    accounts = I.customer_accounts(spark, sf).select("uuid", "segment")
    docs = accounts.select("uuid", F.create_map(F.lit("uuid"), F.col("uuid").cast("variant")).alias("doc"))
    done = W.update_where(accounts, docs, {"segment": "BUILDING"}, {"segment": "CLOSED", "note": "checked"},
                          {"segment": "SQL", "note": "MONGO"})
    note = done.documents.select("uuid", F.try_variant_get(F.try_element_at("doc", F.lit("note")), "$", "string").alias("note"))
    return done.structured.join(note, "uuid").withColumn("affected", done.affected.scalar())


@query("w2_update_by_either_side", f"""WITH {_ACCOUNT}, hit AS (SELECT uuid FROM acct WHERE segment IN ('BUILDING', 'MACHINERY') AND nation = 3)
SELECT uuid, CASE WHEN uuid IN (FROM hit) THEN NULL ELSE balance END AS balance, CASE WHEN uuid IN (FROM hit) THEN 'unknown' END AS doc_balance,
       (SELECT COUNT(*) FROM hit) AS affected FROM acct""")
def w2_update_by_either_side(spark, sf):
    """Two conditions, one on a column and one on a document field; the new text does not fit the number column."""
    accounts = I.customer_accounts(spark, sf)
    docs = accounts.select("uuid", F.create_map(F.lit("nation"), F.col("nation").cast("variant")).alias("doc"))
    done = W.update_where(accounts.select("uuid", "segment", "balance"), docs, {"segment": {"$in": ["BUILDING", "MACHINERY"]}, "nation": 3},
                          {"balance": "unknown"}, {"balance": "SQL"})
    text = F.try_variant_get(F.try_element_at("doc", F.lit("balance")), "$", "string").alias("doc_balance")
    return done.structured.select("uuid", "balance").join(done.documents.select("uuid", text), "uuid").withColumn("affected", done.affected.scalar())


def _split_events(spark, sf):
    """Events routed by what the early ones taught: ``k`` is an integer column, and the texts of late errors stay in documents."""
    from ..operators.records import assign_uuid
    from ..operators.route import route_records

    decisions = decide_targets(field_profile(I.event_records(spark, sf, "early")))
    return route_records(assign_uuid(I.event_records(spark, sf)), decisions)


@query("w2_update_misfit", f"""WITH {I.EVENT_SQL}
SELECT event_id, CASE WHEN NOT (late AND err) THEN k WHEN k IN (5, 6) THEN -1 END AS k, CASE WHEN late AND err AND k NOT IN (5, 6) THEN CAST(k AS VARCHAR) END AS doc_k,
       (SELECT COUNT(*) FROM ev WHERE late AND err AND k IN (5, 6)) AS affected FROM ev""")
def w2_update_misfit(spark, sf):
    """Records are found by values that their column does not hold, and the new value takes the old one's place."""
    sides = _split_events(spark, sf)
    done = W.update_where(sides.structured, sides.documents, {"k": {"$in": ["5", "6"]}}, {"k": -1}, {"k": "SQL"})
    text = F.try_variant_get(F.try_element_at("doc", F.lit("k")), "$", "string").alias("doc_k")
    return done.structured.select("uuid", "event_id", "k").join(done.documents.select("uuid", text), "uuid").select(
        "event_id", "k", "doc_k").withColumn("affected", done.affected.scalar())


@query("q1_filter_either_side", f"""WITH {I.EVENT_SQL}, t AS (SELECT *, late AND err AS is_text FROM ev)
SELECT 'equal' AS test, event_id FROM t WHERE CASE WHEN is_text THEN k = 5 ELSE k = 7 END
UNION ALL SELECT 'range', event_id FROM t WHERE NOT is_text AND k >= 90.5 AND event_type <> 'view'
UNION ALL SELECT 'text', event_id FROM t WHERE is_text AND CAST(k AS VARCHAR) > '95'
UNION ALL SELECT 'not', event_id FROM t WHERE event_type = 'error' AND (is_text OR k <> 5)""")
def q1_filter_either_side(spark, sf):
    sides = _split_events(spark, sf)
    specs = {"equal": {"k": {"$in": ["5", 7, 2.5]}}, "range": {"k": {"$gte": 90.5}, "event_type": {"$ne": "view"}}, "text": {"k": {"$gt": "95"}},
             "not": {"event_type": "error", "k": {"$ne": 5}}}
    out = None
    for name, spec in specs.items():
        rows = Q.filter_records(sides.structured, sides.documents, spec).select(F.lit(name).alias("test"), "event_id")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("w2_update_stored", f"""WITH {_ACCOUNT}, hit AS (SELECT uuid FROM acct WHERE segment = 'BUILDING' AND nation IN (3, 4))
SELECT uuid, CASE WHEN uuid IN (FROM hit) THEN NULL ELSE balance END AS balance, CASE WHEN uuid IN (FROM hit) THEN 'unknown' END AS doc_balance FROM acct""")
def w2_update_stored(spark, sf):
    """Stored sides in buckets: the buckets of the hit records are rewritten."""
    accounts = I.customer_accounts(spark, sf)
    docs = accounts.select("uuid", F.create_map(F.lit("nation"), F.col("nation").cast("variant")).alias("doc"))
    base = work_folder(spark, "buckets")
    write_buckets(accounts.select("uuid", "segment", "balance"), f"{base}/structured")
    write_buckets(docs, f"{base}/documents")
    update_stored(spark, f"{base}/structured", f"{base}/documents", {"segment": "BUILDING", "nation": {"$in": [3, 4]}}, {"balance": "unknown"}, {"balance": "SQL"})
    text = F.try_variant_get(F.try_element_at("doc", F.lit("balance")), "$", "string").alias("doc_balance")
    return read_buckets(spark, f"{base}/structured").select("uuid", "balance").join(read_buckets(spark, f"{base}/documents").select("uuid", text), "uuid")


@query("w3_delete_by_either_side", f"""WITH {_ACCOUNT}, hit AS (SELECT uuid FROM acct WHERE segment = 'BUILDING' AND nation IN (1, 2, 3, 4, 5))
SELECT 'root' AS "table", (SELECT COUNT(*) FROM hit) AS deleted, (SELECT COUNT(*) FROM acct) - (SELECT COUNT(*) FROM hit) AS kept
UNION ALL SELECT 'documents', (SELECT COUNT(*) FROM hit), (SELECT COUNT(*) FROM acct) - (SELECT COUNT(*) FROM hit)""")
def w3_delete_by_either_side(spark, sf):
    accounts = I.customer_accounts(spark, sf)
    docs = accounts.select("uuid", F.create_map(F.lit("nation"), F.col("nation").cast("variant")).alias("doc"))
    tables = {"root": accounts.select("uuid", "segment"), "documents": docs}
    done = W.delete_ids(tables, "root", docs, {"segment": "BUILDING", "nation": {"$in": [1, 2, 3, 4, 5]}}, [("documents", "uuid", "root", "uuid")])
    kept = None
    for name, df in done.tables.items():
        n = df.agg(F.count(F.lit(1)).alias("kept")).select(F.lit(name).alias("table"), "kept")
        kept = n if kept is None else kept.unionByName(n)
    return done.counts.join(kept, "table")


_CASCADE = [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey")]


def _cascade_tables(spark, sf):
    return {n: I.table(spark, sf, n) for n in ("customer", "orders", "lineitem")}


@query("w3_delete_where", """
WITH dc AS (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE')),
dord AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (FROM dc)),
dl AS (SELECT l_orderkey FROM lineitem WHERE l_orderkey IN (FROM dord))
SELECT 'customer' AS "table", (SELECT COUNT(*) FROM dc) AS deleted, (SELECT COUNT(*) FROM customer) - (SELECT COUNT(*) FROM dc) AS kept
UNION ALL SELECT 'orders', (SELECT COUNT(*) FROM dord), (SELECT COUNT(*) FROM orders) - (SELECT COUNT(*) FROM dord)
UNION ALL SELECT 'lineitem', (SELECT COUNT(*) FROM dl), (SELECT COUNT(*) FROM lineitem) - (SELECT COUNT(*) FROM dl)""")
def w3_delete_where(spark, sf):
    condition = structured_filter({"c_mktsegment": {"$in": ["BUILDING", "FURNITURE"]}})
    done = W.delete_where(_cascade_tables(spark, sf), "customer", condition, _CASCADE)
    kept = None
    for name, df in done.tables.items():
        n = df.agg(F.count(F.lit(1)).alias("kept")).select(F.lit(name).alias("table"), "kept")
        kept = n if kept is None else kept.unionByName(n)
    return done.counts.join(kept, "table")


@query("w4_delete_by_id", """
SELECT 'customer' AS "table", COUNT(*) AS deleted, 'success' AS status FROM customer WHERE c_custkey = 7
UNION ALL SELECT 'orders', COUNT(*), 'success' FROM orders WHERE o_custkey = 7
UNION ALL SELECT 'lineitem', COUNT(*), 'success' FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey = 7)
UNION ALL SELECT t, CAST(0 AS BIGINT), '404' FROM (VALUES ('customer'), ('orders'), ('lineitem')) v(t)""")
def w4_delete_by_id(spark, sf):
    tables = _cascade_tables(spark, sf)
    found = W.delete_by_id(tables, "customer", "c_custkey", 7, _CASCADE).counts
    return found.unionByName(W.delete_by_id(tables, "customer", "c_custkey", -1, _CASCADE).counts)


@query("w5_validate_unique", """
WITH b AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P'),
st AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'),
n AS (SELECT o_custkey, COUNT(*) AS n FROM b GROUP BY 1)
SELECT o_orderkey, o_custkey, CASE WHEN o_custkey IN (FROM st) THEN 'already stored' ELSE 'repeated in batch' END AS reason
FROM b JOIN n USING (o_custkey) WHERE n > 1 OR o_custkey IN (FROM st)""")
def w5_validate_unique(spark, sf):
    orders = I.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    batch = orders.filter("o_orderstatus = 'P'").drop("o_orderstatus")
    return W.validate_unique(batch, orders.filter("o_orderstatus = 'F'"), "o_custkey")


@query("w6_idempotent_append", """
SELECT o_custkey, MIN(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus = 'P'
  AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') GROUP BY o_custkey""")
def w6_idempotent_append(spark, sf):
    orders = I.table(spark, sf, "orders")
    batch = orders.filter("o_orderstatus = 'P'").select("o_custkey", "o_orderkey")
    stored = orders.filter("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'").select("o_custkey")
    return W.idempotent_append(stored, batch, ["o_custkey"], "o_orderkey")
