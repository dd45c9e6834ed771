"""Queries over routing, decomposition, shredding and reconstruction."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import walk
from ..functions.values import lookup, type_name
from ..operators import classify as C
from ..operators import profile as P
from ..operators.records import assign_uuid, normalize_keys
from ..operators.route import decompose_large, resolve_references, route_records
from ..operators.shred import (
    child_lists,
    child_rows,
    describe_table,
    lossless_check,
    m2m_catalog,
    rebuild_records,
    reconstruct,
    shred,
    shred_m2m,
    structure_map,
    table_catalog,
    table_info,
    verify_foreign_keys,
)
from ..session import landed
from ..sources.records import read_records
from . import inputs as I
from .registry import query



def _order_routed(spark, sf):
    records = I.order_records(spark, sf)
    decisions = C.decide_targets(P.field_profile(I.order_fields(spark, sf)))
    return route_records(records, decisions)


def _order_uuid(col="o_orderkey"):
    return f"substr(sha256(CAST({col} AS VARCHAR)), 1, 32)"


# --- routing -----------------------------------------------------------------------------

@query("r1_route_structured", f"""WITH {I.ORDER_SQL}
SELECT {_order_uuid()} AS uuid, o_orderkey AS "orderKey", o_orderstatus AS "orderStatus", cents AS "totalCents" FROM o""")
def r1_route_structured(spark, sf):
    return _order_routed(spark, sf).structured.select("uuid", "orderKey", "orderStatus", "totalCents")


@query("r1_route_documents", f"""WITH {I.ORDER_SQL}
SELECT {_order_uuid()} AS uuid, 'customer,payments,tags,uuid' AS keys, CAST(o_custkey AS VARCHAR) AS cust_key, n AS payments,
       o_orderstatus || ',' || o_orderpriority AS tags FROM o""")
def r1_route_documents(spark, sf):
    doc = F.col("doc")
    return _order_routed(spark, sf).documents.select(
        "uuid", F.array_join(F.sort_array(F.map_keys("doc")), ",").alias("keys"),
        F.try_variant_get(doc["customer"], "$.custKey", "string").alias("cust_key"),
        F.size(doc["payments"].cast("array<variant>")).alias("payments"),
        F.array_join(doc["tags"].cast("array<string>"), ",").alias("tags"),
    )


def _documents(spark, sf):
    """Whole documents as (uuid, doc), the uuid being the document id."""
    return I.document_records(spark, sf).select(F.col("rec_id").cast("string").alias("uuid"), F.col("fields").alias("doc"))


_DOC_JSON = """
dj AS (
  SELECT doc_id, text, lang, source, n_chars, quality, toxic,
    length(to_json(struct_pack(lang := lang, n_chars := n_chars, source := source, text := text)))
      + CASE WHEN quality IS NULL THEN 0 ELSE length(',"quality":') + 1 + length(',"toxic":') + 1 END AS size
  FROM d),
moved AS (
  SELECT *, size > 1024 AND length(CAST(to_json(text) AS VARCHAR)) > size * 0.1 AS text_moves FROM dj)"""


@query("r2_decompose_side", f"""WITH {I.DOCUMENT_SQL}, {_DOC_JSON}
SELECT 'decomposed_text' AS collection, CAST(doc_id AS VARCHAR) AS parent_uuid, length(text) AS chars, md5(text) AS digest
FROM moved WHERE text_moves""")
def r2_decompose_side(spark, sf):
    text = F.try_variant_get(F.parse_json("data"), "$", "string")
    return decompose_large(_documents(spark, sf)).side.select(
        "collection", "parent_uuid", F.length(text).alias("chars"), F.md5(text).alias("digest"))


@query("r3_stub_references", f"""WITH {I.DOCUMENT_SQL}, {_DOC_JSON}
SELECT CAST(doc_id AS VARCHAR) AS uuid, lang, CASE WHEN text_moves THEN 'REF::MONGO::decomposed_text::' || doc_id ELSE text END AS text
FROM moved""")
def r3_stub_references(spark, sf):
    return decompose_large(_documents(spark, sf)).documents.select(
        "uuid", F.col("doc")["lang"].cast("string").alias("lang"), F.col("doc")["text"].cast("string").alias("text"))


@query("r4_resolve_references", """
SELECT CAST(doc_id AS VARCHAR) AS uuid, md5(text) AS text_digest, n_chars, source FROM documents""")
def r4_resolve_references(spark, sf):
    parts = decompose_large(_documents(spark, sf))
    back = resolve_references(parts.documents, parts.side).documents
    doc = F.col("doc")
    return back.select(
        "uuid", F.md5(doc["text"].cast("string")).alias("text_digest"), doc["n_chars"].cast("bigint").alias("n_chars"),
        doc["source"].cast("string").alias("source"))


@query("r4_resolve_as_list", f"""WITH {I.DOCUMENT_SQL}, {_DOC_JSON}
SELECT CAST(doc_id AS VARCHAR) AS uuid, CASE WHEN text_moves THEN 'list' ELSE 'str' END AS kind,
       CASE WHEN text_moves THEN 1 END AS payloads FROM moved""")
def r4_resolve_as_list(spark, sf):
    parts = decompose_large(_documents(spark, sf))
    back = resolve_references(parts.documents, parts.side, unwrap=False).documents
    value = F.try_element_at("doc", F.lit("text"))
    return back.select("uuid", type_name(value).alias("kind"),
                       F.array_size(F.try_variant_get(value, "$", "array<variant>")).alias("payloads"))


@query("r4_user_text_like_a_stub", """
SELECT CAST(doc_id AS VARCHAR) AS uuid, md5(text) AS text_digest, 'REF::MONGO::notes::' || doc_id AS note, 'REF::MONGO::x::y' AS inner_note FROM documents""")
def r4_user_text_like_a_stub(spark, sf):
    """Texts of users that look like references survive, while the marked ones are resolved."""
    note = F.concat(F.lit("REF::MONGO::notes::"), F.col("uuid")).cast("variant")
    inner = F.parse_json(F.lit('{"note": "REF::MONGO::x::y"}'))
    docs = _documents(spark, sf).select("uuid", F.map_concat("doc", F.create_map(F.lit("note"), note, F.lit("inner"), inner)).alias("doc"))
    parts = decompose_large(docs, mark=True)
    back = resolve_references(parts.documents, parts.side, nested=True).documents
    at = lambda field, path="$": F.try_variant_get(F.col("doc")[field], path, "string")
    return back.select("uuid", F.md5(at("text")).alias("text_digest"), at("note").alias("note"), at("inner", "$.note").alias("inner_note"))


@query("r5_resolve_nested", """
SELECT CAST(page_id AS VARCHAR) AS uuid, md5(html) AS in_object, md5(html) AS in_list_object,
       'REF::MONGO::decomposed_html::' || page_id AS in_list, 'REF::MONGO::broken' AS malformed, '[]' AS missing FROM pages""")
def r5_resolve_nested(spark, sf):
    pages = I.table(spark, sf, "pages").withColumn("uuid", F.col("page_id").cast("string"))
    side = pages.select(
        F.lit("decomposed_html").alias("collection"), F.col("uuid").alias("parent_uuid"),
        F.to_json(F.col("html").cast("variant")).alias("data"))
    stub = F.concat(F.lit("REF::MONGO::decomposed_html::"), F.col("uuid"))
    shape = F.to_json(F.struct(
        F.struct(stub.alias("html")).alias("body"), F.array(F.struct(stub.alias("html"))).alias("parts"),
        F.array(stub).alias("plain"),
        F.struct(F.lit("REF::MONGO::broken").alias("a"), F.lit("REF::MONGO::decomposed_none::x").alias("b")).alias("odd"),
    ))
    docs = pages.select("uuid", F.from_json(shape, "map<string,variant>").alias("doc"))
    back = resolve_references(docs, side, nested=True).documents
    at = lambda field, path, t="string": F.try_variant_get(F.col("doc")[field], path, t)
    return back.select(
        "uuid", F.md5(at("body", "$.html")).alias("in_object"), F.md5(at("parts", "$[0].html")).alias("in_list_object"),
        at("plain", "$[0]").alias("in_list"), at("odd", "$.a").alias("malformed"), F.to_json(at("odd", "$.b", "variant")).alias("missing"))


# --- shredding and reconstruction --------------------------------------------------------

@query("d1_shred", f"""WITH {I.ORDER_SQL}
SELECT 'root' AS "table", 0 AS depth, CAST(NULL AS VARCHAR) AS parent_table, 0 AS pos, o_orderkey AS a, o_orderstatus AS b, cents AS c FROM o
UNION ALL SELECT 'root_payments', 1, 'root', CAST(pay_no - 1 AS INT), pay_no, NULL, amount FROM pay
UNION ALL SELECT 'root_payments_entries', 2, 'root_payments', CASE entry_code WHEN 'net' THEN 0 ELSE 1 END, NULL, entry_code, cents FROM entry""")
def d1_shred(spark, sf):
    f = lambda n, t: F.try_variant_get(F.try_element_at("fields", F.lit(n)), "$", t)
    return shred(I.order_records(spark, sf)).select(
        "table", "depth", "parent_table", "pos", F.coalesce(f("order_key", "bigint"), f("pay_no", "bigint")).alias("a"),
        F.coalesce(f("order_status", "string"), f("entry_code", "string")).alias("b"),
        F.coalesce(f("total_cents", "bigint"), f("amount_cents", "bigint"), f("cents", "bigint")).alias("c"))


@query("d1_shred_links", f"""WITH {I.ORDER_SQL}
SELECT "table", rows, rows AS distinct_ids, parents FROM (
 SELECT 'root' AS "table", COUNT(*) AS rows, CAST(0 AS BIGINT) AS parents FROM o
 UNION ALL SELECT 'root_payments', COUNT(*), COUNT(DISTINCT o_orderkey) FROM pay
 UNION ALL SELECT 'root_payments_entries', COUNT(*), COUNT(DISTINCT (o_orderkey, pay_no)) FROM entry)""")
def d1_shred_links(spark, sf):
    rows = landed(shred(I.order_records(spark, sf)).select("table", "uuid", "parent_table", "parent_id"), "rows")
    ids = rows.groupBy("table", "uuid").agg(F.count(F.lit(1)).alias("n"))
    per = ids.groupBy("table").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_ids"))
    parents = rows.filter(F.col("parent_id").isNotNull()).select("table", "parent_table", "parent_id").distinct()
    # Every foreign key must point at an existing parent row of the right table.
    found = parents.join(
        rows.select(F.col("table").alias("parent_table"), F.col("uuid").alias("parent_id")), ["parent_table", "parent_id"],
        "left_semi").groupBy("table").agg(F.count(F.lit(1)).alias("parents"))
    return per.join(found, "table", "left").select(
        "table", "rows", "distinct_ids", F.coalesce("parents", F.lit(0).cast("bigint")).alias("parents"))


@query("d2_flatten_object", """
SELECT o_orderkey AS rec_id, CAST(o_custkey AS VARCHAR) AS customer_cust_key, o_orderpriority AS customer_order_priority,
       'customer_cust_key,customer_order_priority,order_key,order_status,total_cents' AS columns FROM orders""")
def d2_flatten_object(spark, sf):
    flat = I.order_fields(spark, sf).select("rec_id", walk.flat_fields(F.col("fields")).alias("f"))
    return flat.select(
        "rec_id", F.col("f")["customer_cust_key"].cast("string").alias("customer_cust_key"),
        F.col("f")["customer_order_priority"].cast("string").alias("customer_order_priority"),
        F.array_join(F.sort_array(F.map_keys("f")), ",").alias("columns"))


@query("d3_m2m_dimension", """
SELECT DISTINCT 'tag' AS dimension, name, substr(sha256('tag|' || name), 1, 32) AS id FROM (
  SELECT o_orderstatus AS name FROM orders UNION SELECT o_orderpriority FROM orders)""")
def d3_m2m_dimension(spark, sf):
    dimensions, _ = shred_m2m(I.order_records(spark, sf))
    return dimensions


@query("d3_m2m_junction", f"""
SELECT 'root_tags' AS junction, {_order_uuid()} AS entity_id, 'tag' AS dimension, substr(sha256('tag|' || name), 1, 32) AS dimension_id, pos
FROM (SELECT o_orderkey, o_orderstatus AS name, 0 AS pos FROM orders UNION ALL SELECT o_orderkey, o_orderpriority, 1 FROM orders)""")
def d3_m2m_junction(spark, sf):
    _, junctions = shred_m2m(I.order_records(spark, sf))
    return junctions


@query("d3_m2m_embeddings", """
SELECT 'root_embedding' AS junction, COUNT(*) AS pairs, COUNT(DISTINCT vec_id) AS entities FROM (
  SELECT vec_id, unnest(embedding) AS x FROM embeddings)""")
def d3_m2m_embeddings(spark, sf):
    raw = I.spread(I.table(spark, sf, "embeddings")).select("vec_id", F.to_json(F.struct("embedding", "label")).alias("raw"))
    _, junctions = shred_m2m(assign_uuid(read_records(raw, "raw", "vec_id").records))
    ids = junctions.groupBy("junction", "entity_id").agg(F.count(F.lit(1)).alias("n"))
    return ids.groupBy("junction").agg(F.sum("n").alias("pairs"), F.count(F.lit(1)).alias("entities"))


@query("d4_table_catalog", """
SELECT t AS "table", c AS "column", y AS type, r AS role, f AS "references", c = 'uuid' AS is_unique FROM (VALUES
 ('root','uuid','VARCHAR(36)','primary_key',NULL),('root','order_key','BIGINT','column',NULL),
 ('root','order_status','VARCHAR(255)','column',NULL),('root','total_cents','BIGINT','column',NULL),
 ('root','customer_cust_key','BIGINT','column',NULL),('root','customer_order_priority','VARCHAR(255)','column',NULL),
 ('root_payments','uuid','VARCHAR(36)','primary_key',NULL),('root_payments','root_id','VARCHAR(36)','foreign_key','root'),
 ('root_payments','pay_no','BIGINT','column',NULL),('root_payments','amount_cents','BIGINT','column',NULL),
 ('root_payments_entries','uuid','VARCHAR(36)','primary_key',NULL),
 ('root_payments_entries','root_payments_id','VARCHAR(36)','foreign_key','root_payments'),
 ('root_payments_entries','entry_code','VARCHAR(255)','column',NULL),('root_payments_entries','cents','BIGINT','column',NULL)
) v(t, c, y, r, f) WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderstatus IN ('F','O'))""")
def d4_table_catalog(spark, sf):
    return table_catalog(landed(shred(I.order_records(spark, sf)).select("table", "parent_table", "fields"), "rows"))


@query("d4_m2m_catalog", """
SELECT t AS "table", c AS "column", y AS type, r AS role, f AS "references", t = 'tag' AS is_unique FROM (VALUES
 ('tag','tag_id','VARCHAR(36)','primary_key',NULL),('tag','tag_name','VARCHAR(255)','column',NULL),
 ('root_tags','root_id','VARCHAR(36)','primary_key','root'),('root_tags','tag_id','VARCHAR(36)','primary_key','tag')
) v(t, c, y, r, f) WHERE EXISTS (SELECT 1 FROM orders)""")
def d4_m2m_catalog(spark, sf):
    return m2m_catalog(*shred_m2m(I.order_records(spark, sf)))


_LINKS = [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"),
          ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("customer", "c_nationkey", "nation", "n_nationkey"),
          ("labels", "doc_id", "documents", "doc_id"), ("events", "user_id", "nation", "n_nationkey")]


@query("d5_verify_foreign_keys", " UNION ALL ".join(
    f"SELECT '{c}' AS child, '{fk}' AS fk, '{p}' AS parent, COUNT(*) AS child_rows, "
    f"COUNT(*) FILTER (WHERE {fk} NOT IN (SELECT {k} FROM {p})) AS orphans FROM {c}" for c, fk, p, k in _LINKS))
def d5_verify_foreign_keys(spark, sf):
    names = {n for link in _LINKS for n in (link[0], link[2])}
    return verify_foreign_keys({n: I.table(spark, sf, n) for n in names}, _LINKS)


@query("d6_reconstruct", """
WITH li AS (SELECT l_orderkey, COUNT(*) AS n, CAST(SUM(l_partkey) AS BIGINT) AS parts FROM lineitem GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) AS uuid, o_custkey AS cust, 'from document' AS status, o_orderpriority AS priority,
       CAST(COALESCE(n, 0) AS INT) AS items, COALESCE(parts, 0) AS item_parts
FROM orders LEFT JOIN li ON l_orderkey = o_orderkey""")
def d6_reconstruct(spark, sf):
    orders = I.table(spark, sf, "orders").withColumn("uuid", F.col("o_orderkey").cast("string"))
    root = orders.select("uuid", F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status"))
    docs = orders.select("uuid", F.create_map(
        F.lit("status"), F.lit("from document").cast("variant"), F.lit("priority"), F.col("o_orderpriority").cast("variant"),
    ).alias("doc"))
    items = I.spread(I.table(spark, sf, "lineitem")).select(
        F.col("l_orderkey").cast("string").alias("uuid"), "l_linenumber", "l_partkey", "l_quantity")
    lists = {"root_items": child_lists(items, "uuid", "items", ["l_linenumber", "l_partkey"])}
    made = reconstruct(root, "uuid", docs, lists)
    record = F.parse_json("record")
    parsed = F.from_json("items", "array<struct<l_partkey:bigint>>")
    return made.select(
        "uuid", F.try_variant_get(record, "$.cust", "bigint").alias("cust"),
        F.try_variant_get(record, "$.status", "string").alias("status"),
        F.try_variant_get(record, "$.priority", "string").alias("priority"),
        F.size(parsed).alias("items"),
        F.aggregate(parsed, F.lit(0).cast("bigint"), lambda acc, i: acc + i["l_partkey"]).alias("item_parts"))


@query("d6_reconstruct_all_depths", f"""WITH {I.ORDER_SQL}, e AS (SELECT o_orderkey, COUNT(*) AS entries, CAST(SUM(cents) AS BIGINT) AS cents FROM entry GROUP BY 1)
SELECT o.o_orderkey, o.cents AS total_cents, CAST(n AS INT) AS payments, COALESCE(entries, 0) AS entries, COALESCE(e.cents, 0) AS paid
FROM o LEFT JOIN e USING (o_orderkey)""")
def d6_reconstruct_all_depths(spark, sf):
    rebuilt = rebuild_records(landed(shred(I.order_records(spark, sf)), "rows"))
    kids = F.from_json(
        F.coalesce(F.to_json(F.try_element_at("fields", F.lit("payments"))), F.lit("[]")),
        "array<struct<entries:array<struct<cents:bigint>>>>")
    entries = F.flatten(F.transform(kids, lambda k: k["entries"]))
    return rebuilt.select(
        F.col("fields")["orderKey"].cast("bigint").alias("o_orderkey"),
        F.col("fields")["totalCents"].cast("bigint").alias("total_cents"), F.size(kids).alias("payments"),
        F.size(entries).cast("bigint").alias("entries"),
        F.aggregate(entries, F.lit(0).cast("bigint"), lambda acc, k: acc + k["cents"]).alias("paid"))


@query("d6_child_rows", """
SELECT c_mktsegment AS uuid, 'customers' AS child, COUNT(*) AS n, CAST(SUM(c_custkey) AS BIGINT) AS keys, MIN(c_custkey) AS first FROM customer
WHERE c_mktsegment IS NOT NULL GROUP BY 1
UNION ALL SELECT 'all', 'customers', COUNT(*), CAST(SUM(c_custkey) AS BIGINT), MIN(c_custkey) FROM customer""")
def d6_child_rows(spark, sf):
    """Parents with any number of children, one of them with all of the table's rows."""
    customer = I.table(spark, sf, "customer")
    root = customer.select(F.col("c_mktsegment").alias("uuid")).distinct().unionByName(spark.createDataFrame([("all",)], "uuid string"))
    kids = customer.select(F.col("c_mktsegment").alias("parent"), "c_custkey").unionByName(
        customer.select(F.lit("all").alias("parent"), "c_custkey"))
    rows = child_rows(root, "uuid", {"root_customers": (kids, "parent", ["c_custkey"])})
    key = F.get_json_object("data", "$.c_custkey").cast("bigint")
    return rows.groupBy("uuid", "child").agg(F.count(F.lit(1)).alias("n"), F.sum(key).alias("keys"), F.min(key).alias("first"))


@query("d7_lossless_check", """
SELECT f AS field, n AS records_before, n AS records_after, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS extra
FROM (SELECT COUNT(*) AS n FROM orders), (VALUES ('orderKey'), ('orderStatus'), ('totalCents'), ('customer'), ('payments'), ('tags'), ('uuid')) v(f)""")
def d7_lossless_check(spark, sf):
    source = landed(I.order_records(spark, sf).select("uuid", "fields"), "source", compact=True)
    return lossless_check(source, rebuild_records(landed(shred(source), "rows", compact=True)))


@query("d7_planted_loss", """
SELECT 'payments' AS field, COUNT(*) AS records_before, COUNT(*) AS records_after,
       COUNT(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS missing, COUNT(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS extra FROM orders
UNION ALL SELECT 'tags', COUNT(*), 0, COUNT(*), 0 FROM orders""")
def d7_planted_loss(spark, sf):
    """The second entry of every payment and all tags are lost on the way; the check says so."""
    source = landed(I.order_records(spark, sf).select("uuid", "fields"), "source", compact=True)
    rows = shred(source).filter((F.col("depth") < 2) | (F.col("pos") == 0)).withColumn(
        "rest", F.map_filter("rest", lambda k, v: k != "tags"))
    return lossless_check(source, rebuild_records(landed(rows, "rows", compact=True))).filter("missing > 0 OR extra > 0")


def _odd_shapes(spark, sf):
    """Orders with the shapes that tables cannot hold: mixed and null-led lists, lists of lists, empty values, clashing names."""
    key, status = F.col("o_orderkey"), F.to_json(F.struct("o_orderstatus"))
    raw = F.concat(
        F.lit('{"k": '), key, F.lit(', "mixed": [{"a": '), key, F.lit('}, 5, null], "led": [null, "b"], "grid": [[1], [2, {"x": '), key,
        F.lit('}]], "none": [], "void": {}, "null": null, "obj": {"in": '), status, F.lit(', "camelCase": 1}, "obj_in": '), key,
        F.lit(', "deepList": [{"items": [{"subItems": [{"q": '), key, F.lit('}, {"q": 1.50}], "empty": []}]}]}'))
    orders = I.spread(I.table(spark, sf, "orders")).select("o_orderkey", raw.alias("raw"))
    return assign_uuid(read_records(orders, "raw", "o_orderkey").records).select("uuid", "fields")


@query("d7_odd_shapes", """
SELECT f AS field, n AS records_before, n AS records_after, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS extra
FROM (SELECT COUNT(*) AS n FROM orders), (VALUES ('k'), ('mixed'), ('led'), ('grid'), ('none'), ('void'), ('null'), ('obj'), ('obj_in'), ('deep_list'), ('uuid')) v(f)""")
def d7_odd_shapes(spark, sf):
    source = landed(normalize_keys(_odd_shapes(spark, sf)).select("uuid", "fields"), "source", compact=True)
    return lossless_check(source, rebuild_records(landed(shred(source), "rows", compact=True)))


@query("d1_deep_levels", """
SELECT depth, COUNT(*) AS rows, CAST(SUM(o_orderkey) AS BIGINT) AS keys FROM orders, unnest(range(0, 16)) AS t(depth) GROUP BY 1""")
def d1_deep_levels(spark, sf):
    """Fifteen lists within lists: a row for each level, none cut off."""
    key = F.col("o_orderkey").cast("string")
    nested = F.concat(F.lit('{"k": '), key, F.lit("}"))
    for _ in range(15):
        nested = F.concat(F.lit('{"k": '), key, F.lit(', "l": ['), nested, F.lit("]}"))
    orders = I.spread(I.table(spark, sf, "orders")).select("o_orderkey", nested.alias("raw"))
    rows = shred(assign_uuid(read_records(orders, "raw", "o_orderkey").records))
    return rows.groupBy("depth").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("fields")["k"].cast("bigint")).alias("keys"))


@query("r4_crowded_reference", """
SELECT source AS uuid, COUNT(*) AS payloads, CAST(SUM(doc_id) AS BIGINT) AS ids, MIN(pos) AS first, MAX(pos) + 1 AS last, 'REF::MONGO::c::' || source AS left_in_place
FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY CAST(doc_id AS VARCHAR)) - 1 AS pos FROM documents) GROUP BY 1""")
def r4_crowded_reference(spark, sf):
    """References with any number of payloads: they come as rows, whatever their number."""
    documents = I.table(spark, sf, "documents")
    side = documents.select(F.lit("c").alias("collection"), F.col("source").alias("parent_uuid"), F.col("doc_id").cast("string").alias("data"))
    stub = F.concat(F.lit("REF::MONGO::c::"), "source")
    docs = documents.select("source").distinct().select(
        F.col("source").alias("uuid"), F.create_map(F.lit("docs"), stub.cast("variant")).alias("doc"))
    out = resolve_references(docs, side, lists=False)
    rows = out.payloads.groupBy("uuid").agg(
        F.count(F.lit(1)).alias("payloads"), F.sum(F.col("data").cast("bigint")).alias("ids"),
        F.min("pos").cast("bigint").alias("first"), (F.max("pos") + 1).cast("bigint").alias("last"))
    return rows.join(out.documents.select("uuid", F.col("doc")["docs"].cast("string").alias("left_in_place")), "uuid")


@query("r4_list_of_payloads", """
SELECT source AS uuid, CAST(COUNT(*) AS INT) AS payloads, CAST(SUM(doc_id) AS BIGINT) AS ids FROM documents GROUP BY 1 HAVING COUNT(*) > 1
UNION ALL SELECT source, 1, doc_id FROM documents QUALIFY COUNT(*) OVER (PARTITION BY source) = 1""")
def r4_list_of_payloads(spark, sf):
    """The same references with their payloads in the document, none left out."""
    documents = I.table(spark, sf, "documents")
    side = documents.select(F.lit("c").alias("collection"), F.col("source").alias("parent_uuid"), F.col("doc_id").cast("string").alias("data"))
    stub = F.concat(F.lit("REF::MONGO::c::"), "source")
    docs = documents.select("source").distinct().select(
        F.col("source").alias("uuid"), F.create_map(F.lit("docs"), stub.cast("variant")).alias("doc"))
    held = F.from_json(F.to_json(F.col("doc")["docs"]), "array<bigint>")
    return resolve_references(docs, side, unwrap=False).documents.select(
        "uuid", F.size(held).alias("payloads"), F.aggregate(held, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("ids"))


@query("r3_stub_escapes", """
SELECT CAST(page_id AS VARCHAR) || '::%3A' AS uuid, md5(html) AS digest, 'REF::MONGO::decomposed_a%3A%3Ab::' || page_id || '%3A%3A%253A' AS stub FROM pages""")
def r3_stub_escapes(spark, sf):
    """Field names and ids that hold the separator still decompose and resolve."""
    pages = I.table(spark, sf, "pages")
    pad = F.repeat(F.lit("x"), 100)
    docs = pages.select(
        F.concat(F.col("page_id").cast("string"), F.lit("::%3A")).alias("uuid"), "html",
        F.create_map(F.lit("a::b"), F.concat("html", F.repeat(pad, 20)).cast("variant")).alias("doc"))
    parts = decompose_large(docs.select("uuid", "doc"), F.lit("2024-01-01").cast("timestamp"))
    back = resolve_references(parts.documents, parts.side).documents
    text = F.col("doc")["a::b"].cast("string")
    return back.select("uuid", F.md5(F.substring(text, F.lit(1), F.length(text) - 2000)).alias("digest")).join(
        parts.documents.select("uuid", text.alias("stub")), "uuid")


@query("r1_misfits", """
SELECT CASE event_id % 4 WHEN 0 THEN 'int' WHEN 1 THEN 'text' WHEN 2 THEN 'fraction' ELSE 'list' END AS kind,
       COUNT(*) AS rows, COUNT(*) FILTER (WHERE event_id % 4 = 0) AS in_column, COUNT(*) FILTER (WHERE event_id % 4 <> 0) AS in_document,
       CAST(0 AS BIGINT) AS lost FROM events GROUP BY 1""")
def r1_misfits(spark, sf):
    """Texts, fractions and lists in a field decided as an integer column: split, merge, and compare with the source."""
    e = F.col("event_id")
    value = (F.when(e % 4 == 0, e.cast("string")).when(e % 4 == 1, F.concat(F.lit('"t'), e, F.lit('"')))
             .when(e % 4 == 2, F.concat(e, F.lit(".5"))).otherwise(F.concat(F.lit("["), e, F.lit("]"))))
    raw = I.spread(I.table(spark, sf, "events")).select("event_id", F.concat(F.lit('{"x": '), value, F.lit("}")).alias("raw"))
    source = assign_uuid(read_records(raw, "raw", "event_id").records)
    decisions = spark.createDataFrame([("x", "SQL", "INT")], "field string, target string, sql_type string")
    parts = route_records(source, decisions)
    merged = reconstruct(parts.structured.select("uuid", "x"), "uuid", parts.documents)
    kind = lookup({"int": "int", "str": "text", "float": "fraction", "list": "list"}, type_name(F.col("fields")["x"]))
    whole = source.select("uuid", kind.alias("kind"), F.to_json(F.col("fields")["x"]).alias("before"))
    again = merged.select("uuid", F.to_json(F.try_variant_get(F.parse_json("record"), "$.x", "variant")).alias("after"))
    column = parts.structured.select("uuid", F.col("x").isNotNull().cast("long").alias("c"))
    document = parts.documents.select("uuid", F.map_contains_key("doc", "x").cast("long").alias("d"))
    # Every side holds a row per record: shuffle them, never broadcast one through the driver.
    return whole.join(again.hint("merge"), "uuid", "left").join(column.hint("merge"), "uuid").join(
        document.hint("merge"), "uuid").groupBy("kind").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("c").alias("in_column"), F.sum("d").alias("in_document"),
        F.count(F.when(~F.col("before").eqNullSafe(F.col("after")), 1)).alias("lost"))


_CUSTOMER_COLUMNS = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                     ("c_mktsegment", "string")]


@query("d8_describe_table", " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS type, COUNT(*) AS rows, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    f"COUNT(*) FILTER (WHERE {c} IS NULL) > 0 AS nullable FROM customer" for i, (c, t) in enumerate(_CUSTOMER_COLUMNS)))
def d8_describe_table(spark, sf):
    return describe_table(I.table(spark, sf, "customer"))


@query("d8_table_info", """
SELECT 'root_payments' AS "table", c AS "column", k AS kind, CASE WHEN k = 'child' THEN 'root_payments_' || c END AS child_table
FROM (VALUES ('payNo','column'),('amountCents','column'),('entries','child')) v(c, k)
WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderstatus IN ('F','O'))""")
def d8_table_info(spark, sf):
    return table_info(structure_map(I.order_fields(spark, sf)), "root_payments")
