"""Queries over design analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import design as D
from ..operators import normal_forms as NF
from ..operators import profile as P
from ..sources.records import read_records
from . import inputs as I
from .registry import query


@query("a1_repeating_groups", f"""WITH {I.ORDER_SQL}
SELECT 'payments' AS group_name, COUNT(*) AS lists, '1:N' AS cardinality, 'amountCents, entries, payNo' AS attributes,
       round(AVG(n), 6) AS avg_occurrences, CAST(NULL AS VARCHAR) AS values_sample FROM o
UNION ALL SELECT 'tags', COUNT(*), 'M:N', 'tags_value', 2.0, arg_min(o_orderstatus || ', ' || o_orderpriority, o_orderkey) FROM o""")
def a1_repeating_groups(spark, sf):
    return D.repeating_groups(I.order_fields(spark, sf)).withColumn("avg_occurrences", F.round("avg_occurrences", 6))


@query("a2_nesting_paths", f"""WITH {I.ORDER_SQL}
SELECT 'root.payments' AS path, 1 AS level, 'root' AS parent, 'payments' AS child, COUNT(*) AS objects, 'amountCents, entries, payNo' AS attributes FROM pay
UNION ALL SELECT 'root.payments.entries', 2, 'payments', 'entries', COUNT(*), 'cents, entryCode' FROM entry""")
def a2_nesting_paths(spark, sf):
    return D.nesting_paths(I.order_fields(spark, sf))


@query("a2_deepest_level", f"WITH {I.ORDER_SQL} SELECT 2 AS deepest_level, CAST(2 AS BIGINT) AS paths FROM entry HAVING COUNT(*) > 0")
def a2_deepest_level(spark, sf):
    return D.deepest_level(D.nesting_paths(I.order_fields(spark, sf)))


def _fd_sql(table, columns, mode="strict"):
    test = "MAX(d) = 1" if mode == "strict" else "MIN(d) = 1"
    pairs = []
    for x in columns:
        for y in columns:
            if x != y:
                pairs.append(
                    f"""SELECT '{x}' AS determinant, '{y}' AS dependent, COUNT(*) AS num_determinant_values,
                    CAST(SUM(n) AS BIGINT) AS num_samples, round(LEAST(COUNT(*) / SUM(n)::DOUBLE, 0.99), 6) AS confidence
                    FROM (SELECT {x}, COUNT(DISTINCT {y}) + CAST(COUNT(*) > COUNT({y}) AS INT) AS d, COUNT(*) AS n FROM {table}
                    WHERE {x} IS NOT NULL GROUP BY {x}) HAVING {test}""")
    return " UNION ALL ".join(pairs)


_CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("a3_functional_dependencies", _fd_sql("customer", _CUSTOMER))
def a3_functional_dependencies(spark, sf):
    return D.functional_dependencies(I.table(spark, sf, "customer")).withColumn("confidence", F.round("confidence", 6))


@query("a3_dependencies_joined", _fd_sql(
    "(SELECT n_nationkey, n_name, n_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)",
    ["n_nationkey", "n_name", "n_regionkey", "r_name"]))
def a3_dependencies_joined(spark, sf):
    joined = I.table(spark, sf, "nation").join(I.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return D.functional_dependencies(joined, ["n_nationkey", "n_name", "n_regionkey", "r_name"]).withColumn(
        "confidence", F.round("confidence", 6))


_MAYBE = ["doc_id", "lang", "source", "quality", "toxic", "mark", "fixed"]
_MAYBE_SQL = """(SELECT d.doc_id, lang, source, quality, toxic, CASE WHEN quality IS NULL THEN NULL WHEN toxic = 1 THEN 'None' ELSE 'ok' END AS mark,
 CASE WHEN lang = 'en' THEN 1 END AS fixed FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


@query("a3_dependencies_with_nulls", _fd_sql(_MAYBE_SQL, _MAYBE))
def a3_dependencies_with_nulls(spark, sf):
    """NULL is a value of the dependent, unlike any text; NULL determinants say nothing."""
    rows = I.table(spark, sf, "documents").select("doc_id", "lang", "source").join(I.table(spark, sf, "labels"), "doc_id", "left")
    rows = rows.withColumn("mark", F.when(F.col("quality").isNotNull(), F.when(F.col("toxic") == 1, "None").otherwise("ok"))).withColumn(
        "fixed", F.when(F.col("lang") == "en", 1))
    return D.functional_dependencies(rows, _MAYBE).withColumn("confidence", F.round("confidence", 6))


@query("a3_dependencies_any", _fd_sql("lineitem", _LINE, "any"))
def a3_dependencies_any(spark, sf):
    return D.functional_dependencies(I.spread(I.table(spark, sf, "lineitem")), _LINE, mode="any").withColumn(
        "confidence", F.round("confidence", 6))


@query("a4_many_to_many", f"""WITH {I.ORDER_SQL}
SELECT 'tags' AS field, 'tag' AS right_entity, 'tag_id' AS right_key, 'parent_tags' AS junction_table, 'M:N' AS cardinality,
       'str' AS value_type, COUNT(*) AS lists, COUNT(*) * 2 AS pairs FROM o""")
def a4_many_to_many(spark, sf):
    return D.many_to_many(I.order_fields(spark, sf))


def _keys_sql(table, columns):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS field, {i} AS position, COUNT(DISTINCT {c}) AS unique_count, COUNT(*) AS total_count,
        COUNT(*) - COUNT({c}) AS null_count, round(COUNT(DISTINCT {c}) / COUNT(*)::DOUBLE, 6) AS uniqueness_ratio,
        COUNT(DISTINCT {c}) = COUNT(*) AS is_candidate FROM {table}""" for i, c in enumerate(columns))


@query("a5_key_analysis", _keys_sql("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]))
def a5_key_analysis(spark, sf):
    return D.key_analysis(I.table(spark, sf, "orders")).withColumn("uniqueness_ratio", F.round("uniqueness_ratio", 6))


_ENTITY_COLUMNS = {"customer": _CUSTOMER, "documents": ["doc_id", "text", "lang", "source", "n_chars"],
                   "conversations": ["conv_id", "turn", "role"], "supplier": ["s_name", "s_suppkey"]}


def _recommend_sql(table, columns):
    words = "email|username|code|id|identifier|ssn|isbn"
    return f"""SELECT '{table}' AS entity, COALESCE(arg_min(field, CASE WHEN regexp_matches(lower(field), '{words}') THEN 0 ELSE 1000 END + position)
      FILTER (WHERE is_candidate), '{table}_id') AS primary_key,
      CASE WHEN COUNT(*) FILTER (WHERE is_candidate) > 0 THEN 'natural' ELSE 'surrogate' END AS strategy,
      COUNT(*) FILTER (WHERE is_candidate) AS candidates FROM ({_keys_sql(table, columns)})"""


@query("a5_recommend_keys", " UNION ALL ".join(_recommend_sql(t, c) for t, c in _ENTITY_COLUMNS.items()))
def a5_recommend_keys(spark, sf):
    out = None
    for name, columns in _ENTITY_COLUMNS.items():
        one = D.recommend_key(D.key_analysis(I.table(spark, sf, name).select(*columns)), name)
        out = one if out is None else out.unionByName(one)
    return out


@query("a6_first_normal_form", f"""WITH {I.ORDER_SQL}
SELECT 'customer' AS field, COUNT(*) AS count, 'dict' AS detected_type FROM o
UNION ALL SELECT 'payments', COUNT(*), 'list' FROM o UNION ALL SELECT 'tags', COUNT(*), 'list' FROM o""")
def a6_first_normal_form(spark, sf):
    return D.first_normal_form_check(P.field_profile(I.order_fields(spark, sf)))


_CUST_JSON = """to_json(struct_pack("custKey" := o_custkey, "orderPriority" := o_orderpriority))"""


@query("a7_embed_or_reference_object", f"""
SELECT 'customer' AS field, 'EMBED' AS decision, round(AVG(length({_CUST_JSON})), 4) AS avg_size,
  CAST(MAX(length({_CUST_JSON})) AS INT) AS max_size, 1 AS depth, true AS appears_in_all,
  round(COUNT(DISTINCT (o_custkey, o_orderpriority)) / COUNT(*)::DOUBLE, 6) AS cardinality_ratio FROM orders""")
def a7_embed_or_reference_object(spark, sf):
    return D.embed_or_reference_object(I.order_fields(spark, sf)).select(
        "field", "decision", F.round("avg_size", 4).alias("avg_size"), "max_size", "depth", "appears_in_all",
        F.round("cardinality_ratio", 6).alias("cardinality_ratio"))


@query("a7_embed_or_reference_pages", """
SELECT 'page' AS field, CASE WHEN size < 500 THEN 'EMBED' WHEN size > 2000 OR ratio > 0.8 THEN 'REFERENCE' ELSE 'EMBED' END AS decision,
       true AS appears_in_all, round(ratio, 6) AS cardinality_ratio
FROM (SELECT AVG(length(to_json(struct_pack(url := url, html := html)))) AS size, COUNT(DISTINCT (url, html)) / COUNT(*)::DOUBLE AS ratio FROM pages)""")
def a7_embed_or_reference_pages(spark, sf):
    raw = I.spread(I.table(spark, sf, "pages")).select("page_id", F.to_json(F.struct(F.struct("url", "html").alias("page"))).alias("raw"))
    return D.embed_or_reference_object(read_records(raw, "raw", "page_id").records).select(
        "field", "decision", "appears_in_all", F.round("cardinality_ratio", 6).alias("cardinality_ratio"))


@query("a8_embed_or_reference_array", f"""WITH {I.ORDER_SQL}, s AS (
 SELECT o_orderkey, CAST(SUM(length(to_json(struct_pack("entryCode" := entry_code, cents := entry.cents)))) AS BIGINT) AS chars
 FROM entry GROUP BY o_orderkey),
p AS (SELECT o_orderkey, CAST(SUM(length('{{"payNo":,"amountCents":,"entries":[,]}}') + length(CAST(pay_no AS VARCHAR)) + length(CAST(amount AS VARCHAR))) + COUNT(*) - 1 AS BIGINT) AS chars
 FROM pay GROUP BY o_orderkey)
SELECT 'payments' AS field, 'EMBED' AS decision, CASE WHEN MAX(n) > 2 * AVG(n) THEN 'unbounded' ELSE 'bounded' END AS growth_pattern,
  MAX(n) AS max_length, round(AVG(n), 6) AS avg_length, round(AVG(2 + COALESCE(s.chars + p.chars, 0)), 4) AS avg_size, true AS contains_objects
FROM o LEFT JOIN s USING (o_orderkey) LEFT JOIN p USING (o_orderkey)
UNION ALL SELECT 'tags', 'EMBED', 'bounded', 2, 2.0, round(AVG(length(to_json([o_orderstatus, o_orderpriority]))), 4), false FROM o""")
def a8_embed_or_reference_array(spark, sf):
    return D.embed_or_reference_array(I.order_fields(spark, sf)).select(
        "field", "decision", "growth_pattern", "max_length", F.round("avg_length", 6).alias("avg_length"),
        F.round("avg_size", 4).alias("avg_size"), "contains_objects")


@query("a9_nesting_depth", """
SELECT f AS field, d AS depth FROM (VALUES ('orderKey',0),('orderStatus',0),('totalCents',0),('customer',1),('payments',4),('tags',1)) v(f, d)
WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderstatus IN ('F','O'))""")
def a9_nesting_depth(spark, sf):
    return D.nesting_depths(I.order_fields(spark, sf))


@query("a10_design_report", f"""WITH {I.ORDER_SQL}
SELECT 'repeating_group' AS finding, 'payments' AS subject, '1:N amountCents, entries, payNo' AS detail FROM o HAVING COUNT(*) > 0
UNION ALL SELECT 'repeating_group', 'tags', 'M:N tags_value' FROM o HAVING COUNT(*) > 0
UNION ALL SELECT 'nesting', 'root.payments', 'level 1' FROM pay HAVING COUNT(*) > 0
UNION ALL SELECT 'nesting', 'root.payments.entries', 'level 2' FROM entry HAVING COUNT(*) > 0
UNION ALL SELECT 'junction', 'tags', 'parent_tags' FROM o HAVING COUNT(*) > 0
UNION ALL SELECT 'primary_key', 'customer', strategy || ' ' || primary_key FROM ({_recommend_sql("customer", _CUSTOMER)})
UNION ALL SELECT 'dependency', determinant, dependent FROM ({_fd_sql("customer", _CUSTOMER)})""")
def a10_design_report(spark, sf):
    return D.design_report(I.order_fields(spark, sf), I.table(spark, sf, "customer"), "customer")


def _key_sets_sql(columns: list[str]) -> str:
    """Minimal keys of one or two columns, looked at set by set."""
    unique = lambda cs: f"(SELECT COUNT(*) = COUNT(DISTINCT ({', '.join(cs)})) FROM t)"
    ones = [f"SELECT '{c}' AS key, 1 AS size FROM (SELECT 1) WHERE {unique([c])}" for c in columns]
    twos = [f"SELECT '{a}, {b}', 2 FROM (SELECT 1) WHERE {unique([a, b])} AND NOT {unique([a])} AND NOT {unique([b])}"
            for i, a in enumerate(columns) for b in columns[i + 1:]]
    return " UNION ALL ".join(ones + twos)


def _findings_sql(entity: str, source: str, columns: list[str]) -> str:
    """Single-column dependencies by counting pairs, against the keys."""
    pairs = " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y FROM (SELECT 1) WHERE (SELECT COUNT(DISTINCT {x}) = COUNT(DISTINCT ({x}, {y})) FROM t)"
        for x in columns for y in columns if x != y)
    held = lambda c: f"EXISTS (SELECT 1 FROM keys WHERE ', ' || key || ', ' LIKE '%, ' || {c} || ', %')"
    return f"""WITH t AS (SELECT {', '.join(columns)} FROM {source}), keys AS ({_key_sets_sql(columns)}), fd AS ({pairs})
SELECT '{entity}' AS entity, CASE WHEN {held('y')} THEN 'BCNF' WHEN {held('x')} THEN '2NF' ELSE '3NF' END AS normal_form,
       CASE WHEN {held('y')} THEN 'prime' WHEN {held('x')} THEN 'partial' ELSE 'transitive' END AS kind, x AS determinant, y AS dependent,
       (SELECT string_agg(key, '; ' ORDER BY key) FROM keys) AS key
FROM fd WHERE x NOT IN (SELECT key FROM keys)"""


_NATION_REGION = ["n_nationkey", "n_name", "n_regionkey", "r_name"]
_LINE_PART = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "p_brand", "p_size"]
_TURNS = ["conv_id", "turn", "role", "lang", "source"]
_LINE_KEYS = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"]


def _joined(spark, sf, *tables):
    names = [name for name, _ in tables]
    out = I.table(spark, sf, names[0])
    for name, on in tables[1:]:
        out = out.join(I.table(spark, sf, name), F.expr(on))
    return out


@query("a5_composite_keys", f"WITH t AS (SELECT * FROM lineitem), keys AS ({_key_sets_sql(_LINE_KEYS)}) SELECT key, size, (SELECT COUNT(*) FROM t) AS rows FROM keys")
def a5_composite_keys(spark, sf):
    return NF.candidate_keys(I.table(spark, sf, "lineitem"), _LINE_KEYS)


@query("a5_composite_keys_turns", f"WITH t AS (SELECT * FROM conversations), keys AS ({_key_sets_sql(['conv_id', 'turn', 'role'])}) "
                                  "SELECT key, size, (SELECT COUNT(*) FROM t) AS rows FROM keys")
def a5_composite_keys_turns(spark, sf):
    return NF.candidate_keys(I.table(spark, sf, "conversations"), ["conv_id", "turn", "role"])


@query("a6_normal_forms_nation", _findings_sql("nation", "nation JOIN region ON n_regionkey = r_regionkey", _NATION_REGION))
def a6_normal_forms_nation(spark, sf):
    return NF.normal_form_findings(_joined(spark, sf, ("nation", ""), ("region", "n_regionkey = r_regionkey")), "nation", _NATION_REGION)


@query("a6_normal_forms_lineitem", _findings_sql("lineitem", "lineitem JOIN part ON l_partkey = p_partkey", _LINE_PART))
def a6_normal_forms_lineitem(spark, sf):
    return NF.normal_form_findings(_joined(spark, sf, ("lineitem", ""), ("part", "l_partkey = p_partkey")), "lineitem", _LINE_PART)


@query("a6_normal_forms_turns", _findings_sql("turns", "conversations JOIN documents ON conv_id = doc_id", _TURNS))
def a6_normal_forms_turns(spark, sf):
    """What belongs to a whole conversation depends on a part of the turn's key."""
    return NF.normal_form_findings(_joined(spark, sf, ("conversations", ""), ("documents", "conv_id = doc_id")), "turns", _TURNS)


@query("a6_highest_normal_form", f"""SELECT entity, CASE WHEN COUNT(CASE WHEN normal_form = '3NF' THEN 1 END) > 0 THEN '2NF' ELSE 'BCNF' END AS normal_form, COUNT(*) AS findings
FROM ({_findings_sql("nation", "nation JOIN region ON n_regionkey = r_regionkey", _NATION_REGION)}) GROUP BY entity""")
def a6_highest_normal_form(spark, sf):
    return NF.highest_normal_form(a6_normal_forms_nation(spark, sf), "nation")
