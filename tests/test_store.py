import json
import random
import time
from collections import Counter

import pytest

from pyspark.sql import functions as F

from recordloom import session
from recordloom.functions.walk import nesting_depth, real_depth
from recordloom.operators import design as D
from recordloom.operators.classify import decide_targets, evolve_schema
from recordloom.operators.levels import split_nodes, table_nodes
from recordloom.operators.profile import field_profile
from recordloom.operators.records import assign_uuid, stamp_ingest
from recordloom.operators.route import decompose_large, resolve_references, route_records
from recordloom.operators.shred import (
    child_lists,
    child_rows,
    lossless_check,
    rebuild_records,
    reconstruct,
    shred,
    shred_m2m,
    structure_map,
    table_catalog,
    verify_foreign_keys,
)
from recordloom.session import landed, work_folder
from recordloom.sources.records import to_document
from recordloom.sources.tables import write_tables

NESTED = json.dumps({
    "user_id": "u1", "username": "nested", "profile": {"bio": "b", "location": {"city": "x"}},
    "orders": [
        {"order_id": "o1", "amount": 10.5, "items": [{"product": "A", "qty": 1}, {"product": "B", "qty": 2}]},
        {"order_id": "o2", "amount": 20.0, "items": [{"product": "C", "qty": 3}]},
    ],
    "comments": [{"text": "t1", "rating": 5}, {"text": "t2", "rating": 4}],
    "tags": ["a", "b", "a"], "empty": [],
})


def tables(rows):
    return {r["table"]: r["n"] for r in rows.groupBy("table").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_shred_counts_and_links(records):
    rows = shred(assign_uuid(records(NESTED)))
    assert tables(rows) == {"root": 1, "root_orders": 2, "root_orders_items": 3, "root_comments": 2}
    by_id = {r.uuid: r for r in rows.collect()}
    for r in by_id.values():
        if r.depth:
            assert by_id[r.parent_id]["table"] == r.parent_table
    root = json.loads(rows.filter("depth = 0").select(to_document(F.col("fields"))).first()[0])
    assert root["profile_bio"] == "b" and root["profile_location"] == {"city": "x"}
    assert "tags" not in root and "orders" not in root


MULTI_LEVEL = json.dumps({
    "username": "u", "timestamp": "2024-01-01T00:00:00", "email": "u@x", "subscription_tier": "gold", "is_active": True,
    "device_info": {"device_id": "d1", "os_name": "os"}, "location": {"city": "c", "gps_lat": 1.5, "altitude": 3.0},
    "orders": [
        {"order_id": "o1", "total_amount": 10.5, "items": [{"item_id": "i1", "quantity": 1}, {"item_id": "i2", "quantity": 2}]},
        {"order_id": "o2", "total_amount": 3.25, "items": [{"item_id": "i3", "quantity": 3}]},
    ],
    "health_metrics": [{"heart_rate": 70, "sleep_hours": 7.5}, {"heart_rate": 72, "sleep_hours": 0}],
    "system_metrics": [{"cpu_usage": 10, "battery_level": 90}],
})


def test_multi_level_record(records):
    rows = shred(assign_uuid(records(MULTI_LEVEL)))
    assert tables(rows) == {"root": 1, "root_orders": 2, "root_orders_items": 3, "root_health_metrics": 2, "root_system_metrics": 1}
    catalog = {(r["table"], r["column"]): (r["type"], r["role"], r["references"]) for r in table_catalog(rows).collect()}
    assert catalog["root", "is_active"] == ("BOOLEAN", "column", None) and catalog["root", "location_gps_lat"][0] == "FLOAT"
    assert catalog["root_health_metrics", "sleep_hours"][0] == "FLOAT" and catalog["root_orders_items", "quantity"][0] == "BIGINT"
    assert catalog["root_orders_items", "root_orders_id"] == ("VARCHAR(36)", "foreign_key", "root_orders")
    assert catalog["root", "uuid"][1] == "primary_key" and catalog["root_orders", "order_id"][1:] == ("foreign_key", "order")


def test_typed_tables_are_written_once_per_table(spark, records):
    path = work_folder(spark, "tables")
    names = write_tables(shred(assign_uuid(records(MULTI_LEVEL))), path)
    assert names == ["root", "root_health_metrics", "root_orders", "root_orders_items", "root_system_metrics"]
    health = spark.read.parquet(f"{path}/root_health_metrics")
    assert dict(health.dtypes) == {"uuid": "string", "root_id": "string", "pos": "int", "heart_rate": "bigint", "sleep_hours": "double"}
    assert sorted(r.sleep_hours for r in health.collect()) == [0.0, 7.5]
    items = spark.read.parquet(f"{path}/root_orders_items")
    orders = spark.read.parquet(f"{path}/root_orders")
    assert items.join(orders, items.root_orders_id == orders.uuid).count() == 3 and orders.columns[:3] == ["uuid", "root_id", "pos"]


def test_empty_list_gives_no_child_table(records):
    assert tables(shred(assign_uuid(records('{"items": [], "a": 1}')))) == {"root": 1}


def test_depth_limit(records):
    text = '{"v": 0}'
    for _ in range(14):
        text = '{"n": [' + text + "]}"
    source = assign_uuid(records(text))
    assert len(tables(shred(source))) == 15
    got = tables(shred(source, depth=10))
    assert len(got) == 11 and got["root" + "_n" * 10] == 1


def test_many_to_many(records):
    dims, junctions = shred_m2m(assign_uuid(records(NESTED, '{"tags": ["b", "c"], "nums": [1, 2]}')))
    assert sorted((r.dimension, r.name) for r in dims.collect()) == [
        ("num", "1"), ("num", "2"), ("tag", "a"), ("tag", "b"), ("tag", "c")]
    assert junctions.filter("junction = 'root_tags'").count() == 5
    assert junctions.join(dims, [junctions.dimension_id == dims.id], "left_anti").count() == 0


def test_structure_map(records):
    got = {(r["table"], r["column"], r["kind"]) for r in structure_map(records(NESTED)).collect()}
    assert ("root", "orders", "child") in got and ("root_orders", "items", "child") in got
    assert ("root", "profile_bio", "column") in got and ("root_orders_items", "qty", "column") in got
    assert not any(c in ("tags", "empty", "profile") for _, c, _ in got)


ODD = ('{"mixed": [{"a": 1}, 5, null, {"b": []}], "led": [null, {"c": 1}], "grid": [[1], [{"d": 2}]], "none": [], "void": {},'
       ' "null": null, "obj": {"in": 1, "list": [{"e": 1}], "Deep": {"x": {}}}, "obj_in": 2, "camelCase": {"subKey": [1]}}')


def canonical(df):
    return sorted((r.uuid, r.t) for r in df.select("uuid", to_document(F.col("fields")).alias("t")).collect())


def as_values(df):
    return {u: json.loads(t) for u, t in canonical(df)}


def test_rebuild_is_lossless(records):
    source = assign_uuid(records(NESTED, '{"a": 1}', '{"l": [{"x": 1}, {"x": 2}, {"x": 3}]}', ODD, "{}"))
    rows = landed(shred(source), "rows")
    rebuilt = rebuild_records(rows)
    assert as_values(rebuilt) == as_values(source)
    for r in lossless_check(source, rebuilt).collect():
        assert r.records_before == r.records_after and r.missing == 0 and r.extra == 0
    lost = rows.withColumn("rest", F.map_filter("rest", lambda k, v: k != "grid"))
    found = {r.field: (r.missing, r.extra) for r in lossless_check(source, rebuild_records(lost)).collect() if r.missing or r.extra}
    assert found == {"grid": (1, 0)}


def shuffled_rows(df):
    """Rows that the shuffles of a query have written."""
    def walked(node):
        own = node.metrics().apply("shuffleRecordsWritten").value() if node.nodeName() == "Exchange" else 0
        kids = node.children()
        return own + sum(walked(kids.apply(i)) for i in range(kids.size()))

    spark = df.sparkSession
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.collect()
        return walked(df._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_the_check_shuffles_a_row_per_record(records):
    source = assign_uuid(records(*[json.dumps({f"m{j}": f"{i} {j}" for j in range(20)}) for i in range(200)])).select("uuid", "fields")
    # Besides the records only each task's sums of the 21 members.
    assert shuffled_rows(lossless_check(source, source)) <= 2 * 200 + 21 * 4


def test_the_check_counts_by_member_as_brute_force(spark):
    rng = random.Random(5)
    sides = [[("u%d" % rng.randrange(30), {k: rng.randrange(3) for k in "abcdef" if rng.random() < 0.8}) for _ in range(300)] for _ in range(2)]
    sides[1][:150] = sides[0][:150]
    frames = [spark.createDataFrame([(u, json.dumps(m)) for u, m in rows], "uuid string, raw string").select(
        "uuid", F.from_json("raw", "map<string,variant>").alias("fields")) for rows in sides]
    before, after = (Counter((k, u, v) for u, m in rows for k, v in m.items()) for rows in sides)
    want = {k: (sum(n for x, n in before.items() if x[0] == k), sum(n for x, n in after.items() if x[0] == k),
                sum(n for x, n in (before - after).items() if x[0] == k), sum(n for x, n in (after - before).items() if x[0] == k)) for k in "abcdef"}
    got = {r.field: (r.records_before, r.records_after, r.missing, r.extra) for r in lossless_check(*frames).collect()}
    assert got == want


def test_ids_of_any_kind_are_rebuilt(records):
    ids = ["x", "", "0123456789abcdef0123456789abcdef", "0123456789ABCDEF0123456789ABCDEF", "\u0001\u00e9", "0123456789abcdef"]
    source = assign_uuid(records(*[json.dumps({"uuid": u, "l": [{"n": i, "m": [{"i": i}, {}]}]}) for i, u in enumerate(ids)]))
    assert as_values(rebuild_records(landed(shred(source), "rows"))) == as_values(source)


def test_a_depth_limit_keeps_what_lies_below(records):
    deep = '{"k": 0}'
    for i in range(14):
        deep = '{"k": %d, "l": [%s]}' % (i + 1, deep)
    source = assign_uuid(records(deep, NESTED))
    assert shred(source).agg(F.max("depth")).first()[0] == 14
    cut = landed(shred(source, depth=3), "rows")
    assert cut.agg(F.max("depth")).first()[0] == 3
    assert as_values(rebuild_records(cut)) == as_values(source)


def test_children_as_rows_and_lists(spark):
    kids = spark.range(1000).select(F.when(F.col("id") < 900, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 10)).alias("k"), "id")
    lists = {r.k: json.loads(r.kids) for r in child_lists(kids, "k", "kids", ["id"]).collect()}
    assert [x["id"] for x in lists["hot"]] == list(range(900)) and sum(map(len, lists.values())) == 1000
    root = spark.createDataFrame([("hot",), ("p1",)], "uuid string")
    rows = child_rows(root, "uuid", {"root_kids": (kids, "k", ["id"])}).collect()
    assert len(rows) == 910 and {r.child for r in rows} == {"kids"}
    assert sorted(json.loads(r.data)["id"] for r in rows if r.uuid == "hot") == list(range(900))


def test_reconstruct_prefers_documents_and_drops_orphans(spark):
    root = spark.createDataFrame([("1", "sql", 5), ("2", "sql", 6)], "uuid string, a string, b int")
    docs = spark.createDataFrame([("1", "doc")], "uuid string, a string").select(
        "uuid", F.create_map(F.lit("a"), F.col("a").cast("variant"), F.lit("c"), F.lit(1).cast("variant")).alias("doc"))
    kids = spark.createDataFrame([("1", 2), ("1", 1), ("9", 3)], "uuid string, x int")
    made = {r.uuid: r for r in reconstruct(root, "uuid", docs, {"root_kids": child_lists(kids, "uuid", "root_kids", ["x"])}).collect()}
    assert set(made) == {"1", "2"}
    assert json.loads(made["1"].record) == {"a": "doc", "b": 5, "c": 1} and json.loads(made["1"].kids) == [{"x": 1}, {"x": 2}]
    assert json.loads(made["2"].record) == {"a": "sql", "b": 6} and made["2"].kids == "[]"


LARGE = json.dumps({"user_id": "u", "username": "large", "basic_info": "info",
                    "device_logs": [{"log_entry": f"l{i}", "data": "x" * 100} for i in range(50)]})


def routed(df):
    return df.select("uuid", F.col("fields").alias("doc"))


def test_decompose_and_resolve_are_inverse(records):
    docs = routed(assign_uuid(records(LARGE, '{"small": "doc"}')))
    parts = decompose_large(docs)
    assert [r.collection for r in parts.side.collect()] == ["decomposed_device_logs"]
    stub = parts.documents.filter(F.map_contains_key("doc", "device_logs")).select(
        "uuid", F.col("doc")["device_logs"].cast("string").alias("s"), F.col("doc")["basic_info"].cast("string").alias("b")).first()
    assert stub.s == f"REF::MONGO::decomposed_device_logs::{stub.uuid}" and stub.b == "info"
    back = resolve_references(parts.documents, parts.side).documents
    text = lambda df: sorted(r[0] for r in df.select(to_document(F.col("doc"))).collect())
    assert text(back) == text(docs)
    assert text(resolve_references(parts.documents, parts.side, nested=True).documents) == text(docs)


def side_rows(spark, *rows):
    return spark.createDataFrame([("c", p, d) for p, d in rows], "collection string, parent_uuid string, data string")


def resolve_one(spark, records, text, side, **options):
    docs = records(text).select(F.col("rec_id").cast("string").alias("uuid"), F.col("fields").alias("doc"))
    out = resolve_references(docs, side, **options)
    return json.loads(out.documents.select(to_document(F.col("doc"))).first()[0]), out.payloads.collect()


def test_reference_forms(spark, records):
    side = side_rows(spark, ("p", '{"a":1}'), ("q", "1"), ("q", "2"))
    text = '{"one": "REF::MONGO::c::p", "two": "REF::MONGO::c::q", "none": "REF::MONGO::c::x", "bad": "REF::MONGO::c", "plain": "text"}'
    got, _ = resolve_one(spark, records, text, side)
    assert got == {"one": {"a": 1}, "two": [1, 2], "none": [], "bad": "REF::MONGO::c", "plain": "text"}
    as_list, _ = resolve_one(spark, records, text, side, unwrap=False)
    assert as_list["one"] == [{"a": 1}] and as_list["two"] == [1, 2]


def test_nested_references(spark, records):
    side = side_rows(spark, ("p", '{"again":"REF::MONGO::c::q","t":":\\"x"}'), ("q", '"end"'))
    text = json.dumps({"o": {"r": "REF::MONGO::c::p", "deep": {"r": "REF::MONGO::c::q"}},
                       "l": [{"r": "REF::MONGO::c::q"}, "REF::MONGO::c::q"], "s": 'says :"REF::MONGO::c::q"'})
    got, _ = resolve_one(spark, records, text, side, nested=True)
    assert got == {"o": {"r": {"again": "REF::MONGO::c::q", "t": ':"x'}, "deep": {"r": "end"}},
                   "l": [{"r": "end"}, "REF::MONGO::c::q"], "s": 'says :"REF::MONGO::c::q"'}


def test_crowded_references(spark, records):
    side = side_rows(spark, *[("p", str(i)) for i in range(30)], ("q", "7"))
    text = '{"a": "REF::MONGO::c::p", "b": "REF::MONGO::c::q"}'
    got, rows = resolve_one(spark, records, text, side, lists=False)
    assert got == {"a": "REF::MONGO::c::p", "b": 7} and sorted(int(r.data) for r in rows) == list(range(30))
    assert sorted(r.pos for r in rows) == list(range(30))
    got, rows = resolve_one(spark, records, text, side)
    assert sorted(got["a"]) == list(range(30)) and got["b"] == 7 and not rows


def test_misfits_stay_in_the_document(spark, records):
    source = assign_uuid(records('{"x": 1, "y": 1, "z": true}', '{"x": "abc", "y": 2.5, "z": "no"}', '{"x": 2.5, "y": "t", "z": 0}',
                                 '{"x": 1e30, "y": 9007199254740993}', '{"x": null}', '{"x": [1], "y": {"a": 1}}'))
    decisions = spark.createDataFrame([("x", "SQL", "INT"), ("y", "SQL", "FLOAT"), ("z", "SQL", "BOOLEAN")],
                                      "field string, target string, sql_type string")
    parts = route_records(source, decisions)
    assert sorted(r.x for r in parts.structured.collect() if r.x is not None) == [1]
    assert sorted(r.y for r in parts.structured.collect() if r.y is not None) == [1.0, 2.5]
    back = {r.uuid: json.loads(r.record) for r in reconstruct(parts.structured.select("uuid", "x", "y", "z"), "uuid", parts.documents).collect()}
    want = {u: {k: v for k, v in d.items() if k != "uuid" and v is not None} for u, d in as_values(source).items()}
    assert {u: {k: v for k, v in d.items() if k in ("x", "y", "z")} for u, d in back.items()} == want


def test_split_then_merge_keeps_every_field(records):
    texts = ['{"id": %d, "name": "n%d", "x": {"y": %d}%s}' % (i, i, i, ', "rare": 1' if i == 3 else "") for i in range(10)]
    source = assign_uuid(stamp_ingest(records(*texts), "2024-01-01 00:00:00"))
    decisions = decide_targets(field_profile(source))
    parts = route_records(source, decisions)
    assert {"id", "name"} <= set(parts.structured.columns) and "rare" not in parts.structured.columns
    made = reconstruct(parts.structured, "uuid", parts.documents)
    got = sorted(made.select("record").collect(), key=lambda r: json.loads(r.record)["id"])
    want = sorted((json.loads(r[0]) for r in source.select(to_document(F.col("fields"))).collect()), key=lambda d: d["id"])
    assert [json.loads(r.record) for r in got] == want


def test_unknown_fields_follow_the_default(records):
    source = assign_uuid(records('{"a": 1, "odd": {"x": 1}}', '{"a": 2, "late": "v"}'))
    decisions = decide_targets(field_profile(source)).filter("field = 'a'")
    to_docs = route_records(source, decisions)
    assert "odd" not in to_docs.structured.columns and to_docs.documents.filter(F.map_contains_key("doc", "late")).count() == 1
    to_columns = route_records(source, decisions, default="SQL")
    got = {r.a: (r.odd, r.late) for r in to_columns.structured.collect()}
    assert got == {1: ('{"x":1}', None), 2: (None, "v")}
    assert to_columns.documents.filter(F.map_contains_key("doc", "late")).count() == 0


def test_evolve_schema_adds_null_columns(spark, records):
    old = spark.createDataFrame([(1,)], "id bigint")
    decisions = spark.createDataFrame([("id", "SQL", "INT"), ("n", "SQL", "FLOAT"), ("d", "MONGO", None)],
                                      "field string, target string, sql_type string")
    new = evolve_schema(old, decisions)
    assert new.dtypes == [("id", "bigint"), ("n", "double")] and new.first().n is None


def test_foreign_keys_report_orphans(spark):
    parent = spark.createDataFrame([(1,), (2,)], "uuid int")
    child = spark.createDataFrame([(1,), (1,), (3,), (None,)], "root_id int")
    row = verify_foreign_keys({"root": parent, "kid": child}, [("kid", "root_id", "root", "uuid")]).first()
    assert (row.child_rows, row.orphans) == (4, 1)


def test_repeating_groups_and_paths(records):
    groups = {r.group_name: r for r in D.repeating_groups(records(NESTED)).collect()}
    assert groups["orders"].cardinality == "1:N" and groups["orders"].attributes == "amount, items, order_id"
    assert groups["tags"].cardinality == "M:N" and groups["tags"].values_sample == "a, b, a"
    paths = {r.path: r.level for r in D.nesting_paths(records(NESTED)).collect()}
    assert paths == {"root.orders": 1, "root.orders.items": 2, "root.comments": 1}
    assert D.deepest_level(D.nesting_paths(records(NESTED))).first().deepest_level == 2


def test_nesting_depth(records):
    cases = {"1": 0, "{}": 0, "[]": 0, '{"a": 1}': 1, "[1]": 1, "[[1, [2]], [[[3]]]]": 2, '{"a": {"b": [{"c": 1}]}}': 4}
    df = records(*['{"v": %s}' % c for c in cases])
    got = [r[0] for r in df.orderBy("rec_id").select(nesting_depth(F.col("fields")["v"])).collect()]
    assert got == list(cases.values())


def brute_dependencies(rows, names, mode):
    out = set()
    for i, x in enumerate(names):
        for j, y in enumerate(names):
            if i == j:
                continue
            groups = {}
            for r in rows:
                if r[i] is not None:
                    groups.setdefault(r[i], set()).add(r[j])
            ones = [len(v) == 1 for v in groups.values()]
            if ones and (all(ones) if mode == "strict" else any(ones)):
                out.add((x, y))
    return out


def test_dependencies_match_brute_force(spark):
    rows = [(i, i % 7, (i % 7) // 2, "s%d" % (i % 3), None if i % 5 == 0 else i % 2) for i in range(60)]
    names = ["id", "a", "b", "c", "d"]
    df = spark.createDataFrame(rows, "id int, a int, b int, c string, d int")
    for mode in ("strict", "any"):
        got = {(r.determinant, r.dependent) for r in D.functional_dependencies(df, names, mode).collect()}
        assert got == brute_dependencies(rows, names, mode), mode
    odd = [(1, None), (1, "None"), (2, "x")]
    found = D.functional_dependencies(spark.createDataFrame(odd, "x int, y string"), ["x", "y"]).collect()
    assert {(r.determinant, r.dependent) for r in found} == {("y", "x")}
    row = D.functional_dependencies(df, names).filter("determinant = 'id' AND dependent = 'a'").first()
    assert row.confidence == 0.99 and row.num_samples == 60


def test_key_recommendation(spark):
    df = spark.createDataFrame([(1, "x", "a"), (2, "x", "b"), (3, "y", "c")], "n int, g string, user_code string")
    row = D.recommend_key(D.key_analysis(df), "entity").first()
    assert (row.primary_key, row.strategy, row.candidates) == ("user_code", "natural", 2)
    assert D.recommend_key(D.key_analysis(df.select("g")), "entity").first().primary_key == "entity_id"
    nulls = spark.createDataFrame([(1, None), (2, "b")], "n int, code string")
    assert D.recommend_key(D.key_analysis(nulls), "entity").first().primary_key == "n"


def test_embed_or_reference(records):
    big = "x" * 3000
    texts = [json.dumps({"small": {"a": i % 2}, "big": {"t": big, "i": i}, "logs": list(range(1100 if i == 0 else 3)),
                         "objs": [{"a": k} for k in range(25)], "few": [1, 2]}) for i in range(4)]
    objects = {r.field: r.decision for r in D.embed_or_reference_object(records(*texts)).collect()}
    assert objects == {"small": "EMBED", "big": "REFERENCE"}
    arrays = {r.field: (r.decision, r.growth_pattern) for r in D.embed_or_reference_array(records(*texts)).collect()}
    assert arrays == {"logs": ("REFERENCE", "unbounded"), "objs": ("REFERENCE", "bounded"), "few": ("EMBED", "bounded")}


def test_shredding_stores_nothing(spark, records):
    """A level's rows used to be stored with all that lies below them, once a level."""
    deep = '{"k": 0}'
    for i in range(15):
        deep = '{"k": %d, "l": [%s]}' % (i + 1, deep)
    stored = lambda: len(session._MADE.get(spark.sparkContext.applicationId, []))
    before = stored()
    got = {r.depth: r.k for r in shred(assign_uuid(records(deep))).select("depth", F.col("fields")["k"].cast("int").alias("k")).collect()}
    assert got == {i: 15 - i for i in range(16)} and stored() == before


@pytest.mark.parametrize("depth", [None, 0, 1, 2])
def test_split_nodes_are_the_table_nodes(records, depth):
    """The same rows; a list leaves its row only where child rows hold all of it."""
    source = assign_uuid(records(NESTED, ODD, "{}", '{"a": [{}], "aA": [{"b": [{"c": [{"d": 1}]}, {"b": [7]}]}], "t": "[{[{"}'))
    keys = ["table", "uuid", "parent_table", "parent_id", "list_key", "pos", "depth"]
    rows = [{tuple(r[k] for k in keys): json.loads(r.t) for r in df.select(*keys, to_document(F.col("fields")).alias("t")).collect()}
            for df in (table_nodes(source, "root", True, depth), split_nodes(source, "root", depth))]
    assert rows[0].keys() == rows[1].keys() and len(rows[0]) > (4 if depth else 3)
    for k, whole in rows[0].items():
        given = {n for n, v in whole.items() if isinstance(v, list) and v and all(isinstance(x, dict) for x in v)}
        assert rows[1][k] == {n: v for n, v in whole.items() if depth == k[-1] or n not in given}


def test_brackets_inside_texts_cost_nothing(records):
    """The walk ends on an empty level: texts full of brackets make no steps."""
    many = "[" * 64_000 + "{" * 64_000
    source = assign_uuid(records(json.dumps({"t": many, "k": [{"t": many}]}), json.dumps({"t": many, "o": {"t": many}})))
    start = time.perf_counter()
    assert sorted(r.depth for r in shred(source).select("depth").collect()) == [0, 0, 1]
    assert D.deepest_level(D.nesting_paths(source)).first().deepest_level == 1
    assert [r[0] for r in source.orderBy("rec_id").select(nesting_depth(F.to_variant_object("fields"))).collect()] == [3, 2]
    assert time.perf_counter() - start < 20


def test_depth_counts_brackets_outside_texts_only(records):
    rows = records(json.dumps({"v": 'a"[{\\'}), json.dumps({"v": [[], [[]], []]}), json.dumps({"v": {"a": {"b\"[": [1]}}}),
                   json.dumps({"v": [{}] * 20_000 + ["]]]"]}), json.dumps({"v": '\\"' * 50_000}))
    assert [r[0] for r in rows.orderBy("rec_id").select(real_depth(F.col("fields")["v"])).collect()] == [0, 3, 3, 2, 0]


def test_a_record_of_many_children(records):
    wide = json.dumps({"k": [{"i": i, "l": [{"j": i}] if i % 1000 == 0 else []} for i in range(30_000)]})
    rows = shred(assign_uuid(records(wide, "{}")))
    assert {r.depth: r["count"] for r in rows.groupBy("depth").count().collect()} == {0: 2, 1: 30_000, 2: 30}
    assert rows.select("uuid").distinct().count() == 30_032


@pytest.mark.parametrize("nested", [False, True])
def test_user_texts_that_look_like_references_survive(spark, records, nested):
    long = "x" * 2000
    source = assign_uuid(records(json.dumps({"note": "REF::MONGO::notes::mine", "body": long, "o": {"n": "REF::MONGO::a::b"}}),
                                 json.dumps({"note": "REF::MONGO::notes::mine", "odd": "REF::"}))).select("uuid", F.col("fields").alias("doc"))
    parts = decompose_large(source, mark=True)
    assert sorted(len(r.stubs) for r in parts.documents.collect()) == [0, 1]
    back = resolve_references(parts.documents, parts.side, nested=nested).documents
    text = lambda df: {r.uuid: r.t for r in df.select("uuid", to_document(F.col("doc")).alias("t")).collect()}
    assert text(back) == text(source)


def test_misfits_and_reconstruct_broadcast_no_record_side(spark, sf):
    """Every side of these joins holds a row per record: none may go through the driver, however small it looks."""
    from recordloom.plans.store_queries import r1_misfits

    root = spark.createDataFrame([("1", 5)], "uuid string, b int")
    docs = spark.createDataFrame([("1",)], "uuid string").select("uuid", F.create_map(F.lit("c"), F.lit(1).cast("variant")).alias("doc"))
    for df in (r1_misfits(spark, sf), reconstruct(root, "uuid", docs)):
        assert "BroadcastExchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert {r.kind: (r.rows, r.lost) for r in r1_misfits(spark, sf).collect()} == {
        k: (n, 0) for k, n in zip(("int", "text", "fraction", "list"),
                                  [spark.read.parquet(f"{sf}/events.parquet").filter(f"event_id % 4 = {i}").count() for i in range(4)])}
