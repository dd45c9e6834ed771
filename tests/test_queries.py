import json
import random

import pytest
from pyspark.sql import functions as F

from recordloom.functions.filters import (
    FilterError,
    check_filter,
    conditions_to_spec,
    document_filter,
    structured_filter,
)
from recordloom.operators import federate as J
from recordloom.operators import mutate as W
from recordloom.operators import query as Q
from recordloom.sources.records import to_document


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [("1", 17, "active", 1.5), ("2", 18, "pending", None), ("3", 30, None, 2.5), ("4", None, "gone", 3.5)],
        "uuid string, age int, status string, score double")


def ids(df):
    return sorted(r.uuid for r in df.select("uuid").collect())


@pytest.mark.parametrize("spec, want", [
    ({"age": {"$gt": 18}}, ["3"]), ({"age": {"$gte": 18}}, ["2", "3"]), ({"age": {"$lt": 18}}, ["1"]), ({"age": {"$lte": 18}}, ["1", "2"]),
    ({"status": {"$in": ["active", "pending"]}}, ["1", "2"]), ({"status": {"$in": "gone"}}, ["4"]), ({"status": "active", "age": 17}, ["1"]),
    ({"status": {"$ne": "active"}}, ["2", "4"]), ({}, ["1", "2", "3", "4"]), ({"status": None}, []), ({"age": {"$eq": 30}}, ["3"]),
])
def test_structured_filters(people, spec, want):
    assert ids(Q.filter_rows(people, spec)) == want


def test_filters_reach_the_scan(spark, sf):
    plan = Q.filter_rows(spark.read.parquet(f"{sf}/orders.parquet"), {"o_orderstatus": "F", "o_custkey": {"$gt": 5}})
    text = plan.select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus)" in text and "o_totalprice" not in text


def test_unknown_and_oversized_filters_are_refused():
    for bad in ({"a": {"$regex": "x"}}, {"$where": 1}, {"a": {"$in": list(range(501))}}):
        with pytest.raises(FilterError):
            check_filter(bad)
    deep = {"a": 1}
    for _ in range(10):
        deep = {"$and": [deep]}
    with pytest.raises(FilterError):
        check_filter(deep)
    with pytest.raises(FilterError):
        structured_filter({"a": {"$exists": True}})
    with pytest.raises(FilterError):
        conditions_to_spec([{"field": "a", "op": "ne", "value": 1}])


DOCS = [{"a": 1, "t": ["x", "y"], "o": {"p": 5}}, {"a": "1", "t": [], "o": {"p": None}}, {"a": None}, {"b": True, "o": [{"p": 5}, {"p": 7}]},
        {"a": [1, 2], "t": "x"}, {"a": 1.0, "t": [["x"]]}, {"a": 2.5, "o": {"q": 1}}, {}]

MISSING = object()


def reach(doc, path):
    """Plain-Python model of the document filter, for comparison."""
    values = [doc]
    for i, part in enumerate(path.split(".")):
        nxt = []
        for v in values:
            for one in (v if isinstance(v, list) and i else [v]):
                if isinstance(one, dict) and part in one:
                    nxt.append(one[part])
        values = nxt
    return values


def same(x, y):
    if isinstance(x, bool) or isinstance(y, bool):
        return isinstance(x, bool) and isinstance(y, bool) and x == y
    return x == y and (x is None) == (y is None)


def holds(doc, spec):
    for key, test in spec.items():
        if key == "$and":
            ok = all(holds(doc, s) for s in test)
        elif key == "$or":
            ok = any(holds(doc, s) for s in test)
        else:
            ok = field_holds(reach(doc, key), test)
        if not ok:
            return False
    return True


def field_holds(values, test):
    leaves = [x for v in values for x in [v, *(v if isinstance(v, list) else [])]]

    def eq(like):
        return (like is None and not values) or any(same(x, like) for x in leaves)

    def ranged(op, like):
        number = (int, float)
        for x in leaves:
            if isinstance(x, bool) or isinstance(like, bool):
                continue
            if (isinstance(x, number) and isinstance(like, number)) or (isinstance(x, str) and isinstance(like, str)):
                if {"$gt": x > like, "$gte": x >= like, "$lt": x < like, "$lte": x <= like}[op]:
                    return True
        return False

    if not isinstance(test, dict):
        return eq(test)
    for op, like in test.items():
        ok = {"$eq": lambda: eq(like), "$ne": lambda: not eq(like), "$in": lambda: any(eq(x) for x in like),
              "$nin": lambda: not any(eq(x) for x in like), "$not": lambda: not field_holds(values, like),
              "$exists": lambda: bool(values) == like, "$size": lambda: any(isinstance(v, list) and len(v) == like for v in values),
              }.get(op, lambda: ranged(op, like))()
        if not ok:
            return False
    return True


def test_document_filters_match_a_plain_model(spark):
    rng = random.Random(3)
    values = [1, 2, 2.5, "1", "x", True, None, 5]

    def leaf():
        op = rng.choice(["$eq", "$ne", "$gt", "$gte", "$lt", "$lte", "$in", "$nin", "$exists", "$size", "$not", "bare"])
        v = rng.choice(values)
        if op == "bare":
            return v
        if op in ("$in", "$nin"):
            return {op: rng.sample(values, 2)}
        if op == "$exists":
            return {op: rng.random() < 0.5}
        if op == "$size":
            return {op: rng.choice([0, 1, 2])}
        if op in ("$gt", "$gte", "$lt", "$lte"):
            return {op: rng.choice([1, 2, 1.5, "a", "x"])}
        if op == "$not":
            return {op: {"$gt": rng.choice([1, "a"])}}
        return {op: v}

    specs = [{rng.choice(["a", "b", "t", "o.p", "o", "zz"]): leaf()} for _ in range(40)]
    specs += [{"$or": [specs[i], specs[i + 1]], "a": {"$ne": 1}} for i in range(4)]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(DOCS)], "i int, raw string").select(
        "i", F.from_json("raw", "map<string,variant>").alias("doc"))
    rows = df.select("i", *[document_filter(s).alias(f"s{k}") for k, s in enumerate(specs)]).orderBy("i").collect()
    for r in rows:
        for k, s in enumerate(specs):
            assert r[f"s{k}"] == holds(DOCS[r.i], s), (DOCS[r.i], s)


def test_projection_keeps_request_order(people):
    assert Q.project_fields(people, ["score", "nope", "uuid"]).columns == ["score", "uuid"]


def test_limits():
    assert [Q.clamp_limit(x) for x in (None, "x", 0, -5, 7, "8", 1000)] == [50, 50, 1, 1, 7, 8, 100]


def test_count_preview(people):
    assert Q.count_preview(people, cap=3).first().asDict() == {"count": 3, "truncated": True, "actual_count": None}
    assert Q.count_preview(people, F.col("age") > 17).first().asDict() == {"count": 2, "truncated": False, "actual_count": 2}


def test_first_available_table(people):
    other = people.select("uuid")
    assert Q.first_available_table({"a": other, "b": people}, ["uuid", "age"])[0] == "b"
    with pytest.raises(LookupError):
        Q.first_available_table({"a": other}, ["age"])


def fields(spark, *docs):
    return spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "seq int, raw string").select(
        "seq", F.from_json("raw", "map<string,variant>").alias("fields"))


def merge_model(left, right):
    """Plain-Python model of the federated merge."""
    key = lambda r: r.get("username") or r.get("sys_ingested_at") or r.get("user_id")
    if not left or not right:
        return left or right
    index = {}
    for m in right:
        if key(m):
            index.setdefault(key(m), []).append(m)
    out = [{**s, **(index.get(key(s), [{}])[0] if key(s) else {})} for s in left]
    known = {key(s) for s in left}
    return out + [m for m in right if key(m) and key(m) not in known]


MERGE_CASES = [
    ([{"username": "a", "x": 1, "y": 1}, {"username": "b", "x": 2}, {"username": "", "user_id": "u", "x": 3}, {"x": 4}],
     [{"username": "a", "x": None, "z": 1}, {"username": "a", "x": 9}, {"username": "c", "z": 1}, {"username": "c", "z": 2}, {"z": 3},
      {"username": None, "sys_ingested_at": "", "user_id": "u", "w": 1}]),
    ([], [{"username": "a"}, {"z": 1}]),
    ([{"username": 0, "user_id": 7, "x": 1}, {"username": False, "sys_ingested_at": "0"}, {"username": 0.0}],
     [{"user_id": 7, "y": 1}, {"sys_ingested_at": "0", "y": 2}, {"username": "false", "y": 3}]),
    ([{"username": "a"}], []),
]


@pytest.mark.parametrize("left, right", MERGE_CASES)
def test_federated_merge_matches_a_plain_model(spark, left, right):
    empty = fields(spark, {}).limit(0)
    merged = J.federated_merge(fields(spark, *left) if left else empty, fields(spark, *right) if right else empty)
    got = [json.loads(r[0]) for r in merged.select(to_document(F.col("fields"))).collect()]
    order = lambda d: json.dumps(d, sort_keys=True)
    assert sorted(got, key=order) == sorted(merge_model(left, right), key=order)


def test_update_touches_only_matching_rows(people):
    docs = people.select("uuid", F.create_map(F.lit("old"), F.lit(1).cast("variant")).alias("doc"))
    done = W.update_where(people, docs, {"status": {"$in": ["active", "gone"]}}, {"age": 99, "tag": None, "flag": True},
                          {"age": "SQL", "tag": "MONGO", "flag": "BOTH"})
    assert done.affected.first()[0] == 2
    assert {r.uuid: r.age for r in done.structured.collect()} == {"1": 99, "2": 18, "3": 30, "4": 99}
    new = {r.uuid: json.loads(r.d) for r in done.documents.select("uuid", to_document(F.col("doc")).alias("d")).collect()}
    assert new["1"] == {"old": 1, "tag": None, "flag": True} and new["2"] == {"old": 1}
    with pytest.raises(ValueError):
        W.update_where(people, docs, {}, {"age": 1}, {})
    two = W.update_where(people, docs, {"status": {"$in": ["active", "gone"]}, "old": 1}, {"age": "old", "tag": 2}, {"age": "SQL", "tag": "MONGO"})
    hit = two.affected.first()[0]
    new = {r.uuid: json.loads(r.d) for r in two.documents.select("uuid", to_document(F.col("doc")).alias("d")).collect()}
    assert hit >= 1 and new["1"] == {"old": 1, "age": "old", "tag": 2}  # a text does not fit the column
    assert {r.uuid: r.age for r in two.structured.collect()}["1"] is None
    gone = W.delete_ids({"root": people}, "root", docs, {"status": "active", "old": 1}, [])
    assert "1" not in {r.uuid for r in gone.tables["root"].collect()}


@pytest.fixture
def split(spark):
    """``age`` is an integer column; what it would not hold is in the documents.  Record 6 has no document."""
    rows = spark.createDataFrame([("1", 17, "a"), ("2", None, "b"), ("3", None, "c"), ("4", 30, "d"), ("5", None, "e"), ("6", 2, "f"),
                                  ("7", None, "g"), ("8", 5, "h")], "uuid string, age int, name string")
    docs = spark.createDataFrame([("1", "{}"), ("2", '{"age": "abc"}'), ("3", '{"age": 2.5}'), ("4", "{}"), ("5", '{"age": null, "x": 1}'),
                                  ("7", '{"age": [7, "abc"], "x": 2}'), ("8", '{"age": 3000000000}')], "uuid string, j string")
    return rows, docs.select("uuid", F.from_json("j", "map<string,variant>").alias("doc"))


EITHER = [
    ({"age": "abc"}, ["2", "7"]), ({"age": 2.5}, ["3"]), ({"age": 17}, ["1"]), ({"age": 17.0}, ["1"]), ({"age": 7}, ["7"]), ({"age": None}, ["5"]),
    ({"age": 5}, []), ({"age": 3000000000}, ["8"]), ({"age": {"$in": ["abc", 30, 2.5]}}, ["2", "3", "4", "7"]), ({"age": {"$in": "abc"}}, ["2", "7"]),
    ({"age": {"$gt": 2}}, ["1", "3", "4", "7", "8"]), ({"age": {"$gte": 2.5}}, ["1", "3", "4", "7", "8"]), ({"age": {"$lt": 2.5}}, ["6"]),
    ({"age": {"$lte": 2.5}}, ["3", "6"]), ({"age": {"$gt": 1e300}}, []), ({"age": {"$lt": float("inf")}}, ["1", "3", "4", "6", "7", "8"]),
    ({"age": {"$lt": 10**30}}, ["1", "3", "4", "6", "7", "8"]), ({"age": {"$gt": "abb"}}, ["2", "7"]), ({"age": True}, []),
    ({"age": {"$ne": 17}}, ["2", "3", "4", "6", "7", "8"]), ({"age": {"$ne": "abc"}}, ["1", "3", "4", "6", "8"]), ({"age": {"$gt": 2, "$lt": 20}}, ["1", "3", "7"]),
    ({"x": 1}, ["5"]), ({"x": {"$gte": 1}, "age": {"$gt": 6}}, ["7"]), ({"name": "b", "age": "abc"}, ["2"]), ({"name": 1}, []), ({}, list("12345678")),
]


@pytest.mark.parametrize("spec, want", EITHER)
def test_conditions_find_values_on_either_side(split, spec, want):
    assert ids(Q.filter_records(*split, spec)) == want


def test_unknown_operators_are_refused_on_either_side(split):
    for bad in ({"age": {"$exists": True}}, {"$or": []}):
        with pytest.raises(FilterError):
            Q.filter_records(*split, bad)


def logical(done):
    """The records as a read gives them."""
    from recordloom.operators.shred import reconstruct

    return {r.uuid: json.loads(r.record) for r in reconstruct(done.structured, "uuid", done.documents).collect()}


def test_an_update_replaces_a_value_wherever_it_is(split):
    done = W.update_where(*split, {"name": "b"}, {"age": 7}, {"age": "SQL"})
    assert logical(done)["2"] == {"age": 7, "name": "b"} and done.affected.first()[0] == 1
    by_value = W.update_where(*split, {"age": "abc"}, {"age": 8, "name": "n"}, {"age": "SQL", "name": "SQL"})
    assert logical(by_value)["2"] == {"age": 8, "name": "n"} and logical(by_value)["7"] == {"age": 8, "name": "n", "x": 2}
    assert logical(W.update_where(*split, {"age": 2.5}, {"age": "old"}, {"age": "SQL"}))["3"] == {"age": "old", "name": "c"}
    both = logical(W.update_where(*split, {"age": {"$in": [17, 3000000000]}}, {"age": 1}, {"age": "BOTH"}))
    assert both["1"]["age"] == both["8"]["age"] == 1
    # To the documents: an older column value must not stay in the way, and a record without a document gets one.
    moved = W.update_where(*split, {"age": {"$in": [30, 2]}}, {"age": "text"}, {"age": "MONGO"})
    assert {r.uuid: r.age for r in moved.structured.collect()}["4"] is None
    assert logical(moved)["4"] == {"age": "text", "name": "d"} and logical(moved)["6"] == {"age": "text", "name": "f"}
    # Found by its new value, and no longer by the old one.
    assert ids(Q.filter_records(moved.structured, moved.documents, {"age": "text"})) == ["4", "6"]
    assert ids(Q.filter_records(done.structured, done.documents, {"age": "abc"})) == ["7"]


def test_a_delete_finds_values_on_either_side(split):
    gone = W.delete_ids({"root": split[0]}, "root", split[1], {"age": {"$in": ["abc", 30]}}, [])
    assert ids(gone.tables["root"]) == ["1", "3", "5", "6", "8"]


def test_reads_by_a_filter_object(split):
    got = J.read_by_filter(split[0], {"age": {"$gte": 2.5}, "name": {"$lt": "d"}}, split[1])
    assert {r.uuid: json.loads(r.record)["age"] for r in got.collect()} == {"1": 17, "3": 2.5}


def test_delete_cascades(spark):
    t = {"root": spark.createDataFrame([("1", "x"), ("2", "y")], "uuid string, g string"),
         "kid": spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "2")], "id string, root_id string"),
         "grand": spark.createDataFrame([("a",), ("c",), ("c",)], "kid_id string")}
    links = [("kid", "root_id", "root", "uuid"), ("grand", "kid_id", "kid", "id")]
    done = W.delete_where(t, "root", structured_filter({"g": "x"}), links)
    assert {r["table"]: r.deleted for r in done.counts.collect()} == {"root": 1, "kid": 2, "grand": 1}
    assert {n: df.count() for n, df in done.tables.items()} == {"root": 1, "kid": 1, "grand": 2}
    assert {r.status for r in W.delete_by_id(t, "root", "uuid", "9", links).counts.collect()} == {"404"}


def test_null_never_matches_a_delete(people):
    done = W.delete_where({"root": people}, "root", structured_filter({"status": {"$ne": "active"}}), [])
    assert ids(done.tables["root"]) == ["1", "3"]


def test_unique_validation(spark):
    stored = spark.createDataFrame([("a",), ("b",)], "email string")
    batch = spark.createDataFrame([(1, "a"), (2, "c"), (3, "c"), (4, "d"), (5, None), (6, None)], "id int, email string")
    got = {r.id: r.reason for r in W.validate_unique(batch, stored, "email").collect()}
    assert got == {1: "already stored", 2: "repeated in batch", 3: "repeated in batch"}


def test_append_twice_is_append_once(spark):
    batch = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 1, None)], "k string, seq int, v string")
    first = W.idempotent_append(batch.limit(0), batch, ["k"], "seq")
    assert sorted(map(tuple, first.collect())) == [("a", 1, "early"), ("b", 1, None)]
    assert W.idempotent_append(first, batch, ["k"], "seq").count() == 0


def test_read_by_id_reports_a_missing_record(spark, people):
    docs = people.select("uuid", F.create_map(F.lit("n"), F.lit(1).cast("variant")).alias("doc"))
    kids = spark.createDataFrame([("1", 5)], "root_id string, x int")
    found = J.read_by_id(people, docs, "1", {"root_kids": (kids, "root_id", ["x"])}).first()
    assert found.status == "success" and json.loads(found.record)["n"] == 1 and json.loads(found.kids) == [{"x": 5}]
    assert J.read_by_id(people, docs, "77").first().status == "404"
