from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from recordloom.operators import classify as C
from recordloom.operators import profile as P


def profile_of(df):
    return {r.field: r for r in df.collect()}


def test_unstable_type(records):
    p = profile_of(P.field_profile(records('{"f": "text"}', '{"f": 123}', '{"f": "more text"}')))
    assert p["f"].type_stability == "unstable" and p["f"].detected_type == "mixed" and p["f"]["count"] == 3


def test_unique_ratio(records):
    p = profile_of(P.field_profile(records(*['{"s": "%s"}' % s for s in ("active", "active", "inactive", "active")])))
    assert p["s"].unique_ratio == 0.5 and p["s"].unique_count == 2


def test_null_counts_as_present(records):
    p = profile_of(P.field_profile(records('{"field1": null, "field2": "value"}', '{"field2": "v"}')))
    assert p["field1"]["count"] == 1 and p["field1"].detected_type == "NoneType" and p["field1"].frequency_ratio == 0.5


def test_empty_batch(records):
    assert P.field_profile(records('{"a": 1}').limit(0)).collect() == []


def test_whole_and_real_numbers_stay_apart(records):
    p = profile_of(P.field_profile(records('{"n": 1}', '{"n": 1.0}', '{"n": 1}')))
    assert p["n"].unique_count == 2 and p["n"].type_stability == "unstable"


def test_nested_values_are_not_counted_unique(records):
    p = profile_of(P.field_profile(records('{"o": {"x": 1}, "l": [1]}', '{"o": {"x": 2}, "l": []}')))
    assert p["o"].is_nested and p["o"].detected_type == "dict" and p["o"].unique_count == 0
    assert p["l"].detected_type == "list"


def test_long_texts_count_exactly(records):
    long = "x" * 500
    p = profile_of(P.field_profile(records(f'{{"t": "{long}a"}}', f'{{"t": "{long}b"}}', f'{{"t": "{long}a"}}')))
    assert p["t"].unique_count == 2


def test_capped_counts(spark):
    from recordloom.sources.records import read_records

    df = spark.range(300).select("id", F.format_string('{"key": %d, "few": %d}', "id", F.col("id") % 7).alias("raw"))
    p = profile_of(P.field_profile_capped(read_records(df, "raw", "id").records, 50))
    assert (p["key"].unique_count, p["few"].unique_count) == (50, 7)
    assert p["key"]["count"] == 300 and p["key"].frequency_ratio == 1.0


def test_samples_follow_arrival(records):
    texts = ['{"v": "%s", "w": 1}' % v for v in ("c", "a", "c", "b", "d", "e", "f")] + ['{"v": "%s"}' % ("z" * 150)]
    lists = {r.key: r.samples for r in P.sample_lists(P.sample_values(P.cells(records(*texts)))).collect()}
    assert lists == {"v": ["c", "a", "b", "d", "e"], "w": ["1"]}
    short = P.sample_lists(P.sample_values(P.cells(records('{"v": "%s"}' % ("z" * 150))))).first()
    assert short.samples == ["z" * 100]


def test_merged_batches_equal_one_batch(records):
    texts = ['{"a": %d, "b": "%s"}' % (i % 4, i % 3) for i in range(20)] + ['{"a": "x"}']
    whole = records(*texts)
    one, two = whole.filter("rec_id <= 7"), whole.filter("rec_id > 7")
    merged = P.merge_value_partials(P.value_partials(P.cells(one)), P.value_partials(P.cells(two)))
    got = profile_of(P.finish_profile(P.field_counts(merged), P.record_total(whole)))
    assert got == profile_of(P.field_profile(whole))


def test_profile_matches_a_plain_loop(records):
    import json
    import random

    rng = random.Random(5)
    values = ['1', '2', '1.5', '"1"', '"x"', "true", "false", "null", "[1]", '{"a": 1}', "1e2"]
    texts = ["{" + ",".join(f'"{k}":{rng.choice(values)}' for k in rng.sample("abcdef", rng.randint(1, 6))) + "}" for _ in range(80)]
    stats = defaultdict(lambda: [0, set(), set()])
    for t in texts:
        for k, v in json.loads(t).items():
            stats[k][0] += 1
            stats[k][1].add(type(v).__name__)
            if not isinstance(v, (dict, list)):
                stats[k][2].add(str(v))
    got = profile_of(P.field_profile(records(*texts)))
    assert set(got) == set(stats)
    for k, (n, types, unique) in stats.items():
        assert got[k]["count"] == n and got[k].unique_count == len(unique), k
        assert got[k].detected_type == (next(iter(types)) if len(types) == 1 else "mixed")
        assert got[k].is_nested == bool(types & {"dict", "list"})


def _profile(spark, *rows):
    schema = ("field string, count bigint, frequency_ratio double, type_stability string, detected_type string, "
              "is_nested boolean, unique_count bigint, unique_ratio double")
    return spark.createDataFrame(rows, schema)


def test_decisions_follow_the_rules(spark):
    p = _profile(
        spark,
        ("username", 9, 0.1, "unstable", "mixed", False, 1, 0.1), ("obj", 10, 1.0, "stable", "dict", True, 0, 0.0),
        ("nil", 10, 1.0, "stable", "NoneType", False, 1, 0.1), ("mix", 10, 1.0, "unstable", "mixed", False, 2, 0.2),
        ("common", 10, 0.85, "stable", "int", False, 2, 0.2), ("rare", 10, 0.8, "stable", "str", False, 2, 0.2),
        ("email", 2000, 1.0, "stable", "str", False, 1999, 0.9995), ("mail", 2000, 1.0, "stable", "str", False, 2000, 1.0),
    )
    got = {r.field: (r.target, r.sql_type, r.is_unique) for r in C.decide_targets(p).collect()}
    assert got == {
        "username": ("BOTH", "TEXT", False), "obj": ("MONGO", None, False), "nil": ("MONGO", None, False),
        "mix": ("MONGO", None, False), "common": ("SQL", "INT", False), "rare": ("MONGO", None, False),
        "email": ("SQL", "VARCHAR(255)", True), "mail": ("SQL", "TEXT", False),
    }


def test_hysteresis(spark):
    p = _profile(spark, *[(f, 10, x, "stable", "str", False, 1, 0.1) for f, x in (("kept", 0.76), ("lost", 0.74), ("new", 0.84))])
    before = spark.createDataFrame([("kept", "SQL"), ("lost", "SQL"), ("new", "MONGO")], "field string, target string")
    after = C.decide_targets(p, before)
    assert {r.field: r.target for r in after.collect()} == {"kept": "SQL", "lost": "MONGO", "new": "MONGO"}
    assert [r.field for r in C.detect_drift(before, after).collect()] == ["lost"]


def test_extended_rules(spark):
    p = _profile(
        spark, ("customer_id", 5, 0.1, "stable", "str", False, 5, 1.0), ("uuid", 5, 1.0, "stable", "str", False, 5, 1.0),
        ("age", 5, 0.1, "stable", "int", False, 5, 1.0), ("phone", 5, 0.2, "stable", "str", False, 5, 1.0),
        ("city", 5, 0.8, "stable", "str", False, 5, 1.0), ("mood", 5, 0.2, "stable", "str", False, 1, 0.2),
        ("order_ids", 5, 0.2, "unstable", "mixed", False, 1, 0.2),
    )
    got = {r.field: (r.rule, r.target, r.is_unique) for r in C.classify_extended(p).collect()}
    assert got == {
        "customer_id": ("foreign_key", "SQL", False), "uuid": ("uuid", "SQL", True), "age": ("number", "SQL", False),
        "phone": ("identifier_name", "SQL", True), "city": ("fairly_frequent", "SQL", False), "mood": ("rest", "MONGO", False),
        "order_ids": ("unstable", "MONGO", False),
    }


def test_schema_changes_number_the_versions(spark):
    old = spark.createDataFrame([("a", "SQL"), ("b", "SQL"), ("c", "MONGO")], "field string, target string")
    new = spark.createDataFrame([("a", "SQL"), ("b", "MONGO"), ("d", "SQL")], "field string, target string")
    got = [(r.field, r.change, r.schema_version) for r in P.schema_changes(old, new, 4).orderBy("field").collect()]
    assert got == [("b", "retargeted", 4), ("c", "removed", 5), ("d", "added", 6)]


def test_profile_scans_its_source_once(spark, sf):
    from recordloom.plans import inputs as I

    profile = P.field_profile(I.event_records(spark, sf))
    profile.collect()
    final = profile._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "CartesianProduct" not in final and "NestedLoop" not in final
    assert "ReusedExchange" in profile._jdf.queryExecution().toString()
