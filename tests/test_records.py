import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordloom.functions.naming import singular, snake_case
from recordloom.functions.values import coerce_literal, type_name
from recordloom.operators.records import assign_uuid, normalize_keys, stamp_ingest
from recordloom.sources.records import read_records, to_document


def docs(df):
    return {r[0]: json.loads(r[1]) for r in df.select("rec_id", to_document(F.col("fields"))).collect()}


def test_snake_case(spark):
    names = {"userName": "user_name", "UserName": "user_name", "user_name": "user_name", "deviceType": "device_type",
             "IPAddress": "ip_address", "IP": "ip", "gpsLat2X": "gps_lat2_x", "a": "a", "éÉtat": "ééetat"}
    df = spark.createDataFrame([(k,) for k in names], "n string")
    got = {r.n: r.s for r in df.select("n", snake_case(F.col("n")).alias("s")).collect()}
    got.pop("éÉtat"), names.pop("éÉtat")
    assert got == names


def test_singular_strips_every_trailing_s(spark):
    df = spark.createDataFrame([("tags",), ("class",), ("tag",)], "n string")
    assert [r[0] for r in df.select(singular(F.col("n"))).collect()] == ["tag", "cla", "tag"]


def test_malformed_texts_are_rejected(spark):
    good = ['{"a": 1}', "{}", ' {"a": {"b": 1}} \n', '{"a": "],[{"}']
    bad = ["nope", "[1,2]", '"text"', '{"a": 1} trailing', '{"a":', None, "", "null", '{"a":1} {"b":2}', '{"a":1},{"b":2}',
           '{"a":1}] [{"b":2}', "{'a': 1}", '{"a":1,}']
    df = spark.createDataFrame(list(enumerate(good + bad)), "id int, raw string")
    parsed = read_records(df, "raw", "id")
    assert sorted(r.rec_id for r in parsed.records.collect()) == list(range(len(good)))
    assert sorted(r.rec_id for r in parsed.rejected.collect()) == list(range(len(good), len(good + bad)))


def test_a_column_of_any_name_is_read(spark):
    df = spark.createDataFrame([("k1", '{"a": 1}'), ("k2", "nope"), ("k3", None)], "id string, value string").withColumn("raw", F.lit("x"))
    parsed = read_records(df, "value", "id")
    assert docs(parsed.records) == {"k1": {"a": 1}}
    assert {r.rec_id: r.raw for r in parsed.rejected.collect()} == {"k2": "nope", "k3": None}
    swapped = read_records(df.select(F.col("value").alias("rec_id"), F.col("id").alias("fields")), "rec_id", "fields")
    assert docs(swapped.records) == {"k1": {"a": 1}}


def test_null_and_absent_differ(records):
    rows = records('{"field1": null, "field2": "value"}').select("fields").first()[0]
    assert set(rows) == {"field1", "field2"}


def test_later_key_wins(records):
    got = docs(normalize_keys(records('{"userName": 1, "b": 2, "user_name": 3}', '{"a": 1, "a": 2}', '{"x": 1}')))
    assert got == {1: {"user_name": 3, "b": 2}, 2: {"a": 2}, 3: {"x": 1}}


def test_ingest_stamp_and_uuid(records):
    base = records('{"a": 1}', '{"a": 1, "sys_ingested_at": "old", "uuid": "mine"}', '{"uuid": ""}')
    got = docs(assign_uuid(stamp_ingest(base, "2024-01-02 03:04:05")))
    assert got[1]["sys_ingested_at"] == "2024-01-02T03:04:05" and got[2]["sys_ingested_at"] == "old"
    assert got[2]["uuid"] == "mine" and len(got[1]["uuid"]) == 32 and got[3]["uuid"] != got[1]["uuid"]
    again = docs(assign_uuid(base))
    assert again[1]["uuid"] == got[1]["uuid"]


def test_coerce_literal(spark):
    cases = {'"98"': ("int", "98"), "'x'": ("str", "x"), "True": ("bool", "true"), "none": ("NoneType", None), "NULL": ("NoneType", None),
             "7": ("int", "7"), "-3": ("int", "-3"), "2.50": ("float", "2.5"), "1e3": ("float", "1000.0"), "abc": ("str", "abc"),
             "": ("str", ""), "12abc": ("str", "12abc"), "5d": ("str", "5d")}
    df = spark.createDataFrame([(k,) for k in cases], "t string").withColumn("v", coerce_literal(F.col("t")))
    got = {r.t: (r.k, r.s) for r in df.select("t", type_name(F.col("v")).alias("k"), F.col("v").cast("string").alias("s")).collect()}
    assert got == cases


keys = st.sampled_from(["userName", "user_name", "UserName", "a", "A", "deviceID", "deviceId", "device_id"])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(keys, st.integers(0, 9)), max_size=6), min_size=1, max_size=8))
def test_normalize_keys_matches_a_plain_loop(records, rows):
    import re

    def snake(k):
        k = re.sub("(.)([A-Z][a-z]+)", r"\1_\2", k)
        return re.sub("([a-z0-9])([A-Z])", r"\1_\2", k).lower()

    texts = ["{" + ",".join(f'"{k}":{v}' for k, v in pairs) + "}" for pairs in rows]
    # A repeated key keeps its first place and last value, as in a JSON reader.
    want = {i: {snake(k): v for k, v in dict(pairs).items()} for i, pairs in enumerate(rows, 1)}
    got = docs(normalize_keys(records(*texts)))
    assert got == want


def test_work_folders_are_released(spark):
    import os

    from recordloom.session import landed, release

    df = landed(spark.range(3), "numbers")
    folder = os.path.dirname(df.inputFiles()[0].removeprefix("file:"))
    assert df.count() == 3 and os.path.isdir(folder)
    assert release(spark) >= 1 and not os.path.exists(folder) and release(spark) == 0


def test_the_example_of_the_readme(spark, tmp_path):
    import re
    from pathlib import Path

    lines = ['{"userName": "a", "age": 3, "orders": [{"sku": "x"}, {"sku": "y"}]}', '{"userName": "b", "age": 4}', "broken"]
    (tmp_path / "in.txt").write_text("\n".join(lines) + "\n")
    readme = (Path(__file__).resolve().parents[1] / "README.md").read_text()
    scope = {"spark": spark, "folder": str(tmp_path / "in.txt")}
    exec(re.search(r"```python\n(.*?)```", readme, re.S).group(1), scope)  # noqa: S102
    assert scope["parsed"].rejected.count() == 1 and scope["rows"].count() == 2
    assert scope["sides"].documents.count() == 2 and scope["parts"].documents.count() == 2
    assert {r["table"] for r in scope["tables"].select("table").collect()} == {"root", "root_orders"}
