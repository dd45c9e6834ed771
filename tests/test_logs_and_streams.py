import json
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from recordloom.operators import oplog as T
from recordloom.operators.profile import field_profile
from recordloom.operators.records import normalize_keys
from recordloom.operators.route import resolve_references
from recordloom.operators.shred import reconstruct
from recordloom.session import work_folder
from recordloom.sources.catalog import load_catalog, newest_version, save_catalog
from recordloom.sources.records import read_records, stream_records, to_document
from recordloom.sources.tables import export_results, write_structured
from recordloom.streaming.ingest import (
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
from recordloom.streaming.sessions import stream_sessions


def test_latency_literals(spark):
    df = spark.createDataFrame([("op", x) for x in (10.5, 20.3, 15.2)], "operation string, ms double")
    row = T.latency_stats(df, "operation", "ms").first()
    assert (row["count"], row.min_ms, row.max_ms, row.p50_ms, row.p95_ms) == (3, 10.5, 20.3, 15.2, 20.3) and row.avg_ms > 15


@pytest.mark.parametrize("steps, bound", [(1, 60), (3, 5), (2, 20), (7, 1), (7, 100_000)])
def test_exact_percentiles_match_sorting(spark, monkeypatch, steps, bound):
    """One operation of many distinct values, one of repeats: no task sorts more than the bound."""
    sorted_at_once = []
    real = T._picked
    monkeypatch.setattr(T, "_picked", lambda near, by: sorted_at_once.append(near.groupBy(*by).count().agg(F.max("count")).first()[0] or 0) or real(near, by))
    rng = random.Random(steps)
    data = {"hot": [float(rng.randint(0, 400)) for _ in range(3000)], "one": [5.0], "same": [2.0] * 50,
            "wide": [rng.random() * 1e6 for _ in range(777)]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "operation string, ms double")
    got = {r.operation: r for r in T.latency_stats(df, "operation", "ms", steps, bound).collect()}
    assert max(sorted_at_once) <= bound
    for k, vs in data.items():
        vs = sorted(vs)
        want = [vs[math.floor(len(vs) * q)] for q in (0.5, 0.95, 0.99)]
        assert [got[k].p50_ms, got[k].p95_ms, got[k].p99_ms] == want and got[k]["count"] == len(vs)


def test_errors_have_their_own_key(spark):
    df = spark.createDataFrame([("read", 1.0, False), ("read", 9.0, True)], "operation string, ms double, failed boolean")
    split = T.error_split(df, "operation", F.col("failed"))
    assert sorted(r.operation for r in T.latency_stats(split, "operation", "ms").collect()) == ["read", "read_ERROR"]
    assert T.slow_operations(df, "ms", 5).count() == 1


def test_sessions_expire(spark):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:00", "x"), ("a", "2024-01-01 03:00:00", "y"), ("b", "2024-01-01 00:30:00", "z"),
                                ("c", "2024-01-01 01:30:00", "w")], "u string, t string, role string").withColumn("t", F.col("t").cast("timestamp"))
    now = F.lit("2024-01-01 03:10:00").cast("timestamp")
    live = T.active_sessions(df, "u", "t", now, ["role"], F.unix_timestamp("t") + 900).collect()
    assert [(r.u, r.role, r.expires_in_sec) for r in live] == [("a", "y", 300), ("c", "w", 0)]


def ops(*rows):
    return [dict(zip(("type", "action", "collection", "unique_check", "status", "retries"), r)) for r in rows]


@pytest.fixture
def txlog(spark):
    schema = ("tx_id string, status string, ops array<struct<type:string,action:string,collection:string,"
              "unique_check:string,status:string,retries:int>>")
    return spark.createDataFrame([
        ("t1", "in_progress", ops(("sql", "insert", "s", "k1", "pending", 0), ("mongo", "insert", "m", "k1", "pending", 2))),
        ("t2", "pending", ops(("sql", "insert", "s", "k2", "done", 0), ("mongo", "insert", "m", "k2", "retrying", 1))),
        ("t3", "committed", ops(("sql", "insert", "s", "k3", "done", 0))),
    ], schema)


def test_recovery_steps(spark, txlog):
    assert sorted(r.tx_id for r in T.incomplete_transactions(txlog).collect()) == ["t1", "t2"]
    present = spark.createDataFrame([("m", "k2")], "collection string, unique_check string")
    todo = T.pending_ops_to_apply(txlog, present)
    assert sorted((r.tx_id, r.op_index) for r in todo.collect()) == [("t1", 0), ("t1", 1)]
    outcomes = spark.createDataFrame([("t1", 0, "applied"), ("t1", 1, "error"), ("t2", 1, "present")], "tx_id string, op_index int, outcome string")
    after = T.advance_op_state(txlog, outcomes)
    states = {(r.tx_id, r.op_index): (r.status, r.retries) for r in T.exploded_ops(after).collect()}
    assert states == {("t1", 0): ("done", 0), ("t1", 1): ("failed", 3), ("t2", 0): ("done", 0), ("t2", 1): ("done", 1), ("t3", 0): ("done", 0)}
    assert {r.tx_id: r.status for r in T.transaction_rollup(after).collect()} == {"t1": "in_progress", "t2": "committed", "t3": "committed"}
    again = T.advance_op_state(txlog, spark.createDataFrame([("t1", 0, "error")], "tx_id string, op_index int, outcome string"))
    assert T.exploded_ops(again).filter("tx_id = 't1' AND op_index = 0").first().status == "retrying"


def test_checksums_ignore_state(spark, txlog):
    names = ["type", "action", "collection", "unique_check"]
    one = T.exploded_ops(T.annotate_ops(txlog, names)).orderBy("tx_id", "op_index").collect()
    assert len({r.checksum for r in one}) == 5 and len({r.idempotency_key for r in one}) == 5 and all(r.status == "pending" for r in one)
    two = T.exploded_ops(T.annotate_ops(T.transaction_rollup(txlog), names)).orderBy("tx_id", "op_index").collect()
    assert [r.checksum for r in one] == [r.checksum for r in two]


def test_recent_entries_are_clamped(spark):
    log = spark.range(700).withColumnRenamed("id", "n")
    got = T.recent_entries(log, 1000, ["n"]).collect()
    assert len(got) == 200 and got[0].n == 699 and got[0].total == 500
    assert len(T.recent_entries(log, 0, ["n"]).collect()) == 1


def test_catalog_versions(spark):
    base = work_folder(spark, "catalog")
    assert load_catalog(spark, base) == {} and newest_version(spark, base) is None
    for version in (1, 2, 10):
        save_catalog({"t": spark.range(version)}, base, version)
    save_catalog({"t": spark.range(5)}, base, 10)
    assert newest_version(spark, base) == 10 and load_catalog(spark, base)["t"].count() == 5
    # A version without its mark does not count.
    spark.range(1).write.parquet(f"{base}/t/version=11")
    assert newest_version(spark, base) == 10 and load_catalog(spark, base, 2)["t"].count() == 2


def test_write_structured_keeps_known_columns(spark):
    path = work_folder(spark, "structured")
    write_structured(spark.createDataFrame([(1, "a")], "id int, v string"), path)
    assert write_structured(spark.createDataFrame([(2, "b", True)], "id int, v string, extra boolean"), path) == ["id", "v"]
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "b")]


def test_exports(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    base = work_folder(spark, "export")
    assert spark.read.json(export_results(df, f"{base}/j", "json")).count() == 2
    assert spark.read.option("header", True).csv(export_results(df, f"{base}/c", "csv")).columns == ["id", "v"]
    text = "\n".join(r.value for r in spark.read.text(export_results(df, f"{base}/t", "text")).collect())
    assert "  id: 2" in text and "  v: None" in text
    with pytest.raises(ValueError):
        export_results(df, base, "xml")


def write_batches(folder, batches, start=0):
    os.makedirs(folder, exist_ok=True)
    for n, texts in enumerate(batches, start):
        path = os.path.join(folder, f"{n:03d}.txt")
        with open(path, "w") as f:
            f.write("\n".join(texts) + "\n")
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))


def texts_of(n, start, **extra):
    out = []
    for i in range(start, start + n):
        doc = {"userName": f"u{i % 5}", "recId": i, "steady": "s", "payload": {"x": i}, **{k: v(i) for k, v in extra.items()}}
        out.append(json.dumps({k: v for k, v in doc.items() if v is not None}))
    return out


def keyed(stream):
    return stream.select(F.get_json_object("value", "$.recId").alias("key"), F.col("value").alias("raw"))


BATCHES = [
    texts_of(20, 0, mood=lambda i: "ok", big=lambda i: "z" * 1500 if i == 3 else None),
    texts_of(20, 20, mood=lambda i: "ok" if i % 5 else None) + ["broken {"],
    texts_of(20, 40, mood=lambda i: None, steady=lambda i: i),
]


def test_adaptive_ingest_over_batches(spark):
    folder, base = work_folder(spark, "in"), work_folder(spark, "out")
    write_batches(folder, BATCHES)
    stream = keyed(stream_records(spark, folder, files_per_trigger=1))
    adaptive_ingest(stream, base, "raw", "key", available_now=True, ingested_at="2024-01-01 00:00:00").awaitTermination()
    structured, docs = read_structured(spark, base), read_documents(spark, base)
    assert structured.count() == 60 and docs.count() == 60 and structured.select("uuid").distinct().count() == 60
    targets = [{r.field: r.target for r in load_catalog(spark, f"{base}/catalog", n)["decisions"].collect()} for n in range(3)]
    assert targets[0]["mood"] == "SQL" and targets[1]["mood"] == "SQL" and targets[2]["mood"] == "MONGO"
    assert targets[1]["steady"] == "SQL" and targets[2]["steady"] == "MONGO"
    assert all(t["username" if "username" in t else "user_name"] in ("SQL", "BOTH") for t in targets)
    assert [r.parent_uuid for r in read_side(spark, base).filter("collection = 'decomposed_big'").collect()] != []
    assert spark.read.parquet(f"{base}/rejected").count() == 1
    total = load_catalog(spark, f"{base}/catalog")["total"].first()[0]
    assert total == 60
    # No field of any record is lost between the two sides.
    by_id = {r.uuid: json.loads(r.d) for r in docs.select("uuid", to_document(F.col("doc")).alias("d")).collect()}
    for r in structured.collect():
        assert by_id[r.uuid]["payload"]["x"] == r.rec_id
        assert ("steady" in by_id[r.uuid]) != (r.steady is not None)


    catalog = load_catalog(spark, f"{base}/catalog")
    assert sorted(r.field for r in catalog["drift"].collect()) == ["mood", "steady"]
    history = catalog["history"].orderBy("schema_version").collect()
    assert [r.schema_version for r in history] == list(range(1, len(history) + 1))
    assert {(r.field, r.change) for r in history if r.change == "retargeted"} == {("mood", "retargeted"), ("steady", "retargeted")}
    left, moved = current_view(spark, base)
    assert not {"mood", "steady"} & set(left.columns) and moved.count() == 60
    steady = moved.select(F.try_variant_get(F.col("doc")["steady"], "$", "string").alias("s"))
    assert steady.filter("s = 's'").count() == 40 and steady.filter("s IS NULL").count() == 0


def test_both_sides_give_the_record_back(spark):
    base = work_folder(spark, "out")
    df = spark.createDataFrame([(t,) for t in BATCHES[0]], "value string")
    ingest_batch(keyed(df), 0, base, "raw", "key", "2024-01-01 00:00:00")
    docs = resolve_references(read_documents(spark, base).select("uuid", "doc"), read_side(spark, base)).documents
    made = reconstruct(read_structured(spark, base), "uuid", docs)
    got = sorted((json.loads(r.record) for r in made.collect()), key=lambda d: d["rec_id"])
    for record, text in zip(got, BATCHES[0], strict=True):
        source = json.loads(text)
        assert record.pop("sys_ingested_at") == "2024-01-01T00:00:00" and len(record.pop("uuid")) == 32
        assert record == {{"userName": "user_name", "recId": "rec_id"}.get(k, k): v for k, v in source.items()}


def test_a_retried_batch_changes_nothing(spark):
    base = work_folder(spark, "retry")

    def run(n):
        df = spark.createDataFrame([(t,) for t in BATCHES[n]], "value string")
        ingest_batch(keyed(df), n, base, "raw", "key", "2024-01-01 00:00:00")

    run(0), run(1)
    before = load_catalog(spark, f"{base}/catalog", 1)["profile"].orderBy("field").collect()
    run(1)
    assert load_catalog(spark, f"{base}/catalog", 1)["profile"].orderBy("field").collect() == before
    assert read_structured(spark, base).count() == 40 and read_documents(spark, base).count() == 40


def test_streamed_profile_equals_batch_profile(spark):
    folder, base = work_folder(spark, "in"), work_folder(spark, "out")
    write_batches(folder, BATCHES)
    stream = keyed(stream_records(spark, folder, files_per_trigger=1))
    stream_profile(stream, base, "raw", "key").awaitTermination()
    from recordloom.operators.records import normalize_keys

    batch = normalize_keys(read_records(keyed(spark.read.text(folder)), "raw", "key").records)
    want = sorted(map(tuple, field_profile(batch).collect()))
    assert sorted(map(tuple, streamed_profile(spark, base).collect())) == want


def test_streamed_sessions_close_with_the_watermark(spark):
    folder, base = work_folder(spark, "in"), work_folder(spark, "out")
    rows = [("a", "2024-01-01T00:00:00"), ("a", "2024-01-01T01:30:00"), ("b", "2024-01-01T00:10:00"),
            ("a", "2024-01-01T05:00:00"), ("b", "2024-01-01T09:00:00"), ("z", "2024-01-02T00:00:00")]
    lines = [json.dumps({"u": u, "t": t}) for u, t in rows]
    write_batches(folder, [lines[:3], lines[3:5], lines[5:]])
    raw = stream_records(spark, folder, files_per_trigger=1)
    log = raw.select(F.get_json_object("value", "$.u").alias("u"), F.get_json_object("value", "$.t").cast("timestamp").alias("t"))
    out = stream_sessions(log, "u", "t")
    out.writeStream.format("parquet").option("path", f"{base}/o").option("checkpointLocation", f"{base}/c").outputMode(
        "append").trigger(availableNow=True).start().awaitTermination()
    got = sorted((r.u, r.events, r.session_start.hour) for r in spark.read.schema(out.schema).parquet(f"{base}/o").collect())
    assert got == [("a", 1, 5), ("a", 2, 0), ("b", 1, 0), ("b", 1, 9)]


def test_work_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark, "x").startswith(base)


def test_running_profile_state_follows_fields_and_resumes(spark, tmp_path):
    """Many batches, a stop in between: the state holds a row a field, and the profile equals that of all records."""
    folder, base = str(tmp_path / "in"), str(tmp_path / "out")
    lines = [json.dumps({"a": i, "b": None if i % 3 else "t", "c": {"d": i}} if i % 2 else {"a": str(i)}) for i in range(60)]
    stream = lambda: stream_records(spark, folder, files_per_trigger=1).withColumn("id", F.sha2("value", 256))
    write_batches(folder, [lines[i:i + 5] for i in range(0, 30, 5)])
    query = stream_running_profile(stream(), base, "value", "id")
    query.awaitTermination()
    write_batches(folder, [lines[i:i + 5] for i in range(30, 60, 5)], start=6)
    again = stream_running_profile(stream(), base, "value", "id")
    again.awaitTermination()
    assert again.lastProgress["stateOperators"][0]["numRowsTotal"] == 4  # three fields and the records
    got = {r.field: (r["count"], r.frequency_ratio, r.type_stability, r.detected_type, r.unique_count) for r in running_profile(spark, base).collect()}
    texts = spark.createDataFrame([(str(i), t) for i, t in enumerate(lines)], "id string, value string")
    want = field_profile(normalize_keys(read_records(texts, "value", "id").records)).collect()
    assert got == {r.field: (r["count"], r.frequency_ratio, r.type_stability, r.detected_type, r.unique_count) for r in want}
    assert len(os.listdir(f"{base}/profile")) <= 2 + 1
