"""Changes to stored sides rewrite the buckets they touch and no others."""

import json
import os

import pytest
from pyspark.sql import functions as F

from recordloom.operators.shred import reconstruct
from recordloom.sources import buckets as B


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def sides(spark, tmp_path):
    rows = spark.range(400).select(F.col("id").cast("string").alias("uuid"), (F.col("id") % 100).cast("int").alias("age"), F.concat(F.lit("n"), "id").alias("name"))
    doc = F.when(F.col("age") == 3, F.create_map(F.lit("age"), F.lit("old").cast("variant"))).otherwise(F.create_map().cast("map<string,variant>"))
    docs = rows.select("uuid", doc.alias("doc"))
    paths = str(tmp_path / "rows"), str(tmp_path / "docs")
    B.write_buckets(rows.withColumn("age", F.when(F.col("age") != 3, F.col("age"))), paths[0], buckets=16)
    B.write_buckets(docs, paths[1], buckets=16)
    return paths


def logical(spark, rows, docs):
    whole = reconstruct(B.read_buckets(spark, rows), "uuid", B.read_buckets(spark, docs))
    return {r.uuid: json.loads(r.record) for r in whole.collect()}


def test_an_update_rewrites_its_buckets_only(spark, sides):
    before, old = [files(p) for p in sides], logical(spark, *sides)
    assert len(old) == 400 and B.update_stored(spark, *sides, {"name": "n7"}, {"age": "seven"}, {"age": "SQL"}, buckets=16) == 1
    for path, was in zip(sides, before, strict=True):
        assert len(was) == 16 and len(was - files(path)) == 1 == len(files(path) - was)
    assert logical(spark, *sides) == old | {"7": {"age": "seven", "name": "n7"}}
    # A value that only documents hold is found, and moves to the column.
    assert B.update_stored(spark, *sides, {"age": {"$in": ["old", "seven"]}}, {"age": 5}, {"age": "SQL"}, buckets=16) >= 1
    new = logical(spark, *sides)
    assert len(new) == 400 and {k for k, v in new.items() if v["age"] == 5} >= {"7", "3", "103", "203", "303", "5"}
    assert B.update_stored(spark, *sides, {"name": "nobody"}, {"age": 1}, {"age": "SQL"}, buckets=16) == 0


def test_a_delete_empties_buckets(spark, sides):
    before = files(sides[0])
    doomed = [r.uuid for r in B.read_buckets(spark, sides[0], [2]).collect()]
    assert B.delete_stored(spark, {sides[0]: "uuid", sides[1]: "uuid"}, *sides, {"name": {"$in": [f"n{u}" for u in doomed]}}, buckets=16) == 1
    assert len(before - files(sides[0])) == 1 and files(sides[0]) < before
    left = logical(spark, *sides)
    assert len(left) == 400 - len(doomed) and not set(doomed) & set(left) and B.read_buckets(spark, sides[1]).count() == len(left)
    assert B.delete_stored(spark, {sides[0]: "uuid"}, *sides, {"name": "n7"}, buckets=16) == 1


def test_only_asked_buckets_are_read(spark, sides):
    plan = B.read_buckets(spark, sides[0], [1, 2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan
