"""Tables in hash buckets of their key, so that a change rewrites the buckets it touches and no others.

A bucket is a partition folder ``_bucket=N``.  Rows of one key are in one bucket on every side that has the same number of buckets.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.mutate import chosen_ids, update_where
from ..session import landed

BUCKET = "_bucket"
BUCKETS = 64


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, key: str = "uuid", buckets: int = BUCKETS) -> None:
    """Write a table anew in buckets; a bucket is one file unless Spark splits a large one."""
    rows = df.withColumn(BUCKET, bucket_of(F.col(key), buckets))
    rows.repartition(buckets, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def read_buckets(spark: SparkSession, path: str, only: list[int] | None = None) -> DataFrame:
    """The stored rows, of all buckets or of some: others are not listed or read."""
    stored = spark.read.parquet(path)
    return (stored if only is None else stored.filter(F.col(BUCKET).isin(only))).drop(BUCKET)


def touched(ids: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets of some keys; no more than there are buckets."""
    return sorted(r[0] for r in ids.select(bucket_of(F.col(key), buckets)).distinct().collect())


def rewrite_buckets(spark: SparkSession, path: str, hit: list[int], change: Callable[[DataFrame], DataFrame], key: str = "uuid",
                    buckets: int = BUCKETS) -> None:
    """Replace the hit buckets by what ``change`` makes of their rows.

    The new rows are written to the shared folder before any old file goes.  Spark replaces exactly the folders that get rows; a
    bucket that is left without rows is removed after that.
    """
    if not hit:
        return
    new = landed(change(read_buckets(spark, path, hit)).withColumn(BUCKET, bucket_of(F.col(key), buckets)), "buckets")
    new.repartition(len(hit), BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    filled = {r[0] for r in new.select(BUCKET).distinct().collect()}
    fs, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    for bucket in sorted(set(hit) - filled):
        folder = fs.Path(f"{path}/{BUCKET}={bucket}")
        folder.getFileSystem(conf).delete(folder, True)


def update_stored(spark: SparkSession, structured: str, documents: str, spec: dict[str, Any], changes: dict[str, Any], routes: dict[str, str],
                  default: str = "MONGO", buckets: int = BUCKETS) -> int:
    """``update_where`` over two stored sides; returns the number of buckets that were rewritten.

    Records are chosen over both sides; then only the buckets they are in are read again, changed and written.
    """
    ids = landed(chosen_ids(read_buckets(spark, structured), read_buckets(spark, documents), spec).select("uuid"), "hits")
    hit = touched(ids, "uuid", buckets)
    if not hit:
        return 0
    rows, docs = read_buckets(spark, structured, hit), read_buckets(spark, documents, hit)
    done = update_where(rows, docs, spec, changes, routes, default)
    # Both results are computed before either side is replaced.
    new_rows, new_docs = landed(done.structured, "changed"), landed(done.documents, "changed")
    rewrite_buckets(spark, structured, hit, lambda _: new_rows, buckets=buckets)
    rewrite_buckets(spark, documents, hit, lambda _: new_docs, buckets=buckets)
    return len(hit)


def delete_stored(spark: SparkSession, sides: dict[str, str], structured: str, documents: str, spec: dict[str, Any], buckets: int = BUCKETS) -> int:
    """Delete the records that satisfy ``spec`` from every stored side ``path: key column``; returns the number of their buckets."""
    ids = landed(chosen_ids(read_buckets(spark, structured), read_buckets(spark, documents), spec).select("uuid"), "hits")
    hit = touched(ids, "uuid", buckets)
    for path, key in sides.items():
        gone = ids.select(F.col("uuid").alias(key))
        rewrite_buckets(spark, path, hit, lambda rows, gone=gone, key=key: rows.join(gone, key, "left_anti").select(*rows.columns), key, buckets)
    return len(hit)
