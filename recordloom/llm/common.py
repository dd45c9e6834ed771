"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.plan import let, once
from ..session import landed, work_folder

__all__ = ["check_fold", "fold", "landed", "let", "of_rows", "once", "ranked", "ship", "table", "utf8_lower", "work_folder", "worker_memory"]

# One bucket of a ranking is sorted by one task: a 256th of a key's rows.
RANK_BUCKETS = 256
FOLDS = 5


def ship(module: str) -> None:
    """Send the functions of a module to executors with the plan, so that they need no
    installed copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def worker_memory() -> dict:
    """A dictionary that lives as long as the Python worker, shared by the tasks it runs one after another."""
    return sys.modules.setdefault("_recordloom_worker", types.ModuleType("_recordloom_worker")).__dict__


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """crc32 of the id's text, modulo 5; a null id belongs to fold 1 (never held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS, F.lit(1)).cast("int")


def check_fold(doc_id: Column) -> Column:
    """True for rows that are held out of every fit."""
    return fold(doc_id) == 0


def utf8_lower(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does that to an ASCII text and does it fast; other
    texts go character by character, so that their other capitals stay."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def ranked(df: DataFrame, keys: list[str], order: list[str], out: str, few: bool = True) -> DataFrame:
    """Add ``out``: a gapless rank from 0 within each key, with no task that holds a key whole.

    Rows are dealt by a hash of ``order`` into buckets of their key; bucket counts give each
    bucket its first rank, and rows are numbered inside their bucket.  The order is that of
    the hash: as good as random, and the same in every run.  Equal rows get different ranks.
    ``df`` is read twice, so it should be a scan or a landed table.  Nulls are keys.  Meant for few keys
    (shards, lanes): the first ranks, 256 short rows a key, are broadcast unless ``few`` is false.
    """
    rows = df.withColumn("_hash", F.xxhash64(*order)).withColumn(
        "_bucket", F.pmod(F.shiftright("_hash", 20), F.lit(RANK_BUCKETS))
    )
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        rows.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
        .withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(*[F.col(k).alias(f"_at_{k}") for k in keys], F.col("_bucket").alias("_at_bucket"), "_first")
    )
    same = F.col("_bucket") == F.col("_at_bucket")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_at_{k}"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_hash", *order)
    return (
        rows.withColumn("_in", F.row_number().over(inside) - 1)
        .join(F.broadcast(first) if few else first, same)  # keys x 256 short rows
        .withColumn(out, F.col("_first") + F.col("_in"))
        .drop("_hash", "_bucket", "_in", "_first", "_at_bucket", *[f"_at_{k}" for k in keys])
    )


def of_rows(make: Callable[[list], list], schema: pa.Schema, *columns: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function: ``make`` takes lists of the named columns' values (zipped) and
    returns one tuple per output row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = make(list(zip(*[batch.column(c).to_pylist() for c in columns], strict=True)))
            values = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema
            )

    return run
