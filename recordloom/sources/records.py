"""Records from JSON text, in batch and as a stream."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.plan import distinct_keys, once
from ..functions.values import OBJECT


class Parsed(NamedTuple):
    records: DataFrame
    rejected: DataFrame


def parse_records(df: DataFrame, json_col: str, id_col: str) -> DataFrame:
    """JSON text to ``(rec_id, raw, fields)``: either ``fields``, or ``raw`` where the text is
    not one JSON object.

    Keys keep their input order and a present null stays apart from an absent key.
    """
    # The JSON reader stops after the first value and would miss trailing matter.  Read as the
    # first of exactly two list elements, a text that is not one whole object shows.
    listed = F.from_json(
        F.concat(F.lit("["), F.col("raw"), F.lit(",{}]")), f"array<{OBJECT}>", {"allowSingleQuotes": "false"}
    )
    parsed = once(df.select(F.col(id_col).alias("rec_id"), F.col(json_col).alias("raw")), _listed=listed)
    first = F.when(F.array_size("_listed") == 2, F.get("_listed", F.lit(0)))
    keyed = once(once(parsed, fields=first), fields=distinct_keys(F.col("fields")))
    return keyed.select("rec_id", F.when(F.col("fields").isNull(), F.col("raw")).alias("raw"), "fields")


def split_parsed(parsed: DataFrame) -> Parsed:
    """Records and rejected texts of a parsed frame."""
    return Parsed(
        parsed.filter(F.col("fields").isNotNull()).drop("raw"),
        parsed.filter(F.col("fields").isNull()).select("rec_id", "raw"),
    )


def read_records(df: DataFrame, json_col: str, id_col: str) -> Parsed:
    """JSON text to ``records (rec_id, fields MAP<STRING, VARIANT>)`` and ``rejected (rec_id, raw)``."""
    return split_parsed(parse_records(df, json_col, id_col))


def stream_records(
    spark: SparkSession,
    folder: str,
    fmt: str = "text",
    schema: T.StructType | str = "value string",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A folder of files, or a path pattern, as a stream; the same transforms apply as in batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def to_document(fields: Column) -> Column:
    """Fields back to one compact JSON text with sorted keys."""
    return F.to_json(F.to_variant_object(fields))
