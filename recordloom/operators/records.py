"""Record normalisation: key names, ingest time, identity."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.naming import snake_case
from ..functions.plan import last_wins, once


def normalize_keys(records: DataFrame) -> DataFrame:
    """Snake-case every top-level key; of two keys that collide the later one wins.

    Works inside each row (no explode, no shuffle).
    """
    entries = F.transform(
        F.map_entries("fields"),
        lambda e: F.struct(snake_case(e["key"]).alias("key"), e["value"].alias("value")),
    )
    return once(records, fields=last_wins(entries))


def with_field(fields: Column, name: str, value: Column) -> Column:
    """Add one scalar field to records that lack it."""
    added = F.map_concat(fields, F.create_map(F.lit(name), value.cast("variant")))
    return F.when(F.map_contains_key(fields, name), fields).otherwise(added)


def stamp_ingest(records: DataFrame, at: datetime | str | None = None) -> DataFrame:
    """Give records without ``sys_ingested_at`` the ingest time (ISO text)."""
    when = F.lit(at).cast("timestamp") if at is not None else F.current_timestamp()
    stamp = F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss")
    return records.withColumn("fields", with_field(F.col("fields"), "sys_ingested_at", stamp))


def assign_uuid(records: DataFrame) -> DataFrame:
    """Keep a given ``uuid``; otherwise derive one from the source key.

    A derived id is the same when a lost task is run again, which a random one is not.
    """
    given = F.nullif(F.try_variant_get(F.try_element_at("fields", F.lit("uuid")), "$", "string"), F.lit(""))
    derived = F.substring(F.sha2(F.col("rec_id").cast("string"), 256), 1, 32)
    identified = once(records, uuid=F.coalesce(given, derived))
    rest = F.map_filter("fields", lambda k, v: k != "uuid")
    return once(identified, fields=F.map_concat(rest, F.create_map(F.lit("uuid"), F.col("uuid").cast("variant"))))
