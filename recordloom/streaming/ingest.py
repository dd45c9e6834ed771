"""Adaptive ingestion as a stream: normalise, profile, classify, route, decompose, write.

Each micro-batch writes under its own ``batch_id`` and replaces what an earlier attempt of
the same batch left, so a retried batch neither loses nor repeats rows.  The catalog
carries the profile from batch to batch as fixed-size partials (counts, type masks, HLL
sketches), one row per field.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.plan import once, spread
from ..functions.values import TYPE_BITS, fingerprint, lookup, plain_text, type_name
from ..operators.classify import decide_targets, detect_drift, migrate_drifted
from ..operators.profile import (
    cells,
    field_counts,
    finish_profile,
    merge_sketch_partials,
    merge_value_partials,
    schema_changes,
    sketch_partials,
    value_partials,
)
from ..operators.records import assign_uuid, normalize_keys, stamp_ingest
from ..operators.route import decompose_large, route_records
from ..sources.catalog import load_catalog, save_catalog
from ..sources.records import parse_records, read_records, split_parsed, to_document
from ..sources.tables import write_documents, write_side

# Fixed value: pause between micro-batches of a continuous stream.
BATCH_PAUSE = "2 seconds"


def ingest_batch(batch: DataFrame, batch_id: int, base: str, json_col: str, id_col: str, ingested_at=None) -> None:
    """One micro-batch through the whole pipeline, writing below ``base``."""
    spark = batch.sparkSession
    kept = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    try:
        texts = parse_records(spread(batch), json_col, id_col)
        # Rejected texts travel along with NULL fields, so that the batch is parsed once.
        parsed = split_parsed(keep(assign_uuid(stamp_ingest(normalize_keys(texts), ingested_at))))
        records = parsed.records
        # The catalog this batch extends is the one of the batch before it, so that a retry
        # of the same batch starts from the same state.
        before = load_catalog(spark, f"{base}/catalog", batch_id - 1) if batch_id > 0 else {}
        without_id = records.select("rec_id", F.map_filter("fields", lambda k, v: k != "uuid").alias("fields"))
        partials = sketch_partials(cells(without_id))
        total = records.agg(F.count(F.lit(1)).alias("records"))
        if before:
            partials = merge_sketch_partials(partials, before["partials"])
            total = total.unionByName(before["total"]).agg(F.sum("records").alias("records"))
        partials, total = keep(partials), keep(total)
        profile = finish_profile(field_counts(partials), total.scalar())
        decisions = keep(decide_targets(profile, before.get("decisions")))
        routed = route_records(records, decisions)
        parts = decompose_large(routed.documents, mark=True)
        here = f"batch_id={batch_id}"
        routed.structured.write.mode("overwrite").parquet(f"{base}/structured/{here}")
        write_documents(parts.documents, f"{base}/documents/{here}", "documents", mode="overwrite")
        write_side(parts.side, f"{base}/side/{here}", mode="overwrite")
        parsed.rejected.write.mode("overwrite").parquet(f"{base}/rejected/{here}")
        catalog = {"partials": partials, "total": total, "profile": profile, "decisions": decisions}
        history = _history(before, decisions)
        _move_drifted(spark, base, batch_id, [r["field"] for r in history["drift"].collect()])  # columns of the table
        save_catalog({**catalog, **history}, f"{base}/catalog", batch_id)
    finally:
        for df in kept:
            df.unpersist()


def _move_drifted(spark, base: str, batch_id: int, drifted: list[str]) -> None:
    """Write the values that earlier batches stored in columns which are document fields from now on.

    Only those columns are read.  A retry of the batch writes the same folder again.
    """
    if not drifted or not batch_id:
        return
    stored = spark.read.option("mergeSchema", True).parquet(f"{base}/structured").filter(F.col("batch_id") < batch_id)
    _, moved = migrate_drifted(stored, stored.select("uuid", F.lit(None).cast("map<string,variant>").alias("doc")).limit(0), drifted)
    moved.select("uuid", to_document(F.col("doc")).alias("doc")).write.mode("overwrite").parquet(f"{base}/moved/batch_id={batch_id}")


def _history(before: dict[str, DataFrame], decisions: DataFrame) -> dict[str, DataFrame]:
    """Schema changes so far and the fields that drifted in this batch."""
    if not before:
        nothing = decisions.limit(0)
        return {"history": schema_changes(nothing, decisions), "drift": detect_drift(nothing, decisions)}
    last = before["history"].agg(F.coalesce(F.max("schema_version"), F.lit(0))).first()[0]
    changes = schema_changes(before["decisions"], decisions, last + 1)
    return {
        "history": before["history"].unionByName(changes),
        "drift": detect_drift(before["decisions"], decisions),
    }


def adaptive_ingest(stream: DataFrame, base: str, json_col: str, id_col: str, available_now: bool = False,
                    ingested_at=None) -> StreamingQuery:
    """Start the pipeline on a stream; ``available_now`` drains what is there and stops."""
    writer = stream.writeStream.foreachBatch(
        lambda df, n: ingest_batch(df, n, base, json_col, id_col, ingested_at)
    ).option("checkpointLocation", f"{base}/_checkpoint")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=BATCH_PAUSE)
    return writer.start()


def read_structured(spark, base: str) -> DataFrame:
    """All structured rows; batches written before a column existed show NULL."""
    return spark.read.option("mergeSchema", True).parquet(f"{base}/structured").drop("batch_id")


def read_documents(spark, base: str) -> DataFrame:
    stored = spark.read.parquet(f"{base}/documents")
    return stored.select("collection", "uuid", F.from_json("doc", "map<string,variant>").alias("doc"), "stubs")


def read_side(spark, base: str) -> DataFrame:
    return spark.read.schema(
        "parent_uuid string, data string, created_at timestamp, batch_id int, collection string"
    ).parquet(f"{base}/side").drop("batch_id")


def read_moved(spark, base: str) -> DataFrame | None:
    """Values moved out of drifted columns as ``(uuid, doc)``, or None if no field has drifted."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/moved")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    stored = spark.read.schema("uuid string, doc string, batch_id int").parquet(f"{base}/moved")
    return stored.select("uuid", F.from_json("doc", "map<string,variant>").alias("_moved"))


def current_view(spark, base: str) -> tuple[DataFrame, DataFrame]:
    """Both sides as the newest decisions want them: columns that drifted are gone from the structured side, and
    their values, moved when they drifted, are in the documents."""
    structured = read_structured(spark, base)
    documents = read_documents(spark, base).select("uuid", "doc", "stubs")
    newest = load_catalog(spark, f"{base}/catalog")["decisions"]
    # Only columns of the structured table are asked for, so the answer is schema-sized.
    gone = newest.filter((F.col("target") == "MONGO") & F.col("field").isin(*structured.columns)).select("field")
    structured = structured.drop(*[r["field"] for r in gone.collect()])
    moved = read_moved(spark, base)
    if moved is None:
        return structured, documents
    # A field may have drifted in several batches, each with rows of its own.
    merged = moved.groupBy("uuid").agg(F.collect_list("_moved").alias("_all"))
    joined = documents.join(merged, "uuid", "full_outer")
    doc = F.coalesce("doc", F.create_map().cast("map<string,variant>"))
    whole = F.aggregate(F.coalesce("_all", F.array().cast("array<map<string,variant>>")), doc, lambda d, m: F.map_concat(
        d, F.map_filter(m, lambda k, v: ~F.map_contains_key(d, k))))
    return structured, joined.select("uuid", whole.alias("doc"), "stubs")


def stream_running_profile(stream: DataFrame, base: str, json_col: str, id_col: str, available_now: bool = True) -> StreamingQuery:
    """Running field profile whose state is in the state store: one row a field (count, type mask, HLL sketch of its values) and
    one for the records, whatever the number of batches.

    A batch is added by partial aggregation, so each task sends one row a field.  The whole profile, small as it is, is
    written per batch; the two newest are kept, and a restart goes on from the checkpoint.
    """
    parsed = normalize_keys(read_records(stream, json_col, id_col).records)
    # The entry without a key counts the record itself.
    entries = F.concat(F.map_entries("fields"), F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("variant").alias("value"))))
    cell = once(parsed.select(F.explode(entries).alias("e")).select("e.key", "e.value"), kind=type_name(F.col("value")))
    state = cell.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.bit_or(lookup(TYPE_BITS, F.col("kind"))).alias("types"),
        F.hll_sketch_agg(fingerprint(plain_text(F.col("value"), F.col("kind")))).alias("sketch"))

    def step(profile: DataFrame, n: int) -> None:
        profile.coalesce(1).write.mode("overwrite").parquet(f"{base}/profile/batch_id={n}")
        _forget(profile.sparkSession, f"{base}/profile/batch_id={n - 2}")

    writer = state.writeStream.outputMode("complete").foreachBatch(step).option("checkpointLocation", f"{base}/_checkpoint")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=BATCH_PAUSE)
    return writer.start()


def _forget(spark, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def running_profile(spark, base: str) -> DataFrame:
    """The profile as of the last batch."""
    stored = spark.read.parquet(f"{base}/profile")
    newest = stored.filter(F.col("batch_id") == stored.agg(F.max("batch_id")).scalar()).drop("batch_id")
    total = newest.filter(F.col("key").isNull()).agg(F.coalesce(F.max("n"), F.lit(0))).scalar()
    return finish_profile(field_counts(newest.filter(F.col("key").isNotNull())), total)


def stream_profile(stream: DataFrame, base: str, json_col: str, id_col: str, available_now: bool = True) -> StreamingQuery:
    """Running field profile: every batch leaves its exact partials and its record count."""

    def step(batch: DataFrame, n: int) -> None:
        records = normalize_keys(read_records(spread(batch), json_col, id_col).records)
        records.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            value_partials(cells(records)).write.mode("overwrite").parquet(f"{base}/partials/batch_id={n}")
            records.agg(F.count(F.lit(1)).alias("records")).write.mode("overwrite").parquet(f"{base}/totals/batch_id={n}")
        finally:
            records.unpersist()

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{base}/_checkpoint")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=BATCH_PAUSE)
    return writer.start()


def streamed_profile(spark, base: str) -> DataFrame:
    """The profile over everything streamed so far."""
    partials = merge_value_partials(spark.read.parquet(f"{base}/partials").drop("batch_id"))
    total = spark.read.parquet(f"{base}/totals").agg(F.sum("records")).scalar()
    return finish_profile(field_counts(partials), total)
