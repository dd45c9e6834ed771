"""Writing and inspecting stored tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import STORE_TYPES
from ..operators.shred import table_catalog, table_frame
from .records import to_document


def existing_columns(spark: SparkSession, path: str) -> list[str] | None:
    """Columns of a stored table, None when there is none yet."""
    try:
        return spark.read.parquet(path).columns
    except AnalysisException:
        return None


def write_structured(df: DataFrame, path: str) -> list[str]:
    """Append the columns that the stored table has (all of them to a new table)."""
    known = existing_columns(df.sparkSession, path)
    columns = df.columns if known is None else [c for c in df.columns if c in known]
    df.select(*columns).write.mode("append").parquet(path)
    return columns


def write_documents(documents: DataFrame, path: str, collection: str | None = None, mode: str = "append") -> None:
    """Append documents ``(uuid, doc[, collection][, stubs])`` as JSON text, one folder per collection."""
    name = F.lit(collection) if collection else F.col("collection")
    marks = [c for c in documents.columns if c == "stubs"]
    out = documents.select(name.alias("collection"), "uuid", to_document(F.col("doc")).alias("doc"), *marks)
    out.write.mode(mode).partitionBy("collection").parquet(path)


def write_shredded(documents: DataFrame, path: str, collection: str | None = None, mode: str = "append") -> None:
    """Append documents ``(…, doc[, collection])`` as shredded ``VARIANT`` files, one folder per collection.

    Spark takes the fields that a file's documents share into Parquet columns of their own and keeps in the remainder what differs in kind or
    is rare, so any document fits and none is changed.  Readers get whole documents as one ``VARIANT`` or, when they ask for
    fields, only those columns.  A document's keys come back in sorted order.
    """
    name = F.lit(collection) if collection else F.col("collection")
    rest = [c for c in documents.columns if c not in ("collection", "doc")]
    out = documents.select(name.alias("collection"), *rest, F.to_variant_object("doc").alias("doc"))
    out.write.mode(mode).partitionBy("collection").parquet(path)


def write_side(side: DataFrame, path: str, mode: str = "append") -> None:
    """Append decomposed payloads, one folder per side collection."""
    side.write.mode(mode).partitionBy("collection").parquet(path)


def write_tables(rows: DataFrame, path: str, catalog: DataFrame | None = None, mode: str = "append") -> list[str]:
    """Write each shredded table with its catalog types.

    The long frame lands once, one folder per table, and the catalog and each typed table
    then read only what they need of it: the source is scanned once however many tables
    there are.
    """
    landing = f"{path}/_rows"
    rows.write.mode("overwrite").partitionBy("table").parquet(landing)
    stored = rows.sparkSession.read.schema(rows.schema).parquet(landing)
    tables: dict[str, dict] = {}
    # The catalog has one row per table and column, so it is small by construction.
    for r in (table_catalog(stored) if catalog is None else catalog).collect():
        entry = tables.setdefault(r["table"], {"columns": {}, "parent": None})
        parent = r["references"]
        if r["role"] == "foreign_key" and r["type"] == "VARCHAR(36)" and r["table"].startswith(f"{parent}_"):
            entry["parent"] = parent
        elif r["column"] != "uuid":
            entry["columns"][r["column"]] = r["type"] if r["type"] in STORE_TYPES else "TEXT"
    for name, entry in sorted(tables.items()):
        frame = table_frame(stored, name, dict(sorted(entry["columns"].items())), entry["parent"])
        frame.write.mode(mode).parquet(f"{path}/{name}")
    return sorted(tables)


def table_preview(df: DataFrame, limit: int = 10, order_by: str | None = None) -> DataFrame:
    """First rows of a table; with ``order_by`` always the same ones."""
    return (df.orderBy(order_by) if order_by else df).limit(limit)


def document_preview(documents: DataFrame, keys: list[str], limit: int = 10, order_by: str = "uuid") -> DataFrame:
    """First documents as columns; ``keys`` is the union of keys to show, empty text where a
    document lacks one."""
    first = documents.orderBy(order_by).limit(limit)
    text = [F.coalesce(F.try_variant_get(F.try_element_at("doc", F.lit(k)), "$", "string"), F.lit("")).alias(k) for k in keys]
    return first.select(order_by, *text)


def preview_keys(documents: DataFrame, limit: int = 10, order_by: str = "uuid") -> list[str]:
    """Union of keys over the previewed documents (at most ``limit`` rows are read back)."""
    rows = documents.orderBy(order_by).limit(limit).select(F.map_keys("doc").alias("k")).collect()
    return list(dict.fromkeys(k for r in rows for k in r["k"]))


def store_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table; each table is counted where it lies."""
    out = None
    for name, df in tables.items():
        n = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = n if out is None else out.unionByName(n)
    return out


def export_results(df: DataFrame, path: str, fmt: str = "json") -> str:
    """A result set as JSON lines, CSV with a header, or ``key: value`` text."""
    if fmt == "csv":
        df.write.mode("overwrite").option("header", True).csv(path)
    elif fmt == "json":
        df.write.mode("overwrite").json(path)
    elif fmt == "text":
        lines = [F.concat(F.lit(f"  {c}: "), F.coalesce(F.col(c).cast("string"), F.lit("None"))) for c in df.columns]
        df.select(F.concat_ws("\n", F.lit("Record:"), *lines).alias("value")).write.mode("overwrite").text(path)
    else:
        raise ValueError(f"unknown export format: {fmt}")
    return path
