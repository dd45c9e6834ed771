"""Catalog snapshots: small tables kept per version.

Layout ``<base>/<name>/version=N``; ``<base>/_complete`` is written last, so that a version
counts only once all its tables are there.  Writing a version again replaces it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "complete"


def save_catalog(tables: dict[str, DataFrame], base: str, version: int) -> None:
    spark = None
    for name, df in tables.items():
        spark = df.sparkSession
        df.coalesce(1).write.mode("overwrite").parquet(f"{base}/{name}/version={version}")
    names = ",".join(sorted(tables))
    spark.range(1).select(F.lit(names).alias("tables")).coalesce(1).write.mode("overwrite").parquet(
        f"{base}/{MARK}/version={version}"
    )


def newest_version(spark: SparkSession, base: str) -> int | None:
    """Highest complete version, None for an empty catalog."""
    try:
        return spark.read.parquet(f"{base}/{MARK}").agg(F.max("version")).first()[0]
    except AnalysisException:
        return None


def load_catalog(spark: SparkSession, base: str, version: int | None = None) -> dict[str, DataFrame]:
    """Tables of the newest (or given) complete version; empty when there is none."""
    version = newest_version(spark, base) if version is None else version
    if version is None:
        return {}
    mark = spark.read.parquet(f"{base}/{MARK}/version={version}").first()
    return {name: spark.read.parquet(f"{base}/{name}/version={version}") for name in mark["tables"].split(",")}
