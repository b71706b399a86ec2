"""Report sink and catalog listing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_report(report: DataFrame, path: str) -> str:
    """Write a report frame as JSON, one object per row, NULL fields included."""
    report.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables and views of a database (default: the current one) as (table_name, is_temporary)."""
    listing = spark.sql(f"SHOW TABLES IN `{database}`" if database else "SHOW TABLES")
    return listing.select(
        F.col("tableName").alias("table_name"), F.col("isTemporary").alias("is_temporary")
    )


def present_tables(
    spark: SparkSession, names: Sequence[str], database: str | None = None
) -> dict[str, DataFrame]:
    """Those of `names` that the catalog holds."""
    prefix = f"{database}." if database else ""
    return {
        name: spark.table(prefix + name)
        for name in names
        if spark.catalog.tableExists(prefix + name)
    }
