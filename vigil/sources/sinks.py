"""Sinks: one-row JSON reports, CSV tables, parquet logs."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report_json(report: DataFrame, path: str) -> None:
    """A one-row report as a single JSON file (coalesce(1) is safe: one row)."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_table_log(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
