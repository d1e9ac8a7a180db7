"""Report files: ordered CSV export, and publication only after the file has been checked."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill import fixed
from panelmill.operators.validate import sum_counts
from panelmill.sources.landing import read_text_landing
from panelmill.sources.versions import Version, VersionedTable


def export_csv(df: DataFrame, path: str, order: list) -> None:
    """CSV part files with headers, sorted across files by a range partitioning.

    No single task gets the whole report: part files in name order are the order of the report.
    """
    df.orderBy(*order).write.option("header", True).option("escape", '"').csv(path)


def report_gate(df: DataFrame, key: str, rows: int) -> DataFrame:
    """One row: rows, distinct keys, and the message of a report with the wrong number of either."""
    counts = sum_counts(
        df.agg(F.count("*").alias("report_rows"), F.count_distinct(key).alias("unique_keys"))
    )
    wrong = (F.col("report_rows") != rows) | (F.col("unique_keys") != rows)
    return counts.withColumn(
        "message", F.when(wrong, F.lit(fixed.MESSAGE_REPORT_ROWS.format(rows=rows)))
    )


def publish_report(
    df: DataFrame, base: str, columns: list[str], rows: int, key: str, order: list
) -> DataFrame:
    """Export to a new folder, read it back, check header, rows and keys, then publish it.

    On failure the report that was published before stays the current one.
    """
    spark: SparkSession = df.sparkSession
    if df.columns != columns:
        raise RuntimeError(fixed.MESSAGE_REPORT_COLUMNS)
    folder = f"version={uuid.uuid4().hex}"
    export_csv(df, f"{base}/{folder}", order)
    written = read_text_landing(spark, f"{base}/{folder}", columns)
    message = report_gate(written, key, rows).first()["message"]
    if message is not None:
        raise RuntimeError(message)
    table = VersionedTable(spark, base)
    before = table.current()
    table.publish(Version((folder,), (rows,), (before.number if before else 0) + 1))
    return written


def current_report(spark: SparkSession, base: str, columns: list[str]) -> DataFrame:
    """The published report."""
    version = VersionedTable(spark, base).current()
    if version is None:
        raise FileNotFoundError(f"no report is published below {base}")
    return read_text_landing(spark, f"{base}/{version.parts[0]}", columns)
