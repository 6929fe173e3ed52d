"""Tables and report files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_alerts(alerts: DataFrame, path: str) -> None:
    """Alerts as a table partitioned by day, so that reading recent days leaves out the rest.

    The days that ``alerts`` has replace those of the table; a write that is repeated changes nothing.
    """
    dated = alerts.withColumn("alert_date", F.to_date("detected_at"))
    writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("alert_date").parquet(path)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report as JSON lines; reports have one row or a few."""
    report.coalesce(1).write.mode("overwrite").json(path)
