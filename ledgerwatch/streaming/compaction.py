"""Merging the folders that a scoring stream writes, one a batch and table, into tables partitioned by day.

A segment holds a span of batches. It is complete when Spark has put its ``_SUCCESS`` file there; from then on the
batches in it are read from the segment, and their folders are removed. A compaction that is lost half way is done again:
nothing is read twice and nothing is missing at any time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerwatch.sources.folders import exists, names_in, remove

#: The time of a row in each table.
TIMES = {"scored": "scored_at", "alerts": "detected_at", "quarantine": "kafka_timestamp", "batches": "logged_at"}


def _batches(spark: SparkSession, output: str, table: str) -> list[int]:
    names = names_in(spark, f"{output}/{table}")
    return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))


def _segments(spark: SparkSession, output: str, table: str) -> list[tuple[int, int]]:
    """First and last batch of each complete segment."""
    folder = f"{output}/{table}_days"
    spans = [n.removeprefix("batches=") for n in names_in(spark, folder) if exists(spark, f"{folder}/{n}/_SUCCESS")]
    return sorted(tuple(map(int, span.split("-"))) for span in spans)


def _left(spark: SparkSession, output: str, table: str) -> list[int]:
    """Batches that no segment holds."""
    segments = _segments(spark, output, table)
    return [b for b in _batches(spark, output, table) if not any(first <= b <= last for first, last in segments)]


def compact(spark: SparkSession, output: str, table: str, up_to: int, files_per_day: int = 1) -> int:
    """Move all batches up to ``up_to``, which must be done, into one segment; how many there were."""
    waiting = [b for b in _left(spark, output, table) if b <= up_to]
    if waiting:
        paths = [f"{output}/{table}/batch_id={b}" for b in waiting]
        rows = spark.read.option("basePath", f"{output}/{table}").parquet(*paths)
        dated = rows.selectExpr("*", f"to_date({TIMES[table]}) as day").repartition(files_per_day, "day")
        place = f"{output}/{table}_days/batches={waiting[0]}-{waiting[-1]}"
        dated.write.mode("overwrite").partitionBy("day").parquet(place)
    for first, last in _segments(spark, output, table):
        for b in _batches(spark, output, table):
            if first <= b <= last:
                remove(spark, f"{output}/{table}/batch_id={b}")
    return len(waiting)


def written(spark: SparkSession, output: str, table: str) -> DataFrame:
    """All rows of a table with their ``batch_id`` and ``day``, from segments and from batches that are in none."""
    folder = f"{output}/{table}_days"
    parts = [f"{folder}/batches={first}-{last}" for first, last in _segments(spark, output, table)]
    frames = [spark.read.option("basePath", part).parquet(part) for part in parts]
    if left := _left(spark, output, table):
        paths = [f"{output}/{table}/batch_id={b}" for b in left]
        rows = spark.read.option("basePath", f"{output}/{table}").parquet(*paths)
        frames.append(rows.selectExpr("*", f"to_date({TIMES[table]}) as day"))
    if not frames:
        raise ValueError(f"the stream has written no {table} yet")
    every = frames[0]
    for more in frames[1:]:
        every = every.unionByName(more)
    return every
