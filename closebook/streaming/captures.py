"""Captured reports in two times: the date a report is for, and the day it was captured.

Budgets, tasks and project status carry no dates, so their metrics have a history only as captured.
A capture is added and never overwrites an earlier one: a late capture, or a correction of a past
period, is a later capture of the same as-of date.  Reading "as known on a day" takes, for every
report, the latest capture that is not after that day.

A capture is one folder (grain, as-of date, capture day).  A retry on the same day replaces exactly
that folder, so it leaves the same rows; folders that cannot be wanted are not read.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.calendar import AsOf
from closebook.operators.report import kpi_report
from closebook.operators.snapshot import DAY, MONTH, WEEK
from closebook.sources.relations import Relations

KEYS = ("grain", "as_of", "captured_on")
SCHEMA = ("ordinal INT, metric STRING, value DOUBLE, grain STRING, as_of DATE, "
          "captured_on DATE")


def period_ends(grain: str, first: date, last: date) -> list[date]:
    """The period ends of a grain from `first` to `last`: days, Sundays, or last days of months."""
    days = (first + timedelta(days=k) for k in range((last - first).days + 1))
    closes = {
        DAY: lambda day: True,
        WEEK: lambda day: day.isoweekday() == 7,
        MONTH: lambda day: (day + timedelta(days=1)).day == 1,
    }[grain]
    return [day for day in days if closes(day)]


def capture(rel: Relations, dates: Iterable[date], path: str, captured_on: date,
            grain: str = DAY) -> None:
    """Store the full report of each date as captured on a day, all in one write."""
    reports = [
        kpi_report(rel, AsOf(day)).withColumn("as_of", F.lit(day)) for day in sorted(set(dates))]
    if not reports:
        return
    rows = reduce(DataFrame.unionByName, reports).withColumns(
        {"grain": F.lit(grain), "captured_on": F.lit(captured_on)})
    (
        # a report is a few dozen rows: one file each
        rows.repartition(*KEYS).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*KEYS).parquet(path)
    )


def capture_due(rel: Relations, path: str, captured_on: date, since: date,
                grains: Iterable[str] = (WEEK, MONTH)) -> None:
    """Capture every period end since a day that has no capture yet, late ones included."""
    held = {(row["grain"], row["as_of"]) for row in
            captured(rel.spark, path).select("grain", "as_of").distinct().collect()}
    for grain in grains:
        due = [day for day in period_ends(grain, since, captured_on) if (grain, day) not in held]
        capture(rel, due, path, captured_on, grain)


def captured(spark: SparkSession, path: str) -> DataFrame:
    """All captures; none before the first one."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def as_known(spark: SparkSession, path: str, day: date) -> DataFrame:
    """The reports as they were known on a day: `SCHEMA`, one row per report and metric.

    Captures after the day are left out by their folder.  A metric that the latest capture has as
    null is null, whatever earlier ones said.
    """
    known = captured(spark, path).filter(F.col("captured_on") <= F.lit(day))
    return known.groupBy("grain", "as_of", "ordinal", "metric").agg(
        F.max_by("value", "captured_on").alias("value"),
        F.max("captured_on").alias("captured_on"))


def corrections(spark: SparkSession, path: str) -> DataFrame:
    """Values that a later capture changed: what was said before, and what after.

    `grain`, `as_of`, `ordinal`, `metric`, `captured_on`, `before`, `value`.
    """
    every = captured(spark, path)
    said = F.struct("captured_on", "value")
    series = every.groupBy("grain", "as_of", "ordinal", "metric").agg(
        F.array_sort(F.collect_list(said)).alias("said"))
    pairs = series.select("grain", "as_of", "ordinal", "metric", F.explode(F.expr(
        "filter(transform(said, (x, i) -> named_struct('captured_on', x.captured_on,"
        " 'before', get(said, i - 1).value, 'value', x.value, 'first', i = 0)),"
        " x -> not x.first and not (x.before <=> x.value))")).alias("c"))
    return pairs.select("grain", "as_of", "ordinal", "metric", "c.captured_on", "c.before",
                        "c.value")
