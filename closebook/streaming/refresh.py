"""Repeatable refresh of stored snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.calendar import AsOf
from closebook.operators.controls import observed, refuse_losses
from closebook.operators.report import kpi_report
from closebook.sources.relations import Relations

SNAPSHOT_KEYS = ("grain", "as_of")


def store_snapshot(snapshots: DataFrame, path: str) -> None:
    """Replace exactly the (grain, as_of) partitions present in `snapshots`.

    Writing the same dates again leaves the same rows, and a failed write
    leaves the previous ones, because partitions are swapped on commit.
    """
    (
        # a partition is a few dozen rows: one file each
        snapshots.repartition(*SNAPSHOT_KEYS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*SNAPSHOT_KEYS)
        .parquet(path)
    )


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(
        "ordinal INT, metric STRING, value DOUBLE, grain STRING, as_of DATE"
    ).parquet(path)


def refresh(rel: Relations, as_of: AsOf, path: str, grain: str = "day",
            report: DataFrame | None = None) -> None:
    """Store the full report for one date, replacing that date only.

    Metrics of current state get their history this way and no other: one
    stored report per refresh.  `report` defaults to a report computed from
    all relations; pass `rollup.report_from_rollup` to spare the ledger.
    """
    report = kpi_report(rel, as_of) if report is None else report
    store_snapshot(
        report.withColumns({"grain": F.lit(grain), "as_of": F.lit(as_of.today)}), path
    )


CONTROLS = "lines BIGINT, net DECIMAL(38,6), lines_without_date BIGINT, grain STRING, as_of DATE"


def checked_refresh(rel: Relations, as_of: AsOf, path: str, grain: str = "day") -> None:
    """`refresh` under `path`/reports, with control totals of the same pass under `path`/controls.

    Nothing is stored, and `LostLines` is raised, if the ledger has fewer lines than at the refresh
    of an earlier date.  The report has 36 rows, which wait for the comparison.
    """
    watched, seen = observed(rel)
    report = kpi_report(watched, as_of)
    rows = report.collect()
    spark, now = rel.spark, {name: value or 0 for name, value in seen.get.items()}
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/controls")
    if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        before = spark.read.schema(CONTROLS).parquet(f"{path}/controls").filter(
            F.col("as_of") <= F.lit(as_of.today)).agg(F.max("lines").alias("lines")).first()
        refuse_losses(before.asDict(), now)
    refresh(rel, as_of, f"{path}/reports", grain, spark.createDataFrame(rows, report.schema))
    totals = (int(now["lines"]), str(now["net"]), int(now["lines_without_date"]), grain, as_of.today)
    store_snapshot(spark.createDataFrame([totals], "lines LONG, net STRING, lines_without_date LONG, "
                                         "grain STRING, as_of DATE").withColumn(
        "net", F.col("net").cast("decimal(38,6)")), f"{path}/controls")
