"""Ledger sums kept up to date from newly arrived lines.

A daily refresh over a large ledger should not read the whole ledger.  Each
arriving batch is summed once, by account, contract, day and profit-and-loss
flag, or by cost code, type and day, and stored beside the earlier ones.  These
sums take the place of the ledgers in `Relations`, so every report and snapshot
is computed from them by the same code.

Accounts and cost codes are joined when a report is computed: a line may arrive
before its account, and a reclassified account counts as what it is now.  Lines
without a date are kept as well.

Each ledger has its own stream, progress and sums.  A batch is stored under its
number and replaced when it is retried, so a failure in between neither loses
nor doubles a line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.calendar import AsOf
from closebook.operators import ledger as G
from closebook.operators.report import kpi_report
from closebook.operators.snapshot import snapshot
from closebook.sources.relations import Relations

LEDGERS = ("gl_debit_credit", "gl")


def summed(ledger: str, lines: DataFrame) -> DataFrame:
    """The lines of one ledger, added up as far as no report can tell."""
    if ledger == "gl_debit_credit":
        lines, amounts = G.line_amounts(lines), ("net", "rounded", "lines")
    elif ledger == "gl":
        lines, amounts = lines.select(
            "cost_code_id", "gl_type_id", "tran_date", "tran_amount"), ("tran_amount",)
    else:
        raise ValueError(f"{ledger}: not one of {LEDGERS}")
    keys = [c for c in lines.columns if c not in amounts]
    return lines.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in amounts])


def store_batch(ledger: str, lines: DataFrame, batch: int, path: str) -> None:
    """Sum the lines of one batch and store them, replacing an earlier attempt."""
    summed(ledger, lines).write.mode("overwrite").parquet(f"{path}/{ledger}/sums/batch={batch}")


def add_new_lines(ledger: str, lines: DataFrame, path: str) -> None:
    """Sum every line that arrived since the last call, then return.

    `lines` is a streaming read of the ledger's folder with the columns of the
    relation `ledger`.  Progress is kept beside the sums, so a call after a
    crash resumes where it stopped.
    """
    (
        lines.writeStream
        .foreachBatch(lambda batch, number: store_batch(ledger, batch, number, path))
        .option("checkpointLocation", f"{path}/{ledger}/progress")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _stored(spark: SparkSession, ledger: str, path: str, rel: Relations) -> DataFrame:
    """Sums of all batches; none before the first line has arrived."""
    kinds = summed(ledger, rel[ledger]).schema
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{ledger}/sums")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return spark.createDataFrame([], kinds)
    return spark.read.schema(kinds).parquet(str(folder))


def from_rollup(spark: SparkSession, path: str, rel: Relations) -> Relations:
    """`rel` with the stored sums in the place of its ledgers, which are not read.

    The ledgers of `rel` only say of which type the ids and amounts are.
    """
    return rel.replace(
        ledger_sums=_stored(spark, "gl_debit_credit", path, rel),
        gl=_stored(spark, "gl", path, rel),
    )


def snapshot_from_rollup(spark: SparkSession, path: str, rel: Relations, grain: str,
                         start=None, end=None) -> DataFrame:
    """Snapshots from the stored ledger sums and the timesheets of `rel`."""
    return snapshot(from_rollup(spark, path, rel), grain, start, end)


def report_from_rollup(spark: SparkSession, path: str, rel: Relations, as_of: AsOf) -> DataFrame:
    """The full report of any date without reading the ledgers."""
    return kpi_report(from_rollup(spark, path, rel), as_of)
