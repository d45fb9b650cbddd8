"""Parallel database reads in even parts, and reads of what is new since the last one.

A range cut into equal steps gives one partition most rows when ids are uneven.  Here the cuts are
quantiles of the column, so parts hold about equal numbers of rows; a value that fills more than a
part becomes a part of its own.  The parts are plain predicates: disjoint, together complete,
nulls included, whatever happened to the table since the quantiles were taken.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: accuracy of the quantiles: the rank is off by at most one in so many of all rows
ACCURACY = 10_000


def sql_value(value: object) -> str:
    """A value as a literal that databases read."""
    if isinstance(value, bool) or value is None:
        raise TypeError(f"cannot split on {value!r}")
    if isinstance(value, (date, datetime, str)):
        text = str(value).replace("'", "''")
        return f"'{text}'"
    return str(value)


def split_points(keys: DataFrame, column: str, parts: int) -> list:
    """The quantiles of a column that cut it into `parts`, in order, with repetitions.

    `keys` needs the column only, as an index of the database offers it.  One pass, one row back.
    """
    if parts < 2:
        return []
    ranks = [k / parts for k in range(1, parts)]
    found = keys.agg(F.percentile_approx(column, ranks, ACCURACY).alias("points")).first()
    return list(found["points"] or [])


def predicates(column: str, points: Sequence) -> list[str]:
    """Conditions that take every row exactly once, rows without a value among the first.

    A point that comes more than once is a value that fills a part, and stands alone.
    """
    cuts = sorted(set(points))
    if not cuts:
        return ["1 = 1"]
    hot = {p for p in cuts if list(points).count(p) > 1}
    out, low = [], None
    for point in cuts:
        above = "" if low is None else f"{column} > {sql_value(low)} AND "
        if point in hot:
            out += [f"{above}{column} < {sql_value(point)}", f"{column} = {sql_value(point)}"]
        else:
            out.append(f"{above}{column} <= {sql_value(point)}")
        low = point
    out[0] = f"({out[0]}) OR {column} IS NULL"
    return [*out, f"{column} > {sql_value(low)}"]


class HighWaterMark:
    """The greatest value of a column that has been read, kept beside what was made of it.

    `read_new` hands over the rows above the mark and up to a new one, fixed before anything is
    read, together with the number of the batch.  The mark moves only when the work is done: after
    a failure the same rows come again under the same number, for a store that replaces by number.
    """

    def __init__(self, spark: SparkSession, path: str, column: str) -> None:
        self._spark, self._path, self._column = spark, path, column

    def _kept(self) -> DataFrame | None:
        folder = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._path)
        files = folder.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration())
        return self._spark.read.parquet(self._path) if files.exists(folder) else None

    def last(self) -> tuple[int, object]:
        """Number of the last finished batch, -1 before the first, and its mark."""
        kept = self._kept()
        row = None if kept is None else kept.orderBy(F.desc("batch")).first()
        return (-1, None) if row is None else (row["batch"], row["mark"])

    def read_new(self, table: DataFrame, work: Callable[[DataFrame, int], None]) -> int:
        """Call `work(rows, batch)` for what is new; returns the batch, or -1 if nothing is.

        Rows without a value are never above a mark; they are part of the first batch.
        """
        batch, mark = self.last()
        column = F.col(self._column)
        newer = table if mark is None else table.filter(column > F.lit(mark))
        top = newer.agg(F.max(column).alias("mark"))
        reached = top.first()["mark"]
        if reached is None:
            return -1
        rows = newer.filter((column <= F.lit(reached)) | column.isNull())
        work(rows, batch + 1)
        kept = self._spark.createDataFrame([(batch + 1, reached)], "batch INT, mark " + dict(
            top.dtypes)["mark"])
        kept.coalesce(1).write.mode("append").parquet(self._path)
        return batch + 1
