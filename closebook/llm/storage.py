"""Tables written between the steps of an operator."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from closebook.sources.shared import shared_folder


#: small rows that one task may write to one file
ROWS_PER_FILE, LEAST_FILES = 250_000, 8
#: Spark's setting by which the shuffle files of a query go when it has ended
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's setting by which a join takes rows that lie by some of its keys as they lie
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def stored(frame: DataFrame, purpose: str, rows: int | None = None) -> DataFrame:
    """`frame` written as Parquet to the shared folder and read again.

    This cuts the lineage: what follows reads files that survive a lost executor.  `rows`, an
    upper bound of the number of rows, lets few rows go to few files.  The shuffle files of
    `frame` go when it is written, not when the driver happens to collect its garbage.
    """
    return _written(frame, f"{shared_folder(frame.sparkSession, purpose)}/part", rows)


@contextmanager
def _setting(spark: SparkSession, **values: str) -> Iterator[None]:
    """The session with these settings, for a while."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _written(frame: DataFrame, path: str, rows: int | None, as_they_lie: bool = False,
             **options: str) -> DataFrame:
    if rows is not None:
        frame = frame.coalesce(max(LEAST_FILES, rows // ROWS_PER_FILE))
    settings = {SHUFFLE_CLEANUP: "true", **({ALL_KEYS: "false"} if as_they_lie else {})}
    with _setting(frame.sparkSession, **settings):
        frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


class WorkingTables:
    """Tables that one computation stores and that go when its result is stored.

    They lie in one new folder of their own below the shared folder, which is all that is
    removed.  What is returned after the end must not depend on them.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark, self._folder, self._tables = spark, shared_folder(spark, "working"), 0

    def stored(self, frame: DataFrame, purpose: str, rows: int | None = None,
               as_they_lie: bool = False, **options: str) -> DataFrame:
        """As `stored`; `options` are those of the Parquet writer.

        `as_they_lie` lets joins of several keys use rows that were repartitioned by some of them.
        """
        self._tables += 1
        return _written(frame, f"{self._folder}/{self._tables}-{purpose}", rows, as_they_lie,
                        **options)

    def __enter__(self) -> WorkingTables:
        return self

    def __exit__(self, *failure) -> None:
        context = self._spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(self._folder)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
