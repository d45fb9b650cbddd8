"""Read relations from files or over JDBC, always with the declared schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.sources.relations import Relations, conform, normalise_text
from closebook.sources.schemas import FACTS, SCHEMAS


def read_columnar(spark: SparkSession, folder: str, names: Iterable[str] | None = None,
                  fmt: str = "parquet", normalise: bool = True,
                  check_keys: bool = True) -> Relations:
    """One parquet or ORC table per relation under `folder`.

    The dimensions are read once to refuse repeated keys; `check_keys=False` spares that.
    """
    tables = {
        name: conform(spark.read.format(fmt).load(f"{folder}/{name}"), name)
        for name in names or SCHEMAS
    }
    return _relations(tables, normalise, check_keys)


def read_csv(spark: SparkSession, name: str, path: str, **options: str) -> DataFrame:
    """A spreadsheet or survey export; columns are declared, never inferred."""
    return (
        spark.read.schema(SCHEMAS[name])
        .options(header="true", mode="FAILFAST", **options)
        .csv(path)
    )


def read_json(spark: SparkSession, name: str, path: str, **options: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).options(mode="FAILFAST", **options).json(path)


def read_jdbc(spark: SparkSession, url: str, tables: Mapping[str, str],
              split_on: Mapping[str, tuple[str, object, object, int]] | None = None,
              normalise: bool = True, check_keys: bool = True,
              parts: Mapping[str, list[str]] | None = None, **options: str) -> Relations:
    """Relations kept in a database.

    `tables` maps a relation to its table or view.  `split_on` gives, for every
    relation of `FACTS`, (column, lowest, highest, partitions) so that the read
    runs as parallel range queries instead of one connection; `parts` gives the
    predicates of the queries instead, for uneven columns (`splits.predicates`).
    """
    split_on, parts = split_on or {}, parts or {}
    whole = sorted(set(tables) & set(FACTS) - set(split_on) - set(parts))
    if whole:
        raise ValueError(f"split_on is missing for {', '.join(whole)}")
    loaded = {}
    for name, table in tables.items():
        if name in parts:
            loaded[name] = conform(spark.read.jdbc(
                url, table, predicates=parts[name], properties=dict(options)), name)
            continue
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
        if name in split_on:
            column, low, high, number = split_on[name]
            reader = reader.options(partitionColumn=column, lowerBound=str(low),
                                    upperBound=str(high), numPartitions=str(number))
        loaded[name] = conform(reader.options(**options).load(), name)
    return _relations(loaded, normalise, check_keys)


def read_month_partitioned(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A dated relation written by `write_month_partitioned`.

    The month column stays in the plan, tied to the date, so a date condition
    should be given with `in_months` to prune folders as well as row groups.
    """
    return spark.read.parquet(path).select(
        *[F.col(f.name).cast(f.dataType) for f in SCHEMAS[name]], F.col("month")
    )


def in_months(table: DataFrame, first, last, column: str = "tran_date") -> DataFrame:
    """Rows dated first..last, reading only the month folders that can hold them."""
    return table.filter(
        F.col("month").between(F.trunc(F.lit(first), "MM"), F.trunc(F.lit(last), "MM"))
        & F.col(column).between(F.lit(first), F.lit(last))
    )


def write_month_partitioned(table: DataFrame, path: str, column: str = "tran_date",
                            files_per_month: int = 16) -> None:
    """Store a dated relation by month.

    Rows of one month are spread over `files_per_month` writers by a hash of
    the row, so a month that holds most rows does not land in one task.  Small
    ledgers may ask for fewer.
    """
    keyed = table.withColumn("month", F.trunc(F.col(column), "MM"))
    slot = F.pmod(F.xxhash64(*[F.col(c) for c in table.columns]), F.lit(files_per_month))
    (
        keyed.repartition(F.col("month"), slot)
        .write.mode("overwrite").partitionBy("month").parquet(path)
    )


def _relations(tables: dict[str, DataFrame], normalise: bool, check_keys: bool) -> Relations:
    if normalise and "ar_inquiry" in tables:
        tables["ar_inquiry"] = normalise_text(tables["ar_inquiry"], "gl_type_name")
    relations = Relations(tables)
    if check_keys:
        relations.check_unique_keys()
    return relations
