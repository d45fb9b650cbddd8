"""Relations mapped from retail-style test tables (see FIXTURES.md, part 2).

The mapping only gives the columns plausible variety.  Every relation is a
lazy projection of the files, so filters and column selection reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.sources.relations import Relations

DEFAULT_AS_OF = "2001-07-15"

# Column types of the test files, so that opening one needs no inference job
FILES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
}

# Descriptions of the account type codes 0 to 12
ACCOUNT_TYPES = (
    "Other Asset", "Other Asset", "Accounts Receivable", "Bank", "Accounts Payable",
    "Cost of Goods Sold", "Credit Card Account", "Expense", "Other Current Liability", "Income",
    "Long Term Liability", "Other Expense", "Other Income",
)


def _money(value: Column) -> Column:
    return value.cast("decimal(18,2)")


def _share(amount: Column, rate: Column) -> Column:
    return _money(F.round(amount * rate.cast("decimal(4,2)"), 2))


class RetailTables:
    """The mapping, one method per relation, over the files of one folder."""

    def __init__(self, spark: SparkSession, folder: str, **files: DataFrame):
        self.spark, self.folder = spark, folder
        self._files = files

    def file(self, name: str) -> DataFrame:
        if name not in self._files:
            self._files[name] = self.spark.read.schema(FILES[name]).parquet(
                f"{self.folder}/{name}.parquet"
            )
        return self._files[name]

    @property
    def _lines(self) -> DataFrame:
        return self.file("lineitem").withColumns({
            "amount": _money(F.col("l_extendedprice")),
            "tran_date": F.col("l_shipdate").cast("date"),
        })

    @property
    def _regions(self) -> DataFrame:
        # nation and region are fixed lists of 25 and 5 rows at every scale
        return self.file("nation").join(
            self.file("region"), F.col("n_regionkey") == F.col("r_regionkey")
        ).select("n_nationkey", F.col("r_name").alias("department"))

    def _contract_count(self) -> Column:
        return self.file("supplier").agg(F.count("*")).scalar()

    def gl_debit_credit(self) -> DataFrame:
        flag = F.col("l_returnflag")
        return self._lines.select(
            F.col("l_suppkey").alias("contract_id"),
            F.col("l_partkey").alias("account_id"),
            (F.col("l_linenumber") + 62).alias("gl_type_id"),
            "tran_date",
            F.when(flag == "A", F.col("amount"))
            .when(flag == "R", _share(F.col("amount"), F.col("l_discount"))).alias("debit"),
            F.when(flag.isin("N", "R"), F.col("amount")).alias("credit"),
        )

    def gl(self) -> DataFrame:
        return self._lines.select(
            F.col("l_partkey").alias("cost_code_id"),
            (F.col("l_linenumber") + 1).alias("gl_type_id"),
            "tran_date",
            F.col("amount").alias("tran_amount"),
        )

    def cost_codes(self) -> DataFrame:
        return self.file("part").select(
            F.col("p_partkey").alias("cost_code_id"), F.col("p_size").cast("string").alias("number")
        )

    def accounts(self) -> DataFrame:
        key, kind = F.col("p_partkey"), F.col("account_type_id")
        description = F.get(F.array(*[F.lit(text) for text in ACCOUNT_TYPES]), kind)
        return (
            self.file("part")
            .withColumn("account_type_id", (key % 13).cast("int"))
            .select(
                key.alias("account_id"),
                "account_type_id",
                description.alias("account_type"),
                F.when(key % 26 == 8, F.lit("20700 Overbillings"))
                .otherwise(F.concat_ws(" ", key.cast("string"), F.col("p_name")))
                .alias("code_name"),
                kind.between(0, 3).cast("int").alias("is_asset"),
                kind.isin(4, 6, 8, 10).cast("int").alias("is_liability"),
                (key % 26 == 5).alias("is_in_staff"),
            )
        )

    def contract_values(self) -> DataFrame:
        return self.file("supplier").select(
            F.col("s_suppkey").alias("contract_id"),
            _money(F.col("s_acctbal") * 10000).alias("original_value"),
        )

    def contract_activity(self) -> DataFrame:
        approved = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
        return self._lines.select(
            F.col("l_suppkey").alias("contract_id"),
            "tran_date",
            F.when(approved, _share(F.col("amount"), F.col("l_tax"))).alias("change_order"),
            F.col("amount").alias("billed"),
        )

    def projects(self) -> DataFrame:
        key = F.col("s_suppkey")
        return (
            self.file("supplier")
            .join(self._regions, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                key.alias("contract_id"),
                F.when(F.col("s_nationkey") % 3 == 0, 1).otherwise(2).alias("status_id"),
                F.when(key % 17 == 0, F.lit("00.000"))
                .otherwise(F.concat(key.cast("string"), F.lit(".000"))).alias("project_number"),
                "department",
            )
        )

    def contract_tasks(self) -> DataFrame:
        return self._lines.filter(
            (F.col("l_linestatus") == "O") & (F.col("l_suppkey") % 5 != 0)
        ).select(
            F.col("l_suppkey").alias("contract_id"),
            F.when(F.col("l_linenumber") != 7, _money(F.col("l_quantity"))).alias("quantity"),
            "amount",
        )

    def budget_items(self) -> DataFrame:
        return self._lines.filter(F.col("l_linestatus") == "F").select(
            F.col("l_suppkey").alias("contract_id"), "amount"
        )

    def daily_time(self) -> DataFrame:
        hours = (_money(F.col("value")) * F.lit("0.02").cast("decimal(3,2)")).cast("decimal(18,4)")
        overtime = F.when(F.col("event_type") == "error", F.lit("0.25")).otherwise(F.lit("0"))
        clock_in = F.timestamp_add("DAY", F.lit(-8400), F.col("ts"))
        worked = F.round(F.col("value") * 72).cast("int")
        return self.file("events").select(
            F.when(F.col("user_id") % 10 != 0, F.col("event_id") % self._contract_count())
            .alias("contract_id"),
            F.col("user_id").alias("employee_id"),
            hours.alias("hours"),
            (hours + overtime.cast("decimal(4,2)")).cast("decimal(18,4)").alias("total"),
            clock_in.alias("in_time"),
            F.timestamp_add("SECOND", worked, clock_in).alias("out_time"),
        )

    def employees(self) -> DataFrame:
        segment = F.col("c_mktsegment")
        return self.file("customer").select(
            F.col("c_custkey").alias("employee_id"),
            (_money(F.col("c_acctbal")) * F.lit("0.01").cast("decimal(3,2)"))
            .cast("decimal(18,4)").alias("wage"),
            F.when(segment == "MACHINERY", 1).when(segment != "BUILDING", 0).alias("temp_hire"),
        )

    def ar_inquiry(self) -> DataFrame:
        invoices = self.file("orders").select(
            F.col("o_orderkey").alias("trans_doc_id"),
            F.lit("PAYAPP").alias("gl_type_name"),
            F.col("o_orderdate").cast("date").alias("tran_date"),
            F.when(F.col("o_orderstatus") == "F", _money(F.lit(0)))
            .otherwise(_money(F.col("o_totalprice"))).alias("balance_due"),
            F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey"))
            .alias("project"),
        )
        payments = self._lines.filter(F.col("l_returnflag") != "N").select(
            F.col("l_orderkey").alias("trans_doc_id"),
            F.lit("PAYAPP-PMT").alias("gl_type_name"),
            "tran_date",
            _money(F.lit(0)).alias("balance_due"),
            F.col("l_suppkey").alias("project"),
        )
        return invoices.unionByName(payments)

    def retainage(self) -> DataFrame:
        return self.file("orders").filter(F.col("o_orderstatus") == "P").select(
            (F.col("o_custkey") % self._contract_count()).alias("contract_id"),
            F.col("o_orderdate").cast("date").alias("tran_date"),
            _share(_money(F.col("o_totalprice")), F.lit("0.1")).alias("unpaid_retainage"),
        )

    def survey(self) -> DataFrame:
        employees = self.file("customer").join(
            self._regions, F.col("c_nationkey") == F.col("n_nationkey")
        )
        return (
            self.file("events").filter(F.col("event_type") == "view")
            .join(employees, F.col("user_id") == F.col("c_custkey"))
            .select(
                F.col("event_id").alias("response_id"),
                F.col("ts").alias("submitted_at"),
                F.col("user_id").alias("employee_id"),
                "department",
                (F.floor("value").cast("int") % 5 + 1).alias("score"),
            )
        )

    def external_sheet(self) -> DataFrame:
        ordered, price = F.col("o_orderdate"), _money(F.col("o_totalprice"))
        in_2000 = (ordered >= F.lit("2000-01-01").cast("timestamp_ntz")) & (
            ordered < F.lit("2001-01-01").cast("timestamp_ntz")
        )
        return (
            self.file("orders").filter(in_2000)
            .groupBy(F.col("o_orderpriority").alias("metric"))
            .agg(*[
                F.sum(F.when(F.month(ordered) == m, price)).cast("decimal(18,2)").alias(f"m{m:02d}")
                for m in range(1, 13)
            ])
        )


RELATIONS = (
    "gl_debit_credit", "gl", "cost_codes", "accounts", "contract_values", "contract_activity",
    "projects", "contract_tasks", "budget_items", "daily_time", "employees", "ar_inquiry",
    "retainage", "survey", "external_sheet",
)


def relations(spark: SparkSession, sf_dir: str, **files: DataFrame) -> Relations:
    """Relations over a folder; `files` replaces single files, say by a part of one."""
    tables = RetailTables(spark, sf_dir, **files)
    return Relations({name: getattr(tables, name) for name in RELATIONS})
