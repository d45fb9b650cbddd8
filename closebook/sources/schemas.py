"""The input relations and their columns."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
QUANTITY = T.DecimalType(18, 4)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_LONG, _INT, _TEXT, _DATE, _TIME = (
    T.LongType(), T.IntegerType(), T.StringType(), T.DateType(), T.TimestampNTZType(),
)

SCHEMAS: dict[str, T.StructType] = {
    # ledger lines, debit and credit side
    "gl_debit_credit": _schema(
        contract_id=_LONG, account_id=_LONG, gl_type_id=_INT, tran_date=_DATE,
        debit=MONEY, credit=MONEY,
    ),
    # signed ledger by cost code
    "gl": _schema(cost_code_id=_LONG, gl_type_id=_INT, tran_date=_DATE, tran_amount=MONEY),
    "cost_codes": _schema(cost_code_id=_LONG, number=_TEXT),
    "accounts": _schema(
        account_id=_LONG, account_type_id=_INT, account_type=_TEXT, code_name=_TEXT,
        is_asset=_INT, is_liability=_INT, is_in_staff=T.BooleanType(),
    ),
    # one row per contract, and the dated movements its totals are made of
    "contract_values": _schema(contract_id=_LONG, original_value=MONEY),
    "contract_activity": _schema(
        contract_id=_LONG, tran_date=_DATE, change_order=MONEY, billed=MONEY
    ),
    "projects": _schema(
        contract_id=_LONG, status_id=_INT, project_number=_TEXT, department=_TEXT
    ),
    "daily_time": _schema(
        contract_id=_LONG, employee_id=_LONG, hours=QUANTITY, total=QUANTITY,
        in_time=_TIME, out_time=_TIME,
    ),
    "employees": _schema(employee_id=_LONG, wage=QUANTITY, temp_hire=_INT),
    "contract_tasks": _schema(contract_id=_LONG, quantity=MONEY, amount=MONEY),
    "budget_items": _schema(contract_id=_LONG, amount=MONEY),
    "ar_inquiry": _schema(
        trans_doc_id=_LONG, gl_type_name=_TEXT, tran_date=_DATE, balance_due=MONEY,
        project=_LONG,
    ),
    # dated retainage movements behind the receivable aging summary
    "retainage": _schema(contract_id=_LONG, tran_date=_DATE, unpaid_retainage=MONEY),
    "survey": _schema(
        response_id=_LONG, submitted_at=_TIME, employee_id=_LONG, department=_TEXT, score=_INT
    ),
    "external_sheet": T.StructType(
        [T.StructField("metric", _TEXT)]
        + [T.StructField(f"m{month:02d}", MONEY) for month in range(1, 13)]
    ),
}

#: Relations that must hold at most one row per key; joins rely on it.
UNIQUE_KEYS: dict[str, str] = {
    "accounts": "account_id",
    "cost_codes": "cost_code_id",
    "contract_values": "contract_id",
    "projects": "contract_id",
    "employees": "employee_id",
}

#: Relations that grow with the business; a database read of one must run in parallel.
FACTS = ("gl_debit_credit", "gl", "contract_activity", "daily_time", "contract_tasks",
         "budget_items", "ar_inquiry", "retainage")

#: Date that says when a row became known, for relations that carry one.
KNOWN_DATES: dict[str, str] = {
    "gl_debit_credit": "tran_date",
    "gl": "tran_date",
    # sums by day that stand for the first ledger (`rollup.from_rollup`)
    "ledger_sums": "tran_date",
    "contract_activity": "tran_date",
    "daily_time": "in_time",
    "ar_inquiry": "tran_date",
    "retainage": "tran_date",
    "survey": "submitted_at",
}
