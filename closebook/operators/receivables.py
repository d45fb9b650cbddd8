"""Invoice and payment timing, receivable aging and retainage."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.calendar import AsOf
from closebook.functions.scalars import literal, one_of
from closebook.plans.measures import Measure
from closebook.sources.relations import Relations

# Document types, days-to-pay windows and aging bucket bounds
INVOICE, PAYMENT = "PAYAPP", "PAYAPP-PMT"
PAY_WINDOWS = (30, 60, 90, 180, 365)
AGING_BUCKETS = {
    "aging_0_30": (0, 30),
    "aging_31_60": (31, 60),
    "aging_61_90": (61, 90),
    "aging_91_180": (91, 180),
    "aging_181_plus": (181, None),
}


def invoice_pairs(rel: Relations, after: date | None = None) -> DataFrame:
    """Latest invoice and latest payment date of documents that have both.

    With `after`, only documents whose latest invoice is later: a row of that day or before
    can be neither such an invoice nor a payment after it, so the bound reaches the scan.
    """
    def latest(kind: str) -> str:
        return f"max(CASE WHEN gl_type_name = {literal(kind)} THEN tran_date END)"

    rows = rel.ar_inquiry.filter(one_of("gl_type_name", (INVOICE, PAYMENT)))
    if after is not None:
        rows = rows.filter(f"tran_date > {literal(after)}")
    return (
        rows
        .groupBy("trans_doc_id")
        .agg(
            F.expr(latest(INVOICE)).alias("invoice_date"),
            F.expr(latest(PAYMENT)).alias("payment_date"),
        )
        .filter("invoice_date IS NOT NULL AND payment_date IS NOT NULL")
    )


def days_to_pay(rel: Relations, after: date | None = None) -> DataFrame:
    """Days from invoice to payment; payments on or before the invoice day are left out."""
    return invoice_pairs(rel, after).filter("payment_date > invoice_date").selectExpr(
        "invoice_date", "datediff(payment_date, invoice_date) AS days_diff"
    )


def average_days_to_pay(rel: Relations, as_of: AsOf,
                        windows: Iterable[int | None] = (*PAY_WINDOWS, None)) -> DataFrame:
    """One row with `pay_<days>` per window and `pay_all` for None."""
    days = "CAST(days_diff AS DOUBLE)"
    windows = list(windows)
    after = None if None in windows or not windows else as_of.days_back(max(windows))
    return days_to_pay(rel, after).agg(*[
        F.expr(f"avg({days}) AS pay_all") if n is None
        else F.expr(f"avg(CASE WHEN invoice_date > {literal(as_of.days_back(n))}"
                    f" THEN {days} END) AS pay_{n}")
        for n in windows
    ])


def receivable_aging(rel: Relations, as_of: AsOf) -> DataFrame:
    """One row: average age and the outstanding balance per age bucket.

    Rows count if unpaid, dated and tied to a project.  Those dated after the
    as-of date are in the average but in no bucket.
    """
    rows = rel.ar_inquiry.filter(
        "balance_due > 1 AND tran_date IS NOT NULL AND project IS NOT NULL"
    ).selectExpr("balance_due", f"datediff({literal(as_of.today)}, tran_date) AS age")
    buckets = [
        Measure(name, "balance_due",
                f"age >= {low}" if high is None else f"age BETWEEN {low} AND {high}").sum()
        for name, (low, high) in AGING_BUCKETS.items()
    ]
    return rows.agg(F.expr("avg(CAST(age AS DOUBLE)) AS age_avg"), *buckets)


def aging_bucket(rel: Relations, as_of: AsOf, name: str) -> DataFrame:
    """One bucket alone, read only for its dates."""
    low, high = AGING_BUCKETS[name]
    dated = f"tran_date <= {literal(as_of.days_back(low))}"
    if high is not None:
        dated += f" AND tran_date >= {literal(as_of.days_back(high))}"
    return rel.ar_inquiry.filter(
        f"{dated} AND balance_due > 1 AND project IS NOT NULL"
    ).agg(F.sum("balance_due").alias(name))


def unbilled_retainage(rel: Relations, as_of: AsOf) -> DataFrame:
    """Retainage not yet billed as of the run date."""
    if "ar_aging" in rel.given:
        return rel.given["ar_aging"]([as_of.today]).agg(
            F.sum("unpaid_retainage").alias("retainage"))
    return rel.retainage.filter(f"tran_date <= {literal(as_of.today)}").agg(
        F.sum("unpaid_retainage").alias("retainage")
    )
