"""Business performance indicators as Spark jobs.

Given ledger, contract, timesheet, budget and receivable relations and one
as-of date, the package computes 36 financial, work-in-progress, labour and
collection metrics in a few shared passes, and extends the same definitions
to weekly and monthly snapshots, department views and survey trends.
"""

from closebook.calendar import AsOf
from closebook.sources.relations import Relations

__all__ = ["AsOf", "Relations"]
