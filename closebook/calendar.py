"""The dates every metric is measured against, all derived from one as-of date."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta


def _month_start(d: date, months: int = 0) -> date:
    """First day of the month `months` away from the month of `d`."""
    index = d.year * 12 + d.month - 1 + months
    return date(index // 12, index % 12 + 1, 1)


@dataclass(frozen=True)
class AsOf:
    """One run date and the reporting boundaries that follow from it.

    Every boundary is month arithmetic on the run date, so January and leap
    days need no special case.
    """

    today: date

    @classmethod
    def parse(cls, value: AsOf | date | str) -> AsOf:
        if isinstance(value, AsOf):
            return value
        return cls(date.fromisoformat(value) if isinstance(value, str) else value)

    @property
    def year_start(self) -> date:
        return date(self.today.year, 1, 1)

    @property
    def month_start(self) -> date:
        """First day of the last completed month."""
        return _month_start(self.today, -1)

    @property
    def month_end(self) -> date:
        """Last day of the last completed month."""
        return _month_start(self.today) - timedelta(days=1)

    @property
    def prior_month_end(self) -> date:
        """Last day of the month before the last completed one."""
        return self.month_start - timedelta(days=1)

    @property
    def start_12m(self) -> date:
        """First day of the twelve complete months that end at `month_end`."""
        return _month_start(self.today, -12)

    def days_back(self, days: int) -> date:
        return self.today - timedelta(days=days)

    @property
    def boundaries(self) -> list[date]:
        """Days on which some metric's date window opens or has just closed."""
        return sorted({
            self.start_12m,
            self.year_start,
            self.month_start,
            self.month_end + timedelta(days=1),
            self.today + timedelta(days=1),
        })
