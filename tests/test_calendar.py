from datetime import date, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st

from closebook.calendar import AsOf


@pytest.mark.parametrize("today, expected", [
    ("2001-07-15", ("2001-01-01", "2001-06-01", "2001-06-30", "2001-05-31", "2000-07-01")),
    # January: the last completed month lies in the year before
    ("2001-01-10", ("2001-01-01", "2000-12-01", "2000-12-31", "2000-11-30", "2000-01-01")),
    ("2000-02-29", ("2000-01-01", "2000-01-01", "2000-01-31", "1999-12-31", "1999-02-01")),
    ("2000-03-31", ("2000-01-01", "2000-02-01", "2000-02-29", "2000-01-31", "1999-03-01")),
    ("2001-06-30", ("2001-01-01", "2001-05-01", "2001-05-31", "2001-04-30", "2000-06-01")),
])
def test_boundaries(today, expected):
    a = AsOf.parse(today)
    found = (a.year_start, a.month_start, a.month_end, a.prior_month_end, a.start_12m)
    assert tuple(d.isoformat() for d in found) == expected


@given(st.dates(date(1970, 1, 1), date(2100, 12, 31)))
def test_windows_are_whole_months(today):
    a = AsOf(today)
    assert a.month_start.day == 1 and a.start_12m.day == 1
    assert (a.month_end + timedelta(days=1)) == today.replace(day=1)
    assert (a.prior_month_end + timedelta(days=1)) == a.month_start
    assert 365 <= (a.month_end - a.start_12m).days + 1 <= 366


def test_parse_accepts_dates_and_text():
    assert AsOf.parse(date(2001, 7, 15)) == AsOf.parse("2001-07-15") == AsOf.parse(
        AsOf(date(2001, 7, 15)))
