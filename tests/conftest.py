"""One local session, the mapped relations and small hand-made ones."""

from __future__ import annotations

import os
from datetime import date, datetime
from decimal import Decimal

import pytest

from closebook.calendar import AsOf
from closebook.session import local_session
from closebook.sources import retail
from closebook.sources.relations import Relations
from closebook.sources.schemas import SCHEMAS

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")
SMALL, MEDIUM = f"{TESTDATA}/sf0.001", f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def as_of() -> AsOf:
    return AsOf.parse(retail.DEFAULT_AS_OF)


@pytest.fixture
def small(spark) -> Relations:
    return retail.relations(spark, SMALL)


@pytest.fixture
def medium(spark) -> Relations:
    return retail.relations(spark, MEDIUM)


@pytest.fixture
def make(spark):
    """Relations from Python rows; unnamed relations are empty."""
    def build(**rows: list[tuple]) -> Relations:
        unknown = set(rows) - set(SCHEMAS)
        assert not unknown, unknown
        return Relations({
            name: spark.createDataFrame(rows.get(name, []), schema)
            for name, schema in SCHEMAS.items()
        })
    return build


def money(value) -> Decimal | None:
    return None if value is None else Decimal(str(value))


def day(text: str) -> date:
    return date.fromisoformat(text)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def values(report) -> dict[str, float | None]:
    return {row["metric"]: row["value"] for row in report.collect()}


def one(frame):
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0]
