"""The set of input relations one run works on."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closebook.sources.schemas import KNOWN_DATES, SCHEMAS, UNIQUE_KEYS

# Fixed value: default name of the account that counts as payable besides the payable types
OVERBILLINGS = "20700 Overbillings"


class Relations:
    """Input tables by name; `relations["accounts"]` or `relations.accounts`.

    A table may be given as a function, which is called on first use only, so
    a query opens no more files than it reads.
    """

    def __init__(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]],
                 overbillings: str = OVERBILLINGS, in_staff_accounts: Iterable | None = None,
                 given: Mapping[str, Callable[[Sequence[date]], DataFrame]] | None = None):
        """`overbillings` names the account that counts as payable besides the payable types;
        `in_staff_accounts` are the ids of in-staff labour accounts, by default those that
        `accounts.is_in_staff` marks.  Every operator follows these settings.

        `given` are relations that are functions of a date, for sources that offer totals and no
        movements.  A function is asked once for all dates that an operator wants and returns its
        rows with `as_of`: `wip_totals` (contract_id, original_value, change_orders,
        total_amount) and `ar_aging` (unpaid_retainage).
        """
        self._tables = dict(tables)
        self.overbillings = overbillings
        self.in_staff_accounts = None if in_staff_accounts is None else tuple(in_staff_accounts)
        self.given = dict(given or {})

    def __contains__(self, name: str) -> bool:
        return name in self._tables

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __getitem__(self, name: str) -> DataFrame:
        table = self._tables[name]
        if not isinstance(table, DataFrame):
            table = self._tables[name] = table()
        return table

    def __getattr__(self, name: str) -> DataFrame:
        # private and special names are looked up before `_tables` exists
        if name.startswith("_") or name not in self._tables:
            raise AttributeError(name)
        return self[name]

    @property
    def spark(self) -> SparkSession:
        return self[next(iter(self))].sparkSession

    def replace(self, **tables: DataFrame | Callable[[], DataFrame]) -> Relations:
        return Relations({**self._tables, **tables}, self.overbillings, self.in_staff_accounts,
                         self.given)

    def with_functions(self, **given: Callable[[Sequence[date]], DataFrame]) -> Relations:
        """The same relations with functions of a date in the place of their movements."""
        return Relations(self._tables, self.overbillings, self.in_staff_accounts,
                         {**self.given, **given})

    def known_by(self, as_of: date) -> Relations:
        """Only rows dated on or before `as_of` or not at all, for restating a past date.

        Off by default in every operator.  Relations without a date (tasks,
        budgets, project status) stay as they are now.
        """
        def cut(name: str, column: str) -> Callable[[], DataFrame]:
            return lambda: self[name].filter(
                F.col(column).isNull() | (F.col(column) < F.lit(as_of + timedelta(days=1)))
            )

        return self.replace(**{
            name: cut(name, column) for name, column in KNOWN_DATES.items() if name in self
        })

    def check_unique_keys(self) -> None:
        """Raise if a relation repeats a key that joins expect to be unique.

        A repeated contract or account would multiply ledger rows silently.
        Runs one grouped count per dimension; call it once per load.
        """
        for name, key in UNIQUE_KEYS.items():
            if name not in self:
                continue
            repeated = self[name].groupBy(key).count().filter("count > 1").limit(5).collect()
            if repeated:
                raise ValueError(f"{name}: repeated {key}: {[row[key] for row in repeated]}")


def conform(table: DataFrame, name: str) -> DataFrame:
    """A user's table with the declared columns of relation `name`.

    Identifiers kept as text stay text, and decimals of more places keep them.  An
    amount of another type that the declared places cannot hold fails the query.
    """
    return table.select(*[
        _conformed(table, field).alias(field.name) for field in SCHEMAS[name]
    ])


def _conformed(table: DataFrame, field: T.StructField) -> Column:
    value, given, declared = F.col(field.name), table.schema[field.name].dataType, field.dataType
    if isinstance(declared, T.LongType) and isinstance(given, T.StringType):
        return value
    if not isinstance(declared, T.DecimalType):
        return value.cast(declared)
    if isinstance(given, T.DecimalType):
        places = max(given.scale, declared.scale)
        whole = max(given.precision - given.scale, declared.precision - declared.scale)
        return value.cast(T.DecimalType(min(38, whole + places), places))
    if isinstance(given, T.IntegralType):
        return value.cast(declared)
    cast = value.cast(declared)
    exact = value.cast("decimal(38,10)") == cast
    refusal = F.raise_error(F.concat(
        F.lit(f"{field.name}: {declared.simpleString()} does not hold "), value.cast("string")))
    return F.when(value.isNull() | exact, cast).otherwise(refusal.cast(declared))


def normalise_text(table: DataFrame, *columns: str) -> DataFrame:
    """Upper-case and strip trailing blanks, once on load.

    Fact columns are compared with plain equality so that the condition can
    reach the scan; sources with mixed spellings go through here first.
    """
    return table.withColumns({c: F.upper(F.rtrim(F.col(c))) for c in columns})
