"""What a report is: a function of tables and settings, plus an optional order."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger.functions import dates
from fieldledger.operators.running import positions

SORT_PREFIX = "_sort"


@dataclass(frozen=True)
class Settings:
    """The clock, the zone and the fixed periods of the reports."""

    as_of: int
    tz: str = dates.PACIFIC
    visit_years: tuple[int, ...] = (2024, 2025)
    churn_past: tuple[int, ...] = (2023, 2024)
    churn_current: tuple[int, ...] = (2025,)
    completed_since: int = dates.year_start(2023)

    @property
    def now(self) -> Column:
        return F.lit(self.as_of).cast("bigint")


@dataclass(frozen=True)
class Report:
    name: str
    description: str
    build: Callable[[Mapping, Settings], DataFrame]
    order: tuple[str, ...] = ()

    def frame(self, tables: Mapping, settings: Settings, ordered: bool = False) -> DataFrame:
        """The report; ``ordered=True`` adds the display sort as the last step."""
        df = self.build(tables, settings)
        if ordered and self.order:
            df = df.orderBy(*[_sort_key(o) for o in self.order])
        return df.select(*[F.col(f"`{c}`") for c in df.columns if not c.startswith(SORT_PREFIX)])

    def positioned(self, tables: Mapping, settings: Settings) -> DataFrame:
        """The report with the place of each row in the display order; rows that tie there go by their own columns."""
        df = self.build(tables, settings)
        shown = [c for c in df.columns if not c.startswith(SORT_PREFIX)]
        placed = positions(df, [*[_sort_key(o) for o in self.order], *[F.col(f"`{c}`").asc() for c in shown]])
        return placed.select(*[F.col(f"`{c}`") for c in shown], "position")


def _sort_key(name: str) -> Column:
    return F.col(f"`{name[1:]}`").desc() if name.startswith("-") else F.col(f"`{name}`").asc()


REPORTS: dict[str, Report] = {}


def report(name: str, description: str, *order: str):
    """Register a builder. ``order`` lists columns; a leading ``-`` means descending.

    A builder may add ``_sort*`` columns that only serve the order.
    """

    def register(build):
        REPORTS[name] = Report(name, description, build, order)
        return build

    return register
