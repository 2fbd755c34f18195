"""Filter context (clients, cities, brands) and reporting period."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.grouping import per_column
from ..settings import LAST_YEAR


@dataclass(frozen=True)
class Period:
    """``all``, one ``year``, or one ``month`` (``YYYY-MM``; None is the latest month with sales)."""

    kind: str = "all"
    year: int | None = None
    month: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in ("all", "year", "month"):
            raise ValueError(f"unknown period {self.kind!r}")
        if self.kind == "year" and self.year is None:
            raise ValueError("a year period needs its year")
        if self.month is not None and not re.fullmatch(r"\d{4}-\d{2}", self.month):
            raise ValueError(f"month {self.month!r} is not YYYY-MM")

    @classmethod
    def of_year(cls, year: int = LAST_YEAR) -> Period:
        return cls("year", year=year)

    @classmethod
    def of_month(cls, month: str | None = None) -> Period:
        return cls("month", month=month)

    def _month_parts(self, last_date: Column) -> tuple[Column, Column]:
        if self.month is None:
            return F.year(last_date), F.month(last_date)
        year, month = self.month.split("-")
        return F.lit(int(year)), F.lit(int(month))

    def selects(self, last_date: Column) -> Column:
        """Whether a row of a sales frame is in the period. ``last_date`` is any day of the latest month."""
        if self.kind == "year":
            return F.col("Year") == self.year
        if self.kind == "month":
            # Compared as year and month, by which sales are stored, so that only that month's files are read.
            year, month = self._month_parts(last_date)
            return (F.col("Year") == year) & (F.col("Month") == month)
        return F.lit(True)

    def current(self, last_date: Column) -> Column:
        """Rows of the current side of a year-over-year comparison."""
        return F.col("Year") == F.year(last_date) if self.kind == "all" else self.selects(last_date)

    def previous(self, last_date: Column) -> Column:
        """Rows of the previous side. All-time compares up to the day of the year of the last sale."""
        if self.kind == "all":
            return (F.col("Year") == F.year(last_date) - 1) & (
                F.dayofyear("Date") <= F.dayofyear(last_date)
            )
        if self.kind == "year":
            return F.col("Year") == self.year - 1
        year, month = self._month_parts(last_date)
        return (F.col("Year") == year - 1) & (F.col("Month") == month)

    def years(self) -> list[int] | None:
        """Years both sides lie in, where that is known without looking at the data."""
        if self.kind == "year":
            return [self.year - 1, self.year]
        if self.kind == "month" and self.month is not None:
            year = int(self.month[:4])
            return [year - 1, year]
        return None


def compared_years(s: DataFrame, period: Period) -> DataFrame:
    """Rows of the two years a comparison can involve, so that the files of all others are skipped. The last year
    comes from a scalar subquery, which on stored sales without a filter reads no column, only partition values."""
    years = period.years()
    if years is not None:
        return s.where(F.col("Year").isin(years))
    return s.where(F.col("Year") >= s.select(F.max("Year") - 1).scalar())


def latest_month(s: DataFrame) -> Column:
    """First day of the latest month with sales, as a scalar subquery that reads partition values only."""
    return s.select(F.max(F.make_date(F.col("Year"), F.col("Month"), F.lit(1)))).scalar()


def with_calendar(days: DataFrame) -> DataFrame:
    """Year and month columns of a sales frame for rows that only have their date."""
    return days.withColumns({
        "Year": F.year("Date"), "Month": F.month("Date"), "YearMonth": F.date_format("Date", "yyyy-MM")
    })


def with_last_date(days: DataFrame) -> DataFrame:
    """Add the date of the last sale to a frame of at most one row per calendar day."""
    return days.withColumn("_last_date", F.max("Date").over(Window.partitionBy(F.lit(0))))


def with_sides(s: DataFrame, period: Period) -> DataFrame:
    """Rows of a year-over-year comparison, with ``_is_current`` and ``_is_previous``.

    Where the period itself names its year this is a plain filter. Where it depends on the last sale, the days of
    both sides are found first and joined; there are at most two years of days, hence the broadcast.
    """
    last_date = F.col("_last_date")
    current, previous = period.current(last_date), period.previous(last_date)
    flags = {"_is_current": current, "_is_previous": previous}
    recent = compared_years(s, period)
    if period.years() is not None:
        return recent.where(current | previous).withColumns(flags)
    days = with_last_date(with_calendar(recent.select("Date").distinct()))
    sides = days.where(current | previous).select(
        "Date", *[condition.alias(name) for name, condition in flags.items()]
    )
    return recent.join(F.broadcast(sides), "Date")


def filter_options(wide: DataFrame) -> DataFrame:
    """Values to choose from per filter (one scan), with the default choice: all values, but only the last month."""
    columns = ["Client", "City", "Brand", "YearMonth"]
    options = per_column(wide, {column: column for column in columns}).toDF("Dimension", "Value")
    is_last = F.col("Value") == F.date_format(latest_month(wide), "yyyy-MM")
    return options.withColumn("Is_Default", (F.col("Dimension") != "YearMonth") | is_last)


def _is_member(column: str, values: Sequence[str | None]) -> Column:
    known = [value for value in values if value is not None]
    condition = F.col(column).isin(known) if known else F.lit(False)
    return condition | F.col(column).isNull() if len(known) < len(values) else condition


def _keep_members(wide: DataFrame, column: str, values: Sequence[str | None] | DataFrame) -> DataFrame:
    if not isinstance(values, DataFrame):
        return wide.where(_is_member(column, values))
    chosen = values.select(F.col(values.columns[0]).alias("_chosen"))
    return wide.join(chosen, F.col(column).eqNullSafe(F.col("_chosen")), "left_semi")


def apply_context(
    wide: DataFrame,
    clients: Sequence[str | None] | DataFrame | None = None,
    cities: Sequence[str | None] | DataFrame | None = None,
    brands: Sequence[str | None] | DataFrame | None = None,
) -> DataFrame:
    """Rows whose client, city and brand are all chosen. None means all; a list matches NULL if it holds None.

    A list is a predicate, by which row groups are skipped; a DataFrame of values is a semi join.
    """
    for column, values in (("Client", clients), ("City", cities), ("Brand", brands)):
        if values is not None:
            wide = _keep_members(wide, column, values)
    return wide


def apply_period(s: DataFrame, period: Period = Period()) -> DataFrame:
    return s if period.kind == "all" else s.where(period.selects(latest_month(s)))
