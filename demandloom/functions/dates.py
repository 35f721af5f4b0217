"""Month windows, month columns and report file names."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom import config


def shift_month(day: date, months: int) -> date:
    """First day of the month ``months`` away from the month of ``day``."""
    index = day.year * 12 + day.month - 1 + months
    return date(index // 12, index % 12 + 1, 1)


@dataclass(frozen=True)
class Window:
    """``months`` calendar months that end with the month of ``as_of``."""

    as_of: date
    months: int = config.WINDOW_MONTHS

    @property
    def start(self) -> date:
        return shift_month(self.as_of, 1 - self.months)

    @property
    def end(self) -> date:
        return shift_month(self.as_of, 1) - timedelta(days=1)

    @property
    def month_starts(self) -> list[date]:
        return [shift_month(self.as_of, offset) for offset in range(1 - self.months, 1)]

    @property
    def labels(self) -> list[str]:
        return [f"{m:%Y/%m}" for m in self.month_starts]

    def resized(self, months: int) -> Window:
        return Window(self.as_of, months)

    def contains(self, day: Column) -> Column:
        """A plain range on the date column, so that it reaches the scan."""
        return (day >= F.lit(self.start)) & (day <= F.lit(self.end))


def rows_in(window: Window, lines: DataFrame) -> Column:
    """Lines of the window; on lines with a period column, only its partitions."""
    inside = window.contains(F.col("data"))
    if config.PERIOD not in lines.columns:
        return inside
    first, last = (d.year * 100 + d.month for d in (window.start, window.end))
    return inside & F.col(config.PERIOD).between(first, last)


def reference_date(lines: DataFrame, column: str = "data") -> date:
    """Latest order date; one row reaches the driver."""
    latest = lines.agg(F.max(column).alias("latest")).first()["latest"]
    if latest is None:
        raise ValueError("no order date found, so the report month is undefined")
    return latest


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def local_now(zone: str = config.AUDIT_ZONE) -> Column:
    """Wall-clock time in ``zone``, whatever the session zone is."""
    return F.convert_timezone(None, F.lit(zone), F.localtimestamp()).cast("timestamp")


def file_title(prefix: str, as_of: date, title: str) -> str:
    return f"{prefix} {as_of.year} {config.MONTH_ABBREVIATIONS[as_of.month - 1]} {title}"
