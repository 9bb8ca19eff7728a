"""Reference time for every report window.

Reports never read the wall clock: they take a ``Clock``, so a run can be
repeated for any day. Window bounds are timestamp literals compared with the
bare column, which keeps the filter eligible for Parquet and partition pruning.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(value: datetime) -> Column:
    """A zone-free timestamp literal."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


@dataclass(frozen=True)
class Clock:
    now: datetime

    @classmethod
    def at(cls, text: str) -> Clock:
        return cls(datetime.fromisoformat(text))

    @property
    def today(self) -> date:
        return self.now.date()

    def midnight(self, days_ago: int = 0) -> datetime:
        return datetime.combine(self.today - timedelta(days=days_ago), time.min)

    def closed_days(self, column: str, days: int) -> Column:
        """From midnight ``days`` ago to this midnight, both ends included."""
        return F.col(column).between(moment(self.midnight(days)), moment(self.midnight()))

    def last(self, column: str, **span: int) -> Column:
        """A rolling window that ends now, e.g. ``last("created", minutes=10)``."""
        return F.col(column).between(moment(self.now - timedelta(**span)), moment(self.now))

    def days_to_now(self, column: str, days: int) -> Column:
        """From midnight ``days`` ago until now."""
        return F.col(column).between(moment(self.midnight(days)), moment(self.now))

    def day_label(self, days_ago: int) -> str:
        """``dd-mm-YYYY`` text used in report titles."""
        return self.midnight(days_ago).strftime("%d-%m-%Y")

    def run_stamp(self) -> str:
        """``dd_mm_YYYY_HH_MM_SS`` text used in output names."""
        return self.now.strftime("%d_%m_%Y_%H_%M_%S")
