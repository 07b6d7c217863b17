"""One pinned clock per run, so that rebuilding a day gives the same rows."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunClock:
    """``as_of`` drives date rules (ages, active flags), ``run_ts`` the audit columns."""

    as_of: dt.date
    run_ts: dt.datetime

    @classmethod
    def on(cls, as_of: str) -> "RunClock":
        day = dt.date.fromisoformat(as_of)
        return cls(day, dt.datetime.combine(day, dt.time()))

    @classmethod
    def now(cls) -> "RunClock":
        ts = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
        return cls(ts.date(), ts)

    def today(self) -> Column:
        return F.lit(self.as_of)

    def stamp(self) -> Column:
        # cast from text: a Python datetime literal would shift by the driver's own zone
        return F.lit(self.run_ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")

    def audit_columns(self) -> dict[str, Column]:
        return {"Created_TS": self.stamp(), "Updated_TS": self.stamp()}
