"""Date helpers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_day(col: Column | str) -> Column:
    """``TO_CHAR(x, 'YYYY-MM-DD')``."""
    return F.date_format(F.col(col) if isinstance(col, str) else col, "yyyy-MM-dd")


def add_days(base: Column | str, days: Column | str) -> Column:
    """``base + days * INTERVAL 1 DAY`` as a timestamp; NULL days give NULL.

    Fractional days move the time of day, as an interval product does.
    """
    b = F.col(base) if isinstance(base, str) else base
    d = F.col(days) if isinstance(days, str) else days
    return b.cast("timestamp_ntz") + F.make_dt_interval(secs=d.cast("decimal(18,6)") * F.lit(86400))


def run_timestamp(ts: _dt.datetime | None = None) -> Column:
    """One run timestamp for every row of a run (``NOW()`` is constant in a transaction)."""
    if ts is None:
        ts = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    # via text: a Python datetime literal would pass through the driver's local time zone
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")
