"""Zone-free literals for ``timestamp_ntz`` columns.

A Python ``datetime`` passed to ``F.lit`` becomes a zoned timestamp (the
Python process's zone) and then shifts by the session zone when cast to
``timestamp_ntz``; a string literal cast to ``timestamp_ntz`` does not.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(value: dt.datetime | dt.date | str) -> Column:
    if isinstance(value, dt.datetime):
        text = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        text = f"{value.isoformat()} 00:00:00"
    else:
        text = value
    return F.lit(text).cast("timestamp_ntz")
