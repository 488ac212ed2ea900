"""Integer calendar keys (``yyyyMMdd`` dates, ``HHmmss`` times).

Computed arithmetically rather than through a formatted string, so they stay
inside codegen and do not depend on locale or formatter settings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c, as_type: str = "int") -> Column:
    d = _c(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast(as_type)


def time_key(c, as_type: str = "int") -> Column:
    t = _c(c)
    return (F.hour(t) * 10000 + F.minute(t) * 100 + F.second(t)).cast(as_type)
