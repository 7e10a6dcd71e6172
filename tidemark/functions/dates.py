"""Date helpers. No helper reads the clock: every caller passes ``as_of``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_date(d) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


def monday(d) -> dt.date:
    """Monday of the ISO week holding ``d``."""
    d = as_date(d)
    return d - dt.timedelta(days=d.weekday())


def _bound(dtype: T.DataType, d: dt.date) -> Column:
    text = d.isoformat()
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(text + " 00:00:00").cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return F.lit(text + " 00:00:00").cast("timestamp")
    return F.lit(text).cast("date")


def time_between(df: DataFrame, start=None, end=None, col: str = "time") -> Column:
    """``start <= day(col) < end`` written on the raw column.

    The bounds are literals of the column's own type, so the comparison is a
    plain range on the stored value and reaches the Parquet scan as
    ``PushedFilters`` (row-group and partition pruning), which a filter on
    ``to_date(col)`` or on a week does not guarantee.
    """
    dtype = df.schema[col].dataType
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(col) >= _bound(dtype, as_date(start)))
    if end is not None:
        cond = cond & (F.col(col) < _bound(dtype, as_date(end)))
    return cond
