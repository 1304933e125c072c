"""Event-time conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def event_time(col: Column, dtype: T.DataType) -> Column:
    """Convert a column of type ``dtype`` to a timestamp; what cannot be read becomes NULL.

    Numbers are epoch seconds. ``try_cast`` keeps NaN, infinite and out-of-range values from
    failing the task under ANSI mode.
    """
    if isinstance(dtype, T.TimestampType):
        return col
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return col.cast("timestamp")
    if isinstance(dtype, T.NumericType):
        return col.cast("double").try_cast("timestamp")
    return col.cast("string").try_cast("timestamp")
