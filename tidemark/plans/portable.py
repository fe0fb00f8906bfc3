"""Engine-neutral output types for cross-engine checks.

Dates and timestamps leave as ISO text, whole numbers as BIGINT, decimals
and floats as DOUBLE, so that results of two engines compare value by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TS_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def portable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, TS_PATTERN)
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast(T.LongType())
        elif isinstance(t, (T.DecimalType, T.FloatType)):
            c = c.cast(T.DoubleType())
        cols.append(c.alias(f.name))
    return df.select(*cols)
