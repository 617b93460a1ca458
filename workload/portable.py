"""Result types that read the same in every engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def portable(df: DataFrame) -> DataFrame:
    """Dates and time stamps as ISO text, decimals and 32-bit floats as doubles."""
    columns = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        columns.append(c.alias(f.name))
    return df.select(*columns)
