"""Plain types at the edge: exact decimals become doubles, dates become text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def plain(df: DataFrame) -> DataFrame:
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(c.alias(field.name))
    return df.select(*out)
