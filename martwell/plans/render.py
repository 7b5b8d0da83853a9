"""Presentation of results for comparison with other engines.

Dates become ISO text (``yyyy-MM-dd``), string arrays become ``|``-joined
text and exact decimals become double, so a result hashes the same whatever
client library turns it into rows.  Values are not changed otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def for_compare(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.concat_ws("|", c)
        cols.append(c.alias(f.name))
    return df.select(*cols)
