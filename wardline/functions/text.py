"""Text form of output fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def csv_field(name: str, data_type: T.DataType) -> Column:
    """Dates as YYYY-MM-DD, fractions with six digits, null as an empty field."""
    col = F.col(name)
    if isinstance(data_type, T.DateType):
        text = F.date_format(col, "yyyy-MM-dd")
    elif isinstance(data_type, (T.DoubleType, T.FloatType)):
        # Rounding first settles ties, which formatters treat differently.
        text = F.when(col.isNotNull(), F.format_string("%.6f", F.round(col.cast("double"), 6)))
    else:
        text = col.cast("string")
    return F.coalesce(text, F.lit(""))
