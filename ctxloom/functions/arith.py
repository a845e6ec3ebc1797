"""Integer arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(value: Column | str, by: int) -> Column:
    """Whole-number quotient as bigint, without a detour over doubles."""
    col = F.col(value) if isinstance(value, str) else value
    return F.call_function("div", col.cast("bigint"), F.lit(by).cast("bigint"))
