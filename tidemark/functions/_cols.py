from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_lit(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
