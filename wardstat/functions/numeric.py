"""Column functions for numeric text and row-wise aggregates.

All of these return `Column` expressions built from Spark built-ins, so they
stay inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain number: optional sign, digits with optional fraction and exponent,
# or inf / infinity in any case; blanks around are allowed. Anything else
# (sentinels such as "N/A", "Too Few to Report", "", "NaN", "1,000", "5%",
# Java-only forms such as "1.5d" or hex floats) becomes NULL.
NUMBER_PATTERN = (
    r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?"
    r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tolerant_double(c: str | Column) -> Column:
    """Text -> double; anything that is not a plain number -> NULL (never NaN)."""
    c = _col(c)
    return F.when(c.rlike(NUMBER_PATTERN), F.trim(c).try_cast("double"))


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL so that NaN never reaches `greatest`, averages or the model."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def clip(c: str | Column, lo: float | None, hi: float | None) -> Column:
    """Clip to [lo, hi]; NULL stays NULL."""
    c = _col(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(c.isNotNull(), out)


def count_present(cols: list[str]) -> Column:
    """Number of non-null values among `cols` (0 when all are null)."""
    return reduce(lambda a, b: a + b,
                  [F.when(F.col(c).isNotNull(), F.lit(1)).otherwise(F.lit(0)) for c in cols]
                  ).cast("long")


def count_above(cols: list[str], threshold: float) -> Column:
    """Number of values strictly above `threshold` (NULLs do not count)."""
    return reduce(lambda a, b: a + b,
                  [F.when(F.col(c) > F.lit(threshold), F.lit(1)).otherwise(F.lit(0)) for c in cols]
                  ).cast("long")


def sum_present(cols: list[str]) -> Column:
    """Left-to-right sum of the non-null values (0.0 when all are null)."""
    return reduce(lambda a, b: a + b,
                  [F.coalesce(F.col(c), F.lit(0.0)) for c in cols])


def row_mean(cols: list[str]) -> Column:
    """Mean of the non-null values; NULL when all are null."""
    n = count_present(cols)
    return F.when(n > 0, sum_present(cols) / n)


def row_sum(cols: list[str]) -> Column:
    """Sum of the non-null values; NULL when all are null (min_count = 1)."""
    return F.when(count_present(cols) > 0, sum_present(cols))


def row_max(cols: list[str]) -> Column:
    return F.greatest(*[F.col(c) for c in cols])


def row_min(cols: list[str]) -> Column:
    return F.least(*[F.col(c) for c in cols])
