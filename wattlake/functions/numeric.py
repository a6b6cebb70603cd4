"""Integer averages and rounding as the warehouse defines them.

Averages of integer columns are integers: NULLs are skipped and the quotient is
cut toward zero.  All sums run in BIGINT and stay exact, so results do not depend
on the order in which partial aggregates meet.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quotient(dividend: Column, divisor: Column | int) -> Column:
    """Integer division toward zero; NULL when the divisor is zero."""
    divisor = F.lit(divisor) if isinstance(divisor, int) else divisor
    return F.call_function(
        "div", dividend.cast("bigint"), F.nullif(divisor.cast("bigint"), F.lit(0))
    )


def int_avg(values: Column) -> Column:
    """Aggregate: integer average of an integer column."""
    return int_avg_of_parts(F.sum(values.cast("bigint")), F.count(values))


def int_avg_of_parts(total: Column, count: Column) -> Column:
    """Integer average from a sum and a count that were computed earlier."""
    return quotient(total, count).cast("int")


def rounded_mean(values: Column, divisor: int) -> Column:
    """Aggregate: mean of ``values`` over ``divisor``, rounded half away from zero.

    The mean is never formed as a fraction.  For a sum s over n rows the rounded
    value of s / (n * divisor) is (2|s| + n * divisor) div (2 * n * divisor) with
    the sign of s, all in BIGINT.
    """
    return rounded_mean_of_parts(F.sum(values.cast("bigint")), F.count(values), divisor)


def rounded_mean_of_parts(total: Column, count: Column, divisor: int) -> Column:
    """The same from a sum and a count that were computed earlier."""
    scaled = count * F.lit(divisor).cast("bigint")
    magnitude = quotient(F.abs(total) * 2 + scaled, scaled * 2)
    return F.when(total < 0, -magnitude).otherwise(magnitude)
