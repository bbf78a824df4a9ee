"""Rounding of indicators to three places."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round3(value: Column) -> Column:
    """Half-even rounding of the exact binary value, like IEEE-aware languages do.

    ``round`` and ``bround`` look at the shortest decimal form, so 0.1235 counts
    as a tie for them although the stored double lies above or below it. Here
    the rounding error of ``value * 2000`` is recovered exactly (Dekker's split),
    and an odd product is a tie only if that error is zero.
    """
    product = value * 2000.0
    carrier = value * 134217729.0
    high = carrier - (carrier - value)
    error = (high * 2000.0 - product) + (value - high) * 2000.0
    below = F.floor((product - 1.0) / 2.0).cast("double")
    nearest = F.floor((product + 1.0) / 2.0).cast("double")
    is_odd = (product == F.floor(product)) & (F.pmod(product, F.lit(2.0)) == 1.0)
    even = F.when(F.pmod(below, F.lit(2.0)) == 0.0, below).otherwise(below + 1.0)
    thousandths = (
        F.when(~is_odd, nearest).when(error > 0, below + 1.0).when(error < 0, below).otherwise(even)
    )
    return thousandths / 1000.0
