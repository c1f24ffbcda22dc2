"""Rounding."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_3(count: Column, total: Column) -> Column:
    """count/total rounded half up to three decimals, in whole-number arithmetic.

    NULL where the total is 0.
    """
    thousandths = F.call_function("div", F.lit(2000) * count + total, F.lit(2) * total)
    return F.when(total > 0, thousandths / F.lit(1000.0))


def round_half_up(number: Column, places: int) -> Column:
    """As decimals are written: 0.125 to two places is 0.13. Large numbers and NaN stay."""
    return F.round(number.cast("double"), places)
