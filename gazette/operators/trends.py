"""Rising and falling keywords: the slope of a word's monthly counts, months without it counted as zero."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def slopes(counts: DataFrame, by: Sequence[str], month: str, n: str, first: int, months: int) -> DataFrame:
    """by, total, active, slope and relative slope (slope / mean) of the regression of n on the month.

    counts: rows of a group and month with a number, as many as there are (they are added up); ``month``: an integer. first, months: the
    range, from the first month on; months outside of it don't count. The sums of x and x * x are those of the whole range and n is zero where there
    is no row, so months without a row are never made. The integer sums are exact in any order.
    """
    if months < 2:
        raise ValueError("a slope takes two months at least")
    x = F.col(month) - first
    inside = counts.where(F.col(n).isNotNull() & (x >= 0) & (x < months)).select(*by, x.cast("long").alias("_x"), F.col(n).cast("long").alias("_n"))
    sums = inside.groupBy(*by).agg(F.sum("_n").alias("total"), F.sum(F.col("_x") * F.col("_n")).alias("_xy"), F.count_distinct(F.when(F.col("_n") != 0, F.col("_x"))).alias("active"))
    sx, sxx = months * (months - 1) // 2, (months - 1) * months * (2 * months - 1) // 6
    slope = (F.col("_xy") * months - F.col("total") * sx) / F.lit(months * sxx - sx * sx)
    return sums.select(*by, "total", "active", slope.alias("slope"), F.when(F.col("total") != 0, slope * months / F.col("total")).alias("relative"))


def month_number(at):
    """Months since year 0 of a date."""
    return F.year(at) * 12 + F.month(at) - 1


def word_trends(dated: DataFrame, words, at: str, weight: str, least_months: int = 24) -> DataFrame:
    """``slopes`` of words over the whole range of the table's dates; ValueError if it has fewer months than asked for.

    weight: how many notices a row stands for. A row without a date doesn't count.
    """
    rows = dated.where(F.col(at).isNotNull()).withColumn("_month", month_number(F.col(at)))
    first, last = rows.agg(F.min("_month"), F.max("_month")).first()
    if first is None or last - first + 1 < least_months:
        raise ValueError(f"trends take {least_months} months at least")
    each = rows.select("_month", weight, F.explode(F.array_distinct(words)).alias("token"))
    return slopes(each, ["token"], "_month", weight, first, last - first + 1)
