"""The most frequent competitors of a keyword over any range of months, from stored exact counts or one mergeable sketch a keyword and month.

Counting every competitor of every range anew would read all awards each time. ``month_counts`` keep each competitor's count of a month, so
``top_counted`` is exact for any number of competitors. Where their size matters more, a month's sketch (Spark's ``approx_top_k`` state) holds at most
``tracked`` competitors, so it has a bounded size; sketches are stored, those of late records are added as further rows, and a range is answered
by combining its months' sketches alone. No group is ever gathered: sketches are filled before the shuffle and merged behind it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Competitors a sketch can hold. While a range has no more of them, its counts are exact.
TRACKED = 4096


def most_error(total: Column, tracked: int = TRACKED) -> Column:
    """By how much a count can be too high at most, of ``total`` counted rows; 0 can't be told from the sketch.

    The sketch's table has the next power of two of places that is filled to three quarters by ``tracked`` items, and its error
    is 3.5 rows a place.
    """
    places = 1 << max(3, (-(-tracked * 4 // 3) - 1).bit_length())
    return F.floor(total * 7 / F.lit(2 * places))


def month_sketches(rows: DataFrame, by: Sequence[str], month: str, item: str, tracked: int = TRACKED) -> DataFrame:
    """by, month, total and sketch of the item's counts. Rows without a group, month or item don't count."""
    known = rows.dropna(subset=[*by, month, item])
    return known.groupBy(*by, month).agg(F.count("*").alias("total"), F.expr(f"approx_top_k_accumulate(`{item}`, {tracked})").alias("sketch"))


def merged(sketches: DataFrame, by: Sequence[str], tracked: int = TRACKED) -> DataFrame:
    """One row of ``by`` from many: months of late records into one, or months into years."""
    return sketches.groupBy(*by).agg(F.sum("total").alias("total"), F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))


def top_items(sketches: DataFrame, by: Sequence[str], month: str, periods: Mapping[str, tuple[int, int]], k: int = 10, tracked: int = TRACKED) -> DataFrame:
    """period, by, rank, item, n and error: the k most frequent items of each group and period (first and last month), ties by item.

    A month may lie in several periods. n is never too low, and too high by ``error`` at most; an item with more than twice
    ``error`` rows is never missed. A group without rows in a period has no rows. All items of a sketch are ranked, so
    which of several items with one count are shown is determined.
    """
    named = F.array(*[F.when(F.col(month).between(first, last), F.lit(name)) for name, (first, last) in periods.items()])
    dealt = sketches.withColumn("period", F.explode(F.array_compact(named)))
    held = merged(dealt, ["period", *by], tracked).withColumn("found", F.expr(f"approx_top_k_estimate(sketch, {tracked})"))
    ordered = F.array_sort(F.transform("found", lambda x: F.struct((-x["count"]).alias("less"), x["item"].alias("item"))))
    ranked = held.select("period", *by, "total", F.posexplode(F.slice(ordered, 1, k)).alias("at", "x"))
    return ranked.select("period", *by, (F.col("at") + 1).alias("rank"), F.col("x.item").alias("item"), (-F.col("x.less")).alias("n"), most_error(F.col("total"), tracked).alias("error"))


def month_counts(rows: DataFrame, by: Sequence[str], month: str, item: str) -> DataFrame:
    """by, month, item and n: how many rows each item has. Rows without a group, month or item don't count; those of late records can be added as further rows."""
    known = rows.dropna(subset=[*by, month, item])
    return known.groupBy(*by, month, F.col(item).alias("item")).agg(F.count("*").alias("n"))


def top_counted(counts: DataFrame, by: Sequence[str], month: str, periods: Mapping[str, tuple[int, int]], k: int = 10) -> DataFrame:
    """period, by, rank, item, n and total: the k most frequent items of each group and period (first and last month), ties by item. All n are exact.

    A month may lie in several periods. An item's months are summed before the shuffle, for all periods at once, and each task ranks its own
    items first, so no group meets in one. A group without rows in a period has no rows.
    """
    sums = [F.sum(F.when(F.col(month).between(first, last), F.col("n"))) for first, last in periods.values()]
    held = counts.groupBy(*by, "item").agg(F.array(*[F.when(n.isNotNull(), F.struct(F.lit(name).alias("period"), n.alias("n"))) for name, n in zip(periods, sums)]).alias("found"))
    dealt = held.select(*by, "item", F.explode(F.array_compact("found")).alias("x")).select("x.period", *by, "item", "x.n")
    ranked = dealt.withColumn("rank", F.row_number().over(W.partitionBy("period", *by).orderBy(F.desc("n"), "item"))).where(F.col("rank") <= k)
    total = dealt.groupBy("period", *by).agg(F.sum("n").alias("total"))
    return ranked.join(total, ["period", *by]).select("period", *by, "rank", "item", "n", "total")
