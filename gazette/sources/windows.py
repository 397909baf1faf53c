"""Ranges to fetch: calendar windows, months, and what of them is done already."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.functions.text import stamp

#: Up to so many days one range is enough.
WINDOW_DAYS = 31


def windows(spark: SparkSession, days: int, as_of: str, limit: int = WINDOW_DAYS) -> DataFrame:
    """bgn, end (yyyyMMddHHmm), resumable: one range, or the calendar months back to ``days`` ago, newest first.

    A month is resumable, that is never fetched again once done, only when it is over.
    """
    today = dt.date.fromisoformat(as_of)
    now = F.lit(as_of).cast("date")
    if days <= limit:
        return spark.range(1).select(stamp(F.date_sub(now, days)).alias("bgn"), stamp(now, True).alias("end"), F.lit(False).alias("resumable"))
    first = (today - dt.timedelta(days=days)).replace(day=1)
    months = spark.range(1).select(F.explode(F.sequence(F.lit(str(first)).cast("date"), F.trunc(now, "month"), F.expr("interval 1 month"))).alias("m"))
    end = F.least(F.last_day("m"), now)
    return months.select(stamp(F.col("m")).alias("bgn"), stamp(end, True).alias("end"), (F.add_months("m", 1) <= now).alias("resumable")).orderBy(F.desc("bgn"))


def months(spark: SparkSession, start: str, as_of: str) -> DataFrame:
    """ym of the months from start to as_of, oldest first."""
    return spark.range(1).select(F.explode(F.sequence(F.trunc(F.lit(f"{start}-01").cast("date"), "month"), F.trunc(F.lit(as_of).cast("date"), "month"), F.expr("interval 1 month"))).alias("m")).select(F.date_format("m", "yyyy-MM").alias("ym"), F.col("m").alias("first_day"), F.last_day("m").alias("last_day"))


def window_key(operation, region, bgn):
    return F.concat_ws("|", operation, region, bgn)


def pending(planned: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """The planned ranges that aren't done; ranges that may still grow are always pending."""
    if "resumable" not in planned.columns:
        return planned.join(done, key, "left_anti")
    return planned.join(done.withColumn("resumable", F.lit(True)), [*key, "resumable"], "left_anti").select(*planned.columns)
