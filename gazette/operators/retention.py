"""What is kept by age or deadline. A date that can't be read keeps its row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.functions.text import days_since, period_end


def _young(c: Column, days: int, as_of: str) -> Column:
    age = days_since(c, as_of)
    return age.isNull() | (age <= days)


def prune_by_age(df: DataFrame, date: str, max_days: int, as_of: str) -> DataFrame:
    return df.where(_young(F.col(date), max_days, as_of))


def prune_by_period_end(df: DataFrame, period: str, grace_days: int, as_of: str) -> DataFrame:
    return df.where(_young(period_end(F.col(period)), grace_days, as_of))


def prune_by_deadline_or_age(df: DataFrame, deadline: str, date: str, grace_days: int, max_days: int, as_of: str) -> DataFrame:
    given = F.coalesce(F.col(deadline).cast("string"), F.lit("")) != ""
    return df.where(F.when(given, _young(F.col(deadline), grace_days, as_of)).otherwise(_young(F.col(date), max_days, as_of)))
