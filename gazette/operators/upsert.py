"""Keyed upsert that remembers when a record was first seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_write(df: DataFrame, key: list[str], seq: list[str]) -> DataFrame:
    """One row a key: the one with the greatest ``seq``. Partial maxima come before the shuffle, so no key is hot."""
    rest = [c for c in df.columns if c not in key]
    top = F.max_by(F.struct(*rest), F.struct(*seq)).alias("top")
    return df.groupBy(*key).agg(top).select(*key, *[F.col(f"top.{c}").alias(c) for c in rest]).select(*df.columns)


def upsert(old: DataFrame, new: DataFrame, key: list[str], seq: list[str], now: Column, first_seen: str = "first_seen") -> DataFrame:
    """old overlaid by new: new columns win, ``first_seen`` stays, rows of either side are kept. Rows without a key go."""
    known = F.lit(True)
    for k in key:
        known = known & F.col(k).isNotNull()
    fresh = last_write(new.where(known), key, seq)
    o, n = old.alias("o"), fresh.withColumn("_new", F.lit(True)).alias("n")
    both = o.join(n, key, "full_outer")
    extra = [c for c in old.columns if c not in (*key, first_seen)]
    added = [c for c in fresh.columns if c not in (*key, *extra, first_seen)]
    value = lambda c: F.when(F.col("n._new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) if c in fresh.columns else F.col(f"o.{c}").alias(c)
    return both.select(*key, *[value(c) for c in extra], *[F.col(f"n.{c}").alias(c) for c in added], F.coalesce(F.col(f"o.{first_seen}"), now).alias(first_seen))


def changed(old: DataFrame, new: DataFrame) -> bool:
    """Whether there is anything to publish."""
    return not (old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty())
