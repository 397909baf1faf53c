"""Ranks over whole tables, without one task that holds all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazette.sources.stores import scratch


def numbered(df: DataFrame, *order, index: str = "index", total: str | None = None) -> DataFrame:
    """df with ``index``, a row's place (from 0) in the order; with ``total`` also the number of rows.

    Rows are dealt by ranges of the order and numbered inside them; only the ranges' sizes are summed in one place. The
    dealt rows are stored once, so that sizes and numbers are of the same ranges. Equal rows get numbers in any order.
    """
    spark = df.sparkSession
    at = scratch(spark)
    df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).write.parquet(at)
    parts = spark.read.parquet(at)
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    bases = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"), F.sum("_size").over(Window.partitionBy()).alias("_total"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    out = parts.withColumn("_row", inside).join(F.broadcast(bases), "_part")
    return out.select(*df.columns, (F.col("_base") + F.col("_row")).alias(index), *([F.col("_total").alias(total)] if total else []))
