"""The last record before each of another table, without sorting a whole key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DAY = 86_400_000_000


def as_of(left: DataFrame, right: DataFrame, key: Sequence[str], at: str, right_at: str, seq: str, strict: bool = False, width: int = DAY) -> DataFrame:
    """left with ``found``: right's columns besides the key, of the key's last row at or before ``at`` (``strict``: before), else null.

    Of right rows at one time the greatest ``seq`` holds, nulls being least, then the greatest other columns. All rows of left
    stay, repeated ones too; those with a null key or time find nothing, and such right rows are never found.
    Time is cut into spans of ``width`` microseconds. A key's spans are sorted each by itself; what holds at a span's start is carried
    from the last row of the spans before, of which a key has as many as there are spans, not rows.
    """
    key = list(key)
    t = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    rest = [right_at, seq, *[c for c in right.columns if c not in (*key, right_at, seq)]]
    # Columns are held in structs, so that names of one side don't clash with the other's.
    r = right.select(F.struct(*key).alias("_key"), t(right_at).alias("_t"), F.struct(*rest).alias("_r")).where(_known("_key", key) & F.col("_t").isNotNull())
    own = left.select(F.struct(*key).alias("_key"), t(at).alias("_t"), F.struct(*left.columns).alias("_l"))
    sound = F.coalesce(_known("_key", key) & F.col("_t").isNotNull(), F.lit(False))
    span = F.floor(F.col("_t") / width).alias("_span")
    r, l = r.select("*", span), own.where(sound).select("*", span)
    ends = r.groupBy("_key", "_span").agg(F.max(F.struct("_t", "_r")).getField("_r").alias("_r"))
    spans = ends.unionByName(l.select("_key", "_span").distinct(), allowMissingColumns=True).groupBy("_key", "_span").agg(F.max("_r").alias("_r"))
    before = F.last("_r", ignorenulls=True).over(W.partitionBy("_key").orderBy("_span").rowsBetween(W.unboundedPreceding, -1))
    carried = spans.select("_key", "_span", before.alias("_r")).where(F.col("_r").isNotNull())
    kind = lambda df, k: df.withColumn("_kind", F.lit(k))
    rows = kind(carried, 0).unionByName(kind(r, 3 if strict else 1), allowMissingColumns=True).unionByName(kind(l, 2), allowMissingColumns=True)
    # What is carried comes first; with ``strict`` the rows of one time come after those that ask.
    order = W.partitionBy("_key", "_span").orderBy(F.expr("if(_kind = 0, null, _t)").asc_nulls_first(), "_kind", "_r")
    found = rows.withColumn("found", F.last("_r", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))).where("_kind = 2")
    none = own.where(~sound).select("_l", F.lit(None).cast(found.schema["found"].dataType).alias("found"))
    return found.select("_l", "found").unionByName(none).select("_l.*", "found")


def _known(struct: str, key: Sequence[str]):
    out = F.lit(True)
    for k in key:
        out = out & F.col(struct)[k].isNotNull()
    return out


def bias(joined: DataFrame, by: Sequence[str], predicted: str, actual: str) -> DataFrame:
    """n, missing (no prediction), mean error and mean absolute error of what was predicted, by group."""
    error = F.col(predicted) - F.col(actual)
    return joined.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(F.col(predicted).isNull()).alias("missing"), F.avg(error).alias("bias"), F.avg(F.abs(error)).alias("absolute"))
