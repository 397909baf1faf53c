"""Profiles of agencies and companies that are kept from changes: a corrected notice is taken back before it counts again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.streaming.parts import PartsSink
from gazette.streaming.upserts import BUCKETS, UpsertSink

MONEY = "decimal(38,2)"
COUNTS = ["owner", "dimension", "value"]


class SumSink(UpsertSink):
    """Adds signed rows to a bucketed table of counts and amounts. Rows that come to no notice stay, so that no bucket gets lost."""

    def merged(self, old: DataFrame | None, new: DataFrame) -> DataFrame:
        both = new if old is None else old.unionByName(new)
        return both.groupBy(*self.key).agg(F.sum("n").alias("n"), F.sum("amount").cast(MONEY).alias("amount"))


class ProfileSink:
    """``foreachBatch`` sink of notices that keeps each owner's histograms: notices and amount by dimension and value.

    A notice's newest record counts, by its fields in the order of ``newest``, then by all others. A batch takes its notices' old records back and adds the new
    ones, so it costs as much as it and the buckets that it touches. Both tables are read as they were before the batch: one that is
    repeated after a failure between their writes gives the same. Rows without an owner or with a null value count nowhere there.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], newest: list[str], owner: str, amount: str, dimensions: Sequence[str], buckets: int = BUCKETS):
        self.key, self.newest, self.owner, self.amount, self.dimensions = key, newest, owner, amount, list(dimensions)
        self.notices = PartsSink(spark, f"{path.rstrip('/')}/notices", key, ["notice"], buckets)
        self.counts = SumSink(spark, f"{path.rstrip('/')}/counts", COUNTS, [], "", buckets)

    def _part(self, batch: DataFrame) -> DataFrame:
        fields = dict.fromkeys([*self.newest, self.owner, self.amount, *self.dimensions])
        return batch.dropna(subset=self.key).select(*self.key, F.struct(*fields).alias("notice"))

    def _signed(self, notices: DataFrame, sign: int) -> DataFrame:
        """A row a dimension of each notice, with how often and with what amount it counts."""
        value = lambda d: F.struct(F.lit(d).alias("dimension"), F.col(f"notice.{d}").cast("string").alias("value"))
        amount = (F.coalesce(F.col(f"notice.{self.amount}").cast(MONEY), F.lit(0)) * sign).cast(MONEY)
        each = notices.select(F.col(f"notice.{self.owner}").cast("string").alias("owner"), F.explode(F.array(*map(value, self.dimensions))).alias("d"), F.lit(sign).cast("long").alias("n"), amount.alias("amount"))
        return each.select("owner", "d.*", "n", "amount").dropna(subset=COUNTS)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        new = self._part(batch).groupBy(*self.key).agg(F.max("notice").alias("notice"))
        known = self.notices.current(batch_id)
        after, change = new, None
        if known is not None:
            old = known.join(new.select(*self.key), self.key, "left_semi")
            after = old.unionByName(new).groupBy(*self.key).agg(F.max("notice").alias("notice"))
            change = self._signed(old, -1)
        added = self._signed(after, 1)
        change = added if change is None else added.unionByName(change)
        # What is taken back and added again is no change.
        change = change.groupBy(*COUNTS).agg(F.sum("n").alias("n"), F.sum("amount").cast(MONEY).alias("amount")).where("n <> 0 or amount <> 0")
        self.counts(change, batch_id)
        self.notices(new, batch_id)

    def current(self) -> DataFrame | None:
        return self.counts.current()


def profiles(counts: DataFrame) -> DataFrame:
    """owner, dimension, n, amount, n_values, mode, mode_n and concentration (the sum of squared shares) from the stored histograms.

    Of values that are equally frequent the least is the mode. All sums are exact, so the batches' order doesn't matter.
    """
    n = F.col("n").cast("decimal(38,0)")
    mode = F.min_by(F.struct("value", "n"), F.struct(-F.col("n"), F.col("value")))
    sums = counts.where("n <> 0").groupBy("owner", "dimension").agg(F.sum("n").alias("n"), F.sum("amount").cast(MONEY).alias("amount"), F.count("*").alias("n_values"), mode.alias("mode"), F.sum((n * n).cast("decimal(38,0)")).alias("_squares"))
    share = F.col("_squares").cast("double") / F.pow(F.col("n").cast("double"), F.lit(2.0))
    return sums.select("owner", "dimension", "n", "amount", "n_values", F.col("mode.value").alias("mode"), F.col("mode.n").alias("mode_n"), share.alias("concentration"))
