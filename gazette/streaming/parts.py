"""Tables that are put together from records that come in any order and on different time axes.

A bid is found by its day of registration, its award by the day of opening eight or nine months later (or, in a backfill, before the
bid itself). A watermark would have to wait as long, so what has come is kept in a bucketed table, and a batch rewrites the buckets it touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gazette.streaming.upserts import BUCKETS, UpsertSink


class PartsSink(UpsertSink):
    """``foreachBatch`` sink of rows with a key and a struct column a part (null where a row isn't of that part).

    Of each part the newest is kept, by the struct's fields in their order: those that say what is newest come first, the others break ties.
    A maximum is the same in any order and however often a record comes, so every order of arrival gives the same table.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], parts: list[str], buckets: int = BUCKETS):
        super().__init__(spark, path, key, [], "", buckets)
        self.parts = parts

    def merged(self, old: DataFrame | None, new: DataFrame) -> DataFrame:
        rows = new.select(*self.key, *self.parts)
        both = rows if old is None else old.unionByName(rows)
        return both.groupBy(*self.key).agg(*[F.max(p).alias(p) for p in self.parts])


class HistorySink(UpsertSink):
    """``foreachBatch`` sink that keeps every version of a notice with the time it was known; see ``versions``.

    Batches may come in any order of their times: the touched keys' intervals are made anew.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], valid: str, known: str, seq: str, buckets: int = BUCKETS):
        super().__init__(spark, path, key, [seq], "", buckets)
        self.valid, self.known = valid, known

    def merged(self, old: DataFrame | None, new: DataFrame) -> DataFrame:
        both = new if old is None else old.drop("known_to").unionByName(new)
        return versions(both, self.key, self.valid, self.known, self.seq[0])


def part(df: DataFrame, key: dict[str, Column], name: str, fields: dict[str, Column]) -> DataFrame:
    """Rows of one part, to be united with others by name (allowMissingColumns)."""
    return df.select(*[c.alias(k) for k, c in key.items()], F.struct(*[c.alias(f) for f, c in fields.items()]).alias(name))


# ------------------------------------------------------------------ bids and awards


def link_awards(table: DataFrame, as_of: str, months: int = 9) -> DataFrame:
    """A row a notice with its state and the months from its registration to its opening.

    table: the columns ``bid`` (with ``registered``) and ``award`` (with ``opened``). awarded; orphan: an award whose bid hasn't been fetched;
    overdue: no award ``months`` months after registration; open.
    """
    bid, award = F.col("bid").isNotNull(), F.col("award").isNotNull()
    late = F.add_months(F.col("bid.registered").cast("date"), months) <= F.lit(as_of).cast("date")
    state = F.when(bid & award, "awarded").when(award, "orphan").when(late, "overdue").otherwise("open")
    lag = F.months_between("award.opened", "bid.registered").cast("double")
    return table.withColumns({"state": state, "lag_months": lag})


def months_to_ask(linked: DataFrame) -> DataFrame:
    """month, n: registration months of bids that are overdue, so that their openings are asked for again."""
    return linked.where("state = 'overdue'").groupBy(F.date_format("bid.registered", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


def link_prespecs(bids: DataFrame, prespecs: DataFrame) -> DataFrame:
    """bid_no, pre_no, told_by: links that a bid tells, a prior specification, or both.

    bids: bid_no and pre_nos, an array; prespecs: pre_no and bid_nos. A link is there once however often it is told, also if the
    other record hasn't come (``has_bid``, ``has_pre``). Nulls in the arrays are no links.
    """
    told = bids.select("bid_no", F.explode("pre_nos").alias("pre_no"), F.lit(1).alias("by")).unionByName(prespecs.select(F.explode("bid_nos").alias("bid_no"), "pre_no", F.lit(2).alias("by")))
    links = told.dropna().groupBy("bid_no", "pre_no").agg(F.bit_or("by").alias("by"))
    by = F.element_at(F.array(F.lit("bid"), F.lit("prespec"), F.lit("both")), F.col("by")).alias("told_by")
    own = lambda df, c, has: df.select(c).where(F.col(c).isNotNull()).distinct().withColumn(has, F.lit(True))
    found = links.join(own(bids, "bid_no", "has_bid"), "bid_no", "left").join(own(prespecs, "pre_no", "has_pre"), "pre_no", "left")
    return found.select("bid_no", "pre_no", by, F.coalesce("has_bid", F.lit(False)).alias("has_bid"), F.coalesce("has_pre", F.lit(False)).alias("has_pre"))


# --------------------------------------------------------------------------- history


def versions(log: DataFrame, key: Sequence[str], valid: str, known: str, seq: str) -> DataFrame:
    """The log's distinct rows with ``known_to``: when another record of the same key and valid time took a row's place (null: it holds).

    valid: from when on a record says how things are; known: when it was fetched. Of records fetched at one time the greatest ``seq`` holds, then
    the others' columns decide; those it beats have an empty interval. The records of one key and valid time are sorted together, as they stream by.
    """
    rest = [c for c in log.columns if c not in (*key, valid, known, seq)]
    order = W.partitionBy(*key, valid).orderBy(known, F.col(seq).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in rest])
    return log.dropna(subset=[*key, valid, known]).distinct().withColumn("known_to", F.lead(known).over(order))


def as_known(history: DataFrame, known: str, known_at: Column) -> DataFrame:
    """The versions that were held at a time."""
    return history.where((F.col(known) <= known_at) & (F.col("known_to").isNull() | (F.col("known_to") > known_at)))


def point_in_time(history: DataFrame, key: Sequence[str], valid: str, known: str, valid_at: Column, known_at: Column, removed: Column | None = None) -> DataFrame:
    """What a reader at ``known_at`` was shown as true at ``valid_at``: a row a key, less those whose record says they are removed.

    Partial maxima come before the shuffle, so no key is hot.
    """
    rest = [c for c in history.columns if c not in (*key, "known_to")]
    held = as_known(history, known, known_at).where(F.col(valid) <= valid_at)
    found = held.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(valid)).alias("top")).select(*key, *[F.col(f"top.{c}").alias(c) for c in rest])
    return found if removed is None else found.where(~F.coalesce(removed, F.lit(False)))


def timeline(history: DataFrame, key: Sequence[str], valid: str, known: str, known_at: Column) -> DataFrame:
    """All valid intervals as they were known at a time: ``valid_to`` is the next record's valid time (null: open)."""
    return as_known(history, known, known_at).drop("known_to").withColumn("valid_to", F.lead(valid).over(W.partitionBy(*key).orderBy(valid)))


def changes(history: DataFrame, key: Sequence[str], valid: str, known: str, seq: str) -> DataFrame:
    """The versions that say something else than the one they replaced; a month that is fetched again mostly repeats what is known."""
    rest = [c for c in history.columns if c not in (*key, valid, known, seq, "known_to")]
    held = history.where(F.col("known_to").isNull() | (F.col("known_to") > F.col(known)))
    before = F.lag(F.struct(*rest)).over(W.partitionBy(*key, valid).orderBy(known))
    return held.withColumn("_before", before).where(~F.col("_before").eqNullSafe(F.struct(*rest))).drop("_before")
