"""Registered queries that run streams: the windowed ingest over recorded responses, and keyed state with timers.

The responses that are recorded for the ingest are made of ``orders``: an order is a notice of its customer, in the region of its key's parity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gazette.operators import normalize
from gazette.plans.catalogue import read, register
from gazette.sources.client import PAGE_ROWS
from gazette.sources.stores import scratch
from gazette.streaming import ingest, state
from gazette.streaming.upserts import UpsertSink, parquet_stream

LANES = ["orders|00", "orders|11"]
RECORD = "bidNtceNo string, bidNtceNm string, bidNtceDt string, bidClseDt string"
#: Calls of a run that can't reach all windows.
FEW_CALLS = 40


def record_responses(orders: DataFrame, path: str) -> None:
    """The pages of every month and region, as the service would answer, each a row of a table partitioned by window."""
    month = F.trunc("o_orderdate", "month")
    item = F.struct(
        F.col("o_custkey").cast("string").alias("bidNtceNo"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("bidNtceNm"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm").alias("bidNtceDt"),
        F.date_format(F.date_add("o_orderdate", 20), "yyyy-MM-dd 18:00").alias("bidClseDt"),
    )
    region = F.when(F.col("o_orderkey") % 2 == 0, "00").otherwise("11")
    rows = orders.where("o_orderdate is not null").select(region.alias("region"), F.date_format(month, "yyyyMMddHHmm").alias("bgn"), "o_orderkey", item.alias("item"))
    # A window's records are numbered as they stream by in their order; its pages hold PAGE_ROWS each.
    at = F.row_number().over(W.partitionBy("region", "bgn").orderBy("o_orderkey")) - 1
    paged = rows.withColumn("at", at).withColumn("page", F.floor(F.col("at") / PAGE_ROWS).cast("int") + 1)
    pages = paged.groupBy("region", "bgn", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "item"))), lambda x: x["item"]).alias("items"), F.max("at").alias("last"))
    total = F.max("last").over(W.partitionBy("region", "bgn")) + 1
    header = F.struct(F.lit("00").alias("resultCode")).alias("header")
    body = F.to_json(F.struct(F.struct(header, F.struct(F.col("total").alias("totalCount"), "items").alias("body")).alias("response")))
    made = pages.withColumn("total", total).select(F.lit("orders").alias("operation"), "region", "bgn", "page", F.lit(200).alias("status"), body.alias("body"))
    made.write.partitionBy("operation", "region", "bgn").parquet(path)


def _ingested(spark: SparkSession, sf_dir: str, **options: str) -> tuple[UpsertSink, str, str, str]:
    """(sink, checkpoint, first month, the month after the last) of a run over all recorded windows."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    first, last = orders.agg(F.date_format(F.min("o_orderdate"), "yyyy-MM"), F.date_format(F.add_months(F.trunc(F.max("o_orderdate"), "month"), 1), "yyyy-MM-dd")).first()
    at = scratch(spark)
    record_responses(orders, f"{at}/recorded")
    sink = UpsertSink(spark, f"{at}/table", ["bidNo"], ingest.SEQUENCE, "2024-01-01 00:00:00")
    convert = lambda stream: ingest.records(stream, RECORD, normalize.normalize_bid)
    run = ingest.ingest(spark, sink, f"{at}/checkpoint", convert, path=f"{at}/recorded", lanes=",".join(LANES), start=first, asOf=last, windowsPerBatch="400", **options)
    if run.status:
        raise RuntimeError(run.error or f"windows that weren't fetched: {run.failed or run.stopped}")
    return sink, f"{at}/checkpoint", first, last


@register(
    "ingest_windows",
    """select cast(o_custkey as varchar) || '-000' as bidNo, 'order ' || o_orderkey as title, strftime(o_orderdate, '%Y-%m-%d') as date,
    strftime(o_orderdate + interval 20 days, '%Y-%m-%d') as deadline from orders where o_orderdate is not null
    qualify row_number() over (partition by o_custkey order by date_trunc('month', o_orderdate) desc, o_orderkey % 2 desc, o_orderkey desc) = 1""",
)
def ingest_windows(spark, sf_dir):
    """All windows, oldest first; of a key the record fetched last holds."""
    sink, *_ = _ingested(spark, sf_dir)
    return sink.current().select("bidNo", "title", "date", "deadline")


@register(
    "ingest_pending",
    f"""with m as (select unnest(generate_series((select date_trunc('month', min(o_orderdate)) from orders), (select date_trunc('month', max(o_orderdate)) + interval 1 month from orders), interval 1 month)) as m),
    w as (select m, r, (m <= (select max(o_orderdate) from orders)) as resumable from m cross join (values ('00', 0), ('11', 1)) t(r, p)),
    n as (select date_trunc('month', o_orderdate) as m, case when o_orderkey % 2 = 0 then '00' else '11' end as r, count(*) as n from orders group by 1, 2),
    c as (select w.*, sum(greatest(1, ceil(coalesce(n, 0) / {PAGE_ROWS}.0))) over (order by w.m, w.r) as calls from w left join n on n.m = w.m and n.r = w.r)
    select 'orders|' || r || '|' || strftime(m, '%Y%m%d') || '0000' as "window", resumable from c where calls > {FEW_CALLS} or not resumable""",
)
def ingest_pending(spark, sf_dir):
    """What a run with FEW_CALLS calls leaves, by the progress in its checkpoint."""
    _, checkpoint, first, last = _ingested(spark, sf_dir, maxCalls=str(FEW_CALLS))
    return ingest.pending(spark, checkpoint, LANES, first, last)


_MS = "date_trunc('milliseconds', ts)"


@register(
    "state_first_seen",
    f"""with l as (select user_id, event_type, {_MS} as t0, event_id as seq, cast(value as varchar) as v, min({_MS}) over (partition by user_id, event_type) as first_seen, (select max({_MS}) from events) as top
    from events where user_id is not null and event_type is not null and ts is not null qualify row_number() over (partition by user_id, event_type order by {_MS} desc, event_id desc) = 1)
    select user_id, event_type, strftime(first_seen, '%Y-%m-%d %H:%M:%S.%g') as first_seen, strftime(t0, '%Y-%m-%d %H:%M:%S.%g') as "at", seq, t0 + interval 5 days <= top - interval 2 days as expired from l""",
)
def state_first_seen(spark, sf_dir):
    """First and newest time of every key from keyed state; keys without an event for 5 days are forgotten."""
    at = scratch(spark)
    stream = parquet_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    key = ["user_id", "event_type"]
    changes = state.run_to_table(state.first_seen(stream, key, "ts", "event_id", "value", "5 days", "2 days"), f"{at}/changes", f"{at}/checkpoint")
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS").alias(c)
    return state.newest(changes, key).select(*key, shown("first_seen"), shown("at"), "seq", "expired")


@register(
    "state_alerts",
    f"""with l as (select user_id, event_type, event_id, {_MS} as t0, (select max({_MS}) from events) - interval 1 day as now from events
    where user_id is not null and event_type is not null and ts is not null qualify row_number() over (partition by user_id, event_type order by {_MS} desc, event_id desc) = 1),
    a as (select user_id, event_type, 'deadline' as kind, t0 + (event_id % 20) * interval 1 day as d, 3 as lead, now from l
    union all select user_id, event_type, 'qualification', t0 + (event_id % 9) * interval 1 day, 0, now from l where event_id % 3 = 0)
    select user_id, event_type, kind, strftime(d, '%Y-%m-%d %H:%M:%S.%g') as due from a where d - lead * interval 1 day <= now""",
)
def state_alerts(spark, sf_dir):
    """Alerts three days before a deadline and on the day of a qualification, of every notice's newest record."""
    at = scratch(spark)
    stream = parquet_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    later = lambda n: F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp")) + (F.col("event_id") % n) * state.DAY_MS)
    notices = stream.withColumns({"deadline": later(20), "qualification": F.when(F.col("event_id") % 3 == 0, later(9))})
    dates = {"deadline": ("deadline", 3), "qualification": ("qualification", 0)}
    found = state.run_to_table(state.alerts(notices, ["user_id", "event_type"], "ts", "event_id", dates), f"{at}/alerts", f"{at}/checkpoint")
    return found.select("user_id", "event_type", "kind", F.date_format("date", "yyyy-MM-dd HH:mm:ss.SSS").alias("due"))
