"""Registered queries that relate notices to others: awards, prior specifications, their own history, last year's notice, predictions.

``orders`` stand for bids, ``lineitem`` for awards, ``events`` for records with two times, ``documents`` for titled notices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.functions import automaton
from gazette.functions.rules import Rules
from gazette.operators import asof, competitors, similar, trends
from gazette.plans.catalogue import read, register
from gazette.sources.stores import scratch
from gazette.streaming import parts
from gazette.streaming.profiles import ProfileSink, profiles
from gazette.streaming.upserts import parquet_stream, run_available

TODAY = "1999-06-15"


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return parquet_stream(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    bids = parts.part(_stream(spark, sf_dir, "orders"), {"no": F.col("o_orderkey")}, "bid", {"registered": F.col("o_orderdate"), "amount": F.col("o_totalprice")})
    line = {"opened": F.col("l_shipdate"), "line": F.col("l_linenumber"), "winner": F.col("l_suppkey"), "price": F.col("l_extendedprice")}
    awards = parts.part(_stream(spark, sf_dir, "lineitem"), {"no": F.col("l_orderkey")}, "award", line)
    at = scratch(spark)
    sink = parts.PartsSink(spark, f"{at}/table", ["no"], ["bid", "award"])
    return parts.link_awards(run_available(bids.unionByName(awards, allowMissingColumns=True), sink, f"{at}/checkpoint"), TODAY)


_BIDS = "(select o_orderkey as no, o_orderdate as registered from orders where o_orderkey is not null qualify row_number() over (partition by o_orderkey order by o_orderdate desc nulls last, o_totalprice desc nulls last) = 1)"
_AWARDS = "(select l_orderkey as no, l_shipdate as opened, l_suppkey as winner from lineitem where l_orderkey is not null qualify row_number() over (partition by l_orderkey order by l_shipdate desc nulls last, l_linenumber desc, l_suppkey desc, l_extendedprice desc) = 1)"
_STATE = f"case when b.no is not null and a.no is not null then 'awarded' when a.no is not null then 'orphan' when cast(registered as date) + interval 9 months <= date '{TODAY}' then 'overdue' else 'open' end"


@register("link_awards", f"select coalesce(b.no, a.no) as no, {_STATE} as state, winner, strftime(opened, '%Y-%m-%d') as opened from {_BIDS} b full join {_AWARDS} a on b.no = a.no")
def link_awards(spark, sf_dir):
    """Bids with their last award, from streams of both."""
    return _linked(spark, sf_dir).select("no", "state", F.col("award.winner").alias("winner"), F.date_format("award.opened", "yyyy-MM-dd").alias("opened"))


@register("link_overdue_months", f"select strftime(registered, '%Y-%m') as month, count(*) as n from (select b.registered, {_STATE} as state from {_BIDS} b full join {_AWARDS} a on b.no = a.no) where state = 'overdue' group by 1")
def link_overdue_months(spark, sf_dir):
    """Registration months whose openings are to be asked for again."""
    return parts.months_to_ask(_linked(spark, sf_dir))


@register(
    "link_prespecs",
    """with t as (select o_orderkey as bid_no, o_custkey as pre_no, 1 as k from orders union all select user_id, event_id, 2 from events),
    l as (select bid_no, pre_no, bit_or(k) as k from t where bid_no is not null and pre_no is not null group by 1, 2)
    select bid_no, pre_no, ['bid', 'prespec', 'both'][k] as told_by, bid_no in (select o_orderkey from orders) as has_bid, pre_no in (select event_id from events) as has_pre from l""",
)
def link_prespecs(spark, sf_dir):
    """Links of bids and prior specifications, told by either."""
    bids = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("bid_no"), F.array("o_custkey").alias("pre_nos"))
    return parts.link_prespecs(bids, read(spark, sf_dir, "events").select(F.col("event_id").alias("pre_no"), F.array("user_id").alias("bid_nos")))


# An event says how its user's notice is from its day on; it is known some days later, not in the order of the days.
_LOG = "(select user_id, event_type, date_trunc('day', ts) as valid, date_trunc('day', ts) + (1 + event_id % 9) * interval 1 day as known, event_id, value from events where user_id is not null and event_type is not null and ts is not null)"
_HELD = f"(select * from {_LOG} where known <= timestamp '2024-01-20' qualify row_number() over (partition by user_id, event_type, valid order by known desc, event_id desc) = 1)"
_KEY = ["user_id", "event_type"]


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_trunc("day", "ts")
    known = (day + F.make_dt_interval((F.col("event_id") % 9 + 1).cast("int"))).cast(day_type := "timestamp")
    log = _stream(spark, sf_dir, "events").where("ts is not null").select(*_KEY, day.cast(day_type).alias("valid"), known.alias("known"), "event_id", "value")
    at = scratch(spark)
    return run_available(log, parts.HistorySink(spark, f"{at}/table", _KEY, "valid", "known", "event_id"), f"{at}/checkpoint")


@register("history_point_in_time", f"select user_id, event_type, strftime(valid, '%Y-%m-%d') as valid, strftime(known, '%Y-%m-%d') as known, event_id, value from {_HELD} where valid <= timestamp '2024-01-12' and event_type <> 'error' qualify row_number() over (partition by user_id, event_type order by valid desc) = 1")
def history_point_in_time(spark, sf_dir):
    """What was shown on the 20th as true on the 12th; a notice whose record is an error is removed."""
    at = lambda d: F.lit(d).cast("timestamp")
    found = parts.point_in_time(_history(spark, sf_dir), _KEY, "valid", "known", at("2024-01-12"), at("2024-01-20"), F.col("event_type") == "error")
    return found.select(*_KEY, F.date_format("valid", "yyyy-MM-dd").alias("valid"), F.date_format("known", "yyyy-MM-dd").alias("known"), "event_id", "value")


@register("history_timeline", f"select user_id, event_type, event_id, strftime(valid, '%Y-%m-%d') as valid, strftime(lead(valid) over (partition by user_id, event_type order by valid), '%Y-%m-%d') as valid_to from {_HELD}")
def history_timeline(spark, sf_dir):
    """All intervals as they were known on the 20th."""
    found = parts.timeline(_history(spark, sf_dir), _KEY, "valid", "known", F.lit("2024-01-20").cast("timestamp"))
    return found.select(*_KEY, "event_id", F.date_format("valid", "yyyy-MM-dd").alias("valid"), F.date_format("valid_to", "yyyy-MM-dd").alias("valid_to"))


@register(
    "similar_last_year",
    r"""with d as (select doc_id, lang, list_filter(list_distinct(string_split_regex(text, '[ \t\n\x0B\x0C\r]+')), lambda x: x <> '') as w from documents),
    s as (select * from d where len(w) > 0),
    p as (select a.doc_id, a.lang, b.doc_id as last_id, len(list_intersect(a.w, b.w)) as s, len(a.w) + len(b.w) as total from s a join s b on a.lang = b.lang
      where a.doc_id % 2 = 1 and b.doc_id % 2 = 0 and 4 * least(len(a.w), len(b.w)) >= 3 * greatest(len(a.w), len(b.w))),
    q as (select *, s / (total - s) as similarity from p where 4 * s >= 3 * (total - s))
    select doc_id, lang, last_id, similarity, case when similarity = 1 then 'strong' else 'medium' end as tier from q
    qualify row_number() over (partition by doc_id order by similarity desc, last_id) = 1""",
)
def similar_last_year(spark, sf_dir):
    """Texts with odd ids (this year's) and the most similar in their language with even ids, by whole texts' words."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    words = F.filter(F.split("text", r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    return similar.last_years(docs.where("doc_id % 2 = 1"), docs.where("doc_id % 2 = 0"), ["lang"], words, "doc_id")


@register(
    "trend_words",
    """with c as (select distinct l.l_shipdate, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, w.t as token, rowid from (select *, row_number() over () as rowid from lineitem) l join part p on p.p_partkey = l.l_partkey, unnest(list_distinct(string_split(p.p_name, ' '))) w(t) where l.l_shipdate is not null),
    m as (select unnest(generate_series((select min(date_trunc('month', l_shipdate)) from c), (select max(date_trunc('month', l_shipdate)) from c), interval 1 month)) as month),
    g as (select token, date_trunc('month', l_shipdate) as month, count(*) as n from c group by 1, 2),
    f as (select t.token, m.month, coalesce(g.n, 0) as n, row_number() over (partition by t.token order by m.month) as x from (select distinct token from g) t cross join m left join g on g.token = t.token and g.month = m.month)
    select token, cast(sum(n) as bigint) as total, count(*) filter (where n > 0) as active, round(regr_slope(n, x), 6) as slope, round(regr_slope(n, x) * count(*) / sum(n), 6) as relative from f group by token""",
)
def trend_words(spark, sf_dir):
    """Slopes of the words of what was sold, by month; lines are counted by part before they meet the names."""
    sold = read(spark, sf_dir, "lineitem").groupBy("l_partkey", F.trunc("l_shipdate", "month").alias("month")).agg(F.count("*").alias("n"))
    named = sold.join(read(spark, sf_dir, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    found = trends.word_trends(named, F.split("p_name", " "), "month", "n")
    return found.withColumns({"slope": F.round("slope", 6), "relative": F.round("relative", 6)})


_ASOF = """(select a.event_id, a.event_type, a.value, max(struct_pack(t := b.ts, i := b.event_id, v := b.value)) as found
    from events a left join events b on b.event_type = 'click' and b.user_id = a.user_id and b.ts < a.ts where a.event_type <> 'click' group by 1, 2, 3)"""


@register("asof_predictions", f"select event_id, found.i as prediction, found.v as predicted from {_ASOF}")
def asof_predictions(spark, sf_dir):
    """Each event and the last click of its user before it."""
    return _predicted(spark, sf_dir).select("event_id", F.col("found.event_id").alias("prediction"), F.col("found.value").alias("predicted"))


@register("asof_bias", f"select event_type, count(*) as n, count(*) filter (where found.i is null) as missing, round(avg(found.v - value), 6) as bias, round(avg(abs(found.v - value)), 6) as absolute from {_ASOF} group by event_type")
def asof_bias(spark, sf_dir):
    """How far predictions were off, by type."""
    joined = _predicted(spark, sf_dir).withColumn("predicted", F.col("found.value"))
    return asof.bias(joined, ["event_type"], "predicted", "value").withColumns({c: F.round(c, 6) for c in ("bias", "absolute")})


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value")
    made = e.where("event_type = 'click'").select("user_id", "ts", "event_id", "value")
    return asof.as_of(e.where("event_type <> 'click'"), made, ["user_id"], "ts", "ts", "event_id", strict=True)


_SOLD = "(select l_orderkey, cast(l_suppkey as varchar) as owner, l_returnflag, l_linestatus, l_quantity, cast(l_extendedprice as decimal(38,2)) as amount from lineitem where l_orderkey is not null qualify row_number() over (partition by l_orderkey order by l_shipdate desc nulls last, l_linenumber desc nulls last, l_suppkey desc nulls last, l_extendedprice desc nulls last) = 1)"
_COUNTS = f"(select owner, d as dimension, v as value, count(*) as n, sum(coalesce(amount, 0)) as amount from (select owner, amount, 'l_returnflag' as d, l_returnflag as v from {_SOLD} union all select owner, amount, 'l_linestatus', l_linestatus from {_SOLD}) where owner is not null and v is not null group by 1, 2, 3)"


@register(
    "profile_suppliers",
    f"""select owner, dimension, cast(sum(n) as bigint) as n, cast(sum(amount) as double) as amount, count(*) as n_values, arg_min(value, (-n, value)) as mode, max(n) as mode_n, cast(sum(n * n) as double) / pow(sum(n), 2) as concentration
    from {_COUNTS} group by owner, dimension""",
)
def profile_suppliers(spark, sf_dir):
    """Suppliers by the last line of each order: histograms that are kept from changes."""
    at = scratch(spark)
    sink = ProfileSink(spark, f"{at}/table", ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_suppkey", "l_extendedprice"], "l_suppkey", "l_extendedprice", ["l_returnflag", "l_linestatus"])
    query = _stream(spark, sf_dir, "lineitem").writeStream.foreachBatch(sink).option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return profiles(sink.current()).withColumn("amount", F.col("amount").cast("double"))


#: Months of three periods, as ``trends.month_number`` counts them: two years and all.
_PERIODS = {"1996": (1996 * 12, 1996 * 12 + 11), "1999-h1": (1999 * 12, 1999 * 12 + 5), "all": (0, 9999 * 12)}


@register(
    "ext_competitors_by_word",
    """with a as (select unnest(list_distinct(string_split(p_name, ' '))) as word, l_suppkey as supplier, year(l_shipdate) * 12 + month(l_shipdate) - 1 as m from lineitem join part on l_partkey = p_partkey),
    p as (select * from (values ('1996', 1996 * 12, 1996 * 12 + 11), ('1999-h1', 1999 * 12, 1999 * 12 + 5), ('all', 0, 9999 * 12)) t(period, first, last)),
    c as (select period, word, supplier, count(*) as n from a join p on m between first and last where supplier is not null group by all),
    t as (select *, sum(n) over (partition by period, word) as total, row_number() over (partition by period, word order by n desc, supplier) as rank from c)
    select period, word, rank, supplier, n, cast(floor(total * 7 / 16384) as bigint) as error from t where rank <= 10""",
)
def ext_competitors_by_word(spark, sf_dir):
    """The ten suppliers with most lines of parts named with a word, by period, all from one stored table of monthly counts; ``error`` is what a sketch of that total would be off by at most."""
    words = read(spark, sf_dir, "part").select("p_partkey", F.explode(F.array_distinct(F.split("p_name", " "))).alias("word"))
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("supplier"), trends.month_number(F.col("l_shipdate")).alias("month"))
    at = f"{scratch(spark)}/counts"
    competitors.month_counts(lines.join(words, "p_partkey"), ["word"], "month", "supplier").write.parquet(at)
    found = competitors.top_counted(spark.read.parquet(at), ["word"], "month", _PERIODS)
    return found.select("period", "word", F.col("rank").cast("long").alias("rank"), F.col("item").alias("supplier"), "n", competitors.most_error(F.col("total")).alias("error"))


#: How many words and phrases a large rule file has: exclude words, group words, allowed phrases, releases.
RULE_SIZES = (170, 120, 40, 7)


def rules_of_corpus(docs: DataFrame) -> Rules:
    """A rule file of RULE_SIZES from a corpus' most frequent words and pairs of words (a bounded list of each)."""
    n_exclude, n_group, n_allow, n_release = RULE_SIZES
    words = F.filter(F.split("text", r"[ \t\n\x0B\f\r]+"), lambda w: F.length(w) >= 3)
    frequent = lambda column, n: [r[0] for r in docs.select(F.explode(F.array_distinct(column)).alias("x")).groupBy("x").count().orderBy(F.desc("count"), "x").limit(n).collect()]
    top = frequent(words, n_exclude + n_group)
    grouped, exclude = top[:n_group], tuple(top[n_group:])
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.when(a.isin(*exclude) & b.isNotNull(), F.concat_ws(" ", a, b)))
    allow = tuple(frequent(F.array_compact(pairs), n_allow)) if exclude else ()
    groups = {f"g{i}": tuple(grouped[i::6]) for i in range(6)}
    return Rules(groups, exclude, allow, allow[:10], tuple((w, exclude[i :: n_release][:5]) for i, w in enumerate(grouped[-n_release:])))


@register("rules_automaton")
def rules_automaton(spark, sf_dir):
    """Whole texts by a rule file of the size that is used in practice; tested against the expressions a word."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = automaton.classify(docs, F.col("text"), F.col("text"), rules_of_corpus(docs))
    return found.select("doc_id", F.concat_ws(",", "groups").alias("groups"), F.concat_ws(",", "excluded").alias("excluded"), "label")
