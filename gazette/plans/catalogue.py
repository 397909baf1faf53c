"""The registered queries and their DuckDB SQL, over the stand-in tables.

``part`` stands for titled and categorized notices, ``orders`` for dated ones, ``events`` for a stream of keyed
records, ``pages`` for boards, ``documents`` for titles. Rules and dates are fixed, so results are the same every day.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.functions import text as t
from gazette.functions.deadline import extract_deadline
from gazette.functions.rules import Rules, excluded_by, match_groups, matched_word
from gazette.operators import discovery, normalize, ordering, retention, views
from gazette.operators.upsert import last_write, upsert
from gazette.sources import boards, envelope, windows
from gazette.sources.stores import scratch

AS_OF = "1998-06-15"
EVENTS_AS_OF = "2024-01-20"

RULES = Rules(
    groups={"metal": ("bolt", "anvil", "ring"), "flat": ("plate", "rod"), "small": ("SMALL", "widget")},
    exclude=("old", "large", "blue"),
    allow=("cold",),
    group_allow=("new ring", "widget"),
    release=(("anvil", ("large", "blue")),),
    codes=("PROMO",),
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# ---------------------------------------------------------------- keyword rules


def _occurs(x: str, word: str, allow: tuple[str, ...]) -> str:
    """SQL: the word is somewhere in x where no phrase covers it."""
    spots = [f"(i > {k} and substr({x}, i - {k}, {len(a)}) = '{a}')" for a in allow for k in range(len(a) - len(word) + 1) if a[k : k + len(word)] == word]
    covered = f" and not ({' or '.join(spots)})" if spots else ""
    return f"(len(list_filter(range(1, length({x}) + 1), lambda i: substr({x}, i, {len(word)}) = '{word}'{covered})) > 0)"


def _listed(cases: list[tuple[str, str]]) -> str:
    return "list_filter([" + ", ".join(f"case when {c} then '{v}' end" for c, v in cases) + "], lambda x: x is not null)"


_TITLE, _HAY = "p_name", "(p_name || ' ' || p_type)"
_GROUPS = _listed([(" or ".join(_occurs(_HAY, w, RULES.group_allow) for w in ws), g) for g, ws in RULES.groups.items()])
_EXCLUDED = _listed([(_occurs(_TITLE, w, RULES.allow) + "".join(f" and not contains({_TITLE}, '{when}')" for when, ws in RULES.release if w in ws), w) for w in RULES.exclude])
_CLASSIFIED = f"""
with c as (
    select *, {_HAY} as hay, {_EXCLUDED} as ex,
        case when len({_GROUPS}) = 0 and p_type in ('PROMO') then ['분류'] else {_GROUPS} end as gs
    from part
), k as (
    select *, case when len(ex) > 0 and len(gs) > 0 then 'killed' when len(ex) > 0 then 'excluded' when len(gs) > 0 then 'kept' else 'unmatched' end as label from c
)
"""


def _hay() -> Column:
    return t.haystack(F.col("p_name"), F.col("p_type"))


def _classified(spark: SparkSession, sf_dir: str, rules: Rules = RULES) -> DataFrame:
    return discovery.classify(read(spark, sf_dir, "part"), F.col("p_name"), _hay(), rules, F.col("p_type"))


@register("kw_partition_counts", _CLASSIFIED + "select label, count(*) as n from k group by label")
def kw_partition_counts(spark, sf_dir):
    return _classified(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n"))


@register("kw_match_groups", f"select p_partkey, array_to_string({_GROUPS}, ',') as groups, coalesce({_GROUPS}[1], '') as first_group from part")
def kw_match_groups(spark, sf_dir):
    groups = match_groups(_hay(), RULES)
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(groups, ",").alias("groups"), F.coalesce(F.get(groups, 0), F.lit("")).alias("first_group"))


@register("kw_code_fallback", _CLASSIFIED + "select p_partkey, array_to_string(gs, ',') as groups from k")
def kw_code_fallback(spark, sf_dir):
    return _classified(spark, sf_dir).select("p_partkey", F.array_join("groups", ",").alias("groups"))


@register("kw_excluded_words", f"select p_partkey, array_to_string({_EXCLUDED}, ',') as excluded from part")
def kw_excluded_words(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(excluded_by(F.col("p_name"), RULES), ",").alias("excluded"))


@register("kw_exclude_frequency", _CLASSIFIED + "select w as word, count(*) as n from (select unnest(ex) as w from k) group by w order by n desc, w limit 12")
def kw_exclude_frequency(spark, sf_dir):
    words = _classified(spark, sf_dir).select(F.explode("excluded").alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(12)


@register("kw_first_reason", _CLASSIFIED + "select ex[1] as word, count(*) as n from k where len(ex) > 0 group by ex[1] order by n desc, word limit 6")
def kw_first_reason(spark, sf_dir):
    hit = _classified(spark, sf_dir).where(F.size("excluded") > 0)
    return hit.groupBy(F.get("excluded", 0).alias("word")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(6)


@register("kw_group_counts", _CLASSIFIED + "select g as grp, count(*) as n, count(*) filter (where g = gs[1]) as n_first from (select gs, unnest(gs) as g from k where label = 'kept') group by g")
def kw_group_counts(spark, sf_dir):
    each = _classified(spark, sf_dir).where("label = 'kept'").select("groups", F.explode("groups").alias("grp"))
    return each.groupBy("grp").agg(F.count("*").alias("n"), F.count_if(F.col("grp") == F.get("groups", 0)).alias("n_first"))


@register(
    "kw_word_counts_zero",
    _CLASSIFIED
    + "select grp, word, count(p_partkey) as n from (values "
    + ", ".join(f"('{g}', '{w}')" for g, ws in RULES.groups.items() for w in ws)
    + ") v(grp, word) left join k on label = 'kept' and list_contains(gs, grp) and contains(hay, word) group by grp, word",
)
def kw_word_counts_zero(spark, sf_dir):
    return discovery.word_counts(_classified(spark, sf_dir), _hay(), RULES)


@register("kw_matched_word", "select p_partkey, case " + " ".join(f"when contains(p_name, '{w}') then '{w}'" for w in RULES.groups["small"]) + " " + " ".join(f"when contains({_HAY}, '{w}') then '{w}·분류명'" for w in RULES.groups["small"]) + " else '?' end as word from part")
def kw_matched_word(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", matched_word(F.col("p_name"), _hay(), RULES.groups["small"]).alias("word"))


@register(
    "kw_what_if",
    f"select case when len({_EXCLUDED}) > 0 then 'excluded' when {' or '.join(_occurs(_HAY, w, RULES.group_allow) for ws in RULES.groups.values() for w in ws if w != 'rod')} then 'caught' else 'fresh' end as label, count(*) as n "
    f"from part where contains({_HAY}, 'rod') group by 1",
)
def kw_what_if(spark, sf_dir):
    return discovery.what_if(read(spark, sf_dir, "part"), "rod", F.col("p_name"), _hay(), RULES).groupBy("label").agg(F.count("*").alias("n"))


@register("src_scoped_exclude", "select source, count(*) as n from documents where text is null or not (contains(text, 'the') or (source = 'src1' and contains(text, 'un'))) group by source")
def src_scoped_exclude(spark, sf_dir):
    common, own = ("the",), {"src1": ("un",)}
    bad = F.when(F.col("source") == "src1", views.source_excluded(F.col("text"), "src1", common, own)).otherwise(views.source_excluded(F.col("text"), "", common, own))
    return read(spark, sf_dir, "documents").where(~bad).groupBy("source").agg(F.count("*").alias("n"))


# -------------------------------------------------------------------- deadlines

_POST, _DUE = "cast(o_orderdate as date)", "cast(o_orderdate as date) + cast(o_orderkey % 45 as int)"


def _deadlines(spark: SparkSession, sf_dir: str, *texts: Callable[[Column, Column], Column], shift: int = 0) -> DataFrame:
    post = F.to_date("o_orderdate")
    due = F.date_add(post, (F.col("o_orderkey") % 45).cast("int") + shift)
    found = extract_deadline(F.date_format(post, "yyyy-MM-dd"), *[f(post, due) for f in texts])
    return read(spark, sf_dir, "orders").select("o_orderkey", found.cast("string").alias("deadline"))


_month = lambda d: F.month(d).cast("string")
_of = lambda d: F.dayofmonth(d).cast("string")


def _phrase(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


_KNOWN = f"select o_orderkey, cast({_DUE} as varchar) as deadline from orders"


@register("deadline_kmd", _KNOWN)
def deadline_kmd(spark, sf_dir):
    return _deadlines(spark, sf_dir, lambda p, d: _phrase("신청 ", _month(d), "월 ", _of(d), "일(금)까지"))


@register("deadline_range", _KNOWN)
def deadline_range(spark, sf_dir):
    return _deadlines(spark, sf_dir, lambda p, d: _phrase("신청기간: ", _month(p), "월 ", _of(p), "일부터 ", _month(d), "월 ", _of(d), "일까지"))


@register("deadline_dot", _KNOWN)
def deadline_dot(spark, sf_dir):
    return _deadlines(spark, sf_dir, lambda p, d: _phrase("접수기간 ", F.date_format(p, "yyyy. M. d."), "(월) ~ ", F.date_format(d, "yyyy. M. d."), "(수) 18:00"))


@register("deadline_slash", _KNOWN)
def deadline_slash(spark, sf_dir):
    return _deadlines(spark, sf_dir, lambda p, d: _phrase("(접수 ", _month(p), "/", _of(p), "~", _month(d), "/", _of(d), ")"))


@register("deadline_same_month", _KNOWN)
def deadline_same_month(spark, sf_dir):
    return _deadlines(spark, sf_dir, lambda p, d: _phrase("접수 ", _month(d), "월 1~", _of(d), "일"))


@register("deadline_no_such_day", _KNOWN)
def deadline_no_such_day(spark, sf_dir):
    """Days that no calendar has are passed over."""
    return _deadlines(spark, sf_dir, lambda p, d: _phrase("접수 ~ 2. 30. 접수 ~ 13. 5. 접수 ~ 2026. 6. 31. 접수 ~ 0. 9. 접수 ~ ", F.date_format(d, "yyyy. M. d.")))


@register("deadline_year_infer", f"select o_orderkey, cast({_POST} + cast(o_orderkey % 45 as int) - 30 as varchar) as deadline from orders")
def deadline_year_infer(spark, sf_dir):
    return _deadlines(spark, sf_dir, lambda p, d: _phrase("모집 ~ ", _month(d), ". ", _of(d), "."), shift=-30)


@register("deadline_context", _KNOWN)
def deadline_context(spark, sf_dir):
    """A later date of an activity period and an untiered one lose against the application date."""
    later = lambda d: F.date_format(F.date_add(d, 60), "yyyy. M. d.")
    return _deadlines(spark, sf_dir, lambda p, d: _phrase("활동기간: 2020. 1. 1. ~ ", later(d), " 그리고 아무런 문맥이 없는 아주 긴 설명이 이어지는 날 ~ ", later(d), " 그다음에 아주 긴 문장이 또 이어지고 접수 ~ ", F.date_format(d, "yyyy. M. d.")))


@register("deadline_window", f"select o_orderkey, case when o_orderkey % 45 <= 20 then cast({_POST} + cast(380 + o_orderkey % 45 as int) as varchar) end as deadline from orders")
def deadline_window(spark, sf_dir):
    """Explicit years count up to 400 days ahead."""
    return _deadlines(spark, sf_dir, lambda p, d: _phrase("신청 ~ ", F.date_format(d, "yyyy. M. d.")), shift=380)


@register("deadline_text_order", _KNOWN)
def deadline_text_order(spark, sf_dir):
    """The first text with any candidate wins; one without is passed over."""
    return _deadlines(spark, sf_dir, lambda p, d: F.lit("연 2.5~4.5% 금리, 13~16시"), lambda p, d: _phrase("~ ", F.date_format(d, "yyyy. M. d.")), lambda p, d: _phrase("접수 ~ ", F.date_format(F.date_add(d, 9), "yyyy. M. d.")))


# ------------------------------------------------------------------- normalizing


@register("normalize_num", "select l_orderkey, l_linenumber, l_extendedprice as price, cast(null as double) as bad from lineitem")
def normalize_num(spark, sf_dir):
    shown = F.concat(F.lit(" "), F.format_number("l_extendedprice", 2), F.lit(" "))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", t.number(shown).alias("price"), t.number(F.lit("1.2.3")).alias("bad"))


@register("normalize_splitdt", "select event_id, strftime(ts, '%Y-%m-%d') as date, strftime(ts, '%H:%M') as time from events")
def normalize_splitdt(spark, sf_dir):
    shown = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return read(spark, sf_dir, "events").select("event_id", t.date_part(shown).alias("date"), t.time_part(shown).alias("time"))


@register("normalize_flag3", "select s_suppkey, case s_suppkey % 5 when 0 then false when 1 then true when 2 then true when 3 then false end as joint_ok, s_suppkey % 5 = 2 as yes from supplier")
def normalize_flag3(spark, sf_dir):
    kind = (F.col("s_suppkey") % 5).cast("int")
    method = F.get(F.array(F.lit("(없음)공동수급불허"), F.lit("공동이행"), F.lit(""), F.lit(" "), F.lit(None).cast("string")), kind)
    yes = F.get(F.array(F.lit("Y"), F.lit("N"), F.lit("Y"), F.lit("N"), F.lit("")), kind)
    return read(spark, sf_dir, "supplier").select("s_suppkey", t.joint_allowed(method, yes).alias("joint_ok"), (t.flag(yes) & (kind == 2)).alias("yes"))


def _raw_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return read(spark, sf_dir, "orders").select(
        F.when(c("o_orderkey") % 10 != 0, c("o_orderkey").cast("string")).otherwise(" ").alias("bidNtceNo"),
        F.when(c("o_orderkey") % 3 == 0, "001").otherwise("").alias("bidNtceOrd"),
        F.concat(F.lit(" "), c("o_orderpriority")).alias("bidNtceNm"),
        F.when(c("o_orderkey") % 2 == 0, "").otherwise("agency").alias("dminsttNm"),
        F.lit("notice org").alias("ntceInsttNm"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm").alias("bidNtceDt"),
        F.format_number("o_totalprice", 2).alias("presmptPrce"),
        c("o_orderstatus").alias("ntceSpecFileNm1"),
        F.when(c("o_orderstatus") == "F", "u1").alias("ntceSpecDocUrl1"),
        F.lit("b").alias("ntceSpecFileNm2"),
        F.lit("u2").alias("ntceSpecDocUrl2"),
    )


@register(
    "normalize_bids",
    """select o_orderkey || '-' || case when o_orderkey % 3 = 0 then '001' else '000' end as bid_no, o_orderpriority as title,
    case when o_orderkey % 2 = 0 then 'notice org' else 'agency' end as org, strftime(o_orderdate, '%Y-%m-%d') as date, '' as deadline, o_totalprice as price,
    case when o_orderstatus = 'F' then 'F=u1,b=u2' else 'b=u2' end as files, false as re_notice from orders where o_orderkey % 10 <> 0""",
)
def normalize_bids(spark, sf_dir):
    found = normalize.valid(normalize.normalize_bid(_raw_bids(spark, sf_dir)))
    files = F.array_join(F.transform("files", lambda x: F.concat_ws("=", x["name"], x["url"])), ",")
    return found.select(F.col("bidNo").alias("bid_no"), "title", "org", "date", "deadline", "price", files.alias("files"), F.col("reNtce").alias("re_notice"))


@register("normalize_opening", "select o_orderkey, case o_orderkey % 4 when 0 then strftime(o_orderdate, '%Y-%m-%d') || ' 10:30' when 1 then strftime(o_orderdate, '%Y-%m-%d') when 2 then strftime(o_orderdate, '%Y-%m-%d') || ' 09:00' else '' end as opening from orders")
def normalize_opening(spark, sf_dir):
    """The opening time, else that of a second opening; a date without a time stays a date."""
    kind, day = F.col("o_orderkey") % 4, F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("bidNtceNo"),
        F.when(kind == 0, F.concat(day, F.lit(" 10:30:00"))).when(kind == 1, day).when(kind == 3, "soon").otherwise("").alias("opengDt"),
        F.when(kind == 2, F.concat(day, F.lit(" 09:00"))).when(kind == 0, "2001-01-01").alias("rbidOpengDt"),
    )
    return normalize.normalize_bid(raw).select(F.split("bidNo", "-")[0].cast("long").alias("o_orderkey"), "opening")


@register("normalize_prespecs", "select cast(o_orderkey as varchar) as bid_no, '용역' as kind, o_orderpriority as title, case when o_orderkey % 4 = 0 then 'a|b' else '' end as converted, '규격서 2=u' as files from orders")
def normalize_prespecs(spark, sf_dir):
    key = F.col("o_orderkey")
    raw = read(spark, sf_dir, "orders").select(key.cast("string").alias("bfSpecRgstNo"), F.col("o_orderpriority").alias("prdctClsfcNoNm"), F.when(key % 4 == 0, " a, ,b ").alias("bidNtceNoList"), F.lit("u").alias("specDocFileUrl2"))
    files = F.array_join(F.transform("files", lambda x: F.concat_ws("=", x["name"], x["url"])), ",")
    return normalize.normalize_prespec(raw).select(F.col("bidNo").alias("bid_no"), "kind", "title", F.array_join("bidNtceNoList", "|").alias("converted"), files.alias("files"))


@register("non_blank_fields", "select s_suppkey, case when s_suppkey % 2 = 0 then 'city,name' else 'name' end as fields from supplier")
def non_blank_fields(spark, sf_dir):
    fields = F.create_map(F.lit("name"), F.col("s_name"), F.lit("city"), F.when(F.col("s_suppkey") % 2 == 0, "x").otherwise(" "), F.lit("none"), F.lit(None).cast("string"))
    return read(spark, sf_dir, "supplier").select("s_suppkey", F.array_join(F.array_sort(F.map_keys(normalize.non_blank(fields))), ",").alias("fields"))


# ------------------------------------------------------------- upsert, retention


@register("dedup_last_wins", "select user_id, event_type, event_id, value from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1")
def dedup_last_wins(spark, sf_dir):
    return last_write(read(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


_OLD_UNTIL, _NEW_FROM, _NOW = "2024-01-15", "2024-01-12", "2024-02-01 00:00:00"


@register(
    "upsert_first_seen",
    f"""with o as (select user_id, event_type, value, event_id, ts from events where ts < timestamp '{_OLD_UNTIL}' qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1),
    n as (select user_id, event_type, value, event_id, ts from events where ts >= timestamp '{_NEW_FROM}' qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1)
    select coalesce(n.user_id, o.user_id) as user_id, coalesce(n.event_type, o.event_type) as event_type, coalesce(n.event_id, o.event_id) as event_id, coalesce(n.value, o.value) as value,
    cast(coalesce(o.ts, timestamp '{_NOW}') as varchar) as first_seen from o full join n on o.user_id = n.user_id and o.event_type = n.event_type""",
)
def upsert_first_seen(spark, sf_dir):
    """A store as of one day, and an overlapping batch from three days before it."""
    events = read(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts")
    key, seq = ["user_id", "event_type"], ["ts", "event_id"]
    old = last_write(events.where(F.col("ts") < _OLD_UNTIL), key, seq).withColumn("first_seen", F.col("ts"))
    found = upsert(old, events.where(F.col("ts") >= _NEW_FROM), key, seq, F.lit(_NOW).cast("timestamp"))
    return found.select("user_id", "event_type", "event_id", "value", F.col("first_seen").cast("string").alias("first_seen"))


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.when(F.col("o_orderkey") % 7 == 0, "unknown").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    due = F.when(F.col("o_orderkey") % 2 == 0, F.date_format(F.date_add("o_orderdate", 20), "yyyy-MM-dd")).otherwise("")
    return read(spark, sf_dir, "orders").select("o_orderkey", date.alias("date"), due.alias("deadline"), F.concat(F.lit("1990-01-01 ~ "), date).alias("period"))


_AGE = f"(date '{AS_OF}' - cast(o_orderdate as date))"


@register("retention_age", f"select o_orderkey from orders where o_orderkey % 7 = 0 or {_AGE} <= 30")
def retention_age(spark, sf_dir):
    return retention.prune_by_age(_dated(spark, sf_dir), "date", 30, AS_OF).select("o_orderkey")


@register("retention_period_end", f"select o_orderkey from orders where o_orderkey % 7 = 0 or {_AGE} <= 0")
def retention_period_end(spark, sf_dir):
    return retention.prune_by_period_end(_dated(spark, sf_dir), "period", 0, AS_OF).select("o_orderkey")


@register("retention_deadline_or_age", f"select o_orderkey from orders where case when o_orderkey % 2 = 0 then {_AGE} - 20 <= 3 else o_orderkey % 7 = 0 or {_AGE} <= 30 end")
def retention_deadline_or_age(spark, sf_dir):
    return retention.prune_by_deadline_or_age(_dated(spark, sf_dir), "deadline", "date", 3, 30, AS_OF).select("o_orderkey")


@register(
    "gold_bids",
    f"""with p as (select p_partkey, {_EXCLUDED} as ex, {_GROUPS} as gs from part)
    select o_orderkey, array_to_string(gs, ',') as kw from orders join lineitem on l_orderkey = o_orderkey and l_linenumber = 1 join p on l_partkey = p_partkey
    where len(ex) = 0 and len(gs) > 0 and case when o_orderkey % 2 = 0 then {_AGE} - 20 <= 0 else o_orderkey % 7 = 0 or {_AGE} <= 30 end""",
)
def gold_bids(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("title"), F.col("p_type").alias("category"))
    first = read(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("k"))
    dated = _dated(spark, sf_dir).join(first, "o_orderkey")
    # The oracle's haystack has no further levels; trailing blanks match no word.
    notices = dated.join(parts, "k").withColumn("bidNo", F.col("o_orderkey").cast("string"))
    return views.gold(notices, RULES, AS_OF).select("o_orderkey", F.array_join("kw", ",").alias("kw"))


@register(
    "gold_prespecs",
    f"""with p as (select p_partkey, {_EXCLUDED} as ex, {_GROUPS} as gs from part)
    select p_partkey, array_to_string(gs, ',') as kw from p where len(ex) = 0 and len(gs) > 0 and p_partkey % 4 <> 0 and p_partkey % 40 <= 30""",
)
def gold_prespecs(spark, sf_dir):
    """Prior specifications that aren't yet notices: by the numbers of notices on the row itself."""
    key = F.col("p_partkey")
    raw = read(spark, sf_dir, "part").select("p_partkey", _hay().alias("prdctClsfcNoNm"), key.cast("string").alias("bfSpecRgstNo"), F.date_format(F.date_sub(F.lit(AS_OF).cast("date"), (key % 40).cast("int")), "yyyy-MM-dd").alias("rcptDt"), F.when(key % 4 == 0, "n1, n2").otherwise(" , ").alias("bidNtceNoList"))
    title = raw.select("p_partkey", F.col("bfSpecRgstNo").alias("bidNo")).join(read(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("title"), F.col("p_type").alias("category")), "p_partkey")
    found = normalize.normalize_prespec(raw).drop("title").join(title, "bidNo")
    return views.gold(found, RULES, AS_OF, converted="bidNtceNoList").select("p_partkey", F.array_join("kw", ",").alias("kw"))


@register("gold_prespec_anti", "select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')")
def gold_prespec_anti(spark, sf_dir):
    """Not yet converted, with the conversions in a table of their own."""
    done = read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return read(spark, sf_dir, "orders").select("o_orderkey").join(done, "o_orderkey", "left_anti")


# ------------------------------------------------------------- windows, progress


_SPAN = "span as (select min(cast(o_orderdate as date)) as lo, max(cast(o_orderdate as date)) as hi from orders), g as (select unnest(generate_series(cast(date_trunc('month', lo) as timestamp), cast(hi as timestamp), interval 1 month)) as m, hi from span)"


def _planned(spark, sf_dir):
    """The windows from the first order's month to the last order's day."""
    first, last = read(spark, sf_dir, "orders").select(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    return windows.windows(spark, (last - first).days, str(last))


def _orders_by_window(spark, sf_dir):
    return read(spark, sf_dir, "orders").where("o_orderdate is not null").groupBy(t.stamp(F.trunc("o_orderdate", "month")).alias("bgn"))


@register(
    "windows_calendar",
    f"""with {_SPAN}, n as (select date_trunc('month', o_orderdate) as m, count(*) as n from orders where o_orderdate is not null group by 1)
    select strftime(g.m, '%Y%m%d') || '0000' as bgn, strftime(least(last_day(g.m), hi), '%Y%m%d') || '2359' as end_at, g.m + interval 1 month <= hi as resumable, coalesce(n.n, 0) as n_orders from g left join n on n.m = g.m""",
)
def windows_calendar(spark, sf_dir):
    """The windows that cover all orders, and how many each holds."""
    held = _orders_by_window(spark, sf_dir).agg(F.count("*").alias("n_orders"))
    return _planned(spark, sf_dir).withColumnRenamed("end", "end_at").join(held, "bgn", "left").fillna(0, ["n_orders"])


@register("months_missing", "select strftime(m, '%Y-%m') as ym from generate_series(timestamp '1990-01-01', timestamp '2000-06-01', interval 1 month) g(m) where m not in (select date_trunc('month', o_orderdate) from orders)")
def months_missing(spark, sf_dir):
    done = read(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("ym")).distinct()
    return windows.pending(windows.months(spark, "1990-01", "2000-06-15"), done, ["ym"]).select("ym")


@register(
    "windows_pending",
    f"""with {_SPAN}, done as (select date_trunc('month', o_orderdate) as m from orders where o_orderdate is not null group by 1 having count(*) filter (where o_orderstatus = 'P') * 3 <= count(*))
    select strftime(g.m, '%Y%m%d') || '0000' as bgn, 'op|00|' || strftime(g.m, '%Y%m%d') || '0000' as key from g where g.m not in (select m from done) or g.m + interval 1 month > hi""",
)
def windows_pending(spark, sf_dir):
    """A window is done if at most a third of its orders is in progress, but the month that isn't over is always fetched again."""
    done = _orders_by_window(spark, sf_dir).agg(F.count(F.when(F.col("o_orderstatus") == "P", 1)).alias("open"), F.count("*").alias("n")).where("open * 3 <= n").select("bgn")
    return windows.pending(_planned(spark, sf_dir), done, ["bgn"]).select("bgn", windows.window_key(F.lit("op"), F.lit("00"), F.col("bgn")).alias("key"))


# --------------------------------------------------------------------- discovery

_WORDS = "list_distinct(list_filter(regexp_split_to_array(regexp_replace(text, '[\\[\\]()「」『』·,~〈〉<>‘’''\"“”/|:;!?&#*+=_%]', ' ', 'g'), '\\s+'), lambda w: length(w) >= 2 and not regexp_full_match(w, '[0-9.]+') and not regexp_full_match(w, '[0-9]{1,4}')))"
_DOC_RULES = Rules(groups={"a": ("tion",), "b": ("ung", "lich")}, exclude=("zu",))
_DOC_CLASSES = f"""
with d as (select doc_id, text, {_WORDS} as ws, contains(text, 'zu') as bad, contains(text, 'tion') as a, contains(text, 'ung') or contains(text, 'lich') as b from documents),
pool as (select * from d where not bad),
n as (select greatest(3, cast(floor(count(*) / 2000 + 0.5) as bigint)) as least from pool),
fp as (select token, count(*) as pool from (select unnest(ws) as token from pool) group by token)
"""
_NO_KEYWORD = "not (contains(token, 'tion') or contains('tion', token) or contains(token, 'ung') or contains('ung', token) or contains(token, 'lich') or contains('lich', token))"


def _doc_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.classify(read(spark, sf_dir, "documents").select("doc_id", "text"), F.col("text"), F.col("text"), _DOC_RULES)


@register("token_df", f"select token, count(*) as n from (select unnest({_WORDS}) as token from documents) group by token having count(*) >= 5")
def token_df(spark, sf_dir):
    return discovery.document_frequency(read(spark, sf_dir, "documents"), discovery.tokens(F.col("text"))).where("n >= 5")


@register("token_korean", "select token, count(*) as n from (select unnest(case when p_partkey % 2 = 0 then ['청년창업지원', '청년창업', p_mfgr_first, '교육서비스', '교육'] else ['홍보관리', '홍보', p_mfgr_first] end) as token from (select p_partkey, string_split(p_type, ' ')[1] as p_mfgr_first from part)) where length(token) >= 2 group by token")
def token_korean(spark, sf_dir):
    """Titles with stop words, years, ordinals, numbers, punctuation and endings."""
    even = F.concat(F.lit("[공고] 2024년 「청년창업지원」 사업 "), F.split("p_type", " ")[0], F.lit(" 교육서비스 운영(12) 3.5"))
    odd = F.concat(F.lit("제2차 홍보관리 용역, "), F.split("p_type", " ")[0], F.lit(" 및 긴급·재공고 1999 내"))
    titles = read(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 2 == 0, even).otherwise(odd).alias("title"))
    return discovery.document_frequency(titles, discovery.tokens(F.col("title")))


@register("token_examples", "select token, n, (select arg_min(p_name, p_partkey) from part where contains(p_name, token)) as example, substr((select arg_min(p_name, p_partkey) from part where contains(p_name, token)), 1, 6) as short from (select unnest(list_distinct(string_split_regex(p_name, '\\s+'))) as token, count(*) as n from part group by 1 order by n desc, token limit 10)")
def token_examples(spark, sf_dir):
    """The most frequent words, each with the first title that holds it, whole and cut."""
    parts = read(spark, sf_dir, "part")
    top = discovery.document_frequency(parts, F.array_distinct(F.split("p_name", r"\s+"))).orderBy(F.desc("n"), "token").limit(10)
    found = discovery.examples(top, parts, "p_name", "p_partkey")
    return found.select("token", "n", "example", discovery.cut(F.col("example"), 6).alias("short"))


@register(
    "token_lift",
    _DOC_CLASSES
    + f""", s as (select 'a' as grp, ws from pool where a union all select 'b', ws from pool where b),
    fs as (select grp, token, count(*) as n from (select grp, unnest(ws) as token from s) group by grp, token),
    c as (select grp, fs.token as token, n, pool, n / pool as lift from fs join fp on fs.token = fp.token cross join n as m where n >= least)
    select grp, token, n, pool, round(lift, 6) as lift, row_number() over (partition by grp order by round(lift * ln(1 + n), 9) desc, token) as rank
    from c where lift >= 0.4 and {_NO_KEYWORD} qualify rank <= 12""",
)
def token_lift(spark, sf_dir):
    found = discovery.lift(_doc_classes(spark, sf_dir), "text", F.col("text"), _DOC_RULES)
    return found.withColumns({"lift": F.round("lift", 6), "rank": F.col("rank").cast("long")})


@register(
    "token_missed",
    _DOC_CLASSES
    + f""", fs as (select token, count(*) as n from (select unnest(ws) as token from pool where not a and not b) group by token)
    select fs.token as token, n, round(n / pool, 6) as lift from fs join fp on fs.token = fp.token cross join n as m
    where n >= 2 * least and n / pool >= 0.7 and {_NO_KEYWORD.replace("token", "fs.token")} order by n desc, fs.token limit 20""",
)
def token_missed(spark, sf_dir):
    return discovery.missed(_doc_classes(spark, sf_dir), "text", _DOC_RULES).withColumn("lift", F.round("lift", 6))


@register(
    "code_candidates",
    f"""with k as (select *, {_EXCLUDED} as ex, {_GROUPS} as gs from part),
    g as (select p_brand as code, arg_min(p_type, p_partkey) as name, count(*) filter (where len(ex) = 0 and len(gs) > 0) as ours, count(*) filter (where len(ex) = 0 and len(gs) = 0) as gain,
        arg_min(p_name, p_partkey) filter (where len(ex) = 0 and len(gs) = 0) as sample from k group by p_brand)
    select code, name, ours, gain, sample, cast(floor(ours / (ours + gain) * 100 + 0.5) as bigint) as hit_rate from g where ours + gain >= 5 and gain >= 3 and ours / (ours + gain) >= 0.5 order by gain desc, code limit 15""",
)
def code_candidates(spark, sf_dir):
    found = discovery.classify(read(spark, sf_dir, "part"), F.col("p_name"), _hay(), RULES)
    return discovery.code_candidates(found, "p_brand", "p_type", "p_name", "p_partkey")


@register("sample_systematic", "select c_custkey from (select c_custkey, row_number() over (order by c_custkey) - 1 as i, count(*) over () as n from customer) where i in (select floor(k * n / 14) from range(14) r(k)) or n <= 14")
def sample_systematic(spark, sf_dir):
    return discovery.systematic_sample(read(spark, sf_dir, "customer").select("c_custkey"), 14, "c_custkey")


# ------------------------------------------------------------ order, views, sets


@register("topk_words", "select word, n, row_number() over (order by n desc, word) as rank from (select p_name as word, count(*) as n from part group by p_name) qualify rank <= 20")
def topk_words(spark, sf_dir):
    top = read(spark, sf_dir, "part").groupBy(F.col("p_name").alias("word")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(20)
    rank = F.row_number().over(discovery.Window.orderBy(F.desc("n"), "word"))  # over 20 rows
    return top.withColumn("rank", rank.cast("long"))


def _board(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.date_format("ts", "yyyy-MM-dd")
    due = F.when(F.col("event_id") % 3 != 0, F.date_format(F.date_add("ts", 10), "yyyy-MM-dd")).otherwise("")
    raw = read(spark, sf_dir, "events").select(F.concat_ws(" &amp; ", "event_type", F.col("user_id").cast("string")).alias("title"), F.when(F.col("event_id") % 2 == 0, "").otherwise(F.col("event_type")).alias("dept"), ts.alias("date"), due.alias("deadline"), F.col("event_id").cast("string").alias("url"), "event_type")
    return views.union_sources([views.unify(raw.where("event_type = 'view'"), "seoul", "서울시"), views.unify(raw.where("event_type = 'click'"), "ydp"), views.unify(raw.where("coalesce(event_type, '') not in ('view', 'click')").withColumn("period", F.concat(F.lit("x ~ "), "date")).withColumn("region", F.lit("부산")), "biz")])


_BOARD = """with b as (
    select case event_type when 'view' then 'seoul' when 'click' then 'ydp' else 'biz' end as src, concat_ws(' & ', event_type, user_id) as title,
        case when coalesce(event_type, '') not in ('view', 'click') then '부산' || case when event_id % 2 = 0 then '' else concat(' · ', event_type) end when event_id % 2 = 1 then event_type when event_type = 'view' then '서울시' else '' end as org,
        strftime(ts, '%Y-%m-%d') as date, case when coalesce(event_type, '') not in ('view', 'click') then strftime(ts, '%Y-%m-%d') when event_id % 3 <> 0 then strftime(cast(ts as date) + 10, '%Y-%m-%d') end as deadline, cast(event_id as varchar) as url
    from events)
"""


@register("union_sources", _BOARD + "select * from b")
def union_sources(spark, sf_dir):
    return _board(spark, sf_dir)


@register("dash_stats", _BOARD + f"select src, count(*) as total, count(*) filter (where date '{EVENTS_AS_OF}' - cast(date as date) <= 7) as fresh, count(*) filter (where cast(deadline as date) - date '{EVENTS_AS_OF}' between 0 and 7) as due from b group by rollup (src)")
def dash_stats(spark, sf_dir):
    return views.stats(_board(spark, sf_dir), EVENTS_AS_OF)


@register(
    "new_due_flags",
    _BOARD
    + f"""select url, date '{EVENTS_AS_OF}' - cast(date as date) <= 7 as is_new, substr(replace(date, '-', '.'), 6) as date_short,
    case when deadline is null or cast(deadline as date) < date '{EVENTS_AS_OF}' then '' when cast(deadline as date) = date '{EVENTS_AS_OF}' then 'D-DAY' else 'D-' || (cast(deadline as date) - date '{EVENTS_AS_OF}') end as dday from b""",
)
def new_due_flags(spark, sf_dir):
    return views.badges(_board(spark, sf_dir), EVENTS_AS_OF).select("url", "is_new", "date_short", "dday")


@register("visible_items", _BOARD + f"select url from b where src = 'ydp' and date '{EVENTS_AS_OF}' - cast(date as date) <= 7 and cast(deadline as date) - date '{EVENTS_AS_OF}' between 0 and 7 and regexp_matches(title, 'click|교육') and contains(lower(title), 'k & 1')")
def visible_items(spark, sf_dir):
    return views.visible(_board(spark, sf_dir), EVENTS_AS_OF, "ydp", True, True, "click|교육", " K & 1 ").select("url")


@register("sort_blank_last", _BOARD + "select url, row_number() over (order by deadline desc nulls last, date desc, url) as rank from b")
def sort_blank_last(spark, sf_dir):
    found = ordering.numbered(_board(spark, sf_dir), *views.sort_order("deadline", True))
    return found.select("url", (F.col("index") + 1).cast("long").alias("rank"))


@register("order_numeric_id", "select o_orderkey, row_number() over (order by o_orderkey desc) as rank from orders")
def order_numeric_id(spark, sf_dir):
    """Ids kept as text, ordered as numbers."""
    ids = read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"))
    found = ordering.numbered(ids, F.col("id").cast("long").desc())
    return found.select(F.col("id").cast("long").alias("o_orderkey"), (F.col("index") + 1).cast("long").alias("rank"))


@register("last_seen_kst", "select strftime(max(ts) + interval 9 hour, '%Y-%m-%d %H:%M') as last_seen from events")
def last_seen_kst(spark, sf_dir):
    return views.last_seen(read(spark, sf_dir, "events"), "ts")


@register("region_histogram", "select case when n_nationkey % 5 = 0 then '미상' else n_name end as region, count(*) as n from customer join nation on c_nationkey = n_nationkey group by 1")
def region_histogram(spark, sf_dir):
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.when(F.col("n_nationkey") % 5 == 0, "").otherwise(F.col("n_name")).alias("region"))
    return views.region_histogram(read(spark, sf_dir, "customer").join(nation, "c_nationkey"), "region")


@register("region_min_window", "select min(strftime(o_orderdate, '%Y%m%d') || '0000') as reached from orders")
def region_min_window(spark, sf_dir):
    return read(spark, sf_dir, "orders").agg(F.min(t.stamp(F.col("o_orderdate"))).alias("reached"))


# ------------------------------------------------------------------ HTML and JSON

_TIDY = "trim(regexp_replace(replace(replace({}, '&amp;', '&'), '&nbsp;', ' '), '\\s+', ' ', 'g'))"


@register("strip_tags_a", "select page_id, md5(" + _TIDY.format("regexp_replace(html, '<[^>]+>', ' ', 'g')") + ") as plain from pages")
def strip_tags_a(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.md5(t.strip_tags_spaced(F.col("html"))).alias("plain"))


@register("strip_tags_b", "select page_id, md5(" + _TIDY.format("regexp_replace(regexp_replace(html, '(?i)<br\\s*/?>', ' ', 'g'), '<[^>]+>', '', 'g')") + ") as plain from pages")
def strip_tags_b(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.md5(t.strip_tags_joined(F.col("html"))).alias("plain"))


@register("html_links", "select page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]+)\"', 1)) as href from pages")
def html_links(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]+)"'), F.lit(1))).alias("href"))


def _list_page(c: Column) -> Column:
    row = F.concat(F.lit('<tr>\n<td>1</td><td class="s"><a href="?nttNo='), c.cast("string"), F.lit('&key=1"><b>모집 &amp; A&nbsp;</b> <span class="n"> NEW </span></a></td><td> dept <br/></td><td><time datetime="2026-08-07">8.7</time></td></tr><tr><td>short</td></tr>'))
    return F.concat(F.lit('<table><tbody class="text_center">'), row, F.lit("<tr><td>x</td><td>no id</td><td>d</td><td>2026-08-07</td></tr></tbody></table>"))


@register("html_rows", "select s_suppkey, cast(s_suppkey as varchar) as no, '모집 & A' as title, 'dept' as dept, '2026-08-07' as date, 'https://example.org/view?id=' || s_suppkey as url from supplier")
def html_rows(spark, sf_dir):
    pages = read(spark, sf_dir, "supplier").select("s_suppkey", _list_page(F.col("s_suppkey")).alias("html"))
    return boards.list_board(pages, "html", "https://example.org/view?id=").select("s_suppkey", F.col("nttNo").alias("no"), "title", "dept", "date", "url")


@register(
    "html_cards",
    "select 'https://example.org/n/' || s_suppkey as url, '모집 ' || s_suppkey || ' & A' as title, '2026-08-07' as date, case when s_suppkey % 2 = 0 then '행정' else '' end as category, case when s_suppkey % 2 = 0 then '접수 ~ 8. 20.' else '' end as summary, case when s_suppkey % 2 = 0 then '2026-08-20' end as deadline from supplier",
)
def html_cards(spark, sf_dir):
    k, even = F.col("s_suppkey").cast("string"), F.col("s_suppkey") % 2 == 0
    more = F.when(even, '<i class="p_work">[행정]</i><span class="ais-cont">접수\n ~ 8. 20.</span>').otherwise("")
    card = F.concat(F.lit('<div class="item"><a href="https://example.org/n/'), k, F.lit('">x</a><em class="subject">모집<br/>'), k, F.lit(' &amp; <b>A</b></em><em class="date"> 2026-08-07</em>'), more, F.lit("</div>"))
    html = F.concat(F.lit("<div>head"), card, F.lit('<div class="item"><em class="subject">no link</em><em class="date">2026-08-07</em></div>'))
    return boards.card_board(read(spark, sf_dir, "supplier").select(html.alias("html")), "html")


@register(
    "html_portal",
    "select cast(s_suppkey as varchar) as id, '제목 ' || s_suppkey as title, '부산' as org, '2026-08-01' as date, '신청 8월 ' || (1 + s_suppkey % 20) || '일까지' as summary, strftime(date '2026-08-01' + cast(s_suppkey % 20 as int), '%Y-%m-%d') as deadline, "
    "case when s_suppkey % 3 = 0 then 'https://example.org/portal/locgovNews/' || s_suppkey when s_suppkey % 3 = 1 then 'https://city.example/a?b=1&c=2' else 'https://example.org/b' end as url from supplier",
)
def html_portal(spark, sf_dir):
    k, kind = F.col("s_suppkey").cast("string"), F.col("s_suppkey") % 3
    link = F.when(kind == 1, '<a href="//city.example/a?b=1&amp;c=2" target="x"> 원문보기</a>').when(kind == 2, '<a href="/b">원문보기</a>').otherwise("")
    one = F.concat(F.lit('<dt class="pcb"><a href="/portal/locgovNews/'), k, F.lit('?x=1" class="t">제목 <b>'), k, F.lit('</b></a></dt><dd class="cont">신청 8월 '), (1 + F.col("s_suppkey") % 20).cast("string"), F.lit('일까지</dd><div class="sorting-area"> <span>부산</span></div> 등록일 2026.08.01 '), link)
    html = F.concat(F.lit("<dl>"), one, F.lit('<dt class="pcb"><a href="/other">no id</a></dt></dl>'))
    return boards.portal_board(read(spark, sf_dir, "supplier").select(html.alias("html")), "html", "https://example.org")


@register("html_events", "select 'EVEN_' || s_suppkey as event_id, '행사 ' || s_suppkey as title, '부산' as region, '2026-08-01 ~ 2026-08-31' as period, 'org' as org, '2026-08-01' as date, 'https://example.org/e/EVEN_' || s_suppkey as url from supplier")
def html_events(spark, sf_dir):
    k = F.col("s_suppkey").cast("string")
    row = F.concat(F.lit('<tr><td>1</td><td>부산</td><td><a href="?eventInfoId=EVEN_'), k, F.lit('">행사 '), k, F.lit('</a></td><td><span class="day">2026-08-01 ~\n 2026-08-31</span></td><td>org</td><td>2026-08-01</td></tr>'))
    html = F.concat(F.lit("<table><tbody>"), row, F.lit("<tr><td>short</td></tr><tr><td>1</td><td>a</td><td>no id</td><td>b</td><td>c</td><td>d</td></tr></tbody></table>"))
    return boards.event_board(read(spark, sf_dir, "supplier").select(html.alias("html")), "html", "https://example.org/e/").withColumnRenamed("eventId", "event_id")


@register(
    "json_failures",
    "select event_id, case event_id % 6 when 0 then null when 1 then 'daily_quota' when 2 then 'range' when 3 then 'other' when 4 then 'other' else case when event_id % 12 = 5 then 'daily_quota' else 'rate' end end as failure from events",
)
def json_failures(spark, sf_dir):
    """What a failed response means; HTTP 429 is the day's quota on a run's first call only."""
    kind = (F.col("event_id") % 6).cast("int")
    bodies = ('{"response": {"header": {"resultCode": "00"}}}', '{"OpenAPI_ServiceResponse": {"cmmMsgHeader": {"errMsg": "SERVICE ERROR", "returnAuthMsg": "LIMITED_NUMBER_OF_SERVICE_REQUESTS_EXCEEDS_ERROR"}}}', '{"nkoneps.com.response.ResponseError": {"header": {"resultCode": "07"}}}', '{"response": {"header": {"resultCode": "99"}}}', "<html>")
    parsed = envelope.status(F.coalesce(F.get(F.array(*map(F.lit, bodies)), kind), F.lit("")))
    limited = F.struct(F.lit("http").alias("kind"), F.lit("429").alias("code"), F.lit("").alias("message"))
    found = read(spark, sf_dir, "events").select("event_id", F.when(kind == 5, limited).otherwise(parsed).alias("status"))
    return found.select("event_id", envelope.failure_class("status", F.col("event_id") % 12 == 5).alias("failure"))


@register("entities", "select s_suppkey, '<b>\"' || chr(44032 + cast(s_suppkey as int)) || 'A&lt;' as decoded from supplier")
def entities(spark, sf_dir):
    coded = F.concat(F.lit("&lt;b&gt;&#034;&#"), (F.col("s_suppkey") + 44032).cast("string"), F.lit(";&#x41;&amp;lt;"))
    return read(spark, sf_dir, "supplier").select("s_suppkey", t.decode_entities(coded).alias("decoded"))


@register("selector_report", "select s as selector, count(*) filter (where n > 0) as pages, cast(sum(n) as bigint) as matches from (select s, len(regexp_extract_all(html, rx)) as n from pages cross join (values ('paragraph', '<p>'), ('link', '<a '), ('table', '<table')) v(s, rx)) group by s")
def selector_report(spark, sf_dir):
    return boards.selector_report(read(spark, sf_dir, "pages"), "html", {"paragraph": "<p>", "link": "<a ", "table": "<table"})


@register("json_props", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_props(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


@register("json_polymorphic_items", "select event_id, 'ok' as kind, case when event_id % 4 = 3 then 0 else 1 end as n, case when event_id % 4 <> 3 then cast(event_id as varchar) end as no, event_id % 100 as total from events where event_id % 5 <> 0 union all select event_id, case event_id % 4 when 0 then 'gateway' when 1 then 'backend' when 2 then 'api' else 'not_json' end, 0, null, 0 from events where event_id % 5 = 0")
def json_polymorphic_items(spark, sf_dir):
    record = F.concat(F.lit('{"no": "'), F.col("event_id").cast("string"), F.lit('"}'))
    kind = (F.col("event_id") % 4).cast("int")
    shape = F.get(F.array(F.concat(F.lit("["), record, F.lit("]")), F.concat(F.lit('{"item": ['), record, F.lit("]}")), F.concat(F.lit('{"item": '), record, F.lit("}")), F.lit('""')), kind)
    good = F.concat(F.lit('{"response": {"header": {"resultCode": "00"}, "body": {"items": '), shape, F.lit(', "totalCount": '), (F.col("event_id") % 100).cast("string"), F.lit("}}}"))
    bad = F.get(F.array(*map(F.lit, ('{"OpenAPI_ServiceResponse": {"cmmMsgHeader": {"errMsg": "SERVICE ERROR"}}}', '{"nkoneps.com.response.ResponseError": {"header": {"resultCode": "07", "resultMsg": "x"}}}', '{"response": {"header": {"resultCode": "99"}}}', "<xml/>"))), kind)
    pages = read(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 5 == 0, bad).otherwise(good).alias("body"))
    found = envelope.parse_pages(pages, "body", "struct<no: string>")
    return found.select("event_id", F.col("status.kind").alias("kind"), F.size("items").alias("n"), F.get("items", 0)["no"].alias("no"), F.col("total_count").alias("total"))


# ------------------------------------------------- streaming and extensions


@register("stream_upsert_available_now", f"select user_id, event_type, event_id, value, '{_NOW}' as first_seen from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1")
def stream_upsert_available_now(spark, sf_dir):
    from gazette.streaming.upserts import UpsertSink, parquet_stream, run_available

    path = os.path.join(sf_dir, "events.parquet")
    stream = parquet_stream(spark, path).select("user_id", "event_type", "event_id", "value", "ts")
    at = scratch(spark)
    found = run_available(stream, UpsertSink(spark, f"{at}/table", ["user_id", "event_type"], ["ts", "event_id"], _NOW), f"{at}/checkpoint")
    return found.select("user_id", "event_type", "event_id", "value", F.col("first_seen").cast("string").alias("first_seen"))


@register("stream_dedup_keys", "select distinct user_id, event_type from events")
def stream_dedup_keys(spark, sf_dir):
    """The first event of each key within the watermark; which one that is depends on arrival, so keys are shown."""
    from gazette.streaming.upserts import dedup_stream, parquet_stream

    at = scratch(spark)
    stream = parquet_stream(spark, os.path.join(sf_dir, "events.parquet")).select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    query = dedup_stream(stream, ["user_id", "event_type"], "ts", "3650 days").writeStream.option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start(f"{at}/found", format="parquet")
    query.awaitTermination()
    return spark.read.parquet(f"{at}/found").select("user_id", "event_type")


@register("ext_competition", "select case when l_extendedprice < 10000 then 'low' when l_extendedprice < 50000 then 'middle' else 'high' end as band, count(*) as n, round(avg(l_quantity), 6) as mean, median(l_quantity) as median, count(*) filter (where l_quantity = 1) as single, count(*) filter (where l_quantity >= 10) as ten from lineitem group by 1")
def ext_competition(spark, sf_dir):
    """Extension: bidders by amount band."""
    price, bidders = F.col("l_extendedprice"), F.col("l_quantity")
    band = F.when(price < 10000, "low").when(price < 50000, "middle").otherwise("high")
    return read(spark, sf_dir, "lineitem").groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.round(F.avg(bidders), 6).alias("mean"), F.median(bidders).alias("median"), F.count_if(bidders == 1).alias("single"), F.count_if(bidders >= 10).alias("ten"))


@register("ext_seasonality", "select month(o_orderdate) as month, count(*) as n, round(sum(o_totalprice), 2) as amount from orders group by 1")
def ext_seasonality(spark, sf_dir):
    """Extension: notices by month."""
    # Sums of cents are exact in any order.
    cents = F.sum(F.round(F.col("o_totalprice") * 100).cast("decimal(20,0)"))
    return read(spark, sf_dir, "orders").groupBy(F.month("o_orderdate").cast("long").alias("month")).agg(F.count("*").alias("n"), F.round(cents.cast("double") / 100, 2).alias("amount"))


@register("ext_last_year", "select a.o_orderkey, min(b.o_orderkey) as last_year from orders a join orders b on a.o_custkey = b.o_custkey and a.o_orderpriority = b.o_orderpriority and year(a.o_orderdate) = year(b.o_orderdate) + 1 and abs(a.o_totalprice - b.o_totalprice) <= 0.2 * a.o_totalprice group by a.o_orderkey")
def ext_last_year(spark, sf_dir):
    """Extension: last year's notice of the same organization and kind within a fifth of the amount."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice", F.year("o_orderdate").alias("y"))
    before = o.select("o_custkey", "o_orderpriority", (F.col("y") + 1).alias("y"), F.col("o_orderkey").alias("b"), F.col("o_totalprice").alias("p"))
    near = o.join(before, ["o_custkey", "o_orderpriority", "y"]).where(F.abs(F.col("o_totalprice") - F.col("p")) <= 0.2 * F.col("o_totalprice"))
    return near.groupBy("o_orderkey").agg(F.min("b").alias("last_year"))


from gazette.plans import relations, streams  # noqa: E402, F401 - register their queries here
