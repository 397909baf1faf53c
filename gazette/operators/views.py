"""What readers see: gold notices, one table over all sources, its filters, order and figures."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.functions import text as t
from gazette.functions.rules import Rules, contains_any, excluded_by, match_groups
from gazette.operators.retention import _young

# Days for NEW and due soon, and the words of education notices and excluded notices.
NEW_DAYS = DUE_SOON_DAYS = 7
MAX_AGE_DAYS = 30
COMMON_EXCLUDE = ("통장", "평가위원", "심사위원", "위원회 위원", "수행기관", "안전점검", "회계감사인", "수의계약", "입찰", "민간위탁")
SOURCE_EXCLUDE = {"govkr": ("결과", "지정", "기업", "기관", "장애인", "어린이집", "수행", "어르신", "플러스센터", "담배", "장학생", "보조사업자", "주민", "여성", "계량기", "반려동물")}


def source_excluded(title: Column, source: str, common: tuple[str, ...] = COMMON_EXCLUDE, by_source: dict[str, tuple[str, ...]] | None = None) -> Column:
    """Whether a title has an excluded word; a null title has none."""
    return contains_any(title, common + (SOURCE_EXCLUDE if by_source is None else by_source).get(source, ()))


def filter_excluded(df: DataFrame, source: str, title: str = "title") -> DataFrame:
    return df.where(~source_excluded(F.col(title), source))


def gold(df: DataFrame, rules: Rules, as_of: str, converted: str | None = None, max_age: int = MAX_AGE_DAYS) -> DataFrame:
    """Notices that no rule excludes and a group matches, not past their deadline (or not too old), newest first.

    ``converted``: an array column of the notices that a row has become; such rows go.
    """
    category = lambda c: F.col(c) if c in df.columns else F.lit("")
    text = t.haystack(F.col("title"), category("category"), category("categoryMid"), category("categoryLarge"))
    code = category("categoryNo") if "categoryNo" in df.columns else None
    out = df.where(F.size(excluded_by(F.col("title"), rules)) == 0).withColumn("kw", match_groups(text, rules, code)).where(F.size("kw") > 0)
    if converted:
        out = out.where(F.coalesce(F.size(converted), F.lit(0)) <= 0)
    due = F.nullif(F.col("deadline"), F.lit(""))
    out = out.where(F.when(due.isNotNull(), _young(due, 0, as_of)).otherwise(_young(F.col("date"), max_age, as_of)))
    return out.orderBy(F.desc("date"), "bidNo")


def unify(df: DataFrame, source: str, label: str = "") -> DataFrame:
    """src, title, org, date, deadline, url of one source's notices. ``label``: the organization where none is given."""
    c = lambda name: F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")
    deadline = t.period_end(c("period")) if "period" in df.columns else F.nullif(c("deadline"), F.lit(""))
    org = t.decode_entities(t.first_given(c("org"), c("dept"), F.lit(label)))
    if "region" in df.columns:
        region = F.coalesce(c("region"), F.lit(""))
        org = F.when((region == "") | org.startswith(region), org).when(org == "", region).otherwise(F.concat_ws(" · ", region, org))
    return df.select(F.lit(source).alias("src"), t.decode_entities(c("title")).alias("title"), org.alias("org"), F.coalesce(c("date"), F.lit("")).alias("date"), deadline.alias("deadline"), c("url").alias("url"))


def union_sources(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def is_new(date: Column, as_of: str) -> Column:
    return F.coalesce(t.days_since(date, as_of) <= NEW_DAYS, F.lit(False))


def is_due_soon(deadline: Column, as_of: str) -> Column:
    return F.coalesce(t.days_until(deadline, as_of).between(0, DUE_SOON_DAYS), F.lit(False))


def visible(df: DataFrame, as_of: str, source: str | None = None, new_only: bool = False, due_only: bool = False, pattern: str | None = None, query: str = "") -> DataFrame:
    """The rows that the chosen filters leave; all of them reach the scan as one predicate."""
    out = df
    if source:
        out = out.where(F.col("src") == source)
    if new_only:
        out = out.where(is_new(F.col("date"), as_of))
    if due_only:
        out = out.where(is_due_soon(F.col("deadline"), as_of))
    if pattern:
        out = out.where(F.col("title").rlike(pattern))
    if query.strip():
        out = out.where(F.contains(F.lower("title"), F.lit(query.strip().lower())))
    return out


def sort_order(key: str, descending: bool, tie: str = "url") -> list[Column]:
    """Blanks come last both ways; equal values newest first."""
    value = F.nullif(F.col(key), F.lit(""))
    return [value.desc_nulls_last() if descending else value.asc_nulls_last(), F.desc("date"), F.col(tie)]


def badges(df: DataFrame, as_of: str) -> DataFrame:
    return df.withColumns({"is_new": is_new(F.col("date"), as_of), "dday": t.dday_label(F.col("deadline"), as_of), "date_short": t.short_date(F.col("date"))})


def stats(df: DataFrame, as_of: str) -> DataFrame:
    """src (null: all), total, fresh, due: one aggregation for the sources and their sum."""
    return df.rollup("src").agg(F.count("*").alias("total"), F.count_if(is_new(F.col("date"), as_of)).alias("fresh"), F.count_if(is_due_soon(F.col("deadline"), as_of)).alias("due"))


def last_seen(df: DataFrame, first_seen: str = "first_seen") -> DataFrame:
    """The newest first_seen, as Korean local time."""
    return df.agg(F.date_format(F.from_utc_timestamp(F.max(first_seen), "Asia/Seoul"), "yyyy-MM-dd HH:mm").alias("last_seen"))


def region_histogram(df: DataFrame, region: str) -> DataFrame:
    return df.groupBy(F.coalesce(F.nullif(F.col(region), F.lit("")), F.lit("미상")).alias("region")).agg(F.count("*").alias("n"))
