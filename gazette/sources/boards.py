"""Notice boards: HTML pages (a row each) to notices (a row each), by split, extract and explode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.functions import text as t
from gazette.functions.deadline import extract_deadline


def _first(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match; null without one."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def table_rows(html: Column, body: str) -> Column:
    """The cells of each row of the first table body that ``body`` opens: array<array<string>>."""
    inner = F.regexp_extract(html, f"(?s){body}(.*?)</tbody>", 1)
    rows = F.regexp_extract_all(inner, F.lit("(?s)<tr>(.*?)</tr>"), F.lit(1))
    return F.transform(rows, lambda r: F.regexp_extract_all(r, F.lit("(?s)<td[^>]*>(.*?)</td>"), F.lit(1)))


def _exploded(df: DataFrame, html: str, rows: Column) -> DataFrame:
    return df.select(*[c for c in df.columns if c != html], F.explode(rows).alias("_r"))


def list_board(df: DataFrame, html: str, detail_url: str) -> DataFrame:
    """Table board: id in a link, title, department, date. Rows with fewer than 4 cells or no id are left out."""
    rows = _exploded(df, html, table_rows(F.col(html), '<tbody class="text_center">')).where(F.size("_r") >= 4)
    cell = lambda i: F.get("_r", i)
    no = _first(cell(1), r"nttNo=(\d+)")
    title = t.strip_tags_spaced(t.drop_new_badge(cell(1)))
    date = F.coalesce(_first(cell(3), 'datetime="([^"]+)"'), t.strip_tags_spaced(cell(3)))
    keep = [c for c in df.columns if c != html]
    return rows.where(no.isNotNull()).select(*keep, no.alias("nttNo"), title.alias("title"), t.strip_tags_spaced(cell(2)).alias("dept"), date.alias("date"), extract_deadline(date, title).cast("string").alias("deadline"), F.concat(F.lit(detail_url), no).alias("url"))


def card_board(df: DataFrame, html: str) -> DataFrame:
    """Cards: link, subject and date needed; category and summary may be missing."""
    blocks = F.slice(F.split(F.col(html), '<div class="item">'), F.lit(2), F.greatest(F.lit(0), F.size(F.split(F.col(html), '<div class="item">')) - 1))
    rows = _exploded(df, html, blocks)
    r = F.col("_r")
    url, subject, date = _first(r, '<a href="(https://[^"]+)"'), _first(r, '(?s)<em class="subject">(.*?)</em>'), _first(r, f'<em class="date">{t.WS}*([\\d-]{{10}})')
    title, summary = t.strip_tags_joined(subject), t.strip_tags_joined(F.coalesce(_first(r, '(?s)<span class="ais-cont">(.*?)</span>'), F.lit("")))
    keep = [c for c in df.columns if c != html]
    return rows.where(url.isNotNull() & subject.isNotNull() & date.isNotNull()).select(
        *keep, url.alias("url"), title.alias("title"), date.alias("date"), F.coalesce(_first(r, r'<i class="p_work">\[([^\]]+)\]</i>'), F.lit("")).alias("category"), summary.alias("summary"), extract_deadline(date, summary, title).cast("string").alias("deadline")
    )


def portal_board(df: DataFrame, html: str, origin: str) -> DataFrame:
    """Search results of a portal: the link to the original is preferred to the portal's own."""
    blocks = F.slice(F.split(F.col(html), '<dt class="pcb">'), F.lit(2), F.greatest(F.lit(0), F.size(F.split(F.col(html), '<dt class="pcb">')) - 1))
    rows = _exploded(df, html, blocks)
    r = F.col("_r")
    link = r'(?s)<a href="[^"]*locgovNews/(\d+)[^"]*"[^>]*>(.*?)</a>'
    no, title = _first(r, link), t.strip_tags_joined(_first(r, link, 2))
    date = F.coalesce(t.dotted_to_dashed(_first(r, f"등록일{t.WS}*([\\d.]{{10}})")), F.lit(""))
    summary = t.strip_tags_joined(F.coalesce(_first(r, '(?s)<dd class="cont">(.*?)</dd>'), F.lit("")))
    org = t.strip_tags_joined(F.coalesce(_first(r, f'(?s)<div class="sorting-area">{t.WS}*<span>(.*?)</span>'), F.lit("")))
    original = _first(r, f'<a href="([^"]+)"[^>]*>{t.WS}*원문보기')
    plain = original
    for name, value in (("amp", "&"), ("quot", '"'), ("#39", "'")):
        plain = F.replace(plain, F.lit(f"&{name};"), F.lit(value))
    url = F.coalesce(t.absolute_url(plain, origin), F.concat(F.lit(f"{origin}/portal/locgovNews/"), no))
    keep = [c for c in df.columns if c != html]
    return rows.where(no.isNotNull()).select(*keep, no.alias("id"), title.alias("title"), org.alias("org"), date.alias("date"), summary.alias("summary"), extract_deadline(date, summary, title).cast("string").alias("deadline"), url.alias("url"))


def event_board(df: DataFrame, html: str, detail_url: str) -> DataFrame:
    """Table of events: region, title, period, organization, date; 6 cells and an event id needed."""
    rows = _exploded(df, html, table_rows(F.col(html), "<tbody>")).where(F.size("_r") >= 6)
    cell = lambda i: F.get("_r", i)
    no = _first(cell(2), r"eventInfoId=(EVEN_\d+)")
    plain = t.strip_tags_spaced
    period = plain(F.coalesce(_first(cell(3), '(?s)<span class="day">(.*?)</span>'), F.lit("")))
    keep = [c for c in df.columns if c != html]
    return rows.where(no.isNotNull()).select(*keep, no.alias("eventId"), plain(cell(2)).alias("title"), plain(cell(1)).alias("region"), period.alias("period"), plain(cell(4)).alias("org"), plain(cell(5)).alias("date"), F.concat(F.lit(detail_url), no).alias("url"))


def selector_report(df: DataFrame, html: str, selectors: dict[str, str]) -> DataFrame:
    """How many pages each selector matches, and how often in all: one pass over the pages."""
    hits = [F.struct(F.lit(k).alias("selector"), F.size(F.regexp_extract_all(F.col(html), F.lit(rx), F.lit(0))).alias("hits")) for k, rx in selectors.items()]
    return df.select(F.explode(F.array(*hits)).alias("x")).groupBy("x.selector").agg(F.count_if(F.col("x.hits") > 0).alias("pages"), F.sum("x.hits").alias("matches"))
