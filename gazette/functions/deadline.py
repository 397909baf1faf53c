"""Application deadlines from free Korean text, as one Column expression.

Every date candidate of five families is taken with the 24 characters before it. The context gives its
tier (an application word, a vague word, none; periods of something else drop it); the highest tier
wins, then the latest date. A year that isn't written is the one nearest to the post date.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazette.functions.text import WS, day, let

# The context words, the windows of days, and the weekdays in parentheses.
APPLY = "신청|접수|모집|공모|응모|원서|등록"
WEAK = "공고|판매|기간"
OTHER_PERIODS = "활동|운영|사업|근무|교육|계약|행사|공연|전시|사용|이용|임기|수행|공사|보관|지원"
WEEKDAYS = "월|화|수|목|금|토|일"
NEAREST_YEAR = (-60, 370)
PLAUSIBLE = (-60, 400)

#: Characters before a date that its context is read from.
CONTEXT = 24
_N, _S = "(\\d{1,2})", f"{WS}*"
# What sets matches and their groups apart in a text; letters of the text that look like these are changed.
_MARK, _GROUP, _OTHER = "\u0001", "\u0002", "\u0003"


@dataclass(frozen=True)
class Family:
    """A pattern, which of its groups are month, day and year (0: none), and what a text must hold for a match."""

    pattern: str
    month: int
    day: int
    year: int
    needs: tuple[str, ...]


# The five ways that a last day is written in.
FAMILIES = (
    Family(f"{_N}{_S}월{_S}{_N}{_S}일[^0-9월]{{0,8}}(?:부터|~|-)[^0-9]{{0,8}}{_N}{_S}월{_S}{_N}{_S}일", 3, 4, 0, ("월", "일")),
    Family(f"{_N}{_S}월{_S}{_N}{_S}(?:일{_S})?[~\\-]{_S}{_N}{_S}일", 1, 3, 0, ("월", "일")),
    Family(f"{_N}{_S}월{_S}{_N}{_S}일{_S}(?:까지|마감)", 1, 2, 0, ("월", "일")),
    Family(f"~{_S}(?:(\\d{{4}}){_S}\\.{_S})?{_N}{_S}\\.{_S}{_N}{_S}\\.", 2, 3, 1, ("~", ".")),
    Family(f"~{_S}{_N}{_S}/{_S}{_N}(?!\\d|{_S}/)", 1, 2, 0, ("~", "/")),
)
#: The shortest match has four characters, so that many pieces before one hold its context.
_PIECES = 2 * (CONTEXT // 4) + 1


def _date(year: Column, month: Column, of_month: Column) -> Column:
    """Null where the calendar has no such day."""
    in_year = F.make_date(year, F.least(F.greatest(month, F.lit(1)), F.lit(12)), F.lit(1))
    return let(in_year, lambda first: F.when(month.between(1, 12) & of_month.between(1, F.dayofmonth(F.last_day(first))), F.date_add(first, of_month - 1)))


def _nearest(post: Column, month: Column, of_month: Column) -> Column:
    """The date in the year before, of or after the post date that is nearest to it; the earlier one of equals."""

    def option(k: Column) -> Column:
        apart = lambda d: F.datediff(d, post)
        return let(_date(F.year(post) + k, month, of_month), lambda d: F.when(apart(d).between(*NEAREST_YEAR), F.struct(F.abs(apart(d)).alias("apart"), d.alias("date"))))

    return F.array_min(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), option))["date"]


def _tier(context: Column) -> Column:
    return F.when(context.rlike(APPLY), F.lit(2)).when(context.rlike(f"(?:{OTHER_PERIODS}){_S}기간"), F.lit(-1)).when(context.rlike(WEAK), F.lit(1)).otherwise(F.lit(0))


def _of_family(f: Family, plain: Column, post: Column) -> Column:
    """array<struct<tier, date>>: one pass marks all matches and their groups, the rest works on the pieces."""
    marks = _MARK + "$0" + "".join(f"{_GROUP}{f'${g}' if g else ''}" for g in (f.month, f.day, f.year)) + _MARK

    def read(pieces: Column) -> Column:
        def one(i: Column) -> Column:
            first = F.greatest(F.lit(0), i - _PIECES)
            before = F.transform(F.slice(pieces, first + 1, i - first), lambda x: F.substring_index(x, _GROUP, 1))
            number = lambda groups, g: F.get(groups, g).cast("int")

            def dated(groups: Column) -> Column:
                near = _nearest(post, number(groups, 1), number(groups, 2))
                date = F.when(F.get(groups, 3) != "", _date(F.get(groups, 3).try_cast("int"), number(groups, 1), number(groups, 2))).otherwise(near) if f.year else near
                return F.struct(let(F.right(F.array_join(before, ""), F.lit(CONTEXT)), _tier).alias("tier"), date.alias("date"))

            return let(F.split(F.get(pieces, i), _GROUP), dated)

        # Matches are the odd pieces.
        return F.when(F.size(pieces) > 1, F.transform(F.sequence(F.lit(1), F.size(pieces) - 1, F.lit(2)), one))

    able = functools.reduce(Column.__and__, [plain.contains(x) for x in f.needs])
    found = let(F.split(F.regexp_replace(plain, f.pattern, marks), _MARK), read)
    return F.coalesce(F.when(able, found), F.array().cast("array<struct<tier:int,date:date>>"))


def candidates(text: Column, post: Column) -> Column:
    """array<struct<tier, date>> of a text's plausible dates."""
    plain = F.regexp_replace(F.translate(text, _MARK + _GROUP, _OTHER * 2), f"\\({_S}(?:{WEEKDAYS}){_S}\\)", "")

    def scan(x: Column) -> Column:
        found = F.concat(*[_of_family(f, x["plain"], x["post"]) for f in FAMILIES])
        return F.filter(found, lambda c: (c["tier"] >= 0) & c["date"].isNotNull() & F.datediff(c["date"], x["post"]).between(*PLAUSIBLE))

    return let(F.struct(plain.alias("plain"), post.alias("post")), scan)


def extract_deadline(post_date: Column, *texts: Column) -> Column:
    """The deadline (date) in the first text that has a candidate; null if none has or the post date is none."""

    def first(post: Column) -> Column:
        return F.when(post.isNotNull(), F.coalesce(*[F.array_max(candidates(F.coalesce(t, F.lit("")), post))["date"] for t in texts]))

    return let(day(post_date), first)
