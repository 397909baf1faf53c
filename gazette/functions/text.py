"""Scalar functions on strings, dates and markup, as Columns. ``""`` and null both mean "missing"."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as browsers and scripts see it; Java's ``\s`` is ASCII only.
WS = r"[\s\u00a0\ufeff\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` over a value that is computed once; Catalyst would put its expression in each place."""
    return F.get(F.transform(F.array(value), then), 0)


def text(c: Column) -> Column:
    """Trimmed; null becomes ''."""
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), f"^{WS}+|{WS}+$", "")


def first_given(*columns: Column) -> Column:
    """The first that is neither null nor ''; '' if none is."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def number(c: Column) -> Column:
    """A number with thousands separators, or null."""
    return F.regexp_replace(text(c), ",", "").try_cast("double")


def date_part(c: Column) -> Column:
    return F.regexp_extract(text(c), r"^(\d{4}-\d{2}-\d{2})", 1)


def time_part(c: Column) -> Column:
    """HH:MM after a leading date, else ''."""
    return F.regexp_extract(text(c), r"^\d{4}-\d{2}-\d{2}[ T](\d{2}:\d{2})", 1)


def flag(c: Column) -> Column:
    """True for Y; never null."""
    return text(c) == "Y"


def joint_allowed(method: Column, yes_no: Column) -> Column:
    """Whether joint bids are allowed; null: unknown."""
    m = text(method)
    return F.when(m.contains("불허"), F.lit(False)).when(m.contains("이행") | m.contains("허용"), F.lit(True)).when(text(yes_no) == "Y", F.lit(True)).when(text(yes_no) == "N", F.lit(False))


def named_files(names: list[Column], urls: list[Column]) -> Column:
    """(name, url) of the numbered column pairs that have both."""
    pairs = F.array(*[F.struct(text(n).alias("name"), text(u).alias("url")) for n, u in zip(names, urls, strict=True)])
    return F.filter(pairs, lambda x: (x["name"] != "") & (x["url"] != ""))


def numbered_files(urls: list[Column], label: str) -> Column:
    """(name, url) with the column's number in the name."""
    pairs = F.array(*[F.struct(F.lit(f"{label} {i}").alias("name"), text(u).alias("url")) for i, u in enumerate(urls, 1)])
    return F.filter(pairs, lambda x: x["url"] != "")


def comma_list(c: Column) -> Column:
    return F.filter(F.transform(F.split(text(c), ","), text), lambda x: x != "")


def notice_key(no: Column, order: Column) -> Column:
    """``no-order``, order 000 by default; null if there is no number."""
    return F.when(text(no) != "", F.concat(text(no), F.lit("-"), first_given(text(order), F.lit("000"))))


def haystack(*columns: Column) -> Column:
    """All columns joined by a space; nulls keep their place."""
    return F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in columns])


# ---------------------------------------------------------------------- markup


def _tidy(c: Column) -> Column:
    return text(F.regexp_replace(F.replace(F.replace(c, F.lit("&amp;"), F.lit("&")), F.lit("&nbsp;"), F.lit(" ")), f"{WS}+", " "))


def strip_tags_spaced(c: Column) -> Column:
    """Every tag becomes a space."""
    return _tidy(F.regexp_replace(c, "<[^>]+>", " "))


def strip_tags_joined(c: Column) -> Column:
    """Line breaks become spaces, other tags vanish."""
    return _tidy(F.regexp_replace(F.regexp_replace(c, f"(?i)<br{WS}*/?>", " "), "<[^>]+>", ""))


def drop_new_badge(c: Column) -> Column:
    """Removes the first NEW badge."""
    return F.regexp_replace(c, f"(?is)^(.*?)<span[^>]*>{WS}*NEW{WS}*</span>", "$1")


def decode_entities(c: Column) -> Column:
    """Numeric and the common named references; &amp; last, so that nothing is decoded twice."""

    def numeric(s: Column, pattern: str, base: int) -> Column:
        # Pieces between references and the references' digits, put together again.
        pieces, digits = F.split(s, pattern), F.regexp_extract_all(s, F.lit(pattern), F.lit(1))
        point = lambda d: F.when(F.conv(d, base, 10).cast("decimal(20,0)") <= 0x10FFFF, F.conv(d, base, 10).cast("int"))
        # A code point is decoded from its four bytes; char() knows Latin-1 only.
        letter = lambda d: F.decode(F.unhex(F.lpad(F.hex(point(d)), 8, "0")), "UTF-32")
        return F.when(F.size(digits) == 0, s).otherwise(F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(letter(F.get(digits, i)), F.lit("")))), ""))

    out = numeric(numeric(F.coalesce(c, F.lit("")), r"&#(\d+);", 10), r"&#[xX]([0-9a-fA-F]+);", 16)
    for name, value in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("nbsp", " "), ("amp", "&")):
        out = F.replace(out, F.lit(f"&{name};"), F.lit(value))
    return out


def absolute_url(c: Column, origin: str) -> Column:
    return F.when(c.rlike("^https?://"), c).when(c.startswith("//"), F.concat(F.lit("https:"), c)).when(c.startswith("/"), F.concat(F.lit(origin), c)).otherwise(F.concat(F.lit(f"{origin}/"), c))


def query_string(pairs: dict[str, Column]) -> Column:
    """k=v pairs, percent-encoded; missing values are left out."""
    return F.concat_ws("&", *[F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(f"{k}="), F.replace(F.url_encode(v), F.lit("+"), F.lit("%20")))) for k, v in pairs.items()])


# ----------------------------------------------------------------------- dates


def day(c: Column) -> Column:
    """The date that an ISO string begins with; null if there is none."""
    return F.regexp_extract(F.coalesce(c.cast("string"), F.lit("")), r"^(\d{4}-\d{2}-\d{2})", 1).try_cast("date")


def days_since(c: Column, as_of: str) -> Column:
    return F.datediff(F.lit(as_of).cast("date"), day(c))


def days_until(c: Column, as_of: str) -> Column:
    return -days_since(c, as_of)


def short_date(c: Column) -> Column:
    return F.coalesce(F.date_format(day(c), "MM.dd"), F.lit(""))


def dotted_to_dashed(c: Column) -> Column:
    return F.translate(c, ".", "-")


def dotted(c: Column) -> Column:
    return F.date_format(c, "yyyy.MM.dd")


def stamp(c: Column, end_of_day: bool = False) -> Column:
    """yyyyMMdd0000, or 2359 at a window's end."""
    return F.concat(F.date_format(c, "yyyyMMdd"), F.lit("2359" if end_of_day else "0000"))


def stamp_minute(c: Column) -> Column:
    """yyyyMMddHHmm of a timestamp."""
    return F.date_format(c, "yyyyMMddHHmm")


def stamp_date(c: Column) -> Column:
    return F.to_date(F.substring(c, 1, 8), "yyyyMMdd")


def period_end(c: Column) -> Column:
    """The end of 'from ~ to'; null if there is none."""
    return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), f"~{WS}*(\\d{{4}}-\\d{{2}}-\\d{{2}})", 1), F.lit(""))


def dday_label(c: Column, as_of: str) -> Column:
    """D-n, D-DAY, or '' when past or unknown."""
    left = days_until(c, as_of)
    return F.when(left > 0, F.concat(F.lit("D-"), left.cast("string"))).when(left == 0, F.lit("D-DAY")).otherwise(F.lit(""))


def percent(part: Column, whole: Column) -> Column:
    """A share in percent, rounded half up."""
    return F.floor(part * 100 / whole + 0.5).cast("long")
