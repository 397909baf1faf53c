"""Raw API records to typed notices: one projection each, so unread fields never leave the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.functions import text as t


def _given(df: DataFrame):
    return lambda name: F.col(name) if name in df.columns else F.lit(None).cast("string")


def normalize_bid(df: DataFrame, kind: str = "용역", keep: Sequence[str] = ()) -> DataFrame:
    """32 fields of a tender notice, after the columns to keep; fields that the input lacks count as missing."""
    c = _given(df)
    opening = t.first_given(c("opengDt"), c("rbidOpengDt"))
    numbered = lambda stem: [c(f"{stem}{i}") for i in range(1, 11)]
    opened = t.date_part(opening)
    return df.select(
        *keep,
        F.lit("bid").alias("type"),
        t.notice_key(c("bidNtceNo"), c("bidNtceOrd")).alias("bidNo"),
        F.lit(kind).alias("kind"),
        t.text(c("bidNtceNm")).alias("title"),
        t.first_given(t.text(c("dminsttNm")), t.text(c("ntceInsttNm"))).alias("org"),
        t.text(c("ntceInsttNm")).alias("noticeOrg"),
        t.date_part(c("bidNtceDt")).alias("date"),
        t.date_part(c("bidClseDt")).alias("deadline"),
        t.time_part(c("bidClseDt")).alias("deadlineTime"),
        F.when(opened != "", t.text(F.concat_ws(" ", opened, t.time_part(opening)))).otherwise("").alias("opening"),
        t.date_part(c("bidQlfctRgstDt")).alias("qlfctDate"),
        t.time_part(c("bidQlfctRgstDt")).alias("qlfctTime"),
        *[t.number(c(a)).alias(b) for a, b in (("presmptPrce", "price"), ("asignBdgtAmt", "budget"))],
        *[t.text(c(a)).alias(b) for a, b in (("cntrctCnclsMthdNm", "method"), ("sucsfbidMthdNm", "winnerMethod"))],
        *[t.number(c(a)).alias(b) for a, b in (("techAbltEvlRt", "techRate"), ("bidPrceEvlRt", "priceRate"))],
        *[t.flag(c(a)).alias(b) for a, b in (("reNtceYn", "reNtce"), ("intrntnlBidYn", "intlBid"), ("arsltCmptYn", "arsltCmpt"), ("indstrytyLmtYn", "indstrytyLmt"), ("rgnLmtYn", "rgnLmt"))],
        t.joint_allowed(c("cmmnSpldmdMethdNm"), c("cmmnCntrctYn")).alias("jointOk"),
        t.text(c("cmmnSpldmdMethdNm")).alias("jointMethod"),
        t.flag(c("cmmnSpldmdCorpRgnLmtYn")).alias("jointRgnLmt"),
        *[t.text(c(f"pubPrcrmnt{a}")).alias(b) for a, b in (("ClsfcNo", "categoryNo"), ("ClsfcNm", "category"), ("MidClsfcNm", "categoryMid"), ("LrgClsfcNm", "categoryLarge"))],
        t.named_files(numbered("ntceSpecFileNm"), numbered("ntceSpecDocUrl")).alias("files"),
        t.first_given(t.text(c("bidNtceDtlUrl")), t.text(c("bidNtceUrl"))).alias("url"),
    )


def normalize_prespec(df: DataFrame, kind: str = "용역", keep: Sequence[str] = ()) -> DataFrame:
    """14 fields of a preliminary specification, after the columns to keep; a blank number is a null key."""
    c = _given(df)
    return df.select(
        *keep,
        F.lit("pre").alias("type"),
        F.nullif(t.text(c("bfSpecRgstNo")), F.lit("")).alias("bidNo"),
        t.first_given(t.text(c("bsnsDivNm")), F.lit(kind)).alias("kind"),
        t.text(c("prdctClsfcNoNm")).alias("title"),
        t.first_given(t.text(c("rlDminsttNm")), t.text(c("orderInsttNm"))).alias("org"),
        t.text(c("orderInsttNm")).alias("noticeOrg"),
        t.date_part(c("rcptDt")).alias("date"),
        t.date_part(c("opninRgstClseDt")).alias("deadline"),
        t.time_part(c("opninRgstClseDt")).alias("deadlineTime"),
        t.number(c("asignBdgtAmt")).alias("budget"),
        F.lit(None).cast("double").alias("price"),
        t.comma_list(c("bidNtceNoList")).alias("bidNtceNoList"),
        t.numbered_files([c(f"specDocFileUrl{i}") for i in range(1, 6)], "규격서").alias("files"),
        F.lit("").alias("url"),
    )


def valid(df: DataFrame, key: str = "bidNo", title: str = "title") -> DataFrame:
    return df.where((F.coalesce(F.col(key), F.lit("")) != "") & (F.coalesce(F.col(title), F.lit("")) != ""))


def non_blank(fields: Column) -> Column:
    """A map's entries that hold something."""
    return F.map_filter(fields, lambda _, v: t.text(v) != "")
