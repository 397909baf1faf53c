import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from gazette.functions import text as t
from gazette.functions.deadline import extract_deadline
from gazette.functions.rules import Rules, excluded_by, lint, match_groups, occurs, parse_rules, where_used
from gazette.sources.client import PAGE_ROWS, ApiError, PagedClient

#: Texts with one reading; None: no deadline.
READ = [
    ("2031-05-02", "참가 신청은 5월 6일부터 5월 19일까지 받습니다", "2031-05-19"),
    ("2031-05-02", "원서 접수는 5월 11 ~ 27일", "2031-05-27"),
    ("2031-05-02", "수강 등록 6월 4일(수)까지", "2031-06-04"),
    ("2031-05-02", "응모 2031. 5. 3.(토) ~ 2031. 6. 1.(일)", "2031-06-01"),
    ("2031-05-02", "[공모 5/3~6/2]", "2031-06-02"),
    ("2031-05-02", "조기 접수 ~ 5. 20. 일반 접수 ~ 6. 10.", "2031-06-10"),
    ("2030-12-30", "회원 모집 ~ 1. 9.", "2031-01-09"),
    ("2031-01-03", "지난 모집 ~ 12. 27.", "2030-12-27"),
    ("2031-05-02", "할인율 1.5~3.5% 적용", None),
    ("2031-05-02", "상담은 9~18시에 합니다", None),
    ("2031-05-02", "신청 ~ 6/1/7", None),
    ("2031-05-02", "공연 기간 2031. 7. 1. ~ 2031. 7. 30.", None),
    ("2031-05-02", "근무기간 2031. 7. ~ 2032. 6. 원서 ~ 5. 23.", "2031-05-23"),
    ("2031-05-02", "", None),
    ("2031-05-02", None, None),
    ("soon", "접수 5월 9일까지", None),
    (None, "접수 5월 9일까지", None),
    ("2032-01-20", "신청 ~ 2. 29.", "2032-02-29"),
    ("2031-01-20", "신청 ~ 2. 29.", None),
    ("2031-01-20", "신청 ~ 14. 2. 다음 ~ 2. 5.", "2031-02-05"),
    ("2031-01-20", "신청 \u0001~ 2. 6.\u0002 끝", "2031-02-06"),
    # The apply word is the first of the 24 characters before the date, or one too far.
    ("2031-05-02", "접수" + "가" * 22 + "~ 5. 9. " + "나" * 24 + "~ 5. 30.", "2031-05-09"),
    ("2031-05-02", "접수" + "가" * 23 + "~ 5. 9. " + "나" * 24 + "~ 5. 30.", "2031-05-30"),
    # Dates one after the other have the earlier ones in their context.
    ("2031-05-02", "접수 ~5.3.~5.4.~5.5.~5.6.", "2031-05-06"),
]
#: Words before a date, and what they make of it (None: it doesn't count).
SAID = [("신청 ", 2), ("접수기간: ", 2), ("모집 안내 ", 2), ("공고 ", 1), ("판매 ", 1), ("활동기간 ", None), ("근무 기간: ", None), ("일시 ", 0), ("", 0)]
APART = " 가나다라마바사아자차카타파하 거너더러머버서어저처커터퍼허 "


def written(rng, post, date):
    """A date in one of the ways; without its year only where that is the nearest one."""
    m, d = date.month, date.day
    ways = [f"~ {date.year}. {m}. {d}.", f"2030. 1. 1. ~ {date.year}.{m}.{d}. 18:00"]
    if -60 <= (date - post).days <= 180:
        start = date - dt.timedelta(days=rng.randrange(1, 20))
        ways += [f"{start.month}월 {start.day}일부터 {m}월 {d}일까지", f"{m}월 {d}일 마감", f"~ {m}. {d}.", f"~{m}/{d}", f"{m}월 {max(1, d - 1)}~{d}일"]
    return rng.choice(ways)


def made_texts(n, seed=5):
    """(post, text, deadline) of texts put together from dates that are known."""
    rng = random.Random(seed)
    for _ in range(n):
        post = dt.date(2030, 1, 1) + dt.timedelta(days=rng.randrange(1200))
        text, found = APART, []
        for _ in range(rng.randrange(1, 5)):
            words, tier = rng.choice(SAID)
            ahead = rng.choice([rng.randrange(-60, 401), rng.randrange(0, 60), -60, -61, 400, 401, rng.randrange(402, 700)])
            date = post + dt.timedelta(days=ahead)
            text += words + written(rng, post, date) + APART + rng.choice(["", "3.1~4.2% ", "10~12시 ", "제2회 "]) + APART
            if tier is not None and -60 <= ahead <= 400:
                found.append((tier, date))
        yield post.isoformat(), text, max(found)[1].isoformat() if found else None


def test_deadlines(spark):
    rows = READ + list(made_texts(2500))
    df = spark.createDataFrame([(i, p, x) for i, (p, x, _) in enumerate(rows)], "i int, p string, x string")
    got = {r.i: r.d for r in df.select("i", extract_deadline(F.col("p"), F.col("x")).cast("string").alias("d")).collect()}
    for i, (p, x, want) in enumerate(rows):
        assert got[i] == want, (p, x)
    second = spark.range(1).select(extract_deadline(F.lit("2031-05-02"), F.lit("아무것도 없음"), F.lit("접수 ~ 5. 9."), F.lit("접수 ~ 5. 30.")).cast("string").alias("d")).first()
    assert second.d == "2031-05-09"


def slow_occurs(text, word, allow):
    spots = lambda w: [i for i in range(len(text)) if text.startswith(w, i)]
    return any(not any(j <= i and i + len(word) <= j + len(a) for a in allow for j in spots(a)) for i in spots(word))


def test_containment(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices("ab.c", k=rng.randrange(14))) for _ in range(800)]
    cases = [("ab", ("cab", "abc", "aba")), ("a", ("aa", "ba")), (".", ("a.", "..")), ("aba", ("ababa",)), ("c", ())]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    out = df.select("i", *[occurs(F.col("x"), w, a).alias(f"c{k}") for k, (w, a) in enumerate(cases)]).collect()
    for r in out:
        assert [r[f"c{k}"] for k in range(len(cases))] == [slow_occurs(texts[r.i], w, a) for w, a in cases]


CONFIG = """
# 수집 키워드
이 목록은 모두 적용됩니다
## 수출
무역
바이어
## 교육
연수
# 수집 예외
무역량
# 제외 키워드
공사
행사
# 제외 예외
진흥공사
# 제외 해제
수출 → 행사 전시회
박람회 -> 행사
# 조달분류코드
81112  설명
12 짧다
"""


def test_rules(spark):
    rules = parse_rules(CONFIG)
    assert rules == Rules({"수출": ("무역", "바이어"), "교육": ("연수",)}, ("공사", "행사"), ("진흥공사",), ("무역량",), (("수출", ("행사", "전시회")), ("박람회", ("행사",))), ("81112",))
    titles = ["대한무역투자진흥공사 해외 바이어 지원", "청사 리모델링 공사", "직무역량 연수", "수출 행사", "행사", None, "그냥"]
    df = spark.createDataFrame([(i, x, "81112" if i == 6 else "") for i, x in enumerate(titles)], "i int, x string, code string")
    hay = t.haystack(F.col("x"), F.lit(None).cast("string"))
    out = {r.i: (r.g, r.e) for r in df.select("i", match_groups(hay, rules, F.col("code")).alias("g"), excluded_by(F.col("x"), rules).alias("e")).collect()}
    assert out == {0: (["수출"], []), 1: ([], ["공사"]), 2: (["교육"], []), 3: ([], []), 4: ([], ["행사"]), 5: ([], []), 6: (["분류"], [])}
    assert where_used("행사", rules) == ["exclude", "release:수출", "release:박람회"]
    assert lint(Rules(exclude=("전시", "전시회", "전시"))) and rules.without("행사").exclude == ("공사",)


def test_scalars(spark):
    cases = [
        (t.text(F.lit("　\xa0 a b﻿")), "a b"),
        (t.number(F.lit("1,234.5 ")), 1234.5),
        (t.number(F.lit("")), None),
        (t.decode_entities(F.lit("&#034;&#x1F600;&amp;lt;&lt;&#xZ;")), '"😀&lt;<&#xZ;'),
        (t.decode_entities(F.lit(None).cast("string")), ""),
        (t.absolute_url(F.lit("//a/b"), "https://o"), "https://a/b"),
        (t.absolute_url(F.lit("/b"), "https://o"), "https://o/b"),
        (t.query_string({"a": F.lit("한 글"), "b": F.lit(""), "c": F.lit("1")}), "a=%ED%95%9C%20%EA%B8%80&c=1"),
        (t.period_end(F.lit("2026-01-01 ~ 2026-02-03")), "2026-02-03"),
        (t.dday_label(F.lit("2026-08-20"), "2026-08-18"), "D-2"),
        (t.dday_label(F.lit("x"), "2026-08-18"), ""),
        (t.drop_new_badge(F.lit("a<span class=x> new </span>b<span>NEW</span>")), "ab<span>NEW</span>"),
        (t.notice_key(F.lit(" "), F.lit("1")), None),
        (t.percent(F.lit(1), F.lit(8)), 13),
        (t.stamp_date(F.lit("202608182359")), dt.date(2026, 8, 18)),
    ]
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, (c, _) in enumerate(cases)]).first()
    assert list(row) == [x for _, x in cases]


def test_scan_says_when_pages_end_before_the_total():
    def pages(total):
        def fetch(params):
            n = max(0, min(PAGE_ROWS, total - (params["pageNo"] - 1) * PAGE_ROWS))
            return 200, json.dumps({"response": {"header": {"resultCode": "00"}, "body": {"totalCount": total, "items": [{"i": i} for i in range(n)]}}})

        return PagedClient(fetch, sleep=lambda _: None)

    assert len(list(pages(300).scan({}, max_pages=3))) == 300
    with pytest.raises(ApiError) as e:
        list(pages(301).scan({}, max_pages=3))
    assert e.value.kind == "truncated"
    with pytest.raises(ApiError):
        list(pages(20_001).scan({}))
