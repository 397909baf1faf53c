"""How rules do on a corpus, and words that could become rules."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette.functions.rules import Rules, excluded_by, match_groups
from gazette.functions.text import let
from gazette.operators.ordering import numbered

# Words that say nothing, endings that are stripped, and the patterns of what is no word.
STOP_WORDS = tuple(
    "용역 사업 운영 지원 위탁 선정 공고 입찰 제안 계약 협상 관련 위한 대상 대한 통한 기반 활용 연간 단가 재공고 긴급 제작 개발 조사 연구 평가 분석 계획 수립 실시 추진 업무 협상에 의한 의하 일반 제한 경쟁 전자 방식 분야 기타 지역 전국 국내 해외 공동 통합 종합 신규 기존 우수 주요 이하 이상 외 및 등 제 년 년도 차 회 기 호 안 내".split()
)
TAILS = tuple("사업 용역 운영 지원 관리 계획 서비스 프로그램 구축 제작 개발 교육 사업자 기관".split())
#: Years, ordinals and numbers.
NUMBERS = "[0-9]{1,4}년?도?|제?[0-9]+[차회기]|[0-9.]+"
PUNCTUATION = "[]()「」『』·,~〈〉<>‘’'\"“”/|:;!?&#*+=_%"
#: What separates words: punctuation and the white space of text.WS.
BETWEEN = PUNCTUATION + " \t\n\x0b\f\r\u00a0\ufeff\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def classify(df: DataFrame, title: Column, text: Column, rules: Rules, code: Column | None = None) -> DataFrame:
    """df with groups, excluded and label: kept, killed (matched but excluded), unmatched, or excluded."""
    out = df.withColumns({"groups": match_groups(text, rules, code), "excluded": excluded_by(title, rules)})
    bad, good = F.size("excluded") > 0, F.size("groups") > 0
    return out.withColumn("label", F.when(bad & good, "killed").when(bad, "excluded").when(good, "kept").otherwise("unmatched"))


def tokens(title: Column, stop: tuple[str, ...] = STOP_WORDS) -> Column:
    """The distinct words of a title and their forms without an ending (no ending ends with another, so a word has one at most).

    What separates words becomes a space first: a pattern with a class of so many characters, matched at each place, costs
    several times as much. Numbers and endings are looked for only in words whose first or last character fits.
    """
    plain = F.translate(F.coalesce(title, F.lit("")), BETWEEN, " " * len(BETWEEN))
    words = F.array_distinct(F.split(plain, " +"))
    number = lambda w: F.substring(w, 1, 1).isin(*"0123456789.제") & w.rlike(f"^(?:{NUMBERS})$")
    able = F.filter(words, lambda w: (F.length(w) >= 2) & ~number(w))
    ended = lambda w: F.right(w, F.lit(1)).isin(*sorted({x[-1] for x in TAILS}))
    form = lambda w: F.regexp_extract(w, f"^(.{{2,}})(?:{'|'.join(TAILS)})$", 1)
    both = let(able, lambda x: F.array_union(x, F.transform(F.filter(x, ended), form)))
    return F.filter(both, lambda w: (F.length(w) >= 2) & ~w.isin(*stop))


def document_frequency(df: DataFrame, words: Column, *by: str) -> DataFrame:
    """token, n: in how many rows a token is."""
    return df.select(*by, F.explode_outer(words).alias("token")).where("token is not null").groupBy(*by, "token").agg(F.count("*").alias("n"))


def is_keyword(token: Column, rules: Rules) -> Column:
    """Whether a token holds a group word or is part of one."""
    out = F.lit(False)
    for words in rules.groups.values():
        for k in words:
            out = out | token.contains(k) | F.contains(F.lit(k), token)
    return out


def min_hits(n_pool: Column) -> Column:
    """3 at least; grows with the pool."""
    return F.greatest(F.lit(3), F.floor(n_pool / 2000 + 0.5).cast("long"))


def _counted(classified: DataFrame, title: str, **flags: Column) -> DataFrame:
    """token, pool (rows with it that no rule excludes), a count for each flag, and n_pool: tokens are made and counted once."""
    pool = classified.where(F.size("excluded") == 0)
    # The flags are bound with the tokens; beside an explode() they would be computed again for each token.
    held = let(F.array(*flags.values()), lambda f: F.transform(tokens(F.col(title)), lambda w: F.struct(w.alias("token"), f.alias("flags"))))
    each = pool.select(F.explode_outer(held).alias("x")).where("x is not null")  # explode() would compute the tokens in a filter as well
    counts = each.groupBy("x.token").agg(F.count("*").alias("pool"), *[F.count_if(F.col("x.flags")[i]).alias(k) for i, k in enumerate(flags)])
    return counts.join(F.broadcast(pool.agg(F.count("*").alias("n_pool"))))  # one row


def lift(classified: DataFrame, title: str, text: Column, rules: Rules, top: int = 12, least: float = 0.4) -> DataFrame:
    """grp, token, n, pool, lift, rank: words that are mostly in a group's rows, the best of each group."""
    hit = lambda words: functools.reduce(Column.__or__, [text.contains(w) for w in words], F.lit(False))
    groups = {f"n_{i}": g for i, g in enumerate(rules.groups)}
    counts = _counted(classified, title, **{k: hit(rules.groups[g]) for k, g in groups.items()})
    each = F.explode(F.array(*[F.struct(F.lit(g).alias("grp"), F.col(k).alias("n")) for k, g in groups.items()]))
    found = counts.select("token", "pool", "n_pool", each.alias("x")).select("token", "pool", "n_pool", "x.*")
    found = found.where((F.col("n") >= min_hits(F.col("n_pool"))) & ~is_keyword(F.col("token"), rules))
    found = found.withColumn("lift", F.col("n") / F.col("pool")).where(F.col("lift") >= least)
    order = Window.partitionBy("grp").orderBy(F.round(F.col("lift") * F.log1p("n"), 9).desc(), "token")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("grp", "token", "n", "pool", "lift", "rank")


def missed(classified: DataFrame, title: str, rules: Rules, top: int = 20, least: float = 0.7) -> DataFrame:
    """token, n, lift: words that are mostly in rows no rule matches."""
    found = _counted(classified, title, n=F.col("label") == "unmatched")
    found = found.where((F.col("n") >= 2 * min_hits(F.col("n_pool"))) & ~is_keyword(F.col("token"), rules)).withColumn("lift", F.col("n") / F.col("pool")).where(F.col("lift") >= least)
    return found.orderBy(F.desc("n"), "token").limit(top).select("token", "n", "lift")


def examples(found: DataFrame, records: DataFrame, title: str, order: str, token: str = "token") -> DataFrame:
    """found (a short report) with ``example``: the title of the first record, by ``order``, that holds the token anywhere.

    The report's tokens are read first, so the records are passed over once, with a test for each token; a report of over 1,000 is refused.
    """
    words = sorted({r[0] for r in found.select(token).limit(1001).collect()})
    if len(words) > 1000:
        raise ValueError("more than 1,000 tokens; take the top of the report first")
    hits = F.filter(F.array(*map(F.lit, words)) if words else F.array().cast("array<string>"), lambda w: F.contains(F.col(title), w))
    first = records.select(F.explode(hits).alias(token), title, order).groupBy(token).agg(F.min_by(title, order).alias("example"))
    return found.join(F.broadcast(first), token, "left")


def cut(c: Column, n: int) -> Column:
    """At most n characters, for reports."""
    return F.substring(c, 1, n)


def code_candidates(classified: DataFrame, code: str, name: str, title: str, order: str, top: int = 15) -> DataFrame:
    """code, name, ours, gain, hit_rate, sample: category codes that would bring in more rows of the kind."""
    free = F.size("excluded") == 0
    ours, gain = free & (F.size("groups") > 0), free & (F.size("groups") == 0)
    found = classified.where(F.coalesce(F.col(code), F.lit("")) != "").groupBy(F.col(code).alias("code")).agg(F.min_by(name, order).alias("name"), F.count_if(ours).alias("ours"), F.count_if(gain).alias("gain"), F.min_by(F.when(gain, F.col(title)), F.when(gain, F.col(order))).alias("sample"))
    rate = F.col("ours") / (F.col("ours") + F.col("gain"))
    found = found.where((F.col("ours") + F.col("gain") >= 5) & (F.col("gain") >= 3) & (rate >= 0.5)).withColumn("hit_rate", F.floor(rate * 100 + 0.5).cast("long"))
    return found.orderBy(F.desc("gain"), "code").limit(top)


def word_counts(classified: DataFrame, text: Column, rules: Rules) -> DataFrame:
    """grp, word, n of every group word over kept rows of its group, zeros included; one aggregation."""
    named = [(g, w) for g, ws in rules.groups.items() for w in ws]
    kept = classified.where("label = 'kept'")
    pairs = [F.struct(F.lit(g).alias("grp"), F.lit(w).alias("word"), (F.array_contains("groups", g) & text.contains(w)).alias("hit")) for g, w in named]
    counts = kept.select(F.explode(F.filter(F.array(*pairs), lambda x: x["hit"])).alias("x")).groupBy("x.grp", "x.word").agg(F.count("*").alias("n"))
    every = classified.sparkSession.createDataFrame(named, "grp string, word string")
    return every.join(counts, ["grp", "word"], "left").select("grp", "word", F.coalesce("n", F.lit(0)).alias("n"))


def what_if(df: DataFrame, word: str, title: Column, text: Column, rules: Rules) -> DataFrame:
    """df's rows with the word, labelled excluded, caught (another word brings them in) or fresh."""
    found = classify(df.where(text.contains(word)), title, text, rules.without(word))
    return found.withColumn("label", F.when(F.size("excluded") > 0, "excluded").when(F.size("groups") > 0, "caught").otherwise("fresh"))


def systematic_sample(df: DataFrame, n: int, *order: str) -> DataFrame:
    """Rows floor(i * len / n) of df in order, all of them if there are no more than n."""
    rows = numbered(df, *order, index="_i", total="_total")
    first = F.ceil(F.col("_i") * n / F.col("_total"))
    chosen = (F.col("_total") <= n) | ((F.floor(first * F.col("_total") / n) == F.col("_i")) & (first < n))
    return rows.where(chosen).select(*df.columns)
