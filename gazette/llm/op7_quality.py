"""Quality rules as a short-circuit cascade, with DataFrame functions only.

Each rule is a Column that is true for a text to reject. On a bounded random sample the cascade
measures what each rule costs and how much it rejects, and puts the rules in
the order of rejections per second; a text is tested until the first rule rejects it.
The sample decides the order alone: the verdict is that of all rules in any order.

A rule's cost is the best of several passes over the sample, less that of a pass without a rule. What several rules read
(words, lines and their counts) is made once before them; the repeated 3-word windows are the dear part, and
where only the verdict is asked for (``keep_good``) they are made for the texts alone that the rules before them leave.
"""

from __future__ import annotations

import functools
import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.shared import fresh, table

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Rows, about, on which rules are measured; they only decide the order of the rules.
SAMPLE_ROWS = 10_000
#: Passes over the sample for each rule, and the tasks of a pass, whatever the table's partitions.
PASSES, SAMPLE_TASKS = 3, 16
SEED = 7
REPEATS = "repeated_windows"


@dataclass(frozen=True)
class Rule:
    name: str
    reject: Column


def words_of(text: Column) -> Column:
    """The words [^\\x20\\x09-\\x0D]+ of a text."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def n_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def with_counts(df: DataFrame, at: str) -> DataFrame:
    """Adds a struct column ``at`` of what the cheap rules look at. A null text is empty."""
    text, words, lines = (f"{at}_{x}" for x in ("text", "words", "lines"))
    c = F.col
    out = df.withColumn(text, F.coalesce(c("text"), F.lit("")))
    out = out.withColumns({words: words_of(c(text)), lines: F.filter(F.split(c(text), "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")})
    features = F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.translate(c(text), SPACES, "")).cast("long").alias("word_chars"),
        n_of(c(text), SYMBOLS).alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        c(text).alias("text"),
        c(words).alias("words"),
        c(lines).alias("lines"),
    )
    return out.withColumn(at, features).drop(text, words, lines)


def with_repeats(df: DataFrame, at: str, needed: Column | None = None) -> DataFrame:
    """Adds a column ``{at}_n_repeat`` to with_counts' table: the words in 3-word windows that occur twice or more (0 where not needed)."""
    bits, grams, keys, spots = (f"{at}_{x}" for x in ("bits", "grams", "keys", "spots"))
    c, words = F.col, F.col(f"{at}.words")
    shift = lambda x, by: F.call_function("shiftleft", x, by)
    back = lambda x, by: F.call_function("shiftright", x, by)
    n = F.size(words)
    wanted = n >= 3 if needed is None else (n >= 3) & needed
    out = df.withColumn(bits, F.ceil(F.log2((n + 1).cast("double"))).cast("int"))
    # The hash of every 3-word window, at the index of its first word.
    hashed = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    out = out.withColumn(grams, F.when(wanted, hashed).otherwise(F.array().cast("array<bigint>")))
    # Where windows repeat: (hash, index) packed in a long and sorted brings equal windows together.
    packed = F.transform(c(grams), lambda g, i: shift(g, F.col(bits)).bitwiseOR(i.cast("long")))
    repeats = F.size(F.array_distinct(grams)) < F.size(grams)
    out = out.withColumn(keys, F.when(repeats, F.sort_array(packed)).otherwise(F.array().cast("array<bigint>")))
    place = lambda k: (F.get(keys, k) - shift(back(F.get(keys, k), c(bits)), c(bits))).cast("int")
    prefix = lambda k: back(F.get(keys, k), c(bits))
    same_words = lambda p, q: functools.reduce(Column.__and__, [F.get(words, p + j) == F.get(words, q + j) for j in range(3)])
    equal = lambda a, b: (prefix(a) == prefix(b)) & same_words(place(a), place(b))
    m = F.size(keys)
    again = F.filter(F.sequence(F.lit(0), m - 1), lambda k: ((k > 0) & equal(k - 1, k)) | ((k < m - 1) & equal(k, k + 1)))
    # Two windows with one (shortened) hash could stand between equal ones; then the windows themselves are sorted.
    collided = F.exists(F.sequence(F.lit(1), m - 1), lambda k: (prefix(k - 1) == prefix(k)) & ~same_words(place(k - 1), place(k)))
    out = out.withColumn(spots, F.when(m > 1, F.when(collided, _by_windows(words)).otherwise(F.sort_array(F.transform(again, place)))).otherwise(F.array().cast("array<int>")))
    # The union of the windows [p, p + 2] over the sorted indexes.
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("total"))
    union = F.aggregate(spots, start, lambda s, p: F.struct(p.alias("last"), (s["total"] + F.least(F.lit(3), p - s["last"]).cast("long")).alias("total")), lambda s: s["total"])
    return out.withColumn(f"{at}_n_repeat", union).drop(bits, grams, keys, spots)


def _by_windows(words: Column) -> Column:
    """The sorted indexes of the windows that occur again, by the windows themselves."""
    each = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("g"), i.alias("i")))

    def again(x: Column) -> Column:
        same = lambda a, b: F.get(x, a)["g"] == F.get(x, b)["g"]
        kept = F.filter(x, lambda y, k: ((k > 0) & F.coalesce(same(k - 1, k), F.lit(False))) | F.coalesce(same(k, k + 1), F.lit(False)))
        return F.sort_array(F.transform(kept, lambda y: y["i"]))

    return F.get(F.transform(F.array(F.sort_array(each)), again), 0)


def repeats_rule(at: str) -> Rule:
    return Rule(REPEATS, 100 * F.col(f"{at}_n_repeat") > 50 * F.col(f"{at}.n_words"))


def short_rule(at: str) -> Rule:
    return Rule("short", F.col(f"{at}.n_words") < 50)


def default_rules(f: str) -> list[Rule]:
    """The rules over the struct column ``f`` of with_counts."""
    g = lambda x: F.col(f"{f}.{x}")
    # Over half of the letters of any script. A text that is half lower-case ASCII can't be, and is told without a regex.
    letters, upper = (F.length(F.regexp_replace(g("text"), x, "")) for x in (r"\P{L}+", r"\P{Lu}+"))
    shouting = F.when(2 * n_of(g("text"), "abcdefghijklmnopqrstuvwxyz") >= g("word_chars"), F.lit(False)).otherwise(2 * upper > letters)
    ends = F.size(F.filter(g("lines"), lambda x: x.endswith("...") | x.endswith("…")))
    return [
        Rule("symbols", 10 * g("n_symbols") > g("n_words")),
        Rule("repeated_lines", 2 * g("n_dup_lines") > F.size(g("lines"))),
        Rule("word_length", (g("word_chars") < 2 * g("n_words")) | (g("word_chars") > 12 * g("n_words"))),
        Rule("shouting", shouting),
        Rule("placeholder", F.lower(g("text")).contains("lorem ipsum")),
        Rule("cut_lines", 10 * ends > 3 * F.size(g("lines"))),
    ]


@dataclass(frozen=True)
class Measure:
    name: str
    seconds: float
    rejected: float


def _seconds(df: DataFrame, value: Column) -> tuple[float, int]:
    """The shortest of PASSES passes, and how many rows the value is true for."""
    times, n = [], 0
    for _ in range(PASSES):
        began = time.perf_counter()
        n = df.agg(F.count_if(value).alias("n")).first().n
        times.append(time.perf_counter() - began)
    return min(times), n


def measure(counted: DataFrame, at: str, rules: list[Rule]) -> list[Measure]:
    """Seconds and rejected share of each rule on a stored sample; the repeats' seconds hold the making of their windows."""
    n = counted.count()
    idle, _ = _seconds(counted, F.col(f"{at}.n_words") < 0)
    out = []
    for rule in rules:
        over = with_repeats(counted, at) if rule.name == REPEATS else counted
        took, hit = _seconds(over, rule.reject)
        out.append(Measure(rule.name, max(0.0, took - idle), hit / n if n else 0.0))
    return out


def in_order(rules: list[Rule], measured: list[Measure]) -> list[Rule]:
    """Most rejections per second first; among rules that reject nothing, the cheapest."""
    by = {m.name: m for m in measured}
    # What is less than a millisecond is noise of the clock.
    seconds = {m.name: max(m.seconds, 1e-3) for m in measured}
    return sorted(rules, key=lambda r: (-by[r.name].rejected / seconds[r.name], seconds[r.name], r.name))


def sampled(df: DataFrame, at: str, rows: int) -> DataFrame:
    """About ``rows`` random rows of df's texts with their counts, kept on the executors' disks."""
    n = df.count()
    some = df.select("text").sample(min(1.0, 1.05 * rows / n), SEED) if n > rows else df.select("text")
    return with_counts(some.repartition(SAMPLE_TASKS), at).persist(StorageLevel.DISK_ONLY)


def rejected(rules: list[Rule]) -> Column:
    """True at the first rule that rejects; later ones aren't evaluated then."""
    out = F.when(F.lit(False), F.lit(False))
    for rule in rules:
        out = out.when(rule.reject, F.lit(True))
    return out.otherwise(F.lit(False))


def ordered_rules(df: DataFrame, at: str, rules: list[Rule], sample_rows: int) -> list[Rule]:
    sample = sampled(df, at, sample_rows)
    try:
        return in_order(rules, measure(sample, at, rules))
    finally:
        sample.unpersist()


def judge(df: DataFrame, at: str = "_quality", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Adds the struct column ``at`` with the features, base_failed and kept; all other columns stay, whatever their names.

    Null and empty texts have no words and fail the base rule. Equal texts get equal verdicts.
    An empty table gives none. ``at`` must not be a column of df.
    """
    if at.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"{at} is a column already")
    own = fresh(df, "_quality")
    rules = ordered_rules(df, own, default_rules(own), sample_rows)
    found = with_repeats(with_counts(df, own), own)
    failed = short_rule(own).reject | repeats_rule(own).reject
    kept = F.when(failed, F.lit(False)).otherwise(~rejected(rules))
    features = [F.col(f"{own}.{x}") for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines")]
    made = F.struct(*features, F.col(f"{own}_n_repeat").alias("n_repeat_words"), failed.alias("base_failed"), kept.alias("kept"))
    return found.select(*[F.col(f"`{c}`") for c in df.columns], made.alias(at))


def keep_good(df: DataFrame, sample_rows: int = SAMPLE_ROWS, order: list[str] | None = None) -> DataFrame:
    """The rows that pass, with df's columns. ``order``: names of the rules, where it is known; else it is measured.

    A filter right on the verdict would be pushed below the features, with a copy of them at each
    place that reads one. Spark pushes none below a row number.
    """
    at = fresh(df, "_quality")
    rules = [short_rule(at), repeats_rule(at), *default_rules(at)]
    rules = sorted(rules, key=lambda r: order.index(r.name)) if order else ordered_rules(df, at, rules, sample_rows)
    i = [r.name for r in rules].index(REPEATS)
    counted = with_counts(df, at).withColumn(f"{at}_before", rejected(rules[:i]))
    found = with_repeats(counted, at, ~F.col(f"{at}_before"))
    bad = F.when(F.col(f"{at}_before"), F.lit(True)).otherwise(rejected(rules[i:]))
    judged = found.select(*[F.col(f"`{c}`") for c in df.columns], bad.alias(f"{at}_bad"), F.monotonically_increasing_id().alias(f"{at}_row"))
    return judged.where((~F.col(f"{at}_bad")) & (F.col(f"{at}_row") >= 0)).select(*[F.col(f"`{c}`") for c in df.columns])


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: features and verdict."""
    return judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "_quality.*")


ORACLE = r"""
with d as (select doc_id, coalesce(text, '') as t from documents),
w as (
    select doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
    from d
),
g as (
    select doc_id, i, ws[i] || chr(1) || ws[i + 1] || chr(1) || ws[i + 2] as gram
    from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w)
),
c as (select doc_id, i, count(*) over (partition by doc_id, gram) as n from g),
r as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from c where n > 1) group by doc_id),
f as (
    select w.doc_id, t, ls, cast(len(ws) as bigint) as n_words,
        cast(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
        cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
        cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
        cast(coalesce(r.n, 0) as bigint) as n_repeat_words
    from w left join r on w.doc_id = r.doc_id
),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from f)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed
    and not 10 * n_symbols > n_words
    and not 2 * n_dup_lines > len(ls)
    and not (word_chars < 2 * n_words or word_chars > 12 * n_words)
    and not 2 * length(regexp_replace(t, '\P{Lu}+', '', 'g')) > length(regexp_replace(t, '\P{L}+', '', 'g'))
    and not contains(lower(t), 'lorem ipsum')
    and not 10 * len(list_filter(ls, lambda x: ends_with(x, '...') or ends_with(x, '…'))) > 3 * len(ls) as kept
from b
"""
