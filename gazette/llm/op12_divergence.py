"""Source divergence audit by a baseline-correction inverted index.

Each language keeps the terms that enough of its documents hold. The inverted index has, for each kept term, the sources that
use it and how often. Two sources are compared over *all* kept terms, though most terms miss in one or both:

1. a pair starts at its baseline, V times f of two zero counts;
2. a source's own postings correct that against the other's zero count. Terms of one count give the same correction, so a
   source's histogram of counts is enough: terms with a count, times the correction;
3. only terms that both sources have are left, where both corrections together are wrong. Their postings meet by term and emit the rest,
   f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0), which is summed by pair in the task that makes it.

Everything is integer arithmetic, so the three sums give exactly the sum over all terms. Each source's terms are ranked by their
divergence from the language in a window whose limit is applied before the shuffle.

Counting is one pass over Arrow batches: a task sums the counts of its texts by language, source and word, COUNTS of them at a time at most.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gazette.llm.shared import chunks, materialize, table, utf8

#: A term is kept by a language if so many of its documents hold it.
LEAST_DOCUMENTS = 10
#: What a missing term counts, and the scale of a share.
PRIOR, SCALE = 2, 1_000_000_000
#: Terms reported for a source.
TOP = 10
#: Counts that a task holds before it passes them on.
COUNTS = 200_000

#: Bytes of UTF-8 text: letters in lower case, what is no letter and below 128 as a space.
_FOLD = bytes(32 if b <= 64 or 91 <= b <= 96 or 123 <= b <= 127 else b + 32 if 65 <= b <= 90 else b for b in range(256))

COUNTED = "lang string, source string, term string, n long, documents long"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def count_terms(df: DataFrame) -> DataFrame:
    """COUNTED: occurrences and documents of each term in each (lang, source); a row with a null term for every such group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            columns: list[list] = [[], [], [], [], []]
            for (lang, source), (n, documents) in held.items():
                columns[0] += [lang] * (len(n) + 1)
                columns[1] += [source] * (len(n) + 1)
                columns[2] += [None, *n]
                columns[3] += [0, *n.values()]
                columns[4] += [0, *map(documents.__getitem__, n)]
            held.clear()
            strings = [pa.array(c, pa.binary()).cast(pa.string()) for c in columns[:3]]
            return pa.RecordBatch.from_arrays([*strings, *[pa.array(c, pa.int64()) for c in columns[3:]]], ["lang", "source", "term", "n", "documents"])

        for piece, texts in chunks(batches):
            for key, text in zip(zip(utf8(piece.column("lang")), utf8(piece.column("source")), strict=True), texts, strict=True):
                n, documents = held.setdefault(key, (Counter(), Counter()))
                words = terms_of(text)
                size -= len(n)
                n.update(words)
                documents.update(set(words))
                size += len(n)
            if size >= COUNTS:
                yield flush()
                size = 0
        if held:
            yield flush()

    return df.select(*[F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")]).mapInArrow(run, COUNTED)


def share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * v)). The product may be wider than a long."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(n + PRIOR), wide(total + PRIOR * v))


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are at most SCALE + 1, so the square is a long."""
    return F.call_function("div", (p - q) * (p - q), p + q)


class Index:
    """The kept terms' postings with their shares, and the groups they are in; stored tables.

    groups: lang, source, v, p0. postings: lang, term, source, n, p, p0, q (q: the term's share in the language).
    """

    def __init__(self, df: DataFrame, least_documents: int = LEAST_DOCUMENTS):
        counted = count_terms(df).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
        counted = materialize(counted, "counted")
        named = counted.where("term is not null")
        kept = named.groupBy("lang", "term").agg(F.sum("documents").alias("documents"), F.sum("n").alias("in_lang")).where(F.col("documents") >= least_documents)
        raw = materialize(named.select("lang", "term", "source", "n").join(kept.select("lang", "term", "in_lang"), ["lang", "term"]), "kept")
        # The words of a language, each once: where its first source has it.
        first = raw.groupBy("lang", "term").agg(F.first("in_lang").alias("in_lang"))
        langs = first.groupBy("lang").agg(F.count("*").alias("v"), F.sum("in_lang").alias("lang_total"))
        totals = raw.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = counted.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        zero = lambda c: F.coalesce(c, F.lit(0))
        groups = groups.select("lang", "source", zero(F.col("v")).alias("v"), zero(F.col("total")).alias("total"), zero(F.col("lang_total")).alias("lang_total"))
        p0 = F.when(F.col("v") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("v"))).otherwise(1)
        groups = materialize(groups.withColumn("p0", p0.cast("long")), "groups")
        both = raw.join(groups, ["lang", "source"])
        shares = share(F.col("n"), F.col("total"), F.col("v")).alias("p"), share(F.col("in_lang"), F.col("lang_total"), F.col("v")).alias("q")
        self.groups = groups.select("lang", "source", "v", "p0")
        self.postings = materialize(both.select("lang", "term", "source", "n", *shares, "p0"), "postings")

    def pairs(self) -> DataFrame:
        """lang, a, b, value of every two sources of a language, a before b: the sum over all its kept terms."""
        groups, postings = self.groups, self.postings
        side = lambda df, x, *names: df.select("lang", *[F.col(c).alias(f"{c}_{x}") for c in names])
        # Sources of a language, two by two, as the result has them.
        two = side(groups, "a", "source", "p0").join(side(groups, "b", "source", "p0").join(groups.select("lang", "v").distinct(), "lang"), "lang").where("source_a < source_b")
        base = two.select("lang", "source_a", "source_b", (F.col("v") * divergence(F.col("p0_a"), F.col("p0_b"))).alias("value"))
        # One side's counts against the other's zero: p stands for its count.
        histogram = postings.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("terms"))
        one = side(histogram, "x", "source", "p", "p0", "terms").join(side(groups, "y", "source", "p0"), "lang").where("source_x <> source_y")
        corrected = F.col("terms_x") * (divergence(F.col("p_x"), F.col("p0_y")) - divergence(F.col("p0_x"), F.col("p0_y")))
        single = one.select("lang", F.least("source_x", "source_y").alias("source_a"), F.greatest("source_x", "source_y").alias("source_b"), corrected.alias("value"))
        # Terms of both.
        shared = [postings.select("lang", "term", *[F.col(c).alias(f"{c}_{x}") for c in ("source", "p", "p0")]) for x in "ab"]
        met = shared[0].join(shared[1], ["lang", "term"]).where("source_a < source_b")
        p, q, p0, q0 = (F.col(c) for c in ("p_a", "p_b", "p0_a", "p0_b"))
        rest = divergence(p, q) - divergence(p, q0) - divergence(p0, q) + divergence(p0, q0)
        double = met.groupBy("lang", "source_a", "source_b").agg(F.sum(rest).alias("value"))
        every = base.unionByName(single).unionByName(double)
        return every.groupBy("lang", F.col("source_a").alias("a"), F.col("source_b").alias("b")).agg(F.sum("value").alias("value"))

    def terms(self) -> DataFrame:
        """lang, source, term, value of the terms that a source uses more than its language does."""
        return self.postings.where("p > q").select("lang", "source", "term", divergence(F.col("p"), F.col("q")).alias("value"))


def ranked(df: DataFrame, item: str) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), item)
    return df.withColumn("rank", F.row_number().over(order))


def audit(df: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank of df(text, lang, source).

    A null lang, source or text is an empty one. A language without kept terms gives pairs of value 0; a language with one
    source gives no pairs. Equal rows all count; an empty table gives none; other columns are ignored. Ties are ranked by
    the item's UTF-8 bytes.
    """
    filled = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    index = Index(filled, least_documents)
    pairs = materialize(index.pairs(), "pairs")
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    terms = ranked(index.terms().withColumnRenamed("term", "item"), "item").where(F.col("rank") <= top)
    columns = "lang", "source", "part", "item", "value", "rank"
    return ranked(both, "item").withColumn("part", F.lit("pair")).select(*columns).unionByName(terms.withColumn("part", F.lit("term")).select(*columns))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return audit(table(spark, sf_dir, "documents"))


ORACLE = rf"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as t from documents),
w as (select r, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term, count(*) as n from w group by lang, term having count(distinct r) >= {LEAST_DOCUMENTS}),
l as (select lang, count(*) as v, cast(sum(n) as hugeint) as total from kept group by lang),
g as (select distinct lang, source from d),
c as (select w.lang, source, w.term, count(*) as n from w join kept using (lang, term) group by w.lang, source, w.term),
s as (select lang, source, cast(sum(n) as hugeint) as total from c group by lang, source),
p as (
    select g.lang, g.source, kept.term, coalesce(c.n, 0) as n,
        1 + {SCALE}::hugeint * (coalesce(c.n, 0) + {PRIOR}) // (coalesce(s.total, 0) + {PRIOR} * l.v) as p,
        1 + {SCALE}::hugeint * (kept.n + {PRIOR}) // (l.total + {PRIOR} * l.v) as q
    from g join l using (lang) join kept using (lang)
    left join s on s.lang = g.lang and s.source = g.source
    left join c on c.lang = g.lang and c.source = g.source and c.term = kept.term
),
f as (
    select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
    from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by a.lang, a.source, b.source
),
pairs as (
    select a.lang, a.source, b.source as item, cast(coalesce(f.value, 0) as bigint) as value
    from g a join g b on a.lang = b.lang and a.source <> b.source
    left join f on f.lang = a.lang and f.source = a.source and f.item = b.source
),
terms as (select lang, source, term as item, cast((p - q) * (p - q) // (p + q) as bigint) as value from p where n > 0 and p > q)
select lang, source, 'pair' as part, item, value, cast(row_number() over (partition by lang, source order by value desc, item) as integer) as rank from pairs
union all
select * from (
    select lang, source, 'term' as part, item, value, cast(row_number() over (partition by lang, source order by value desc, item) as integer) as rank from terms
) where rank <= {TOP}
"""
