"""Source divergence against a brute force over all terms of all pairs."""

import random
import re
from collections import Counter, defaultdict

from gazette.llm import op12_divergence as m


def brute_force(rows, least):
    docs, groups = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        docs[lang].update(set(words))
        groups[lang, source].update(words)
    out = []
    for lang in {x for x, _ in groups}:
        kept = [w for w, n in docs[lang].items() if n >= least]
        v = len(kept)
        own = {s: c for (x, s), c in groups.items() if x == lang}
        total = {s: sum(c[w] for w in kept) for s, c in own.items()}
        every = sum(total.values())
        p = {s: {w: 1 + 10**9 * (own[s][w] + 2) // (total[s] + 2 * v) for w in kept} for s in own}
        q = {w: 1 + 10**9 * (sum(c[w] for c in own.values()) + 2) // (every + 2 * v) for w in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in own:
            pairs = sorted(((-sum(f(p[s][w], p[o][w]) for w in kept), o.encode(), o) for o in own if o != s))
            out += [(lang, s, "pair", o, -value, i + 1) for i, (value, _, o) in enumerate(pairs)]
            terms = sorted((-f(p[s][w], q[w]), w.encode(), w) for w in kept if own[s][w] and p[s][w] > q[w])
            out += [(lang, s, "term", w, -value, i + 1) for i, (value, _, w) in enumerate(terms[:10])]
    return sorted(out)


def run(spark, rows, least=2):
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    return sorted(tuple(r) for r in m.audit(df.withColumnRenamed("source", "Source"), least).collect())


def test_as_brute_force(spark):
    rng = random.Random(2)
    words = ["the", "The", "é", "ÉA", "of", "a1b", "x", "straße", "zz", "\U0001f600", "q_r"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 30))), rng.choice(["en", "de", None, ""]), rng.choice(["s0", "s0", "s0", "s1", "s2", None])) for _ in range(120)]
    rows += [(None, "en", "s9"), ("", "fr", "only"), ("", "fr", "other"), (rows[0][0], "en", "s0"), (rows[0][0], "en", "s0"), ("word " * 20_000, "en", "s1")]
    assert run(spark, rows) == brute_force(rows, 2)


def test_nothing_kept_and_empty(spark):
    rows = [("a b", "en", "x"), ("c", "en", "y"), (None, "de", "x")]
    assert run(spark, rows, 10) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    assert run(spark, []) == []


def test_counts_wider_than_a_long(spark):
    from pyspark.sql import functions as F

    n, total = 500_000_000_000, 2_000_000_000_001
    got = spark.range(1).select(m.share(F.lit(n).cast("long"), F.lit(total).cast("long"), F.lit(7).cast("long"))).first()[0]
    assert got == 1 + 10**9 * (n + 2) // (total + 14)


def test_flushes_give_the_same(spark, monkeypatch):
    rows = [(f"a b c{'d' * (i % 7)}", "en", f"s{i % 3}") for i in range(60)]
    whole = run(spark, rows)
    monkeypatch.setattr(m, "COUNTS", 1)
    assert run(spark, rows) == whole == brute_force(rows, 2)
