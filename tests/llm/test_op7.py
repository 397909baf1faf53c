import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from gazette.llm import op7_quality as m

W = re.compile(r"[^\x20\x09-\x0D]+")


def features(text):
    t = text or ""
    w = W.findall(t)
    grams = Counter(zip(w, w[1:], w[2:]))
    cover = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in t.split("\n") if W.search(x)]
    base = len(w) < 50 or 100 * len(cover) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover), base


def test_features_against_brute_force(spark):
    rng = random.Random(7)
    texts = [None, "", " ", "\n\n", "a", " a b\x0bc\x0c", "a b c a b c", "é " * 200, "x y z w", "#" * 9, "a\n\na\nb \nb", "q " * 5000]
    texts += ["".join(rng.choices("ab \n#c\t", k=rng.randrange(400))) for _ in range(300)]
    texts += [" ".join(rng.choices(["the", "of", "x1", "y2", "z3", "w4"] + [str(i) for i in range(90)], k=rng.randrange(900))) for _ in range(40)]
    df = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)] + [(0, None, True)], "doc_id long, text string, kept boolean")
    found = m.judge(df).select("doc_id", "_quality.*").collect()
    assert len(found) == len(texts) + 1
    for r in found:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == features(texts[r.doc_id]), texts[r.doc_id]
        assert not (r.base_failed and r.kept)


def test_cascade_rejects_junk_and_keeps_columns(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(1, good, "a"), (2, good.replace("word", "w### "), "a"), (3, good.upper(), "a"), (4, good + " lorem ipsum", "a"), (5, None, "a"), (1, good, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    kept = m.keep_good(df)
    assert kept.columns == df.columns
    assert [r.doc_id for r in kept.collect()] == [1, 1]
    assert m.keep_good(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        m.judge(df, "text")


def test_order_is_by_rejections_per_second():
    rules = [m.Rule(x, None) for x in "abc"]
    assert [r.name for r in m.in_order(rules, [m.Measure("a", 1, 0.1), m.Measure("b", 0.1, 0.05), m.Measure("c", 0.1, 0)])] == ["b", "a", "c"]


def test_main_path_is_native(spark):
    plan = m.op7_quality(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_query_as_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(con.execute(f"select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept from ({m.ORACLE})").fetchall())
    assert sorted(map(tuple, m.op7_quality(spark, sf).collect())) == want


def test_shouting_counts_letters_of_every_script(spark):
    words = lambda x: " ".join(f"{x}{chr(0x3B1 + i % 20)}{chr(0x3B1 + i // 20)}" for i in range(60))
    greek = words("λόγος")
    hangul = " ".join(f"교육{chr(0xAC00 + i)}" for i in range(60))
    arabic = " ".join(f"كتاب{chr(0x628 + i % 20)}{chr(0x628 + i // 20)}" for i in range(60))
    kept = [greek + " API", hangul + " API USA", arabic + " API", greek.upper()[:3] + greek]
    rejected = [greek.upper(), words("МОСКВА").upper(), " ".join(f"WORD{i}" for i in range(60))]
    df = spark.createDataFrame(list(enumerate(kept + rejected)), "doc_id long, text string")
    assert sorted(r.doc_id for r in m.keep_good(df).collect()) == list(range(len(kept)))


def test_any_order_gives_one_verdict(spark):
    import itertools
    import random

    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names = ["short", m.REPEATS, *[r.name for r in m.default_rules("x")]]
    want = {r.doc_id for r in m.judge(df).select("doc_id", "_quality.kept").collect() if r.kept}
    rng = random.Random(1)
    for order in [names, names[::-1], *(rng.sample(names, len(names)) for _ in range(2))]:
        assert {r.doc_id for r in m.keep_good(df, order=order).collect()} == want
    assert {r.doc_id for r in m.keep_good(df).collect()} == want


def test_columns_of_any_name_stay(spark):
    text = " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame([(1, text, 7, "a", 5, 3)], "doc_id long, text string, _quality_row int, _quality_text string, _QUALITY_bits int, __quality_row int")
    assert [tuple(r) for r in m.keep_good(df).collect()] == [(1, text, 7, "a", 5, 3)]
    found = m.judge(df).first()
    assert found["_quality"].kept and tuple(found)[:-1] == (1, text, 7, "a", 5, 3)


def test_measures_cost(spark):
    df = spark.range(2000).selectExpr("id as doc_id", "repeat(concat('some words ', id, ' '), 200) as text")
    at = "_f"
    sample = m.with_counts(df, at).cache()
    dear = m.Rule("dear", F.size(F.array_distinct(F.transform(F.col("_f.words"), lambda w: F.sha2(w, 512)))) < 0)
    cheap = m.Rule("cheap", F.col("_f.n_words") < 0)
    by = {x.name: x for x in m.measure(sample, at, [dear, cheap])}
    assert by["dear"].seconds > by["cheap"].seconds
    assert [r.name for r in m.in_order([dear, cheap], list(by.values()))] == ["cheap", "dear"]


def test_windows_themselves(spark):
    """The way for colliding hashes gives what the fast one does."""
    texts = ["a b c a b c", "x", "a a a a a", " ".join("ab"[i % 2] + str(i % 7) for i in range(200)), "p q r s t u"]
    df = m.with_counts(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), "_f")
    rows = df.select("doc_id", F.when(F.size("_f.words") >= 3, m._by_windows(F.col("_f.words"))).alias("spots")).collect()
    for r in rows:
        w = texts[r.doc_id].split()
        g = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        assert (r.spots or []) == [i for i in range(len(g)) if g.count(g[i]) > 1]
