"""The automaton against the expressions a word, and profiles against a recompute."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gazette.functions import automaton
from gazette.functions.rules import Rules
from gazette.operators import discovery
from gazette.plans import catalogue, relations
from gazette.streaming.parts import PartsSink
from gazette.streaming.profiles import ProfileSink, profiles


def test_phrases_that_cover_words(spark):
    rules = Rules({"g": ("art", "b"), "h": ("zz",)}, ("old", "art", "aa"), ("oldest", "aaa", "art gallery"), ("party",), (("new", ("old", "aa")),), ("77",))
    texts = ["old", "oldest", "oldest old", "oldold", "party", "party art", "aaa", "aaaa", "aaab", "art gallery", "art galleryart", "new old", "zz b", "", None, "x" * 50_000 + "old", "party" * 5_000]
    df = spark.createDataFrame([(i, t, "77" if i % 2 else None) for i, t in enumerate(texts)], "i int, t string, c string")
    t, c = F.col("t"), F.col("c")
    own = automaton.classify(df, t, t, rules, c).select("i", "groups", "excluded", "label").orderBy("i").collect()
    assert own == discovery.classify(df, t, F.coalesce(t, F.lit("")), rules, c).select("i", "groups", "excluded", "label").orderBy("i").collect()
    assert [r.excluded for r in own][:8] == [["old"], [], ["old"], ["old"], ["art"], ["art"], [], []]
    assert automaton.classify(df, t, t, Rules()).where("label <> 'unmatched'").count() == 0
    with pytest.raises(ValueError):
        automaton.Matcher(Rules(exclude=("",)))


def test_large_rule_file_as_an_expression_a_word(spark):
    docs = catalogue.read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    rules = relations.rules_of_corpus(docs)
    assert (len(rules.exclude), len(rules.groups), len(rules.allow), len(rules.release)) == (170, 6, 40, 7)
    t = F.col("text")
    other = discovery.classify(docs, t, F.coalesce(t, F.lit("")), rules).select("doc_id", F.concat_ws(",", "groups"), F.concat_ws(",", "excluded"), "label")
    own = relations.rules_automaton(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, own.collect())) == sorted(map(tuple, other.collect()))


def test_profiles_as_a_recompute(spark, tmp_path, monkeypatch):
    rng = random.Random(1)
    schema = "no string, seq long, org string, amount double, kind string, area string"
    record = lambda i: (rng.choice([f"n{rng.randrange(25)}"] * 20 + [None]), i, rng.choice(["a", "a", "b", None]), rng.choice([None, 1.25, 10.1]), rng.choice(["x", "y", None]), rng.choice("pqr"))
    batches = [[record(100 * b + i) for i in range(12)] for b in range(6)]
    rng.shuffle(batches)  # corrections may come before what they correct
    args = (["no"], ["seq"], "org", "amount", ["kind", "area"], 3)
    sink = ProfileSink(spark, f"{tmp_path}/p", *args)
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, schema)
        if i == 3:  # ends after the first of its two tables
            broken = ProfileSink(spark, f"{tmp_path}/p", *args)
            monkeypatch.setattr(PartsSink, "__call__", lambda *_: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                broken(df, i)
            monkeypatch.undo()
        sink(df, i)
        if i == 5:
            sink(df, i)
    newest = {}
    for r in (r for b in batches for r in b):
        if r[0] is not None and (r[0] not in newest or r[1] > newest[r[0]][1]):
            newest[r[0]] = r
    hist, money = defaultdict(Counter), Counter()
    for _, _, org, amount, *values in newest.values():
        for d, v in zip(("kind", "area"), values):
            if org is not None and v is not None:
                hist[org, d][v] += 1
                money[org, d] += round((amount or 0) * 100)
    expected = []
    for (org, d), c in hist.items():
        mode, n = min(c.items(), key=lambda x: (-x[1], x[0]))
        total = sum(c.values())
        expected.append((org, d, total, money[org, d] / 100, len(c), mode, n, round(sum(x * x for x in c.values()) / total**2, 9)))
    found = profiles(sink.current()).withColumns({"amount": F.col("amount").cast("double"), "concentration": F.round("concentration", 9)})
    assert sorted(map(tuple, found.collect())) == sorted(expected)
