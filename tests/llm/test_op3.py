import random
import re

import numpy as np
import pyarrow as pa

from gazette.llm import op3_near_dup as m
from gazette.llm.components import components


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_force(docs):
    """[(doc_id, n_shingles, component_id, kept)] by all pairs."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[top(i)] = min((x for x in (least.get(top(i)), d) if x is not None), default=None)
    return [(d, len(sets[i]), least[top(i)], d == least[top(i)]) for i, (d, _) in enumerate(docs)]


def edited(rng, words, share):
    return [w if rng.random() > share else f"e{rng.randrange(10**6)}" for w in words]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def test_groups_chains_ties(spark):
    rng = random.Random(3)
    docs = [(5, None), (6, ""), (7, " \n"), (8, "one two"), (9, "ONE  two"), (10, "one"), (11, "a b c d e"), (12, "a b c d e f"), (12, "a b c d e f"), (None, "one two")]
    for g in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([8, 30, 120, 400]))]
        for k in range(rng.choice([2, 5, 25])):
            docs.append((100 * g + 50 + k, " ".join(edited(rng, base, rng.choice([0, 0.01, 0.03, 0.05])))))
        chain = list(base)
        for k in range(5):
            chain = edited(rng, chain, 0.02)
            docs.append((100 * g + 90 + k, " ".join(chain)))
    rng.shuffle(docs)
    df = spark.createDataFrame([(d, t, "z") for d, t in docs], "doc_id long, text string, digest string")
    found = m.near_duplicates(df)
    assert order(map(tuple, found.collect())) == order(brute_force(docs))
    kept = {r.doc_id for r in found.where("kept").collect()}
    out = m.keep_first(df)
    assert out.columns == df.columns
    assert {r.doc_id for r in out.collect()} == kept
    assert m.near_duplicates(df.limit(0)).count() == 0


def test_guarantee_of_the_index():
    """Every pair within 2 * CHUNKS - 1 symbols shares a key."""
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**16, (300, m.SYMBOLS)).astype(np.uint16)
    b = a.copy()
    for i in range(len(b)):
        at = rng.choice(m.SYMBOLS, 2 * m.CHUNKS - 1, replace=False)
        b[i, at] ^= rng.integers(1, 2**16, len(at)).astype(np.uint16)
    assert ((a != b).sum(axis=1) == 2 * m.CHUNKS - 1).all()
    assert (m.probe_keys(a) == m.probe_keys(b)).any(axis=1).all()


def test_recall_at_the_threshold():
    """Sets of similarity 0.75 share a key: at most one of 20,000 may be missed."""
    rng = np.random.default_rng(2)
    missed = 0
    for n in (7, 70, 700):
        for _ in range(2000 if n < 700 else 500):
            x = np.unique(rng.integers(0, 2**64, n, np.uint64))
            k = len(x) // 7
            a, b = np.sort(x[k:]), np.sort(x[: len(x) - k])
            if len(x) > 2 * k:
                keys = m.probe_keys(m.signatures([a, b]))
                missed += not (keys[0] == keys[1]).any()
    assert missed <= 1


def test_filter_of_ids(spark):
    """All of its own ids pass, hardly any others."""
    bits = m.id_filter(spark.range(0, 120_000, 2))
    assert m.in_filter(bits, pa.array(range(0, 120_000, 2))).all()
    assert m.in_filter(bits, pa.array(range(1, 400_001, 2))).mean() < 0.005


def test_wide_tables_are_shuffled_once(spark, monkeypatch):
    """Keys and exploded shingles meet in one shuffle each, and no set moves to be exploded, where no table is small enough to be sent to all tasks."""
    plans, store = {}, m.materialize

    def stored(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return store(df, name)

    monkeypatch.setattr(m, "materialize", stored)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = m.near_duplicates(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "g")], "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(map(tuple, rows)) == [(1, 2, 1, True), (2, 2, 1, False), (3, 1, 3, True)]
    assert plans["members"].count("Exchange hashpartitioning(key#") == 1
    # It is read twice there; the second shuffle is the first one, reused.
    assert plans["mixed_able"].count("Exchange hashpartitioning(shingle#") == 2
    assert "LeftSemi" not in plans["mixed_able"]


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 50 + i) for i in range(20)] + [(200, 300), (300, 201), (7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(31), 0), **dict.fromkeys([100, *range(50, 70)], 50), 200: 200, 201: 200, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert order(map(tuple, m.op3_near_dup(spark, sf).collect())) == order(brute_force(docs))
