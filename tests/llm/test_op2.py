import hashlib
import random

import numpy as np

from gazette.llm.op2_decontaminate import TestBlock, brute_force, build_index, find_contamination, match, op2_decontaminate, report, search
from gazette.llm.shared import scratch_path


def check(rows, docs, items, window=10):
    want = sorted((d if d is not None else -1, *brute_force(t, items, window)) for d, t in docs)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, len(r.hits), r.items) for r in rows) == want


def frames(spark, docs, items):
    return spark.createDataFrame([(d, t, 7) for d, t in docs], "doc_id long, text string, items int"), spark.createDataFrame(items, "item_id string, text string")


def test_random_texts_against_brute_force(spark):
    rng = random.Random(2)
    make = lambda n: " ".join(rng.choice("aBcdé1") for _ in range(rng.randrange(n)))
    items = [(str(i), make(12)) for i in range(40)] + [("x", "Q.R-s_t"), ("x", "q"), ("n", None), ("e", ""), ("p", "...")]
    docs = [(i, make(60)) for i in range(150)] + [(900, None), (901, ""), (None, "q r s t u"), (902, "Q/R\nS T"), (902, "Q/R\nS T"), (902, "other")]
    df, bench = frames(spark, docs, items)
    for window, limit in ((4, 50_000), (4, 9), (10, 50_000)):
        check(find_contamination(df, bench, window, pass_windows=limit).collect(), docs, items, window)


def test_long_item_over_blocks(spark):
    rng = random.Random(3)
    words = [str(rng.randrange(50)) for _ in range(300)]
    items = [("1", " ".join(words))]
    docs = [(1, " ".join(words[95:112])), (2, " ".join(words[200:209])), (3, " ".join(words))]
    df, bench = frames(spark, docs, items)
    check(find_contamination(df, bench, pass_windows=40).collect(), docs, items)


def test_proximity(spark):
    df, bench = frames(spark, [(1, "a b x c d"), (2, "a b c d"), (3, "a x x x x x b c d")], [("i", "a b c d")])
    found = {r.doc_id: (r.items, r.near_items) for r in find_contamination(df, bench, slop=2).collect()}
    assert found == {1: ([], ["i"]), 2: (["i"], ["i"]), 3: ([], [])}


def test_empty_tables(spark):
    df, bench = frames(spark, [(1, "a b")], [("i", "a b")])
    assert find_contamination(df.limit(0), bench).count() == 0
    r = report(find_contamination(df, bench.limit(0))).first()
    assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (2, 0, 0, hashlib.sha256(b"").hexdigest(), False)


def test_anchor_is_the_rarest_term():
    block = TestBlock([((b"a", b"b", b"c"), ["i"])])
    block.plan({b"a": 9, b"b": 1, b"c": 5})
    assert block.terms[0].tolist() == [block.term[b"b"], block.term[b"c"], block.term[b"a"]]


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    found = {r.doc_id: r for r in op2_decontaminate(spark, sf).collect()}
    n = 0
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        n_words, n_hit, hit = brute_force(d.text, items)
        r = found[d.doc_id]
        n += n_hit > 0
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n_words, n_hit, len(hit), hashlib.sha256(",".join(hit).encode()).hexdigest())
    assert n


def test_stored_index_serves_other_test_sets(spark, tmp_path):
    docs = [(i, f"w{i % 7} common words here and w{i % 5} then more common words w{i % 3}") for i in range(60)]
    sets = [[("i", "common words here"), ("j", "w1 common words")], [("k", "then more common words w2")]]
    df, _ = frames(spark, docs, sets[0])
    df.select("doc_id", "text").write.parquet(f"{tmp_path}/docs")
    at = build_index(spark.read.parquet(f"{tmp_path}/docs"), scratch_path(spark, "index"))
    for x in (tmp_path / "docs").iterdir():
        x.unlink()
    for items in sets:
        check(search(spark, at, spark.createDataFrame(items, "item_id string, text string")).collect(), docs, items)
    files = spark.read.parquet(at).where("term = encode('common', 'UTF-8')")
    assert files.agg({"n_docs": "sum"}).first()[0] == 60


def test_items_without_id_hit_but_are_not_named(spark):
    df, bench = frames(spark, [(1, "x a b c y"), (2, "p q")], [(None, "a b c"), ("i", "p q")])
    r = {x.doc_id: x for x in report(find_contamination(df, bench)).collect()}
    assert (r[1].n_hit, r[1].n_items, r[1].contaminated) == (3, 0, True)
    assert (r[2].n_hit, r[2].n_items) == (2, 1)


def test_frequent_anchor_in_parts():
    block = TestBlock([((b"a", b"b"), ["i"]), ((b"a", b"a"), ["j"])])
    block.plan({})
    keys = np.sort(np.array([(0 << 20) + x for x in range(10, 5000)] + [(1 << 20) + x for x in range(11, 5000, 3)]))
    whole, parts = match(block, keys, 20), match(block, keys, 20, limit=7)
    assert sorted(zip(*map(list, whole))) == sorted(zip(*map(list, parts))) and len(whole[0]) > 6000


def test_very_long_text(spark):
    words = [f"w{i % 1000}" for i in range(400_000)]
    df, bench = frames(spark, [(1, " ".join(words)), (2, "w998 w999 w0 w1")], [("i", "w998 w999 w0 w1")])
    r = {x.doc_id: x for x in report(find_contamination(df, bench)).collect()}
    assert (r[1].n_words, r[1].n_hit, r[2].n_hit) == (400_000, 4 * 399, 4)
