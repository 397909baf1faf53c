import re
import zlib
from collections import Counter, defaultdict

from gazette.llm import op1_sharding as m
from gazette.llm.shared import scratch_path


def check(rows, texts, n_shards=8):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    places = defaultdict(list)
    for r in rows:
        places[r.shard].append(r.slot)
    for s, x in places.items():
        assert 0 <= s < n_shards
        assert sorted(x) == list(range(len(x)))


def shard_bytes(rows):
    out = Counter()
    for r in rows:
        out[r.shard] += r.size
    return out


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = m.op1_sharding(spark, sf).collect()
    check(rows, [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])
    size = shard_bytes(rows)
    assert max(size.values()) - min(size.values()) < 0.005 * sum(size.values()) / 8


def test_nulls_copies_clashing_columns(spark):
    texts = [(None, None), (1, None), (2, ""), (3, "é")] + [(7, "hot row")] * 4000 + [(i, "x" * (i % 50)) for i in range(100, 900)]
    df = spark.createDataFrame([(d, t, 0, 0) for d, t in texts], "doc_id long, text string, shard int, size int")
    rows = m.assign(df).collect()
    check(rows, texts)
    size = shard_bytes(rows)
    assert max(size.values()) - min(size.values()) < 0.01 * sum(size.values()) / 8
    assert m.assign(df.limit(0)).count() == 0


def test_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(m, "COPIES", 7)
    texts = [(1, "a")] * 22 + [(2, "b")] * 7 + [(3, "c")]
    check(m.assign(spark.createDataFrame(texts, "doc_id long, text string"), 3).collect(), texts, 3)


def test_map_is_versioned_and_edited(spark):
    df = spark.range(20000).selectExpr("id as doc_id", "repeat('x', cast(id % 97 as int)) as text")
    path = scratch_path(spark, "map")
    m.assign(df, 8, map_path=path)
    one = m.load_map(spark, path)
    m.assign(df, 9, map_path=path)
    two = m.load_map(spark, path)
    assert (two.version, two.n_shards, m.load_map(spark, path, one.version)) == (one.version + 1, 9, one)
    moved = [i for i in range(m.SLOTS) if one.shard[i] != two.shard[i]]
    assert 0 < len(moved) < m.SLOTS / 7
    assert sum(two.shard[i] == 8 for i in moved) > 0.9 * len(moved)


def test_rows_lie_where_the_stored_map_says(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "repeat('y', cast(id % 31 as int)) as text")
    path = scratch_path(spark, "map")
    for n_shards, version in ((4, 2), (5, 3)):
        rows = m.assign(df, n_shards, 64, map_path=path).collect()
        stored = m.load_map(spark, path, version)
        assert {(r.map_version, r.shard - stored.shard[r.virtual_slot]) for r in rows} == {(version, 0)}
    assert m.load_map(spark, path, 1) == m.first_map(64, 4)


def test_long_text(spark):
    texts = [(1, "é" * 3_000_000), (2, "a"), (1, "é" * 3_000_000)]
    check(m.assign(spark.createDataFrame(texts, "doc_id long, text string"), 2).collect(), texts, 2)


def test_a_shard_can_go():
    old = m.first_map(100, 5)
    new = m.rebalance(old, dict.fromkeys(range(100), 10), 4)
    assert Counter(new.shard) == {0: 25, 1: 25, 2: 25, 3: 25}
    assert all(a == b for a, b in zip(old.shard, new.shard, strict=True) if a < 4)


def test_main_path_is_native(spark):
    assert not re.search("Python|Arrow|Pandas", m.op1_sharding(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString())
