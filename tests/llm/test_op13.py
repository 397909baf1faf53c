"""The prefix trie against a dictionary of all prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

from gazette.llm import op13_trie as m


def brute_force(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = []
    for node, cs in members.items():
        under = [x for x in members if x[: len(node)] == node]
        has_child = {x[:-1] for x in members if x}
        ends = sorted(c for c in cs if made[c] == node)
        out.append(
            (
                min(cs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(cs),
                sum(len(x) == len(node) + 1 and x[: len(node)] == node for x in members),
                sum(x not in has_child for x in under),
                sum((len(members[x]) - 1) * len(x[-1][1]) for x in under if x),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def run(spark, rows, local=m.LOCAL):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, CHAIN string" if rows and len(rows[0]) == 5 else "conv_id long, turn long, role string, text string").repartition(3)
    return sorted((tuple(r) for r in m.prefix_trie(df, local).collect()), key=repr)


def sample(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(350), n):
        for t in range(rng.choice([0, 1, 2, 3, 5, 9])):
            rows.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", "user", None]), rng.choice(["a", "a", "hello", "é\U0001f600", None, ""])))
    # A group of copies, a chain of prefixes, repeated rows and equal turns.
    for c in range(400, 430):
        rows += [(c, t, "user", "same") for t in range(12)]
    for c in range(505, 520):
        rows += [(c, t, "u", f"t{t}") for t in range(c - 504)]
    return rows + [(1, 0, "user", "x"), (1, 0, "user", "x"), (1, 0, "user", "w"), (None, 0, "user", "lost")]


def test_as_brute_force(spark):
    rows = sample(1)
    expected = brute_force(rows)
    for local in (1, 3, 7, m.LOCAL):
        assert run(spark, rows, local) == expected, local


def test_small_tables_and_extra_columns(spark):
    assert run(spark, []) == []
    one = [(5, None, None, None)]
    assert run(spark, one) == brute_force(one)
    rows = [(*r, "x") for r in sample(3, 10)]
    assert run(spark, rows, 4) == brute_force([r[:4] for r in rows])


def test_turnless_conversations_end_at_the_root(spark):
    rows = [(c, 0, "user", "t") for c in range(1, 40)]
    got = run(spark, rows, 2)
    assert got == brute_force(rows)
    assert got[0][:2] == (1, 0) and any(r[1] == 0 and r[7] != m.NOTHING for r in got)


def test_long_conversation(spark):
    rows = [(100 + c, t, "u", f"{t % 3}") for c in range(3) for t in range(1_500 + c)]
    got = run(spark, rows, 1)
    assert len(got) and max(r[1] for r in got) == 1502
    assert sum(r[4] == 0 for r in got) == next(r[5] for r in got if r[1] == 0)


def test_pieces_of_ids_hash_as_one(spark, monkeypatch):
    monkeypatch.setattr(m, "PIECE", 10)
    ends = spark.createDataFrame([(s, c) for s in ("a", "b") for c in range(0, 3000, 7)], "sid string, conv_id long").repartition(3)
    want = hashlib.sha256(",".join(map(str, range(0, 3000, 7))).encode()).hexdigest()
    assert {r.sid: r.ends_sha256 for r in m.digests(ends).collect()} == {"a": want, "b": want}


def test_streamed_buckets(spark, monkeypatch):
    monkeypatch.setattr(m, "TOGETHER", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        rows = sample(5, 30)
        assert run(spark, rows, 5) == brute_force(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
