"""Links, history, similar titles, as-of joins and trends against brute force, in any order of arrival."""

import datetime as dt
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gazette.operators import asof, similar, trends
from gazette.streaming import parts

DAY = dt.timedelta(days=1)
START = dt.datetime(2023, 1, 1)
PARTS = "no string, bid struct<registered: timestamp, seq: long, amount: double>, award struct<opened: timestamp, seq: long, winner: string>"


def test_awards_in_any_order(spark, tmp_path):
    bid = lambda no, day, seq, amount: (no, (START + DAY * day, seq, amount), None)
    award = lambda no, day, seq, winner: (no, None, (START + DAY * day, seq, winner))
    batches = [
        [bid("a", 0, 1, 1.0), bid("b", 5, 2, 2.0), bid("c", 200, 3, None), (None, (START, 1, 1.0), None)],
        [award("a", 250, 9, "x"), award("d", 250, 10, "y")],
        [bid("a", 0, 7, 1.5), award("a", 250, 8, "old"), award("a", 250, 9, "x")],
        [],
    ]
    found = set()
    for i, order in enumerate(itertools.permutations(range(4))):
        if i not in (0, 11, 23):
            continue
        sink = parts.PartsSink(spark, f"{tmp_path}/t{i}", ["no"], ["bid", "award"], buckets=4)
        for n, b in enumerate(order):
            sink(spark.createDataFrame(batches[b], PARTS), n)
        sink(spark.createDataFrame(batches[order[-1]], PARTS), 3)  # the last one again, as after a failure
        linked = parts.link_awards(sink.current(), "2023-11-15").select("no", "state", "bid.amount", "award.winner", "lag_months")
        found.add(tuple(sorted(map(tuple, linked.collect()))))
        assert [tuple(r) for r in parts.months_to_ask(parts.link_awards(sink.current(), "2023-11-15")).collect()] == [("2023-01", 1)]
    assert len(found) == 1
    (rows,) = found
    assert [r[:4] for r in rows] == [("a", "awarded", 1.5, "x"), ("b", "overdue", 2.0, None), ("c", "open", None, None), ("d", "orphan", None, "y")]
    assert rows[0][4] == pytest.approx(8.22580645)


def test_prespec_links_from_both_sides(spark):
    bids = spark.createDataFrame([("b1", ["p1", "p2", None]), ("b2", ["p1"]), ("b3", None), ("b2", ["p1"])], "bid_no string, pre_nos array<string>")
    pres = spark.createDataFrame([("p1", ["b1", "b9"]), ("p3", ["b3"]), (None, ["b1"])], "pre_no string, bid_nos array<string>")
    found = sorted(map(tuple, parts.link_prespecs(bids, pres).collect()))
    assert found == [("b1", "p1", "both", True, True), ("b1", "p2", "bid", True, False), ("b2", "p1", "bid", True, True), ("b3", "p3", "prespec", True, True), ("b9", "p1", "prespec", False, True)]
    assert parts.link_prespecs(bids.limit(0), pres.limit(0)).count() == 0


LOG = "k string, valid timestamp, known timestamp, seq long, v string, gone boolean"


def shown(log, valid_at, known_at):
    out = {}
    for k, valid, known, seq, v, gone in sorted(set(log), key=lambda r: (r[1], r[2], r[3], r[4], r[5])):
        if valid <= valid_at and known <= known_at:
            out[k] = (k, valid, v, gone)  # later valid times win, then later knowledge
    return sorted(r[:3] for r in out.values() if not r[3])


@pytest.mark.parametrize("seed", range(2))
def test_history_as_a_recompute_from_the_log(spark, tmp_path, seed):
    rng = random.Random(seed)
    log = [(f"k{rng.randrange(4)}", START + DAY * rng.randrange(6), START + DAY * rng.randrange(12), rng.randrange(3), rng.choice("xyz"), rng.random() < 0.2) for _ in range(120)]
    sink = parts.HistorySink(spark, f"{tmp_path}/h{seed}", ["k"], "valid", "known", "seq", buckets=2)
    batches = [log[i::4] for i in range(4)]
    for n, rows in enumerate(batches):
        sink(spark.createDataFrame(rows, LOG), n)
    sink(spark.createDataFrame(batches[-1], LOG), 3)
    history = sink.current().cache()
    whole = parts.versions(spark.createDataFrame(log, LOG), ["k"], "valid", "known", "seq")
    order = history.columns
    assert sorted(map(tuple, history.collect()), key=repr) == sorted(map(tuple, whole.select(order).collect()), key=repr)
    for valid, known in [(0, 0), (3, 5), (5, 11), (2, 30), (9, 7)]:
        v, k = START + DAY * valid, START + DAY * known
        found = parts.point_in_time(history, ["k"], "valid", "known", F.lit(v), F.lit(k), F.col("gone")).select("k", "valid", "v")
        assert sorted(map(tuple, found.collect())) == shown(log, v, k)
        line = parts.timeline(history, ["k"], "valid", "known", F.lit(k)).collect()
        for key in {r.k for r in line}:
            own = sorted((r for r in line if r.k == key), key=lambda r: r.valid)
            assert [r.valid_to for r in own] == [*[r.valid for r in own[1:]], None]


def test_what_is_fetched_again_is_no_change(spark):
    log = [("k", START, START + DAY * d, 0, v, False) for d, v in [(0, "a"), (1, "a"), (2, None), (3, None), (4, "a")]]
    history = parts.versions(spark.createDataFrame([*log, log[0], (None, START, START, 0, "n", False)], LOG), ["k"], "valid", "known", "seq")
    assert history.count() == 5
    assert sorted((r.known, r.v) for r in parts.changes(history, ["k"], "valid", "known", "seq").collect()) == [(START, "a"), (START + DAY * 2, None), (START + DAY * 4, "a")]


def best_titles(this, last):
    out = []
    for id, org, kind, words in this:
        own, found = set(words or ()), []
        for other, org2, kind2, words2 in last:
            has = set(words2 or ())
            if own and has and org is not None and (org, kind) == (org2, kind2) and 4 * len(own & has) >= 3 * len(own | has):
                found.append((-len(own & has) / len(own | has), other))
        if found:
            s, other = min(found)
            out.append((id, other, -s, "strong" if s == -1 else "medium"))
    return sorted(out)


@pytest.mark.parametrize("lot", [20_000, 3])
def test_similar_titles_as_all_pairs(spark, monkeypatch, lot):
    monkeypatch.setattr(similar, "LOT", lot)
    monkeypatch.setattr(similar, "RANKED", 5)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(14)]
    base = [rng.sample(words, rng.randrange(1, 9)) for _ in range(12)]

    def made(n, at):
        rows = []
        for i in range(n):
            own = list(rng.choice(base))
            if rng.random() < 0.5:
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((at + i, rng.choice(["o1", "o1", "o2", None]), rng.choice(["x", "y"]), own))
        return [*rows, (at + n, "o1", "x", []), (at + n + 1, "o1", "x", None), rows[0]]

    schema = "id long, org string, kind string, words array<string>"
    this, last = made(120, 0), made(120, 1000)
    found = similar.last_years(spark.createDataFrame(this, schema), spark.createDataFrame(last, schema), ["org", "kind"], F.col("words"), "id")
    rows = sorted((r.id, r.last_id, r.similarity, r.tier) for r in found.collect())
    assert rows == best_titles(this, last) and {r[3] for r in rows} == {"strong", "medium"}
    assert similar.last_years(spark.createDataFrame([], schema), spark.createDataFrame(last, schema), ["org", "kind"], F.col("words"), "id").count() == 0


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("width", [asof.DAY, 3 * 3_600_000_000])
def test_as_of_with_ties_and_nulls(spark, strict, width):
    rng = random.Random(9)
    when = lambda: None if rng.random() < 0.05 else START + dt.timedelta(hours=rng.randrange(24 * 12))
    key = lambda: rng.choice(["a", "a", "a", "b", "c", None])
    left = [(key(), when(), i % 40) for i in range(150)]
    right = [(k, when(), rng.choice([None, 1, 2]), rng.choice([None, "x", "y"])) for k in (key() for _ in range(90)) if k != "c"]
    l = spark.createDataFrame([*left, *left[:9]], "k string, at timestamp, v int")
    r = spark.createDataFrame([*right, *right[:9]], "k string, at timestamp, seq int, v string")
    found = asof.as_of(l, r, ["k"], "at", "at", "seq", strict, width)
    assert found.columns == ["k", "at", "v", "found"]
    least = lambda x: (x is not None, x or 0 if not isinstance(x, str) else x)

    def last(k, at):
        own = [x for x in right if None not in (k, at, x[0], x[1]) and x[0] == k and (x[1] < at if strict else x[1] <= at)]
        return max(((x[1], x[2], x[3]) for x in own), key=lambda x: (x[0], least(x[1]), (x[2] is not None, x[2] or "")), default=None)

    expected = [(k, at, v, last(k, at)) for k, at, v in [*left, *left[:9]]]
    assert sorted(((x.k, x.at, x.v, x.found and tuple(x.found)) for x in found.collect()), key=repr) == sorted(expected, key=repr)
    assert asof.as_of(l, r.limit(0), ["k"], "at", "at", "seq").where("found is not null").count() == 0


def test_slopes_as_over_the_dense_table(spark):
    rng = random.Random(3)
    rows = [(rng.choice("abc"), rng.randrange(-3, 40), rng.choice([None, 0, 1, 5, 17])) for _ in range(200)] + [("once", 30, 2), ("zero", 4, 0), ("out", -1, 5)]
    found = {r.t: r for r in trends.slopes(spark.createDataFrame(rows, "t string, m int, n int"), ["t"], "m", "n", 2, 36).collect()}
    assert set(found) == {"a", "b", "c", "once", "zero"}
    for t, r in found.items():
        dense = np.zeros(36)
        for own, m, n in rows:
            if own == t and n and 2 <= m < 38:
                dense[m - 2] += n
        assert r.total == dense.sum() and r.active == (dense > 0).sum()
        assert r.slope == pytest.approx(np.polyfit(range(36), dense, 1)[0], abs=1e-9)
        assert r.relative is None if t == "zero" else r.relative == pytest.approx(r.slope / dense.mean())
    with pytest.raises(ValueError):
        trends.word_trends(spark.createDataFrame([(dt.date(2024, 1, 1), 1, ["a"])], "d date, n int, w array<string>"), F.col("w"), "d", "n")


def shuffled(spark):
    """MB written for shuffles so far."""
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty(30_000)
    found = sc.statusStore().executorList(True)
    return sum(found.apply(i).totalShuffleWrite() for i in range(found.size())) / 1e6


@pytest.mark.parametrize("block", [1000, 7])
def test_words_of_near_copies_are_not_shuffled_a_pair(spark, monkeypatch, block):
    monkeypatch.setattr(similar, "BLOCK", block)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that are too large for it
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))
    base = [word() for _ in range(1200)]
    made = lambda at: [(at + i, "o", "x", [word() if rng.random() < 0.05 else w for w in base]) for i in range(50)]
    this, last = made(0), made(1000)
    schema = "id long, org string, kind string, words array<string>"
    a, b = (spark.createDataFrame(x, schema) for x in (this, last))
    before = shuffled(spark)
    found = similar.last_years(a, b, ["org", "kind"], F.col("words"), "id").collect()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    written = shuffled(spark) - before
    assert sorted((r.id, r.last_id, r.similarity, r.tier) for r in found) == best_titles(this, last) and len(found) == 50
    # 100 sets of 12 kB; their 2,500 pairs have 60 MB of words.
    assert 0 < written < (8 if block == 1000 else 24)
