"""Top competitors from monthly sketches: bounds against exact counts, late rows, nulls and ties."""

import random
from collections import Counter

import pytest

from gazette.operators import competitors as m
from gazette.plans import catalogue, relations  # noqa: F401 - registers the query

TRACKED = 48  # 64 places


@pytest.fixture(scope="module")
def awards():
    rng = random.Random(8)
    skewed = [("hot", rng.randrange(24), int(rng.paretovariate(1.1)) % 3000) for _ in range(30_000)]
    return skewed + [("flat", rng.randrange(24), rng.randrange(400)) for _ in range(4_000)] + [("few", rng.randrange(24), rng.randrange(30)) for _ in range(2_000)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "word string, month int, firm int").repartition(7)


def exact(rows, word, first, last):
    return Counter(f for w, t, f in rows if w == word and first <= t <= last)


def test_bounds_over_ranges(spark, awards):
    periods = {"all": (0, 23), "late": (17, 23), "one": (4, 4), "none": (90, 99)}
    late, soon = [r for i, r in enumerate(awards) if i % 5 == 0], [r for i, r in enumerate(awards) if i % 5]
    held = [m.month_sketches(frame(spark, x), ["word"], "month", "firm", TRACKED) for x in (soon, late)]
    found = m.top_items(held[0].unionByName(held[1]), ["word"], "month", periods, 10, TRACKED).collect()
    assert {r.period for r in found} == {"all", "late", "one"}
    for period, word in {(r.period, r.word) for r in found}:
        mine, truth = sorted((r for r in found if (r.period, r.word) == (period, word)), key=lambda r: r["rank"]), exact(awards, word, *periods[period])
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1)) and len(mine) <= 10
        error = mine[0].error
        assert error == sum(truth.values()) * 7 // 128
        assert all(truth[r["item"]] <= r.n <= truth[r["item"]] + error for r in mine)
        assert len(mine) == 10 or {f for f, n in truth.items() if n > 2 * error} <= {r["item"] for r in mine}
        assert all(n <= mine[-1].n for f, n in truth.items() if n > 2 * error and f not in {r["item"] for r in mine})
        if word == "few":  # fits the sketch
            assert [(r["item"], r.n) for r in mine] == sorted(truth.items(), key=lambda x: (-x[1], x[0]))[:10]


def test_months_merge_into_years(spark, awards):
    few = [r for r in awards if r[0] == "few"]
    months = m.month_sketches(frame(spark, few), ["word"], "month", "firm", TRACKED)
    years = m.merged(months.selectExpr("word", "cast(month div 12 as int) as year", "total", "sketch"), ["word", "year"], TRACKED)
    of = lambda df, at, periods: sorted(map(tuple, m.top_items(df, ["word"], at, periods, 5, TRACKED).collect()))
    assert of(years, "year", {"second": (1, 1)}) == of(months, "month", {"second": (12, 23)})


def test_nulls_ties_empty(spark):
    rows = [("a", 1, 2), ("a", 1, 1), ("a", None, 9), ("a", 1, None), (None, 1, 9), ("b", 3, 5), ("b", 3, 5)]
    held = m.month_sketches(frame(spark, rows), ["word"], "month", "firm")
    found = sorted(map(tuple, m.top_items(held, ["word"], "month", {"p": (1, 3), "q": (3, 3)}, 1).collect()))
    assert found == [("p", "a", 1, 1, 1, 0), ("p", "b", 1, 5, 2, 0), ("q", "b", 1, 5, 2, 0)]
    none = m.month_sketches(frame(spark, rows).limit(0), ["word"], "month", "firm")
    assert m.top_items(none, ["word"], "month", {"p": (1, 3)}).count() == 0


def test_texts_as_items(spark):
    df = spark.createDataFrame([("w", 1, "가나", 3), ("w", 1, "나다", 3), ("w", 2, "가나", 3)], "word string, month int, firm string, rank int")
    found = m.top_items(m.month_sketches(df, ["word"], "month", "firm"), ["word"], "month", {"p": (1, 2)}).collect()
    assert [(r["item"], r.n) for r in found] == [("가나", 2), ("나다", 1)]


def test_counts_are_exact_for_any_number_of_items(spark, awards):
    periods = {"all": (0, 23), "late": (17, 23), "none": (90, 99)}
    rows = [*awards, ("hot", None, 1), ("hot", 1, None), (None, 1, 1)]
    late, soon = [r for i, r in enumerate(rows) if i % 5 == 0], [r for i, r in enumerate(rows) if i % 5]
    held = [m.month_counts(frame(spark, x), ["word"], "month", "firm") for x in (soon, late)]
    found = m.top_counted(held[0].unionByName(held[1]), ["word"], "month", periods).collect()
    expected = []
    for period, word in [(p, w) for p in ("all", "late") for w in ("hot", "flat", "few")]:
        truth = exact(awards, word, *periods[period])
        top = sorted(truth.items(), key=lambda x: (-x[1], x[0]))[:10]
        expected += [(period, word, i + 1, firm, n, sum(truth.values())) for i, (firm, n) in enumerate(top)]
    assert sorted(map(tuple, found)) == sorted(expected)
    assert m.top_counted(held[0].limit(0), ["word"], "month", periods).count() == 0


def test_query_with_more_suppliers_than_a_sketch_holds(spark, tmp_path):
    import duckdb

    at = str(tmp_path)
    spark.createDataFrame([(0, "old bolt"), (1, "bolt bolt new"), (2, None)], "p_partkey long, p_name string").write.parquet(f"{at}/part.parquet")
    lines = spark.range(40_000).selectExpr("id % 3 as l_partkey", "nullif(id * 7 % 20011, 5) as l_suppkey", "timestamp '1995-12-15' + make_dt_interval(cast(id % 1500 as int)) as l_shipdate")
    lines.write.parquet(f"{at}/lineitem.parquet")
    found = sorted(tuple(r[c] for c in ("period", "word", "rank", "supplier", "n", "error")) for r in catalogue.QUERIES["ext_competitors_by_word"](spark, at).collect())
    c = duckdb.connect()
    for t in ("part", "lineitem"):
        c.sql(f"create view {t} as select * from '{at}/{t}.parquet/*.parquet'")
    assert found == sorted(c.sql(catalogue.ORACLES["ext_competitors_by_word"]).fetchall()) and len(found) == 90
