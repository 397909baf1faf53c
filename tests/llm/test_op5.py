import re

import duckdb
import pytest
from pyspark.sql import functions as F

from gazette.llm import op5_licences as m


def test_prefix_filter_holds_every_match():
    """What stays of a template without its anchors is under the threshold."""
    idf = {w: 1.0 + i % 7 for i, w in enumerate(m.vocabulary())}
    vectors = m.unit_templates(idf)
    for t in (0.3, 0.6, 0.9):
        words = set(m.anchors(vectors, idf, t))
        for _, _, v in vectors:
            assert sum(x * x for w, x in v.items() if w not in words) < t * t
    # Frequent words are no anchors, though a long template repeats them.
    idf |= dict.fromkeys(("the", "of", "or", "to", "and"), 1.0) | dict.fromkeys(("software", "license"), 12.0)
    assert not {"the", "of", "or", "to", "and"} & set(m.anchors(m.unit_templates(idf), idf, 0.6))


def test_pattern_of_anchors_is_their_alternation():
    words = ["a", "apache", "affero", "2.0", "2", "gnu"]
    found = re.compile(rf"(?<![a-z0-9])(?:{m.any_of(words)})(?![a-z0-9])")
    assert [w for w in (*words, "ap", "2.1", "200", "gnus", "xgnu", "b") if found.fullmatch(w)] == words
    assert [bool(found.search(t)) for t in ("the gnu.", "in 2.0,", "v2.0", "apach", "gnus 20")] == [True, True, False, False, False]


def test_headers_files_and_inheritance(spark):
    mit = "The MIT License\n\n" + m.TEMPLATES["MIT"][2] + ".\n\nTHE SOFTWARE IS PROVIDED AS IS."
    gpl = "\n".join(m.TEMPLATES["GPL-3.0"][1][i : i + 60] for i in range(0, 240, 60))
    rows = [
        ("LICENSE", mit),
        ("a/b/c.py", "# comment\n#   Licensed under the Apache License, Version 2.0.\ncode()"),
        ("a/b/d.py", "code()"),
        ("a/COPYING.txt", m.TEMPLATES["GPL-3.0"][1]),
        ("ab/x.py", "print(1)"),
        ("q/whole", "Released under the MIT License."),
        ("q/r/s/t", None),
        ("q/r/s/t", ""),
        (None, "nothing"),
        ("z/two", "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.\nReleased under the MIT License. \n" + "word " * 5000),
        ("z/wrapped", gpl),
        ("z/none", "the license of a driver, version of a story"),
        ("z/none", "the license of a driver, version of a story"),
    ]
    df = spark.createDataFrame([(i, p, t, "x", 1) for i, (p, t) in enumerate(rows)], "k int, p string, text string, row string, score int")
    out = {r.k: r for r in m.scan(df, F.col("p")).collect()}
    assert len(out) == len(rows)
    got = {k: (r.spdx, r.how, r.licence_dir) for k, r in out.items()}
    assert got[0] == ("MIT", "own", None)
    assert got[1] == ("Apache-2.0", "own", None)
    assert got[2] == ("GPL-3.0", "inherited", "a")
    assert got[3] == ("GPL-3.0", "own", None)
    assert got[4] == ("MIT", "inherited", "")
    assert got[6] == got[7] == ("MIT", "inherited", "q")
    assert got[8] == (None, None, None)
    assert got[9][1] == "own" and out[9].all_spdx == ["CC-BY-NC-4.0", "MIT"] and out[9].n_statements == 2
    assert got[10] == ("GPL-3.0", "own", None)
    # The wrapped notice is all that z/wrapped holds, so it is a licence file, though line ends cut some of its words.
    assert got[11] == got[12] == ("GPL-3.0", "inherited", "z")
    assert m.scan(df.limit(0), F.col("p")).count() == 0


def test_full_texts_of_any_name_and_statements_with_more_words(spark):
    mit = "MIT License\n\nCopyright (c) 2031 Ana Example\n\n" + m.TEMPLATES["MIT"][3].removeprefix("MIT License. ").replace("conditions: ", "conditions:\n\n")
    bsd = "Copyright 2030, The Authors\n\n" + m.TEMPLATES["BSD-3-Clause"][3]
    filler = [(f"pad/{i}/x", f"word{i} of the story and a software tale number {i} to be used") for i in range(300)]
    rows = [("a/terms.md", mit), ("a/b/code.py", "x = 1"), ("c/readme-legal", bsd), ("c/d.py", None), ("e/f", "Released under the MIT License. Copyright 2024 Jane Doe"), ("g/h", "Some words first. Licensed under the Apache License, Version 2.0. And more words that follow it here."), *filler]
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "k int, p string, text string")
    for times in (1, 8):  # the same shares in a larger table
        found = m.scan(df if times == 1 else df.withColumn("r", F.explode(F.sequence(F.lit(1), F.lit(times)))), F.col("p"))
        out = {r.k: (r.spdx, r.how) for r in found.where("k < 6").collect()}
        assert out == {0: ("MIT", "own"), 1: ("MIT", "inherited"), 2: ("BSD-3-Clause", "own"), 3: ("BSD-3-Clause", "inherited"), 4: ("MIT", "own"), 5: ("Apache-2.0", "own")}


def test_large_directory_tables_are_salted(spark, monkeypatch):
    rows = [("a/LICENSE", "Released under the MIT License."), *[(f"a/b/{i}", None if i % 2 else "text") for i in range(50)], ("z", "y")]
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "k int, p string, text string")
    one = sorted(map(tuple, m.scan(df, F.col("p")).select("k", "spdx", "how").collect()))
    monkeypatch.setattr(m, "BROADCAST_ROWS", -1)
    assert sorted(map(tuple, m.scan(df, F.col("p")).select("k", "spdx", "how").collect())) == one
    assert len(one) == len(rows) and one[1][1:] == ("MIT", "inherited")


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table_as_sql(spark, sf):
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '/root/testdata/{sf}/documents.parquet'")
    found = m.op5_licences(spark, f"/root/testdata/{sf}")
    expected = c.sql(m.ORACLE)
    assert sorted(expected.columns) == sorted(found.columns)
    key = lambda r: str(r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected.select(", ".join(found.columns)).fetchall(), key=key)


def test_columns_that_clash_in_any_case(spark):
    df = spark.createDataFrame([(1, "Released under the MIT License.", "x", "y", "z")], "doc_id long, text string, Path string, ROW string, extra string")
    out = m.scan(df, F.lit("a/b.md"))
    assert out.columns[:2] == ["doc_id", "extra"] and out.count() == 1
