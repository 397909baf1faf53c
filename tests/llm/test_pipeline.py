import random

import corpus_pipeline as p
import pyarrow as pa
from gazette.llm import op2_decontaminate as op2
from gazette.llm.op10_secrets import REDACTED
from gazette.llm.shared import BATCH_BYTES, materialize

from tests.llm.test_op3 import brute_force as near_brute_force


def test_stages_against_brute_force(spark, tmp_path):
    rng = random.Random(5)
    text = lambda n: " ".join(f"word{rng.randrange(3000)}a" for _ in range(n))
    bench = [(1, text(14)), (2, None), (3, text(4))]
    base = [text(120) for _ in range(12)]
    docs = [(i, t) for i, t in enumerate(base)]
    docs += [(20 + i, t + " tail end") for i, t in enumerate(base[:5])]
    docs += [(40, text(60) + " " + bench[0][1] + " " + text(60)), (41, text(100) + ' token = "0b96a8c8d79c4a5085c919698889f59b72ab7bb6" ' + text(20))]
    docs += [(50, None), (51, ""), (52, "too short"), (53, "same same same " * 60)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(d, t, "en", None, None if t is None else len(t)) for d, t in docs], columns).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in p.STAGES:
        out = materialize(stage(spark, at, str(tmp_path)), name)
        rows = {r.doc_id: r for r in out.collect()}
        if name != "pieces":
            assert out.columns == at.columns
        before = {r.doc_id: r.text for r in at.collect()}
        if name == "quality":
            assert set(rows) == set(before) - {50, 51, 52, 53}
        if name == "near_dedup":
            assert set(rows) == {d for d, _, _, kept in near_brute_force(sorted(before.items())) if kept}
        if name == "decontaminate":
            assert set(rows) == {d for d, t in before.items() if not op2.brute_force(t, bench)[1]}
        if name == "secrets":
            assert {d for d in before if rows[d].text != before[d]} == {41}
            assert REDACTED in rows[41].text and rows[41].n_chars == len(rows[41].text)
        if name == "pieces":
            assert set(rows) == set(before)
        at = out
    assert p.run(spark, str(tmp_path)).count() == 13
    assert len(p.STAGES) == 5


def test_null_and_repeated_ids_drop_by_row(spark, tmp_path):
    rng = random.Random(6)
    text = lambda n: " ".join(f"word{rng.randrange(3000)}a" for _ in range(n))
    a, b, c, d, e, item = (text(n) for n in (120, 120, 120, 120, 120, 14))
    leak = f"{text(60)} {item} {text(60)}"
    docs = [(1, a), (None, a), (None, b), (2, a), (2, c), (3, d), (3, d), (None, e), (None, e), (None, leak), (4, leak), (4, text(90))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    order = lambda rows: sorted(rows, key=str)
    kept = [tuple(r) for r in p.near_dedup(spark, df, str(tmp_path)).collect()]
    assert order(kept) == order([(1, a), (None, b), (2, c), (3, d), (None, e), (4, leak), docs[-1]])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [tuple(r) for r in p.decontaminate(spark, df, str(tmp_path)).collect()]
    assert order(clean) == order(x for x in docs if x[1] != leak)


def test_extra_columns_stay_whatever_their_names(spark, tmp_path):
    rng = random.Random(7)
    text = lambda n: " ".join(f"word{rng.randrange(3000)}a" for _ in range(n))
    item = text(14)
    docs = [(i, t, "en", "s", len(t), i, str(i), i * 2, "k") for i, t in enumerate([text(120), text(130), text(60) + " " + item + " " + text(50), text(110) + ' token = "0b96a8c8d79c4a5085c919698889f59b72ab7bb6" x'])]
    docs.append((9, docs[0][1], "en", "s", 1, 9, "9", 18, "k"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, _ROW long, _Quality string, _secrets long, SALT string")
    at = df
    for name, stage in p.STAGES[:-1]:
        at = materialize(stage(spark, at, str(tmp_path)), name)
        assert at.columns == df.columns, name
    got = {r.doc_id: r for r in at.collect()}
    assert set(got) == {0, 1, 3}
    assert all((r._ROW, r._Quality, r._secrets) == (i, str(i), i * 2) for i, r in got.items())


def test_arrow_batches_are_bounded_by_bytes(spark, tmp_path):
    """A batch is held in the executor's JVM and in its Python worker; a task's texts must not be one batch."""

    def sizes(batches):
        for x in batches:
            yield pa.RecordBatch.from_pydict({"n": [x.nbytes], "rows": [x.num_rows]})

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    text = " ".join(f"word{i}a" for i in range(1_000))
    large = spark.range(0, 3_000, 1, 1).selectExpr("id as doc_id", f"'{text}' as text")
    spark.conf.unset(key)
    try:
        p.pieces(spark, spark.createDataFrame([(1, text)], "doc_id long, text string"), str(tmp_path))
        found = large.mapInArrow(sizes, "n long, rows long").collect()
        assert sum(x.rows for x in found) == 3_000
        assert max(x.n for x in found) < 1.5 * BATCH_BYTES
        spark.conf.set(key, "1m")
        p.pieces(spark, spark.createDataFrame([(1, text)], "doc_id long, text string"), str(tmp_path))
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)
