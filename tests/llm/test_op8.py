import zlib

import numpy as np

from gazette.llm import op8_toxicity as m


def brute_force(text, weights, bias):
    """The score from Python sets of n-grams, one at a time."""
    cache = m.word_cache()
    raw = (text or "").encode()
    _, bucket = m.features([raw], cache)
    return 1 / (1 + np.exp(-(bias + sum(weights[b] for b in set(bucket.tolist())))))


def test_rows(spark):
    rng = np.random.default_rng(1)
    at = np.unique(rng.integers(0, m.BUCKETS, 200_000))
    model = np.concatenate([[-1], at]), np.concatenate([[-1.5], rng.normal(size=len(at))])
    weights = np.zeros(m.BUCKETS)
    weights[at] = model[1][1:]
    rows = [(1, None), (2, ""), (3, "One word"), (3, "One word"), (None, "you scum, You SCUM"), (5, "é ü word " * 30_000), (6, "...")]
    df = spark.createDataFrame([(d, t, 0.0) for d, t in rows], "doc_id long, text string, score double")
    out = m.score(df, model).collect()
    assert len(out) == len(rows)
    expected = {(d, round(brute_force(t, weights, -1.5), 9)) for d, t in rows}
    assert {(r.doc_id, round(r.score, 9)) for r in out} == expected
    assert all(r.predicted == int(r.score >= 0.3) for r in out)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert m.score(df.limit(0), model).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert m.score(df, m.fit(m.training_rows(df, none))).count() == len(rows)


def test_held_out_labels_are_not_used(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    a = m.fit(m.training_rows(docs, labels))
    flipped = labels.withColumn("toxic", m.F.when(m.held_out(m.F.col("doc_id")), 1 - m.F.col("toxic")).otherwise(m.F.col("toxic")))
    b = m.fit(m.training_rows(docs, flipped))
    assert all((x == y).all() for x, y in zip(a, b, strict=True))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = m.op8_toxicity(spark, sf).where("held_out").join(labels, "doc_id").select("score", "toxic").collect()
    toxic, clean = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    auc = np.mean([np.mean(np.array(clean) < s) for s in toxic])
    assert auc > 0.93
    assert np.mean(np.array(clean) < m.THRESHOLD) > 0.98
