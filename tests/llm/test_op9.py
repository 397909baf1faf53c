import functools
import json
import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gazette.llm import op9_token_files as m
from gazette.llm.shared import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 700), max_size=60), max_size=40))
def test_round_trip_and_random_access(docs):
    ids = np.array([x for d in docs for x in d], np.uint32)
    f = m.TokenFile(m.file_bytes(list(range(len(docs))), np.array([len(d) for d in docs], np.int64), ids))
    assert f.tokens(0, len(ids)).tolist() == ids.tolist()
    assert [f.token(i) for i in range(len(ids))] == ids.tolist()
    assert [f.document(k).tolist() for k in range(len(docs))] == docs


def test_parts_as_whole_texts():
    odd = ["", " ", "a  b", "It's THE 'end'.", "x\ny", "W̊ é", " ́x", "a\vb\x1cc d e", "<|endoftext|>a<|startoftext|> b", "ΣΑΣ ΟΔΟΣ.", "日本 123 €5.…", "\0", "İI"]
    encode = m.word_encoder(PATH)
    for text, ids in zip(odd, encode([x.encode() for x in odd]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, text


def test_random_parts_as_whole_texts():
    rng = random.Random(9)
    texts = ["".join(rng.choices("abT'slmrevd 0\n.,!éÉßÿ×÷ªµ <|>_́ŵ", k=rng.randrange(40))) for _ in range(3000)]
    for text, ids in zip(texts, m.word_encoder(PATH)([x.encode() for x in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, text


def test_plain_texts_as_whole_texts():
    """Cut by plain_pretokens: short forms after an apostrophe, digits, runs of signs, ends of texts."""
    rng = random.Random(10)
    texts = ["'", "'s", "''s", "'sé 's's'", "I'LL'VE", "5's'r", "don't\n'Tis", "", "\n \n", "É'é", "a<b | c", "'re", "'r", "'l l", "À-ÿ!?12"]
    texts += ["".join(rng.choices("'stmdrevlLSaÉéß 5.-\n", k=rng.randrange(30))) for _ in range(4000)]
    assert all(m.is_plain(x.encode()) for x in texts)
    assert not any(m.is_plain(x.encode()) for x in ["<|", "×", "a÷", "\t", "ā", "µ", "日", "\x7f", "\0"])
    for text, ids in zip(texts, m.word_encoder(PATH)([x.encode() for x in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, text


def test_python_handles_different_pretokens_only(monkeypatch):
    """10,000 different parts of 100 words and a comma: as many look-ups, not one for each part."""
    asked, fill = [], m.AgingCache.fill
    monkeypatch.setattr(m.AgingCache, "fill", lambda self, words: (asked.append(len(words)), fill(self, words)))
    words = [a + b for a in "abcdefghij" for b in "klmnopqrst"]
    text = " ".join(f"{x},{y}" for x in words for y in words)
    (ids,) = m.word_encoder(PATH)([text.encode()])
    assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert sum(asked) <= 101


def test_ties_nulls_many_files(spark, monkeypatch):
    rows = [(3, "c c"), (1, None), (None, "n"), (2, ""), (3, "c c"), (3, "b")]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n_tokens int")
    out = scratch_path(spark, "t")
    manifest = m.write_token_files(df, out, lambda: m.word_encoder(PATH), n_partitions=3).cache()
    found = sorted(m.read_token_files(manifest, out).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, 1, 2, 3, 3, 3]
    assert [r.start for r in found] == np.concatenate([[0], np.cumsum([r.n_tokens for r in found])])[:-1].tolist()
    assert (found[1].n_tokens, found[1].ids_crc32) == (1, crc([2]))
    assert m.read_token_files(m.write_token_files(df.limit(0), out, lambda: m.word_encoder(PATH)), out).count() == 0


def test_query_as_the_library(spark):
    sf = "/root/testdata/sf0.001"
    start = 0
    texts = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    found = sorted(m.op9_token_files(spark, sf).collect())
    for (doc_id, text), r in zip(texts, found, strict=True):
        ids = [*LIBRARY.encode(text, add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(ids), crc(ids))
        start += len(ids)


def test_places_of_many_files(spark):
    """Starts of files that were closed by size, over parts without any file."""
    out = scratch_path(spark, "t")
    manifests = []
    for part, files in ((0, 3), (2, 1), (11, 5), (12, 2)):
        df = spark.createDataFrame([(100 * part + i, "a b " * (part + i)) for i in range(files)], "doc_id long, text string")
        written = m.materialize(m.write_token_files(df, out, lambda: m.word_encoder(PATH), n_partitions=files), "manifest")
        manifests.append(written.selectExpr(f"{part} as part", "part as file", "path", "n_docs", "n_tokens"))
    manifest = functools.reduce(lambda a, b: a.unionByName(b), manifests)
    found = sorted(m.read_token_files(manifest, out).collect())
    assert [r.start for r in found] == np.concatenate([[0], np.cumsum([r.n_tokens for r in found])])[:-1].tolist()
    assert len(found) == 11


def test_another_tokenizer_goes_through_its_library(tmp_path):
    other = json.load(open(PATH))
    assert m.cuts_as_known(other)
    other["normalizer"]["normalizers"].pop()  # no lower-casing
    path = str(tmp_path / "other.json")
    json.dump(other, open(path, "w"))
    assert not m.cuts_as_known(other)
    texts = ["The End  of\nÉté", "", "a"]
    library = Tokenizer.from_file(path)
    assert [np.frombuffer(x, "<u4").tolist() for x in m.word_encoder(path)([t.encode() for t in texts])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_very_long_text(spark):
    text = "lorem ipsum 12 " * 200_000
    df = spark.createDataFrame([(1, text), (2, "a")], "doc_id long, text string")
    out = scratch_path(spark, "t")
    found = sorted(m.read_token_files(m.materialize(m.write_token_files(df, out, lambda: m.word_encoder(PATH)), "manifest"), out).collect())
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert (found[0].n_tokens, found[0].ids_crc32, found[1].start) == (len(ids) + 1, crc([*ids, 2]), len(ids) + 1)
