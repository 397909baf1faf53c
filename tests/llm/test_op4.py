import gc
import hashlib
import random
import time

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from gazette.llm.op4_pieces import MergeVocabulary, PieceCodec, digests, encode_decode, op4_pieces
from gazette.llm.shared import Lent

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "\n", "\n\n", " \n ", "a\nb", "a \n b", "\t x", "</s> <s> <unk> <0x0A>", "x▁y", "▁", "日本語 한국 😀", "é ́", "\0", "a\0b c", "\x01", "ééé", "zz" * 3000, "|" * 500, "the the  the   the    the", "a" * 70 + " b"]


def expected(text):
    ids = LIBRARY.encode(text, add_eos=True)
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


def test_odd_texts_as_the_library():
    codec = PieceCodec(MODEL)
    for text, (ids, decoded) in zip(ODD, codec.encode([x.encode() for x in ODD]), strict=True):
        want = LIBRARY.encode(text, add_eos=True)
        assert list(map(int, ids.split())) == want, text
        assert decoded.decode() == LIBRARY.decode(want), text
        assert codec.vocabulary.decode(want) == LIBRARY.decode(want), text


def test_random_texts_as_the_library():
    """With the check on: doubled, leading and trailing spaces, indented lines, words at the start of a line."""
    rng = random.Random(4)
    words = ["One.", " ", "  ", "    ", "\n", "\n    ", "The", "the", "end", "def f(x):", "return", "é", "日本", "😀", "▁", "\t", "\0", "x1", "...", "\r\n", "The end", "</s>"]
    codec = PieceCodec(MODEL)
    for begin in range(0, 20_000, 1_000):
        texts = ["".join(rng.choices("abcdeth  \n.,'é日▁😀01", k=rng.randrange(60))) for _ in range(500)]
        texts += ["".join(rng.choices(words, k=rng.randrange(16))) for _ in range(500)]
        for text, (ids, decoded) in zip(texts, codec.encode([x.encode() for x in texts]), strict=True):
            want = LIBRARY.encode(text, add_eos=True)
            assert list(map(int, ids.split())) == want, text
            assert decoded.decode() == LIBRARY.decode(want), text


def test_parts_are_kept_within_bytes():
    codec = PieceCodec(MODEL)
    codec.cache.most_bytes = 100_000
    for i in range(30):
        codec.encode([(f"{i}" + "q" * 20_000).encode()])
        assert codec.cache.held < 100_000 + 200_000


def test_new_parts_are_encoded_a_slice_at_a_time():
    """What the encoding takes for a moment doesn't grow with a chunk's new parts."""
    codec = PieceCodec(MODEL)
    sizes, ids_of_all = [], codec.vocabulary.ids_of_all
    codec.vocabulary.ids_of_all = lambda parts: sizes.append(len(parts)) or ids_of_all(parts)
    text = " ".join(f"w{i}" for i in range(30_000))
    ((ids, decoded),) = codec.encode([text.encode()])
    assert list(map(int, ids.split())) == LIBRARY.encode(text, add_eos=True)
    assert decoded.decode() == text
    assert sum(sizes) == 30_000 and max(sizes) <= 10_000


def test_difference_is_raised():
    codec = PieceCodec(MODEL)
    with pytest.raises(ValueError):
        codec.check(["▁a"], [[5]])


def test_nulls_ties_extra_columns(spark):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "the end", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = sorted(((r.doc_id or -1), r.n_tokens, r.ids_sha256) for r in digests(encode_decode(df, MODEL)).collect())
    assert found == sorted((d or -1, *expected(t or "")[:2]) for d, t, _ in rows)
    assert digests(encode_decode(df.limit(0), MODEL)).count() == 0


def test_whole_table_as_the_library(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = op4_pieces(spark, sf).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(texts[r.doc_id])


def test_vocabulary_is_cut_only_where_no_piece_reaches():
    assert all("\n" not in p for p in MergeVocabulary(MODEL).id)


def test_idle_workers_hold_no_codec(spark):
    """What a worker keeps after the stage counts against the executor while later stages run."""

    def held(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [sum(type(x).__name__ == "PieceCodec" for x in gc.get_objects())]})

    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string").coalesce(1)
    assert [x.n_tokens for x in encode_decode(df, MODEL).collect()] == [len(LIBRARY.encode("a b")) + 1]
    time.sleep(5)
    assert [x.n for x in df.mapInArrow(held, "n long").collect()] == [0]


def test_lent_values_are_kept_while_in_use():
    made = []
    lent = Lent(lambda key: made.append(key) or [key], 0.2)
    with lent.lend("a") as first:
        pass
    with lent.lend("a") as again, lent.lend("a") as inner:
        time.sleep(0.6)
        assert first is again is inner is lent.value and made == ["a"]
    with lent.lend("b") as other:
        assert other == ["b"]
    with pytest.raises(KeyError), lent.lend("b"):
        raise KeyError
    time.sleep(1)
    assert lent.value is None and made == ["a", "b"]
    with lent.lend("b") as other:
        assert other == ["b"] and made == ["a", "b", "b"]
