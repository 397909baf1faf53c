"""Token-ID files: directly addressable codes (DAC).

An id is split into chunks of CHUNK_BITS bits. Level 0 holds the low chunk of
every token, level k the chunks of the tokens that need more than k chunks. Each
level has a bitmap (one bit a chunk: "the token goes on in the next level") and a
rank directory (set bits before each block of RANK_BLOCK bits). Token i's next
chunk is at ``rank(level, i)`` of the next level, so any token is read from a few
bytes, without decoding those before it.

A file holds documents in ascending doc_id order: header, levels, and the
offsets of its documents. Files are written inside tasks to the shared folder
under a temporary name and then renamed; a retried task writes the same bytes.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.llm.shared import AgingCache, chunks, materialize, partitions, scratch_path, table, with_text

MAGIC = b"GZDAC001"
CHUNK_BITS = 8
RANK_BLOCK = 512
#: Tokens after which a task closes a file and begins the next (bounds its memory).
FILE_TOKENS = 8_000_000
END_ID = 2
#: Bytes of text that are encoded in one call.
ENCODED_BYTES = 8_000_000


# ---------------------------------------------------------------- the format


def encode_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, bitmap, rank directory) of each level."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        low, rest = (rest & 0xFF).astype(np.uint8), rest >> CHUNK_BITS
        more = rest > 0
        padded = np.zeros(-(-len(more) // RANK_BLOCK) * RANK_BLOCK, np.uint8)
        padded[: len(more)] = more
        ranks = np.concatenate([[0], np.cumsum(padded.reshape(-1, RANK_BLOCK).sum(axis=1, dtype=np.uint64))]).astype(np.uint64)
        levels.append((low, np.packbits(padded, bitorder="little"), ranks))
        rest = rest[more]
        if not len(rest):
            return levels


def file_bytes(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    levels = encode_levels(ids)
    out = [MAGIC, struct.pack("<QQB", len(doc_ids), len(ids), len(levels))]
    known = np.array([x is not None for x in doc_ids], np.uint8)
    out += [np.array([x or 0 for x in doc_ids], np.int64).tobytes(), known.tobytes()]
    out.append(np.concatenate([[0], np.cumsum(lengths)]).astype(np.uint64).tobytes())
    for low, bits, ranks in levels:
        out += [struct.pack("<QQQ", len(low), len(bits), len(ranks)), low.tobytes(), bits.tobytes(), ranks.tobytes()]
    return b"".join(out)


class TokenFile:
    """Reads a file: ``token(i)`` touches a few bytes; ``document(k)`` gives one document's ids."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        self.n_docs, self.n_tokens, n_levels = struct.unpack_from("<QQB", data, 8)
        at = 25
        self.doc_id = np.frombuffer(data, np.int64, self.n_docs, at)
        at += 8 * self.n_docs
        self.known = np.frombuffer(data, np.uint8, self.n_docs, at).astype(bool)
        at += self.n_docs
        self.offset = np.frombuffer(data, np.uint64, self.n_docs + 1, at).astype(np.int64)
        at += 8 * (self.n_docs + 1)
        self.levels = []
        for _ in range(n_levels):
            n, n_bits, n_ranks = struct.unpack_from("<QQQ", data, at)
            at += 24
            low = np.frombuffer(data, np.uint8, n, at)
            bits = np.frombuffer(data, np.uint8, n_bits, at + n)
            ranks = np.frombuffer(data, np.uint64, n_ranks, at + n + n_bits)
            at += n + n_bits + 8 * n_ranks
            self.levels.append((low, bits, ranks))

    def rank(self, level: int, i: int) -> int:
        """Set bits of a level before i."""
        _, bits, ranks = self.levels[level]
        block = i // RANK_BLOCK
        first = block * RANK_BLOCK // 8
        part = np.unpackbits(bits[first : i // 8 + 1], bitorder="little")[: i - first * 8]
        return int(ranks[block]) + int(part.sum())

    def token(self, i: int) -> int:
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = 0
        for k, (low, bits, _) in enumerate(self.levels):
            value |= int(low[i]) << (CHUNK_BITS * k)
            if not bits[i // 8] >> (i % 8) & 1:
                break
            i = self.rank(k, i)
        return value

    def tokens(self, begin: int, end: int) -> np.ndarray:
        """The ids of a range, from the same directories."""
        value = np.zeros(end - begin, np.uint32)
        where = np.arange(end - begin)
        for k, (low, bits, _) in enumerate(self.levels):
            if begin == end:
                break
            value[where] |= low[begin:end].astype(np.uint32) << np.uint32(CHUNK_BITS * k)
            first = begin // 8
            more = np.unpackbits(bits[first : (end + 7) // 8], bitorder="little")[begin - first * 8 : end - first * 8].astype(bool)
            where, begin = where[more], self.rank(k, begin)
            end = begin + len(where)
        return value

    def document(self, k: int) -> np.ndarray:
        return self.tokens(int(self.offset[k]), int(self.offset[k + 1]))


# ------------------------------------------------------- encoding whole texts


#: Texts whose normal form and pre-tokens are known without the library: spaces, line ends, printable ASCII and the letters À to ÿ,
#: without the beginning of a special token. In their UTF-8 a byte from 0x80 only follows 0xC3.
_ASCII, _LETTERS = bytes([10, *range(32, 127)]), re.compile(rb"(?:\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])*")
_LOWER = bytes(b + 32 if 65 <= b <= 90 or 0x80 <= b <= 0x9E else b for b in range(256))
_SPACE, _LETTER, _DIGIT, _SIGN = range(4)
_KIND = bytes(_SPACE if b in b"\n " else _DIGIT if b in b"0123456789" else _LETTER if b > 127 or bytes([b]).isalpha() else _SIGN for b in range(256))


def is_plain(text: bytes) -> bool:
    return b"<|" not in text and _LETTERS.fullmatch(text.translate(None, _ASCII)) is not None


def plain_pretokens(texts: list[bytes]) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The lower-cased pre-tokens of plain texts by the tokenizer's own pattern, and how many come before each text and the end.

    A pre-token is a run of letters, a digit or a run of signs; but where one begins at an apostrophe
    and 's, 't, 're, 've, 'm, 'll or 'd follows, it is just that.
    """
    every = b"\n".join([*texts, b"", b""]).translate(_LOWER)
    kind, low = np.frombuffer(every.translate(_KIND), np.uint8), np.frombuffer(every, np.uint8)
    begins = kind == _DIGIT
    begins[0] = True
    begins[1:] |= kind[1:] != kind[:-1]
    quotes = np.flatnonzero(begins[:-2] & (low[:-2] == ord("'")))
    one, two = low[quotes + 1], low[quotes + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = np.isin(one.astype(np.uint16) << 8 | two, np.frombuffer(b"revell", ">u2"))
    begins[quotes[short | long] + 1] = False
    begins[quotes[short] + 2] = True
    begins[quotes[long] + 3] = True
    solid = every.translate(None, b"\n ")
    at = np.append(np.flatnonzero(begins[kind != _SPACE]), len(solid))
    pretokens = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(solid)])
    lengths = [len(x) - x.count(b" ") - x.count(b"\n") for x in texts]
    return pretokens, np.searchsorted(at, np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]))


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = itertools.count(256)
    return {b: chr(b if b in own else next(spare)) for b in range(256)}


# What a tokenizer file must say for texts to be cut into parts and pre-tokens here.
_SECTIONS = {
    "truncation": None,
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


def cuts_as_known(description: dict) -> bool:
    """Whether a tokenizer file normalizes and cuts texts as this module does; its special tokens must begin with ``<|`` and hold no space."""
    special = [x["content"] for x in description.get("added_tokens", []) if not x["normalized"] and not x["lstrip"] and not x["rstrip"]]
    known = len(special) == len(description.get("added_tokens", [])) and all(x.startswith("<|") and not re.search(r"\s", x) for x in special)
    return known and all(description.get(k) == v for k, v in _SECTIONS.items()) and not description["model"].get("dropout")


@functools.lru_cache(1)
def word_encoder(tokenizer_path: str) -> Callable[[list[bytes]], list[bytes]]:
    """Encodes texts with the tokenizers library to little-endian unsigned 32-bit ids.

    A plain text is in normal form but for its case. It is cut into pre-tokens, and each different one of a call goes to the
    library's model unless the Python worker, over all its tasks, still has its ids; cutting, telling different ones and
    placing their ids are numpy's and Arrow's. For other texts: this tokenizer never joins anything across a space or
    a line end (its pre-tokenizer drops white space and neither composition nor lower-casing looks across it), so a
    text's ids are those of its parts between them. Plain parts go on as plain texts, the others through the whole
    library. So do whole texts if the file's tokenizer cuts in another way.
    """
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path)
    with open(tokenizer_path, encoding="utf-8") as f:
        if not cuts_as_known(json.load(f)):
            return lambda texts: [np.array(x.ids, "<u4").tobytes() for x in library.encode_batch_fast([x.decode() for x in texts], add_special_tokens=False)]
    model, letters = library.model, {i: c for i, c in byte_letters().items() if i > 127}

    def encode_pretokens(words: list[bytes]) -> list[bytes]:
        spelled = [w.decode() if w.isascii() else w.decode("latin-1").translate(letters) for w in words]
        ids, cut = [], [0]
        for w in spelled:
            ids.extend([t.id for t in model.tokenize(w)])
            cut.append(4 * len(ids))
        raw = np.array(ids, "<u4").tobytes()
        return [raw[a:b] for a, b in itertools.pairwise(cut)]

    pretokens = AgingCache(encode_pretokens, 1_000_000)

    def encode_plain(texts: list[bytes]) -> list[bytes]:
        found, before = plain_pretokens(texts)
        coded = found.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        pretokens.fill(set(words))
        placed = pa.array([pretokens[w] for w in words], pa.large_binary()).take(coded.indices)
        _, ends, raw = placed.buffers()
        raw = memoryview(raw or b"")
        cut = np.frombuffer(ends, np.int64)[before].tolist() if len(found) else [0] * len(before)
        return [bytes(raw[a:b]) for a, b in itertools.pairwise(cut)]

    def encode_parts(parts: list[bytes]) -> list[bytes]:
        plain = [is_plain(x) for x in parts]
        easy = iter(encode_plain([*itertools.compress(parts, plain)]))
        odd = iter(library.encode_batch_fast([x.decode() for x, p in zip(parts, plain, strict=True) if not p], add_special_tokens=False))
        return [next(easy) if p else np.array(next(odd).ids, "<u4").tobytes() for p in plain]

    cache = AgingCache(encode_parts, 300_000)
    lines = bytes.maketrans(b"\n", b" ")

    def encode_odd(texts: list[bytes]) -> list[bytes]:
        parts = [x.translate(lines).split(b" ") for x in texts]
        cache.fill(set(itertools.chain.from_iterable(parts)))
        return [b"".join(map(cache.__getitem__, x)) for x in parts]

    def encode(texts: list[bytes]) -> list[bytes]:
        plain = [is_plain(x) for x in texts]
        easy = iter(encode_plain([*itertools.compress(texts, plain)]))
        odd = iter(encode_odd([x for x, p in zip(texts, plain, strict=True) if not p]))
        return [next(easy if p else odd) for p in plain]

    return encode


# ------------------------------------------------------------------- operator


def _store(path: str):
    """File system and path of a URI of the shared folder."""
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))


MANIFEST = "part int, file int, path string, n_docs long, n_tokens long"


def write_token_files(df: DataFrame, out: str, encoder: Callable[[], Callable[[list[bytes]], list[bytes]]], end_id: int | None = END_ID, n_partitions: int | None = None) -> DataFrame:
    """Writes the texts' ids under ``out`` in ascending doc_id order; a row for each file.

    ``encoder()`` is called in the task. Null doc_ids come first; rows of one doc_id are in
    the order of their text's hash. A null text is empty and holds just the end id.
    Needs the columns doc_id and text; others are ignored. The manifest is lazy:
    files are written when it is read, once for each read, under names of their own.
    """
    n = n_partitions or partitions(df.sparkSession)
    dealt = with_text(df, "doc_id").withColumn("tie", F.xxhash64("text")).repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    end = np.array([] if end_id is None else [end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encode = TaskContext.get().partitionId(), encoder()
        store, root = _store(out)
        store.create_dir(root, recursive=True)
        docs: list[int | None] = []
        ids: list[bytes] = []
        held = n_file = 0

        def close() -> pa.RecordBatch:
            lengths = np.array([len(x) // 4 for x in ids], np.int64)
            name = f"{root}/part-{part:06d}-{n_file:04d}-{uuid.uuid4().hex[:8]}.dac"
            with store.open_output_stream(name + ".tmp") as f:
                f.write(file_bytes(docs, lengths, np.frombuffer(b"".join(ids), "<u4")))
            store.move(name + ".tmp", name)
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": pa.array([n_file], pa.int32()), "path": [name], "n_docs": [len(docs)], "n_tokens": [int(lengths.sum())]})

        for piece, texts in chunks(batches, limit=ENCODED_BYTES):
            made = encode(texts)
            docs += piece.column("doc_id").to_pylist()
            ids += [x + end for x in made]
            held += sum(map(len, made)) // 4
            if held >= FILE_TOKENS:
                yield close()
                docs, ids, held, n_file = [], [], 0, n_file + 1
        if docs:
            yield close()

    return dealt.mapInArrow(write, MANIFEST)


def read_token_files(manifest: DataFrame, out: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32, read from the files."""
    # Parts first, a row for each task that wrote; then the files of a part, side by side with those of others.
    before = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens")).select("part", before(Window.orderBy("part")).alias("begin"))
    placed = manifest.withColumn("inside", before(Window.partitionBy("part").orderBy("file"))).join(parts, "part")
    spread = placed.select("path", (F.col("begin") + F.col("inside")).alias("base")).repartition(partitions(manifest.sparkSession), "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _store(out)
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                with store.open_input_file(path) as f:
                    found = TokenFile(f.read())
                ids = found.tokens(0, found.n_tokens).astype("<u4")
                raw, cut = memoryview(ids.tobytes()), found.offset
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(found.doc_id, mask=~found.known),
                        "start": pa.array(cut[:-1] + base),
                        "n_tokens": pa.array(np.diff(cut)),
                        "ids_crc32": pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in itertools.pairwise(cut.tolist())], pa.int64()),
                    }
                )

    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through the files: see the module text. Empty table: no rows."""
    import public_tokenizers

    model = public_tokenizers.path("word_bpe_49k.json")
    out = scratch_path(spark, "tokens")
    manifest = materialize(write_token_files(table(spark, sf_dir, "documents"), out, lambda: word_encoder(model)), "manifest")
    return read_token_files(manifest, out)
