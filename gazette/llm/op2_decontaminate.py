"""Benchmark decontamination with a stored positional inverted index.

1. ``build_index`` turns the training texts into postings of all their words and stores them as a table: for each
   word and each block of documents (about BLOCK_BYTES of text) how many documents hold it, and its places in the block.
   The table is dealt by word and salt and sorted by word, so a frequent word is in many files and a lookup skips
   the row groups without its words. Texts are read once; any number of test sets is searched in the stored index.
2. The test items become windows of WINDOW consecutive words (a shorter item is one window), in a Spark job.
3. Document frequencies, summed from the postings, give each window the order in which its lists are intersected, rarest first.
4. ``search`` looks up the test terms alone and brings a block's postings together. The rarest term's list, less its offset in the
   window, gives the possible starts; those are intersected with the other
   terms' offset-adjusted lists. With ``slop`` 0 this is an exact phrase match; with slop s each
   term may be up to s words from its place (a proximity match).

Windows are searched in passes of at most PASS_WINDOWS, so what the driver and a task hold of them is bounded whatever the
size of the test sets, and a task holds the postings of one block and at most CANDIDATES starts at a time.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.shared import chunks, materialize, partitions, scratch_path, table

WINDOW = 10
#: Windows of test items in one pass over the index (about 1 kB each).
PASS_WINDOWS = 50_000
#: Starts that are intersected at a time.
CANDIDATES = 1_000_000
#: How far a term may be from its place in a proximity match.
SLOP = 2
#: Places between two documents of a block; windows must reach less far.
GAP = 64
#: A word's postings are dealt to so many partitions.
SALTS = 64
#: Text of a block of documents (a longer document is a block of its own).
BLOCK_BYTES = 8_000_000

#: Bytes of UTF-8 text: letters in lower case, what is no word as a space.
_FOLD = bytes(32 if b < 48 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 127 else b + 32 if 65 <= b <= 90 else b for b in range(256))

_ABOUT = "struct<rows: array<bigint>, doc_ids: array<bigint>, sizes: array<int>>"
POSTED = f"block long, term binary, n_docs int, places binary, about {_ABOUT}"
HITS = "row long, doc_id long, n_words long, hits array<int>, items array<string>, near_items array<string>"
WINDOWS = "words array<binary>, item string"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


# ----------------------------------------------------------------- the index


def post(words: list[pa.Array]) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """(terms, documents of each, places of each as differences of 32 bits) of a block's documents, each an array of its words."""
    sizes = np.array([len(w) for w in words], np.int64)
    coded = pa.concat_arrays([*words, pa.array([], pa.binary())]).dictionary_encode()
    term = coded.indices.to_numpy()
    base = np.cumsum(sizes + GAP) - sizes
    place = np.arange(len(term), dtype=np.int32) + np.repeat((base - (np.cumsum(sizes) - sizes)).astype(np.int32), sizes)
    document = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    order = np.argsort(term, kind="stable")
    term, place, document = term[order], place[order], document[order]
    first = np.diff(term, prepend=-1) != 0
    begin = np.flatnonzero(first)
    step = np.where(first, place, np.diff(place, prepend=0)).astype(np.int32)
    n_docs = np.add.reduceat((first | (np.diff(document, prepend=-1) != 0)).astype(np.int32), begin) if len(begin) else np.zeros(0, np.int32)
    ends = (np.append(begin, len(term)) * 4).astype(np.int32)
    places = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(step.tobytes())])
    return coded.dictionary.take(pa.array(term[begin])), n_docs, places


def build_index(df: DataFrame, path: str) -> str:
    """Stores the postings of all words of df(doc_id, text) at ``path``, and its blocks' documents; gives the path back.

    Every row is posted, whatever its doc_id; null and empty texts are documents without words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
        about = pa.struct([("rows", longs), ("doc_ids", longs), ("sizes", ints)])
        schema = pa.schema([("block", pa.int64()), ("term", pa.binary()), ("n_docs", pa.int32()), ("places", pa.binary()), ("about", about)])
        for piece, texts in chunks(batches, limit=BLOCK_BYTES):
            block += 1
            # As arrays, so that a block's words are never all objects at once.
            words = [pa.array(words_of(t), pa.binary()) for t in texts]
            terms, n_docs, places = post(words)
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(terms), pa.int64()), terms, pa.array(n_docs, pa.int32()), places, pa.nulls(len(terms), about)], schema=schema)
            own = {"rows": piece.column("row").to_pylist(), "doc_ids": piece.column("doc_id").to_pylist(), "sizes": [len(w) for w in words]}
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.array([own], about)], schema=schema)

    numbered = df.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Rows of blocks' documents have no term; the block deals them.
    keys = F.coalesce("term", F.col("block").cast("string").cast("binary")), F.pmod(F.xxhash64("block"), F.lit(SALTS))
    numbered.mapInArrow(run, POSTED).repartition(partitions(df.sparkSession), *keys).sortWithinPartitions("term", "block").write.parquet(path)
    return path


# --------------------------------------------------------------- test windows


class TestBlock:
    """Some windows of test items: their words, the items of each, and the order in which lists are intersected."""

    __test__ = False

    def __init__(self, windows: list[tuple[tuple[bytes, ...], list[str]]]):
        self.windows = [tuple(w) for w, _ in windows]
        self.items = [sorted(x) for _, x in windows]
        self.term = {w: i for i, w in enumerate(sorted({w for x in self.windows for w in x}))}

    def plan(self, frequency: dict[bytes, int]) -> None:
        """Orders each window's (offset, term) by how many documents hold the term, rarest first."""
        often = {i: frequency.get(w, 0) for w, i in self.term.items()}
        order = [sorted(enumerate(self.term[w] for w in x), key=lambda p: (often[p[1]], p)) for x in self.windows]
        width = max(map(len, order), default=0)
        # A short window repeats its first pair: intersecting twice changes nothing.
        padded = [x + x[:1] * (width - len(x)) for x in order]
        self.offsets = np.array([[p[0] for p in x] for x in padded], np.int64).reshape(len(order), width)
        self.terms = np.array([[p[1] for p in x] for x in padded], np.int64).reshape(len(order), width)
        self.lengths = np.array([len(x) for x in self.windows], np.int64)
        self.by_anchor = np.argsort(self.terms[:, 0], kind="stable") if width else np.zeros(0, np.int64)
        self.anchor_begin = np.searchsorted(self.terms[self.by_anchor, 0] if width else self.by_anchor, np.arange(len(self.term) + 1))


def test_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """words, items of every distinct window of benchmark(item_id, text). A window of items without id has no items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in chunks(batches):
            for item, text in zip(piece.column("item").to_pylist(), texts, strict=True):
                words = words_of(text)
                n = max(1, len(words) - window + 1) if words else 0
                for begin in range(0, n, 20_000):
                    made = [words[i : i + window] for i in range(begin, min(n, begin + 20_000))]
                    yield pa.RecordBatch.from_pydict({"words": pa.array(made, pa.list_(pa.binary())), "item": pa.array([item] * len(made), pa.string())})

    each = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(run, WINDOWS)
    return each.groupBy("words").agg(F.collect_set("item").alias("items"))


test_windows.__test__ = False


def passes(windows: DataFrame, limit: int) -> Iterator[TestBlock]:
    """The windows, by their hash, in blocks of about ``limit``; one block, maybe an empty one, at least."""
    n = windows.count()
    of = max(1, -(-n // limit))
    at = F.pmod(F.xxhash64("words"), F.lit(of))
    for i in range(of):
        yield TestBlock([(tuple(bytes(w) for w in r.words), r.items) for r in windows.where(at == i).collect()])


# ------------------------------------------------------------------- search


def _narrow(block: TestBlock, keys: np.ndarray, bits: int, slop: int, window: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    for j in range(1, block.terms.shape[1]):
        want = (block.terms[window, j] << bits) + start + block.offsets[window, j]
        at = np.searchsorted(keys, want - slop)
        ok = np.zeros(len(want), bool)
        inside = at < len(keys)
        ok[inside] = keys[at[inside]] <= want[inside] + slop
        window, start = window[ok], start[ok]
        if not len(window):
            break
    return window, start


def match(block: TestBlock, keys: np.ndarray, bits: int, slop: int = 0, limit: int = CANDIDATES) -> tuple[np.ndarray, np.ndarray]:
    """(windows, starts) of the matches. keys: sorted ``term << bits | place`` of the postings of many documents.

    With slop, one start for each document and window is enough and the places are those of the rarest term's.
    """
    first = np.searchsorted(keys, np.arange(len(block.term) + 1, dtype=np.int64) << bits)
    anchors = np.flatnonzero((np.diff(first) > 0) & (np.diff(block.anchor_begin) > 0))
    held: list[tuple[np.ndarray, np.ndarray]] = []
    found: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0

    def flush() -> None:
        nonlocal n
        if held:
            found.append(_narrow(block, keys, bits, slop, *(np.concatenate(x) for x in zip(*held, strict=True))))
            held.clear()
            n = 0

    for t in anchors.tolist():
        own = block.by_anchor[block.anchor_begin[t] : block.anchor_begin[t + 1]]
        places = keys[first[t] : first[t + 1]] & ((1 << bits) - 1)
        # A frequent anchor's windows and places are paired a part at a time.
        wide = max(1, limit // len(own))
        for at in range(0, len(places), wide):
            some = places[at : at + wide]
            held.append((np.repeat(own, len(some)), (some[None, :] - block.offsets[own, 0][:, None]).ravel()))
            n += len(own) * len(some)
            if n >= limit:
                flush()
    flush()
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))  # type: ignore[return-value]


def in_block(b: TestBlock, slop: int, terms: np.ndarray, counts: np.ndarray, steps: np.ndarray, sizes: np.ndarray) -> tuple[list, list, list]:
    """(hits, items, near items) of a block's documents. terms, counts: of each posting list; steps: their places' differences."""
    n = len(sizes)
    hits: list[np.ndarray] = [np.zeros(0, np.int32)] * n
    items: list[list[str]] = [[]] * n
    near_items: list[list[str]] = [[]] * n
    base = np.cumsum(sizes + GAP) - sizes
    bits = max(1, int(base[-1] + sizes[-1] + GAP).bit_length())
    total = np.cumsum(steps)
    begin = np.cumsum(counts) - counts
    keys = total - np.repeat(total[begin] - steps[begin], counts) if len(steps) else total
    keys += np.repeat(terms, counts) << bits
    keys.sort()
    exact = match(b, keys, bits)
    near = match(b, keys, bits, slop) if slop else exact
    for (w, s), is_exact in ((exact, True), (near, False)):
        doc = np.clip(np.searchsorted(base, s + slop, side="right") - 1, 0, n - 1)
        order = np.argsort(doc, kind="stable")
        cut = np.flatnonzero(np.diff(doc[order], prepend=-1))
        for group in np.split(order, cut[1:]) if len(order) else ():
            d = int(doc[group[0]])
            named = sorted({x for i in set(w[group].tolist()) for x in b.items[i]})
            if is_exact:
                length = b.lengths[w[group]]
                inner = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
                hits[d] = np.unique(np.repeat(s[group] - base[d], length) + inner).astype(np.int32)
                items[d] = named
            else:
                near_items[d] = named
    return hits, items, near_items


def search_pass(spark: SparkSession, path: str, block: TestBlock, slop: int) -> DataFrame:
    """HITS of every document of the index for the windows of one pass."""
    if max(map(len, block.windows), default=0) + 2 * slop >= GAP:
        raise ValueError(f"windows and slop reach over {GAP} words")
    index = spark.read.schema(POSTED).parquet(path)
    numbers = F.broadcast(spark.createDataFrame([(w, i) for w, i in block.term.items()], "term binary, number int"))  # at most WINDOW * PASS_WINDOWS
    terms = index.where("term is not null").select("block", "term", "n_docs", "places").join(numbers, "term")
    often = terms.groupBy("term").agg(F.sum("n_docs").alias("n"))  # no more rows than the pass has terms
    block.plan({bytes(r.term): r.n for r in often.collect()})
    shared = spark.sparkContext.broadcast(block)
    documents = index.where("term is null").select("block", F.lit(None).cast("int").alias("number"), "places", "about")
    lists = terms.select("block", "number", "places", F.lit(None).cast(_ABOUT).alias("about"))

    def find(postings: pa.Table) -> pa.Table:
        number = postings.column("number").to_numpy(zero_copy_only=False)
        about = postings.take(np.flatnonzero(np.isnan(number))).column("about").to_pylist()[0]
        held = postings.take(np.flatnonzero(~np.isnan(number)))
        raw = held.column("places").to_pylist()
        steps = np.frombuffer(b"".join(raw), np.int32).astype(np.int64)
        counts = np.array([len(x) // 4 for x in raw], np.int64)
        terms = held.column("number").to_numpy().astype(np.int64)
        sizes = np.array(about["sizes"], np.int64)
        hits, items, near = in_block(shared.value, slop, terms, counts, steps, sizes)
        strings = pa.list_(pa.string())
        made = {"row": pa.array(about["rows"], pa.int64()), "doc_id": pa.array(about["doc_ids"], pa.int64()), "n_words": pa.array(sizes), "hits": pa.array(hits, pa.list_(pa.int32())), "items": pa.array(items, strings), "near_items": pa.array(near, strings)}
        return pa.Table.from_pydict(made)

    return documents.unionByName(lists).groupBy("block").applyInArrow(find, HITS)


def search(spark: SparkSession, path: str, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP, pass_windows: int = PASS_WINDOWS) -> DataFrame:
    """row, doc_id, n_words, hits, items, near_items of every document of a stored index; no text is read."""
    windows = materialize(test_windows(benchmark, window), "test_windows")
    parts = [search_pass(spark, path, x, slop) for x in passes(windows, pass_windows)]
    if len(parts) == 1:
        return parts[0]
    # Each pass's row of a document meet; its arrays are no longer than the document.
    merge = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return functools.reduce(DataFrame.unionByName, parts).groupBy("row", "doc_id", "n_words").agg(merge("hits"), merge("items"), merge("near_items"))


def find_contamination(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP, pass_windows: int = PASS_WINDOWS, path: str | None = None) -> DataFrame:
    """doc_id, n_words, hits (word positions inside a match), items, near_items of every row of df.

    A null or empty text has no words. Repeated rows each get their own row. Test items without
    text are skipped; those without id hit words but are no items; items of one id count once. No test items: nothing is hit. Columns
    other than doc_id and text are ignored. ``path``: where the index is stored; a new scratch folder if not given.
    """
    spark = df.sparkSession
    at = build_index(df, path or scratch_path(spark, "index"))
    return search(spark, at, benchmark, window, slop, pass_windows).drop("row")


def report(found: DataFrame) -> DataFrame:
    n_hit = F.size("hits").cast("long")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    return report(find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def brute_force(text: str | None, items: list[tuple[str, str | None]], window: int = WINDOW) -> tuple[int, int, list[str]]:
    """(n_words, n_hit, items) by trying every window everywhere; for tests."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, found = split(text), set(), set()
    for item, t in items:
        own = split(t)
        length = min(window, len(own))
        windows = {tuple(own[i : i + length]) for i in range(len(own) - length + 1)} if own else set()
        for s in range(len(words) - length + 1) if own else ():
            if tuple(words[s : s + length]) in windows:
                hit.update(range(s, s + length))
                found.add(item)
    return len(words), len(hit), sorted(found)
