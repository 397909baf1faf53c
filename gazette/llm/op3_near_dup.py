"""Near-duplicate documents by a multi-index Hamming join of b-bit minwise signatures.

A document's set is that of its 5-word shingles. Its signature has SYMBOLS symbols of
16 bits (b = 16): the low bits of as many minwise hashes. Two signatures differ in a symbol with
a probability of about one minus their sets' similarity.

Multi-index: the signature is cut into CHUNKS chunks of 4 symbols. If two signatures differ in at most
2 * CHUNKS - 1 symbols, some chunk has at most one error (pigeonhole). All
chunks with at most one error are enumerated by leaving out each symbol in turn: 4 keys
a chunk, so every pair within that distance shares a key. Pairs beyond
it that share one are tested as well, none is discarded by distance. At a
similarity of 0.75 a pair shares no key with a probability of 1.5e-6.

Documents of equal sets are one node, so exact copies cost nothing. Then

1. every key with several nodes links them to its leader, the node with the most neighbours
   (the original of a group, as a rule), and these pairs are confirmed on the full sets;
2. components of the confirmed links;
3. only keys that still hold several components are left. A shingle that no other of their nodes has can't
   be in an intersection, and what two nodes share inside their leader's set is at most what either has in common
   with the leader; both bound the similarity of a node to another;
   pairs of different components within the bound are confirmed on the full sets, and join components.

A pair inside one component needs no test, so no group's pairs are ever all made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.llm.components import components
from gazette.llm.shared import Disposable, WordCache, chunks, fresh, materialize, table

SHINGLE = 5
#: Links have 100 * |intersection| >= PERCENT * |union|.
PERCENT = 75
CHUNKS = 10
SYMBOLS = 4 * CHUNKS
#: Bits of the filter that prunes documents before a shuffle, by the number of ids; what it lets through too much is dropped
#: later. Beyond the most (32 MB) it lets more through, which costs a shuffle and changes no result.
LEAST_BITS, MOST_BITS, BITS_AN_ID = 1 << 20, 1 << 28, 16
#: At 16 to 32 bits an id, 4 let 0.02 to 0.24 % of other ids through; one let 3 to 6 % through, each with its set of shingles.
FILTER_HASHES = 4

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_RNG = np.random.default_rng(3)
_XOR = _RNG.integers(0, 2**64, SYMBOLS, np.uint64)
_TIMES = _RNG.integers(0, 2**64, SYMBOLS, np.uint64) | np.uint64(1)
_ROLL = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_cache() -> WordCache:
    return WordCache(lambda words: [xxhash.xxh64_intdigest(w) for w in words], 300_000)


def shingle_sets(texts: list[bytes], cache: WordCache) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    split = [t.translate(_LOWER).split() for t in texts]
    cache.fill({w for x in split for w in x})
    out = []
    for words in split:
        h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
        width = min(SHINGLE, len(h))
        n = len(h) - width + 1 if width else 0
        s = np.full(n, width, np.uint64)
        for j in range(width):
            s = s * _ROLL + h[j : j + n]
        out.append(np.unique(mix(s)))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """uint16 symbols [set, SYMBOLS] of non-empty sets."""
    every = np.concatenate(sets)
    begin = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), SYMBOLS), np.uint16)
    for k in range(SYMBOLS):
        least = np.minimum.reduceat((every ^ _XOR[k]) * _TIMES[k], begin)
        out[:, k] = (least ^ (least >> np.uint64(32))).astype(np.uint16)
    return out


def probe_keys(symbols: np.ndarray) -> np.ndarray:
    """int64 keys [set, 4 * CHUNKS]: each chunk with each of its symbols left out."""
    packed = np.ascontiguousarray(symbols).view(np.uint64)  # a chunk of 4 symbols is 64 bits
    keys = np.empty((len(symbols), 4 * CHUNKS), np.int64)
    for c in range(CHUNKS):
        for d in range(4):
            rest = packed[:, c] & ~(np.uint64(0xFFFF) << np.uint64(16 * d))
            keys[:, 4 * c + d] = mix(rest * _ROLL + np.uint64(4 * c + d + 1)).view(np.int64)
    return keys


def digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def sign(df: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest (of the set; null if empty) and keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache()
        for piece, texts in chunks(batches):
            sets = shingle_sets(texts, cache)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys: list = [None] * len(sets)
            if full:
                for i, row in zip(full, probe_keys(signatures([sets[i] for i in full])), strict=True):
                    keys[i] = row
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": piece.column("doc_id"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "digest": pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                    "keys": pa.array(keys, pa.list_(pa.int64())),
                }
            )

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, digest binary, keys array<long>")


# --------------------------------------------------- pruning before shuffles


def _slots(ids: np.ndarray, size: int) -> np.ndarray:
    """FILTER_HASHES slots of each id: [hash, id]."""
    first = mix(ids.astype(np.int64).view(np.uint64))
    step = mix(first ^ _ROLL)
    return np.stack([((first + np.uint64(k) * step) % np.uint64(size)).astype(np.int64) for k in range(FILTER_HASHES)])


def filter_bits(n: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_AN_ID * n).bit_length()))


def id_filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of ids (one long column); MOST_BITS / 64 rows at most come to the driver."""
    size = filter_bits(ids.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_slots(batch.column(0).fill_null(0).to_numpy(), size))
            yield pa.RecordBatch.from_pydict({"word": at >> 6, "bits": np.left_shift(np.int64(1), at & 63)})

    found = ids.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out


def in_filter(bits: np.ndarray, ids: pa.Array) -> np.ndarray:
    at = _slots(ids.fill_null(0).to_numpy(zero_copy_only=False), 64 * len(bits))
    return ((bits[at >> 6] >> (at & 63)) & 1 == 1).all(axis=0)


def prune(df: DataFrame, bits: np.ndarray, inside: bool, key: str = "doc_id") -> DataFrame:
    """df's rows whose key may be (or can't be) in the filter."""
    shared = df.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_filter(shared.value, batch.column(key)) == inside))

    return df.mapInArrow(run, df.schema)


def full_sets(df: DataFrame, needed: DataFrame) -> DataFrame:
    """node, shingles of the classes in needed(first_doc, digest, node), from their whole texts."""
    shared = df.sparkSession.sparkContext.broadcast(id_filter(needed.select("first_doc")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache()

        def wanted():
            for batch in batches:
                yield batch.filter(pa.array(in_filter(shared.value, batch.column("doc_id"))))

        for _, texts in chunks(wanted()):
            sets = [s for s in shingle_sets(texts, cache) if len(s)]
            yield pa.RecordBatch.from_pydict({"digest": pa.array([digest(s) for s in sets], pa.binary()), "shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))})

    texts = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # One document of each class is enough; others of it that pass the filter hold the same set.
    return texts.mapInArrow(run, "digest binary, shingles array<long>").join(needed.select("digest", "node"), "digest").select("node", "shingles")


# ---------------------------------------------------------------- the join


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, common (elements of both full sets), linked of each pair (a, b)."""
    one = pairs.join(sets, pairs.b == sets.node).select("a", "b", F.col("shingles").alias("other"))
    both = one.join(sets, one.a == sets.node)
    counted = both.select("a", "b", F.size(F.array_intersect("shingles", "other")).alias("common"), (F.size("shingles") + F.size("other")).alias("total"))
    return counted.select("a", "b", "common", (100 * F.col("common") >= PERCENT * (F.col("total") - F.col("common"))).alias("linked"))


def may_link(shared, n_a, n_b):
    """Whether sets of n_a and n_b elements with at most ``shared`` in common can be linked."""
    return 100 * shared >= PERCENT * (n_a + n_b - shared)


def with_leaders(members: DataFrame) -> DataFrame:
    """Adds each key's leader and its set's size. members: key, node, n_shingles, n (nodes of the key)."""
    scored = members.join(members.groupBy("node").agg(F.sum("n").alias("score")), "node")
    leaders = scored.groupBy("key").agg(F.max(F.struct("score", "node", "n_shingles")).alias("top"))
    return members.join(leaders, "key").select("key", "node", "n_shingles", F.col("top.node").alias("leader"), F.col("top.n_shingles").alias("n_leader"))


def star_pairs(led: DataFrame) -> DataFrame:
    """(leader, node) for every key's nodes."""
    able = may_link(F.least("n_shingles", "n_leader"), F.col("n_shingles"), F.col("n_leader"))
    return led.where((F.col("node") != F.col("leader")) & able).select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()


def several(rows: DataFrame) -> DataFrame:
    """The rows of keys that hold more than one component."""
    keys = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return rows.join(keys.select("key"), "key")


def cross_pairs(led: DataFrame, tested: DataFrame, found: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components (ca, cb) that share a key and aren't ruled out by their sets' bounds.

    What two nodes have in common lies inside their key's leader or outside. Inside it is no more than either has
    in common with the leader (known from ``tested``), outside no more than either's shingles that any other node
    here has. A node that was too far in size from the leader to be tested has the second bound on its whole set.
    """
    labelled = led.join(found, "node", "left").select("key", "node", "n_shingles", "leader", "n_leader", F.coalesce("component", "node").alias("component"))
    rows = materialize(several(labelled), "mixed")
    own = rows.select("node").distinct()
    # What the filter lets through too much can only raise the bound. A join would shuffle the sets once more.
    shingles = prune(sets, id_filter(own), True, "node").select("node", F.explode("shingles").alias("shingle"))
    held = Window.partitionBy("shingle")
    common = shingles.withColumn("low", F.min("node").over(held)).withColumn("high", F.max("node").over(held)).where("low < high")
    bound = common.groupBy("node").agg(F.count("*").alias("shared"))
    able = rows.join(bound, "node").where(may_link(F.col("shared"), F.col("n_shingles"), F.col("shared")))
    common_with = tested.select(F.col("a").alias("leader"), F.col("b").alias("node"), "common")
    inside = F.when(F.col("node") == F.col("leader"), F.col("n_leader")).otherwise(F.col("common"))
    able = able.join(common_with, ["leader", "node"], "left").withColumn("inside", inside.cast("long")).drop("n_leader", "common")
    # One row a leader and node, so that a pair with many keys in common is made once and not for each.
    carried = ("node", "component", "n_shingles", "shared", "inside")
    rest = materialize(several(able).groupBy("leader", *carried).agg(F.collect_set("key").alias("keys")), "mixed_able")
    # A leader's largest component is only paired with the others, never with itself.
    sizes = rest.groupBy("leader", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("leader").agg(F.max(F.struct("n", "component")).getField("component").alias("largest"))
    marked = rest.join(largest, "leader")
    a = marked.where("component <> largest").select("leader", *[F.col(c).alias(f"{c}_a") for c in (*carried, "keys")])
    b = marked.select("leader", "largest", *[F.col(c).alias(f"{c}_b") for c in (*carried, "keys")])
    each_once = (F.col("component_b") == F.col("largest")) | (F.col("node_a") < F.col("node_b"))
    outside = F.least(F.col("shared_a") - F.col("inside_a"), F.col("shared_b") - F.col("inside_b"))
    most = F.least("shared_a", "shared_b", F.least("inside_a", "inside_b") + outside)
    # least() skips nulls; the bound holds only if both were tested.
    most = F.when(F.col("inside_a").isNull() | F.col("inside_b").isNull(), F.least("shared_a", "shared_b")).otherwise(most)
    within = may_link(most, F.col("n_shingles_a"), F.col("n_shingles_b"))
    pairs = a.join(b, "leader").where((F.col("component_a") != F.col("component_b")) & each_once & within & F.arrays_overlap("keys_a", "keys_b"))
    return pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), F.col("component_a").alias("ca"), F.col("component_b").alias("cb")).distinct()


def near_duplicates(df: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of df.

    Null, empty and wordless texts have no shingles and are alone. Equal rows share their component; a null
    doc_id is ignored as a component's smallest. An empty table gives none; columns
    other than doc_id and text are ignored. Lower case is that of A-Z.
    """
    signed = materialize(sign(df), "signatures")
    classes = signed.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("first_doc"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    probes = classes.select("node", "n_shingles", F.explode("keys").alias("key"))
    # A window and not a join with the counts, so that the keys, the widest table by far, are shuffled once.
    counted = probes.withColumn("n", F.count("*").over(Window.partitionBy("key"))).where("n > 1")
    members = materialize(with_leaders(materialize(counted, "members")), "led_members")
    needed = materialize(classes.select("first_doc", "digest", "node").join(members.select("node").distinct(), "node", "left_semi"), "needed")
    sets = materialize(full_sets(df, needed), "sets")
    tested = materialize(compare(star_pairs(members), sets), "tested")
    found = components(tested.where("linked"))
    pairs = materialize(cross_pairs(members, tested, found, sets), "cross")
    links = compare(pairs.select("a", "b"), sets).where("linked").join(pairs, ["a", "b"]).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    wider = components(links).select(F.col("node").alias("component"), F.col("component").alias("wide"))
    nodes = found.unionByName(wider.select(F.col("component").alias("node"), "component").join(found, "node", "left_anti"))
    nodes = nodes.join(wider, "component", "left").select("node", F.coalesce("wide", "component").alias("component"))
    named = nodes.join(classes.select("node", "first_doc"), "node")
    least = named.groupBy("component").agg(F.min("first_doc").alias("least"))
    labels = classes.select("node", "digest", "first_doc").join(named.select("node", "component").join(least, "component"), "node", "left")
    labels = labels.select("digest", F.coalesce("least", "first_doc").alias("label"))
    out = signed.select("doc_id", "n_shingles", "digest").join(labels, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("label"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """(df with a row number, its column's name), stored, so that all who read it see the same: doc_ids may be null or repeated."""
    row = fresh(df, "_row")
    return materialize(df.withColumn(row, F.monotonically_increasing_id()), "numbered_rows"), row


def by_row(rows: DataFrame, row: str) -> DataFrame:
    """The row numbers as doc_ids, and the texts."""
    return rows.select(F.col(row).alias("doc_id"), "text")


def without_rows(rows: DataFrame, row: str, dropped: DataFrame) -> DataFrame:
    """A numbered table without the rows whose number is in dropped's first column, and without the numbers.

    Most rows pass on a filter of the numbers alone and are never shuffled.
    """
    dropped = materialize(dropped.select(F.col(dropped.columns[0]).alias(row)).distinct(), "dropped")
    bits = id_filter(dropped)
    maybe = prune(rows, bits, True, row)
    return prune(rows, bits, False, row).unionByName(maybe.join(dropped, row, "left_anti").select(*[F.col(f"`{c}`") for c in rows.columns])).drop(row)


def keep_first(df: DataFrame) -> DataFrame:
    """df's rows, of each near-duplicate component only the one with the smallest doc_id; all columns stay, whatever their names.

    A null doc_id comes last; of rows with one doc_id in a component the first stays.
    """
    rows, row = numbered(df)
    with Disposable(df.sparkSession) as d:
        found = d.keep(near_duplicates(by_row(rows, row)).where("not kept").select(F.col("doc_id").alias("at"), "component_id"), "later_rows")
    # A component's label is its first row, which is kept.
    members = found.unionByName(found.select(F.col("component_id").alias("at"), "component_id").distinct())
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at")
    chosen = members.join(rows.select(F.col(row).alias("at"), "doc_id"), "at").groupBy("component_id").agg(F.min(order)["at"].alias("at"))
    return without_rows(rows, row, members.join(chosen.select("at"), "at", "left_anti").select("at"))


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))
