"""Last year's notice by title: a set-similarity join inside an organization and category.

Titles' words are read three times: to count them, to hash each title's first ones, and, of the titles that are left, to compare them
whole. Between these only hashes are stored and shuffled, a quarter of a title's words or less. Pairs that share enough of their first words are
brought together by what they are linked to, so that a title's words are shuffled about once and not once a pair.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.sources.stores import scratch

#: Counts by which words are ordered from the rarest on; a word is counted with all whose hash has its remainder.
RANKED = 1 << 18
#: Titles of one organization, category and word that meet in one task; more are dealt to several.
LOT = 20_000
#: Parts that the rows of one title are dealt to when they get its match.
SALTS = 8
#: First words that two similar titles share at least, or all that they share if those are fewer.
SHARED = 4
#: Different titles of either side that are compared in one task; linked ones beyond that are dealt to several.
BLOCK = 1000
#: Bits of the filter that prunes rows before a shuffle, an id and at most; beyond that it lets more rows through.
BITS_AN_ID, MOST_BITS, FILTER_HASHES = 16, 1 << 28, 4

_HASH_BITS = 47


def _least(n: Column, num: int, den: int) -> Column:
    """ceil(num * n / den): the fewest words that are num / den of n."""
    return F.floor((n * num + (den - 1)) / den)


def _digest(body: Column) -> Column:
    return F.unhex(F.sha2(body, 256))


def _hash(by: Sequence[str], word: Column) -> Column:
    return F.xxhash64(*by, word)


def _ranks(sides: Sequence[DataFrame], by: Sequence[str], words: Column) -> np.ndarray:
    """How often words of each remainder occur, on a scale of logarithms. Any order gives the same matches; this one makes few candidates."""
    buckets = RANKED
    each = [x.select(*by, F.explode(words).alias("word")).select(F.pmod(_hash(by, F.col("word")), F.lit(buckets)).alias("bucket")) for x in sides]
    found = each[0].unionAll(each[1]).groupBy("bucket").agg(F.count("*").alias("n")).toArrow()
    counts = np.zeros(buckets)
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return (np.log2(counts + 1) * 1024).astype(np.uint64)  # 16 bits


def titles(df: DataFrame, by: Sequence[str], words: Column, id: str, ranks: np.ndarray, num: int, den: int) -> DataFrame:
    """A row a title: by, id, digest (of its set of words), sid (a hash of it), n words and tokens.

    ``tokens`` are a hash of each of its first words, from the rarest on: of two titles with T words in common or more, the SHARED first of these (all, if T is less)
    are among the first n - T + SHARED of either. A token that stands for two words makes candidates, it loses none.
    """
    rows = df.select(*by, F.col(id).alias("id"), F.array_distinct(words).alias("words"))
    for c in by:
        rows = rows.where(F.col(c).isNotNull())
    digest = _digest(F.to_json(F.array_sort("words"))).alias("digest")
    rows = rows.select(*by, "id", digest, F.transform("words", lambda w: _hash(by, w)).alias("hashes"))
    rows = rows.select(*by, "id", "digest", F.hash(*by, "digest").alias("sid"), "hashes")  # short, as pairs of them are shuffled; two sets may share one
    kept = rows.columns[:-1]
    schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField("n", T.LongType()), T.StructField("tokens", T.ArrayType(T.LongType()))])
    shared, most = df.sparkSession.sparkContext.broadcast(ranks), SHARED
    low = np.uint64((1 << _HASH_BITS) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        for batch in batches:
            batch = batch.filter(pc.greater(pc.fill_null(pc.list_value_length(batch.column("hashes")), 0), 0))
            n = pc.list_value_length(batch.column("hashes")).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = batch.column("hashes").flatten().to_numpy(zero_copy_only=False)
            tokens = ((ranks[np.mod(flat, len(ranks))] << np.uint64(_HASH_BITS)) | (flat.view(np.uint64) & low)).view(np.int64)
            least = (n * num + (den - 1)) // den
            take = n - least + np.minimum(most, least)
            ends = np.cumsum(n)
            first = [np.sort(tokens[begin:end])[:k] for begin, end, k in zip(ends - n, ends, take)]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(take)]), pa.int32()), pa.array(np.concatenate(first) if first else [], pa.int64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(n), lists], names=[*kept, "n", "tokens"])

    return rows.mapInArrow(run, schema)


def _sets(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """A row a distinct set of words of a group, with its smallest id."""
    return rows.groupBy(*by, "digest").agg(F.min("id").alias("id"), F.min("sid").alias("sid"))


def _lots(rows: DataFrame) -> DataFrame | None:
    """token, lots of the tokens that over LOT titles start with; LOT times as many rows as that at least have been counted."""
    token = rows.select(F.explode("tokens").alias("token"))
    bucket = F.pmod("token", F.lit(RANKED)).alias("bucket")
    large = [r[0] for r in token.groupBy(bucket).agg(F.count("*").alias("m")).where(F.col("m") > LOT).collect()]  # RANKED numbers at most
    if not large:
        return None
    counted = token.where(bucket.isin(large)).groupBy("token").agg(F.count("*").alias("m")).where(F.col("m") > LOT)
    return counted.select("token", F.ceil(F.col("m") / LOT).cast("int").alias("lots"))


def candidates(this: DataFrame, last: DataFrame, num: int, den: int) -> DataFrame:
    """sid, sid_last of all pairs of ``titles`` that share enough of their first words.

    Tokens that too many titles start with are dealt to several tasks, so no group meets in one. Repeated titles are one row behind the shuffle.
    """
    large = _lots(last)
    spot = ["token"] if large is None else ["token", "lot"]

    def postings(rows: DataFrame, suffix: str, lot) -> DataFrame:
        each = rows.select("sid", "n", F.posexplode("tokens").alias("at", "token"))
        each = each if large is None else each.join(F.broadcast(large), "token", "left").withColumn("lot", lot(F.coalesce("lots", F.lit(1))))
        packed = F.shiftleft("n", 32).bitwiseOR(F.col("at").cast("long")).alias("packed")  # so that less is shuffled
        once = each.select(*spot, "sid", packed).repartition(*spot).dropDuplicates()
        return once.select(*spot, F.col("sid").alias(f"sid{suffix}"), F.shiftright("packed", 32).alias(f"n{suffix}"), F.col("packed").bitwiseAND(F.lit(0xFFFFFFFF)).alias(f"at{suffix}"))

    a = postings(this, "", lambda lots: F.explode(F.sequence(F.lit(0), lots - 1)))
    b = postings(last, "_last", lambda lots: F.pmod(F.xxhash64("sid"), lots).cast("int"))
    least = _least(F.col("n") + F.col("n_last"), num, num + den)
    enough = F.least(least, F.lit(SHARED))
    near = (F.col("at") < F.col("n") - least + enough) & (F.col("at_last") < F.col("n_last") - least + enough)
    met = a.join(b, spot).where(_fits(num, den) & near).withColumn("enough", enough)
    return met.groupBy("sid", "sid_last").agg(F.count("*").alias("m"), F.min("enough").alias("enough")).where("m >= enough").select("sid", "sid_last")


def _fits(num: int, den: int) -> Column:
    return F.least("n", "n_last") * den >= F.greatest("n", "n_last") * num


def _among(df: DataFrame, id: str, wanted: DataFrame) -> DataFrame:
    """df's rows whose id may be in the column of ``wanted``: by a Bloom filter, so that the others' words are neither made nor shuffled."""
    size = min(MOST_BITS, 1 << (BITS_AN_ID * wanted.count() + 63).bit_length())
    slots = lambda c: F.array(*[F.pmod(F.xxhash64(F.lit(k), c), F.lit(size)) for k in range(FILTER_HASHES)])
    slot = wanted.select(F.explode(slots(F.col(wanted.columns[0]))).alias("slot"))
    found = slot.groupBy(F.floor(F.col("slot") / 64).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.int64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy()
    shared, n = df.sparkSession.sparkContext.broadcast(bits), FILTER_HASHES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
            hit = ((shared.value[at >> 6] >> (at & 63)) & 1 == 1).all(axis=1)
            yield batch.filter(pa.array(hit)).select(range(batch.num_columns - 1))

    return df.select("*", slots(F.col(id)).alias("_slots")).mapInArrow(run, df.schema)


def _homes(pairs: DataFrame) -> DataFrame:
    """The pairs with a home, where both are compared: the least title that a neighbour of sid_last is linked to, and a lot of BLOCK titles of either side.

    Each sid_last has one home (a lot of ``this`` aside), and what is linked closely has the same.
    """
    low = pairs.groupBy("sid").agg(F.min("sid_last").alias("low"))
    label = pairs.join(low, "sid").groupBy("sid_last").agg(F.min("low").alias("label"))
    out = pairs.join(label, "sid_last")
    for c, lot in (("sid", "lot"), ("sid_last", "lot_last")):
        large = out.select("label", c).distinct().groupBy("label").agg(F.count("*").alias("m")).where(F.col("m") > BLOCK)
        out = out.join(large.select("label", F.ceil(F.col("m") / BLOCK).cast("int").alias("lots")), "label", "left")
        out = out.withColumn(lot, F.pmod(F.hash(F.lit(0), c), F.coalesce("lots", F.lit(1)))).drop("lots")
    return out


_HOME = ["label", "lot", "lot_last"]


def _whole(df: DataFrame, by: Sequence[str], words: Column, id: str, sets: DataFrame, homes: DataFrame, sid: str) -> DataFrame:
    """home, is_last, sid, by, digest, id, body (the words as JSON): the sets of one side, at each of their homes."""
    wanted = homes.select(*_HOME, F.col(sid).alias("sid")).distinct().join(sets, "sid")
    rows = _among(df, id, wanted.select("id").distinct()).select(*by, F.to_json(F.array_sort(F.array_distinct(words))).alias("body"))
    rows = rows.select(*by, _digest(F.col("body")).alias("digest"), "body")
    return rows.join(wanted, [*by, "digest"]).select(*_HOME, F.lit(sid == "sid_last").alias("is_last"), "sid", *by, "digest", "id", "body")


def compared(homes: DataFrame, sets: DataFrame, by: Sequence[str], num: int, den: int) -> DataFrame:
    """by, digest, last_id, similarity of the pairs whose intersection / union >= num / den, by their whole words."""
    fields = [*[sets.schema[c] for c in (*by, "digest")], T.StructField("last_id", sets.schema["id"].dataType), T.StructField("similarity", T.DoubleType())]
    schema, key = T.StructType(fields), [*by, "digest"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        number: dict = {}
        held: dict = defaultdict(list)
        seen = set()
        keys = list(zip(*[right.column(c).to_pylist() for c in key]))
        for i, (is_last, sid, body) in enumerate(zip(*[right.column(c).to_pylist() for c in ("is_last", "sid", "body")])):
            if (is_last, keys[i]) not in seen:
                seen.add((is_last, keys[i]))
                held[is_last, sid].append((i, np.array([number.setdefault(w, len(number)) for w in json.loads(body)], np.int32)))
        linked = defaultdict(list)
        for a, b in zip(left.column("sid").to_pylist(), left.column("sid_last").to_pylist()):
            linked[a].append(b)
        inside = np.zeros(len(number), np.bool_)
        at, at_last, similarity = [], [], []
        for a, others in linked.items():
            for i, own in held[False, a]:
                inside[own] = True
                for b in others:
                    for j, words in held[True, b]:
                        s = int(np.count_nonzero(inside[words]))
                        union = len(own) + len(words) - s
                        if keys[i][:-1] == keys[j][:-1] and s * den >= union * num:
                            at.append(i)
                            at_last.append(j)
                            similarity.append(s / union)
                inside[own] = False
        at, at_last = pa.array(at, pa.int64()), pa.array(at_last, pa.int64())
        return pa.Table.from_arrays([*[right.column(c).take(at) for c in key], right.column("id").take(at_last), pa.array(similarity, pa.float64())], names=[*key, "last_id", "similarity"])

    own = homes.select(*[F.col(c).alias(c) for c in homes.columns])  # other columns than those in sets
    return own.groupBy(*_HOME).cogroup(sets.groupBy(*_HOME)).applyInArrow(run, schema)


def last_years(this: DataFrame, last: DataFrame, by: Sequence[str], words: Column, id: str, num: int = 3, den: int = 4) -> DataFrame:
    """Rows of ``this`` that have a similar title in ``last`` (intersection / union >= num / den, both compared exactly), with the best one:
    ``last_id``, ``similarity``, ``tier`` (strong: the same words).

    The best is the most similar, then that of the smallest id. Rows with a null in ``by``, or without a word, have none. Repeated
    titles are compared once, and each row of them gets the match; one that has the same words in ``last`` is compared with no other.
    """
    by, spark, at = list(by), this.sparkSession, scratch(this.sparkSession)

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{at}/{name}")
        return spark.read.schema(df.schema).parquet(f"{at}/{name}")

    ranks = _ranks((this, last), by, words)
    rows, rows_last = (stored(titles(x, by, words, id, ranks, num, den), name) for x, name in ((this, "this"), (last, "last")))
    key = [*by, "digest"]
    a, b = _sets(rows, by), _sets(rows_last, by)
    same = a.select(*key).join(b.select(*key, F.col("id").alias("last_id")), key).select(*key, "last_id", F.lit(1.0).alias("similarity"))
    rest = a.join(b.select(*key), key, "left_anti")
    pairs = stored(candidates(rows, rows_last, num, den).join(rest.select("sid").distinct(), "sid", "left_semi"), "pairs")
    homes = stored(_homes(pairs), "homes")
    sets = _whole(this, by, words, id, rest, homes, "sid").unionByName(_whole(last, by, words, id, b, homes, "sid_last"))
    near = compared(homes, sets, by, num, den)
    best = near.groupBy(*key).agg(F.min_by(F.struct("last_id", "similarity"), F.struct(-F.col("similarity"), F.col("last_id"))).alias("best"))
    best = best.unionByName(same.select(*key, F.struct("last_id", "similarity").alias("best")))
    salted = best.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    each = rows.select(*key, F.col("id").alias(id)).withColumn("salt", F.pmod(F.xxhash64(id), F.lit(SALTS)).cast("int"))
    found = each.join(salted, [*key, "salt"]).select(id, *by, F.col("best.last_id").alias("last_id"), F.col("best.similarity").alias("similarity"))
    return found.withColumn("tier", F.when(F.col("similarity") == 1, "strong").otherwise("medium"))
