"""A prefix trie of conversations by distributed MSD radix partitioning.

1. Turns are dictionary-encoded: each different (role, text) gets a number, so a conversation is a sequence of numbers.
2. All conversations are one bucket. In a round every bucket is split by the number that follows what its conversations have in
   common: that common prefix, found from the least and the greatest sequence of the bucket, gives a chain of nodes
   at once, so copies of long conversations take no more rounds than short ones. A bucket of at most LOCAL conversations is local;
   the larger ones go on. There are as many rounds as a path has branchings with over LOCAL conversations.
3. Local buckets are sorted by multikey quicksort, a task taking many of them one after the other; the recursion on equal keys
   emits their nodes.
4. Local buckets and chains report their leaves and tokens to the chains above, summed before the shuffle.

A node is named by its smallest conversation and its depth. The digest of conversations that end at a large bucket's node is made of
sorted pieces: each task joins its ids, and one task, whichever way a digest is made, hashes the pieces as they stream by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gazette.llm.shared import materialize, partitions, table

#: Conversations that a task may hold as one bucket.
LOCAL = 2_000
#: Conversations of one task's buckets that are sorted together.
TOGETHER = 8_000
#: Bytes of a piece of ids that are hashed.
PIECE = 1_000_000
#: Every conversation starts with up to SHARED - 1 turns of the one whose id is the last multiple of STEP.
STEP, SHARED = 100, 6

TURNS = "array<struct<id: bigint, len: int>>"
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
LOCAL_NODES = f"{NODES}, path array<string>"
NOTHING = hashlib.sha256(b"").hexdigest()


# ------------------------------------------------------- conversations as numbers


def in_order(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), role, text: a null turn comes first, equal turns by role and text; rows without a conv_id are of none."""
    filled = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return filled.select("conv_id", (F.row_number().over(order) - 1).alias("pos"), "role", "text")


def encoded(ordered: DataFrame) -> DataFrame:
    """conv_id, pos, id, len: turns by their number in the dictionary. The digest stands for the turn where it would be shuffled."""
    key = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    keyed = materialize(ordered.select("conv_id", "pos", key.alias("turn"), F.length("text").alias("len")), "keyed_turns")
    dictionary = materialize(keyed.groupBy("turn").agg(F.first("len").alias("len")).withColumn("id", F.monotonically_increasing_id()), "dictionary")
    return materialize(keyed.drop("len").join(dictionary, "turn").select("conv_id", "pos", "id", "len"), "encoded_turns")


def rebuilt(turns: DataFrame, step: int = STEP, shared: int = SHARED) -> DataFrame:
    """conv_id, turns of every conversation: the first h turns of its base, then its own after its first h; h = crc32(conv_id) % shared."""
    base, h = F.col("conv_id") - F.col("conv_id") % step, (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")
    ids = turns.select("conv_id").distinct().select("conv_id", base.alias("base"), h.alias("h"))
    # A base has at most step - 1 followers, and gives each less than ``shared`` turns.
    lent = turns.where((F.col("pos") < shared - 1) & (F.col("conv_id") % step == 0)).select(F.col("conv_id").alias("base"), "pos", "id", "len")
    taken = ids.join(lent, "base").where("pos < h").select("conv_id", "pos", "id", "len")
    own = turns.join(ids.select("conv_id", "h"), "conv_id").where("pos >= h").select("conv_id", "pos", "id", "len")
    # One row a conversation stays even if no turn does.
    none = ids.select("conv_id", F.lit(None).cast("int").alias("pos"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("int").alias("len"))
    every = taken.unionByName(own).unionByName(none)
    listed = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "id", "len"))))
    return every.groupBy("conv_id").agg(F.transform(listed, lambda x: F.struct(x["id"].alias("id"), x["len"].alias("len"))).alias("turns"))


# ------------------------------------------------------------- local buckets


def by_key(rows: list[int], keys: list[int]) -> Iterator[list[int]]:
    """The rows of each key, by three-way quicksort; keys: of every row."""
    waiting = [rows]
    while waiting:
        some = waiting.pop()
        if len(some) == 1:
            yield some
            continue
        pivot = keys[some[len(some) // 2]]
        less, same, more = [], [], []
        for r in some:
            k = keys[r]
            (same if k == pivot else less if k < pivot else more).append(r)
        yield same
        waiting += [x for x in (more, less) if x]


def local_trie(sequences: list[list[int]], lengths: list[list[int]], convs: list[int], depth: int, parent: int | None) -> list[list]:
    """Nodes of one bucket, the first its root: sequences that share their first number, below a node at ``depth`` named by ``parent``.

    [conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256] each. A stack stands for the
    recursion, so long conversations need no deep calls; a node comes before those below it.
    """
    nodes: list[list] = []
    above: list[int] = []
    waiting: list[tuple[list[int], int, int]] = [(list(range(len(sequences))), 1, -1)]
    while waiting:
        rows, d, up = waiting.pop()
        at, n = len(nodes), len(rows)
        conv = min(convs[r] for r in rows)
        ends = sorted(convs[r] for r in rows if len(sequences[r]) == d)
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest() if ends else NOTHING
        nodes.append([conv, depth + d, parent if up < 0 else nodes[up][0], n, 0, 0, (n - 1) * lengths[rows[0]][d - 1], digest])
        above.append(up)
        if up >= 0:
            nodes[up][4] += 1
        further = [r for r in rows if len(sequences[r]) > d] if ends else rows
        if further:
            keys = [s[d] if len(s) > d else -1 for s in sequences] if n == len(sequences) else {r: sequences[r][d] for r in further}
            waiting += [(group, d + 1, at) for group in by_key(further, keys)]  # type: ignore[arg-type]
    for i in range(len(nodes) - 1, -1, -1):
        node, up = nodes[i], above[i]
        node[5] += node[4] == 0
        if up >= 0:
            nodes[up][5] += node[5]
            nodes[up][6] += node[6]
    return nodes


def local_nodes(rows: DataFrame) -> DataFrame:
    """LOCAL_NODES of the local buckets in rows(bucket, conv_id, turns, depth, parent_conv, path); path is given with a bucket's root only."""

    def made(held: pa.Table) -> pa.RecordBatch:
        turns = held.column("turns").combine_chunks()
        ids, lens = (turns.flatten().field(x).to_pylist() for x in ("id", "len"))
        begin = turns.offsets.to_pylist()
        sequences, lengths = ([v[i - begin[0] : j - begin[0]] for i, j in zip(begin, begin[1:])] for v in (ids, lens))
        convs, depth = held.column("conv_id").to_pylist(), held.column("depth").to_pylist()
        parent, path = held.column("parent_conv").to_pylist(), held.column("path")
        bucket = held.column("bucket").combine_chunks().dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist() + [held.num_rows]
        nodes, paths = [], []
        for i, j in zip(cuts, cuts[1:]):
            found = local_trie(sequences[i:j], lengths[i:j], convs[i:j], depth[i], parent[i])
            nodes += found
            paths += [path[i].as_py(), *[None] * (len(found) - 1)]
        columns = list(zip(*nodes, strict=True))
        arrays = [pa.array(c, pa.int64()) for c in columns[:7]] + [pa.array(columns[7], pa.string()), pa.array(paths, pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in LOCAL_NODES.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < TOGETHER:
                continue
            all_held = pa.Table.from_batches(held)
            bucket = all_held.column("bucket")
            # The last bucket may go on in the next batch.
            last = bucket.index(bucket[-1]).as_py()
            if last:
                yield made(all_held.slice(0, last))
            held, n = all_held.slice(last).to_batches(), all_held.num_rows - last
        if n:
            yield made(pa.Table.from_batches(held))

    return rows.repartition(partitions(rows.sparkSession), "bucket").sortWithinPartitions("bucket").mapInArrow(run, LOCAL_NODES)


# ------------------------------------------------------------ large buckets


def digests(ends: DataFrame) -> DataFrame:
    """sid, ends_sha256 of ends(sid, conv_id): the conversations that end at large buckets, any number of them."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of joined ids, in order. A task has a range of (sid, conv_id)."""
        sid, first, parts, size = None, 0, [], 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"sid": [sid], "first": pa.array([first], pa.int64()), "piece": pa.array([",".join(parts).encode()], pa.binary())})

        for batch in batches:
            for s, c in zip(batch.column("sid").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if s != sid or size >= PIECE:
                    if parts:
                        yield piece()
                    sid, first, parts, size = s, c, [], 0
                parts.append(str(c))
                size += len(parts[-1]) + 1
        if parts:
            yield piece()

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sid, state = None, hashlib.sha256()
        for batch in batches:
            out = []
            for s, p in zip(batch.column("sid").to_pylist(), batch.column("piece"), strict=True):
                if s != sid:
                    if sid is not None:
                        out.append((sid, state.hexdigest()))
                    sid, state = s, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(p.as_py())
            yield pa.RecordBatch.from_pydict({"sid": pa.array([x for x, _ in out], pa.string()), "ends_sha256": pa.array([x for _, x in out], pa.string())})
        if sid is not None:
            yield pa.RecordBatch.from_pydict({"sid": [sid], "ends_sha256": [state.hexdigest()]})

    n = partitions(ends.sparkSession)
    pieces = ends.repartitionByRange(n, "sid", "conv_id").sortWithinPartitions("sid", "conv_id").mapInArrow(join, "sid string, first long, piece binary")
    return pieces.repartition(n, "sid").sortWithinPartitions("sid", "first").mapInArrow(hash_all, "sid string, ends_sha256 string")


def split(active: DataFrame, round_: int, local: int) -> tuple[DataFrame, DataFrame]:
    """(buckets, active's rows with their bucket's sid, common, n, conv).

    active: seg (sid of the chain above), conv_id, turns. A bucket is a chain above and the first number after it.
    """
    first = F.coalesce(F.get("turns", 0)["id"], F.lit(-1)) if round_ else F.lit(-1).cast("long")
    keyed = active.withColumn("key", first)
    about = [F.first(c).alias(c) for c in ("depth", "parent_conv", "path")]
    stats = keyed.groupBy("seg", "key").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv"), F.min("turns").alias("low"), F.max("turns").alias("high"), *about)
    # The first place where the least and the greatest sequence differ; what they share all share.
    same = F.zip_with("low", "high", lambda a, b: F.coalesce(a["id"] == b["id"], F.lit(False)))
    differ = F.array_position(same, F.lit(False)).cast("int")
    common = F.when(differ == 0, F.size("low")).otherwise(differ - 1)
    # A local bucket's own nodes tell what it has in common.
    stats = stats.select("seg", "key", "n", "conv", "depth", "parent_conv", "path", F.when(F.col("n") > local, F.slice("low", F.lit(1), common)).alias("chain"))
    named = stats.withColumn("sid", F.concat(F.lit(f"{round_}:"), F.monotonically_increasing_id().cast("string")))
    buckets = materialize(named, "buckets")
    rows = keyed.join(buckets.select("seg", "key", "sid", "n", "conv", F.size("chain").alias("common")), ["seg", "key"])
    return buckets, rows


def trie(conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    """NODES of the prefix trie of conversations(conv_id, turns: TURNS), each conv_id once.

    An empty table gives no node, not even a root.
    """
    spark = conversations.sparkSession
    root = {"seg": F.lit(""), "depth": F.lit(0), "parent_conv": F.lit(None).cast("long"), "path": F.array().cast("array<string>")}
    active = materialize(conversations.select("conv_id", "turns").withColumns(root), "conversations")
    chains, small, ended, children = [], [], [], []
    round_ = 0
    while True:
        # The root is a chain in any case: it may have nothing in common.
        buckets, rows = split(active, round_, local if round_ else 0)
        large = buckets.where(F.col("chain").isNotNull())
        children.append(buckets.select("seg"))
        if round_:
            small.append(rows.where(F.col("n") <= local).select(F.col("sid").alias("bucket"), "conv_id", "turns", "depth", "parent_conv", "path"))
        chains.append(large.select("sid", "path", "depth", "n", "conv", "parent_conv", "chain"))
        if large.isEmpty():
            break
        held = rows.where(F.col("common").isNotNull() & (F.col("common") >= 0) & (F.col("n") > (local if round_ else 0)))
        over = materialize(
            held.select(
                F.col("sid").alias("seg"),
                "conv_id",
                F.slice("turns", F.col("common") + 1, F.greatest(F.size("turns") - F.col("common"), F.lit(0))).alias("turns"),
                (F.col("depth") + F.col("common")).alias("depth"),
                F.col("conv").alias("parent_conv"),
                F.concat("path", F.array("sid")).alias("path"),
            ),
            "next_round",
        )
        ended.append(over.where(F.size("turns") == 0).select(F.col("seg").alias("sid"), "conv_id"))
        active = over.where(F.size("turns") > 0)
        round_ += 1

    def together(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    chain = together(chains)
    local_found = materialize(local_nodes(together(small)) if small else spark.createDataFrame([], LOCAL_NODES), "local_nodes")
    n_children = together(children).groupBy(F.col("seg").alias("sid")).agg(F.count("*").alias("n_children"))
    tokens = F.aggregate("chain", F.lit(0).cast("long"), lambda s, x: s + x["len"]) * (F.col("n") - 1)
    known = chain.join(n_children, "sid", "left").join(digests(together(ended)) if ended else spark.createDataFrame([], "sid string, ends_sha256 string"), "sid", "left")
    known = materialize(known.withColumns({"n_children": F.coalesce("n_children", F.lit(0)), "tokens": tokens, "ends_sha256": F.coalesce("ends_sha256", F.lit(NOTHING))}), "chains")
    leaf = (F.col("n_children") == 0).cast("long")
    reports = local_found.where("path is not null").select("path", "n_leaves", F.col("saved_tokens").alias("tokens")).unionByName(known.select("path", leaf.alias("n_leaves"), "tokens"))
    below = reports.select(F.explode("path").alias("sid"), "n_leaves", "tokens").groupBy("sid").agg(F.sum("n_leaves").alias("leaves_below"), F.sum("tokens").alias("tokens_below"))
    full = known.join(below, "sid", "left")
    # A chain's nodes, from the one just below the chain above; the root's chain begins with the root itself, which has no text.
    links = F.when(F.size("path") == 0, F.concat(F.array(F.struct(F.lit(-1).cast("long").alias("id"), F.lit(0).alias("len"))), F.col("chain"))).otherwise(F.col("chain"))
    up = F.when(F.size("path") == 0, 0).otherwise(1)
    each = full.withColumn("links", links).withColumn("start", F.col("depth") + up).select("*", F.posexplode("links").alias("i", "link"))
    last = F.col("i") == F.size("links") - 1
    own = F.aggregate(F.slice("links", F.col("i") + 1, F.size("links")), F.lit(0).cast("long"), lambda s, x: s + x["len"]) * (F.col("n") - 1)
    top = each.select(
        F.col("conv").alias("conv_id"),
        (F.col("start") + F.col("i")).cast("long").alias("depth"),
        F.when(F.col("i") > 0, F.col("conv")).otherwise(F.col("parent_conv")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(last, F.col("n_children")).otherwise(1).cast("long").alias("n_children"),
        (leaf + F.coalesce("leaves_below", F.lit(0))).cast("long").alias("n_leaves"),
        (own + F.coalesce("tokens_below", F.lit(0))).cast("long").alias("saved_tokens"),
        F.when(last, F.col("ends_sha256")).otherwise(NOTHING).alias("ends_sha256"),
    )
    return top.unionByName(local_found.drop("path"))


def prefix_trie(turns: DataFrame, local: int = LOCAL) -> DataFrame:
    """NODES of the rebuilt conversations of turns(conv_id, turn, role, text).

    A null turn comes first, a null role or text is empty, rows of equal turns are ordered by role and text and all stay; rows
    without a conv_id are of no conversation. Long texts count their code points and are never cut. An empty table gives none; other
    columns are ignored.
    """
    return trie(rebuilt(encoded(in_order(turns))), local)


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


# CRC-32 of the decimal id, a byte and a bit at a time: the reversed polynomial 0xEDB88320 and the initial and final value 0xFFFFFFFF are fixed values.
ORACLE = rf"""
with o as (
    select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as pos, coalesce(role, '') as role, coalesce(text, '') as text
    from conversations where conv_id is not null
),
ids as (
    select conv_id, conv_id - conv_id % {STEP} as base,
        xor(list_reduce(list_transform(string_split(cast(conv_id as varchar), ''), lambda x: cast(ord(x) as bigint)),
            lambda c, b: list_reduce(range(8), lambda k, j: xor(k >> 1, 3988292384 * (k & 1)), xor(c, b)), 4294967295::bigint), 4294967295) % {SHARED} as h
    from (select distinct conv_id from o)
),
t as (
    select ids.conv_id, pos, role, text from ids join o on o.conv_id = ids.base where pos < h
    union all
    select ids.conv_id, pos, role, text from ids join o on o.conv_id = ids.conv_id where pos >= h
),
s as (
    select ids.conv_id, coalesce(list(struct_pack(role := role, text := text) order by pos) filter (where pos is not null), []) as turns
    from ids left join t on t.conv_id = ids.conv_id group by ids.conv_id
),
p as (select conv_id, unnest(range(0, len(turns) + 1)) as depth, turns from s),
m as (
    select conv_id, depth, len(turns) as own, turns[depth].text as last, min(conv_id) over w as node, count(*) over w as n
    from p window w as (partition by depth, turns[1:depth])
),
node as (
    select node as conv_id, depth, min(n) as n_convs, min(last) as last,
        sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where own = depth), '')) as ends_sha256
    from m group by node, depth
),
linked as (
    select node.*, case when depth = 0 then null else (select node from m where m.conv_id = node.conv_id and m.depth = node.depth - 1) end as parent_conv_id from node
),
kids as (select parent_conv_id as conv_id, depth - 1 as depth, count(*) as n from linked where depth > 0 group by 1, 2),
full_node as (select linked.*, coalesce(kids.n, 0) as n_children, (n_convs - 1) * coalesce(length(last), 0) as tokens from linked left join kids using (conv_id, depth)),
up as (
    select m.node as conv_id, m.depth, sum(case when n_children = 0 then 1 else 0 end) as n_leaves, sum(tokens) as saved_tokens
    from full_node f join m on m.conv_id = f.conv_id and m.depth <= f.depth group by 1, 2
)
select f.conv_id, cast(f.depth as bigint) as depth, f.parent_conv_id, cast(n_convs as bigint) as n_convs, cast(n_children as bigint) as n_children,
    cast(n_leaves as bigint) as n_leaves, cast(saved_tokens as bigint) as saved_tokens, ends_sha256
from full_node f join up using (conv_id, depth)
"""
