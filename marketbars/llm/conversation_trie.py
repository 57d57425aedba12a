"""Prefix tries over conversations, packed as double arrays.

A node is a sequence of first turns. Its name is a 128-bit hash, the exclusive or
of one hash for each (turn, depth), so that names can be added up along a path
and tables can be joined on them.

Paths are cut into pieces of at most 64 turns and equal pieces become one. Sorted
by their turns, all over the cluster, pieces of a common prefix lie together: each
run of 65,536 turns is a shard. A shard numbers its turns densely, packs BASE and
CHECK arrays, and walks its pieces through them for the nodes and their sums.
Nodes that shards share, those above a cut, are added up globally.

No task holds the members of a node. What a subtree sums to follows from two
additive passes over the shards: every node belongs to its smallest member, so a
conversation owns the nodes from some depth down; all that the members of a node
own lies in its subtree or above it on the path of the smallest member.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketbars.llm.shared import WORD, partitions, saved

PIECE = 64
_SHARD_TURNS = 1 << 16
_CHAIN_BLOCK = 4096
_CHUNK_IDS = 4096
_SEARCHED = 4096
NAME = ("depth", "p1", "p2")


class Trie(NamedTuple):
    """`nodes`: `depth`, `p1`, `p2` (the node's name), `conv_id`, `parent_conv_id`,
    `n_convs`, `n_children`, `n_leaves`, `saved_tokens`. The last turn of a node is
    turn `depth` of conversation `conv_id`. `ends`: a node's name and `conv_id`,
    for each conversation that ends there.
    """

    nodes: DataFrame
    ends: DataFrame


# Turns, numbered within their conversations


def narrow_turns(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `turn`, two hashes of (role, text) and the words of the text.

    A missing role or text is empty; rows without `conv_id` belong to nothing.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.xxhash64(role, text).alias("t1"),
        F.xxhash64(text, F.lit(1), role).alias("t2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )


def _number(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with their place within (partition, conversation)."""
    part = TaskContext.get().partitionId()
    last, count = None, 0
    for batch in rows:
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id").to_numpy()
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        place = np.arange(len(ids)) - np.repeat(starts, np.diff(np.r_[starts, len(ids)]))
        if last == ids[0]:
            place[: starts[1] if len(starts) > 1 else None] += count
        last, count = ids[-1], int(place[-1]) + 1
        columns = {name: batch.column(name) for name in ("conv_id", "t1", "t2", "words")}
        parts = np.full(len(ids), part, np.int64)
        yield pa.record_batch(columns | {"part": parts, "place": place.astype(np.int64)})


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with `place` from 0 in their conversation, and `conv_id`, `n_turns`.

    Turns go by `turn`, null first; those that share one by their hashes. The sort
    is over all rows, so that a conversation of any length is spread.
    """
    rows = saved(narrow_turns(conversations))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("t1"), F.col("t2")]
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), *order)
    schema = "conv_id long, t1 long, t2 long, words long, part long, place long"
    placed = saved(dealt.sortWithinPartitions(*order).mapInArrow(_number, schema))
    runs = placed.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One conversation at most goes on over each border of two partitions.
    later = runs.withColumn("before", F.sum("n").over(before)).where("before IS NOT NULL")
    later = later.select("conv_id", "part", "before")
    turns = placed.join(F.broadcast(later), ["conv_id", "part"], "left")
    place = F.col("place") + F.coalesce("before", F.lit(0))
    turns = turns.select("conv_id", place.alias("place"), "t1", "t2", "words")
    return turns, saved(runs.groupBy("conv_id").agg(F.sum("n").alias("n_turns")))


# Double arrays


class DoubleArray:
    """Child `c` of a node is at BASE[node] + c, if CHECK there is the node."""

    def __init__(self, size: int) -> None:
        self.base = np.zeros(max(size, 16), np.int64)
        self.check = np.full(max(size, 16), -1, np.int64)
        self.check[0] = 0
        self._low, self._high = 1, 1

    def _room(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.r_[self.base, np.zeros(more, np.int64)]
            self.check = np.r_[self.check, np.full(more, -1, np.int64)]

    def _occupy(self, slots: np.ndarray, nodes: np.ndarray | int) -> None:
        self.check[slots] = nodes
        self._high = max(self._high, int(slots.max()) + 1)

    def _place(self, node: int, symbols: np.ndarray) -> None:
        """The first base at which all children find a free slot."""
        offsets = symbols - symbols[0]
        self._room(self._low + _SEARCHED + int(offsets[-1]) + 1)
        near = self._low + np.flatnonzero(self.check[self._low : self._low + _SEARCHED] == -1)
        if len(near) < _SEARCHED // 16:
            self._low += _SEARCHED // 2
        for offset in offsets[1:]:
            near = near[self.check[near + offset] == -1]
            if not len(near):
                break
        first = int(near[0]) if len(near) else self._high
        self._room(first + int(offsets[-1]) + 1)
        self.base[node] = first - symbols[0]
        self._occupy(first + offsets, node)

    def extend(self, nodes: np.ndarray, symbols: np.ndarray) -> None:
        """Add children; all those of a node come in one call."""
        order = np.lexsort((symbols, nodes))
        nodes, symbols = nodes[order], symbols[order]
        fresh = np.r_[True, (nodes[1:] != nodes[:-1]) | (symbols[1:] != symbols[:-1])]
        nodes, symbols = nodes[fresh], symbols[fresh]
        first = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]])
        size = np.diff(np.r_[first, len(nodes)])
        many = np.flatnonzero(size > 1)
        for k in many[np.argsort(-size[many], kind="stable")]:
            self._place(int(nodes[first[k]]), symbols[first[k] : first[k] + size[k]])
        one = first[size == 1]
        if len(one):
            self._room(self._high + len(one))
            free = np.flatnonzero(self.check[self._low : self._high + len(one)] == -1)
            slots = self._low + free[: len(one)]
            self.base[nodes[one]] = slots - symbols[one]
            self._occupy(slots, nodes[one])

    def step(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The children by these symbols; -1 where there is none."""
        slots = self.base[nodes] + symbols
        inside = (slots > 0) & (slots < len(self.check))
        found = inside & (self.check[np.where(inside, slots, 0)] == nodes)
        return np.where(found, slots, -1)


_NODES = pa.schema(
    [(n, pa.int64()) for n in ("depth", "p1", "p2", "q1", "q2", "words", "least", "v1", "v2")]
)


def _nodes_of(pieces: pa.Table) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard, below the tops of its pieces."""
    turns = pieces.column("turns").combine_chunks()
    entries, offsets = turns.flatten(), turns.offsets.to_numpy()
    starts, lengths = offsets[:-1] - offsets[0], np.diff(offsets)
    field = {n: entries.field(n).to_numpy() for n in ("t", "h1", "h2", "words")}
    column = {n: pieces.column(n).to_numpy() for n in ("band", "top1", "top2", "least", "v1", "v2")}

    turn_ids = np.unique(field["t"], return_inverse=True)[1]
    tops = np.stack([column["band"], column["top1"], column["top2"]], 1)
    top_ids = np.unique(tops, axis=0, return_inverse=True)[1].reshape(-1)
    trie = DoubleArray(len(entries) + len(tops) + 1)
    root = np.zeros(len(lengths), np.int64)
    trie.extend(root, top_ids)
    state = trie.step(root, top_ids)
    level, alive = state.copy(), np.arange(len(lengths))
    for k in range(int(lengths.max())):
        alive = alive[lengths[alive] > k]
        symbols = turn_ids[starts[alive] + k]
        trie.extend(level[alive], symbols)
        level[alive] = trie.step(level[alive], symbols)

    # The walk: one turn of all pieces at a time.
    alive, name1, name2 = np.arange(len(lengths)), column["top1"].copy(), column["top2"].copy()
    for k in range(int(lengths.max())):
        alive = alive[lengths[alive] > k]
        at = starts[alive] + k
        state[alive] = trie.step(state[alive], turn_ids[at])
        above = name1[alive], name2[alive]
        name1[alive] ^= field["h1"][at]
        name2[alive] ^= field["h2"][at]
        order = np.argsort(state[alive], kind="stable")
        held = state[alive][order]
        first = np.flatnonzero(np.r_[True, held[1:] != held[:-1]])
        one = order[first]
        chosen = alive[order]
        found = [
            column["band"][alive[one]] * PIECE + k + 1,
            name1[alive[one]],
            name2[alive[one]],
            above[0][one],
            above[1][one],
            field["words"][at[one]],
            np.minimum.reduceat(column["least"][chosen], first),
            np.add.reduceat(column["v1"][chosen], first),
            np.add.reduceat(column["v2"][chosen], first),
        ]
        yield pa.record_batch(found, schema=_NODES)


def _shards(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces, cut into shards of bounded size, as nodes."""
    held, size = [], 0
    for batch in rows:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            held.append(part)
            size += len(part.column("turns").flatten())
            if size >= _SHARD_TURNS:
                yield from _nodes_of(pa.Table.from_batches(held))
                held, size = [], 0
    if size:
        yield from _nodes_of(pa.Table.from_batches(held))


_PATH = ("band", "top1", "top2", "turns")


def _walk(pieces: DataFrame) -> DataFrame:
    """Nodes with the least member and the sums of `v1`, `v2` over their members."""
    whole = saved(pieces.select(*_PATH, "least", "v1", "v2"))
    dealt = whole.repartitionByRange(partitions(whole.sparkSession), *_PATH)
    schema = ", ".join(f"{f.name} long" for f in _NODES)
    nodes = dealt.sortWithinPartitions(*_PATH).mapInArrow(_shards, schema)
    same = [F.max(c).alias(c) for c in ("q1", "q2", "words")]
    sums = [F.min("least").alias("least"), F.sum("v1").alias("v1"), F.sum("v2").alias("v2")]
    return nodes.groupBy(*NAME).agg(*same, *sums)


# Pieces of paths


def _pieces(turns: DataFrame) -> DataFrame:
    """Runs of 64 turns of each conversation, with the name of the node above them."""
    h1, h2 = F.xxhash64("t1", "depth"), F.xxhash64("t2", "depth")
    entry = F.struct("depth", F.col("t1").alias("t"), "h1", "h2", "words")
    rows = turns.withColumns({"h1": h1, "h2": h2})
    band = F.floor((F.col("depth") - 1) / PIECE).cast("long").alias("band")
    pieces = rows.groupBy("conv_id", band).agg(
        F.sort_array(F.collect_list(entry)).alias("turns"),
        F.bit_xor("h1").alias("x1"),
        F.bit_xor("h2").alias("x2"),
    )
    pieces = saved(pieces.withColumn("n", F.size("turns").cast("long")))
    alone = (F.col("band") == 0) & (F.col("n") < PIECE)
    zero, yes = F.lit(0).cast("long"), F.lit(True)
    short = pieces.where(alone).withColumns({"top1": zero, "top2": zero, "last": yes})
    path = Window.partitionBy("conv_id").orderBy("band")
    above = path.rowsBetween(Window.unboundedPreceding, -1)
    long = pieces.where(~alone).withColumns(
        {
            "top1": F.coalesce(F.bit_xor("x1").over(above), zero),
            "top2": F.coalesce(F.bit_xor("x2").over(above), zero),
            "last": F.lead("band").over(path).isNull(),
        }
    )
    return saved(short.unionByName(long))


def _merged(pieces: DataFrame, *values: Column) -> DataFrame:
    return pieces.groupBy(*_PATH).agg(F.min("conv_id").alias("least"), *values)


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> Trie:
    """All nodes of the trie of some conversations.

    `turns` has `conv_id`, `depth` (from 1, without gaps), `t1`, `t2` (hashes of
    the turn) and `words`; `conversations` has each `conv_id` once, also of
    those without turns, which are members of the root alone. Without
    conversations there is no node, otherwise the root is one.

    A node's `saved_tokens` is the sum over its subtree of words times members but
    one. Turns that agree in 64 bits, and nodes that agree in 128, are taken as equal.
    The pieces of one conversation, a 64th of its turns, are ordered in one task.
    """
    least_of_all, n_conversations = conversations.agg(F.min("conv_id"), F.count("*")).first()
    pieces = _pieces(turns)
    count = F.count("*").alias("v1"), F.lit(0).cast("long").alias("v2")
    found = saved(_walk(_merged(pieces, *count)).withColumnRenamed("v1", "n_convs").drop("v2"))
    above = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")]
    children = found.groupBy(*above).agg(F.count("*").alias("n_children"))
    found = found.join(children, [*NAME], "left").fillna(0, ["n_children"])
    own = ((F.col("n_convs") - 1) * F.col("words")).alias("own")
    leaf = (F.col("n_children") == 0).cast("long").alias("leaf")
    block = F.floor(F.col("depth") / _CHAIN_BLOCK).alias("block")
    found = saved(found.select("*", own, leaf, block))

    # What lies above a node among those of its smallest member, in two steps.
    blocks = found.groupBy("least", "block").agg(F.sum("own").alias("total"))
    earlier = Window.partitionBy("least").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("base", F.sum("total").over(earlier)).where("base IS NOT NULL")
    chain = Window.partitionBy("least", "block").orderBy("depth")
    upper = F.sum("own").over(chain.rowsBetween(Window.unboundedPreceding, -1))
    nodes = found.withColumn("upper", F.coalesce(upper, F.lit(0)))
    nodes = nodes.join(blocks.drop("total"), ["least", "block"], "left")

    chains = found.groupBy("least").agg(F.sum("own").alias("own"), F.sum("leaf").alias("leaf"))
    owned = pieces.join(chains.withColumnRenamed("least", "conv_id"), "conv_id")
    members = _walk(_merged(owned, F.sum("own").alias("v1"), F.sum("leaf").alias("v2")))
    members = members.select(*NAME, F.col("v1").alias("owned"), F.col("v2").alias("n_leaves"))
    saved_tokens = F.col("owned") - F.col("upper") - F.coalesce("base", F.lit(0))
    parents = found.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("p1").alias("q1"),
        F.col("p2").alias("q2"),
        F.col("least").alias("parent_conv_id"),
    )
    nodes = nodes.join(members, [*NAME]).join(parents, ["depth", "q1", "q2"], "left")
    # All nodes of depth 1 have one parent, of which all are members.
    parent = F.when(F.col("depth") == 1, F.lit(least_of_all)).otherwise(F.col("parent_conv_id"))
    columns = [
        *NAME,
        F.col("least").alias("conv_id"),
        parent.cast("long").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        saved_tokens.alias("saved_tokens"),
    ]
    nodes = nodes.select(*columns)

    zero = F.lit(0).cast("long")
    depth_one = F.count_if(F.col("depth") == 1)
    children_of_root, leaves, tokens = found.agg(depth_one, F.sum("leaf"), F.sum("own")).first()
    root = conversations.sparkSession.range(1 if n_conversations else 0).select(
        *[zero.alias(n) for n in NAME],
        F.lit(least_of_all).cast("long").alias("conv_id"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(n_conversations).alias("n_convs"),
        F.lit(children_of_root).cast("long").alias("n_children"),
        F.lit(leaves or 1).cast("long").alias("n_leaves"),
        F.lit(tokens or 0).cast("long").alias("saved_tokens"),
    )

    ended = pieces.where("last").select(
        (F.col("band") * PIECE + F.col("n")).alias("depth"),
        F.col("top1").bitwiseXOR(F.col("x1")).alias("p1"),
        F.col("top2").bitwiseXOR(F.col("x2")).alias("p2"),
        "conv_id",
    )
    turnless = conversations.join(pieces.where("last").select("conv_id"), "conv_id", "left_anti")
    turnless = turnless.select(zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), "conv_id")
    return Trie(nodes.unionByName(root), ended.unionByName(turnless))


# Conversations whose first turns come from another one


def with_shared_starts(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of rebuilt conversations, and all `conv_id`.

    Conversation c has the first h turns of conversation c - c % 20, if there is
    one, then its own turns after the first h; h is crc32 of its decimal id,
    modulo 4. The remainder of a negative id is negative, as in SQL.
    """
    turns, lengths = numbered_turns(conversations)
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    source = (F.col("conv_id") - F.col("conv_id") % 20).alias("source")
    ids = lengths.select("conv_id", h.alias("h"), source)
    others = lengths.select(F.col("conv_id").alias("source"), F.col("n_turns").alias("there"))
    ids = ids.join(others, "source", "left")
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    ids = saved(ids.select("conv_id", "source", "h", taken.alias("taken")))

    turn = ["t1", "t2", "words"]
    starts = turns.where(F.col("place") < 3).withColumnRenamed("conv_id", "source")
    starts = ids.join(starts, "source").where(F.col("place") < F.col("h"))
    starts = starts.select("conv_id", (F.col("place") + 1).alias("depth"), *turn)
    rest = turns.join(ids, "conv_id").where(F.col("place") >= F.col("h"))
    depth = F.col("place") - F.col("h") + F.col("taken") + 1
    rest = rest.select("conv_id", depth.alias("depth"), *turn)
    return starts.unionByName(rest), ids.select("conv_id")


# Digests of long lists


def _lists(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted members as comma-joined lists of bounded length."""
    schema = pa.schema([*((n, pa.int64()) for n in (*NAME, "first")), ("ids", pa.string())])
    for batch in rows:
        if not batch.num_rows:
            continue
        column = [batch.column(n).to_numpy() for n in (*NAME, "conv_id")]
        new = np.zeros(batch.num_rows, bool)
        new[::_CHUNK_IDS] = True
        for c in column[:3]:
            new[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(new)
        words = [str(x) for x in column[3].tolist()]
        ends = [*starts[1:].tolist(), batch.num_rows]
        lists = [",".join(words[a:b]) for a, b in zip(starts.tolist(), ends, strict=True)]
        yield pa.record_batch([*(c[starts] for c in column), pa.array(lists)], schema=schema)


def _digests(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of a node, in order, as one digest; only a hash's state is held."""
    schema = pa.schema([*((n, pa.int64()) for n in NAME), ("ends_sha256", pa.string())])
    held, digest = None, None

    def done() -> pa.RecordBatch:
        return pa.record_batch([[x] for x in (*held, digest.hexdigest())], schema=schema)

    for batch in rows:
        for *name, ids in zip(*(batch.column(n).to_pylist() for n in (*NAME, "ids")), strict=True):
            if name == held:
                digest.update(b",")
            else:
                if held:
                    yield done()
                held, digest = name, hashlib.sha256()
            digest.update(ids.encode())
    if held:
        yield done()


def digest_of_ends(ends: DataFrame) -> DataFrame:
    """A node's name and the SHA-256 of its `conv_id`, ascending and comma-joined."""
    members, n = saved(ends), partitions(ends.sparkSession)
    order = [*NAME, "conv_id"]
    dealt = members.repartitionByRange(n, *order).sortWithinPartitions(*order)
    lists = dealt.mapInArrow(_lists, "depth long, p1 long, p2 long, first long, ids string")
    whole = lists.repartition(n, *NAME).sortWithinPartitions(*NAME, "first")
    return whole.mapInArrow(_digests, "depth long, p1 long, p2 long, ends_sha256 string")


def conversation_nodes(conversations: DataFrame) -> DataFrame:
    """The trie of conversations with shared starts, its ends as digests.

    One row for each node: `conv_id` (the smallest member), `depth`,
    `parent_conv_id`, `n_convs`, `n_children`, `n_leaves`, `saved_tokens`,
    `ends_sha256`. Rows without `conv_id` take no part; null `turn` comes first;
    rows that share a turn go by their hashes, equal rows one after another;
    further columns are not read. An empty table has no nodes.
    """
    trie = prefix_trie(*with_shared_starts(conversations))
    nodes = trie.nodes.join(digest_of_ends(trie.ends), [*NAME], "left")
    digest = F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest()))
    return nodes.drop("p1", "p2").withColumn("ends_sha256", digest)
