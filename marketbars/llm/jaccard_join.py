"""Jaccard join on word shingles, filtered under several token orders."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.llm.components import connected_components
from marketbars.llm.hashing import mix, shingle_hashes, word_hashes
from marketbars.llm.shared import batches, saved
from marketbars.llm.tokens import forget

# Counters of the sketch that tells frequent tokens, and rows it travels in.
_SKETCH = 1 << 20
_CHUNKS = 16
# Token orders under all of which candidates must meet.
_ORDERS = 2
# Sets of a token that are paired, and by how much prefixes are made longer for it.
_PAIRED, _EXTRA = 32, 15
# Marks tokens of the first order's guaranteeing prefix.
_STAR = 1 << _ORDERS
# Percent of a set's tokens in its wide prefix, where the similarity allows it.
_WIDE = 27
# A cluster up to this size is joined in one task; larger ones are cut.
_MOST_ITEMS, _MOST_TOKENS = 2048, 1 << 21
_BLOCK = 512
_SALTS = 32

_ITEM = "cluster long, id long, n long, tokens binary"


def shingles(text: str | None, words: int) -> np.ndarray:
    """The set of shingles of a text, as sorted hashes."""
    return np.unique(shingle_hashes(word_hashes(text), words))


def _wide_parts(n: int, percent: int) -> tuple[int, int]:
    """Length of a set's wide prefix, and how many shared tokens it is longer by.

    With p tokens that guarantee a shared one, a set shares k tokens of the
    first p - 1 + k with each partner.
    """
    first = n - -(-percent * n // 100) + 1
    more = max(1, _WIDE * n // 100 - first + 1)
    return first - 1 + more, more


@cache
def _wide_least(n: int, percent: int) -> int:
    """The smallest k of all sizes that a partner of a set can have.

    By its roundings k can fall by one where sizes grow. It is 1 at every size
    where _WIDE + percent <= 100, and else no smaller 100 sizes further on.
    """
    low, high = -(-percent * n // 100), 100 * n // percent
    return min(_wide_parts(m, percent)[1] for m in range(low, min(high, low + 99) + 1))


def _set_id(tokens: np.ndarray) -> int:
    """60 bits of a hash of a sorted set."""
    place = np.arange(1, len(tokens) + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    total = np.add.reduce(mix(tokens ^ place)) + np.uint64(len(tokens))
    return int(mix(np.array([total]))[0] >> np.uint64(4))


def _rank(tokens: np.ndarray, levels: np.ndarray, order: int, salt: int) -> np.ndarray:
    """A token's place in a global order: rare ones first, then by a hash."""
    salted = mix(tokens ^ np.uint64(salt))
    level = levels[(salted & np.uint64(_SKETCH - 1)).astype(np.int64)].astype(np.uint64)
    hashed = mix(tokens + np.uint64((order + 1) * 0x2545F4914F6CDD1D % (1 << 64)))
    return level << np.uint64(56) | hashed >> np.uint64(8)


def _first_tokens(
    tokens: np.ndarray, count: int, levels: np.ndarray, order: int, salt: int
) -> np.ndarray:
    if count >= len(tokens):
        return tokens
    rank = _rank(tokens, levels, order, salt)
    return tokens[np.argpartition(rank, count - 1)[:count]]


class _Sketch:
    """Counts of tokens by hash, over everything that a task sees."""

    def __init__(self) -> None:
        self._counts = np.zeros(_SKETCH, np.uint32)

    def add(self, tokens: np.ndarray, salt: int) -> None:
        place = (mix(tokens ^ np.uint64(salt)) & np.uint64(_SKETCH - 1)).astype(np.int64)
        np.add.at(self._counts, place, 1)

    def rows(self) -> list[tuple[int, bytes]]:
        parts = np.split(self._counts, _CHUNKS)
        return [(i, zlib.compress(p.astype("<u8").tobytes(), 1)) for i, p in enumerate(parts)]


def _levels(chunks: DataFrame) -> np.ndarray:
    """How much more frequent than usual the tokens of each counter are.

    The sum over all tasks has the sketch's fixed size, 8 MB.
    """

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(_SKETCH // _CHUNKS, np.uint64)
        for part in group.column("counts"):
            total += np.frombuffer(zlib.decompress(part.as_py()), "<u8")
        return pa.table({"chunk": group.column("chunk")[:1], "counts": [total.tobytes()]})

    def pair(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's chunks, added up before they are shuffled."""
        totals: dict[int, np.ndarray] = {}
        for batch in rows:
            for chunk, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = np.frombuffer(zlib.decompress(part), "<u8")
                totals[chunk] = totals[chunk] + counts if chunk in totals else counts
        packed = [zlib.compress(t.astype("<u8").tobytes(), 1) for t in totals.values()]
        yield pa.record_batch(
            [pa.array(list(totals), pa.int32()), pa.array(packed, pa.binary())],
            names=["chunk", "counts"],
        )

    schema = "chunk int, counts binary"
    summed = chunks.mapInArrow(pair, schema).groupBy("chunk").applyInArrow(add, schema)
    counts = np.zeros(_SKETCH, np.uint64)
    for row in summed.collect():
        step = _SKETCH // _CHUNKS
        counts[row.chunk * step : (row.chunk + 1) * step] = np.frombuffer(row.counts, np.uint64)
    mean = max(float(counts.mean()), 1.0)
    levels = np.where(counts < 2 * mean + 16, 0, np.log2(np.maximum(counts / mean, 2.0)))
    return levels.astype(np.uint8)


def _meet(prefixes: DataFrame) -> DataFrame:
    """Edges between items that share a token.

    A token's items are not paired: each is joined with the smallest of them.
    """
    shared = (
        prefixes.groupBy("token")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where(F.col("low") < F.col("high"))
        .drop("high")
    )
    return (
        prefixes.join(shared, "token")
        .where(F.col("id") != F.col("low"))
        .select("id", "low")
        .distinct()
    )


def _with_counts(tokens: DataFrame) -> DataFrame:
    """Each set's tokens that another one has, with the number of sets."""
    often = tokens.groupBy("token").agg(F.count("*").alias("often")).where(F.col("often") > 1)
    return (
        tokens.join(often, "token")
        .groupBy("id", "n")
        .agg(F.collect_list(F.struct("token", "often")).alias("shared"))
    )


class JaccardJoin:
    """Links between texts whose shingle sets have a Jaccard similarity of `percent`.

    With D the difference of a set A from any fixed set, two sets link when
    F(A) + F(B) <= 2 (100 + percent) |D(A) & D(B)|, where
    F = (100 + percent) |D| - (100 - percent) |A|. At first the fixed set is
    empty and D is the set itself.
    """

    def __init__(self, words: int, percent: int) -> None:
        self.words, self.percent = words, percent

    def _excess(self, tokens: int, n: int) -> int:
        return (100 + self.percent) * tokens - (100 - self.percent) * n

    def _prefix(self, tokens: int, n: int, least: int) -> int:
        """First tokens of a difference that must hold one of any partner's."""
        overlap = max(1, -(-(self._excess(tokens, n) + least) // (2 * (100 + self.percent))))
        return max(0, tokens - overlap + 1)

    def _wide(self, n: int) -> tuple[int, int]:
        """Length of a set's wide prefix, and how much of it any partner's must share.

        Of two partners' k, both share the smaller one.
        """
        return _wide_parts(n, self.percent)[0], _wide_least(n, self.percent)

    def sets(self, documents: DataFrame) -> DataFrame:
        """`doc_id`, the size of its set, the set's id; and the sketch of all tokens."""
        words = self.words

        def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forget()
            sketch = _Sketch()
            names = ["doc_id", "n", "id", "chunk", "counts"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            for batch in batches(rows, 1024):
                n, ids, all_tokens = [], [], []
                for text in batch.column(1).to_pylist():
                    tokens = shingles(text, words)
                    all_tokens.append(tokens)
                    n.append(len(tokens))
                    ids.append(_set_id(tokens))
                sketch.add(np.concatenate(all_tokens), 0)
                empty = [None] * len(n)
                columns = [batch.column(0), n, ids, empty, empty]
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
                )
            chunks, counts = zip(*sketch.rows(), strict=True)
            empty = [None] * _CHUNKS
            columns = [empty, empty, empty, chunks, counts]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
            )

        schema = "doc_id long, n long, id long, chunk int, counts binary"
        return documents.select("doc_id", "text").mapInArrow(read, schema)

    def _text_prefixes(self, documents: DataFrame, levels: np.ndarray) -> DataFrame:
        """The wide prefixes of all sets; equal sets of a task once."""
        words, wide = self.words, self._wide

        def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for batch in batches(rows, 1024):
                ids, firsts = [], []
                for text in batch.column(0).to_pylist():
                    tokens = shingles(text, words)
                    own = _set_id(tokens)
                    if not len(tokens) or own in seen:
                        continue
                    seen.add(own)
                    first = _first_tokens(tokens, wide(len(tokens))[0], levels, 0, 0)
                    firsts.append(first)
                    ids.append(np.full(len(first), own, np.int64))
                if ids:
                    yield pa.record_batch(
                        [np.concatenate(ids), np.concatenate(firsts).view(np.int64)],
                        names=["id", "token"],
                    )

        return documents.select("text").mapInArrow(read, "id long, token long")

    def _candidates(self, prefixes: DataFrame, classes: DataFrame) -> DataFrame:
        """`id` and `cluster` of the sets that may link with another one.

        A set goes if too few tokens of its wide prefix are anywhere else. What
        stays is put in several orders, all with the rare tokens of the wide
        prefixes first, and must meet the same sets under each of them.
        """
        shared = (
            prefixes.groupBy("token")
            .agg(F.min("id").alias("low"), F.max("id").alias("high"))
            .where(F.col("low") < F.col("high"))
            .select("token")
        )

        # The overlap that `_wide` asks for.
        low, high = f"({self.percent} * n + 99) div 100", f"100 * n div {self.percent}"
        first = f"(m - ({self.percent} * m + 99) div 100 + 1)"
        more = f"greatest(1, {_WIDE} * m div 100 - {first} + 1)"
        sizes = f"sequence({low}, least({high}, {low} + 99))"
        overlap = f"array_min(transform({sizes}, m -> {more}))"
        lists = (
            prefixes.join(shared, "token", "left_semi")
            .groupBy("id")
            .agg(F.collect_set("token").alias("tokens"))
            .join(classes.select("id", "n"), "id")
            .where(F.size("tokens") >= F.expr(overlap))
        )
        # How often a token is shared counts only among the sets that are left.
        kept = saved(lists.select("id", "n", F.explode("tokens").alias("token")))
        return self._in_orders(_with_counts(kept), self._wide)

    def _whole(self, n: int) -> tuple[int, int]:
        """The same as `_wide` for all tokens of a set."""
        return n, -(-self.percent * n // 100)

    def _search_whole_sets(self, items: DataFrame) -> DataFrame:
        """Cut clusters by whole sets, of which enough must be shared in the cluster."""

        def spread(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches(rows, 256):
                out: list[list[np.ndarray]] = [[], [], []]
                for cluster, own, n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    tokens = np.frombuffer(raw, np.uint64)
                    out[0].append(np.full(n, own, np.int64))
                    out[1].append(np.full(n, n, np.int64))
                    # Tokens of another cluster are others.
                    out[2].append(mix(tokens ^ np.uint64(cluster % (1 << 64))).view(np.int64))
                yield pa.record_batch([np.concatenate(c) for c in out], names=["id", "n", "token"])

        columns = items.select("cluster", "id", "n", "tokens")
        tokens = saved(columns.mapInArrow(spread, "id long, n long, token long"))
        again = self._in_orders(_with_counts(tokens), self._whole)
        return items.drop("cluster").join(again, "id")

    def _in_orders(self, lists: DataFrame, needed: Callable[[int], tuple[int, int]]) -> DataFrame:
        """`id` and `cluster` of sets that may link with another, by several orders.

        `lists` has a set's shared tokens and how often each is shared; `needed`
        tells how many tokens the list was taken from and how many of them any
        partner shares. All orders have rare tokens first. Of a prefix that is j
        tokens longer than the one that guarantees a shared token, partners
        share j + 1, under every order. Pairs are counted only over tokens of at
        most 32 sets; a more frequent token might be shared by any two that have
        it in a prefix, and these are joined with the first of them.
        """

        def order(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ["id", "token", "often", "mask", "need", "hot0", "hot1"]
            for batch in batches(rows, 1024):
                out: list[list[np.ndarray]] = [[] for _ in names]
                for own, n, shared in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    # Tokens that nothing shares would come before all of these.
                    first = len(shared) - needed(n)[1] + 1
                    if first < 1:
                        continue
                    tokens = np.array([x["token"] for x in shared], np.int64)
                    often = np.array([x["often"] for x in shared], np.int64)
                    length = min(len(shared), first + _EXTRA)
                    mask = np.zeros(len(tokens), np.int64)
                    hot = []
                    for k in range(_ORDERS):
                        hashed = mix(tokens.view(np.uint64) + np.uint64(k))
                        place = np.lexsort((hashed, often))[:length]
                        mask[place] |= 1 << k
                        if k == 0:
                            mask[place[:first]] |= _STAR
                        hot.append(int((often[place] > _PAIRED).sum()))
                    (used,) = np.nonzero(mask)
                    values = (own, tokens[used], often[used], mask[used], length - first + 1, *hot)
                    for column, value in zip(out, values, strict=True):
                        column.append(np.broadcast_to(np.int64(value) if np.isscalar(value) else value, len(used)))
                if out[0]:
                    yield pa.record_batch([np.concatenate(c) for c in out], names=names)

        kinds = "id long, token long, often long, mask long, need long, hot0 long, hot1 long"
        ordered = saved(lists.mapInArrow(order, kinds))
        rare = ordered.where(F.col("often") <= _PAIRED).drop("often")
        other = rare.select(*[F.col(c).alias(c if c == "token" else f"{c}_b") for c in rare.columns])
        both = F.col("mask").bitwiseAND(F.col("mask_b"))
        shared = [F.sum(F.shiftright(both, k).bitwiseAND(F.lit(1))) for k in range(_ORDERS)]
        least = [F.min(F.least(c, f"{c}_b")) for c in ("need", "hot0", "hot1")]
        enough = (F.col("shared0") + F.col("hot0") >= F.col("need")) & (
            F.col("shared1") + F.col("hot1") >= F.col("need")
        )
        pairs = (
            rare.join(other, "token")
            .where(F.col("id") < F.col("id_b"))
            .groupBy("id", "id_b")
            .agg(
                *[c.alias(f"shared{k}") for k, c in enumerate(shared)],
                *[c.alias(n) for c, n in zip(least, ("need", "hot0", "hot1"), strict=True)],
            )
            .where(enough)
            .select(F.col("id").alias("a"), F.col("id_b").alias("b"))
        )
        # Pairs without a rare token in common have a frequent one in the prefix
        # that guarantees it; one order is enough to find it.
        star = F.col("mask").bitwiseAND(F.lit(_STAR)) > 0
        frequent = ordered.where((F.col("often") > _PAIRED) & star).select("id", "token")
        met = _meet(frequent).select(F.col("id").alias("a"), F.col("low").alias("b"))
        found = connected_components(pairs.unionByName(met))
        return found.select(F.col("node").alias("id"), F.xxhash64("root").alias("cluster"))

    def _together(self, edges: DataFrame, orders: int) -> DataFrame:
        """`id` and a `cluster` of what is connected under every order."""
        edges = edges.select(F.col("id").alias("a"), F.col("low").alias("b"))
        found = connected_components(edges)
        return (
            found.select(F.expr(f"node div {orders}").alias("id"), "root")
            .groupBy("id")
            .agg(F.count("*").alias("orders"), F.xxhash64(F.sort_array(F.collect_list("root"))).alias("cluster"))
            .where(F.col("orders") == orders)
            .select("id", "cluster")
        )

    def _items(self, documents: DataFrame, chosen: DataFrame) -> DataFrame:
        """The sets of the chosen documents (`doc_id`, `id`, `cluster`, `large`), each once.

        Rows that repeat a `doc_id` and a set are one item, as they are in sizes.
        """
        words = self.words

        def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task, seen = TaskContext.get().partitionId(), set()
            for batch in batches(rows, 1024):
                out = []
                for own, cluster, large, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if own in seen:
                        continue
                    tokens = shingles(text, words)
                    if _set_id(tokens) == own:
                        seen.add(own)
                        out.append((cluster, own, len(tokens), tokens.tobytes(), large, task))
                columns = list(zip(*out, strict=True)) or [()] * 6
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.int32())
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                    names=["cluster", "id", "n", "tokens", "large", "task"],
                )

        # The chosen are a share of the documents, without a bound: one plan at
        # every size, in which neither side is broadcast.
        texts = documents.join(chosen.hint("merge"), "doc_id")
        texts = texts.select("id", "cluster", "large", "text")
        return self._once(saved(texts.mapInArrow(read, _ITEM + ", large boolean, task int")))

    def _once(self, items: DataFrame) -> DataFrame:
        """Each item from one `task`: a join that is split for a hot key has it in several."""
        tasks = items.groupBy("id").agg(F.min("task").alias("first"), F.max("task").alias("last"))
        several = saved(tasks.where(F.col("first") < F.col("last")).select(F.col("id").alias("own"), "first"))
        again = (F.col("id") == F.col("own")) & (F.col("task") != F.col("first"))
        return items.join(several, again, "left_anti").drop("task")

    def _refine(self, items: DataFrame, levels: np.ndarray) -> DataFrame:
        """Cut clusters of differences: items that meet under every order stay together."""
        prefix = self._prefix

        def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches(rows, 512):
                out: list[list[np.ndarray]] = [[], []]
                names = ("cluster", "id", "n", "tokens", "least")
                columns = [batch.column(c).to_pylist() for c in names]
                for cluster, own, n, raw, least in zip(*columns, strict=True):
                    tokens = np.frombuffer(raw, np.uint64)
                    count, salt = prefix(len(tokens), n, least), cluster % (1 << 64)
                    for order in range(_ORDERS) if count else ():
                        first = _first_tokens(tokens, count, levels, order, salt)
                        out[0].append(np.full(len(first), own * _ORDERS + order, np.int64))
                        # Tokens of another cluster or order are others.
                        out[1].append(mix(mix(first ^ np.uint64(salt)) + np.uint64(order)).view(np.int64))
                if out[0]:
                    yield pa.record_batch([np.concatenate(c) for c in out], names=["id", "token"])

        prefixes = saved(items.mapInArrow(read, "id long, token long"))
        again = self._together(_meet(prefixes), _ORDERS)
        return items.drop("cluster").join(again, "id")

    def _local(self, group: pa.Table) -> pa.Table:
        """Links inside a cluster or between two blocks, as edges of a forest.

        Items of one `side` are linked with each other only where it is null.
        """
        ids = np.array(group.column("id").to_pylist(), np.int64)
        n = np.array(group.column("n").to_pylist(), np.int64)
        side = np.array([-1 if s is None else s for s in group.column("side").to_pylist()])
        sets = [np.frombuffer(t.as_py(), np.uint64) for t in group.column("tokens")]
        size = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), size)
        _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = count[column] > 1
        owner, column = owner[shared], column[shared]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        column = np.cumsum(np.diff(column, prepend=column[:1]) != 0) if len(column) else column
        common = np.zeros((len(sets), len(sets)), np.float32)
        step = 4096
        for begin in range(0, int(column[-1]) + 1 if len(column) else 0, step):
            part = slice(*np.searchsorted(column, [begin, begin + step]))
            incidence = np.zeros((len(sets), step), np.float32)
            incidence[owner[part], column[part] - begin] = 1
            common += incidence @ incidence.T
        link = np.zeros(common.shape, bool)
        blocks = [slice(i, i + _BLOCK) for i in range(0, len(sets), _BLOCK)]
        for rows in blocks:
            total = n[rows, None] + n
            apart = size[rows, None] + size - 2 * common[rows].astype(np.int64)
            close = (100 + self.percent) * apart <= (100 - self.percent) * total
            close &= (side[rows, None] < 0) | (side[rows, None] != side)
            link[rows] = close | (ids[rows, None] == ids)
        root = np.arange(len(sets))
        while True:
            lower = root.copy()
            for rows in blocks:
                reached = np.where(link[rows], root, len(sets)).min(axis=1, initial=len(sets))
                lower[rows] = np.minimum(lower[rows], reached)
            lower = lower[lower]
            if (lower == root).all():
                break
            root = lower
        joined = root != np.arange(len(sets))
        return pa.table({"a": ids[joined], "b": ids[root[joined]]})

    def _in_tasks(self, items: DataFrame, *key: str) -> DataFrame:
        def local(group: pa.Table) -> pa.Table:
            return self._local(group)

        return items.groupBy(*key).applyInArrow(local, "a long, b long")

    def _sized(self, items: DataFrame) -> DataFrame:
        """Adds `items` and `large`: whether the cluster is too large for one task.

        Sets that are alone in their cluster go.
        """
        sizes = items.groupBy("cluster").agg(F.count("*").alias("items"), F.sum("n").alias("held"))
        large = (F.col("items") > _MOST_ITEMS) | (F.col("held") > _MOST_TOKENS)
        sizes = sizes.where(F.col("items") > 1).select("cluster", "items", large.alias("large"))
        return items.join(sizes, "cluster")

    def _recenter(self, items: DataFrame, copies: DataFrame) -> DataFrame:
        """Each item's difference from its cluster's set with the most copies.

        `least` is the cluster's smallest excess, of the item `nearest`.
        """
        join = self

        def differ(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches(rows, 512):
                excess, out = [], []
                for n, raw, center in zip(
                    *(batch.column(c).to_pylist() for c in ("n", "tokens", "center")), strict=True
                ):
                    tokens = np.setxor1d(
                        np.frombuffer(raw, np.uint64), np.frombuffer(center, np.uint64), assume_unique=True
                    )
                    out.append(tokens.tobytes())
                    excess.append(join._excess(len(tokens), n))
                columns = [*(batch.column(c) for c in ("cluster", "id", "n")), pa.array(out, pa.binary())]
                yield pa.record_batch(
                    [*columns, pa.array(excess, pa.int64())],
                    names=["cluster", "id", "n", "tokens", "excess"],
                )

        best = (
            items.select("cluster", "id")
            .join(copies, "id")
            .groupBy("cluster")
            .agg(F.max(F.struct("copies", "id"))["id"].alias("id"))
        )
        centers = items.join(best, ["cluster", "id"]).dropDuplicates(["cluster"])
        salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
        centers = centers.select("cluster", F.col("tokens").alias("center"), salts.alias("salt"))
        salted = items.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(_SALTS)).cast("int"))
        paired = salted.join(centers, ["cluster", "salt"]).select("cluster", "id", "n", "tokens", "center")
        different = saved(paired.mapInArrow(differ, _ITEM + ", excess long"))
        least = different.groupBy("cluster").agg(F.min(F.struct("excess", "id")).alias("low"))
        least = least.select("cluster", F.col("low.excess").alias("least"), F.col("low.id").alias("nearest"))
        return saved(different.join(least, "cluster"))

    def _large(self, items: DataFrame, copies: DataFrame) -> DataFrame:
        """Links in clusters of any size.

        Items that with the cluster's nearest one to the center differ little
        enough from the center are linked with it without being compared; so
        are, through it, all pairs that could link without sharing a token of
        their differences. The others must share one, which cuts the cluster
        again. What is still large is compared in blocks, without pairs of
        blocks whose items are all linked already.
        """
        centered = self._recenter(items, copies)
        linked = F.col("excess") + F.col("least") <= 0
        stars = centered.where(linked & (F.col("id") != F.col("nearest")))
        edges = stars.select(F.col("id").alias("a"), F.col("nearest").alias("b"))

        def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sketch = _Sketch()
            for batch in rows:
                for cluster, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    sketch.add(np.frombuffer(raw, np.uint64), cluster % (1 << 64))
            chunks, counts = zip(*sketch.rows(), strict=True)
            yield pa.record_batch(
                [pa.array(chunks, pa.int32()), pa.array(counts, pa.binary())], names=["chunk", "counts"]
            )

        counted = centered.select("cluster", "tokens").mapInArrow(count, "chunk int, counts binary")
        again = self._refine(centered, _levels(counted))
        sized = saved(self._sized(again.withColumn("linked", linked)))
        edges = edges.unionByName(self._small(sized))

        blocks = F.greatest(F.ceil(F.col("items") / _BLOCK), F.lit(1)).cast("int")
        block = F.pmod(F.xxhash64("id"), blocks).cast("int") * 2 + F.col("linked").cast("int")
        large = sized.where("large").withColumn("blocks", blocks).withColumn("block", block)
        # Even blocks hold open items and meet all blocks; odd ones meet even ones.
        others = F.sequence(F.lit(0), F.col("blocks") * 2 - 1)
        meets = F.filter(others, lambda o: (F.col("block") % 2 == 0) | (o % 2 == 0))
        dealt = large.withColumn("other", F.explode(meets)).select(
            "cluster",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "id",
            "n",
            "tokens",
            F.when(F.col("block") != F.col("other"), F.col("block")).alias("side"),
        )
        return edges.unionByName(self._in_tasks(dealt, "cluster", "low", "high"))

    def _small(self, sized: DataFrame) -> DataFrame:
        small = sized.where(~F.col("large")).select("cluster", "id", "n", "tokens")
        return self._in_tasks(small.withColumn("side", F.lit(None).cast("int")), "cluster")

    def components(self, documents: DataFrame) -> DataFrame:
        """`doc_id`, `n_shingles` and `component_id` of every row.

        The smallest `doc_id` that links reach. A null or empty text has no
        shingles and links with nothing; nor does a row with a null `doc_id`,
        whose component is null. Texts with the same shingles are one set;
        repeated rows get the same result. An empty table gives no row. Columns
        other than `doc_id` and `text` are not looked at.
        """
        docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        known = saved(self.sets(docs))
        levels = _levels(known.where(F.col("chunk").isNotNull()).select("chunk", "counts"))
        rows = known.where(F.col("chunk").isNull()).select("doc_id", "n", "id")
        named = docs.where(F.col("doc_id").isNotNull())
        classes = (
            rows.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
            .groupBy("id")
            .agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.count("*").alias("copies"))
        )
        met = self._candidates(self._text_prefixes(named, levels), classes)
        chosen = saved(self._sized(classes.join(met, "id")))
        items = self._items(named, chosen.select("doc_id", "id", "cluster", "large"))
        found = self._small(items)
        # The rounds for large clusters have nothing to do where there are none.
        large = items.where("large").drop("large")
        if not chosen.where("large").isEmpty():
            sized = saved(self._sized(self._search_whole_sets(large)))
            found = found.unionByName(self._small(sized))
            large = sized.where("large").drop("items", "large")
            if not large.isEmpty():
                copies = chosen.select("id", "copies")
                found = found.unionByName(self._large(large, copies))
        links = connected_components(found)

        roots = links.select(F.col("node").alias("id"), "root")
        joined = classes.select("id", "doc_id").join(roots, "id", "left")
        root = F.coalesce("root", "id")
        least = joined.groupBy(root.alias("root")).agg(F.min("doc_id").alias("component_id"))
        of_class = joined.select("id", root.alias("root")).join(least, "root").select("id", "component_id")
        alone = (F.col("n") == 0) | F.col("doc_id").isNull()
        return rows.join(of_class, "id", "left").select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        )


def link_documents(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """`JaccardJoin.components` with the given shingles and similarity."""
    return JaccardJoin(words, percent).components(documents)
