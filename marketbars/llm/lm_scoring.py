"""Scores of texts by prediction by partial matching over bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.hashing import byte_word_hashes
from marketbars.llm.shared import saved

# Bytes that UTF-8 never has: before the first byte of a text, and its end.
_BEGIN, _END = 0xFE, 0xFF
_ALPHABET = 255
_BLOCK_BYTES = 24 << 20
_SEGMENT = 1 << 20
# Entries that are held before they are merged.
_UNMERGED = 1_500_000
# Pairs whose code lengths are worked out at a time.
_RUN = 1 << 20
_SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


class Contexts:
    """The nodes of one order: sorted contexts, and the symbols seen after each.

    `entry` is context * 256 + symbol of every seen pair, sorted.
    """

    def __init__(self, entry: np.ndarray, count: np.ndarray) -> None:
        seen = count > 0
        entry, count = entry[seen], count[seen]
        self.entry, first = np.unique(entry, return_index=True)
        order = np.argsort(entry, kind="stable")
        first = np.searchsorted(entry[order], self.entry)
        self.count = np.add.reduceat(count[order], first) if len(first) else count
        self.context, start = np.unique(self.entry >> np.uint64(8), return_index=True)
        self.total = np.add.reduceat(self.count, start) if len(start) else self.count
        self.kinds = np.diff(np.append(start, len(self.entry)))
        self._start = start

    @staticmethod
    def _find(table: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
        """`values` of the keys that are in a sorted table, else 0."""
        if not len(table):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return np.where(table[at] == keys, values[at], 0)

    def count_of(self, entry: np.ndarray) -> np.ndarray:
        return self._find(self.entry, entry, self.count)

    def total_of(self, context: np.ndarray) -> np.ndarray:
        return self._find(self.context, context, self.total)

    def kinds_of(self, context: np.ndarray) -> np.ndarray:
        return self._find(self.context, context, self.kinds)

    def excluded(self, parent: Contexts) -> np.ndarray:
        """What the symbols seen in each context count in its parent.

        A parent's context is the same without its oldest byte, the lowest.
        """
        shorter = (self.entry >> np.uint64(16) << np.uint64(8)) | (self.entry & np.uint64(255))
        counts = parent.count_of(shorter)
        return np.add.reduceat(counts, self._start) if len(self._start) else counts


def lower_orders(
    keys: np.ndarray, counts: np.ndarray, order: int, least: int = 0
) -> list[Contexts]:
    """Contexts of the orders from `least` on, from pairs of `order` bytes and a symbol."""
    out = []
    symbol = keys & np.uint64(255)
    for k in range(least, order + 1):
        context = keys >> np.uint64(8 * (order - k + 1))
        out.append(Contexts(context << np.uint64(8) | symbol, counts))
    return out


def code_lengths(keys: np.ndarray, orders: list[Contexts]) -> np.ndarray:
    """log10 probability of each symbol after its context.

    From the longest context down: a symbol seen there has (count - 1/2) of the
    total, the escape to the next shorter context half of the number of kinds
    (method D). Symbols seen in a longer context are excluded from the shorter
    one's counts. After the empty context all bytes left are equally likely.
    """
    order = len(orders) - 1
    symbol = keys & np.uint64(255)
    out = np.zeros(len(keys))
    open_ = np.ones(len(keys), bool)
    gone = np.zeros(len(keys), np.int64)
    gone_kinds = np.zeros(len(keys), np.int64)
    for k in range(order, -1, -1):
        here = orders[k]
        context = keys >> np.uint64(8 * (order - k + 1))
        total = here.total_of(context) - gone
        kinds = here.kinds_of(context) - gone_kinds
        count = here.count_of(context << np.uint64(8) | symbol)
        known = open_ & (total > 0)
        hit = known & (count > 0)
        out[hit] += np.log10((count[hit] - 0.5) / total[hit])
        miss = known & (count == 0)
        out[miss] += np.log10(kinds[miss] * 0.5 / total[miss])
        open_ &= ~hit
        if k:
            excluded = here.excluded(orders[k - 1])
            gone = Contexts._find(here.context, context, excluded)
            gone_kinds = here.kinds_of(context)
    left = _ALPHABET - int(orders[0].kinds.sum())
    out[open_] -= np.log10(max(left, 1))
    return out


def _segments(datas: list[bytes], order: int) -> Iterator[tuple[list[int], list[bytes]]]:
    """Documents' bytes with their marks, some at a time, long ones in parts.

    Each part begins with the `order` bytes before it.
    """
    who: list[int] = []
    parts: list[bytes] = []
    held, most = 0, 1 << (64 - 8 * (order + 1))
    for i, data in enumerate(datas):
        marked = bytes([_BEGIN]) * order + data + bytes([_END])
        for begin in range(0, len(marked) - order, _SEGMENT):
            part = marked[begin : begin + _SEGMENT + order]
            if parts and (held + len(part) > 2 * _SEGMENT or len(parts) == most):
                yield who, parts
                who, parts, held = [], [], 0
            who.append(i)
            parts.append(part)
            held += len(part)
    if parts:
        yield who, parts


def _events(parts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted pairs of context and symbol, and the part that each is from."""
    code = np.frombuffer(b"".join(parts), np.uint8)
    n = len(code) - order
    key = np.zeros(n, np.uint64)
    # The newest byte of the context is the highest.
    for j in [*range(order - 1, -1, -1), order]:
        key = key << np.uint64(8) | code[j : j + n]
    size = np.array([len(p) for p in parts])
    part = np.repeat(np.arange(len(parts), dtype=np.uint64), size)[order:]
    inside = np.ones(len(code), bool)
    first = np.cumsum(size) - size
    for j in range(order):
        inside[first + j] = False
    bits = np.uint64(64 - 8 * (order + 1))
    joint = (key << bits | part)[inside[order:]]
    joint.sort()
    return joint >> bits, joint & ((np.uint64(1) << bits) - np.uint64(1))


def _deal(documents: DataFrame, blocks: int) -> DataFrame:
    """Documents as compressed parcels, each of one block's in an Arrow batch."""

    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            block = batch.column(3).to_numpy()
            order = np.argsort(block, kind="stable")
            number, first = np.unique(block[order], return_index=True)
            parcels = []
            for some in np.split(order, first[1:]) if len(order) else []:
                part = batch.select([0, 1, 2]).take(pa.array(some))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                    writer.write_batch(part)
                parcels.append(sink.getvalue().to_pybytes())
            yield pa.record_batch(
                [pa.array(number, pa.int64()), pa.array(parcels, pa.binary())], names=["block", "parcel"]
            )

    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block")
    return documents.select("doc_id", "text", "held_out", block).mapInArrow(pack, "block long, parcel binary")


def _opened(table: pa.Table) -> Iterator[tuple[list, list[bytes], np.ndarray]]:
    """Ids, bytes with A-Z lowered, and whether to learn from them; some at a time."""
    for parcel in table.column("parcel"):
        for batch in pa.ipc.open_stream(parcel.as_buffer()):
            for at in range(0, batch.num_rows, 1024):
                ids, texts, held_out = (c.to_pylist() for c in batch.slice(at, 1024).columns)
                datas = [(t or "").encode("utf-8", "replace").lower() for t in texts]
                yield ids, datas, ~np.array(held_out, bool)


class _Counts:
    """Sums by key, merged from time to time."""

    def __init__(self) -> None:
        self._parts: list[tuple[np.ndarray, np.ndarray]] = []
        self._held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._parts.append((keys, counts))
        self._held += len(keys)
        if self._held > _UNMERGED:
            self._parts = [self.merged()]
            self._held = 0

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self._parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys = np.concatenate([k for k, _ in self._parts])
        counts = np.concatenate([c for _, c in self._parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = _firsts(keys)
        return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal sorted keys begins."""
    return np.flatnonzero(np.diff(keys, prepend=keys[:1] + np.uint64(1)))


def _count_events(counts: _Counts, datas: list[bytes], train: np.ndarray, order: int) -> None:
    for who, parts in _segments(datas, order):
        key, part = _events(parts, order)
        learned = train[np.array(who)][part.astype(np.int64)].astype(np.int64)
        first = _firsts(key)
        if len(first):
            counts.add(key[first], np.add.reduceat(learned, first))


def _words(datas: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All words of some documents, and the document of each."""
    words = [byte_word_hashes(d) for d in datas]
    return np.concatenate(words), np.repeat(np.arange(len(words)), [len(w) for w in words])


def _count_words(counts: _Counts, datas: list[bytes], train: np.ndarray) -> None:
    words, who = _words(datas)
    kind, at = np.unique(words, return_inverse=True)
    counts.add(kind, np.bincount(at, train[who], len(kind)).astype(np.int64))


def score_documents(documents: DataFrame, order: int = 5) -> DataFrame:
    """Score all whole texts, learning from those that are not held out.

    The model is a trie of the contexts of up to `order` bytes, with the counts
    of the bytes after them in all training texts, A-Z lowered; see
    `code_lengths`. It is learned first and then fixed. A text's score is the
    log10 probability of its bytes and its end. `base_score` is that of its
    words and its end under the training words' frequencies, plus one.

    Result: `doc_id`, `held_out`, `n_tokens`, `n_known`, `train_tokens`,
    `base_score`, `score`, one row for each row. A null text is empty and has
    its end alone; a null `doc_id` is learned from; repeated rows count and are
    scored each; without training texts all bytes are equally likely; an empty
    table gives no row. Other columns are not looked at.

    Neither trie nor word counts are ever in one place. Texts are dealt into
    blocks of 24 MB on average, in which a text and the rows that repeat it with
    its `doc_id` stay together, whatever their size; a block asks once for each pair of context and
    symbol, and each word, that it has; counts are added up by pair, code
    lengths are worked out in a pass over the sorted pairs, a million or the
    pairs of one context of three bytes at a time, and go back to the blocks
    that asked. Only the trie's first two
    levels, 65,536 pairs at most, go to the driver and all tasks. Words are
    known by 64-bit hashes.
    """
    if not 2 <= order <= 6:
        raise ValueError(f"order must be from 2 to 6, not {order}")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = docs.withColumn("held_out", is_held_out(F.col("doc_id")))
    size, texts = docs.agg(
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.when(~F.col("held_out"), 1))
    ).first()
    # At least a block for each core, where there is something to share out.
    cores = docs.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-size // _BLOCK_BYTES), min(cores, size >> 20))

    def ask(table: pa.Table) -> pa.Table:
        events, words = _Counts(), _Counts()
        for _, datas, train in _opened(table):
            _count_events(events, datas, train, order)
            _count_words(words, datas, train)
        keys, counts = zip(events.merged(), words.merged(), strict=True)
        both = np.concatenate(keys).view(np.int64)
        pa.default_memory_pool().release_unused()
        return pa.table(
            {
                "block": np.full(len(both), table.column("block")[0].as_py(), np.int64),
                "word": np.repeat([False, True], [len(k) for k in keys]),
                "key": both,
                "n": np.concatenate(counts),
            }
        )

    schema = "block long, word boolean, key long, n long"
    asked = saved(_deal(docs, blocks).groupBy("block").applyInArrow(ask, schema))
    events = asked.where(~F.col("word")).select("block", "key", "n")
    words = asked.where("word").select("block", "key", "n")

    word_counts = words.groupBy("key").agg(F.sum("n").alias("count"), F.count("*").alias("blocks"))
    word_counts = saved(word_counts)
    seen = word_counts.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("n"),
        F.count(F.when(F.col("count") > 0, 1)).alias("kinds"),
    ).first()
    train_tokens, kinds = seen.n + texts, seen.kinds + (texts > 0)

    pairs = saved(events.groupBy("key").agg(F.sum("n").alias("n")))
    newest = F.shiftright("key", 8 * order).alias("newest")
    top = (
        pairs.where(F.col("n") > 0)
        .groupBy(newest, F.col("key").bitwiseAND(F.lit(255)).alias("symbol"))
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    first_keys = np.array([r.newest << 8 | r.symbol for r in top], np.uint64)
    first_counts = np.array([r.n for r in top], np.int64)

    upper = lower_orders(first_keys, first_counts, 1)

    def run(keys: np.ndarray, counts: np.ndarray, second: list[np.ndarray]) -> pa.RecordBatch:
        """Code lengths of pairs that hold whole contexts of three bytes."""
        keys = keys.view(np.uint64)
        orders = upper + [Contexts(second[0].view(np.uint64), second[1])]
        lengths = code_lengths(keys, orders + lower_orders(keys, counts, order, 3))
        return pa.record_batch([keys.view(np.int64), lengths], names=["key", "value"])

    def answer(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        three = 8 * (order - 2)
        second = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        for batch in rows:
            pair = batch.column("level").to_numpy() == 1
            both = [batch.column(c).to_numpy() for c in ("key", "n")]
            second = [np.append(old, new[~pair]) for old, new in zip(second, both, strict=True)]
            held = [np.append(old, new[pair]) for old, new in zip(held, both, strict=True)]
            keys, counts = held
            if len(keys) < _RUN:
                continue
            # The last context of three bytes may go on.
            cut = int(np.searchsorted(keys >> three, keys[-1] >> three))
            if cut:
                yield run(keys[:cut], counts[:cut], second)
                held = [keys[cut:], counts[cut:]]
                needed = second[0] >> 8 >= keys[cut] >> (8 * (order - 1))
                second = [x[needed] for x in second]
        if len(held[0]):
            yield run(*held, second)

    # The counts after two bytes come before the pairs that end with these two.
    two = F.shiftright("key", 8 * (order - 1)).alias("two")
    symbol = F.col("key").bitwiseAND(F.lit(255))
    after_two = F.shiftleft(two, 8).bitwiseOR(symbol).alias("key")
    second = pairs.where(F.col("n") > 0).groupBy(two, after_two).agg(F.sum("n").alias("n"))
    levels = second.select("two", F.lit(0).alias("level"), "key", "n").unionByName(
        pairs.select(two, F.lit(1).alias("level"), "key", "n")
    )
    together = levels.repartition("two").sortWithinPartitions("two", "level", "key")
    lengths = together.mapInArrow(answer, "key long, value double")
    shared = word_counts.where(F.col("blocks") > 1)
    answers = (
        events.join(lengths, "key")
        .select("block", "key", "value")
        .unionByName(words.join(shared, "key").select("block", "key", (F.col("count") + 1.0).alias("value")))
    )

    def score(table: pa.Table, replies: pa.Table) -> pa.Table:
        # Code lengths come as negative numbers, counts of words plus one.
        key, value = replies.column("key").to_numpy().view(np.uint64), replies.column("value").to_numpy()
        order_by = np.argsort(key)
        key, value = key[order_by], value[order_by]
        known, lengths = key[value < 0], value[value < 0]
        counts = _Counts()
        for _, datas, train in _opened(table):
            _count_words(counts, datas, train)
        kind, count = counts.merged()
        count[np.searchsorted(kind, key[value > 0])] = value[value > 0].astype(np.int64) - 1
        below = train_tokens + kinds + 1
        out = []
        for ids, datas, train in _opened(table):
            total = np.zeros(len(datas))
            for who, parts in _segments(datas, order):
                event, part = _events(parts, order)
                first = _firsts(event)
                often = np.diff(np.append(first, len(event)))
                each = np.repeat(lengths[np.searchsorted(known, event[first])], often)
                np.add.at(total, np.array(who), np.bincount(part.astype(np.int64), each, len(parts)))
            words, who = _words(datas)
            often = count[np.searchsorted(kind, words)]
            base = np.bincount(who, np.log10((often + 1) / below), len(datas))
            n_known = np.bincount(who, often > 0, len(datas)).astype(np.int64)
            out.append(
                pa.table(
                    {
                        "doc_id": pa.array(ids, pa.int64()),
                        "held_out": ~train,
                        "n_tokens": np.bincount(who, minlength=len(datas)) + 1,
                        "n_known": n_known + int(texts > 0),
                        "train_tokens": np.full(len(datas), train_tokens, np.int64),
                        "base_score": base + np.log10((texts + 1) / below),
                        "score": total,
                    }
                )
            )
        pa.default_memory_pool().release_unused()
        return pa.concat_tables(out)

    parcels = _deal(docs, blocks).groupBy("block")
    return parcels.cogroup(answers.groupBy("block")).applyInArrow(score, _SCORES)
