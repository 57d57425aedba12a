"""Removal of long repeated strings by a hash-compared suffix sort."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.llm.hashing import data_id, mix, powers
from marketbars.llm.shared import batches, partitions, saved
from marketbars.llm.tokens import forget

# Bytes whose hash picks anchors.
_GRAM = 16
# Bytes compared at a time, and searched for anchors at a time.
_CHUNK = 3 << 20
_SEGMENT = 1 << 23
# Anchors of a group that are compared in one task.
_MOST = 16_384
_ANCHOR = "id long, at long, low long, high long, code long, place long, twice boolean"


class Prefixes:
    """Prefix polynomial hashes of a byte string."""

    def __init__(self, code: np.ndarray) -> None:
        self.code = code
        self._powers, self._inverses = powers(len(code) + 1)
        self._total = np.zeros(len(code) + 1, np.uint64)
        np.cumsum((code.astype(np.uint64) + np.uint64(1)) * self._powers[:-1], out=self._total[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self._total[end] - self._total[start]) * self._inverses[start]

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """Longest common extension of places a and b, to the right (1) or left (-1)."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
        for _ in range(int(most.max(initial=0)).bit_length()):
            middle = (low + high + 1) >> 1
            if step > 0:
                same = self.hash(a, a + middle) == self.hash(b, b + middle)
            else:
                same = self.hash(a - middle, a) == self.hash(b - middle, b)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def anchors(code: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places that equal strings of `length` bytes share, and the strings of each.

    Each string of `length` bytes has its anchor where the hash of 16 bytes is
    smallest (the first of equals) among those that begin in its first three
    quarters: equal strings have it at the same offset. Returned are anchors
    with the first and the last start of the strings that have them.
    """
    reach = length * 3 // 4
    found: list[list[np.ndarray]] = [[], [], []]
    for begin in range(0, max(len(code) - length + 1, 0), _SEGMENT):
        part = code[begin : begin + _SEGMENT + length - 1]
        n = len(part) - _GRAM + 1
        wide = np.zeros(len(part) - 7, np.uint64)
        for k in range(8):
            wide |= part[k : len(part) - 7 + k].astype(np.uint64) << np.uint64(8 * k)
        gram = mix(wide[:n] ^ mix(wide[8 : 8 + n] + np.uint64(1)))
        lowest = gram >> np.uint64(24) << np.uint64(24) | np.arange(n, dtype=np.uint64)
        width = 1
        while width * 2 <= reach:
            lowest = np.minimum(lowest[:-width], lowest[width:])
            width *= 2
        if width < reach:
            lowest = np.minimum(lowest[: len(lowest) - (reach - width)], lowest[reach - width :])
        starts = len(part) - length + 1
        at = (lowest[:starts] & np.uint64((1 << 24) - 1)).astype(np.int64)
        (first,) = np.nonzero(np.diff(at, prepend=-1))
        last = np.append(first[1:], starts) - 1
        for out, values in zip(found, (at[first], first, last), strict=True):
            out.append(values + begin)
    return tuple(np.concatenate(f) if f else np.zeros(0, np.int64) for f in found)


def _surroundings(
    code: np.ndarray, sizes: tuple[int, ...]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A text's anchors, and for each the first one with the same strings around it.

    `sizes` are the strings' lengths. Anchors are those of the shortest: longer
    ones begin with it. The last array has the hashes of what follows each anchor
    in all its strings.
    """
    length, longest = min(sizes), max(sizes)
    at, low, high = anchors(code, length)
    prefixes = Prefixes(code)
    end = np.minimum(high + longest, len(code))
    shape = mix((at - low << 32 | high - low).astype(np.uint64)) + mix((end - high).astype(np.uint64))
    around = mix(prefixes.hash(low, end) ^ shape)
    _, first, which = np.unique(around, return_index=True, return_inverse=True)
    follows = length - length * 3 // 4 + 1
    return at, low, high, first[which], mix(prefixes.hash(at, at + follows)).view(np.int64)


def _own_repeats(data: bytes, sizes: tuple[int, ...]) -> list[tuple[int, int, int]]:
    """Parts (size, start, end) whose strings come again around another own anchor."""
    _, low, high, first, _ = _surroundings(np.frombuffer(data, np.uint8), sizes)
    out = []
    for i in np.flatnonzero(first != np.arange(len(first))).tolist():
        j = int(first[i])
        if data[low[i] : high[i] + max(sizes)] == data[low[j] : high[j] + max(sizes)]:
            for k in (i, j):
                ends = ((n, min(int(high[k]) + n, len(data))) for n in sizes)
                out += [(n, int(low[k]), end) for n, end in ends if end - low[k] >= n]
    return out


def _sorted_within(
    prefixes: Prefixes, at: np.ndarray, room: np.ndarray, group: np.ndarray, step: int
) -> np.ndarray:
    """Mergesort of the suffixes (or reversed prefixes) at `at`, inside each group.

    Groups are runs of equal values. All pairs of runs of a pass are merged at
    once: an element's place is its own in its run and, by binary search, the
    number of smaller ones in the other run. Two suffixes are compared at the
    end of their longest common extension, which the hashes give in a
    logarithmic number of steps.
    """
    code = prefixes.code
    order = np.arange(len(at))
    begin = np.searchsorted(group, group, "left")
    size = np.searchsorted(group, group, "right") - begin
    own = order - begin
    width = 1
    while width < int(size.max(initial=1)):
        pair = own // (2 * width) * (2 * width)
        in_left = own - pair < width
        low = begin + np.where(in_left, np.minimum(pair + width, size), pair)
        high = begin + np.where(in_left, np.minimum(pair + 2 * width, size), pair + width)
        other = low.copy()
        active = np.flatnonzero(low < high)
        while len(active):
            middle = (low[active] + high[active]) >> 1
            x, y = order[active], order[middle]
            most = np.minimum(room[x], room[y])
            shared = prefixes.common(at[x], at[y], most, step)
            inside = shared < most
            offset = shared if step > 0 else -shared - 1
            cx = code[np.where(inside, at[x] + offset, 0)].astype(np.int64)
            cy = code[np.where(inside, at[y] + offset, 0)].astype(np.int64)
            # -1: y before x; 1: after. A suffix comes before those it begins.
            sign = np.where(inside, np.sign(cy - cx), np.sign(room[y] - room[x]))
            before = np.where(in_left[active], sign < 0, sign <= 0)
            low[active] = np.where(before, middle + 1, low[active])
            high[active] = np.where(before, high[active], middle)
            active = active[low[active] < high[active]]
        place = begin + pair + (own - pair - np.where(in_left, 0, width)) + (low - other)
        merged = np.empty_like(order)
        merged[place] = order
        order = merged
        width *= 2
    return order


def _longest(
    prefixes: Prefixes, at: np.ndarray, room: np.ndarray, group: np.ndarray, step: int
) -> tuple[np.ndarray, np.ndarray]:
    """Each place's longest common extension with any other of its group, and with which."""
    order = _sorted_within(prefixes, at, room, group, step)
    x, y = order[:-1], order[1:]
    most = np.where(group[x] == group[y], np.minimum(room[x], room[y]), 0)
    shared = np.zeros(len(at) + 1, np.int64)
    shared[1:-1] = prefixes.common(at[x], at[y], most, step)
    # Sorted, a place has a neighbour on either side.
    after = shared[1:] >= shared[:-1]
    beside = np.clip(np.arange(len(at)) + np.where(after, 1, -1), 0, len(at) - 1)
    out, partner = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    out[order] = np.maximum(shared[1:], shared[:-1])
    partner[order] = order[beside]
    return out, partner


def _same_bytes(code: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    out = np.zeros(len(a), bool)
    for i in range(0, len(a), 4096):
        span = np.arange(length)
        left, right = a[i : i + 4096, None] + span, b[i : i + 4096, None] + span
        out[i : i + 4096] = (code[left] == code[right]).all(axis=1)
    return out


def shared_parts(
    prefixes: Prefixes,
    at: np.ndarray,
    room: tuple[np.ndarray, np.ndarray],
    found: tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
    length: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What anchors share with the other that agrees most to the right, or to the left.

    `found` has the longest extensions to the left and right with their partners.
    Returned are the anchors that share `length` bytes or more, and how many on
    either side.
    """
    out = []
    for side in (0, 1):
        own, partner = found[side]
        # The other side, with the same partner.
        most = np.minimum(room[1 - side], room[1 - side][partner])
        most = np.where(own > 0, most, 0)
        beyond = prefixes.common(at, at[partner], most, 1 if side == 0 else -1)
        left, right = (own, beyond) if side == 0 else (beyond, own)
        (enough,) = np.nonzero(left + right >= length)
        out.append((enough, left[enough], right[enough]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def repeated_parts(
    prefixes: Prefixes,
    at: np.ndarray,
    group: np.ndarray,
    to_left: np.ndarray,
    to_right: np.ndarray,
    length: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where strings of `length` bytes around anchors are repeated in their group.

    Where an anchor's extensions add up to less than `length` nothing is
    repeated. The strings between are held against each other by hash, and equal
    ones byte by byte. Returned are the anchors' indices and the first and last
    offset, counted from the anchor to the left, of their repeated strings.
    """
    code = prefixes.code
    low, high = length - to_right, to_left
    (open_,) = np.nonzero(low <= high)
    count = (high - low + 1)[open_]
    who = np.repeat(open_, count)
    offset = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count) + low[who]
    start = at[who] - offset
    # Strings are alike only at the same offset in the same group.
    place = mix(group[who].astype(np.uint64) << np.uint64(24) | offset.astype(np.uint64))
    key = mix(prefixes.hash(start, start + length) ^ place)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    first = np.flatnonzero(np.diff(sorted_key, prepend=sorted_key[:1] + np.uint64(1)))
    size = np.diff(np.append(first, len(order)))
    many = np.repeat(size > 1, size)
    lead = np.repeat(order[first], size)[many]
    order = order[many]
    # Collisions: a string that differs from its class's first is no copy of it.
    same = _same_bytes(code, start[order], start[lead], length)
    twin = np.zeros(len(who), bool)
    follows = same & (order != lead)
    twin[order[follows]] = True
    twin[lead[follows]] = True
    who, offset = who[twin], offset[twin]
    index, first = np.unique(who, return_index=True)
    if not len(index):
        return index, index, index
    return index, np.minimum.reduceat(offset, first), np.maximum.reduceat(offset, first)


def _spans(parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts, joined where they touch or overlap."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(parts):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _keyed(documents: DataFrame) -> DataFrame:
    """`doc_id`, the text's 64-bit `id`, its size and its SHA-256."""

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in rows:
            data = [(t or "").encode("utf-8", "replace") for t in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([data_id(d) for d in data], pa.int64()),
                    pa.array([len(d) for d in data], pa.int64()),
                    pa.array([hashlib.sha256(d).hexdigest() for d in data], pa.string()),
                ],
                names=["doc_id", "id", "n_bytes", "sha256"],
            )

    return documents.mapInArrow(read, "doc_id long, id long, n_bytes long, sha256 string")


def _anchors(documents: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """The anchors of all texts, with the hash of what follows each in all its strings.

    Of a text's anchors with the same strings around them, as in a run of one
    word, the first stands for all and is marked as `twice`.
    """
    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches(rows, 1024):
            out: list[list[np.ndarray]] = [[], [], [], [], [], []]
            for text in batch.column(0).to_pylist():
                data = (text or "").encode("utf-8", "replace")
                own = data_id(data)
                if len(data) < min(sizes) or own in seen:
                    continue
                seen.add(own)
                at, low, high, first, hashed = _surroundings(np.frombuffer(data, np.uint8), sizes)
                one, count = np.unique(first, return_counts=True)
                ids = np.full(len(one), own, np.int64)
                columns = (ids, at[one], low[one], high[one], hashed[one], count > 1)
                for column, values in zip(out, columns, strict=True):
                    column.append(values)
            if out[0]:
                *columns, twice = (np.concatenate(c) for c in out)
                place = mix(mix(columns[0].view(np.uint64)) + columns[1].view(np.uint64)).view(np.int64)
                yield pa.record_batch(
                    [pa.array(c) for c in (*columns, place, twice)],
                    names=["id", "at", "low", "high", "code", "place", "twice"],
                )

    return documents.select("text").mapInArrow(read, _ANCHOR)


def _contexts(texts: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """What lies around the chosen anchors of each text: all bytes of their strings."""

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["code", "id", "first", "left", "bytes"]
        for batch in batches(rows, 256):
            out: list[tuple] = []
            for own, text, chosen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode("utf-8", "replace")
                for x in (x for x in chosen if x["frequent"] is False):
                    around = data[x["low"] : x["high"] + max(sizes)]
                    out.append((x["code"], own, x["low"], x["at"] - x["low"], around))
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return texts.mapInArrow(read, "code long, id long, first long, left long, bytes binary")


def _frequent(texts: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """Repeated parts around anchors of groups of any size, by the strings' digests.

    Each string around such an anchor is a row of its digest and place, so that
    a group is spread over as many tasks as its strings; the rows of a string
    are reduced to their smallest and largest place before the shuffle.
    """

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 64):
            out: list[tuple] = []
            for own, text, chosen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode("utf-8", "replace")
                for x in chosen:
                    for n in sizes if x["frequent"] else ():
                        for start in range(x["low"], min(x["high"], len(data) - n) + 1):
                            digest = hashlib.blake2b(data[start : start + n], digest_size=16)
                            out.append((digest.digest(), own, start, n))
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
            names = ["digest", "id", "start", "size"]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
            )

    texts = texts.where(F.exists("chosen", lambda x: x["frequent"]))
    strings = texts.mapInArrow(read, "digest binary, id long, start long, size long")
    place = F.struct("id", "start")
    twice = (
        strings.groupBy("digest")
        .agg(F.min(place).alias("least"), F.max(place).alias("most"))
        .where(F.col("least") != F.col("most"))
        .select("digest")
    )
    return strings.join(twice, "digest", "left_semi").select(
        "id", "size", "start", (F.col("start") + F.col("size")).alias("end")
    )


def _compare(contexts: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """Repeated parts of each text. Each partition holds whole groups, sorted by `code`."""

    def chunk(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        code = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
        size = np.array([len(r[4]) for r in rows])
        left = np.array([r[3] for r in rows])
        at = np.cumsum(size) - size + left
        _, group = np.unique(np.array([r[0] for r in rows]), return_inverse=True)
        prefixes = Prefixes(code)
        # Sorted to either side, the longest extension is that with a neighbour.
        found = (
            _longest(prefixes, at, left, group, -1),
            _longest(prefixes, at, size - left, group, 1),
        )
        longest = max(sizes)
        index, low, high = repeated_parts(prefixes, at, group, found[0][0], found[1][0], longest)
        yield parts(rows, longest, index, left, -high, longest - low)
        if min(sizes) < longest:
            room = (left, size - left)
            index, before, after = shared_parts(prefixes, at, room, found, min(sizes))
            yield parts(rows, min(sizes), index, left, -before, after)

    def parts(
        rows: list[tuple], n: int, index: np.ndarray, left: np.ndarray, start: np.ndarray, end: np.ndarray
    ) -> pa.RecordBatch:
        """Parts of texts, given from the anchors on."""
        anchor = np.array([r[2] for r in rows])[index] + left[index]
        columns = [
            pa.array([rows[i][1] for i in index.tolist()], pa.int64()),
            pa.array(np.full(len(index), n), pa.int64()),
            pa.array(anchor + start),
            pa.array(anchor + end),
        ]
        return pa.record_batch(columns, names=["id", "size", "start", "end"])

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group: list[tuple] = []
        bytes_held = 0
        for batch in batches(rows, 1024):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[0] != group[0][0]:
                    held += group
                    group = []
                    if bytes_held >= _CHUNK:
                        yield from chunk(held)
                        held, bytes_held = [], 0
                group.append(row)
                bytes_held += len(row[4])
        if held or group:
            yield from chunk(held + group)

    return contexts.mapInArrow(read, "id long, size long, start long, end long")


def remove_repeats(
    documents: DataFrame,
    length: int = 400,
    keep_text: bool = False,
    most: int = _MOST,
    also: int | None = None,
) -> DataFrame:
    """Remove every byte that lies in a string of `length` bytes found anywhere else.

    Strings are judged on the texts as they come, within one document and
    across documents; overlapping ones count; matches never cross documents.

    Anchors are shuffled, about one in `length` * 3/8 bytes, and each text once,
    to its anchors. Those whose following bytes occur once have no copy and go;
    around the others the bytes of all their strings are brought together by
    those following bytes and sorted there (see `repeated_parts`). Equal texts
    are one text with copies.
    Groups of more than `most` anchors, as from one passage in very many
    documents, are too large for one task and go by `_frequent` instead.

    Result: `doc_id`, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256`, one row
    for each row, and with `keep_text` the other bytes as `kept` (invalid UTF-8
    at the cuts is dropped; the text itself where nothing is removed). With `also`,
    a shorter length, `n_repeated` counts bytes in strings of that length found
    anywhere else, from the same anchors; nothing else depends on it. It is a lower
    bound: in a group of many, an anchor is held against the two others that
    agree with it most, to the left and to the right. A null text is empty; repeated rows are copies of each other; an empty table gives
    no row. Columns other than `doc_id` and `text` are not looked at.
    """
    spark = documents.sparkSession
    if also is not None and not _GRAM * 2 <= also < length:
        raise ValueError(f"also must be less than {length} and at least {_GRAM * 2}")
    sizes = (length,) if also is None else (length, also)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = saved(_keyed(docs))
    found = saved(_anchors(docs, sizes))
    shared = (
        found.groupBy("code")
        .agg(F.min("place").alias("least"), F.max("place").alias("most"), F.count("*").alias("n"))
        .where(F.col("least") < F.col("most"))
        .select("code", (F.col("n") > most).alias("frequent"))
    )
    # Strings that come again in their own text need no other text.
    chosen = (
        found.join(shared, "code", "left")
        .where(F.col("frequent").isNotNull() | F.col("twice"))
        .groupBy("id")
        .agg(
            F.collect_set(F.struct("at", "low", "high", "code", "frequent")).alias("chosen"),
            F.max("twice").alias("twice"),
        )
    )
    texts = _with_ids(docs).groupBy("id").agg(F.first("text").alias("text"))
    texts = saved(texts.join(chosen, "id").select("id", "text", "chosen", "twice"))
    contexts = _contexts(texts.select("id", "text", "chosen"), sizes)
    dealt = contexts.repartition(partitions(spark), "code").sortWithinPartitions("code")
    repeated = _compare(dealt, sizes).unionByName(
        _frequent(texts.select("id", "text", "chosen"), sizes)
    )
    parts = repeated.groupBy("id").agg(F.collect_set(F.struct("size", "start", "end")).alias("parts"))

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = ["id", "n_removed", "n_spans", "n_repeated", "kept_sha256", "kept"]
        for batch in batches(rows, 512):
            out: list[tuple] = []
            for own, text, twice, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data, keep, at = text.encode("utf-8", "replace"), [], 0
                parts = [(p["size"], p["start"], p["end"]) for p in found or ()]
                parts += _own_repeats(data, sizes) if twice else []
                spans, again = (_spans([p[1:] for p in parts if p[0] == n]) for n in (length, min(sizes)))
                for start, end in spans:
                    keep.append(data[at:start])
                    at = end
                kept = b"".join([*keep, data[at:]])
                shown = kept.decode("utf-8", "ignore") if keep_text else None
                digest = hashlib.sha256(kept).hexdigest()
                n_repeated = sum(end - start for start, end in again)
                out.append((own, len(data) - len(kept), len(spans), n_repeated, digest, shown))
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    cuts = texts.join(parts, "id", "left").where(F.col("parts").isNotNull() | F.col("twice"))
    cuts = cuts.select("id", "text", "twice", "parts")
    cuts = cuts.mapInArrow(
        cut, "id long, n_removed long, n_spans long, n_repeated long, kept_sha256 string, kept string"
    )
    copies = known.groupBy("id").agg(F.count("*").alias("copies")).where(F.col("copies") > 1)
    whole = F.col("copies").isNotNull() & (F.col("n_bytes") >= length)
    again = F.col("copies").isNotNull() & (F.col("n_bytes") >= min(sizes))
    n_repeated = F.when(again, F.col("n_bytes")).otherwise(F.coalesce("n_repeated", F.lit(0)))
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        known.join(cuts, "id", "left")
        .join(copies, "id", "left")
        .select(
            "doc_id",
            "id",
            "n_bytes",
            F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            *([n_repeated.alias("n_repeated")] if also else []),
            F.when(whole, nothing).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
            F.when(whole, "").otherwise(F.col("kept")).alias("kept"),
        )
    )


def _with_ids(docs: DataFrame) -> DataFrame:
    """`id` and `text` of every text that is not missing."""

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            ids = [data_id(t.encode("utf-8", "replace")) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array(ids, pa.int64()), batch.column(0)], names=["id", "text"])

    return docs.select("text").where(F.col("text").isNotNull()).mapInArrow(read, "id long, text string")
