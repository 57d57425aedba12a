"""Benchmark decontamination by SimHash windows the size of the items."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.hashing import byte_word_hashes, mix, shingle_hashes, text_id
from marketbars.llm.shared import batches, saved

_WORDS = 5
_FILTER_BITS = 1 << 24
_CHUNKS = 16
# Every byte that is neither an ASCII letter or digit nor part of a longer character.
_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def plain_words(text: str | None) -> bytes:
    """The words of a text in lower case, with one space between them."""
    data = (text or "").lower().encode("utf-8", "replace").translate(_PLAIN)
    return b" ".join(data.split())


def fingerprints(words: np.ndarray, size: int) -> np.ndarray:
    """SimHash of each window of `size` words, every word counting once."""
    bits = (words[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    total = np.zeros((len(words) + 1, 64), np.int32)
    np.cumsum(bits.astype(np.int32) * 2 - 1, axis=0, out=total[1:])
    positive = total[size:] - total[:-size] > 0
    return np.packbits(positive, axis=1, bitorder="little").view("<u8").ravel()


def similarity(a: bytes, b: bytes, words: int = _WORDS) -> float:
    """Weighted Jaccard similarity of shingles, each weighing as often as it occurs."""

    def weights(plain: bytes) -> Counter:
        split = plain.split(b" ")
        n = min(words, len(split))
        return Counter(tuple(split[i : i + n]) for i in range(len(split) - n + 1))

    x, y = weights(a), weights(b)
    either = (x | y).total()
    return (x & y).total() / either if either else 0.0


def _filter_places(shingles: np.ndarray, size: int) -> np.ndarray:
    """The filter's bits for shingles of items of `size` words; 0: of any item."""
    return (mix(shingles + np.uint64(size)) & np.uint64(_FILTER_BITS - 1)).astype(np.int64)


def _shingles(words: np.ndarray) -> np.ndarray:
    return shingle_hashes(words, _WORDS)


def _blocks(radius: int) -> list[tuple[int, int]]:
    """First bit and number of bits of radius + 1 blocks."""
    parts = np.array_split(np.arange(64), radius + 1)
    return [(int(p[0]), len(p)) for p in parts]


def _block(fingerprint: Column, first: int, bits: int) -> Column:
    return F.shiftrightunsigned(fingerprint, first).bitwiseAND(F.lit((1 << bits) - 1))


def _by_block(frame: DataFrame, radius: int) -> DataFrame:
    values = [
        F.struct(F.lit(k).alias("block"), _block(F.col("fingerprint"), *place).alias("value"))
        for k, place in enumerate(_blocks(radius))
    ]
    return frame.withColumn("key", F.explode(F.array(*values))).select("*", "key.*").drop("key")


def items_of(benchmark: DataFrame) -> DataFrame:
    """`item_id`, its number of words, its words and its fingerprint; items with words only."""

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out = []
            for item_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                plain = plain_words(text)
                words = byte_word_hashes(plain)
                if len(words):
                    mark = int(fingerprints(words, len(words)).view(np.int64)[0])
                    out.append((item_id, len(words), plain, mark))
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64())
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["item_id", "size", "words", "fingerprint"],
            )

    chosen = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return chosen.mapInArrow(read, "item_id long, size long, words binary, fingerprint long")


def _filter(items: DataFrame) -> np.ndarray:
    """One bit for each hash of the items' shingles: 2 MB for any number of items."""
    step = _FILTER_BITS // _CHUNKS
    schema = "chunk int, bits binary"

    def mark(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(_FILTER_BITS, bool)
        for batch in rows:
            for size, plain in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shingles = _shingles(byte_word_hashes(plain))
                bits[_filter_places(shingles, 0)] = True
                bits[_filter_places(shingles, size)] = True
        packed = [zlib.compress(np.packbits(p).tobytes(), 1) for p in np.split(bits, _CHUNKS)]
        yield pa.record_batch(
            [pa.array(range(_CHUNKS), pa.int32()), pa.array(packed, pa.binary())], names=["chunk", "bits"]
        )

    def either(group: pa.Table) -> pa.Table:
        total = np.zeros(step // 8, np.uint8)
        for part in group.column("bits"):
            total |= np.frombuffer(zlib.decompress(part.as_py()), np.uint8)
        return pa.table({"chunk": group.column("chunk")[:1], "bits": [total.tobytes()]})

    rows = items.select("size", "words").mapInArrow(mark, schema)
    bits = np.zeros(_FILTER_BITS, bool)
    for row in rows.groupBy("chunk").applyInArrow(either, schema).collect():
        part = np.unpackbits(np.frombuffer(row.bits, np.uint8)).view(bool)
        bits[row.chunk * step : (row.chunk + 1) * step] = part
    return bits


def windows_of(
    documents: DataFrame, bits: np.ndarray, sizes: list[int], percent: int
) -> DataFrame:
    """Windows that could be similar to an item of `size` words, with fingerprints.

    A window has as many words as the item; of a document with fewer words, the
    whole text is the one window. A similarity of `percent` takes as many of a
    window's shingles from items of that size; all windows that have them by the
    filter are returned.
    """
    packed = zlib.compress(np.packbits(bits).tobytes(), 1)

    def search(plain: bytes, filter_: np.ndarray) -> list[tuple[int, int, int, bytes, int]]:
        words = byte_word_hashes(plain)
        out: list[tuple[int, int, int, bytes, int]] = []
        split: list[bytes] | None = None
        full = _shingles(words) if len(words) >= _WORDS else None
        near = np.flatnonzero(filter_[_filter_places(full, 0)]) if full is not None else None
        for size in sizes:
            if size > len(words) and near is None:
                # Its one shingle is shorter than any of the item's.
                continue
            if size < _WORDS:
                shingles = shingle_hashes(words, size)
                (starts,) = np.nonzero(filter_[_filter_places(shingles, size)])
            else:
                span = size - _WORDS + 1
                least = -(-percent * span // 100)
                if near is None or len(near) < least:
                    continue
                hits = near[filter_[_filter_places(full[near], size)]]
                if len(hits) < least:
                    continue
                if size > len(words):
                    mark = int(fingerprints(words, len(words)).view(np.int64)[0])
                    out.append((0, size, len(words), plain, mark))
                    continue
                total = np.zeros(len(full) + 1, np.int64)
                total[hits + 1] = 1
                total = np.cumsum(total)
                (starts,) = np.nonzero(total[span:] - total[:-span] >= least)
            if not len(starts):
                continue
            split = split or plain.split(b" ")
            # Runs of neighbouring windows share their sums.
            cut = np.flatnonzero(np.diff(starts) > 1) + 1
            for run in np.split(starts, cut):
                marks = fingerprints(words[run[0] : run[-1] + size], size).view(np.int64)
                for start, fingerprint in zip(run.tolist(), marks.tolist(), strict=True):
                    out.append((start, size, size, b" ".join(split[start : start + size]), fingerprint))
        return out

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_ = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8)).view(bool)
        kinds = [*[pa.int64()] * 5, pa.binary(), pa.int64()]
        names = ["doc_id", "text_id", "start", "size", "n_words", "words", "fingerprint"]
        for batch in batches(rows, 1024):
            out: list[tuple] = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = search(plain_words(text), filter_)
                own = text_id(text) if found else 0
                out += [(doc_id, own, *f) for f in found]
            columns = list(zip(*out, strict=True)) or [()] * 7
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    schema = "doc_id long, text_id long, start long, size long, n_words long, words binary, fingerprint long"
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(read, schema)


def find_leaks(
    documents: DataFrame, benchmark: DataFrame, percent: int = 80, radius: int = 16
) -> DataFrame:
    """Where documents hold a passage similar to a benchmark item.

    Windows of as many words as an item are compared with it, and the whole
    text of a document that has fewer words: their 64-bit
    SimHash fingerprints are cut into radius + 1 blocks, so that two within the
    radius agree in a block, and windows meet the items they are
    for in an equi-join on size, block and value; of the pairs within the radius those stay
    whose weighted five-word shingles have a similarity of `percent` or more.
    Only windows are fingerprinted that by a fixed-size filter hold as many of
    the items' shingles as that similarity takes.

    Words are runs of letters and digits, without regard to case. Result: one
    row for each document and item with `doc_id`, `text_id` (a hash of the
    text), `item_id`, `first_word`, `n_words`, `similarity` of the most similar
    window, the first of equals. Null and empty texts and items have no words
    and no row; items of fewer than five words are one shingle; repeated
    documents or items give each pair of ids once; empty tables give no row.
    Other columns are not looked at.

    To the driver go the filter (2 MB) and the distinct sizes of items; a hot
    item's windows are split by Spark, as they only meet in joins.
    """
    items = saved(items_of(benchmark))
    sizes = sorted(r.size for r in items.select("size").distinct().toLocalIterator())
    windows = saved(windows_of(documents, _filter(items), sizes, percent))

    def verify(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            columns = [batch.column(c).to_pylist() for c in ("words", "item_words")]
            found = [similarity(a, b) for a, b in zip(*columns, strict=True)]
            names = ["doc_id", "text_id", "item_id", "start", "n_words"]
            yield pa.record_batch(
                [*(batch.column(c) for c in names), pa.array(found, pa.float64())],
                names=[*names, "similarity"],
            )

    left, right = _by_block(windows, radius).alias("w"), _by_block(items, radius).alias("i")
    same = [F.col(f"w.{c}") == F.col(f"i.{c}") for c in ("size", "block", "value")]
    apart = F.col("w.fingerprint").bitwiseXOR(F.col("i.fingerprint"))
    # A pair that agrees in several blocks counts in the first of them.
    first = F.coalesce(
        *[F.when(_block(apart, *place) == 0, F.lit(k)) for k, place in enumerate(_blocks(radius))]
    )
    pairs = (
        left.join(right, same[0] & same[1] & same[2])
        .where((F.bit_count(apart) <= radius) & (first == F.col("w.block")))
        .select(
            "w.doc_id",
            "w.text_id",
            "i.item_id",
            "w.start",
            "w.n_words",
            "w.words",
            F.col("i.words").alias("item_words"),
        )
    )
    schema = "doc_id long, text_id long, item_id long, start long, n_words long, similarity double"
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words"))
    return (
        pairs.mapInArrow(verify, schema)
        .where(F.col("similarity") >= percent / 100)
        .groupBy("doc_id", "text_id", "item_id")
        .agg(best.alias("best"))
        .select(
            "doc_id",
            "text_id",
            "item_id",
            (-F.col("best.back")).alias("first_word"),
            F.col("best.n_words").alias("n_words"),
            F.col("best.similarity").alias("similarity"),
        )
    )
