"""Packing: windows filled with the lexical neighbours of a seed document."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.llm.shared import batches_by_size, saved
from marketbars.llm.tokens import encoder, tidy

_PIECE = {
    "doc_id": pa.int64(),
    "start": pa.int64(),
    "length": pa.int64(),
    "ids_crc32": pa.int64(),
    "doc_tokens": pa.int64(),
}
_CUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
_PACKED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)

# BM25's usual constants; a seed asks with its heaviest terms.
_K1, _B = 1.2, 0.75
_QUERY_TERMS = 64
_NEIGHBOURS = 64
# Documents in a shard of the index, on average.
_SHARD_ROWS = 2048
# Bytes of the texts that are encoded at once; a longer text is so alone.
_ENCODED = 8 << 20


def _checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _record(columns: dict[str, list], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(columns[k], t) for k, t in kinds.items()], names=list(kinds))


def cut_documents(
    documents: DataFrame, tokenizer: str, end_id: int, window: int, added: bool = False
) -> DataFrame:
    """Pieces of whole windows, and one tail of each document with its ids."""

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        encode = encoder(tokenizer, added)
        end = np.array([end_id], encode.dtype)
        for batch in batches_by_size(rows, 1, _ENCODED):
            out: dict[str, list] = {k: [] for k in (*_PIECE, "ids")}
            encoded = encode.encode_all(batch.column(1))
            for doc_id, text_ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                ids = np.concatenate([text_ids, end])
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    tail = len(piece) < window
                    out["doc_id"].append(doc_id)
                    out["start"].append(start)
                    out["length"].append(len(piece))
                    out["ids_crc32"].append(None if tail else _checksum(piece))
                    out["doc_tokens"].append(len(ids))
                    out["ids"].append(piece.tobytes() if tail else None)
            yield _record(out, _PIECE | {"ids": pa.binary()})

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(cut, _CUT)


def _tail_terms(tails: DataFrame, tokenizer: str) -> dict[int, int]:
    """In how many tails each token occurs: as many rows as the vocabulary at most."""

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, dtype = np.zeros(0, np.int64), encoder(tokenizer).dtype
        at = np.zeros(0, np.int64)
        for batch in rows:
            for held in batch.column(0).to_pylist():
                ids = np.frombuffer(held, dtype)
                if ids.max(initial=0) >= len(total):
                    more = np.zeros(int(ids.max()) + 1 - len(total), np.int64)
                    total, at = np.append(total, more), np.append(at, more)
                # One place of each token stays written.
                places = np.arange(len(ids))
                at[ids] = places
                total[ids[at[ids] == places]] += 1
        (tokens,) = np.nonzero(total)
        yield pa.record_batch([pa.array(tokens), pa.array(total[tokens])], names=["token", "n"])

    counted = tails.select("ids").mapInArrow(count, "token long, n long")
    return {r.token: r.n for r in counted.groupBy("token").agg(F.sum("n").alias("n")).collect()}


class _Shard:
    """An inverted index over the tails of one shard."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean: float) -> None:
        lengths = np.array([len(t) for t in tails])
        unit = np.repeat(np.arange(len(tails)), lengths)
        token = np.concatenate([np.sort(t) for t in tails])
        (first,) = np.nonzero(np.append(True, (np.diff(unit) != 0) | (token[1:] != token[:-1])))
        count = np.diff(np.append(first, len(token)))
        unit, token = unit[first], token[first]
        norm = _K1 * (1 - _B + _B * lengths[unit] / mean)
        weight = idf[token] * count * (_K1 + 1) / (count + norm)
        self._size = len(tails)
        self._terms_at = np.searchsorted(unit, np.arange(len(tails) + 1))
        self._token, self._weight = token, weight
        by_token = np.argsort(token, kind="stable")
        self._posting_unit, self._posting_weight = unit[by_token], weight[by_token]
        self._postings_at = np.append(0, np.cumsum(np.bincount(token, minlength=len(idf))))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of all tails for the heaviest terms of the seed."""
        own = slice(self._terms_at[seed], self._terms_at[seed + 1])
        terms, weights = self._token[own], self._weight[own]
        if len(terms) > _QUERY_TERMS:
            terms = terms[np.argpartition(-weights, _QUERY_TERMS)[:_QUERY_TERMS]]
        spans = [slice(self._postings_at[t], self._postings_at[t + 1]) for t in terms.tolist()]
        units = np.concatenate([self._posting_unit[s] for s in spans])
        weights = np.concatenate([self._posting_weight[s] for s in spans])
        return np.bincount(units, weights, self._size)


def _powers_of_two(total: int) -> list[int]:
    return [1 << i for i in reversed(range(total.bit_length())) if total >> i & 1]


def fill_windows(
    tails: list[np.ndarray], idf: np.ndarray, mean: float, window: int
) -> list[list[tuple[int, int, int]]]:
    """Sequences of (tail, first id, length).

    The longest unused tail is the seed. Its unused neighbours, best first, are
    taken whole while they fit; then the best of the rest is cut to fill the
    window, and what is left of it stays unused. The last ids of a shard make
    sequences whose lengths are powers of two, so that nothing is padded.
    """
    index = _Shard(tails, idf, mean)
    left = np.array([len(t) for t in tails])
    begin = np.zeros(len(tails), np.int64)
    out: list[list[tuple[int, int, int]]] = []
    current: list[tuple[int, int, int]] = []

    def take(unit: int, count: int) -> None:
        current.append((unit, int(begin[unit]), count))
        begin[unit] += count
        left[unit] -= count

    for seed in np.argsort(-left, kind="stable").tolist():
        if not left[seed]:
            continue
        space = window - int(left[seed])
        take(seed, int(left[seed]))
        scores = index.scores(seed) if space else None
        while space:
            (unused,) = np.nonzero(left)
            if not len(unused):
                break
            rank = scores[unused]
            if len(unused) > _NEIGHBOURS:
                best = np.argpartition(-rank, _NEIGHBOURS)[:_NEIGHBOURS]
                unused, rank = unused[best], rank[best]
            unused = unused[np.lexsort((unused, -rank))].tolist()
            for unit in unused:
                if left[unit] <= space:
                    space -= int(left[unit])
                    take(unit, int(left[unit]))
            rest = [unit for unit in unused if left[unit]]
            if space and rest:
                take(rest[0], space)
                space = 0
        if space == 0:
            out.append(current)
            current = []
    sizes = _powers_of_two(sum(count for _, _, count in current))
    part: list[tuple[int, int, int]] = []
    for unit, first, count in current:
        while count:
            step = min(count, sizes[0] - sum(c for _, _, c in part))
            part.append((unit, first, step))
            first, count = first + step, count - step
            if sum(c for _, _, c in part) == sizes[0]:
                out.append(part)
                part = []
                sizes.pop(0)
    return out


def pack_documents(
    documents: DataFrame, tokenizer: str, end_id: int = 1, window: int = 2048, added: bool = False
) -> DataFrame:
    """Pack all documents into sequences of at most `window` ids.

    Each document is its ids and the end id. Whole windows of a document are
    sequences of their own; the tails go, evenly by a hash of their row, into
    shards of a BM25 inverted index whose term statistics are those of all
    tails, and each shard fills windows as `fill_windows` says. So a window has
    neighbours from one shard, and a shard's size does not grow with the input.

    Result: one row for each piece with `doc_id`, `start`, `length`,
    `ids_crc32`, `doc_tokens`, `sequence_id`, `offset`. Every id is in one
    piece. A null or empty text has its end id alone, rows with a null or
    repeated `doc_id` are packed like others, a very long text is cut into its
    windows, and an empty table gives no row. With `added`, the tokenizer's added
    tokens are found in texts. Columns other than `doc_id` and `text` are not
    looked at.
    """
    cut = saved(cut_documents(documents, tokenizer, end_id, window, added))
    numbered = cut.withColumn("row", F.monotonically_increasing_id())
    whole = numbered.where(F.col("ids").isNull()).select(
        *_PIECE,
        (F.col("row") * 2 + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    tails = cut.where(F.col("ids").isNotNull())
    size = tails.agg(F.count("*").alias("n"), F.avg("length").alias("mean")).first()
    terms = _tail_terms(tails, tokenizer)
    idf = np.zeros(max(terms, default=0) + 1)
    for token, n in terms.items():
        idf[token] = np.log1p((size.n - n + 0.5) / (n + 0.5))
    mean = size.mean or 1.0
    shards = max(1, -(-size.n // _SHARD_ROWS))

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("row")
        column = {name: group.column(name).to_pylist() for name in group.column_names}
        dtype = encoder(tokenizer).dtype
        ids = [np.frombuffer(b, dtype) for b in column["ids"]]
        out: dict[str, list] = {k: [] for k in (*_PIECE, "sequence_id", "offset")}
        first = column["shard"][0] << 32
        for number, sequence in enumerate(fill_windows(ids, idf, mean, window)):
            offset = 0
            for unit, begin, count in sequence:
                out["doc_id"].append(column["doc_id"][unit])
                out["start"].append(column["start"][unit] + begin)
                out["length"].append(count)
                out["ids_crc32"].append(_checksum(ids[unit][begin : begin + count]))
                out["doc_tokens"].append(column["doc_tokens"][unit])
                out["sequence_id"].append((first | number) * 2)
                out["offset"].append(offset)
                offset += count
        kinds = _PIECE | {"sequence_id": pa.int64(), "offset": pa.int64()}
        return pa.Table.from_batches([_record(out, kinds)])

    packed = (
        numbered.where(F.col("ids").isNotNull())
        .withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
        .select("shard", "row", "doc_id", "start", "doc_tokens", "ids")
        .groupBy("shard")
        .applyInArrow(pack, _PACKED)
    )
    return whole.unionByName(packed)
