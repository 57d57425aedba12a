"""Token ids in Arrow files of equal-length sequences with masks."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketbars.llm.shared import batches, partitions, saved
from marketbars.llm.tokens import encoder, tidy
from marketbars.storage import new_folder

_FILES = "path string, first_doc long, n_docs long, n_ids long"
_DOCS = "path string, doc_id long, start long, n_tokens long, ids_crc32 long"


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


class SequenceWriter:
    """Writes ids, end to end, into sequences of equal length.

    `<uri>.arrow` is an Arrow file whose batches hold a fixed-size list of ids
    and one of mask bits for each sequence; the mask is true for ids and false
    for the padding of the last sequence. `<uri>.docs.arrow` names each
    document's first id and number of ids. Both get their name when complete,
    so that a task that is run again never leaves a half-written file under it.
    """

    def __init__(self, uri: str, dtype: np.dtype, length: int, rows: int = 256) -> None:
        self._fs, self._path = _place(uri)
        self._length, self._rows = length, rows
        self._pending: list[np.ndarray] = []
        self._n_pending = 0
        self.n_ids = 0
        self._dtype = dtype
        ids = pa.list_(pa.from_numpy_dtype(dtype), length)
        self._schema = pa.schema([("input_ids", ids), ("mask", pa.list_(pa.bool_(), length))])
        self._docs_schema = pa.schema(
            [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())]
        )
        self._files = [self._fs.open_output_stream(self._path + s) for s in (".part", ".docs.part")]
        self._writers = [
            pa.ipc.new_file(f, s)
            for f, s in zip(self._files, (self._schema, self._docs_schema), strict=True)
        ]
        self._docs: list[tuple[int | None, int, int]] = []

    def _write(self, flat: np.ndarray, used: int) -> None:
        mask = np.zeros(len(flat), bool)
        mask[:used] = True
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), self._length)
            for values in (flat, mask)
        ]
        self._writers[0].write_batch(pa.record_batch(columns, schema=self._schema))

    def _flush(self, last: bool = False) -> None:
        flat = np.concatenate(self._pending) if self._pending else np.zeros(0, self._dtype)
        step = self._length * self._rows
        end = len(flat) if last else len(flat) // step * step
        for begin in range(0, end, step):
            part = flat[begin : min(begin + step, end)]
            padded = np.zeros(-(-len(part) // self._length) * self._length, self._dtype)
            padded[: len(part)] = part
            self._write(padded, len(part))
        self._pending = [flat[end:].copy()]
        self._n_pending = len(flat) - end
        if self._docs and (last or len(self._docs) >= 10_000):
            columns = [pa.array(c, pa.int64()) for c in zip(*self._docs, strict=True)]
            self._writers[1].write_batch(pa.record_batch(columns, schema=self._docs_schema))
            self._docs = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._docs.append((doc_id, self.n_ids, len(ids)))
        self._pending.append(ids)
        self._n_pending += len(ids)
        self.n_ids += len(ids)
        if self._n_pending >= 4 * self._length * self._rows or len(self._docs) >= 10_000:
            self._flush()

    def close(self) -> None:
        self._flush(last=True)
        for writer, file in zip(self._writers, self._files, strict=True):
            writer.close()
            file.close()
        self._fs.move(self._path + ".docs.part", self._path + ".docs.arrow")
        self._fs.move(self._path + ".part", self._path + ".arrow")


class SequenceReader:
    """Random access to a written file; on a local disk nothing is copied."""

    def __init__(self, uri: str) -> None:
        file_system, path = _place(uri)
        if isinstance(file_system, fs.LocalFileSystem):
            self._sources = [pa.memory_map(path + s) for s in (".arrow", ".docs.arrow")]
        else:
            self._sources = [
                file_system.open_input_file(path + s) for s in (".arrow", ".docs.arrow")
            ]
        self._file, self._docs = map(pa.ipc.open_file, self._sources)
        self.length = self._file.schema.field("input_ids").type.list_size
        self._rows = self._file.get_batch(0).num_rows if self._file.num_record_batches else 1

    def __enter__(self) -> SequenceReader:
        return self

    def __exit__(self, *_: object) -> None:
        for source in self._sources:
            source.close()

    def batch(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and masks of the sequences of a batch; the ids are a view."""
        batch = self._file.get_batch(i)
        ids = batch.column(0).flatten().to_numpy(zero_copy_only=True)
        return ids.reshape(-1, self.length), batch.column(1)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        ids, masks = self.batch(i // self._rows)
        row = i % self._rows
        return ids[row], np.array(masks[row].as_py())

    def ids(self, start: int, count: int) -> list[np.ndarray]:
        """The ids from `start` on, as views of the batches that hold them."""
        step, out = self._rows * self.length, []
        while count > 0:
            flat = self.batch(start // step)[0].reshape(-1)[start % step :][:count]
            out.append(flat)
            start, count = start + len(flat), count - len(flat)
        return out

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        for i in range(self._docs.num_record_batches):
            columns = [c.to_pylist() for c in self._docs.get_batch(i).columns]
            yield from zip(*columns, strict=True)


def write_sequences(
    documents: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    length: int = 2048,
    added: bool = False,
) -> DataFrame:
    """Write all documents' ids in ascending `doc_id` order; one row per file.

    Documents are dealt out by ranges of `doc_id`, and each task streams its
    range into one file, holding a few batches of ids at a time. A null text
    is empty and has the end id alone; null ids come first; repeated rows are
    written as often as they come, ordered by text. An empty table gives no
    file. With `added`, the tokenizer's added tokens are found in texts. Columns
    other than `doc_id` and `text` are not looked at.
    """

    def write(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        out, n_docs, first, uri = None, 0, None, f"{folder}/{uuid.uuid4().hex}"
        encode = encoder(tokenizer, added)
        end = np.array([end_id], encode.dtype).tobytes()
        for batch in batches(rows, 512):
            ids, texts = (c.to_pylist() for c in batch.columns)
            if out is None:
                out, first = SequenceWriter(uri, encode.dtype, length), ids[0]
            for doc_id, text in zip(ids, texts, strict=True):
                out.add(doc_id, np.frombuffer(encode.encode(text) + end, encode.dtype))
            n_docs += len(ids)
        if out is not None:
            out.close()
            columns = [[uri], [first], [n_docs], [out.n_ids]]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["path", "first_doc", "n_docs", "n_ids"],
            )

    file_system, path = _place(folder)
    file_system.create_dir(path, recursive=True)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt = docs.repartitionByRange(partitions(documents.sparkSession), "doc_id")
    return saved(dealt.sortWithinPartitions("doc_id", "text").mapInArrow(write, _FILES))


def read_documents(files: DataFrame) -> DataFrame:
    """Each document's place and the checksum of its ids, read from the files.

    Starts count ids over all files in order; of the files only one row each
    meets in the running sum.
    """

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for batch in rows for p in batch.column(0).to_pylist()):
            found: list[tuple] = []
            with SequenceReader(path) as file:
                for doc_id, start, count in file.documents():
                    crc = 0
                    for ids in file.ids(start, count):
                        crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                    found.append((path, doc_id, start, count, crc))
            kinds = (pa.string(), *[pa.int64()] * 4)
            columns = list(zip(*found, strict=True)) or [()] * 5
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["path", "doc_id", "start", "n_tokens", "ids_crc32"],
            )

    before = Window.orderBy(F.col("first_doc").asc_nulls_first(), "path").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = files.select(
        "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before")
    )
    dealt = files.select("path").repartition(partitions(files.sparkSession))
    docs = dealt.mapInArrow(read, _DOCS)
    return docs.join(offsets, "path").select(
        "doc_id",
        (F.col("before") + F.col("start")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def binary_output(
    documents: DataFrame, tokenizer: str, end_id: int = 2, length: int = 2048, added: bool = False
) -> DataFrame:
    """Write ids to a new folder of the shared one and read them back."""
    folder = new_folder(documents.sparkSession)
    return read_documents(write_sequences(documents, folder, tokenizer, end_id, length, added))
