"""Substring deduplication of lines, paragraphs and sentences by global digests."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.llm.shared import batches, saved

_ALPHANUMERIC = re.compile(r"[^\W_]+")
# A sentence ends with its marks and the white space after them.
_SENTENCE = re.compile(r"[^.!?。！？]*[.!?。！？]+[ \x09-\x0D]*|[^.!?。！？]+")
LINE = 2, 6
SENTENCE = 8, 40
_UNITS = "doc_id long, text_key binary, first long, length long, digest binary"


def normalise(unit: str) -> str:
    """Letters and digits in lower case, one space between runs of them."""
    return " ".join(_ALPHANUMERIC.findall(unit.lower()))


def _long_enough(plain: str, bound: tuple[int, int]) -> bool:
    words, characters = bound
    return len(plain) >= characters or (plain != "" and plain.count(" ") + 1 >= words)


def _lines(text: str, separator: str) -> Iterator[str]:
    """The lines of a text with their separators; joined they are the text."""
    parts = text.split(separator)
    for part in parts[:-1]:
        yield part + separator
    if parts[-1]:
        yield parts[-1]


def _compared(text: str, separator: str) -> Iterator[tuple[int, int, str]]:
    """First character, length and normal form of the units that are long enough."""
    at = 0
    for line in _lines(text, separator):
        plain = normalise(line)
        if _long_enough(plain, LINE):
            yield at, len(line), plain
        if len(plain) >= 2 * SENTENCE[0] - 1:
            found = [m.span() for m in _SENTENCE.finditer(line)]
            for start, end in found if len(found) > 1 else ():
                # So many words need as many characters at least.
                if end - start >= SENTENCE[0]:
                    part = normalise(line[start:end])
                    # The only sentence with words is its line.
                    if part != plain and _long_enough(part, SENTENCE):
                        yield at + start, end - start, part
        at += len(line)


def _units(documents: DataFrame, separator: str) -> DataFrame:
    """The units that are compared, with offsets in characters."""

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary())
        names = ("doc_id", "text_key", "first", "length", "digest")
        for batch in batches(rows, 512):
            out: list[tuple] = []
            for doc_id, text, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for first, length, plain in _compared(text or "", separator):
                    digest = blake2b(plain.encode("utf-8", "replace"), digest_size=16).digest()
                    out.append((doc_id, key, first, length, digest))
            columns = list(zip(*out, strict=True)) or [()] * len(kinds)
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
            )

    return documents.mapInArrow(cut, _UNITS)


def _longest(flags: list[bool], words: list[int], passed: list[bool]) -> int:
    """Words in the longest run of flagged units; those to be passed over end none."""
    most = now = 0
    for flag, n, over in zip(flags, words, passed, strict=True):
        now = now + n if flag else now if over else 0
        most = max(most, now)
    return most


def cut_text(text: str, found: list[tuple[int, int, bool]], separator: str) -> tuple:
    """What stays of a text whose units at (first, length) occur elsewhere as well.

    The third field tells units that go. A text is passed over once.
    """
    repeated, gone = (sorted({(f, f + n) for f, n, g in found if g or not only}) for only in (0, 1))
    flags: list[list[bool]] = [[], []]
    words, short, spans, kept, at = [], [], [], [], 0
    place = [0, 0]
    until = [0, 0]
    for line in _lines(text, separator):
        for m in _SENTENCE.finditer(line):
            start, end = at + m.start(), at + m.end()
            for k, units in enumerate((repeated, gone)):
                while place[k] < len(units) and units[place[k]][0] <= start:
                    until[k] = max(until[k], units[place[k]][1])
                    place[k] += 1
                flags[k].append(end <= until[k])
            plain = normalise(m[0])
            words.append(plain.count(" ") + 1 if plain else 0)
            short.append(not _long_enough(plain, SENTENCE))
            if not flags[1][-1]:
                kept.append(m[0])
            elif spans and spans[-1][0] + spans[-1][1] == start:
                spans[-1] = (spans[-1][0], end - spans[-1][0])
            else:
                spans.append((start, end - start))
        at += len(line)
    return (
        len(words),
        sum(flags[1]),
        sum(n for _, n in spans),
        _longest(flags[1], words, [False] * len(words)),
        _longest(flags[0], words, short),
        spans,
        "".join(kept),
    )


_RESULT = (
    "doc_id long, n_units long, n_removed long, removed_chars long, longest_removed long, "
    "longest_repeated long, removed array<struct<first:bigint,length:bigint>>, text string"
)


def _without_repeats(joined: DataFrame, separator: str) -> DataFrame:
    span = pa.struct([("first", pa.int64()), ("length", pa.int64())])
    kinds = [pa.int64()] * 6 + [pa.list_(span), pa.string()]
    names = [c.split()[0] for c in _RESULT.split(", ")]

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 256):
            out = []
            for doc_id, text, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                units = [(x["first"], x["length"], x["gone"]) for x in found or ()]
                *counts, spans, kept = cut_text(text or "", units, separator)
                spans = [{"first": f, "length": n} for f, n in spans]
                out.append((doc_id, *counts, spans, None if text is None else kept))
            columns = list(zip(*out, strict=True)) or [()] * len(kinds)
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
            )

    return joined.select("doc_id", "text", "found").mapInArrow(cut, _RESULT)


def dedup_units(documents: DataFrame, separator: str = "\n") -> DataFrame:
    """Keep the earliest occurrence of each unit and remove the others.

    Units are lines (or paragraphs, with a blank line as `separator`) and the
    sentences of a line of several. Units that are equal after `normalise` are
    one; the occurrence with the smallest `doc_id` (a null comes last), then the
    smallest place in its text, stays. Short units agree by chance and stay: lines
    of fewer than 2 words and 6 characters, sentences beside others in their
    line of fewer than 8 words and 40 characters. In a line without spaces the
    characters count, however it is written.

    Result: `doc_id`, `n_units` (sentences of the text, a line without an end mark
    being one), `n_removed` (those of them that go), `removed_chars`,
    `longest_removed` (words in the longest run of sentences that go),
    `longest_repeated` (words in the longest run of sentences that occur elsewhere,
    as the earliest do too; short ones between them are passed over), `removed` (first character and length of each maximal run in the
    original, in order), `text` (what stays). One row for each row. A null text
    stays null and has no unit; rows that repeat both `doc_id` and text are one
    document and get the same result; an empty table gives no row. Other
    columns are not looked at.

    Digests are grouped with a map-side minimum, so a line that is in every
    document reaches the shuffle once a task, and met again in a join whose hot
    partitions Spark splits. Of the texts only one shuffle by document is made,
    and each is passed over once, whatever its number of lines.
    """
    key = F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("text_key")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", key)
    units = saved(_units(docs, separator))
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "first", "text_key")
    firsts = (
        units.groupBy("digest")
        .agg(F.min(rank).alias("kept"), F.max(rank).alias("latest"))
        .where(F.col("kept") != F.col("latest"))
        .select("digest", "kept")
    )
    found = F.struct("first", "length", (rank != F.col("kept")).alias("gone"))
    found = (
        units.join(firsts, "digest")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set(found).alias("found"))
        .withColumnsRenamed({"doc_id": "found_id", "text_key": "found_key"})
    )
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key"))
    return _without_repeats(docs.join(found, same, "left"), separator)
