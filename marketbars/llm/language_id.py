"""Language identification by unigrams summed over all segmentations."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.llm import tokens
from marketbars.llm.shared import batches

_LETTERS = re.compile(r"[^\W\d_]+")
_START = "▁"
_MOST_LANGUAGES = 500
_CACHED = 250_000
_ROOT = 1
_TABLE_LETTERS = 95
# Added to each piece's count, as a share of the mean count.
_SMOOTHING = 0.02
_TINY, _HUGE = 1e-120, 1e120

UNKNOWN = "und"


def words_in(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    return _LETTERS.findall(text.lower()) if text else []


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


_PROCESSORS: dict[str, sentencepiece.SentencePieceProcessor] = {}


def _processor(path: str) -> sentencepiece.SentencePieceProcessor:
    if path not in _PROCESSORS:
        _PROCESSORS[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _PROCESSORS[path]


def learn(documents: DataFrame, vocabulary: str) -> dict[str, np.ndarray]:
    """Per language, the probability of each piece of the vocabulary.

    Pieces are counted over all given rows in the vocabulary's own segmentation
    of each word; tasks add up their counts, so that what is shuffled and sent
    to the driver has at most vocabulary size times languages rows. More than
    500 distinct values of `lang` are an error.
    """

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        processor = _processor(vocabulary)
        total: dict[str, np.ndarray] = {}
        for batch in batches(rows, 2048):
            words: dict[str, Counter] = {}
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words.setdefault(lang, Counter()).update(words_in(text))
            for lang, counts in words.items():
                mine = total.setdefault(lang, np.zeros(processor.get_piece_size(), np.int64))
                pieces = processor.encode(list(counts), num_threads=1)
                repeats = np.repeat(list(counts.values()), [len(p) for p in pieces])
                flat = np.fromiter((i for p in pieces for i in p), np.int64)
                np.add.at(mine, flat, repeats.astype(np.int64))
        for lang, mine in total.items():
            (pieces,) = np.nonzero(mine)
            columns = [pa.array([lang] * len(pieces), pa.string()), pieces, mine[pieces]]
            yield pa.record_batch([pa.array(c) for c in columns], names=["lang", "piece", "n"])

    labelled = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = (
        labelled.select("lang", "text")
        .mapInArrow(count, "lang string, piece long, n long")
        .groupBy("lang", "piece")
        .agg(F.sum("n").alias("n"))
    )
    model: dict[str, np.ndarray] = {}
    size = _processor(vocabulary).get_piece_size()
    for row in counted.toLocalIterator():
        if row.lang not in model and len(model) == _MOST_LANGUAGES:
            raise ValueError(f"more than {_MOST_LANGUAGES} languages")
        model.setdefault(row.lang, np.zeros(size))[row.piece] = row.n
    for counts in model.values():
        counts += _SMOOTHING * counts.sum() / size
        counts /= counts.sum()
    return dict(sorted(model.items()))


class Scorer:
    """Log probabilities of words, summed over all segmentations into pieces."""

    def __init__(self, vocabulary: str, model: dict[str, np.ndarray]) -> None:
        processor = _processor(vocabulary)
        self.languages = list(model)
        # A trie over the pieces: children by character. Node 0 is a dead end.
        self._children: list[dict[str, int]] = [{}, {}]
        nodes: dict[int, int] = {}
        for i in range(processor.get_piece_size()):
            if processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i):
                continue
            node = _ROOT
            for c in processor.id_to_piece(i):
                if c not in self._children[node]:
                    self._children[node][c] = len(self._children)
                    self._children.append({})
                node = self._children[node][c]
            nodes[node] = i
        size = processor.get_piece_size()
        table = np.array([model[lang] for lang in self.languages]).reshape(-1, size).T
        self._weights = np.zeros((len(self._children), len(self.languages)))
        self._weights[list(nodes)] = table[list(nodes.values())]
        self._is_piece = np.zeros(len(self._children), bool)
        self._is_piece[list(nodes)] = True
        bytes_at = [processor.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self._byte_weights = table[bytes_at]

        # The same trie as a table, for the letters that most pieces have.
        letters = Counter(c for children in self._children for c in children)
        single = {c for c, node in self._children[_ROOT].items() if self._is_piece[node]}
        common = [c for c, _ in letters.most_common() if c in single and c.isalpha() and c.islower()]
        self._code = {c: k for k, c in enumerate([_START, *common[:_TABLE_LETTERS]])}
        self._next = np.zeros((len(self._children), len(self._code)), np.int32)
        for node, children in enumerate(self._children):
            for c, child in children.items():
                if c in self._code:
                    self._next[node, self._code[c]] = child
        self._common = re.compile("[" + "".join(map(re.escape, common[:_TABLE_LETTERS])) + "]{1,24}")
        self._row: dict[str, int] = {}
        self._logs = np.zeros((0, len(self.languages)))

    def _spelled(self, c: str) -> np.ndarray:
        """A character as its bytes: the vocabulary's way out."""
        return np.maximum(self._byte_weights[list(c.encode("utf-8", "replace"))].prod(axis=0), 1e-60)

    def word(self, word: str) -> np.ndarray:
        """The forward algorithm over the word with the vocabulary's start mark."""
        text = _START + word
        forward = np.zeros((len(text) + 1, len(self.languages)))
        forward[0] = 1
        log_scale = np.zeros(len(self.languages))
        for i in range(len(text)):
            tiny = (forward[i] > 0) & (forward[i] < _TINY)
            if tiny.any():
                # Later places hold sums of the same scale.
                forward[i:, tiny] *= _HUGE
                log_scale[tiny] -= math.log(_HUGE)
            node, alone = _ROOT, False
            for j in range(i, len(text)):
                node = self._children[node].get(text[j], 0)
                if not node:
                    break
                if self._is_piece[node]:
                    alone |= j == i
                    forward[j + 1] += forward[i] * self._weights[node]
            if not alone:
                forward[i + 1] += forward[i] * self._spelled(text[i])
        return np.log(np.maximum(forward[-1], 1e-300)) + log_scale

    def _same_length(self, words: list[str], length: int) -> np.ndarray:
        """`word` for words of one length whose letters the table has, all at once."""
        code = np.zeros((len(words), length + 1), np.int32)
        of = self._code
        code[:, 1:] = np.array([[of[c] for c in w] for w in words], np.int32).reshape(-1, length)
        forward = np.zeros((length + 2, len(words), len(self.languages)))
        forward[0] = 1
        for i in range(length + 1):
            at = np.arange(len(words))
            node = np.full(len(words), _ROOT, np.int32)
            for j in range(i, length + 1):
                node = self._next[node, code[at, j]]
                alive = node > 0
                if not alive.any():
                    break
                if not alive.all():
                    at, node = at[alive], node[alive]
                forward[j + 1, at] += forward[i, at] * self._weights[node]
        return np.log(forward[-1])

    def _learn(self, words: list[str]) -> None:
        if len(self._row) + len(words) > _CACHED:
            self._row, self._logs = {}, self._logs[:0]
        groups: dict[int, list[str]] = {}
        for w in words:
            groups.setdefault(len(w) if self._common.fullmatch(w) else 0, []).append(w)
        parts = [self._logs]
        for length, group in groups.items():
            self._row.update(zip(group, range(len(self._row), len(self._row) + len(group)), strict=True))
            parts.append(
                self._same_length(group, length) if length else np.array([self.word(w) for w in group])
            )
        self._logs = np.concatenate(parts)

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Each text's most probable language, and its probability among all."""
        split = [words_in(t) for t in texts] if self.languages else [[] for _ in texts]
        seen = dict.fromkeys(w for words in split for w in words)
        new = [w for w in seen if w not in self._row]
        if len(self._row) + len(new) > _CACHED:
            new = list(seen)
        if new:
            self._learn(new)
        langs, scores, row = [], [], self._row
        for words in split:
            if not words:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            total = self._logs[[row[w] for w in words]].sum(axis=0)
            best = int(total.argmax())
            langs.append(self.languages[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return langs, scores


def identify(
    documents: DataFrame,
    model: dict[str, np.ndarray],
    vocabulary: str,
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """All columns, and every text's language and score under two new names."""
    kinds = (T.StringType(), T.DoubleType())
    added = [T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]
    schema = T.StructType([*documents.schema.fields, *added])

    def predict(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        scorer = Scorer(vocabulary, model)
        for batch in batches(rows, 2048):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            langs, scores = scorer.score(texts)
            columns = [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.record_batch(columns, names=schema.names)

    return documents.mapInArrow(predict, schema)


def language_of_documents(documents: DataFrame, vocabulary: str) -> DataFrame:
    """Predict every document's language, learning from those not held out.

    Per language a probability for each piece of a fixed public vocabulary; a
    text's probability is the product over its words (runs of letters, in lower
    case) of the sum over all segmentations into pieces. Learned from `text`
    and non-null `lang` of rows whose crc32 of `doc_id` has a remainder other
    than 1 by 3; a null `doc_id` counts as not held out.

    Result: `doc_id`, `held_out`, `lang_pred`, `score`, one row for each row.
    A null, empty or letterless text, and every text if nothing could be
    learned, is `und` with score 0. Other columns are not looked at.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    docs = docs.withColumn("held_out", is_held_out(F.col("doc_id")))
    model = learn(docs.where(~F.col("held_out")), vocabulary)
    scored = identify(docs.select("doc_id", "held_out", "text"), model, vocabulary)
    return scored.select("doc_id", "held_out", "lang_pred", "score")
