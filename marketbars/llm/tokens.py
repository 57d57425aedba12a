"""Token ids of whole texts, by the tokenizers library."""

from __future__ import annotations

import ctypes
from array import array
from codecs import charmap_decode
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from marketbars.llm import hashing

# The split of this vocabulary's byte-level pre-tokenizer, and the
# bytes that its alphabet shows as themselves.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRINTABLE = (*range(33, 127), *range(161, 173), *range(174, 256))

# White space of the split, and texts where a cut before a space or line feed could
# fall into a run of it, or that begin with it; in the syntax of Arrow's functions.
_WHITE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_UNSAFE = rf"\A[{_WHITE}]|[{_WHITE}][ \n](?:[{_WHITE}]|\z)"

# Words, and parts of other words, that a process keeps.
_CACHED, _PIECES = 900_000, 200_000


class ByteLevelEncoder:
    """Byte-level BPE of one tokenizer file, memoised by word.

    The pre-tokenizer never joins characters across the end of a word, so a
    text's ids are those of its words in a row, and each word is looked up or
    given to the library's BPE model once. With `added`, a text that holds the
    string of one of the file's added tokens is given to the library whole, so
    that all ids are those of its defaults; without, these strings are ordinary
    text. Ids come as little-endian bytes of `dtype`: two bytes an id where the
    vocabulary allows it.
    """

    def __init__(self, path: str, added: bool = False) -> None:
        tokenizer = Tokenizer.from_file(path)
        self._library = tokenizer
        tokens = tokenizer.get_added_tokens_decoder().values() if added else ()
        self._added = [token.content for token in tokens]
        self._tokenize = tokenizer.model.tokenize
        wide = tokenizer.get_vocab_size() > 1 << 16
        self._code, self.dtype = ("I", np.dtype("<u4")) if wide else ("H", np.dtype("<u2"))
        others = [b for b in range(256) if b not in _PRINTABLE]
        self._alphabet = "".join(chr(256 + others.index(b) if b in others else b) for b in range(256))
        self._pieces_of = regex.compile(_SPLIT).findall
        # A space between two characters of white space is no safe place to cut.
        self._uncut = regex.compile(r"\s (?:\s|\Z)").search
        self._words: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {}

    def _bpe(self, piece: str) -> bytes:
        shown, _ = charmap_decode(piece.encode("utf-8", "replace"), "strict", self._alphabet)
        return array(self._code, [token.id for token in self._tokenize(shown)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        found = self._pieces.get(piece)
        if found is None:
            if len(self._pieces) >= _PIECES:
                self._pieces.clear()
            found = self._pieces[piece] = self._bpe(piece)
        return found

    def _plain(self, text: str) -> bytes:
        return b"".join([self._piece(piece) for piece in self._pieces_of(text)])

    def _word(self, word: str) -> bytes:
        """Ids of a word that is not known, with the space before it."""
        if len(self._words) >= _CACHED:
            self._words.clear()
        stem, mark = word[:-1], word[-1:]
        if word.isalpha():
            found = self._bpe(" " + word)
        elif mark in (",", ".") and stem.isalpha():
            found = (self._words.get(stem) or self._word(stem)) + self._piece(mark)
        else:
            found = self._plain(" " + word)
        self._words[word] = found
        return found

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text; a missing text has none."""
        if not text:
            return b""
        if any(token in text for token in self._added):
            ids = self._library.encode(text, add_special_tokens=False).ids
            return array(self._code, ids).tobytes()
        if self._uncut(text):
            return self._plain(text)
        words = text.split(" ")
        known, learn = self._words.get, self._word
        rest = [known(w) or learn(w) for w in words[1:]]
        return self._plain(words[0]) + b"".join(rest)

    def _line_start(self, word: str) -> bytes:
        """Ids of a line feed and the word after it."""
        if word[1:].isalpha():
            return self._piece("\n") + self._piece(word[1:])
        return self._plain(word)

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each of some texts, as `encode` gives them.

        Texts are cut before spaces and line feeds by Arrow, and each distinct word
        is looked up once for all of them. A line feed put before each text makes
        its first word one like those of other lines. They are held several times
        over, so a call's texts should be a few megabytes, or one text.
        """
        texts = texts.cast(pa.large_string()).fill_null("")
        empty, line = pa.scalar("", texts.type), pa.scalar("\n", texts.type)
        alone = pc.match_substring_regex(texts, _UNSAFE)
        for token in self._added:
            alone = pc.or_(alone, pc.match_substring(texts, token))
        spaced = pc.replace_substring(pc.if_else(alone, empty, texts), "\n", " \n")
        cut = pc.split_pattern(pc.binary_join_element_wise(empty, spaced, line), " ")
        words = cut.flatten().dictionary_encode()
        known, learn, start = self._words.get, self._word, self._line_start
        found = [
            start(w) if w[:1] == "\n" else known(w) or learn(w)
            for w in words.dictionary.to_numpy(zero_copy_only=False)
        ]
        ids = np.frombuffer(b"".join(found), self.dtype)
        size = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        code, first = words.indices.to_numpy(), cut.offsets.to_numpy()
        at, count = (np.cumsum(size) - size)[code], size[code]
        lead = len(self._piece("\n")) // self.dtype.itemsize
        at[first[:-1]] += lead
        count[first[:-1]] -= lead
        ends = np.append(0, np.cumsum(count))
        place = np.repeat((at - ends[:-1]).astype(np.int32), count)
        place += np.arange(len(place), dtype=np.int32)
        ids, bounds = ids[place], ends[first].tolist()
        out = [ids[a:b] for a, b in pairwise(bounds)]
        for row in np.flatnonzero(alone.to_numpy(zero_copy_only=False)).tolist():
            out[row] = self.ids(texts[row].as_py())
        return out

    def clear(self) -> None:
        self._words.clear()
        self._pieces.clear()

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode(text), self.dtype)


_ENCODERS: dict[tuple[str, bool], ByteLevelEncoder] = {}


def encoder(path: str, added: bool = False) -> ByteLevelEncoder:
    """The process's encoder for a tokenizer file, with or without its added tokens."""
    if (path, added) not in _ENCODERS:
        _ENCODERS[path, added] = ByteLevelEncoder(path, added)
    return _ENCODERS[path, added]


def forget() -> None:
    """Drop what this process's encoders have learned.

    For tasks of other operators: worker processes serve one after another.
    """
    for known in _ENCODERS.values():
        known.clear()
    tidy()


def tidy() -> None:
    """Drop other operators' tables and give freed memory back to the system."""
    hashing.forget()
    pa.default_memory_pool().release_unused()
    library = ctypes.CDLL(None)
    if hasattr(library, "malloc_trim"):
        library.malloc_trim(0)
