"""Vectorised 64-bit hashes of words and runs of words."""

from __future__ import annotations

import hashlib

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2^64."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = max(n, 1 << 16)
        for_base = np.full(size, _BASE, np.uint64)
        for_inverse = np.full(size, _INVERSE, np.uint64)
        for_base[0] = for_inverse[0] = 1
        _POWERS, _INVERSES = np.cumprod(for_base), np.cumprod(for_inverse)
    return _POWERS[:n], _INVERSES[:n]


def forget() -> None:
    """Drop the tables of powers; they come again when they are needed."""
    global _POWERS, _INVERSES
    _POWERS, _INVERSES = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values whose every output bit depends on all input."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word and the byte after it; words end at ASCII white space."""
    space = np.ones(len(code) + 2, np.int8)
    space[1:-1] = _SPACE[code]
    turn = np.diff(space)
    return np.flatnonzero(turn == -1), np.flatnonzero(turn == 1)


def word_hashes(text: str | None) -> np.ndarray:
    """A hash of each word of a text, with A-Z lowered."""
    return byte_word_hashes((text or "").encode("utf-8", "replace").lower())


def byte_word_hashes(data: bytes) -> np.ndarray:
    """A hash of each word of some bytes."""
    code = np.frombuffer(data, np.uint8)
    starts, ends = word_spans(code)
    forward, inverses = powers(len(code) + 1)
    total = np.zeros(len(code) + 1, np.uint64)
    np.cumsum((code.astype(np.uint64) + np.uint64(1)) * forward[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * inverses[starts])


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n words; of all words if there are fewer."""
    n = min(n, len(words))
    if not n:
        return words
    out = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        out = out * np.uint64(_BASE) + words[k : len(words) - n + 1 + k]
    return mix(out)


def text_id(text: str | None) -> int:
    """A 64-bit hash of a whole text; a missing text is an empty one."""
    return data_id((text or "").encode("utf-8", "replace"))


def data_id(data: bytes) -> int:
    """A 64-bit hash of some bytes."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)
