"""Words of a text as 64-bit hashes, computed on the UTF-8 bytes of the whole text."""

from __future__ import annotations

import numpy as np

#: Word bytes: ASCII digits and lower-case letters, and every byte of a non-ASCII character.
IS_WORD = np.zeros(256, np.uint8)
IS_WORD[list(range(0x30, 0x3A)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = 1
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[0x41:0x5B] += 32

#: Texts are hashed in blocks of about this many bytes, cut between words.
BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit integers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_powers = np.ones(1, _U)
_inverses = np.ones(1, _U)


def _grow(n: int) -> None:
    """Powers of the hash base and of its inverse modulo 2**64, up to ``n``."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers))
        for name, base in (("_powers", _BASE), ("_inverses", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, _U)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)


def word_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end byte of each word of a lower-cased byte buffer."""
    flags = np.zeros(len(buf) + 2, np.int8)
    flags[1:-1] = IS_WORD[buf]
    edge = np.flatnonzero(np.diff(flags))
    return edge[::2], edge[1::2]


def word_hashes(buf: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of a lower-cased byte buffer, in order."""
    out, at = [], 0
    while at < len(buf):
        end = at + BLOCK
        while end < len(buf) and IS_WORD[buf[end]]:
            end += 1
        part = buf[at:end]
        begins, ends = word_bounds(part)
        if len(begins):
            _grow(len(part) + 1)
            sums = np.zeros(len(part) + 1, _U)
            np.cumsum(part.astype(_U) * _powers[: len(part)], out=sums[1:])
            raw = (sums[ends] - sums[begins]) * _inverses[begins]
            out.append(mix(raw + (ends - begins).astype(_U)))
        at = end
    return np.concatenate(out) if out else np.empty(0, _U)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of every run of ``k`` consecutive words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, _U)
    total = np.zeros(n, _U)
    for j in range(k):
        total = mix(total + words[j : j + n] + _U(j + 1))
    return total


def lowered(text: str) -> np.ndarray:
    """Bytes of the text in Unicode lower case."""
    return np.frombuffer(text.lower().encode("utf-8"), np.uint8)


def ascii_lowered(text: str) -> np.ndarray:
    """Bytes of the text with only A-Z lower-cased."""
    return ASCII_LOWER[np.frombuffer(text.encode("utf-8"), np.uint8)]
