"""Words of whole texts as 64-bit numbers, in numpy."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PART = 1 << 20
_BASE = 0xD6E8FEB86659FD93
_RANDOM = np.random.Generator(np.random.PCG64(1)).integers(0, 2**64, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole number (one to one)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown as needed."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def upto(cls, n: int) -> None:
        if len(cls.up) < n:
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
                p = np.full(n, base, dtype=np.uint64)
                p[0] = 1
                setattr(cls, name, np.cumprod(p, dtype=np.uint64))


def _part_words(buf: np.ndarray) -> np.ndarray:
    word = np.empty(len(buf) + 2, dtype=bool)
    word[0] = word[-1] = False
    np.logical_not(_SPACE[buf], out=word[1:-1])
    edge = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edge[::2], edge[1::2]
    _Powers.upto(len(buf) + 1)
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_RANDOM[buf] * _Powers.up[:len(buf)], dtype=np.uint64, out=total[1:])
    return mix((total[ends] - total[starts]) * _Powers.down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit number for each word ``[^\\x20\\x09-\\x0D]+``; taken in parts cut at white space, so long texts need little memory."""
    if len(text) <= _PART:
        return _part_words(np.frombuffer(text, dtype=np.uint8))
    buf, out, at = np.frombuffer(text, dtype=np.uint8), [], 0
    while at < len(buf):
        end = min(len(buf), at + _PART)
        while end < len(buf) and not _SPACE[buf[end]]:
            step = np.flatnonzero(_SPACE[buf[end:end + _PART]])
            end = end + int(step[0]) if len(step) else min(len(buf), end + _PART)
        out.append(_part_words(buf[at:end]))
        at = end
    return np.concatenate(out)


def texts_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of many texts in a row, and the offsets of each text in them (one more than texts)."""
    if sum(map(len, texts)) <= _PART:
        joined = b"\n".join(texts)
        begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
        buf = np.frombuffer(joined, dtype=np.uint8)
        ids = _part_words(buf)
        word = ~_SPACE[buf]
        first = word.copy()
        first[1:] &= ~word[:-1]
        n = np.concatenate(([0], np.cumsum(first)))
        return ids, n[np.minimum(begin, len(buf))]
    parts = [word_hashes(t) for t in texts]
    return np.concatenate(parts), np.cumsum([0, *map(len, parts)])


def grams(ids: np.ndarray, length: int, known: dict[int, np.ndarray] | None = None) -> np.ndarray:
    """Number of the ``length`` consecutive items that start at each place, by doubling; ``known`` keeps the levels."""
    known = {} if known is None else known
    if length in known:
        return known[length]
    if length == 1:
        known[1] = ids
        return ids
    half = 1 << ((length - 1).bit_length() - 1)
    a, b = grams(ids, half, known), grams(ids, length - half, known)
    n = max(0, len(ids) - length + 1)
    known[length] = mix(a[:n] * _U(0x9E3779B97F4A7C15) + (b[half:half + n] ^ _U(length)))
    return known[length]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` consecutive ones."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:]) if len(x) > span else x[:0]
        span *= 2
    rest = width - span
    if rest:
        x = np.minimum(x[:-rest], x[rest:]) if len(x) > rest else x[:0]
    return x
