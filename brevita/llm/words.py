"""Word hashes and hashes of word windows for many texts at once, in numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd

# Texts are taken in groups of about so many bytes, since a word costs far more in Python than its bytes.
GROUP_BYTES = 2 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)

# ASCII letters to lower case, ASCII that is neither letter nor digit to blanks, the rest as it is.
ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def groups(texts: Sequence[bytes | None], most: int = GROUP_BYTES) -> Iterator[slice]:
    """Consecutive slices of about ``most`` bytes; a longer text is a slice of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or b"")
        if size > most:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: Sequence[Sequence[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words one after another, and the offsets of each text (one more than texts)."""
    offsets = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=offsets[1:])
    flat = np.empty(offsets[-1], dtype=object)
    for i, w in enumerate(words):
        flat[offsets[i] : offsets[i + 1]] = w
    if not len(flat):
        return np.zeros(0, np.uint64), offsets
    return pd.util.hash_array(flat, categorize=False), offsets


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of every ``width`` consecutive words, modulo 2^64 over hashed words, then mixed.

    Windows that reach over the end of a text are there too; ``inside`` tells them apart.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # Doubling: a hash over 2w words is the hash over the first w, shifted, plus that over the next w.
    total, done, power = None, 0, np.uint64(1)
    part, step, lift = hashes, 1, _BASE
    rest = width
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                piece = part[done : done + n]
                total = piece.copy() if total is None else total + piece * power
                power, done = power * lift, done + step
            rest >>= 1
            if rest:
                part = part[:-step] + part[step:] * lift
                step, lift = step * 2, lift * lift
        return mixed(total * _ODD + np.uint64(width))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    out, step = values, 1
    while step * 2 <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return np.minimum(out[:n], out[rest : rest + n]) if rest else out[:n]


def inside(offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and first word, counted over all texts, of every window that lies in one text."""
    lengths = np.maximum(np.diff(offsets) - width + 1, 0)
    text = np.repeat(np.arange(len(lengths)), lengths)
    begin = np.cumsum(lengths) - lengths
    return text, np.arange(len(text)) - begin[text] + offsets[:-1][text] if len(text) else np.zeros(0, np.int64)


def covered(starts: np.ndarray, width: int | np.ndarray, length: int) -> np.ndarray:
    """Which of ``length`` words lie in a window that begins at one of ``starts``: maximal intervals as a mask."""
    edge = np.zeros(length + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + width, length), -1)
    return np.cumsum(edge[:-1]) > 0
