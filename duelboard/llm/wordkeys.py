"""Word and shingle keys of many texts at once, as numpy arrays.

Words are runs of bytes other than space and 0x09-0x0D; A-Z count as a-z. A word's
key is a 64-bit polynomial hash of its bytes, so one pass over the byte buffer gives
the keys of all words of all texts without a loop over words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

LOWER = bytes(range(256)).lower()
_RNG = np.random.Generator(np.random.PCG64(20_240_607))
_BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SHINGLE_FACTORS = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of each."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inverse = pow(_BASE, -1, 2**64)
        for name, base in (("up", _BASE), ("down", inverse)):
            out = np.ones(size, np.uint64)
            filled, step = 1, base
            while filled < size:  # doubling: out[k + filled] = out[k] * base^filled
                out[filled : 2 * filled] = out[:filled] * np.uint64(step)
                step = step * step % 2**64
                filled *= 2
            _powers[name] = out
    return _powers["up"], _powers["down"]


def joined(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(lower-cased bytes of all texts, each closed by a newline; end offset of each text)."""
    parts = [(t or "").encode("utf-8", "replace").translate(LOWER) for t in texts]
    ends = np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)
    return np.frombuffer(b"\n".join(parts) + b"\n" if parts else b"", np.uint8), ends


def word_spans(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of a buffer that ends with a space."""
    gap = _SPACE[buffer]
    edge = np.empty(len(gap), bool)
    if len(gap):
        edge[0] = not gap[0]
        np.not_equal(gap[1:], gap[:-1], out=edge[1:])
    at = np.flatnonzero(edge)
    return at[0::2], at[1::2]


def word_keys(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(key of every word, offsets: text ``i`` has the keys ``offsets[i]:offsets[i + 1]``)."""
    buffer, ends = joined(texts)
    return buffer_keys(buffer, ends)


def buffer_keys(buffer: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, stops = word_spans(buffer)
    up, down = _power_tables(len(buffer) + 1)
    total = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[buffer] * up[: len(buffer)], out=total[1:])
    keys = mix((total[stops] - total[starts]) * down[starts])
    offsets = np.zeros(len(ends) + 1, np.int64)
    offsets[1:] = np.searchsorted(starts, ends)
    return keys, offsets


def shingle_keys(words: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the ``size``-word shingles of each text, in order, and their offsets.

    A text with fewer words, but at least one, has a single shingle of all its words.
    """
    lengths = np.diff(offsets)
    counts = np.where(lengths >= size, lengths - size + 1, (lengths > 0).astype(np.int64))
    out_offsets = np.concatenate(([0], np.cumsum(counts)))
    padded = np.concatenate((words, np.zeros(size, np.uint64)))
    hashed = np.zeros(len(words), np.uint64)
    for k in range(size):
        hashed += padded[k : k + len(words)] * _SHINGLE_FACTORS[k]
    short = np.flatnonzero((lengths > 0) & (lengths < size))
    for i in short:
        own = words[offsets[i] : offsets[i + 1]]
        hashed[offsets[i]] = (own * _SHINGLE_FACTORS[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
    position = np.arange(out_offsets[-1]) + np.repeat(offsets[:-1] - out_offsets[:-1], counts)
    return mix(hashed[position]), out_offsets


def in_blocks(texts: list[str | None], max_chars: int = 500_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``max_chars`` characters each; one longer text is a range of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if i > start and size + n > max_chars:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
