"""Hashed n-grams of bytes or code points as feature vectors."""

from __future__ import annotations

import numpy as np

#: Bytes that are hashed at once, which bounds memory for very long texts.
_BLOCK = 1 << 20
_MULTIPLIER = np.uint32(2654435761)


def byte_ngrams(data: bytes, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """How often each of the ``2 ** bits`` hash values of the n-grams (n up to 4) of ``data`` occurs."""
    return _ngrams(np.frombuffer(data, np.uint8), sizes, bits)


def character_ngrams(text: str, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """The same of the code points of a text."""
    return _ngrams(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), sizes, bits)


def _ngrams(units: np.ndarray, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    counts = np.zeros(1 << bits, np.int64)
    shift = np.uint32(32 - bits)
    reach = max(sizes) - 1
    for at in range(0, len(units), _BLOCK):
        piece = units[at : at + _BLOCK + reach].astype(np.uint32)
        for n in sizes:
            starts = min(_BLOCK, len(units) - at - n + 1, len(piece) - n + 1)
            if starts <= 0:
                continue
            value = np.full(starts, n, np.uint32)
            for k in range(n):
                value = (value + piece[k : k + starts] + np.uint32(1)) * _MULTIPLIER
            value ^= value >> np.uint32(15)
            counts += np.bincount((value * _MULTIPLIER) >> shift, minlength=1 << bits)
    return counts


def unit(counts: np.ndarray) -> np.ndarray:
    """Square roots of shares: a vector of length one, or zeros."""
    total = counts.sum()
    return np.sqrt(counts / total).astype(np.float32) if total else counts.astype(np.float32)
