"""Hashed word shingles of whole texts, many texts at a time."""

from __future__ import annotations

import numpy as np

U = np.uint64
_BYTE = np.random.default_rng(11).integers(0, 2**64, 256, dtype=np.uint64) | U(1)
_K = 0x9E3779B97F4A7C15
_INVERSE = pow(_K, -1, 1 << 64)
#: Bytes of texts hashed together.
TOGETHER = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads each bit of a 64-bit number over all."""
    for _ in range(2):
        x = (x ^ x >> U(32)) * U(0xD6E8FEB86659FD93)
    return x ^ x >> U(32)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U(base))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of other bytes than white space, A-Z lowered) of all texts, and each text's first."""
    sizes = np.array([len(t) + 1 for t in texts])
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8).copy()
    data[(data >= 65) & (data <= 90)] += 32
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _powers(_K, len(data)), dtype=np.uint64)])
    hashes = mix((sums[end] - sums[start]) * _powers(_INVERSE, len(data) + 1)[start] + (end - start).astype(np.uint64))
    return hashes, np.concatenate([[0], np.searchsorted(start, np.cumsum(sizes))])


def shingle_sets(texts: list[str | None], k: int = 5) -> list[np.ndarray]:
    """Each text's set of k-word shingles as ascending 64-bit hashes; with fewer words, the whole sequence as one."""
    out: list[np.ndarray] = []
    batch: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        batch.append((text or "").encode("utf-8", "replace"))
        size += len(batch[-1]) + 1
        if size >= TOGETHER or i == len(texts) - 1:
            out += _sets(batch, k)
            batch, size = [], 0
    return out


def _sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    words, first = word_hashes(texts)
    full = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for j in range(k):
        full = mix(full * U(_K) + words[j : j + len(full)])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(full[a : b - k + 1]))
        elif b > a:
            one = np.full(1, b - a, np.uint64)
            for j in range(a, b):
                one = mix(one * U(_K) + words[j : j + 1])
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out
