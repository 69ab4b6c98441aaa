"""Minimizers of fixed-length byte windows: equal windows have equal minimizers."""

from __future__ import annotations

import numpy as np

from larder.llm.common import mix64


def gram_hashes(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Hashes of all k-byte strings of ``x``; k is a power of two. Doubles the length in each step."""
    table = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(2 * seed + 1))
    h, width = table[x], 1
    factor = int(mix64(np.asarray([seed + 977], np.uint64))[0]) | 1
    while width < k:
        h = h[: len(h) - width] * np.uint64(factor) + h[width:]
        factor = factor * factor % 2**64 ^ 0x9E3779B97F4A7C16
        width *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def window_hashes(x: np.ndarray, window: int) -> list[np.ndarray]:
    """Two hashes of every window of ``x``, each from two overlapping strings that cover it."""
    k = 1 << (window.bit_length() - 1)
    grams = [gram_hashes(x, k, seed) for seed in (3, 4)]
    return [mix64(mix64(h[: len(x) - window + 1]) + h[window - k :]) for h in grams]


def sliding_min(h: np.ndarray, size: int) -> np.ndarray:
    """Least value of every ``size`` neighbours."""
    width, m = 1, h
    while 2 * width <= size:
        m = np.minimum(m[: len(m) - width], m[width:])
        width *= 2
    return np.minimum(m[: len(h) - size + 1], m[size - width :]) if width < size else m


def twice(h: np.ndarray, m: np.ndarray, span: int) -> np.ndarray:
    """Minimizers that one window may hold at two places: text that repeats itself."""
    out = np.full(span - 1, np.uint64(0))
    most = ~sliding_min(~np.r_[out, m, out], span)  # for each place the largest minimizer of the windows that hold it
    at = np.flatnonzero(most == h)
    return h[at[1:]][(h[at[1:]] == h[at[:-1]]) & (np.diff(at) < span)]


def minimizer_runs(x: np.ndarray, window: int, k: int, seed: int = 1, within: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring windows with one minimizer: (minimizer, first window, windows, hash of all
    their bytes, whether windows of the run may equal each other).

    A run has at most window - k + 1 windows, as many as one place of its minimizer can have. With
    ``within``, a number for each window, runs end where the number changes, and windows with a
    negative number are left out.
    """
    none = np.empty(0, np.int64)
    if len(x) < window:
        return none.astype(np.uint64), none, none, none.astype(np.uint64), none.astype(bool)
    h = gram_hashes(x, k, seed)
    span = window - k + 1
    m = sliding_min(h, span)
    new = np.r_[True, m[1:] != m[:-1]]
    if within is not None:
        new |= np.r_[True, within[1:] != within[:-1]]
    first = np.flatnonzero(new)
    size = np.diff(np.r_[first, len(m)])
    if within is not None:
        keep = within[first] >= 0
        first, size = first[keep], size[keep]
        if not len(first):
            return none.astype(np.uint64), none, none, none.astype(np.uint64), none.astype(bool)
    if size.max() > span:  # text that repeats itself: cut such runs
        parts = -(-size // span)
        owner = np.repeat(np.arange(len(first)), parts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        first, size = first[owner] + nth * span, np.minimum(span, size[owner] - nth * span)
    length = size + window - 1
    whole = length.astype(np.uint64)
    for j in range(-(-(2 * window - k) // k)):
        at = np.minimum(j * k, length - k)
        whole = (whole ^ h[first + at]) * np.uint64(0x9FB21C651E98DF25) + np.uint64(j)
        whole ^= whole >> np.uint64(32)
    again = twice(h, m, span)
    return m[first], first, size, whole, np.isin(m[first], again) if len(again) else np.zeros(len(first), bool)
