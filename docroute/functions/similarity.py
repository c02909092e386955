"""Fuzzy text similarity from 0 to 100, and a perceptual hash of grey pixels, as Arrow-batched functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence; a bit of a whole number for each character of a."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    return 100.0 if not a and not b else 200.0 * common_length(a, b) / (len(a) + len(b))


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter text and a stretch of the longer one of its length, or shorter at the ends.

    Moving a stretch by one character changes the common length by one at most, so from each stretch it is known how many
    of the next ones cannot be better than the best so far; these are skipped.
    """
    short, long = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long else 0.0
    n, m, best, i = len(short), len(long), 0.0, 1 - len(short)
    while i < m:
        part = long[max(i, 0) : i + n]
        common, whole = common_length(short, part), n + len(part)
        best = max(best, 200.0 * common / whole)
        if best == 100.0:
            break
        if i < 0:  # stretches grow: the k-th next has a ratio of 200 (common + k) / (whole + k) at most
            step, end = (best * whole - 200.0 * common) / (200.0 - best), 0
        elif i + n <= m:  # whole stretches: 200 (common + k) / whole
            step, end = (best * whole - 200.0 * common) / 200.0, m - n + 1
        else:  # stretches shrink: 200 common / (whole - k)
            step, end = (whole - 200.0 * common / best if best else m), m
        # The first k that could be better; never past the end of such stretches, and a little early for rounding.
        i = min(i + max(1, int(step - 1e-6) + (step > 1e-6)), max(end, i + 1))
    return best


def token_set_ratio(a: str, b: str) -> float:
    """Compares what two sets of tokens have in common with either set."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not left or not right):
        return 100.0
    whole = [" ".join(filter(None, (both, s))) for s in (left, right)]
    out = 100.0 * (1 - (len(left) + len(right) - 2 * common_length(left, right)) / (len(whole[0]) + len(whole[1])))
    return max(out, *(ratio(both, w) for w in whole)) if both else out


def similarity(a: str | None, b: str | None) -> float:
    """The best of four ratios; 0 if either text is missing or blank."""
    if not a or not b or not a.strip() or not b.strip():
        return 0.0
    best = max(ratio(a, b), ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))), token_set_ratio(a, b))
    return best if best == 100.0 else max(best, partial_ratio(a, b))


@F.pandas_udf(T.DoubleType())
def text_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    pairs = list(zip(a, b, strict=True))
    known = {p: similarity(*p) for p in set(pairs)}
    return pd.Series([known[p] for p in pairs], dtype=float)


def phash(grey: np.ndarray) -> int:
    """64 bits: the low cosine frequencies of a 32x32 image against their median."""
    k = np.arange(32)
    waves = np.cos(np.pi * (2 * k[None, :] + 1) * k[:8, None] / 64)
    low = waves @ grey.astype(float) @ waves.T
    bits = (low > np.median(low)).ravel()
    return int(np.packbits(bits).view(">i8")[0])


@F.pandas_udf(T.LongType())
def phash_of_pixels(pixels: pd.Series) -> pd.Series:
    """From 1024 grey bytes; null for any other size."""
    return pd.Series([phash(np.frombuffer(p, np.uint8).reshape(32, 32)) if p is not None and len(p) == 1024 else None for p in pixels], dtype="Int64")
