"""Hashed character n-grams of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import regex

MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x110000))
    table = np.zeros(0x110000, bool)
    for found in regex.finditer(r"\p{L}[\p{L}\p{M}]*", every):
        table[found.start() : found.end()] = True
    return table


@lru_cache(1)
def true_letters() -> np.ndarray:
    """Which code points are letters, marks left out."""
    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x110000))
    table = np.zeros(0x110000, bool)
    for found in regex.finditer(r"\p{L}+", every):
        table[found.start() : found.end()] = True
    return table


def _codes(lowered: str) -> np.ndarray:
    codes = np.frombuffer(lowered.encode("utf-32-le", "replace"), np.uint32).copy()
    codes[~letters()[codes]] = 32
    return codes


def code_parts(text: str, chars: int, reach: int) -> Iterator[np.ndarray]:
    """The codes of one long text, ``chars`` at a time, each part with the first ``reach - 1`` of what follows, so
    that n-grams of ``reach`` codes at most that begin in a part lie wholly in it. Nothing is added at a cut."""
    whole = f" {text.lower()} "
    for at in range(0, len(whole), chars):
        yield _codes(whole[at : at + chars + reach - 1])


def word_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of the lower-cased texts, anything but letters and marks as a blank; end of each text).
    Each text stands between two blanks of its own."""
    joined = " " + "".join(f"{t} " for t in (t.lower() for t in texts))
    codes = _codes(joined)
    ends = np.cumsum([len(t.lower()) + 1 for t in texts])
    return codes, ends


def hashed(codes: np.ndarray, ends: np.ndarray, sizes: tuple[int, ...], bits: int, starts: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text number) of each n-gram that lies within a word; a word's two borders count as characters.
    With ``starts`` only those that begin at one of the first so many codes."""
    blank = codes == 32
    values = codes.astype(np.uint64)
    text = np.searchsorted(ends, np.arange(len(codes)), side="left") if len(ends) else np.zeros(len(codes), np.int64)
    buckets, owners = [], []
    for n in sizes:
        m = len(codes) - n + 1 if starts is None else min(starts, len(codes) - n + 1)
        if m <= 0:
            continue
        h = np.full(m, (n * int(MIX)) & 0xFFFFFFFFFFFFFFFF, np.uint64)
        for k in range(n):
            h = (h ^ values[k : k + m]) * MIX
            h ^= h >> np.uint64(29)
        inner = np.zeros(m, bool)
        for k in range(1, n - 1):
            inner |= blank[k : k + m]
        keep = ~inner & ~(blank[:m] & blank[n - 1 : n - 1 + m])
        buckets.append((h[keep] >> np.uint64(64 - bits)).astype(np.int32))
        owners.append(text[n - 1 : n - 1 + m][keep])
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(buckets), np.concatenate(owners)


def distinct_by_text(buckets: np.ndarray, owners: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text, count), each pair once, ordered by text."""
    keys, counts = np.unique((owners.astype(np.int64) << bits) | buckets, return_counts=True)
    return (keys & ((1 << bits) - 1)).astype(np.int32), keys >> bits, counts
