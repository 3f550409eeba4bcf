"""Hashes of words, word shingles and MinHash signatures, for whole batches of texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from envlake.llm.common import text_bytes

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2 ** 64
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BLOCK = 1 << 18  # bytes hashed at once; a longer word is hashed alone


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in the bytes, and the number of words of each text."""
    dark = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    first = dark.copy()
    first[1:] &= ~dark[:-1]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[edges] = dark[edges]
    last = dark.copy()
    last[:-1] &= ~dark[1:]
    last[offsets[1:][offsets[:-1] < offsets[1:]] - 1] |= dark[offsets[1:][offsets[:-1] < offsets[1:]] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK, side="right")))
        low, high = int(starts[at]), int(ends[to - 1])
        n = high - low
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw[low:high].astype(np.uint64) + np.uint64(1)) * _powers(n, BASE), out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (sums[e] - sums[s]) * _powers(n + 1, BASE_INVERSE)[s] + (e - s).astype(np.uint64)
        at = to
    return mix(out)


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word shingles, shingles per text, and two digests of each text's words.

    A text of fewer words has one shingle of all its words, one without words has none. The
    digests depend on the words and their order, not on the white space between them.
    """
    raw, offsets = text_bytes(texts)
    starts, ends, counts = words(raw, offsets)
    h = word_hashes(raw, starts, ends)
    n = len(h)
    begin = np.cumsum(counts) - counts
    place = np.arange(n) - np.repeat(begin, counts)
    left = np.repeat(counts, counts) - place  # words from here to the text's end
    total = np.zeros(n, np.uint64)
    factor = mix(np.arange(1, size + 1, dtype=np.uint64))  | np.uint64(1)
    for j in range(size):
        part = np.zeros(n, np.uint64)
        if n > j:
            part[: n - j] = h[j:] * factor[j]
        total += np.where(left > j, part, np.uint64(0))
    total = mix(total)
    keep = place <= np.maximum(np.repeat(counts, counts) - size, 0)
    digests = []
    for salt in (np.uint64(0x9FB21C651E98DF25), np.uint64(0xA24BAED4963EE407)):
        each = mix(h ^ mix(place.astype(np.uint64) * salt + salt))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(each, out=sums[1:])
        digests.append(mix(sums[begin + counts] - sums[begin] + counts.astype(np.uint64) * salt))
    per_text = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    return total[keep], per_text, digests[0], digests[1]


def signatures(hashes: np.ndarray, per_text: np.ndarray, functions: int) -> np.ndarray:
    """MinHash values, one row for each text; a text without shingles gets the largest value."""
    out = np.full((len(per_text), functions), np.uint32(0xFFFFFFFF))
    some = np.flatnonzero(per_text > 0)
    if not len(some):
        return out
    seeds = mix(np.arange(1, 2 * functions + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    first = (np.cumsum(per_text) - per_text)[some]
    low = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    for k in range(functions):
        a, b = np.uint32(seeds[2 * k] & np.uint64(0xFFFFFFFF)) | np.uint32(1), np.uint32(seeds[2 * k + 1] >> np.uint64(32)) | np.uint32(1)
        value = (low * a) ^ (high * b)
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x2C1B3C6D)
        out[some, k] = np.minimum.reduceat(value, first)
    return out
