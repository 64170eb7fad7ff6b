"""Hashes of the words of many texts, and of their five-word shingles, in numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5
STEP, GOLDEN = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xD1B54A32D192ED03)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64 bits: two rounds of xor-shift and multiply."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, text after text, and where each text's words begin (one entry more than texts).

    Words end at the six ASCII spaces. A distinct word is hashed once a batch; the hash is the same everywhere.
    """
    split = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    sizes = np.array([len(w) for w in split], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    joined = pa.array([b" ".join(w) for w in split if w], pa.large_binary())
    if not len(joined):
        return np.zeros(0, np.uint64), offsets
    found = pc.split_pattern(joined, b" ").flatten().dictionary_encode()
    distinct = np.array(found.dictionary.to_pylist(), dtype=object)
    hashed = pd.util.hash_array(distinct, categorize=False)
    return hashed[found.indices.to_numpy(zero_copy_only=False)], offsets


def shingles(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of each text in order, and where each text's begin.

    A text of one to four words has one shingle, all its words; a text without words has none.
    """
    sizes = np.diff(offsets)
    counts = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, (sizes > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    if not bounds[-1]:
        return np.zeros(0, np.uint64), bounds
    padded = np.concatenate([words, np.zeros(SHINGLE, np.uint64)])
    rolled = np.zeros(len(words), np.uint64)
    for k in range(SHINGLE):
        rolled = rolled * STEP + padded[k:k + len(words)] + GOLDEN
    at = np.repeat(offsets[:-1] - bounds[:-1], counts) + np.arange(bounds[-1])
    out = rolled[at]
    for i in np.flatnonzero((sizes > 0) & (sizes < SHINGLE)):
        h = np.full(1, sizes[i], np.uint64)
        for w in words[offsets[i]:offsets[i + 1]]:
            h = h * STEP + w + GOLDEN
        out[bounds[i]] = h[0]
    return mix(out), bounds


def cells(hashed: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each text's shingles with their occurrence number, as one hash each: a shingle that a text has three times
    gives three cells. So the cells that two texts share, among all they have, are their weighted similarity."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((hashed, owner))
    h, o = hashed[order], owner[order]
    at = np.arange(len(h))
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    occurrence = at - np.maximum.accumulate(np.where(first, at, 0))
    return mix(h + occurrence.astype(np.uint64) * GOLDEN)
