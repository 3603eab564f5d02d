"""Hashes of words and of word shingles, for whole Arrow batches."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def split_batch(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words (runs without white space) as a dictionary array, and where each text's words begin."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    words, offsets = lists.flatten(), np.asarray(lists.offsets, np.int64)
    offsets = offsets - offsets[0]
    full = np.asarray(pc.binary_length(words), np.int64) > 0  # white space at either end leaves an empty word
    if not full.all():
        words = words.filter(pa.array(full))
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
    return words.dictionary_encode(), offsets


def hash_words(words: pa.DictionaryArray) -> np.ndarray:
    if not len(words):
        return np.zeros(0, np.uint64)
    distinct = pd.util.hash_array(words.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False)
    return distinct[np.asarray(words.indices, np.int64)]


def chain(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` values, one per start."""
    n = max(len(hashes) - size + 1, 0)
    out = hashes[:n].copy()
    for j in range(1, size):
        out = mix(out * _A + hashes[j : j + n])
    return out


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Each text's distinct shingles of `size` words (A-Z lowered), sorted; fewer words make one."""
    words, offsets = split_batch(pc.ascii_lower(texts.cast(pa.large_string())))
    hashes = hash_words(words)
    runs = chain(hashes, size)
    sets = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= size:
            sets.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            short = chain(hashes[a:b], b - a)
            sets.append(mix(short + np.uint64(b - a)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()
