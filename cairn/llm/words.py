"""Vectorised word splitting shared by the text operators.

A word is a run of characters other than U+0020 and U+0009..U+000D.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 4 << 20       # text handled at once inside a task, whole documents


class Words(NamedTuple):
    """Words of rows ``start:stop``: row r has ``codes[offsets[r]:offsets[r + 1]]``, each an index into ``vocab``."""
    start: int
    stop: int
    vocab: pa.Array
    codes: np.ndarray
    offsets: np.ndarray


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges holding about ``limit`` bytes each (at least one row)."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, stop
        start = stop


def small_batches(batches: Iterator[pa.RecordBatch], column: int | str) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about CHUNK_BYTES of text, so that what a task holds doesn't follow the batch size."""
    for batch in batches:
        for start, stop in text_chunks(batch.column(column)):
            yield batch.slice(start, stop - start)


def split_words(texts: pa.Array, lower: bool = True, limit: int = CHUNK_BYTES) -> Iterator[Words]:
    """Distinct words and word codes of every row, a bounded chunk of rows at a time; null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    for start, stop in text_chunks(texts, limit):
        part = pc.fill_null(texts.slice(start, stop - start), "")
        if lower:
            part = pc.ascii_lower(part)
        lists = pc.ascii_split_whitespace(part)
        flat = lists.flatten()
        full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
        at = np.concatenate([[0], np.cumsum(full)]).astype(np.int64)
        ends = lists.offsets.to_numpy().astype(np.int64)
        coded = flat.filter(pa.array(full)).dictionary_encode()
        yield Words(start, stop, coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
                    at[ends - ends[0]])


def hash_words(vocab: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hash of each distinct word."""
    f = xxhash.xxh3_64_intdigest
    return np.fromiter((f(w, seed) for w in vocab.cast(pa.binary()).to_pylist()), np.uint64, len(vocab))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all 64 bits (splitmix64)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every k consecutive words, given their hashes; the whole sequence as one when it is shorter."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    width = min(n, k)
    h = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[i:n - width + 1 + i])
    return h


def byte_letters() -> dict[str, int]:
    """The character of each byte in byte-level vocabularies: printable Latin-1 as itself, the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
