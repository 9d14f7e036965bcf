"""Shared text helpers of the operators: words and shingles as 64-bit hashes.

Everything here runs inside tasks on one block of texts at a time. Words are
found and hashed with numpy over the raw UTF-8 bytes (A-Z lower-cased, no
Python loop per word), in segments of at most ``SEGMENT`` bytes unless one
word is longer, so memory does not depend on a text's length beyond the text
itself and eight bytes per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from martflow.session import work_dir

SEGMENT = 1 << 20
BLOCK_BYTES = 2 << 20

_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # odd, so invertible modulo 2**64

# words are runs of bytes that are no space, tab, line feed, vertical tab, form feed, return
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

# words are runs of ASCII digits, ASCII letters (lower-cased) and all non-ASCII characters
ALNUM = np.zeros(256, dtype=bool)
ALNUM[ord("0"):ord("9") + 1] = True
ALNUM[ord("a"):ord("z") + 1] = True
ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, SEGMENT + 1)
        steps = np.full(size, _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
        steps[1:] = pow(_BASE, -1, 1 << 64)
        _inverse = np.cumprod(steps, dtype=np.uint64)
    return _powers, _inverse


def _segment_words(raw: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of one lower-cased segment."""
    inside = is_word[raw]
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts
    power, inverse = _tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)), starts


def words(raw: bytes, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, byte starts) of the words of raw, A-Z lower-cased."""
    raw = np.frombuffer(raw.lower(), dtype=np.uint8)
    if len(raw) <= SEGMENT:
        return _segment_words(raw, is_word)
    hashes, starts, at = [], [], 0
    while at < len(raw):
        end = min(at + SEGMENT, len(raw))
        while end < len(raw) and is_word[raw[end]]:  # on to the next separator
            gap = np.flatnonzero(~is_word[raw[end:end + SEGMENT]])
            end = end + int(gap[0]) if len(gap) else min(end + SEGMENT, len(raw))
        h, s = _segment_words(raw[at:end], is_word)
        hashes.append(h)
        starts.append(s + at)
        at = end
    return np.concatenate(hashes), np.concatenate(starts)


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """One 64-bit hash per run of n words; all the words as one if fewer; int64."""
    if not len(hashes):
        return np.empty(0, dtype=np.int64)
    width = min(n, len(hashes))
    out = np.full(len(hashes) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        out = mix(out * _MULT + hashes[i:len(hashes) - width + 1 + i])
    return out.view(np.int64)


def text_words(batch: pa.RecordBatch, column: str, is_word: np.ndarray
               ) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of each text of a batch in order; null is empty.

    Short texts are joined into blocks so that numpy works on megabytes.
    """
    texts = batch.column(column).cast(pa.large_binary()).to_pylist()
    at = 0
    while at < len(texts):
        block, size, first = [], 0, at
        while at < len(texts) and (not block or size + len(texts[at] or b"") <= BLOCK_BYTES):
            block.append(texts[at] or b"")
            size += len(block[-1]) + 1
            at += 1
        hashes, starts = words(b"\n".join(block), is_word)
        ends = np.cumsum([len(t) + 1 for t in block])
        cuts = np.searchsorted(starts, ends)
        low = 0
        for i, high in enumerate(cuts):
            yield first + i, hashes[low:high]
            low = int(high)


def arrow_type(df: DataFrame, column: str) -> pa.DataType:
    return to_arrow_type(df.schema[column].dataType)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of df written as Parquet into the shared work folder and read
    back: a lineage cut that survives lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
