"""Words and hashes of texts, taken from Arrow batches inside tasks.

All word rules work on UTF-8 bytes: ``bytes.lower`` changes A-Z only and
``bytes.split`` cuts at 0x20 and 0x09-0x0D only, whatever the language.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

hash64 = partial(xxhash.xxh64_intdigest, seed=42)

#: Entries of a worker's table of words, about 200 bytes each.
CACHE_LIMIT = 150_000


def needed(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that further columns can never clash with internal names."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def only(table: WordTable | None) -> None:
    """Empties the word tables of other operators: workers live on from stage to stage."""
    held = [t for t in WordTable.made if t is not table and t]
    for other in held:
        other.clear()
    if held:
        gc.collect()
    pa.default_memory_pool().release_unused()
    # Freed memory goes back to the system, where the C library can do that.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def small(batches: Iterable[pa.RecordBatch], rows: int = 1_000,
          table: WordTable | None = None) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that few texts are held as Python values at a time.

    Begins a task that uses no word table but ``table``.
    """
    only(table)
    for batch in batches:
        # Memory of earlier batches goes back before the next one is taken apart.
        pa.default_memory_pool().release_unused()
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def as_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """Texts of a batch as UTF-8 bytes; null is the empty text."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def words(text: bytes) -> list[bytes]:
    return text.lower().split()


class WordTable(dict):
    """Values of words, computed once per word and worker; emptied when it gets large."""

    made: list[WordTable] = []

    def __init__(self, value):
        super().__init__()
        self.value = value
        WordTable.made.append(self)

    def __missing__(self, word):
        if len(self) >= CACHE_LIMIT:
            self.clear()
        found = self[word] = self.value(word)
        return found


WORD_HASHES = WordTable(hash64)


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of every word of the text, in order."""
    found = words(text)
    return np.fromiter(map(WORD_HASHES.__getitem__, found), np.uint64, len(found))


def mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """A second, well-spread 64-bit hash of 64-bit values."""
    x = values + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``width`` words, repeats included.

    A text of fewer words has one run, the whole sequence; a text without words none.
    """
    found = words(text)
    if not found:
        return np.empty(0, np.uint64)
    if len(found) <= width:
        return np.array([hash64(b" ".join(found))], np.uint64)
    runs = map(b" ".join, zip(*(found[k:] for k in range(width))))
    return np.fromiter(map(hash64, runs), np.uint64, len(found) - width + 1)
