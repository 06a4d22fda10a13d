"""Words of many texts at once as 64-bit hashes, in numpy on the UTF-8 bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: list[np.ndarray] = []

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _mask(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


# Bytes of a word: all but ASCII white space; or ASCII letters and digits and every byte of a non-ASCII character.
SPACED = ~_mask((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = _mask((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        one = np.ones(1, np.uint64)
        _powers[:] = [np.concatenate([one, np.cumprod(np.full(size - 1, b, np.uint64))]) for b in (BASE, BASE_INVERSE)]
    return _powers[0][:n], _powers[1][:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums over ``values[:i]`` times powers of the base; two of them give the hash of any slice."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def slice_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mixed((sums[ends] - sums[starts]) * powers(len(sums))[1][starts] + (ends - starts).astype(np.uint64))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and where each begins; NULL is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_of(batch: pa.RecordBatch) -> pa.Array:
    return batch.column("text")


def rows_of(docs: DataFrame, carried: list[str] | None = None) -> tuple[DataFrame, Callable[[pa.RecordBatch], pa.Array]]:
    """``row`` (the ``carried`` columns of ``docs``, all unless they are named), and how a batch of it gives the texts.

    A whole row holds its text, so that texts travel once; beside others stands the column ``text``.
    """
    if carried is not None:
        return docs.select(F.struct(*carried).alias("row"), "text"), text_of
    names = docs.columns
    at = names.index("text") if "text" in names else [c.lower() for c in names].index("text")
    return docs.select(F.struct("*").alias("row")), lambda batch: batch.column("row").field(at)


def chunks(batches, text: Callable[[pa.RecordBatch], pa.Array] = text_of, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of whole rows of about ``limit`` bytes, so that memory does not depend on the batch size."""
    for batch in batches:
        data, offsets = utf8(text(batch))
        at = 0
        while at < len(batch):
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            end = min(end, len(batch))
            yield batch.slice(at, end - at), data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
            at = end


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of words before each text; no word crosses texts."""
    inside = table[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[offsets] = True
    bounds = np.flatnonzero(edge)
    kept = inside[bounds[:-1]] if len(data) else np.zeros(0, bool)
    starts, ends = bounds[:-1][kept], bounds[1:][kept]
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased word, and the number of words before each text."""
    starts, ends, before = word_spans(data, offsets, table)
    return slice_hashes(prefix_sums(BYTE_VALUES[LOWER[data]]), starts, ends), before
