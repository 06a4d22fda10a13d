"""Benchmark passages in documents, found through an FM-index for each shard of the documents.

A shard is some megabytes of whole texts, indexed in the task that reads them, so the documents are
never shuffled. Its sequence holds the words that some benchmark item has, as numbers; any other word, and the end of a
text, is a separator, and runs between separators that are shorter than the shortest window are left out:
no window can lie there. The test windows are then searched backwards in the index, all at once, the
places of those found are looked up by sampled suffix positions, and the places are merged to spans.

The benchmark is a stated set of queries. It is read in blocks of bounded size, each of which goes over all documents.
Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxsieve.llm import words as w
from rxsieve.llm.fm_index import FMIndex
from rxsieve.llm.store import stored

WINDOW = 10
SHARD_BYTES = 8 << 20
#: Text of the benchmark that is sent to the tasks at once.
BLOCK_BYTES = 16 << 20
#: Windows that are searched at once.
PATTERNS = 1 << 17
FILTER_BITS = 20


class Windows(NamedTuple):
    """Distinct windows of a block of items, and the items that have them, all as arrays."""

    vocabulary: np.ndarray  # sorted hashes; a word's number is its place, from 1
    words: np.ndarray  # the items' words as numbers, one item after the other
    starts: dict[int, np.ndarray]  # by length of the windows: where each begins in words
    owners: dict[int, tuple[np.ndarray, np.ndarray]]  # and the numbers of the items that have it, with where they begin
    names: pa.Array  # of the items' numbers, sorted

    def patterns(self, width: int, first: int) -> np.ndarray:
        """The words of ``PATTERNS`` windows from the ``first`` on."""
        return self.words[self.starts[width][first : first + PATTERNS, None] + np.arange(width)]

    def items(self, width: int, windows: np.ndarray) -> np.ndarray:
        """Numbers of the items that have any of the windows."""
        numbers, begin = self.owners[width]
        first, count = begin[windows], begin[windows + 1] - begin[windows]
        return np.unique(numbers[np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())])


def windows(items: pa.Table) -> Windows:
    """``items``: ``item_id``, which may be NULL, and ``words``, hashes. An item without an id has windows without a name."""
    words = items.column("words").combine_chunks()
    sizes = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    hashes, ends = words.flatten().to_numpy().view(np.uint64), np.cumsum(sizes)
    names, number = np.unique(items.column("item_id").to_numpy().astype(object)[items.column("item_id").is_valid().to_numpy()].astype(str), return_inverse=True)
    name = np.full(len(sizes), -1, np.int32)
    name[items.column("item_id").is_valid().to_numpy()] = number
    vocabulary = np.unique(hashes)
    numbers = (np.searchsorted(vocabulary, hashes) + 1).astype(np.int32)
    sums = w.prefix_sums(hashes)
    starts, owners = {}, {}
    for width in np.unique(np.minimum(sizes[sizes > 0], WINDOW)).tolist():
        of_width = np.flatnonzero(np.minimum(sizes, WINDOW) == width)
        count = sizes[of_width] - width + 1
        at = np.repeat((ends - sizes)[of_width] - np.cumsum(count) + count, count) + np.arange(count.sum())
        _, first, window = np.unique(w.slice_hashes(sums, at, at + width), return_index=True, return_inverse=True)
        starts[width] = at[first].astype(np.int32)
        owner = np.repeat(name[of_width], count)
        named = np.unique(window[owner >= 0] * len(names) + owner[owner >= 0]) if len(names) else np.zeros(0, np.int64)
        begin = np.searchsorted(named, np.arange(len(first) + 1) * max(1, len(names)))
        owners[width] = (named % max(1, len(names))).astype(np.int32), begin.astype(np.int32)
    return Windows(vocabulary, numbers, starts, owners, pa.array(names.tolist(), pa.string()))


def _words(batches):
    for batch, data, offsets in w.chunks(batches):
        hashes, before = w.word_hashes(data, offsets, w.ALPHANUMERIC)
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.ListArray.from_arrays(pa.array(before, pa.int32()), pa.array(hashes.view(np.int64)))], ["item_id", "words"])


def _sequence(hashes: np.ndarray, before: np.ndarray, block: Windows, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols to index, and which word of the shard each stands for."""
    number = np.zeros(len(hashes), np.int64)
    maybe = np.flatnonzero(seen[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
    place = np.minimum(np.searchsorted(block.vocabulary, hashes[maybe]), len(block.vocabulary) - 1)
    number[maybe] = np.where(block.vocabulary[place] == hashes[maybe], place + 1, 0)
    known = number > 0
    starts = known.copy()
    starts[1:] &= ~known[:-1]
    text_starts = before[:-1][before[:-1] < len(known)]
    starts[text_starts] |= known[text_starts]
    run = np.cumsum(starts) - 1
    length = np.bincount(run[known], minlength=int(starts.sum()))
    kept = known & (length[np.maximum(run, 0)] >= min(block.starts)) if len(length) else known
    at = np.flatnonzero(kept)
    # a separator after the last word of each run
    ends = np.append(run[at][1:] != run[at][:-1], True) if len(at) else np.zeros(0, bool)
    to = np.arange(len(at)) + np.cumsum(ends) - ends
    symbols, word = np.zeros(len(at) + int(ends.sum()), np.int64), np.zeros(len(at) + int(ends.sum()), np.int64)
    symbols[to], word[to] = number[at], at
    return symbols, word


def _search(hashes: np.ndarray, before: np.ndarray, block: Windows, seen: np.ndarray) -> tuple[np.ndarray, dict[int, set[int]]]:
    """For the words of a shard, how many windows cover each; for its texts that have any, the numbers of the items that occur."""
    covered = np.zeros(len(hashes) + 1, np.int64)
    items: dict[int, set[int]] = {}
    symbols, word = _sequence(hashes, before, block, seen)
    if len(symbols):
        index = FMIndex(symbols)
        for width, starts in block.starts.items():
            for some in range(0, len(starts), PATTERNS):
                first, end = index.search(block.patterns(width, some))
                count = end - first
                pattern = np.repeat(np.arange(len(count)), count)
                rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
                start = word[index.locate(rows)]
                np.add.at(covered, start, 1)
                np.add.at(covered, start + width, -1)
                text = np.searchsorted(before, start, "right") - 1
                found = np.unique(text * PATTERNS + pattern)
                texts, begin = np.unique(found // PATTERNS, return_index=True)
                for k, own in zip(texts.tolist(), np.split(found % PATTERNS + some, begin[1:]), strict=False):
                    items.setdefault(k, set()).update(block.items(width, own).tolist())
    return np.cumsum(covered[:-1]), items


def _spans(hit: np.ndarray) -> list[int]:
    """Starts and ends, in turn, of the runs of words that are hit."""
    return np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]]))).tolist()


def _pass(rows: DataFrame, items: pa.Table, text: Callable[[pa.RecordBatch], pa.Array], names: list[str]) -> DataFrame:
    """``rows`` (row, n_words, spans, items and perhaps text) with what one block of the benchmark adds; they go on with the columns ``names``."""
    shared = rows.sparkSession.sparkContext.broadcast(tuple(windows(items)))

    def find(batches):
        block = Windows(*shared.value)
        seen = np.zeros(1 << FILTER_BITS, bool)
        seen[(block.vocabulary >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        for batch, data, offsets in w.chunks(batches, text, SHARD_BYTES):
            # hashes in smaller pieces, to keep the working arrays small
            parts = [w.word_hashes(d, o, w.ALPHANUMERIC) for _, d, o in w.chunks([batch], text)]
            hashes = np.concatenate([h for h, _ in parts])
            before = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(b) for _, b in parts]))])
            covered, found = _search(hashes, before, block, seen) if block.starts else (np.zeros(len(hashes), np.int64), {})
            spans, known_items = [], []
            for k, (old, known) in enumerate(zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True)):
                if k not in found:
                    spans.append(old)
                    known_items.append(known)
                    continue
                hit = covered[before[k] : before[k + 1]] > 0
                for a, b in zip(old[::2], old[1::2], strict=True):
                    hit[a:b] = True
                spans.append(_spans(hit.astype(np.int8)))
                known_items.append(sorted({*block.names.take(pa.array(sorted(found[k]), pa.int32())).to_pylist(), *known}))
            new = {"n_words": pa.array(np.diff(before)), "spans": pa.array(spans, pa.list_(pa.int32())), "items": pa.array(known_items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([new[c] if c in new else batch.column(c) for c in names], names)

    return rows.mapInArrow(find, T.StructType([rows.schema[c] for c in names]))


def find_passages(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, carried: list[str] | None = None) -> DataFrame:
    """Per row of ``docs``: ``row`` (its ``carried`` columns, all unless they are named), ``n_words``, ``spans``, ``items``.

    ``spans`` are the starts and ends, in turn, of the runs of words inside an occurrence of a window of ten
    consecutive words of an item, or of a whole shorter item; ``items`` are the ids, as strings and sorted, of the items
    that have such an occurrence. Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.
    NULL texts have no words; items without words have no windows; an item without id hits words and has no name; texts of a repeated id all count for it.
    An empty benchmark finds nothing.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    rows, text = w.rows_of(docs, carried)
    rows = rows.withColumns({"n_words": F.lit(0).cast("long"), "spans": F.array().cast("array<int>"), "items": F.array().cast("array<string>")})
    if blocks > 1:
        items = stored(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "items")
    for k in range(blocks):
        block = items.where(F.col("block") == k) if blocks > 1 else items
        found = block.select("item_id", "text").mapInArrow(_words, "item_id string, words array<long>").toArrow()
        # the last pass has no use for the texts
        names = [c for c in rows.columns if c != "text" or k < blocks - 1]
        rows = _pass(rows if k == 0 else stored(rows, "passages"), found, text, names)
    return rows


def n_hit(spans: Column) -> Column:
    """Words inside the spans."""
    return F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).cast("long").alias("sign")), lambda s, x: F.struct((s["sum"] + s["sign"] * x).alias("sum"), (-s["sign"]).alias("sign")), lambda s: s["sum"])


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``; other columns are ignored."""
    found = find_passages(docs, benchmark, carried=["doc_id"])
    return found.select("row.doc_id", "n_words", n_hit(F.col("spans")).alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def without_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, whatever their columns, that hold no benchmark passage."""
    return find_passages(docs, benchmark).where(F.size("spans") == 0).select("row.*")
