"""Repeated passages cut out of documents: every byte of a 100-byte string that starts earlier as well.

A suffix array over all text would need all text in one place. Two windows of 100 bytes can only be equal if they hold the same
anchor: the 32-byte gram with the least hash in the window, the first of equals. So windows meet by their anchor:

1. Each text falls into pieces: consecutive windows with the same anchor, some 130 bytes each. A piece is
   shuffled as two hashes and its place.
2. Pieces that are equal as a whole need no index: all but the earliest are repeated. What remains are anchors with several
   different pieces. Equal pieces within a task are settled there, so copies in great number do not load an anchor's task.
3. The texts of those pieces are fetched and grouped by anchor. Parts that no other piece of the anchor can share are cut off, and a suffix array of
   the rest, by linear grouping, puts equal windows side by side; all but the earliest are repeated.
   A group of more than ``BLOCK`` pieces is indexed in blocks, and windows that are still alone meet across blocks by their hash.
4. The windows of each text are merged to spans.

Positions are bytes of the UTF-8 text. Pieces are compared by 128 bits of hash, whatever is indexed byte by byte.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxsieve.llm import words as w
from rxsieve.llm.store import stored
from rxsieve.llm.suffix_order import suffix_order

WINDOW = 100
GRAM = 32
SPREAD = WINDOW - GRAM  # an anchor begins 0 to 68 bytes after its window
CHUNK_BYTES = 2 << 20
#: Different pieces of an anchor that are indexed together.
BLOCK = 4096
#: The id that stands for NULL.
NO_ID = -(1 << 63)
REPEAT, PIECE = 0, 1


def _place(start, before, length):
    """A piece's place as one number, in order of its start, with the anchor's distance and the length."""
    return start << 14 | before << 7 | length - WINDOW


def _start(place):
    return place >> 14


def _before(place):
    return place >> 7 & 0x7F


def _length(place):
    return (place & 0x7F) + WINDOW


def _anchors(sums: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the gram at each byte, and the place of each window's anchor."""
    at = np.arange(n - GRAM + 1)
    grams = w.slice_hashes(sums, at, at + GRAM)
    least = grams >> np.uint64(32) << np.uint64(32) | at.astype(np.uint64)
    span, count = 1, SPREAD + 1
    while 2 * span <= count:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = count - span
    least = np.minimum(least[: len(least) - rest], least[rest:])
    return grams, (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _pieces(batches):
    """``key`` (hash of the anchor), ``digest``, ``id``, ``tie``, ``place``, ``known``: a repeat already, with a key that only scatters it."""
    for batch, data, offsets in w.chunks(batches, limit=CHUNK_BYTES):
        n = len(data)
        if n < WINDOW:
            continue
        sums = w.prefix_sums(w.BYTE_VALUES[data])
        grams, anchor = _anchors(sums, n)
        # windows within one text
        sizes = np.diff(offsets)
        long = sizes >= WINDOW
        change = np.zeros(n + 1, np.int32)
        np.add.at(change, offsets[:-1][long], 1)
        np.add.at(change, offsets[1:][long] - WINDOW + 1, -1)
        valid = np.cumsum(change[: n - WINDOW + 1]) > 0
        first = valid.copy()
        first[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
        first[offsets[:-1][long]] = True
        last = valid.copy()
        last[:-1] &= first[1:] | ~valid[1:]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + WINDOW
        if not len(starts):
            continue
        text = np.searchsorted(offsets, starts, "right") - 1
        ids, tie = batch.column("id").to_numpy()[text], batch.column("tie").to_numpy()[text]
        place = _place(starts - offsets[text], anchor[starts] - starts, ends - starts)
        key, digest = grams[anchor[starts]], w.slice_hashes(sums, starts, ends)
        order = np.lexsort((tie, place, ids, digest, key))
        key, digest, ids, tie, place = key[order], digest[order], ids[order], tie[order], place[order]
        new = np.ones(len(order), bool)
        new[1:] = (key[1:] != key[:-1]) | (digest[1:] != digest[:-1])
        earliest = np.flatnonzero(new)[np.cumsum(new) - 1]
        known = (ids != ids[earliest]) | (tie != tie[earliest]) | (place != place[earliest])
        own = new | known  # without what a row that occurs again repeats of itself
        key, digest, ids, tie, place, known = key[own], digest[own], ids[own], tie[own], place[own], known[own]
        key = np.where(known, w.mixed(place.astype(np.uint64) + w.mixed(ids.astype(np.uint64) ^ tie.astype(np.uint64))), key)
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(ids), pa.array(tie), pa.array(place), pa.array(known)], ["key", "digest", "id", "tie", "place", "known"])


def _sorted_out(batches):
    """From the pieces in order of key, digest and place: repeats of equal pieces, and the different pieces of keys that have several.

    A key may go on for many batches; all that is kept of it is the last digest with its first id, text and place, its first piece and their number.
    A piece with that id, text and place is the same piece, of a row that occurs again.
    """
    last_key, last_digest, first, count, held = None, None, (0, 0, 0), 0, None
    names = ("id", "tie", "place")
    for batch in batches:
        key, digest = (batch.column(c).to_numpy() for c in ("key", "digest"))
        piece_of = [batch.column(c).to_numpy() for c in names]
        known = batch.column("known").to_numpy(zero_copy_only=False)
        out = [(REPEAT, *(c[known] for c in piece_of), key[known], np.zeros(known.sum(), np.int64))]
        key, digest, piece_of = key[~known], digest[~known], [c[~known] for c in piece_of]
        if len(key):
            new_key = np.append(key[0] != last_key, key[1:] != key[:-1])
            new_piece = new_key | np.append(digest[0] != last_digest, digest[1:] != digest[:-1])
            at = np.flatnonzero(new_piece)
            piece = np.cumsum(new_piece)  # 0: the piece that the batch before ended with
            firsts = [np.append(f, c[at])[piece] for f, c in zip(first, piece_of, strict=True)]
            again = np.any([c != f for c, f in zip(piece_of, firsts, strict=True)], 0)
            out.append((REPEAT, *(c[again] for c in piece_of), key[again], np.zeros(again.sum(), np.int64)))
            own = np.cumsum(new_key)[at]  # 0: the key that the batch before ended with
            counts = np.bincount(own, minlength=int(new_key.sum()) + 1)
            earlier = np.zeros(len(counts), np.int64)
            earlier[0] = count
            number = np.arange(len(at)) - (np.cumsum(counts) - counts)[own] + earlier[own]
            several = (counts + earlier)[own] > 1
            if held and counts[0] and count == 1:
                out.append((PIECE, *(np.array([x], np.int64) for x in held), np.zeros(1, np.int64)))
            told = at[several]
            out.append((PIECE, *(c[told] for c in piece_of), key[told], number[several] // BLOCK))
            ends = len(counts) - 1
            count = int(counts[ends] + earlier[ends])
            last_key, last_digest, first = key[-1], digest[-1], tuple(f[-1] for f in firsts)
            if ends or counts[0]:
                held = None
            if count == 1 and counts[ends] == 1:
                held = (*(c[at[-1]] for c in piece_of), key[at[-1]])
        kind = np.concatenate([np.full(len(o[1]), o[0], np.int32) for o in out])
        columns = [np.concatenate([o[k] for o in out]) for k in range(1, 6)]
        yield pa.RecordBatch.from_arrays([pa.array(kind), *map(pa.array, columns)], ["kind", *names, "key", "block"])


def _cut(batches):
    """The texts of the pieces of each document; a row that occurs again in the task has been cut already."""
    done = set()
    for batch in batches:
        for row in range(len(batch)):
            name = batch.column("id")[row].as_py(), batch.column("tie")[row].as_py()
            if name in done:
                continue
            done.add(name)
            text = batch.column("text")[row].as_py().encode() if batch.column("text")[row].is_valid else b""
            wanted = batch.column("wanted")[row].values
            place, key, block = (wanted.field(c).to_numpy() for c in ("place", "key", "block"))
            texts = [text[a : a + n] for a, n in zip(_start(place).tolist(), _length(place).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(block), *(pa.array(np.full(len(place), x)) for x in name), pa.array(place), pa.array(texts, pa.binary())], ["key", "block", "id", "tie", "place", "piece"])


def _common(one: bytes, two: bytes) -> int:
    """Length of the common prefix."""
    return bisect_left(range(min(len(one), len(two))), True, key=lambda n: one[: n + 1] != two[: n + 1])


def _shared_lengths(sides: list[bytes]) -> list[int]:
    """For each string, its longest common prefix with any other."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    out = [0] * len(sides)
    for a, b in zip(order, order[1:], strict=False):
        n = _common(sides[a], sides[b])
        out[a], out[b] = max(out[a], n), max(out[b], n)
    return out


def _repeats(pieces: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int]]:
    """Of different pieces (id, place, tie, text) around one anchor, the windows that an earlier one has: the piece's number and the window's distance before the anchor."""
    before = [_before(p) for _, p, _, _ in pieces]
    left = _shared_lengths([t[:b][::-1] for b, (*_, t) in zip(before, pieces, strict=True)])
    right = _shared_lengths([t[b:] for b, (*_, t) in zip(before, pieces, strict=True)])
    # a window that begins d bytes before the anchor needs d shared bytes before it and 100 - d from it on
    earliest: dict[tuple[int, bytes], int] = {}
    found = []
    rank = [(i, _start(p) + b, tie) for b, (i, p, tie, _) in zip(before, pieces, strict=True)]
    for k, (*_, text) in enumerate(pieces):
        most, least = left[k], max(before[k] - (len(text) - WINDOW), WINDOW - right[k], 0)
        if most < least:
            continue
        part = (most, text[before[k] - most : before[k] - least + WINDOW])
        other = earliest.setdefault(part, k)
        if other != k:
            late = k if rank[other] < rank[k] else other
            earliest[part] = k + other - late
            found += [(late, d) for d in range(least, most + 1)]
    if len(earliest) < 2:
        return found
    texts, owner, distance = [], [], []
    for (most, part), k in earliest.items():
        texts.append(part)
        windows = len(part) - WINDOW + 1
        owner += [k] * windows + [-1] * WINDOW
        distance += [*range(most, most - windows, -1), *([0] * WINDOW)]
    text = b"\0".join(texts) + b"\0"
    same: list[int] = []
    window = None
    for at in [s for s in suffix_order(text) if owner[s] >= 0]:
        here = text[at : at + WINDOW]
        if here != window:
            window, same = here, [at]
            continue
        # of two equal windows the later one is repeated
        late = max(same[0], at, key=lambda s: rank[owner[s]])
        same[0] = same[0] + at - late
        found.append((owner[late], distance[late]))
    return found


def _indexed(batches):
    """Spans of repeated windows in each block of pieces; and, of blocks that are full or not the first, the windows that are left, by hash."""
    spans: list[tuple[int, int, int, int]] = []
    alone: list[tuple[int, int, int, int, int]] = []

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("key", "block", "id", "place", "tie", "piece")), strict=True)

    def flushed():
        kinds = np.concatenate([np.full(len(spans), 0, np.int32), np.full(len(alone), 1, np.int32)])
        columns = np.array([(*s, 0, 0) for s in spans] + alone, np.int64).reshape(-1, 6).T
        out = pa.RecordBatch.from_arrays([pa.array(kinds), *map(pa.array, np.ascontiguousarray(columns))], ["kind", "id", "tie", "start", "end", "one", "two"])
        spans.clear()
        alone.clear()
        return out

    for (_, block), group in groupby(rows(), key=lambda r: r[:2]):
        pieces = sorted({r[2:] for r in group})
        found = _repeats(pieces)
        for k, d in found:
            number, place, tie, _ = pieces[k]
            start = _start(place) + _before(place) - d
            spans.append((number, tie, start, start + WINDOW))
        if block or len(pieces) >= BLOCK:
            repeated = set(found)
            for k, (number, place, tie, text) in enumerate(pieces):
                for at in range(len(text) - WINDOW + 1):
                    if (k, _before(place) - at) not in repeated:
                        digest = hashlib.blake2b(text[at : at + WINDOW], digest_size=16).digest()
                        one, two = (int.from_bytes(digest[h : h + 8], "little", signed=True) for h in (0, 8))
                        alone.append((number, tie, _start(place) + at, _start(place) + at + WINDOW, one, two))
        if len(spans) + len(alone) > 20_000:
            yield flushed()
    if spans or alone:
        yield flushed()


def _across_blocks(windows: DataFrame) -> DataFrame:
    """The windows whose equal stands earlier in another block."""
    by = ["one", "two"]
    place = F.struct("id", "start", "tie")
    least = windows.groupBy(*by).agg(F.min(place).alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    return windows.join(least, by).where(place != F.col("least")).select("id", "tie", "start", "end")


def repeated_spans(texts: DataFrame) -> DataFrame:
    """``id``, ``tie`` and ``windows`` (start, end; unordered) of the documents that have repeated windows.

    A document is an ``id`` and the hash ``tie`` of its ``text``; nothing is gathered beyond the pieces and windows of one text.
    """
    pieces = texts.mapInArrow(_pieces, "key long, digest long, id long, tie long, place long, known boolean")
    ordered = pieces.repartition("key").sortWithinPartitions("key", "digest", "id", "place", "tie")
    sorted_out = stored(ordered.mapInArrow(_sorted_out, "kind int, id long, tie long, place long, key long, block long"), "pieces")

    wanted = sorted_out.where(F.col("kind") == PIECE).groupBy("id", "tie").agg(F.collect_list(F.struct("place", "key", "block")).alias("wanted"))
    cut = texts.join(wanted, ["id", "tie"]).mapInArrow(_cut, "key long, block long, id long, tie long, place long, piece binary")
    grouped = cut.repartition("key", "block").sortWithinPartitions("key", "block")
    indexed = stored(grouped.mapInArrow(_indexed, "kind int, id long, tie long, start long, end long, one long, two long"), "windows")

    start, length = F.shiftright("place", 14), F.col("place").bitwiseAND(F.lit(0x7F)) + WINDOW
    whole = sorted_out.where(F.col("kind") == REPEAT).select("id", "tie", start.alias("start"), (start + length).alias("end"))
    every = whole.unionByName(indexed.where("kind = 0").select("id", "tie", "start", "end")).unionByName(_across_blocks(indexed.where("kind = 1")))
    return every.groupBy("id", "tie").agg(F.collect_list(F.struct("start", "end")).alias("windows"))


def _kept(batches):
    for batch in batches:
        rows = {n: [] for n in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")}
        for row in range(len(batch)):
            text = batch.column("text")[row].as_py().encode() if batch.column("text")[row].is_valid else b""
            found = batch.column("windows")[row]
            hit = np.zeros(len(text) + 1, np.int64)
            if found.is_valid:
                start, end = (found.values.field(c).to_numpy() for c in ("start", "end"))
                np.add.at(hit, start, 1)
                np.add.at(hit, end, -1)
            removed = np.concatenate([[0], np.cumsum(hit[:-1]) > 0, [0]]).astype(np.int8)
            edges = np.flatnonzero(np.diff(removed)).tolist()
            kept = [text[a:b] for a, b in zip([0, *edges[1::2]], [*edges[::2], len(text)], strict=True)]
            for name, value in zip(rows, (len(text), int(removed.sum()), len(edges) // 2, hashlib.sha256(b"".join(kept)).hexdigest(), edges), strict=True):
                rows[name].append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(rows[n], pa.int64()) for n in ("n_bytes", "n_removed", "n_spans")), pa.array(rows["kept_sha256"], pa.string()), pa.array(rows["spans"], pa.list_(pa.int64()))],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``spans``.

    Every byte covered by a window of 100 bytes that also starts earlier, in a document with a smaller doc_id or at a smaller
    start in the same, is removed; all windows are judged on the input. ``spans`` are the starts and ends, in turn, of the removed runs.
    NULL is the empty text. Rows without doc_id count as the least id; different texts with one doc_id, told apart by 64 bits of hash, are compared
    by start; rows alike in id and text are one document. No rows give no rows.
    """
    texts = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"))
    spans = repeated_spans(texts.select("id", "tie", "text"))
    return texts.join(spans, ["id", "tie"], "left").select("doc_id", "text", "windows").mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>")
