"""Texts to token ids of a byte-level BPE tokenizer, one merge run for each distinct pre-token.

The tokenizer first cuts a text by a pattern (contractions, letters, numbers, other characters, white space; a
space goes with what follows) and then merges each piece on its own. The cuts are found here for many texts at once, by
the class of each code point, so the tokenizer only sees each distinct piece of a chunk once.

Texts are handed to the tokenizer whole if they hold one of its special strings, white space beyond ASCII's six,
or a code point whose class has changed between Unicode versions or lies outside the basic plane.
"""

from __future__ import annotations

import itertools
import json
import os
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd

from rxsieve.llm import words as w

CHUNK_BYTES = 2 << 20
SLICE_BYTES = 1 << 17
#: The cutting step of the tokenizers meant here.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
#: The character that stands for a byte in a byte-level vocabulary: itself if printable in Latin-1, the rest from 256 on in order.
_BYTES = np.arange(256)
_PRINTED = (_BYTES >= 33) & (_BYTES <= 126) | (_BYTES >= 161) & (_BYTES != 173)
BYTE_CHARS = np.where(_PRINTED, _BYTES, 255 + np.cumsum(~_PRINTED)).astype("<u2")
LETTER, NUMBER, OTHER, WHITE, UNSURE = range(5)
SPACE, APOSTROPHE = ord(" "), ord("'")
#: Cached pieces in a worker; beyond that the cache starts anew.
CACHE = 3 << 18

#: The hash of each code point that the hashes of pieces are summed from.
CODE_VALUES = w.mixed(np.arange(1, (1 << 16) + 2, dtype=np.uint64))


def classes() -> np.ndarray:
    """Class of each code point of the basic plane; the last entry stands for all beyond."""
    out = np.full((1 << 16) + 1, UNSURE, np.uint8)
    for code in range(1 << 16):
        char = chr(code)
        category = unicodedata.category(char)
        if code in (9, 10, 11, 12, 13, 32):
            out[code] = WHITE
        elif category[0] not in "CZ" and category == unicodedata.ucd_3_2_0.category(char):
            out[code] = {"L": LETTER, "N": NUMBER}.get(category[0], OTHER)
        elif code < 28 or code == 127:
            out[code] = OTHER
    return out


class Pieces(NamedTuple):
    text: str
    starts: np.ndarray
    ends: np.ndarray
    before: np.ndarray  # pieces before each text
    offsets: np.ndarray  # code points before each text
    whole: np.ndarray  # texts that the tokenizer must see whole


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """All texts in a row, their code points, and the number of these before each text; invalid bytes become U+FFFD."""
    try:
        text = data.tobytes().decode()
        first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        places = first[offsets]
    except UnicodeDecodeError:
        texts = [data[a:b].tobytes().decode(errors="replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        text, places = "".join(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    return text, np.frombuffer(text.encode("utf-32-le"), np.uint32), places


def pieces(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, special: list[str]) -> tuple[Pieces, np.ndarray]:
    """The pre-tokens of each text, and the hash of each."""
    text, codes, offsets = code_points(data, offsets)
    count = len(codes)
    at = codes.astype(np.int64)
    kind = table.take(at, mode="clip")
    hashed = w.prefix_sums(CODE_VALUES.take(at, mode="clip"))
    text_start = np.zeros(count + 1, bool)
    text_start[offsets] = True
    cut = text_start.copy()
    cut[1:count] |= kind[1:] != kind[:-1]
    white = kind == WHITE
    # the last white space before another character stands alone, or goes with that character if it is a space
    follows = np.zeros(count, bool)
    follows[1:] = ~white[1:] & white[:-1] & ~text_start[1:count]
    at = np.flatnonzero(follows)
    cut[at - 1] = True
    cut[at[codes[at - 1] == SPACE]] = False
    # contractions, where the apostrophe begins a piece
    at = np.flatnonzero((codes == APOSTROPHE) & cut[:count])
    if len(at):
        padded = np.append(codes, [0, 0]).astype(np.uint64)
        one, two = padded[at + 1], padded[at + 2]
        inside, further = ~text_start[np.minimum(at + 1, count)], ~text_start[np.minimum(at + 2, count)]
        short = inside & np.isin(one, np.array([ord(c) for c in "stmd"], np.uint64))
        pair = one << np.uint64(32) | two
        long = inside & further & np.isin(pair, np.array([ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")], np.uint64))
        cut[at[short | long] + 1] = False
        cut[at[short] + 2] = True
        cut[at[long] + 3] = True
    starts = np.flatnonzero(cut[:count])
    ends = np.append(starts[1:], count) if len(starts) else starts
    whole = np.zeros(len(offsets) - 1, bool)
    text_of = lambda places: np.searchsorted(offsets, places, "right") - 1
    whole[text_of(np.flatnonzero(kind == UNSURE))] = True
    for string in special:
        place = text.find(string)
        while place >= 0:
            whole[text_of(place)] = True
            place = text.find(string, place + 1)
    return Pieces(text, starts, ends, np.searchsorted(starts, offsets), offsets, whole), w.slice_hashes(hashed, starts, ends)


def slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``SLICE_BYTES``: small enough that the arrays over their code points stay in the processor's cache."""
    at, count = 0, len(offsets) - 1
    while at < count or not at:
        end = min(count, max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1))
        yield data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = max(end, 1)


def joined(parts: Iterable[tuple[Pieces, np.ndarray]]) -> tuple[Pieces, np.ndarray]:
    """The pieces of runs of texts as those of one."""
    found, hashes = zip(*parts, strict=True)
    chars = np.cumsum([0, *(len(p.text) for p in found)])
    counts = np.cumsum([0, *(len(p.starts) for p in found)])
    shifted = lambda field, by, end=None: np.concatenate([getattr(p, field)[:end] + b for p, b in zip(found, by, strict=False)])
    return Pieces(
        "".join(p.text for p in found), shifted("starts", chars), shifted("ends", chars),
        np.append(shifted("before", counts, -1), counts[-1]), np.append(shifted("offsets", chars, -1), chars[-1]), np.concatenate([p.whole for p in found]),
    ), np.concatenate(hashes)


class Encoder:
    """Ids of texts as the tokenizer gives them, without added special tokens."""

    def __init__(self, source: str, table: np.ndarray):
        """``source`` is the tokenizer's JSON."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.table = table
        self.known: dict[int, bytes] = {}
        self.older: dict[int, bytes] = {}
        parts = json.loads(source)
        #: Whether this is the kind of tokenizer whose cuts are found here; the texts of any other go to it whole.
        self.cuts = parts["pre_tokenizer"] is not None and BYTE_LEVEL.items() <= parts["pre_tokenizer"].items() and not parts["normalizer"]

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def distinct(self, data: np.ndarray, offsets: np.ndarray) -> tuple[Pieces, np.ndarray, np.ndarray, np.ndarray]:
        """The pieces, the number of each one's string, and for each string its hash and a place where it stands."""
        found, hashes = joined(pieces(d, o, self.table, self.special) for d, o in slices(data, offsets))
        if not self.cuts:
            found.whole[:] = True
        number, strings = pd.factorize(hashes)
        place = np.zeros(len(strings), np.int64)
        place[number[::-1]] = np.arange(len(number))[::-1]
        return found, number, strings, place

    def _merged(self, texts: list[str]) -> list[bytes]:
        """Ids of each piece, as unsigned 32-bit integers: its bytes go through the tokenizer's merges."""
        raw = [t.encode() for t in texts]
        chars = BYTE_CHARS[np.frombuffer(b"".join(raw), np.uint8)].tobytes().decode("utf-16-le")
        merge, ids, ends, at = self.model.tokenize, [], [0], 0
        for piece in raw:
            end = at + len(piece)
            ids += [t.id for t in merge(chars[at:end])]
            ends.append(4 * len(ids))
            at = end
        flat = array("I", ids).tobytes()
        return [flat[a:b] for a, b in itertools.pairwise(ends)]

    def ids_of(self, found: Pieces, strings: np.ndarray, place: np.ndarray) -> list[bytes]:
        """Ids of each distinct string.

        What is known is kept in two halves; when the newer one is full it becomes the older one, so that frequent pieces stay.
        """
        if len(self.known) > CACHE // 2:
            self.older, self.known = self.known, {}
        keys = strings.tolist()
        out = list(map(self.known.get, keys))
        missing = [k for k, ids in enumerate(out) if ids is None]
        if self.older:
            for k in missing:
                out[k] = self.older.get(keys[k])
        new = [k for k in missing if out[k] is None]
        text, at = found.text, place[new]
        texts = [text[a:b] for a, b in zip(found.starts[at].tolist(), found.ends[at].tolist(), strict=True)]
        for k, ids in zip(new, self._merged(texts), strict=True):
            out[k] = ids
        self.known.update((keys[k], out[k]) for k in missing)
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids before each."""
        found, number, strings, place = self.distinct(data, offsets)
        lists = self.ids_of(found, strings, place)
        sizes = np.fromiter(map(len, lists), np.int32, len(lists)) // 4
        flat = np.frombuffer(b"".join(lists), "<u4")
        first = np.cumsum(sizes, dtype=np.int32) - sizes
        count = sizes[number]
        ends = np.zeros(len(number) + 1, np.int32)
        np.cumsum(count, out=ends[1:])
        ids = flat[np.arange(ends[-1], dtype=np.int32) + np.repeat(first[number] - ends[:-1], count)]
        before = ends[found.before].astype(np.int64)
        if found.whole.any():
            parts = [ids[a:b] for a, b in zip(before[:-1], before[1:], strict=True)]
            texts = np.flatnonzero(found.whole)
            for k, own in zip(texts, self.whole([found.text[found.offsets[k] : found.offsets[k + 1]] for k in texts]), strict=True):
                parts[k] = np.array(own, np.uint32)
            ids, before = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, before


def shared_encoder(value: tuple[str, np.ndarray, dict]) -> Encoder:
    """The encoder of a broadcast (JSON, classes, {}): a worker process keeps it in its copy, so that its tasks share what is cached."""
    source, table, kept = value
    if "encoder" not in kept:
        kept["encoder"] = Encoder(source, table)
    return kept["encoder"]
