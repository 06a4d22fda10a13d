"""Token counts by a shortcut for whole tokens.

A byte-level BPE tokenizer cuts a text into pre-tokens and merges the bytes of each. Most of the vocabulary's strings are
pre-tokens that merge to one token. Which ones, is proved beforehand by encoding every string of the vocabulary; the merges
work on each pre-token by itself, so that holds in every text. A pre-token among them counts one without a
merge, and only the distinct others of a chunk go through the merges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxsieve.llm import words as w
from rxsieve.llm.pretokens import CHUNK_BYTES, Encoder, classes, shared_encoder

LIMIT = 1024


def whole_tokens(encoder: Encoder) -> np.ndarray:
    """Sorted hashes of the vocabulary's strings that are one pre-token and encode as one token."""
    size = encoder.tokenizer.get_vocab_size(with_added_tokens=False)
    texts = [encoder.tokenizer.decode([k], skip_special_tokens=False) for k in range(size)]
    texts = [t for t in texts if t and "�" not in t]
    texts = [t for t, ids in zip(texts, encoder.whole(texts), strict=True) if len(ids) == 1]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    found, number, strings, _ = encoder.distinct(data, offsets)
    alone = (np.diff(found.before) == 1) & ~found.whole
    return np.unique(strings[number[found.before[:-1][alone]]])


def token_counts(docs: DataFrame, tokenizer_file: str, limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): ``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit``; other columns are ignored.

    The counts are those of the tokenizer without begin, end or added special tokens; special strings in a text are the tokens
    they stand for. NULL and empty texts have none.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        source = file.read()
    table = classes()
    shared = docs.sparkSession.sparkContext.broadcast(((source, table, {}), whole_tokens(Encoder(source, table))))

    def count(batches):
        own, alone = shared.value
        encoder = shared_encoder(own)
        for batch, data, offsets in w.chunks(batches, limit=CHUNK_BYTES):
            found, number, strings, place = encoder.distinct(data, offsets)
            size = np.ones(len(strings), np.int64)
            rest = np.flatnonzero(alone[np.minimum(np.searchsorted(alone, strings), len(alone) - 1)] != strings)
            size[rest] = [len(ids) // 4 for ids in encoder.ids_of(found, strings[rest], place[rest])]
            sums = np.concatenate([[0], np.cumsum(size[number])])
            total = np.diff(sums[found.before])
            texts = np.flatnonzero(found.whole)
            total[texts] = [len(ids) for ids in encoder.whole([found.text[found.offsets[k] : found.offsets[k + 1]] for k in texts])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(total)], ["doc_id", "n_bytes", "n_tokens"])

    counted = docs.select("doc_id", "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
