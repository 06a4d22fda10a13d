"""Ranks of a linked list kept in a table: how much weight lies before each node.

1. The rows are dealt by ranges of their key. In each run of ``CHUNK`` rows, the pieces of the list that lie there whole are walked and each is replaced by one
   node: the piece's first, with the weight of all. Lists whose neighbours have near keys, as a tour's arcs have, shrink to few nodes.
2. While more than ``BASE`` nodes are left, all toss a coin; a node that shows heads swallows the next one if that shows tails. A quarter of the
   nodes goes in each round, whatever the list looks like.
3. The last ``BASE`` nodes at most are walked in one task, and the rounds are undone from the last to the first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxsieve.llm.store import stored

CHUNK = 1 << 20
BASE = 1 << 14
KEY, NEXT, HEAD = ("conv", "step"), ("to_conv", "to_step"), ("head_conv", "head_step")
WEIGHTS = ("n", "leaves", "saved")
BEFORE = tuple(f"{w}_before" for w in WEIGHTS)
LIST = ", ".join(f"{c} long" for c in (*KEY, *NEXT, *WEIGHTS))


def _places(keys: np.ndarray, wanted: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Row of each wanted key (pairs of numbers), -1 for those that no row has or that are not known."""
    out = np.full(len(wanted), -1)
    both = np.concatenate([keys, wanted[known]])
    _, code = np.unique(both[:, 0], return_inverse=True)
    packed = code * (int(both[:, 1].max(initial=0)) + 1) + both[:, 1]
    order = np.argsort(packed[: len(keys)])
    asked = packed[len(keys) :]
    at = order[np.minimum(np.searchsorted(packed[: len(keys)], asked, sorter=order), len(keys) - 1)]
    out[known] = np.where(packed[at] == asked, at, -1)
    return out


def walked(following: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first node of each node's piece, and the weight of the piece before it, by doubling the steps; ``following`` is -1 at the end of a piece."""
    head = np.arange(len(following))
    inner = following >= 0
    back = head.copy()
    back[following[inner]] = head[inner]
    before = np.where((back != head)[:, None], weights[back], 0)
    while (back[back] != back).any():
        before += before[back]
        back = back[back]
    return back, before


def _pieces(chunk: int):
    def contract(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= chunk:
                yield _contracted(held)
                held, size = [], 0
        if size:
            yield _contracted(held)

    return contract


def _contracted(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(batches)
    number = lambda c: rows.column(c).combine_chunks().fill_null(0).to_numpy()
    keys, to = (np.stack([number(c) for c in pair], 1) for pair in (KEY, NEXT))
    ended = rows.column(NEXT[0]).combine_chunks().is_null().to_numpy(zero_copy_only=False)
    weights = np.stack([number(c) for c in WEIGHTS], 1)
    following = _places(keys, to, ~ended)
    head, before = walked(following, weights)
    names = [*rows.column_names, *HEAD, *BEFORE, "tail"]
    columns = [*(rows.column(c).combine_chunks() for c in rows.column_names), *(pa.array(keys[head, k]) for k in range(2)), *(pa.array(before[:, k]) for k in range(3)), pa.array(following < 0)]
    return pa.RecordBatch.from_arrays(columns, names)


def _walk_rest(batches):
    batches = [b for b in batches if len(b)]
    if batches:
        done = _contracted(batches)
        yield done.select([*KEY, *BEFORE])


def _named(pair: tuple[str, str]) -> list[Column]:
    return [F.col(c).alias(k) for c, k in zip(pair, KEY, strict=True)]


def _round(rows: DataFrame, seed: int) -> DataFrame:
    """Heads beside the tails that follow them, and what is left alone of both: columns of the head, and of the tail with ``_b`` behind their names."""
    coin = F.xxhash64(F.lit(seed), *KEY).bitwiseAND(F.lit(1))
    heads, tails = rows.where(coin == 0), rows.where(coin == 1)
    tails = tails.select(*(F.col(c).alias(f"{c}_b") for c in tails.columns))
    return heads.join(tails, (F.col("to_conv") == F.col("conv_b")) & (F.col("to_step") == F.col("step_b")), "full")


def _left(pairs: DataFrame) -> DataFrame:
    alone, both = F.col("conv").isNull(), F.col("conv").isNotNull() & F.col("conv_b").isNotNull()
    return pairs.select(
        *(F.coalesce(c, f"{c}_b").alias(c) for c in KEY),
        *(F.when(alone | both, F.col(f"{c}_b")).otherwise(F.col(c)).alias(c) for c in NEXT),
        *((F.coalesce(c, F.lit(0)) + F.coalesce(f"{c}_b", F.lit(0))).alias(c) for c in WEIGHTS),
    )


def _undone(pairs: DataFrame, ranks: DataFrame) -> DataFrame:
    """The ranks of the nodes before a round, from those after it."""
    swallowed = pairs.where("conv is not null and conv_b is not null")
    of_head = swallowed.join(ranks, list(KEY))
    return ranks.unionByName(of_head.select(F.col("conv_b").alias("conv"), F.col("step_b").alias("step"), *((F.col(b) + F.col(w)).alias(b) for b, w in zip(BEFORE, WEIGHTS, strict=True))))


def ranked(rows: DataFrame, chunk: int = CHUNK, base: int = BASE) -> DataFrame:
    """``rows`` of one list with ``n_before``, ``leaves_before``, ``saved_before``: the weights of all nodes before each.

    A row has its key ``conv``, ``step``, the key of the node that follows (``to_conv``, ``to_step``; NULL at the end) and its weights ``n``,
    ``leaves``, ``saved``; other columns are carried along. No rows give no rows.
    """
    schema = ", ".join([*(f"{c} {t}" for c, t in rows.dtypes), *(f"{c} long" for c in (*HEAD, *BEFORE)), "tail boolean"])
    dealt = rows.repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    pieces = stored(dealt.mapInArrow(_pieces(chunk), schema), "pieces")
    left = pieces.where("tail").select(*_named(HEAD), *NEXT, *((F.col(b) + F.col(w)).alias(w) for b, w in zip(BEFORE, WEIGHTS, strict=True)))
    rounds: list[DataFrame] = []
    while left.count() > base:
        rounds.append(stored(_round(left, len(rounds)), "round"))
        left = _left(rounds[-1])
    ranks = left.repartition(1).mapInArrow(_walk_rest, ", ".join(f"{c} long" for c in (*KEY, *BEFORE)))
    for pairs in reversed(rounds):
        ranks = stored(_undone(pairs, ranks), "ranks")
    of_head = ranks.select(*(F.col(k).alias(h) for k, h in zip(KEY, HEAD, strict=True)), *(F.col(b).alias(f"{b}_head") for b in BEFORE))
    return pieces.join(of_head, list(HEAD)).select(*rows.columns, *((F.col(b) + F.col(f"{b}_head")).alias(b) for b in BEFORE))
