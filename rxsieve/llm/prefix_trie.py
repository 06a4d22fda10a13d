"""The prefix trie of conversations by the Euler-tour technique.

1. Turns become two 64-bit hashes. A conversation's turns are numbered in a global order, so that a very long one is spread over tasks, and
   each prefix gets 128 bits of polynomial hash from running sums. Prefixes with equal hashes are one node.
2. The nodes stand once as parents and once as children in one order: a parent, then its children by their least member. Reading along that order links the arcs
   of the tour: a node's enter arc leads to its first child's, or to its own exit arc; an exit arc leads to the next child's enter arc, or to the parent's exit arc.
3. The tour is ranked as a list (``list_rank``), each enter arc with the leaf and the savings that its node adds. What lies before a node's exit arc less what
   lies before its enter arc is the sum over its subtree.

An arc's key is the least member of its node and twice the depth, plus one for an exit: neighbours on the tour are mostly neighbours by key.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxsieve.llm import list_rank
from rxsieve.llm import words as w
from rxsieve.llm.in_order import in_order, summaries
from rxsieve.llm.mixing import n_words
from rxsieve.llm.store import stored

FAMILY = 20
#: Turns that a conversation takes over from the first of its family, less one at most.
SHARED = 4
#: Bytes of ids that are joined before they meet the others of a node.
PIECE = 8000


def power(base: np.uint64, exponents: np.ndarray) -> np.ndarray:
    out, factor, left = np.ones(len(exponents), np.uint64), np.uint64(base), exponents.astype(np.uint64)
    with np.errstate(over="ignore"):
        while left.any():
            out = np.where(left & np.uint64(1), out * factor, out)
            factor, left = factor * factor, left >> np.uint64(1)
    return out


def shifted(values: np.ndarray, by: np.ndarray) -> np.ndarray:
    """``values`` times the base to the power ``by``, which may be negative."""
    return values * power(w.BASE, np.maximum(by, 0)) * power(w.BASE_INVERSE, np.maximum(-by, 0))


def _numbers(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _unsigned(column) -> np.ndarray:
    return np.ascontiguousarray(_numbers(column)).view(np.uint64)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _runs(same_as_before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the start of the run of each row."""
    starts = np.flatnonzero(~same_as_before)
    return starts, np.cumsum(~same_as_before)


TURNS = "part int, seq long, conv_id long, k long, one long, two long, words long, sum_one long, sum_two long"


def _number_turns(batches):
    """Each turn's number in its conversation and the sums up to it, both counted from where the part begins.

    The summary has the first conversation, in ``one`` the last, with its turns and sums in the part.
    """
    names = [f.split()[0] for f in TURNS.split(", ")]
    first, part = None, 0
    seq, last, count, carry = 0, None, 0, [np.zeros(1, np.uint64)] * 2
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        conv = _numbers(batch.column("conv_id"))
        same = np.append(last is not None and conv[0] == last, conv[1:] == conv[:-1])
        starts, run = _runs(same)
        k = np.arange(n) - np.concatenate([[-count], starts])[run]
        sums = []
        for side, name in enumerate(("one", "two")):
            values = _unsigned(batch.column(name)) * power(w.BASE, k)
            total = np.cumsum(values)
            before = np.concatenate([-carry[side], total[starts] - values[starts]])
            sums.append(total - before[run])
            carry[side] = sums[-1][-1:]
        first = conv[0] if first is None else first
        last, count, part = conv[-1], int(k[-1]) + 1, batch.column("part")[0].as_py()
        yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(np.arange(seq, seq + n)), batch.column("conv_id"), pa.array(k), *(batch.column(c) for c in ("one", "two", "words")), *map(_signed, sums)], names)
        seq += n
    if seq:
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *(pa.array([x], pa.int64()) for x in (-1, first, count, last, 0, 0)), *map(_signed, carry)], names)


def _carried_turns(parts: DataFrame) -> dict[int, tuple[int, int, int, int]]:
    """By part, the conversation that goes on there, with its turns so far and their sums."""
    out, now = {}, (None, 0, 0, 0)
    base, mask = int(w.BASE), (1 << 64) - 1
    for row in summaries(parts):
        going = row.conv_id == now[0]
        if going:
            out[row.part] = now
        before = now if going and row.one == now[0] else (row.one, 0, 0, 0)
        factor = pow(base, before[1], 1 << 64)
        now = (row.one, before[1] + row.k, (before[2] + factor * row.sum_one) & mask, (before[3] + factor * row.sum_two) & mask)
    return out


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` from 0, ``one``, ``two``, ``words``, and the hashes ``sum_one``, ``sum_two`` of the turns up to this one."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(F.lit(1), role, text).alias("one"), F.xxhash64(F.lit(2), role, text).alias("two"), n_words(F.col("text")).alias("words")
    )
    # hashed before the order is sampled, so that texts are read once
    turns = stored(turns, "hashed")
    parts = in_order(turns, ["conv_id", F.col("turn").asc_nulls_first(), "one", "two"], _number_turns, TURNS, "turns")
    carried = conversations.sparkSession.sparkContext.broadcast(_carried_turns(parts))

    def whole(batches):
        for batch in batches:
            part, conv, k = (_numbers(batch.column(c)) for c in ("part", "conv_id", "k"))
            sums = [_unsigned(batch.column(c)) for c in ("sum_one", "sum_two")]
            place = k.copy()
            for one in np.unique(part):
                going, count, *before = carried.value.get(int(one), (None, 0, 0, 0))
                if going is not None:
                    at = np.flatnonzero((part == one) & (conv == going))
                    place[at] += count
                    for side in range(2):
                        sums[side] = sums[side].copy()
                        sums[side][at] = np.uint64(before[side]) + shifted(sums[side][at], np.array([count]))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(place), *(batch.column(c) for c in ("one", "two", "words")), *map(_signed, sums)], ["conv_id", "place", "one", "two", "words", "sum_one", "sum_two"])

    return parts.where("seq >= 0").drop("seq").mapInArrow(whole, "conv_id long, place long, one long, two long, words long, sum_one long, sum_two long")


NODE = ("depth", "one", "two")
PATH = "conv_id long, depth long, one long, two long, up_one long, up_two long, words long"


def _facts(turns: DataFrame) -> DataFrame:
    """A row for each conversation: ``taken`` turns (one, two, words) from its family's first instead of its own first ``own``, and sums of what it drops and has."""
    few = F.when(F.col("place") < SHARED - 1, F.struct("place", "one", "two", "words", "sum_one", "sum_two"))
    each = stored(
        turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(few)).alias("head"), F.max_by(F.struct("sum_one", "sum_two"), "place").alias("end")), "heads"
    )
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    crc = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    own = F.when(family == F.col("conv_id"), F.lit(0)).otherwise(crc).cast("int")
    first = each.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("family"), F.col("head").alias("first_head"))
    beside = each.select("*", own.alias("own"), F.when(own > 0, family).alias("family")).join(first, "family", "left")
    taken = F.coalesce(F.slice("first_head", F.lit(1), F.col("own")), F.slice("head", 1, 0))
    dropped = F.when(F.col("own") > 0, F.get("head", F.col("own") - 1))
    return beside.select("conv_id", "n", "own", taken.alias("taken"), *(F.coalesce(dropped[s], F.lit(0)).alias(f"dropped_{s[4:]}") for s in ("sum_one", "sum_two")), *(F.col("end")[s].alias(f"end_{s[4:]}") for s in ("sum_one", "sum_two")))


def _taken_paths(batches):
    """Paths of the turns taken over, from the root on; ``length`` of the whole conversation where the path ends, else NULL."""
    for batch in batches:
        taken = batch.column("taken")
        sizes = pc.list_value_length(taken).to_numpy()
        row = np.repeat(np.arange(len(batch)), sizes)
        ends = np.cumsum(sizes)
        place = np.arange(len(row)) - (ends - sizes)[row]
        flat = taken.flatten()
        sums, ups = [], []
        for side in ("one", "two"):
            values = _unsigned(flat.field(side)) * power(w.BASE, place)
            total = np.concatenate([[np.uint64(0)], np.cumsum(values)])
            begun = total[(ends - sizes)[row]]
            ups.append(total[:-1] - begun)
            sums.append(total[1:] - begun)
        conv, n, own = (_numbers(batch.column(c)) for c in ("conv_id", "n", "own"))
        # all but the first of a family drop their own first turns
        length = sizes + np.maximum(n - own, 0)
        whole, at_end = [], []
        for side, name in enumerate(("one", "two")):
            prefix = np.zeros(len(batch), np.uint64)
            prefix[sizes > 0] = sums[side][ends[sizes > 0] - 1]
            whole.append(prefix)
            rest = shifted(_unsigned(batch.column(f"end_{name}")) - _unsigned(batch.column(f"dropped_{name}")), sizes - own)
            at_end.append(np.where(n > own, prefix + rest, prefix))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("own"), pa.array(sizes.astype(np.int32)), pa.array(length), *(batch.column(f"dropped_{c}") for c in ("one", "two")), *map(_signed, whole), *map(_signed, at_end),
             pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.StructArray.from_arrays([pa.array(place + 1), *map(_signed, sums), *map(_signed, ups), flat.field("words")], ["depth", "one", "two", "up_one", "up_two", "words"]))],
            ["conv_id", "own", "taken", "length", "dropped_one", "dropped_two", "prefix_one", "prefix_two", "end_one", "end_two", "path"],
        )


def _own_paths(batches):
    for batch in batches:
        place, own, taken = (_numbers(batch.column(c)) for c in ("place", "own", "taken"))
        depth = place - own + taken + 1
        here, up = [], []
        for c in ("one", "two"):
            rest = _unsigned(batch.column(f"sum_{c}")) - _unsigned(batch.column(f"dropped_{c}"))
            here.append(_unsigned(batch.column(f"prefix_{c}")) + shifted(rest, taken - own))
            up.append(here[-1] - _unsigned(batch.column(c)) * power(w.BASE, depth - 1))
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(depth), *map(_signed, here), *map(_signed, up), batch.column("words")], [f.split()[0] for f in PATH.split(", ")])


def _rebuilt(turns: DataFrame) -> DataFrame:
    """A row for each conversation with what its own turns need (``own``, ``taken``, sums), its ``path`` over the turns taken over, ``length`` and the hashes at its end."""
    path = "path array<struct<depth: long, one: long, two: long, up_one: long, up_two: long, words: long>>"
    fields = ", ".join(f"{c} long" for c in ("length", "dropped_one", "dropped_two", "prefix_one", "prefix_two", "end_one", "end_two"))
    return stored(_facts(turns).mapInArrow(_taken_paths, f"conv_id long, own int, taken int, {fields}, {path}"), "rebuilt")


def _paths(turns: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """A row for each conversation and node on its way, the root included."""
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = rebuilt.select("conv_id", *(zero.alias(c) for c in NODE), none.alias("up_one"), none.alias("up_two"), zero.alias("words"))
    taken = rebuilt.select("conv_id", F.explode("path").alias("p")).select("conv_id", "p.*")
    own = turns.join(rebuilt.select("conv_id", "own", "taken", "dropped_one", "dropped_two", "prefix_one", "prefix_two"), "conv_id").where("place >= own")
    return roots.unionByName(taken).unionByName(own.mapInArrow(_own_paths, PATH))


def _joined_ids(batches):
    """Ids of a node's members in order, joined to pieces of some thousand bytes."""
    key, ids, size = None, [], 0
    rows: list[tuple] = []

    def flushed():
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], [*NODE, "first", "text"])

    def close():
        if ids:
            rows.append((*key, ids[0], ",".join(map(str, ids))))

    for batch in batches:
        for *node, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id")), strict=True):
            if node != key or size > PIECE:
                close()
                key, ids, size = node, [], 0
            ids.append(conv)
            size += len(str(conv)) + 1
        if len(rows) > 1000:
            yield flushed()
            rows = []
    close()
    if rows:
        yield flushed()


def _digests(batches):
    """SHA-256 of each node's pieces, which come in order."""
    key, digest = None, None
    for batch in batches:
        done = []
        for *node, text in zip(*(batch.column(c).to_pylist() for c in (*NODE, "text")), strict=True):
            if node != key:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = node, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], [*NODE, "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*key, digest.hexdigest())], [*NODE, "ends_sha256"])


def _ends(rebuilt: DataFrame) -> DataFrame:
    """By node, the digest of the ids of the conversations that end there."""
    ends = rebuilt.select(F.col("length").alias("depth"), F.col("end_one").alias("one"), F.col("end_two").alias("two"), "conv_id")
    pieces = in_order(ends, [*NODE, "conv_id"], _joined_ids, "depth long, one long, two long, first long, text string", "ends")
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(_digests, "depth long, one long, two long, ends_sha256 string")


LINKS = "part int, seq long, child boolean, conv long, depth long, saved long, parent long, then_child boolean, then_conv long"


def _link(batches):
    """Each row of the order with its parent and the row behind it, as far as the part tells. The summary has the part's first row and its last parent."""
    seq, parent, held, first = 0, None, None, None
    for batch in batches:
        if not len(batch):
            continue
        rows = pa.Table.from_batches([batch.select(["part", "child", "conv", "depth", "saved"])])
        rows = pa.concat_tables([held, rows]) if held is not None else rows
        first = rows.slice(0, 1) if first is None else first
        child, conv = (_numbers(rows.column(c).combine_chunks()) for c in ("child", "conv"))
        at = np.maximum.accumulate(np.where(child, -1, np.arange(len(rows))))
        known = at >= 0
        parents = np.where(known, conv[np.maximum(at, 0)], 0 if parent is None else parent)
        unknown = ~known if parent is None else np.zeros(len(rows), bool)
        held = rows.slice(len(rows) - 1)
        done = len(rows) - 1
        if done:
            yield _linked(rows.slice(0, done), seq, parents[:done], unknown[:done], pa.array(child[1:]), pa.array(conv[1:]))
        seq += done
        # the held row comes again; its parent must not be lost
        before = parents[:done][-1:] if done else []
        if len(before) and not unknown[done - 1]:
            parent = int(before[0])
    if held is not None:
        child, conv = held.column("child")[0].as_py(), held.column("conv")[0].as_py()
        own = conv if not child else parent
        nothing = pa.array([None], pa.bool_()), pa.array([None], pa.int64())
        yield _linked(held, seq, np.array([own or 0]), np.array([own is None]), *nothing)
        yield _linked(first, -1, np.array([own or 0]), np.array([own is None]), *nothing)


def _linked(rows: pa.Table, seq: int, parents, unknown, then_child, then_conv) -> pa.RecordBatch:
    rows = rows.combine_chunks()
    columns = [rows.column(c).combine_chunks() for c in ("part", "child", "conv", "depth", "saved")]
    return pa.RecordBatch.from_arrays([columns[0], pa.array(np.arange(seq, seq + len(rows))), *columns[1:], pa.array(parents, pa.int64(), mask=unknown), then_child, then_conv], [f.split()[0] for f in LINKS.split(", ")])


def _tour(nodes: DataFrame) -> DataFrame:
    """The arcs of the Euler tour: key, following key, weights, and for exit arcs the parent."""
    saved = (F.col("n_convs") - 1) * F.col("words")
    as_parent = nodes.select(*NODE, F.lit(False).alias("child"), F.col("conv_id").alias("conv"), saved.alias("saved"))
    as_child = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("up_one").alias("one"), F.col("up_two").alias("two"), F.lit(True).alias("child"), F.col("conv_id").alias("conv"), F.lit(0).cast("long").alias("saved"))
    parts = in_order(as_parent.unionByName(as_child), [*NODE, "child", "conv"], _link, LINKS, "links")

    going, behind, parent = {}, {}, None
    rows = summaries(parts)
    for row, then in zip(rows, [*rows[1:], None], strict=False):
        going[row.part] = parent
        behind[row.part] = (then.child, then.conv) if then else (False, None)
        parent = parent if row.parent is None else row.parent
    spark = nodes.sparkSession
    table = spark.createDataFrame([(p, going[p], *behind[p]) for p in going], "part int, going long, behind_child boolean, behind_conv long")
    # a row for each part
    known = parts.where("seq >= 0").join(F.broadcast(table), "part")
    c = F.col
    known = known.select(
        "child", "conv", "depth", "saved", F.coalesce("parent", "going").alias("parent"),
        F.when(c("then_child").isNull(), c("behind_child")).otherwise(c("then_child")).alias("then_child"), F.when(c("then_child").isNull(), c("behind_conv")).otherwise(c("then_conv")).alias("then_conv"),
    )
    enter, leave = c("depth") * 2, c("depth") * 2 + 1
    below = (c("depth") + 1) * 2
    one, zero, none = (F.lit(x).cast("long") for x in (1, 0, None))
    entered = known.where("not child").select(
        "conv", enter.alias("step"), F.when(c("then_child"), c("then_conv")).otherwise(c("conv")).alias("to_conv"), F.when(c("then_child"), below).otherwise(leave).alias("to_step"),
        one.alias("n"), F.when(c("then_child"), zero).otherwise(one).alias("leaves"), "saved", none.alias("parent"),
    )
    # a child's depth in the order is its parent's
    left = known.where("child").select(
        "conv", (below + 1).alias("step"), F.when(c("then_child"), c("then_conv")).otherwise(c("parent")).alias("to_conv"), F.when(c("then_child"), below).otherwise(leave).alias("to_step"),
        one.alias("n"), zero.alias("leaves"), zero.alias("saved"), "parent",
    )
    end = nodes.where("depth = 0").select(F.col("conv_id").alias("conv"), one.alias("step"), none.alias("to_conv"), none.alias("to_step"), one.alias("n"), zero.alias("leaves"), zero.alias("saved"), none.alias("parent"))
    return entered.unionByName(left).unionByName(end)


def prefix_trie(conversations: DataFrame, chunk: int = list_rank.CHUNK, base: int = list_rank.BASE) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations.

    ``conversations`` has ``conv_id``, ``turn``, ``role``, ``text``; other columns are ignored. Conversation c is the first h turns of c - c % 20 and then its own after
    its first h, h = crc32(decimal c) % 4. Per node: ``conv_id`` (least member), ``depth``, ``parent_conv_id`` (NULL for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``, and its place on the tour, ``entered`` and ``left``.

    NULL roles and texts are empty; a NULL turn comes first; turns of one number follow each other by a hash of role and text, and rows alike in all columns are turns of
    their own. Rows without conv_id belong to no conversation. No conversations give no nodes.
    """
    turns = turns_in_order(conversations)
    rebuilt = _rebuilt(turns)
    zero, none, no_text = F.lit(0).cast("long"), F.lit(None).cast("long"), F.lit(None).cast("string")
    members = _paths(turns, rebuilt).withColumns({"n_convs": F.lit(1).cast("long"), "ends_sha256": no_text})
    ends = _ends(rebuilt).select(none.alias("conv_id"), *NODE, none.alias("up_one"), none.alias("up_two"), zero.alias("words"), zero.alias("n_convs"), "ends_sha256")
    nodes = members.unionByName(ends).groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), *(F.max(c).alias(c) for c in ("up_one", "up_two", "words", "ends_sha256")))
    nodes = stored(nodes, "nodes")
    ranks = stored(list_rank.ranked(_tour(nodes), chunk, base), "ranks")

    depth, exits = F.shiftright("step", 1), F.col("step") % 2 == 1

    def signed(column: str) -> Column:
        return F.when(exits, F.col(column)).otherwise(-F.col(column))

    own = ranks.select(F.col("conv").alias("conv_id"), depth.alias("depth"), F.col("parent").alias("parent_conv_id"), signed("leaves_before").alias("n_leaves"), signed("saved_before").alias("saved_tokens"), "n_before")
    below = ranks.where(exits & (depth > 0)).select(F.col("parent").alias("conv_id"), (depth - 1).alias("depth"), F.lit(1).cast("long").alias("n_children"))
    facts = nodes.select("conv_id", "depth", "n_convs", "ends_sha256")
    every = own.unionByName(below, allowMissingColumns=True).unionByName(facts, allowMissingColumns=True)
    return every.groupBy("conv_id", "depth").agg(
        F.max("parent_conv_id").alias("parent_conv_id"), F.max("n_convs").alias("n_convs"), F.coalesce(F.sum("n_children"), F.lit(0)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.coalesce(F.max("ends_sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), F.min("n_before").alias("entered"), F.max("n_before").alias("left"),
    )
