"""Near-duplicate vectors by cross-polytope hashing.

1. A rotation is three times random signs and a fast Hadamard transform. A vector's hash is the axis, with its sign, that it lies nearest to; a key joins the hashes of
   ``width`` rotations. In each table a vector has its own key and ``probes - 1`` more, those of the next nearest axes. Two vectors meet where the
   own key of one is any key of the other.
2. In each bucket 256 sign bits tell which pairs can be links at all. Only vectors with such a pair are fetched.
3. Their cosines decide. A link is counted in the first bucket that finds it, so every link counts once though no pair leaves its task: a task
   returns for each vector its number of links and the least vector that it hangs together with.

Equal vectors are one from the start, with their number. A bucket too large for a task is cut into blocks, and every two blocks meet.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxsieve.llm import words as w
from rxsieve.llm.components import components
from rxsieve.llm.store import stored

COSINE = 0.9
#: Chance to miss a pair at exactly the least cosine; the number of tables follows from it.
MISS = 0.005
#: Vectors for each own key at most, on average; the number of rotations of a key follows from it.
IN_BUCKET = 8
#: Members of a bucket that a task compares, and numbers in their vectors.
BUCKET, NUMBERS = 2000, 1 << 21
#: Pairs that are compared at once.
PAIRS = 1 << 18
ROUNDS = 3
SEED = 12
#: Numbers that are rotated at once.
ROTATED = 1 << 20
#: Sign bits of a linked pair differ with the chance of their angle; five standard deviations more are let through.
SKETCH = 256
_CHANCE = math.acos(COSINE) / math.pi
MOST_BITS = math.ceil(SKETCH * _CHANCE + 5 * math.sqrt(SKETCH * _CHANCE * (1 - _CHANCE)))


def padded(length: int) -> int:
    return 1 << max(1, (length - 1).bit_length())


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of each row, whose length is a power of two; it keeps all angles."""
    n, size = rows.shape
    half = 1
    while half < size:
        pairs = rows.reshape(n, size // (2 * half), 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, size)
        half *= 2
    return rows


def rotated(rows: np.ndarray, number: int) -> np.ndarray:
    draw = np.random.default_rng([SEED, number, rows.shape[1]])
    for signs in draw.integers(0, 2, (ROUNDS, rows.shape[1])) * 2.0 - 1:
        rows = hadamard(rows * signs) / math.sqrt(rows.shape[1])
    return rows


def table_keys(rows: np.ndarray, table: int, width: int, probes: int) -> np.ndarray:
    """The keys of each row, its own first, then those of the nearest other axes; they differ within a row."""
    count, size = rows.shape
    best, codes = np.zeros((count, 1)), np.zeros((count, 1), np.uint64)
    for k in range(width):
        turned = rotated(rows, 1 + table * width + k)
        both = np.concatenate([turned, -turned], 1)
        taken = min(probes, 2 * size)
        axes = np.argpartition(-both, taken - 1, 1)[:, :taken] if taken < 2 * size else np.tile(np.arange(2 * size), (count, 1))
        far = np.take_along_axis(both, axes, 1)
        cost = ((far.max(1, keepdims=True) - far) ** 2)[:, None, :] + best[:, :, None]
        code = w.mixed(codes * w.BASE + np.uint64(table + 1))[:, :, None] + axes.astype(np.uint64)[:, None, :]
        cost, code = cost.reshape(count, -1), code.reshape(count, -1)
        order = np.argsort(cost, 1, kind="stable")[:, :probes]
        best, codes = np.take_along_axis(cost, order, 1), np.take_along_axis(code, order, 1)
    return w.mixed(codes + np.uint64(size))


def sketches(rows: np.ndarray) -> np.ndarray:
    """Sign bits of each row, as numbers of 64 bits."""
    turns = math.ceil(SKETCH / rows.shape[1])
    bits = np.concatenate([rotated(rows, -k % (1 << 32)) for k in range(turns)], 1)[:, :SKETCH] > 0
    return np.packbits(bits, 1).view(np.uint64)


def layout(count: int, length: int) -> tuple[int, int, int]:
    """Rotations of a key, keys of a vector in a table, and tables, for ``count`` vectors.

    The tables are as many as miss a pair at the least cosine with a chance of ``MISS``, by how often seeded random pairs of this length meet in one.
    """
    size = padded(length)
    width = max(1, math.ceil(math.log(max(1, count / IN_BUCKET)) / math.log(2 * size)))
    probes = 2 ** (width + 1)
    draw = np.random.default_rng(SEED)
    pairs = max(64, min(2000, (1 << 21) // size))
    one, other = draw.normal(size=(2, pairs, size))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other -= (one * other).sum(1, keepdims=True) * one
    other = COSINE * one + math.sqrt(1 - COSINE**2) * other / np.linalg.norm(other, axis=1, keepdims=True)
    met = [_meet(table_keys(one, t, width, probes), table_keys(other, t, width, probes)).mean() for t in range(2)]
    rate = min(0.999, max(0.02, float(np.mean(met)) - 0.02))
    return width, probes, math.ceil(math.log(MISS) / math.log(1 - rate))


def _meet(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return (one[:, :1] == other).any(1) | (other[:, :1] == one).any(1)


def _vectors(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length of the vectors, their rows and their numbers."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat, ends = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(sizes)
    found = []
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        found.append((rows, flat[(ends[rows] - size)[:, None] + np.arange(size)]))
    return found


def _units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled first, so that no square is infinite or vanishes."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _lists(rows: np.ndarray) -> pa.Array:
    ends = pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(rows.ravel().view(np.int64)))


def _wide(column, width: int) -> np.ndarray:
    return column.flatten().to_numpy().view(np.uint64).reshape(-1, width)


def _hash(width: int, probes: int, tables: int):
    def hashed(batches):
        for whole in batches:
            for at in range(0, len(whole), 1024):
                batch = whole.slice(at, 1024)
                keys, bits = np.zeros((len(batch), tables * probes), np.uint64), np.zeros((len(batch), SKETCH // 64), np.uint64)
                for rows, vectors in _vectors(batch.column("vector")):
                    size = padded(vectors.shape[1])
                    for some in np.array_split(np.arange(len(rows)), max(1, len(rows) * size // ROTATED)):
                        units = np.zeros((len(some), size))
                        units[:, : vectors.shape[1]] = _units(vectors[some])
                        bits[rows[some]] = sketches(units)
                        for t in range(tables):
                            own = table_keys(units, t, width, probes)
                            # fewer axes than probes: the own key stands for the missing ones
                            keys[rows[some], t * probes : (t + 1) * probes] = np.concatenate([own, np.repeat(own[:, :1], probes - own.shape[1], 1)], 1)
                yield pa.RecordBatch.from_arrays([batch.column("id"), _lists(bits), _lists(keys)], ["id", "sketch", "keys"])

    return hashed


CELL = ("key", "low", "high")


def _cells(batches):
    """Tables of whole cells, which come in order, and where each cell begins."""
    held, size = [], 0

    def begins(table):
        key = np.stack([table.column(c).combine_chunks().to_numpy() for c in CELL], 1)
        return np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(1)))

    for batch in batches:
        if not len(batch):
            continue
        held.append(pa.Table.from_batches([batch]))
        size += len(batch)
        if size >= 4 * BUCKET:
            table = pa.concat_tables(held).combine_chunks()
            starts = begins(table)
            if starts[-1]:
                yield table.slice(0, starts[-1]).combine_chunks(), starts[:-1]
            held, size = [table.slice(starts[-1])], len(table) - starts[-1]
    if size:
        table = pa.concat_tables(held).combine_chunks()
        yield table, begins(table)


def _pairs(table: pa.Table, starts: np.ndarray):
    """Pairs of a row with its own key and any other row of its cell, from different blocks if the cell has two."""
    own, block, low, high = (table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("own", "block", "low", "high"))
    sizes = np.diff(np.append(starts, len(table)))
    cell = np.repeat(np.arange(len(starts)), sizes)
    rows = np.flatnonzero(own)
    counts = sizes[cell[rows]]
    for some in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(np.cumsum(counts) // PAIRS)) + 1):
        count = counts[some]
        one = np.repeat(rows[some], count)
        other = starts[cell[one]] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        met = (one != other) & ((low[one] == high[one]) | (block[one] != block[other]))
        yield one[met], other[met]


def _likely(batches):
    """Of each cell, the rows that have a pair within ``MOST_BITS``."""
    names = ["id", "own", "block", "table", *CELL]
    for table, starts in _cells(batches):
        bits = _wide(table.column("sketch").combine_chunks(), SKETCH // 64)
        found = np.zeros(len(table), bool)
        for one, other in _pairs(table, starts):
            near = np.bitwise_count(bits[one] ^ bits[other]).sum(1) <= MOST_BITS
            found[one[near]] = found[other[near]] = True
        if found.any():
            yield from table.select(names).filter(pa.array(found)).combine_chunks().to_batches()


def _first(one: np.ndarray, other: np.ndarray, table: int, key: np.ndarray, probes: int) -> np.ndarray:
    """Whether each pair, given by the keys of its two vectors, meets in this bucket and in none before."""
    now = np.ones(len(one), bool)
    for t in range(table):
        at = slice(t * probes, (t + 1) * probes)
        left = np.flatnonzero(now)
        now[left] = ~_meet(one[left, at], other[left, at])
    at = slice(table * probes, (table + 1) * probes)
    one, other = one[:, at], other[:, at]
    most = np.uint64((1 << 64) - 1)
    least = np.minimum(np.where((one[:, :1] == other).any(1), one[:, 0], most), np.where((other[:, :1] == one).any(1), other[:, 0], most))
    return now & (least == key)


def _verify(probes: int):
    def verified(batches):
        for table, starts in _cells(batches):
            ids, copies, key, number = (table.column(c).combine_chunks().to_numpy() for c in ("id", "copies", "key", "table"))
            keys = table.column("keys").combine_chunks()
            keys = keys.flatten().to_numpy().view(np.uint64).reshape(len(ids), -1)
            sizes = np.zeros(len(ids), np.int64)
            lengths = _vectors(table.column("vector").combine_chunks())
            units = np.zeros((len(ids), max(v.shape[1] for _, v in lengths)))
            for rows, vectors in lengths:
                units[rows, : vectors.shape[1]] = _units(vectors)
                sizes[rows] = vectors.shape[1]
            links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
            pairs = [np.zeros(0, np.int64)]
            for one, other in _pairs(table, starts):
                for a, b in zip(np.array_split(one, step := 1 + one.size * units.shape[1] // NUMBERS), np.array_split(other, step), strict=True):
                    near = np.flatnonzero(((units[a] * units[b]).sum(1) >= COSINE) & (sizes[a] == sizes[b]))
                    pairs.append(np.minimum(a, b)[near] * len(ids) + np.maximum(a, b)[near])
            # two rows with own keys meet both ways
            pairs = np.unique(np.concatenate(pairs))
            for some in np.array_split(pairs, 1 + len(pairs) // PAIRS):
                a, b = np.divmod(some, len(ids))
                new = np.zeros(len(some), bool)
                for t in np.unique(number[a]):
                    at = np.flatnonzero(number[a] == t)
                    new[at] = _first(keys[a[at]], keys[b[at]], t, key[a[at]].view(np.uint64), probes)
                a, b = a[new], b[new]
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                root = _joined(root, a, b)
            kept = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(ids[kept]), pa.array(ids[root[kept]]), pa.array(links[kept])], ["a", "b", "links"])

    return verified


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row that each row hangs together with, after the links a, b are added."""
    while True:
        low = np.minimum(root[a], root[b])
        if (root[a] == low).all() and (root[b] == low).all():
            return root
        root = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]


def _valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _dealt(rows: DataFrame, bucket: int) -> DataFrame:
    """The rows ``key``, ``id`` and others by cell: a bucket of at most ``bucket`` rows is one, a larger one is cut into blocks that meet two by two."""
    large = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > bucket).select("key", F.ceil(F.col("n") * 2 / bucket).cast("int").alias("blocks"))
    cut = rows.join(large, "key", "left").withColumn("block", F.coalesce(F.pmod(F.xxhash64("id"), "blocks"), F.lit(0)).cast("int"))
    met = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    met = cut.withColumn("met", met)
    return met.withColumns({"low": F.least("block", "met"), "high": F.greatest("block", "met")}).drop("met", "blocks")


def _by_cell(rows: DataFrame) -> DataFrame:
    return rows.repartition(*CELL).sortWithinPartitions(*CELL)


def near_vectors(vectors: DataFrame, column: str = "embedding", bucket: int = BUCKET) -> DataFrame:
    """Per row ``vec_id``, ``n_links`` (other vectors linked directly), ``component_id`` (least vec_id reachable), ``kept``.

    A link joins vectors with a cosine of 0.9 or more in double precision, scaled copies among them. Vectors that are NULL, empty or zero or hold NULL or
    numbers that are not finite are linked with nothing, and so are vectors of different lengths with each other. Every row is a vector of its own, also one that repeats
    another or its id; a row without vec_id is linked like all others and names no component: among such rows alone it is NULL, and they are kept.
    Other columns are ignored; no rows give no rows.
    """
    numbers = F.col("vector").cast("array<double>")
    same = ["hash_one", "hash_two"]
    named = vectors.select("vec_id", F.col(column).alias("vector"))
    named = named.withColumns({h: F.when(_valid(numbers), F.xxhash64(F.lit(k), numbers)) for k, h in enumerate(same)})
    single = named.where("hash_one is not null").groupBy(*same).agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.any_value("vector").alias("vector"))
    single = stored(single.withColumn("id", F.monotonically_increasing_id()), "vectors")

    facts = single.agg(F.count("*"), F.max(F.size("vector"))).first()
    length = facts[1] or 1
    width, probes, tables = layout(facts[0], length)
    bucket = max(2, min(bucket, NUMBERS // padded(length)))
    hashed = stored(single.mapInArrow(_hash(width, probes, tables), "id long, sketch array<long>, keys array<long>"), "keys")
    own = F.col("place") % probes == 0
    own_key = F.get("keys", F.col("place") - F.col("place") % probes)
    members = hashed.select("id", "sketch", "keys", F.posexplode("keys").alias("place", "key")).where(own | (F.col("key") != own_key))
    members = members.select("key", "id", "sketch", own.alias("own"), F.floor(F.col("place") / probes).cast("int").alias("table"))
    schema = "id long, own boolean, block int, table int, key long, low int, high int"
    likely = stored(_by_cell(_dealt(members, bucket)).mapInArrow(_likely, schema), "likely")
    ready = likely.join(single.select("id", "copies", "vector"), "id").join(hashed.select("id", "keys"), "id")
    links = stored(_by_cell(ready).mapInArrow(_verify(probes), "a long, b long, links long"), "links")

    of_vector = links.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    whole = single.join(of_vector, "id", "left").join(components(links), "id", "left").select(*same, "least", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "id").alias("component"))
    whole = stored(whole, "classes")
    least = whole.groupBy("component").agg(F.min("least").alias("component_id"))
    of_copy = whole.join(least, "component").select(*same, (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    found = named.select("vec_id", *same).join(of_copy, same, "left")
    alone = F.col("hash_one").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    return found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (component.isNull() | F.coalesce(F.col("vec_id") == component, F.lit(False))).alias("kept"))
