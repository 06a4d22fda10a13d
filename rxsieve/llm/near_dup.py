"""Near-duplicate documents by MinHash bands and odd sketches.

Each text becomes the set of its 5-word shingles and 96 MinHash samples. 32 bands of three samples find
candidates: a pair at similarity 0.75 shares no band with a probability of (1 - 0.75**3)**32 = 2e-8.
The samples are folded into a parity bitmap, the odd sketch, in which every sample flips one bit. The ones
in the XOR of two sketches tell how many samples differ, and pairs far below the threshold are dropped there.
Whatever remains is decided on the full sets.

A group of m near copies has m * m / 2 pairs, so the pairs are looked at in two passes:

1. In each bucket of a band, everyone against the least member. That is linear, and links most of a group.
2. Only buckets whose members are still in several components go on, and there only pairs across components.
   A bucket too large for one task is cut into blocks, those of its largest component and those of the rest: every block
   of the rest meets every block in a task of its own. A pair is looked at in the first band it shares.

Equal sets count once from the start, as the least document that has them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rxsieve.llm import words as w
from rxsieve.llm.components import components
from rxsieve.llm.store import drop_stored, stored

WORDS = 5
PERCENT = 75
BANDS, ROWS = 32, 3
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
#: Sketches that put the similarity below this are dropped: five standard errors of 96 samples below 0.75.
LEAST_ESTIMATE = 0.5
MOST_ONES = int(SKETCH_BITS / 2 * (1 - np.exp(-4 * SAMPLES * (1 - LEAST_ESTIMATE) / SKETCH_BITS)))
#: Members of a bucket that one task compares: a whole bucket, or two blocks of about half of it.
BUCKET = 2000
#: And their shingles in all, 64 MB of hashes, beyond which it is cut likewise.
SHINGLES = 8 << 20
_MULTIPLIERS = w.mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64)) | np.uint64(1)


def _shingles(data: np.ndarray, offsets: np.ndarray):
    """Distinct shingles of each text, sorted; a text of fewer words is one shingle, one without words has none."""
    hashes, before = w.word_hashes(data, offsets, w.SPACED)
    sums = w.prefix_sums(hashes)
    at = np.arange(max(0, len(hashes) - WORDS + 1))
    rolling = w.slice_hashes(sums, at, at + WORDS)
    for first, end in zip(before[:-1], before[1:], strict=True):
        if end - first >= WORDS:
            yield np.unique(rolling[first : end - WORDS + 1])
        else:
            yield w.slice_hashes(sums, np.array([first]), np.array([end])) if end > first else hashes[:0]


def _ids(values) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _signatures(batches):
    position = np.arange(SAMPLES, dtype=np.uint64)
    for batch, data, offsets in w.chunks(batches):
        others = [c for c in batch.schema.names if c != "text"]
        sets = list(_shingles(data, offsets))
        samples = np.zeros((len(sets), SAMPLES), np.uint64)
        for row, shingles in enumerate(sets):
            if len(shingles):
                samples[row] = (shingles[:, None] * _MULTIPLIERS).min(0)
        bits = (w.mixed(samples + position) % np.uint64(SKETCH_BITS)).astype(np.int64) + SKETCH_BITS * np.arange(len(sets))[:, None]
        ones = np.bincount(bits.ravel(), minlength=SKETCH_BITS * len(sets)) & 1
        sketch = np.packbits(ones.astype(np.uint8)).view(np.int64)
        groups = samples.reshape(len(sets), BANDS, ROWS)
        bands = np.arange(BANDS, dtype=np.uint64)
        for k in range(ROWS):
            bands = w.mixed(bands * w.BASE + groups[:, :, k])
        one = np.array([x.sum(dtype=np.uint64) for x in sets], np.uint64)
        two = np.array([w.mixed(x).sum(dtype=np.uint64) for x in sets], np.uint64)
        count = len(sets)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in others), pa.array([len(x) for x in sets], pa.int64()), _ids(one), _ids(two),
             pa.ListArray.from_arrays(pa.array(np.arange(count + 1) * BANDS, pa.int32()), _ids(bands.reshape(count * BANDS))),
             pa.ListArray.from_arrays(pa.array(np.arange(count + 1) * (SKETCH_BITS // 64), pa.int32()), pa.array(sketch))],
            [*others, "n_shingles", "sum_one", "sum_two", "bands", "sketch"],
        )


def _full_sets(batches):
    for batch, data, offsets in w.chunks(batches):
        sets = list(_shingles(data, offsets))
        ends = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _ids(np.concatenate(sets)))], ["id", "shingles"])


def _linked(shared, size, other):
    return 100 * shared >= PERCENT * (size + other - shared)


def _links_in_bucket(table: pa.Table) -> pa.Table:
    """One link for each member and other component that it is linked with, over the pairs whose first shared band is this bucket's.

    Of two blocks, only pairs across them are looked at; each block of the rest has a task of its own as well.
    """
    ids, labels, blocks = (table.column(c).to_numpy() for c in ("id", "label", "block"))
    band, low, high = (table.column(c)[0].as_py() for c in ("band", "low", "high"))
    width = lambda name, n: table.column(name).combine_chunks().flatten().to_numpy().reshape(-1, n)
    bands, sketches = width("bands", BANDS), width("sketch", SKETCH_BITS // 64).view(np.uint64)
    shingles = table.column("shingles").combine_chunks()
    flat, ends = shingles.flatten().to_numpy(), np.concatenate([[0], np.cumsum(shingles.value_lengths().to_numpy())])
    sizes = np.diff(ends)
    found: list[tuple[int, int]] = []
    values, counts = np.unique(labels, return_counts=True)
    # pairs within the largest component need no look
    for x in np.flatnonzero(labels != values[counts.argmax()] if low == high else blocks == low):
        others = np.flatnonzero((labels != labels[x]) & (blocks == high) & (100 * np.minimum(sizes, sizes[x]) >= PERCENT * np.maximum(sizes, sizes[x])))
        same = bands[others] == bands[x]
        others = others[same[:, band] & ~same[:, :band].any(1)]
        ones = np.bitwise_count(sketches[others] ^ sketches[x]).sum(1)
        others = others[np.argsort(ones, kind="stable")[: np.count_nonzero(ones <= MOST_ONES)]]
        own = flat[ends[x] : ends[x + 1]]
        reached = set()
        for y in others:
            if labels[y] in reached:
                continue
            if _linked(len(np.intersect1d(own, flat[ends[y] : ends[y + 1]], True)), sizes[x], sizes[y]):
                reached.add(labels[y])
                found.append((ids[x], ids[y]))
    a, b = np.array(found, np.int64).reshape(-1, 2).T
    return pa.table({"a": a, "b": b})


def _as(frame: DataFrame, side: str) -> DataFrame:
    """``id`` under the name of one side of a pair, the other columns with that suffix."""
    return frame.select(F.col("id").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in frame.columns if c != "id"))


def _first_links(bucketed: DataFrame, single: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of the members of each bucket with its least member."""
    ones = sum((F.bit_count(F.col("sketch_a")[k].bitwiseXOR(F.col("sketch_b")[k])) for k in range(SKETCH_BITS // 64)), F.lit(0))
    sketches = single.select("id", "sketch")
    pairs = bucketed.where("id != least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    likely = pairs.join(_as(sketches, "b"), "b").join(_as(sketches, "a"), "a").where(ones <= MOST_ONES).select("a", "b")
    both = likely.join(_as(sets, "b"), "b").join(_as(sets, "a"), "a")
    shared = F.size(F.array_intersect("shingles_a", "shingles_b"))
    return both.where(_linked(shared, F.size("shingles_a"), F.size("shingles_b"))).select("a", "b")


def _unresolved(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with the bucket's members and shingles."""
    counts = members.groupBy("key").agg(F.count("*").alias("members"), F.sum("size").alias("shingles"), F.min("label").alias("low"), F.max("label").alias("high"))
    return members.join(counts.where("low != high").select("key", "members", "shingles"), "key")


def _cells(members: DataFrame, bucket: int, shingles: int = SHINGLES) -> DataFrame:
    """The members of each bucket by the pairs of blocks, ``low`` and ``high``, that a task compares; a bucket of at most ``bucket`` members with ``shingles`` in all is one block.

    The blocks of the rest come first and those of the largest component, which need not meet each other, after them.
    """
    tasks = lambda n, size: F.greatest(n / bucket, size / shingles)
    load = tasks(F.col("members"), F.col("shingles"))
    small = members.where(load <= 1).select("key", "id", "band", "label", F.lit(0).alias("block"), F.lit(1).alias("rest"), F.lit(1).alias("blocks"))
    large = members.where(load > 1)
    of_label = large.groupBy("key", "label", "members", "shingles").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    main = of_label.groupBy("key", "members", "shingles").agg(F.max(F.struct("n", "size", "label")).alias("main"))
    count = lambda n, size: F.ceil(2 * tasks(n, size)).cast("int")
    rest = F.greatest(F.lit(1), count(F.col("members") - F.col("main.n"), F.col("shingles") - F.col("main.size")))
    main = main.select("key", F.col("main.label").alias("main"), rest.alias("rest"), (rest + F.greatest(F.lit(1), count(F.col("main.n"), F.col("main.size")))).alias("blocks"))
    salt = F.xxhash64("id")
    block = F.when(F.col("label") == F.col("main"), F.col("rest") + F.pmod(salt, F.col("blocks") - F.col("rest"))).otherwise(F.pmod(salt, F.col("rest")))
    cut = large.join(main, "key").select("key", "id", "band", "label", block.cast("int").alias("block"), "rest", "blocks")
    met = F.explode(F.sequence(F.lit(0), F.when(F.col("block") < F.col("rest"), F.col("blocks")).otherwise(F.col("rest")) - 1)).alias("met")
    cells = small.unionByName(cut).select("key", "id", "band", "label", "block", met)
    return cells.select("key", "id", "band", "label", "block", F.least("block", "met").alias("low"), F.greatest("block", "met").alias("high"))


def _further_links(bucketed: DataFrame, named: DataFrame, single: DataFrame, sets: DataFrame, bucket: int) -> DataFrame:
    """Links across the components found so far, over every bucket that holds several."""
    labelled = bucketed.select("key", "id", "band", "size").join(named, "id", "left").select("key", "id", "band", "size", F.coalesce("component", "id").alias("label"))
    todo = stored(_unresolved(labelled), "unresolved")
    ready = _cells(todo, bucket).join(single.select("id", "bands", "sketch"), "id").join(sets, "id")
    return stored(ready.groupBy("key", "low", "high").applyInArrow(_links_in_bucket, "a long, b long"), "links")


def _components_of_rows(docs: DataFrame, bucket: int) -> DataFrame:
    """``docs`` (doc_id, text, and what else is carried along) with ``n_shingles`` and ``component_id`` instead of the text; no shingles, no component."""
    others = [c for c in docs.columns if c != "text"]
    carried = ", ".join(f"{c} {t}" for c, t in docs.dtypes if c != "text")
    signed = stored(docs.mapInArrow(_signatures, f"{carried}, n_shingles long, sum_one long, sum_two long, bands array<long>, sketch array<long>"), "signatures")
    same = ["n_shingles", "sum_one", "sum_two"]
    least = F.min(F.struct("doc_id", "bands", "sketch")).alias("least")
    single = signed.where("n_shingles > 0 and doc_id is not null").groupBy(*same).agg(least)
    single = stored(single.select(F.col("least.doc_id").alias("id"), *same, "least.bands", "least.sketch"), "sets")
    banded = single.select("id", F.col("n_shingles").cast("int").alias("size"), F.posexplode("bands").alias("band", "key"))
    sizes = banded.groupBy("key").agg(F.count("*").alias("members"), F.min("id").alias("least"))
    bucketed = stored(banded.join(sizes.where("members > 1").drop("members"), "key"), "buckets")

    candidates = docs.join(bucketed.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi").withColumnRenamed("doc_id", "id")
    sets = stored(candidates.mapInArrow(_full_sets, "id long, shingles array<long>"), "shingles")
    links = stored(_first_links(bucketed, single, sets), "links")
    named = components(links)
    links = links.unionByName(_further_links(bucketed, named, single, sets, bucket))
    named = components(links)
    drop_stored(sets)
    drop_stored(bucketed)

    members = single.select(*same, "id").join(named, "id", "left").select(*same, F.coalesce("component", "id").alias("component_id"))
    return signed.select(*others, *same).join(members, same, "left").select(*others, "n_shingles", "component_id")


def near_duplicates(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Per row ``doc_id``, ``n_shingles``, ``component_id`` (least document reachable by links), ``kept``.

    A link joins documents whose shingle sets have a Jaccard similarity of 0.75 or more. NULL and empty
    texts have no shingles and are linked with nothing. Rows that repeat a doc_id are one document, linked as
    any of its texts is. A row without doc_id gets the component of its set, and names none: if no
    other row has its set, its component is NULL and it is kept. Other columns are ignored; no rows give no rows.
    """
    of_set = _components_of_rows(docs.select("doc_id", "text"), bucket)
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return of_set.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("component_id").isNull() | F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)) | (F.col("n_shingles") == 0))


def without_copies(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """One row of each group of near copies among the rows of ``docs``, whatever their columns: the least by doc_id, those without one last.

    Unlike above, every row is a document under 64 bits of hash of its doc_id and text, so rows without doc_id are linked like all others and texts
    of a repeated doc_id are told apart. Rows alike in doc_id and text are one document, also without words.
    """
    id_ = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.coalesce("text", F.lit(""))).alias("id")
    named = docs.select(id_.alias("doc_id"), F.col("doc_id").alias("origin"), "text")
    named = named.where("origin is not null").unionByName(named.where("origin is null").dropDuplicates(["doc_id"]))
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id")).alias("alone")
    least = F.min(F.struct(F.col("origin").isNull().alias("last"), "origin", "doc_id")).alias("least")
    kept = _components_of_rows(named, bucket).groupBy(alone, "component_id").agg(least).select(F.col("least.doc_id").alias("id"))
    number = F.row_number().over(Window.partitionBy("id").orderBy("id"))
    rows = docs.select(F.struct("*").alias("row"), id_)
    return rows.join(kept, "id", "left_semi").withColumn("number", number).where("number = 1").select("row.*")
