"""Fingerprints by spot signatures, in SQL expressions only.

A spot is a common word; its signature is a hash of the word and the chain of the next ``CHAIN`` content words, that is words that are
not common. Text that is only prose has a spot in every few words. So that lists and tables have some too, words
whose own hash falls into one of ``SPARSE`` classes are spots as well, which depends on the word alone. The fingerprint is the
sorted set of the signatures after their number; the likeness of two is their Jaccard similarity.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxsieve.llm.store import stored

CHAIN = 2
SPARSE = 8
#: Rows of neighbouring ids that are put in order together, on average, and parts of the ids by quantiles.
NEIGHBOURS, SEGMENTS = 256, 128
FEW = 100_000
#: Frequent function words of English, German, French and Spanish.
COMMON = (
    "a an and are as at be but by for from has have he her his i in is it not of on or she that the their they this to was we were which with you "
    "als am auch auf aus bei das dass dem den der des die ein eine einen einer er es für hat ich im ist mit nicht noch sich sie sind so und über um von vor war wie zu zum zur "
    "au aux avec ce ces cette dans de du elle en est et il je la le les leur mais ne nous ont ou où par pas plus pour que qui sa se ses son sont sur un une vous "
    "al como con del el ella ellos era ha hay lo los las más me mi muy no nos o para pero por porque sin sobre su sus también unos y ya"
).split()


def with_signatures(rows: DataFrame, text: str, to: str) -> DataFrame:
    """``rows`` with the array ``to``: the sorted set of the signatures of the column ``text``, which must not be NULL.

    A text without a spot has the hash of the whole as its only signature, the empty text has none. Each step is a projection of its own,
    so that no lambda computes an array anew for each element.
    """
    common = sorted(set(COMMON))
    words = rows.withColumn("_words", F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda x: x != ""))
    parts = words.withColumns({
        "_content": F.filter("_words", lambda x: ~x.isin(common)),
        "_common": F.filter(F.transform("_words", lambda x, k: F.when(x.isin(common), k)), lambda k: k.isNotNull()),
    })

    def chain(first: Column) -> list[Column]:
        return [F.get("_content", first + k) for k in range(CHAIN)]

    # the j-th common word, at place k, has k - j content words before it
    spots = F.transform("_common", lambda k, j: F.hash(F.get("_words", k), *chain(k - j)))
    sparse = F.transform("_content", lambda x, k: F.when(F.pmod(F.hash(x), F.lit(SPARSE)) == 0, F.hash(x, *chain(k + 1))))
    found = parts.withColumn("_found", F.concat(spots, F.filter(sparse, lambda x: x.isNotNull())))
    whole = F.when(F.col(text) == "", F.array().cast("array<int>")).otherwise(F.array(F.hash(text)))
    signed = found.withColumn(to, F.when(F.size("_found") > 0, F.array_sort(F.array_distinct("_found"))).otherwise(whole))
    return signed.drop("_words", "_content", "_common", "_found")


def fingerprint(signatures: Column) -> Column:
    """The number of signatures and, after a colon, each as eight hexadecimal digits."""
    digits = F.transform(signatures, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0"))
    return F.concat(F.size(signatures).cast("string"), F.lit(":"), F.array_join(digits, ""))


def length_class(signatures: Column, least: float) -> Column:
    """Partition by set length: sets that are ``least`` alike are in the same or in neighbouring classes."""
    return F.floor(F.log(F.greatest(F.size(signatures), F.lit(1))) / -math.log(least))


def likeness(one: Column, two: Column, least: float | None = None) -> Column:
    """Jaccard similarity of two sets; two empty sets are alike.

    With ``least``, pairs whose lengths alone keep them below it are 0 without a look at the sets.
    """
    shared = F.size(F.array_intersect(one, two))
    exact = F.when(F.size(one) + F.size(two) == 0, 1.0).otherwise(shared / (F.size(one) + F.size(two) - shared))
    if least is None:
        return exact
    far = (F.abs(length_class(one, least) - length_class(two, least)) > 1) | (F.least(F.size(one), F.size(two)) < least * F.greatest(F.size(one), F.size(two)))
    return F.when(far & (F.size(one) + F.size(two) > 0), 0.0).otherwise(exact)


def _next_lower(keys: DataFrame) -> DataFrame:
    """``key`` and ``lower``, the next lower key, the highest for the least; the keys are distinct."""
    if keys.limit(FEW + 1).count() <= FEW:
        by = Window.orderBy("key")
        return keys.select("key", F.coalesce(F.lag("key").over(by), F.max("key").over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("lower"))
    keyed = keys.withColumn("parent", F.expr(f"key div {FEW}"))
    tops = keyed.groupBy("parent").agg(F.max("key").alias("top"))
    below = _next_lower(tops.select(F.col("parent").alias("key"))).withColumnsRenamed({"key": "parent", "lower": "below"})
    below = below.join(tops.withColumnsRenamed({"parent": "below", "top": "end"}), "below")
    within = keyed.withColumn("lag", F.lag("key").over(Window.partitionBy("parent").orderBy("key")))
    return within.join(below, "parent").select("key", F.coalesce("lag", "end").alias("lower"))


def _segments(rows: DataFrame) -> tuple[list[int], list[int], int, int]:
    """Ids that cut all rows into about ``SEGMENTS`` equal parts, how many parts each stands for, ranges in a part, and ranges of the rows without id."""
    steps = [k / SEGMENTS for k in range(1, SEGMENTS)]
    n, known, low, found = rows.agg(F.count("*"), F.count("doc_id"), F.min("doc_id"), F.percentile_approx("doc_id", steps, 100 * SEGMENTS)).first()
    cuts = Counter([low or 0, *(found or [])])
    return sorted(cuts), [cuts[c] for c in sorted(cuts)], max(1, math.ceil(known / SEGMENTS / NEIGHBOURS)), max(1, math.ceil((n - known) / NEIGHBOURS))


def _range(rows: DataFrame, tie: Column) -> Column:
    """The range of a row, rising with its doc_id, rows without one first, and with ``tie`` where one id has many rows."""
    cuts, weights, per, unknown = _segments(rows)

    def spread(count: Column) -> Column:
        return F.least(F.floor((tie.cast("double") / 2.0**64 + 0.5) * count), count - 1)

    number = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut <= F.col("doc_id")))
    at = lambda values, k: F.get(F.array(*map(F.lit, values)), k)
    low, high, many = at([float(c) for c in cuts], number - 1), at([float(c) for c in [*cuts[1:], cuts[-1]]], number - 1), at(weights, number - 1) * per
    # an id that is a cut several times has several parts by itself
    heavy = (F.col("doc_id") == at(cuts, number - 1)) & (many > per)
    part = F.when(high > low, (F.col("doc_id").cast("double") - low) / (high - low)).otherwise(0.0)
    inside = F.when(heavy, spread(many)).otherwise(many + F.least(F.floor(part * per), F.lit(per - 1)))
    return F.when(F.col("doc_id").isNull(), spread(F.lit(unknown))).otherwise(number.cast("long") * F.lit(1 << 40) + inside).cast("long")


def with_next(rows: DataFrame, columns: list[str], prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``rows`` (doc_id, text and others) with ``next``, the ``columns`` of the next row in descending order of doc_id.

    After the last row comes the first. Rows without doc_id are last; rows that repeat a doc_id follow each other by a hash of their text. The rows are cut
    into ranges of about ``NEIGHBOURS``, by quantiles of the ids and evenly between these, each ordered by itself, and a copy of each range's first row stands behind the
    range above it. ``prepare`` adds columns once it is known which rows are copied.
    """
    placed = rows.withColumn("_tie", F.xxhash64("text"))
    placed = placed.withColumn("_range", _range(rows, F.col("_tie")))
    place = F.struct(F.col("doc_id").isNotNull().alias("named"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("_tie").alias("tie"))
    heads = stored(placed.groupBy("_range").agg(F.max(place).alias("head")), "heads")
    lower = _next_lower(heads.select(F.col("_range").alias("key")))
    behind = lower.join(heads.withColumnRenamed("_range", "lower"), "lower").select(F.col("key").alias("_above"), F.col("lower").alias("_range"), "head")
    behind = stored(behind, "behind")
    copies = placed.join(behind, "_range").where(place == F.col("head")).drop("head").withColumn("_range", F.col("_above")).drop("_above")
    # of rows alike at the head of a range one is enough
    copies = copies.dropDuplicates(["_range"]).withColumn("_copy", F.lit(1))
    order = Window.partitionBy("_range").orderBy("_copy", F.col("doc_id").desc_nulls_last(), F.col("_tie").desc())
    both = placed.withColumn("_copy", F.lit(0)).unionByName(copies)
    both = prepare(both) if prepare else both
    return both.withColumn("next", F.lead(F.struct(*columns)).over(order)).where("_copy = 0").drop("_copy", "_tie", "_range")


def spot_fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored), the fingerprints of its text and of an edited text.

    The edited text has the last third of the code points replaced by the first as many of the next document's, or all of them.
    Columns: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``. NULL is
    the empty text. Any long is an id; ids need not be evenly spread. Rows without doc_id come last and, like those that repeat one, in an order by hash.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    beside = with_next(texts, ["text", "own"], lambda rows: with_signatures(rows, "text", "own"))
    third = F.floor(F.length("text") / 3).cast("int")
    kept = F.substring("text", F.lit(1), F.length("text") - third)
    edited = beside.withColumn("edited", F.concat(kept, F.substring("next.text", F.lit(1), third)))
    signed = with_signatures(edited, "edited", "changed")
    return signed.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("next.own")).alias("near_next"),
    )
