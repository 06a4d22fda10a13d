"""Mixing sources to target weights by pivotal dependent rounding, in SQL expressions only.

Every document of a source should be taken target / size times, a number of copies that has a fraction. Rounding
each on its own would miss the target by the noise of all documents. Pivotal rounding looks at two documents
at a time and moves mass from one to the other, in words, until the copies of one are whole; which of the two ways it goes
is drawn so that every document keeps its expected copies. The words of the pair stay the same, so only what is
left of the very last document can miss the target. To make that a small one, the large documents of a source are
rounded first, and the smaller ones share what is left to take after them.

The pairs form a tree: documents are dealt into groups of about ``GROUP`` within their source, each group folds
to one residual document, the residuals are dealt again, and so on to the last residual of each source, which is rounded by
a draw. A level is one shuffle of what the level before left, and no group grows with the source.
All draws are hashes of the documents' ids, so a rerun takes the same copies.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxsieve.llm.copies import repeated_kinds, with_copy
from rxsieve.llm.store import stored

#: Weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)
#: A source is repeated this often at most.
MOST_COPIES = 3
#: Documents in a group of the tree, on average.
GROUP = 64
#: Documents above so many times their source's mean size are rounded first, and so on; the rest come last.
CLASSES = (2, 0.25)
KEPT = ("source", "size", "whole", "part", "row")
#: Copies as near as this to a whole number are whole.
NEAR = 1e-9


def n_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``source``, ``source_size``, ``target`` from the rows ``source``, ``size``.

    The targets share the total size by weight; what a target has above ``MOST_COPIES`` times its source's size is shared
    again by weight among the others until none is above. That ends where min(cap, level * weight) adds up to the total: sources reach
    their caps in the order of cap / weight, so the level follows from running sums over the sources.
    The one-partition windows run over one row for each source.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*(F.lit(x) for x in WEIGHTS))
    weighted = sums.withColumn("weight", F.element_at(weights, (F.pmod(F.row_number().over(in_order) - 1, F.lit(len(WEIGHTS))) + 1).cast("int")))
    weighted = weighted.withColumn("cap", MOST_COPIES * F.col("source_size"))
    everything = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    running = weighted.withColumns({
        "total": F.sum("source_size").over(everything),
        "full": F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
    })
    level = running.withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    # the first source whose cap is not below the level given all before it are full sets the level of the rest
    fits = F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.col("level"))
    levelled = level.withColumn("level", F.first(fits, ignorenulls=True).over(by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.lit(0.0)))
    return levelled.select("source", "source_size", target.alias("target"))


def _draw(*parts: Column) -> Column:
    """A number from 0 to 1 that the parts fix."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / float(1 << 53)


def _pair(x: Column, y: Column, seed: int) -> Column:
    """What becomes of two documents when words move between them until the copies of one are whole: ``done`` and ``left``."""
    # words that can move from y to x, and from x to y
    to_x = F.least((1 - x["part"]) * x["size"], y["part"] * y["size"])
    to_y = F.least(x["part"] * x["size"], (1 - y["part"]) * y["size"])
    moved = F.when(_draw(F.lit(seed), x["id"], y["id"], x["tie"], y["tie"]) * (to_x + to_y) < to_y, to_x).otherwise(-to_y)
    one = x.withField("part", x["part"] + moved / x["size"])
    two = y.withField("part", y["part"] - moved / y["size"])
    off = lambda s: F.abs(s["part"] - F.round(s["part"]))
    return F.when(off(one) <= off(two), F.struct(one.alias("done"), two.alias("left"))).otherwise(F.struct(two.alias("done"), one.alias("left")))


def _fold(rows: DataFrame, seed: int) -> DataFrame:
    """One row for each group: ``done`` holds the documents whose copies are whole, ``left`` the one that may not be.

    The largest come first: what is left of them then meets ever smaller documents.
    """
    members = F.reverse(F.array_sort(F.collect_list(F.struct("size", "id", "tie", "part", "whole", "row"))))
    grouped = rows.groupBy("source", "n", "group").agg(members.alias("members"))
    first = F.element_at("members", 1)
    nobody = F.when(F.lit(False), first)
    start = F.struct(F.array(nobody).alias("done"), F.struct(nobody.alias("done"), first.alias("left")).alias("last"))

    def fold(state: Column, member: Column) -> Column:
        return F.struct(F.concat(state["done"], F.array(state["last"]["done"])).alias("done"), _pair(state["last"]["left"], member, seed).alias("last"))

    state = F.aggregate(F.slice("members", F.lit(2), F.size("members")), start, fold)
    whole = F.filter(F.concat(F.col("state.done"), F.array("state.last.done")), lambda d: d.isNotNull())
    return grouped.select("source", "n", state.alias("state")).select("source", "n", whole.alias("done"), F.col("state.last.left").alias("left"))


def _beside(rows: DataFrame, facts: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the facts of their source, which ``facts`` calls ``of``."""
    return rows.join(facts, F.col("source").eqNullSafe(F.col("of")), how).drop("of")


def _rounded(rows: DataFrame, most: int, seed: int) -> DataFrame:
    """The rows ``KEPT`` with ``part`` rounded to 0 or 1, by the tree.

    ``n`` is the number of rows of the source, ``most`` the largest: they tell how many groups a level has and how many levels there are.
    """
    settled = rows.where(F.col("part") <= NEAR).select(*KEPT)
    left, done, level, width = rows.where(F.col("part") > NEAR).select(*KEPT, "id", "tie", "n"), [], 0, 1
    while not level or width < most:
        level, width = level + 1, width * GROUP
        group = F.pmod(F.xxhash64(F.lit(level), "id", "tie"), F.ceil(F.col("n") / width))
        folded = stored(_fold(left.withColumn("group", group), seed + level), "mixing")
        done.append(folded.select("source", F.explode("done").alias("d")).select("source", "d.size", "d.whole", F.round("d.part").alias("part"), "d.row"))
        left = folded.select("source", "n", "left.*")
    drawn = (_draw(F.lit(seed), F.col("id"), F.col("tie")) < F.col("part")).cast("double")
    done.append(left.withColumn("part", drawn).select(*KEPT))
    return reduce(DataFrame.unionByName, done, settled.withColumn("part", F.lit(0.0)))


def mix(docs: DataFrame, carried: list[str] | None = None, seed: int = 1) -> DataFrame:
    """Per row ``row`` (its ``carried`` columns, all unless they are named), ``size``, ``source_size``, ``target``, ``copies``.

    ``docs`` has ``doc_id``, ``text`` and ``source``. Texts without words are never taken. A NULL source is a source, the last; a
    NULL doc_id is an id like others. Rows alike in id and text are documents of their own, told apart by where they stand in the table. No rows
    give no rows.
    """
    row = F.struct(*(carried or docs.columns)).alias("row")
    sized = docs.select(row, F.col("doc_id").alias("id"), F.xxhash64("text").alias("tie"), "source", n_words(F.col("text")).alias("size"))
    if repeated_kinds(sized, ["id", "tie"]).limit(1).count():
        # rows alike in id and text get ties of their own, or all of them would share a group on every level
        numbered = with_copy(sized, ["id", "tie"])
        sized = numbered.withColumn("tie", F.when(F.col("copy") > 0, F.xxhash64("tie", "copy")).otherwise(F.col("tie"))).drop("copy")
    rows = stored(sized, "sized")
    wanted = stored(targets(rows), "targets")
    worded = rows.where("size > 0")
    means = worded.groupBy(F.col("source").alias("of")).agg(F.avg("size").alias("mean"))
    ends = [*(F.col("mean") * c for c in CLASSES), F.lit(0.0)]
    counts = _beside(worded, means).groupBy(F.col("source").alias("of")).agg(F.first("mean").alias("mean"), *(F.count_if(F.col("size") > e).alias(f"above_{k}") for k, e in enumerate(ends)))
    still = _beside(wanted, counts, "left").withColumnsRenamed({"target": "to_take", "source_size": "to_see"})
    still = stored(still, "still")
    most = still.agg(*(F.max(f"above_{k}") for k in range(len(ends)))).first()

    taken = []
    for k, end in enumerate(ends):
        members = _beside(worded, still.withColumnRenamed("source", "of")).where(F.col("size") > end)
        members = members.where(F.col("size") <= ends[k - 1]) if k else members
        expected = F.greatest(F.lit(0.0), F.least(F.lit(float(MOST_COPIES)), F.try_divide("to_take", "to_see")))
        members = members.withColumn("whole", F.floor(expected + NEAR)).withColumn("part", F.greatest(F.lit(0.0), expected - F.col("whole")))
        members = members.withColumn("n", F.col(f"above_{k}"))
        taken.append(_rounded(members, most[k] or 0, seed + 100 * k).withColumn("copies", F.col("whole") + F.col("part")))
        if k < len(CLASSES):
            sums = taken[-1].groupBy(F.col("source").alias("of")).agg(F.sum(F.col("copies") * F.col("size")).alias("words"), F.sum("size").alias("seen"))
            less = {a: F.col(a) - F.coalesce(b, F.lit(0)) for a, b in (("to_take", F.col("words")), ("to_see", F.col("seen")))}
            still = stored(_beside(still, sums, "left").withColumns(less).drop("words", "seen"), "still")
    empty = rows.where("size = 0").select("source", "size", "row", F.lit(0.0).alias("copies"))
    every = reduce(DataFrame.unionByName, (t.select("source", "size", "row", "copies") for t in taken), empty)
    final = _beside(every, wanted.withColumnRenamed("source", "of"))
    return final.select("row", "size", "source_size", "target", F.col("copies").cast("int").alias("copies"))


def mixture(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` (words the mix takes, repeats counted), ``copies``."""
    mixed = mix(docs, ["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def repeated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, whatever their columns, each as often as the mix takes it."""
    return mix(docs).where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
