"""Matches drug rows to the product catalogue by NDC11, NDC9 or GPI code.

The match condition is a three-way OR with LIKE, which a planner can only run
as a nested loop over all pairs. Here every code is reduced to an *anchor*, a
literal piece any matching product must contain: the whole code, or its longest
run without wildcard, which leads the code, ends it, or lies inside. A product has one piece of a length
that leads and one that ends its code, but one for each place inside. Products offer
their pieces of exactly the lengths some code asks for, so the match becomes one
equi-join; what the piece leaves open is checked behind the join.

Scale notes
 * The join runs on distinct codes and distinct pairs of product codes, nothing else. Drug
   columns and catalogue columns are joined to the matches that were found, by equality.
 * The lengths asked for are a scalar subquery, so building the plan starts no job.
 * There is one plan for all sizes. Both sides of every join grow with the tables and packed files
   are estimated far too small, so the joins are merged and never broadcast (``joins.merged``); AQE splits hot pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxsieve.functions.cells import cell, filled
from rxsieve.operators.joins import merged
from rxsieve.params import CampaignParams

# Columns of the three tables, in table order.
PRODUCT_COLUMNS = [
    "drug_prod_gid", "drug_id", "gpi_cd", "brnd_gnrc_cd", "drug_multi_src_cd", "pbm_drug_multi_src_cd",
    "mddb_brnd_gnrc_cd", "mddb_drug_multi_src_cd", "mddb_multsrc_cd", "otc_drug_ind",
]
DRUG_COLUMNS = ["rec_type", "drug_code", "druglvl", "ndc9", "ndc11", "gpi", "drug_desc", "b_g", "ms_ss"]
PRODUCT_CODES, ASKED = ["drug_id", "gpi_cd"], ["druglvl", "drug_code"]
MONY_COLUMNS = ["mony_m", "mony_o", "mony_n", "mony_y", "rx", "otc"]

# Tags of the two product definitions; the first is four characters wide.
PBM, MDDB = "PBM ", "MDDB"

# LIKE's escape character is set to one no code holds, so a backslash is an ordinary character.
NO_ESCAPE = "\u0001"

# A piece is one of these letters and the text: which code of the product it comes from, and how.
WHOLE_NDC9, WHOLE_NDC11, NDC11_HEAD, NDC11_INSIDE, NDC11_TAIL, GPI_HEAD, GPI_INSIDE = "9", "N", "H", "I", "T", "G", "J"
PIECES = "array<string>"

# What is left to check behind the join: nothing, a run at a fixed place, or a LIKE.
DECIDED, FIXED, OPEN = range(3)


def drug_columns(run: CampaignParams) -> list[str]:
    return DRUG_COLUMNS + (MONY_COLUMNS if run.has_mony_switches else [])


def match_products(drugs: DataFrame, catalog: DataFrame, columns: list[str] = DRUG_COLUMNS) -> DataFrame:
    """Distinct (product, drug row) pairs with all catalogue columns and the given drug columns."""
    rows = drugs.select(*[cell(c) for c in columns]).filter(F.col("druglvl").isin("NDC11", "NDC9", "GPI") & filled("drug_code"))
    products = catalog.select(*PRODUCT_COLUMNS).filter(F.col("drug_prod_gid").isNotNull())
    matches = matched_codes(rows, products)
    # copies of matched products and of drug rows go here, so that they never multiply
    known = products.join(merged(matches), [F.col(c).eqNullSafe(F.col(f"matched_{c}")) for c in PRODUCT_CODES])
    known = known.select(*PRODUCT_COLUMNS, *ASKED).distinct()
    asked = rows.distinct().withColumnsRenamed({c: f"asked_{c}" for c in ASKED})
    both = known.join(merged(asked), [F.col(c) == F.col(f"asked_{c}") for c in ASKED])
    return both.select(*PRODUCT_COLUMNS, *columns)


def matched_codes(rows: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct pairs of a drug row's code and a product's codes that match; both sides are reduced to their codes first."""
    codes = _anchored(rows.select(*ASKED).distinct())
    kind = F.struct(F.substring("piece", 1, 1).alias("origin"), (F.length("piece") - 1).alias("n"))
    wanted = codes.agg(F.collect_set(kind).alias("wanted")).scalar()
    offered = _pieces(products.select(*PRODUCT_CODES).distinct(), wanted)
    pairs = offered.withColumnsRenamed({c: f"matched_{c}" for c in PRODUCT_CODES}).join(merged(codes), "piece")
    subject = F.when(F.col("druglvl") == "GPI", F.trim("matched_gpi_cd")).otherwise(F.col("matched_drug_id"))
    size, place = F.length("anchor"), F.instr(F.col("pattern"), F.col("anchor"))
    fits = (
        F.when(F.col("rest") == FIXED, (F.length(subject) == F.length("pattern")) & (F.substring(subject, place, size) == F.col("anchor")))
        .when(F.col("rest") == OPEN, F.like(subject, F.col("pattern"), F.lit(NO_ESCAPE)))
        .otherwise(True)
    )
    return pairs.filter(fits).select(*[f"matched_{c}" for c in PRODUCT_CODES], *ASKED)


def _anchored(codes: DataFrame) -> DataFrame:
    """Codes with the piece of product code they ask for, and what the piece leaves open."""
    level, code = F.col("druglvl"), F.col("drug_code")
    is_gpi = level == "GPI"
    like = F.when(is_gpi, F.concat(F.trim(code), F.lit("%"))).otherwise(code)
    head = F.regexp_extract(like, "^[^_%]*", 0)
    runs = F.transform(F.split(like, "[_%]+"), lambda run: F.struct(F.length(run).alias("size"), run.alias("run")))
    longest = F.array_max(runs)
    tail = F.regexp_extract(like, "[^_%]*$", 0)
    leads = F.length(head) >= longest["size"]
    # a run at either end has one piece a product, so it is taken before a longer one inside if that is not twice its length
    ends = ~is_gpi & (F.length(tail) > 0) & (2 * F.length(tail) > longest["size"])
    is_ndc9 = level == "NDC9"
    whole = is_ndc9 | (~is_gpi & ~F.rlike(code, F.lit("[_%]")))

    origin = (
        F.when(whole, F.when(is_ndc9, WHOLE_NDC9).otherwise(WHOLE_NDC11))
        .when(leads, F.when(is_gpi, GPI_HEAD).otherwise(NDC11_HEAD))
        .when(ends, NDC11_TAIL)
        .otherwise(F.when(is_gpi, GPI_INSIDE).otherwise(NDC11_INSIDE))
    )
    anchor = F.when(whole, code).when(leads, head).when(ends, tail).otherwise(longest["run"])
    decided = whole | (like == F.concat(head, F.lit("%"))) | (ends & (like == F.concat(F.lit("%"), tail)))
    rest = (
        F.when(decided, DECIDED)
        .when(F.rlike(like, F.lit("^_*[^_%]+_*$")), FIXED)
        .otherwise(OPEN)
    )
    return codes.withColumns({"piece": F.concat(origin, anchor), "anchor": anchor, "pattern": like, "rest": rest})


def _pieces(products: DataFrame, wanted: Column) -> DataFrame:
    """One row per product and piece of its codes of a kind and length that is wanted."""
    ndc9, ndc11, gpi = F.substring("drug_id", 1, 9), F.col("drug_id"), F.trim("gpi_cd")

    def pieces(want: Column) -> Column:
        origin, n = want["origin"], want["n"]
        subject = F.when(origin == WHOLE_NDC9, ndc9).when(origin.isin(GPI_HEAD, GPI_INSIDE), gpi).otherwise(ndc11)
        first = F.when(origin == NDC11_TAIL, F.length(subject) - n + 1).otherwise(1)
        last = F.when(origin.isin(NDC11_INSIDE, GPI_INSIDE, NDC11_TAIL), F.length(subject) - n + 1).otherwise(1)
        long_enough = F.when(origin.isin(WHOLE_NDC9, WHOLE_NDC11), F.length(subject) == n).otherwise(F.length(subject) >= n)
        runs = F.transform(F.sequence(first, last), lambda at: F.concat(origin, F.substring(subject, at, n)))
        return F.when(long_enough, runs).otherwise(F.array().cast(PIECES))

    kinds = products.withColumn("want", F.explode(wanted))
    return kinds.withColumn("piece", F.explode(F.array_distinct(pieces(F.col("want"))))).drop("want")


def drug_validity(drugs: DataFrame, catalog: DataFrame, run: CampaignParams) -> DataFrame:
    """Both product definitions of every match, distinct.

    The match runs once; each pair then yields its PBM row and its MDDB row,
    the latter with the MDDB indicators under the PBM names.
    """
    columns = drug_columns(run)

    def definition(tag: str, brand: str, source: str, source_code: str) -> Column:
        return F.struct(
            F.col(brand).alias("brnd_gnrc_cd"),
            F.col(source).alias("drug_multi_src_cd"),
            F.col(source_code).alias("pbm_drug_multi_src_cd"),
            F.lit(tag).alias("drug_defn"),
        )

    both = F.array(
        definition(PBM, "brnd_gnrc_cd", "drug_multi_src_cd", "pbm_drug_multi_src_cd"),
        definition(MDDB, "mddb_brnd_gnrc_cd", "mddb_drug_multi_src_cd", "mddb_multsrc_cd"),
    )
    pairs = match_products(drugs, catalog, columns)
    rows = pairs.select("drug_prod_gid", "drug_id", "otc_drug_ind", *columns, F.inline(both))
    indicators = ["brnd_gnrc_cd", "drug_multi_src_cd", "pbm_drug_multi_src_cd", "otc_drug_ind"]
    switches = MONY_COLUMNS if run.has_mony_switches else []
    return rows.select("drug_prod_gid", "drug_id", *indicators, *DRUG_COLUMNS, "drug_defn", *switches).distinct()
