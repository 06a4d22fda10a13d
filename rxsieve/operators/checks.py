"""Prunes contradictory matches, then finds duplicates and exclusions without inclusion.

Each check reads the pruned matches more than once; ``plans.intake.validate_intake`` takes the name of a
table to keep them in. What a check joins them with grows with them, so these joins are merged
and never broadcast (``joins.merged``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxsieve.functions.cells import any_of, surely
from rxsieve.operators.joins import merged
from rxsieve.params import CampaignParams

# What makes a duplicate, and the columns of its report.
DUPLICATE_KEY = ["rec_type", "drug_defn", "drug_id"]
REPORT_COLUMNS = [
    "rec_type", "drug_id", "drug_desc", "ndc9", "ndc11", "gpi", "b_g", "ms_ss", "druglvl",
    "brnd_gnrc_cd", "drug_multi_src_cd",
]


def contradicts(run: CampaignParams) -> Column:
    """Whether a match contradicts its drug row; an unknown indicator contradicts nothing."""
    # The codes of drug rows and catalogue.
    c = F.col
    if run.has_mony_switches:
        source, otc_product = c("pbm_drug_multi_src_cd"), c("otc_drug_ind") == "Y"
        contradictions = [(c(f"mony_{letter.lower()}") == "E") & (source == letter) for letter in "MONY"]
        contradictions += [(c("rx") == "E") & ~surely(otc_product), (c("otc") == "E") & otc_product]
        gone = (c("druglvl") == "GPI") & any_of([surely(x) for x in contradictions])
    else:
        gone = any_of(
            [
                surely(x)
                for x in (
                    (c("b_g") == "B") & (c("brnd_gnrc_cd") == "GNRC"),
                    (c("b_g") == "G") & (c("brnd_gnrc_cd") == "BRND"),
                    c("ms_ss").isin("M", "MS") & (c("drug_multi_src_cd") == "SINGLE"),
                    c("ms_ss").isin("S", "SS") & (c("drug_multi_src_cd") == "MULTI"),
                )
            ]
        )
    return surely(gone)


def prune_matches(validity: DataFrame, run: CampaignParams) -> DataFrame:
    """Drops matches that contradict the drug row."""
    return validity.filter(~contradicts(run))


def duplicate_groups(validity: DataFrame) -> DataFrame:
    """Products assigned more than once under one record type and definition."""
    return validity.groupBy(*DUPLICATE_KEY).agg(F.count("*").alias("cnt")).filter(F.col("cnt") > 1)


def duplicate_report(validity: DataFrame) -> DataFrame:
    """Rows of every product with a duplicate group.

    Joined without the definition, as the report is defined: a product
    duplicated under both definitions lists each of its rows twice, and rows of
    its clean definition appear as well.
    """
    groups = duplicate_groups(validity).select("rec_type", "drug_id")
    return validity.join(merged(groups), ["rec_type", "drug_id"]).select(*REPORT_COLUMNS)


def duplicate_rows(validity: DataFrame) -> DataFrame:
    """Rows that are in a duplicate group, once each.

    A count and a semi-join rather than a window: the count combines before its
    shuffle and the semi-join can be split, while a window would sort all rows of
    a hot product in one task.
    """
    groups = duplicate_groups(validity).select(*[F.col(k).alias(f"group_{k}") for k in DUPLICATE_KEY])
    same = [F.col(k).eqNullSafe(F.col(f"group_{k}")) for k in DUPLICATE_KEY]
    return validity.join(merged(groups), same, "left_semi").select("rec_type", "drug_defn", *REPORT_COLUMNS[1:])


def rows_of_type(validity: DataFrame, rec_type: str) -> DataFrame:
    return validity.filter(F.col("rec_type") == rec_type)


def invalid_exclusions(validity: DataFrame) -> DataFrame:
    """Exclusions whose product is not in the inclusions, with SQL's NOT IN semantics.

    One NULL among the inclusions empties the answer, no inclusions at all keep
    every exclusion. Written as an anti-join on distinct products, which
    shuffles both sides, since NOT IN itself would collect the inclusions in
    every executor.
    """
    included = rows_of_type(validity, "I").select("drug_id")
    facts = included.agg(
        F.struct((F.count("*") == 0).alias("none"), (F.count("*") > F.count("drug_id")).alias("unknown")).alias("facts")
    ).scalar()
    excluded = rows_of_type(validity, "E").select("drug_id", "rec_type")
    possible = excluded.filter(facts["none"] | (~facts["unknown"] & F.col("drug_id").isNotNull()))
    return possible.join(merged(included.distinct()), "drug_id", "left_anti").select("drug_id", "rec_type")


def duplicate_report_by_product(validity: DataFrame) -> DataFrame:
    """The rows of ``duplicate_report``, joined by product alone.

    For matches that lie bucketed by ``drug_id``: neither the groups nor the join need an exchange then. A product has at most as many groups as record types
    times definitions, so what is gathered for it is small.
    """
    groups = duplicate_groups(validity).groupBy("drug_id").agg(F.collect_list("rec_type").alias("groups"))
    same = F.filter("groups", lambda group: group == F.col("rec_type"))
    return validity.join(merged(groups), "drug_id").select(*REPORT_COLUMNS, F.explode(same).alias("group")).drop("group")


def finding_counts(validity: DataFrame) -> DataFrame:
    """One row: ``duplicates``, rows of the duplicate report, and ``exclusions``, exclusions without inclusion.

    All from one pass over the matches: the rows of each product, record type and definition are counted, and the counts tell how many rows the joins of the
    reports would give, by the same rules for NULL.
    """
    c = F.col
    groups = validity.groupBy(*DUPLICATE_KEY).agg(F.count("*").alias("n"))
    kinds = groups.groupBy("rec_type", "drug_id").agg(F.sum("n").alias("n"), F.count_if(c("n") > 1).alias("repeated"))
    products = kinds.groupBy("drug_id").agg(
        F.sum(F.when(c("rec_type").isNotNull() & c("drug_id").isNotNull(), c("n") * c("repeated"))).alias("reported"),
        F.sum(F.when(c("rec_type") == "I", c("n"))).alias("included"),
        F.sum(F.when(c("rec_type") == "E", c("n"))).alias("excluded"),
    )
    known = c("drug_id").isNotNull()
    facts = products.agg(
        F.coalesce(F.sum("reported"), F.lit(0)).alias("duplicates"),
        F.count("included").alias("included"),
        F.count(F.when(~known, c("included"))).alias("unknown"),
        F.coalesce(F.sum("excluded"), F.lit(0)).alias("every"),
        F.coalesce(F.sum(F.when(known & c("included").isNull(), c("excluded"))), F.lit(0)).alias("alone"),
    )
    exclusions = F.when(c("included") == 0, c("every")).when(c("unknown") > 0, 0).otherwise(c("alone"))
    return facts.select("duplicates", exclusions.alias("exclusions"))
