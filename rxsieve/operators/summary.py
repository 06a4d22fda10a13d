"""The data of the confirmation a finished run sends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxsieve.functions.cells import clean_code, clean_title, filled, text
from rxsieve.operators.lookup import one_per_key

# Defaults, and campaigns per table their drugs are counted in.
DEFAULT_PRODUCT = "Client Specific Communications"
SHORTEST_PRODUCT = 5
UNKNOWN_CAMPAIGN = "Unknown Campaign"
FORMULARY_COUNT_CAMPAIGNS = (63, 26, 67, 566)
WORK_COUNT_CAMPAIGNS = (30, 52)


def project_titles(projects: DataFrame) -> DataFrame:
    """Distinct cleaned titles per project."""
    return projects.select("prjct_id", clean_title("title_nm").alias("title_nm")).distinct()


def project_details(projects: DataFrame) -> DataFrame:
    """One row per project: cleaned title, product and sub-product.

    Each field is picked on its own, the least value first, so a project listed
    many times costs one combined row per partition.
    """
    cleaned = projects.select(
        "prjct_id",
        clean_title("title_nm").alias("title_nm"),
        clean_code("prod_id").alias("prod_id"),
        clean_code("prod_subcat_id").alias("prod_subcat_id"),
    )
    picked = cleaned.groupBy("prjct_id").agg(*[F.min(c).alias(c) for c in ("title_nm", "prod_id", "prod_subcat_id")])
    return picked.select(
        "prjct_id",
        text("title_nm").alias("title_nm"),
        _product("prod_id").alias("prod_id"),
        _product("prod_subcat_id").alias("prod_subcat_id"),
    )


def _product(name: str) -> Column:
    return F.when(F.length(text(name)) < SHORTEST_PRODUCT, DEFAULT_PRODUCT).otherwise(F.col(name))


def drug_count(campaign: Column, formulary: DataFrame, work: DataFrame) -> Column:
    """Number of drugs targeted by a campaign, from the table its kind is counted in.

    Each table is counted once, whatever the number of campaigns; campaigns of
    any other kind have no count.
    """
    counted = F.count("*").alias("n")
    return F.when(campaign.isin(*FORMULARY_COUNT_CAMPAIGNS), formulary.agg(counted).scalar()).when(
        campaign.isin(*WORK_COUNT_CAMPAIGNS), work.agg(counted).scalar()
    )


def drug_counts(campaign_ids: DataFrame, formulary: DataFrame, work: DataFrame) -> DataFrame:
    """One row per campaign whose drugs are counted."""
    counted = FORMULARY_COUNT_CAMPAIGNS + WORK_COUNT_CAMPAIGNS
    wanted = campaign_ids.select("campaign_id").filter(F.col("campaign_id").isin(*counted)).distinct()
    return wanted.withColumn("drug_count", drug_count(F.col("campaign_id"), formulary, work))


def campaign_names(runs: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Runs with campaign name and targeting message, or the defaults."""
    dim = one_per_key(campaigns, "dqi_campaign_id", ["dqi_campaign_name", "dqi_targeting_message"])
    known = dim.withColumn("known", F.lit(True)).withColumnRenamed("dqi_campaign_id", "campaign_id")
    name = F.when(F.col("known"), F.col("dqi_campaign_name")).otherwise(UNKNOWN_CAMPAIGN)
    return runs.join(known, "campaign_id", "left").select(
        *runs.columns,
        name.alias("campaign_name"),
        F.when(filled("dqi_targeting_message"), F.col("dqi_targeting_message")).alias("targeting_message"),
    )


def run_summaries(
    runs: DataFrame, campaigns: DataFrame, projects: DataFrame | None, count: Column | None = None
) -> DataFrame:
    """One summary row per finished run.

    ``runs`` has ticket, activity, campaign_id, mailing_name, program, project and
    client_name; ``count`` is the expression for their drug count. Without a
    project table the title is empty and both products take their default.
    """
    named = campaign_names(runs, campaigns)
    if projects is None:
        empty = F.lit("").alias("title_nm")
        default = F.lit(DEFAULT_PRODUCT)
        named = named.select("*", empty, default.alias("prod_id"), default.alias("prod_subcat_id"))
    else:
        details = project_details(projects).withColumn("ticket", F.col("prjct_id").cast("string")).drop("prjct_id")
        named = named.join(details, "ticket", "left")
    title = text("title_nm")
    subject = F.concat(F.lit("SUCCESS!! "), text("activity"), F.lit(" - "), text("ticket"), F.lit(" "), title)
    return named.select(
        "ticket",
        subject.alias("subject"),
        "mailing_name",
        "program",
        F.lit("DQI").alias("application"),
        "activity",
        "campaign_id",
        "campaign_name",
        "project",
        F.coalesce("prod_id", F.lit(DEFAULT_PRODUCT)).alias("product_id"),
        F.coalesce("prod_subcat_id", F.lit(DEFAULT_PRODUCT)).alias("subproduct_id"),
        "client_name",
        (F.lit(None).cast("long") if count is None else count).alias("drug_count"),
        "targeting_message",
    )
