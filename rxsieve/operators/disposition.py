"""What a raised issue means for its campaign run.

Input is one row per issue: run, order, campaign, message id and text. Message
id 0 stands for a plain text, any other for a message record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxsieve.functions.cells import surely
from rxsieve.operators.lookup import one_per_key
from rxsieve.params import FIRST_TRIAGE_CAMPAIGN, CampaignParams

# Message types with their subject prefixes, and the record for an unknown message id.
FAILURE, WARNING, INFORMATIVE = "FAILURE MESSAGE", "WARNING MESSAGE", "INFORMATIVE MESSAGE"
SUBJECT_PREFIX = {FAILURE: "FAILED!! ", WARNING: "WARNING!! ", INFORMATIVE: "INFORMATIVE!! "}
UNKNOWN_MESSAGE = "Critical error encountered"

# Fixed value: the text of a plain issue that was raised without one.
NO_TEXT = "N"


def message_pairs(messages: DataFrame) -> DataFrame:
    """Message records as (name, trimmed value) pairs, one row per field."""
    fields = [c for c in messages.columns if c != "dqi_message_id"]
    as_text = messages.select("dqi_message_id", *[F.col(c).cast("string").alias(c) for c in fields])
    pairs = as_text.unpivot("dqi_message_id", fields, "name", "value")
    return pairs.withColumn("value", F.trim("value"))


def campaign_flags(campaigns: DataFrame) -> DataFrame:
    """How often each campaign id has each notify flag."""
    return campaigns.groupBy("dqi_campaign_id", "dqi_messages").agg(F.count("*").alias("n"))


def notified_campaigns(campaigns: DataFrame) -> DataFrame:
    """``campaign_id`` and ``flagged``: whether its flags, joined as text, are a single Y.

    That is so if one row has a flag other than the empty text, and that is Y; a NULL joins as a text of its own.
    """
    flag = F.coalesce("dqi_messages", F.lit("null"))
    return campaigns.groupBy(F.col("dqi_campaign_id").alias("campaign_id")).agg(
        ((F.count_if(flag != "") == 1) & (F.count_if(flag == "Y") == 1)).alias("flagged")
    )


def dispose_issues(
    issues: DataFrame, messages: DataFrame, campaigns: DataFrame, run: CampaignParams
) -> DataFrame:
    """Every issue with its class, notification, triage text and abort decision."""
    records = one_per_key(messages, "dqi_message_id", ["dqi_message_type", "dqi_mco_message"])
    c = F.col
    plain = c("message_id") == 0
    triage = c("campaign_id") >= FIRST_TRIAGE_CAMPAIGN
    looked_up = F.coalesce(F.trim("dqi_message_type"), F.lit(FAILURE))
    fails = plain | (looked_up == FAILURE)
    ignored = ~plain & looked_up.isin(WARNING, INFORMATIVE)
    abort = surely(~triage & fails)
    on_test = run.test_directory in run.main_dir
    flagged = surely(c("flagged"))

    application = F.when(abort, F.lit(run.test_application) if on_test else F.when(flagged, run.application))
    message = F.when(plain, F.coalesce("message_text", F.lit(NO_TEXT))).otherwise(
        F.coalesce(F.trim("dqi_mco_message"), F.lit(UNKNOWN_MESSAGE))
    )
    # plain issues look nothing up, so they must not meet under one key
    asked = F.when(c("message_id") != 0, c("message_id"))
    return (
        issues.join(records, asked == c("dqi_message_id"), "left")
        .join(notified_campaigns(campaigns), "campaign_id", "left")
        .select(
            "run_id",
            "seq",
            "campaign_id",
            "message_id",
            F.when(triage, "triage").otherwise("regular").alias("campaign_class"),
            F.when(~plain, looked_up).alias("message_type"),
            F.when(~triage, _subject(plain, looked_up, run)).alias("subject"),
            F.when(triage & ~ignored, message).alias("triage_text"),
            (triage & ~ignored).cast("int").alias("triage_error"),
            abort.alias("abort"),
            application.alias("application"),
            (abort & flagged & F.lit(not on_test)).alias("send_summary"),
        )
    )


def _subject(plain: Column, message_type: Column, run: CampaignParams) -> Column:
    prefix = F.when(plain, SUBJECT_PREFIX[FAILURE])
    for kind, start in SUBJECT_PREFIX.items():
        prefix = prefix.when(message_type == kind, start)
    return F.concat(prefix, F.lit(run.email_subject))


def run_flags(disposed: DataFrame) -> DataFrame:
    """One row per run: size, triage flag and abort decision."""
    return disposed.groupBy("run_id").agg(
        F.count("*").alias("n_issues"),
        F.max("triage_error").alias("triage_error"),
        F.max("abort").alias("abort"),
        F.max("send_summary").alias("send_summary"),
    )


def run_messages(disposed: DataFrame) -> DataFrame:
    """The failure texts of every run, one row per failing issue."""
    return disposed.filter(F.col("triage_text").isNotNull()).select("run_id", "seq", "triage_text")


def run_text(disposed: DataFrame, run_id: int) -> DataFrame:
    """The failure text of one run: its texts in order with bars between, from the first on that is not empty.

    One cell holds all texts, so this is for a run the caller knows, not for all runs.
    """
    said = run_messages(disposed).filter(F.col("run_id") == run_id)
    texts = F.transform(F.array_sort(F.collect_list(F.struct("seq", "triage_text"))), lambda x: x["triage_text"])
    first = F.array_position(F.transform("texts", lambda t: t != ""), True).cast("int")
    kept = F.when(first > 0, F.slice("texts", first, F.size("texts"))).otherwise(F.slice("texts", 1, 0))
    return said.agg(texts.alias("texts")).select(F.array_join(kept, "|").alias("msg_fail"))


def run_texts(disposed: DataFrame) -> DataFrame:
    """The failure text of every run that has failing issues: ``run_id``, ``msg_fail``.

    Its texts in order of ``seq`` with bars between, from the first on that is not empty: what is empty so far is replaced, not continued. A run of empty texts
    alone has the empty text. The text of a run is one cell, so it is as long as the run has failing issues.
    """
    said = run_messages(disposed)
    begins = said.groupBy(F.col("run_id").alias("run")).agg(F.min(F.when(F.col("triage_text") != "", F.col("seq"))).alias("begin"))
    begun = said.join(begins, F.col("run_id").eqNullSafe(F.col("run"))).drop("run")
    spoken = F.when(F.col("seq") >= F.col("begin"), F.col("triage_text"))
    joined = begun.select("run_id", "seq", spoken.alias("spoken")).groupBy("run_id")
    return joined.agg(F.expr("coalesce(listagg(spoken, '|') within group (order by seq, spoken), '')").alias("msg_fail"))
