"""Rows of the run-variable history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxsieve.operators.align import load_time
from rxsieve.params import CampaignParams

# History columns between the row id and the load time, in table order.
VARIABLE_COLUMNS = [
    "dqi_ticket", "dqi_aprimo_activity", "mbr_process_id", "phys_process_id", "dqi_macro_scope",
    "dqi_macro_variable", "dqi_macro_value", "dqi_user_id", "dqi_user_name", "dqi_job_id",
]


def history_rows(variables: DataFrame, run: CampaignParams, logged_at: Column | None = None) -> DataFrame:
    """Run variables as the history stores them; times have whole seconds.

    ``logged_at`` takes the time from the rows themselves instead of the run.
    """
    moment = load_time(run) if logged_at is None else logged_at
    return variables.select(
        F.lit(1).alias("row_gid"), *VARIABLE_COLUMNS, F.date_trunc("second", moment).alias("dqi_ts")
    )
