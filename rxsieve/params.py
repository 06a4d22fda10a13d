"""Run parameters: one frozen object instead of process-wide variables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Names a caller passes as the context of a run.
INTAKE = "M_INTAKE_FORM_DRUG"
INTAKE_FDRO_ANA = "M_INTAKE_FORM_DRUG_FDRO_ANA"
INTAKE_ACF = "M_INTAKE_FORM_DRUG_ACF"
INTAKE_ACFBF_EX_BOB = "M_INTAKE_FORM_DRUG_ACFBF_EX_BOB"
INTAKE_BC_EX_BOB = "M_INTAKE_FORM_DRUG_BC_EX_BOB"
INTAKE_VF_EX_BOB = "M_INTAKE_FORM_DRUG_VF_EX_BOB"

# Campaigns whose drug rows carry MONY, Rx and OTC switches.
MONY_CAMPAIGNS = (66, 67, 554)

# Fixed value: campaigns from this id on are triage campaigns.
FIRST_TRIAGE_CAMPAIGN = 500


@dataclass(frozen=True)
class CampaignParams:
    """Everything a run needs to know besides its tables.

    ``run_ts`` stands for the clock, so that a rerun gives the same rows.
    """

    campaign_id: int = 0
    context: str = ""
    client_specific: str = "N"
    run_type: str = ""
    bob_run_type: str = ""
    opioid_dose_bypass: str = "N"
    program_type: str = ""
    formulary_run_type: str = ""
    production: str = "N"
    main_dir: str = ""
    email_subject: str = ""
    project_schema: str = ""
    # Fixed values as defaults: the directory part that marks a test installation, applications, history tables.
    test_directory: str = "bss_test"
    test_application: str = "MDP"
    application: str = "DQI"
    production_history: str = "dqi_process_macros"
    development_history: str = "dqi_process_macros_dev"
    run_ts: dt.datetime | None = None

    def in_context(self, name: str) -> bool:
        return self.context.upper() == name

    @property
    def has_mony_switches(self) -> bool:
        return self.campaign_id in MONY_CAMPAIGNS

    @property
    def is_triage(self) -> bool:
        return self.campaign_id >= FIRST_TRIAGE_CAMPAIGN
