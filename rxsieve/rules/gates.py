"""Which rule families a campaign switches on.

Campaign and context are constants of a run, so families that are off never
enter the plan.
"""

from __future__ import annotations

from collections.abc import Iterable

from rxsieve import params as p
from rxsieve.params import CampaignParams
from rxsieve.rules import acf, bc, common, fdro, formulary, intake, opioid, value_formulary
from rxsieve.rules.base import Rule

# Campaigns per family, and campaigns that count only in one context.
FDRO, FDRO_IN_CONTEXT = (30, 35, 45, 556), {63: p.INTAKE_FDRO_ANA, 79: p.INTAKE_FDRO_ANA}
ACF = (26, 54, 551)
ACF_IN_CONTEXT = {79: p.INTAKE_ACF, 81: p.INTAKE_ACFBF_EX_BOB, 96: p.INTAKE_ACFBF_EX_BOB}
BC, BC_IN_CONTEXT = (566,), {79: p.INTAKE_BC_EX_BOB, 81: p.INTAKE_BC_EX_BOB}
VALUE_FORMULARY, VALUE_FORMULARY_IN_CONTEXT = (23, 89, 567), {96: p.INTAKE_VF_EX_BOB}
TIER = (60, 61, 553, 562)
HEALTH_EXCHANGE = (20, 558)
STEP_THERAPY = (20, 28, 34, 557, 558)
BALANCE = (67, 554)
GRANDFATHER = (66, 67, 554)
DRUG_MESSAGES = (54, 81, 96, 554)
CLIENT_DRUG_MESSAGES = (66,)
OPIOID = (52, 53, 563)


def _listed(run: CampaignParams, always: tuple[int, ...], in_context: dict[int, str]) -> bool:
    needed = in_context.get(run.campaign_id)
    return run.campaign_id in always or (needed is not None and run.in_context(needed))


def rules_for(run: CampaignParams, columns: Iterable[str]) -> list[Rule]:
    """The rules of a run in message order."""
    present = {c.lower() for c in columns}
    campaign = run.campaign_id
    is_fdro = _listed(run, FDRO, FDRO_IN_CONTEXT)
    # Campaign 63 has two intake files: the FDRO one, and otherwise the ACF one.
    is_acf = _listed(run, ACF, ACF_IN_CONTEXT) or (campaign == 63 and not is_fdro)

    active = common.record_rules() + common.code_rules(present)
    active += common.tier_rules() if campaign in TIER else common.not_tier_rules()
    if is_fdro:
        active += fdro.fdro_rules()
    if is_acf:
        active += acf.acf_rules()
    if _listed(run, BC, BC_IN_CONTEXT):
        active += bc.bc_rules()
    if campaign in HEALTH_EXCHANGE:
        active += formulary.health_exchange_rules()
    if campaign in STEP_THERAPY:
        active += formulary.step_therapy_rules()
    elif campaign in BALANCE:
        active += formulary.balance_rules()
    if campaign in GRANDFATHER:
        active += formulary.grandfather_rules()
    if campaign in DRUG_MESSAGES and run.bob_run_type == "IB":
        active += formulary.drug_message_rules(84, present)
    if campaign in CLIENT_DRUG_MESSAGES:
        active += formulary.drug_message_rules(85, present)
    if run.in_context(p.INTAKE):
        active += intake.intake_rules()
    if _listed(run, VALUE_FORMULARY, VALUE_FORMULARY_IN_CONTEXT):
        active += value_formulary.value_formulary_rules()
    if campaign in OPIOID and run.opioid_dose_bypass == "N":
        active += opioid.opioid_rules()
    return sorted(active, key=lambda rule: rule.number)
