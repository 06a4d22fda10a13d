from collections import Counter

import pytest
from pyspark.sql import functions as F

from rxsieve import params as p
from rxsieve.operators.quality import SEPARATOR, issue_counts, issues_per_row, validate_quality, validate_target_indicator
from rxsieve.params import CampaignParams
from rxsieve.rules.gates import rules_for
from rxsieve.workload import inputs
from rxsieve.workload.rule_sql import RULE_SQL

CLEAN = {
    "rec_type": "I", "b_g": "A", "ms_ss": "A", "gpi": "", "ndc11": "", "ndc9": "123456789", "gpi_raw": "",
    "ndc11_raw": "", "sql_join": "", "gpi_len": 0, "ast": 0, "age_min": 0, "age_max": 999,
}
INTEGERS = {"gpi_len", "ast", "age_min", "age_max", "_exceed_rlimit", "_exceed_mlimit"}
MISSING = [None, "", " ", "   "]


def frame(spark, *rows):
    names = list(rows[0])
    kinds = {n: "int" if n in INTEGERS else "date" if "DATE" in n else "string" for n in names}
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(f"`{n}` {k}" for n, k in kinds.items()))


def messages(spark, run, **values):
    rows = validate_quality(frame(spark, CLEAN | values), run).collect()
    return rows[0]["validation_msg"].split("; ") if rows else []


PLAIN = CampaignParams(campaign_id=24)


def numbers(spark, columns=(), **run):
    return {r.number for r in rules_for(CampaignParams(**run), columns)}


COMMON = {1, 2, 78, *range(86, 105)}
NOT_TIER, TIER = COMMON | {72}, COMMON | {71}
MESSAGE_COLUMNS = [f"DrugMsg_IB{i}" for i in range(1, 13)]


@pytest.mark.parametrize(
    ("run", "rules"),
    [
        ({"campaign_id": 1}, NOT_TIER),
        *(({"campaign_id": c}, TIER) for c in (60, 61, 553, 562)),
        *(({"campaign_id": c}, NOT_TIER | set(range(3, 24))) for c in (30, 35, 45, 556)),
        ({"campaign_id": 63, "context": p.INTAKE_FDRO_ANA.lower()}, NOT_TIER | set(range(3, 24))),
        ({"campaign_id": 63}, NOT_TIER | set(range(24, 41))),
        ({"campaign_id": 79, "context": p.INTAKE_FDRO_ANA}, NOT_TIER | set(range(3, 24))),
        ({"campaign_id": 79, "context": p.INTAKE_ACF}, NOT_TIER | set(range(24, 41))),
        ({"campaign_id": 79, "context": p.INTAKE_BC_EX_BOB}, NOT_TIER | set(range(41, 71))),
        ({"campaign_id": 79}, NOT_TIER),
        *(({"campaign_id": c}, NOT_TIER | set(range(24, 41))) for c in (26, 54, 551)),
        ({"campaign_id": 81, "context": p.INTAKE_ACFBF_EX_BOB}, NOT_TIER | set(range(24, 41))),
        ({"campaign_id": 81, "context": p.INTAKE_BC_EX_BOB}, NOT_TIER | set(range(41, 71))),
        ({"campaign_id": 96, "context": p.INTAKE_ACFBF_EX_BOB}, NOT_TIER | set(range(24, 41))),
        ({"campaign_id": 96, "context": p.INTAKE_VF_EX_BOB}, NOT_TIER | set(range(108, 155))),
        ({"campaign_id": 566}, NOT_TIER | set(range(41, 71))),
        *(({"campaign_id": c}, NOT_TIER | {73, 74, 75, 76}) for c in (20, 558)),
        *(({"campaign_id": c}, NOT_TIER | {76}) for c in (28, 34, 557)),
        ({"campaign_id": 67}, NOT_TIER | {77, 80, 81, 82, 83}),
        ({"campaign_id": 554, "bob_run_type": "IB"}, NOT_TIER | {77, 80, 81, 82, 83, 84}),
        ({"campaign_id": 66}, NOT_TIER | {80, 81, 82, 83, 85}),
        ({"campaign_id": 54, "bob_run_type": "IB"}, NOT_TIER | set(range(24, 41)) | {84}),
        ({"campaign_id": 24, "context": p.INTAKE}, NOT_TIER | {79, 105, 106, 107}),
        *(({"campaign_id": c}, NOT_TIER | set(range(108, 155))) for c in (23, 89, 567)),
        *(({"campaign_id": c}, NOT_TIER | {155, 156}) for c in (52, 53, 563)),
        ({"campaign_id": 52, "opioid_dose_bypass": "Y"}, NOT_TIER),
    ],
)
def test_gates(spark, run, rules):
    assert numbers(spark, MESSAGE_COLUMNS, **run) == rules


def test_every_rule_is_reachable_with_its_message(spark):
    runs = [
        {"campaign_id": 30}, {"campaign_id": 26}, {"campaign_id": 566}, {"campaign_id": 60}, {"campaign_id": 20},
        {"campaign_id": 554, "bob_run_type": "IB"}, {"campaign_id": 66}, {"campaign_id": 24, "context": p.INTAKE},
        {"campaign_id": 567}, {"campaign_id": 52},
    ]
    found = {(r.number, r.message) for run in runs for r in rules_for(CampaignParams(**run), MESSAGE_COLUMNS)}
    assert found == {(n, message) for rules in RULE_SQL.values() for n, _, message in rules}
    assert {n for n, _ in found} == set(range(1, 157))
    assert not [message for _, message in found if SEPARATOR.strip() in message]


def test_clean_row_is_not_reported(spark):
    assert messages(spark, PLAIN) == []


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        ({"rec_type": None}, ["Invalid rec type"]),
        ({"rec_type": "I "}, ["Invalid rec type"]),
        ({"b_g": "g"}, []),
        ({"b_g": "Z"}, ["Invalid B_G indicator"]),
        ({"b_g": None}, []),
        ({"b_g": "Z", "rec_type": "E"}, []),
        ({"ms_ss": "M"}, ["Invalid MS_SS indicator"]),
        *(({"ndc9": v}, ["GPI and NDC are blank"]) for v in MISSING),
        ({"ndc9": "12345678*"}, ["Invalid NDC9"]),
        ({"ndc9": "1234-6789"}, ["Invalid NDC9"]),
        ({"ndc9": "1.2E+09"}, ["Invalid NDC9 length", "Invalid NDC9"]),
        ({"ndc9": "1.2e+0999"}, ["Invalid NDC9"]),
        ({"ndc9": "1234,6789"}, ["Multiple values separated by comma in one cell"]),
        ({"ndc11": "1234567890"}, ["Invalid NDC11 length"]),
        ({"ndc11": "123%", "ndc11_raw": "123*", "sql_join": "WILDCARD"}, []),
        ({"ndc11": "12345-78901"}, ["Invalid NDC11"]),
        ({"gpi": "12", "gpi_raw": "12", "gpi_len": 2}, []),
        ({"gpi": "123", "gpi_raw": "123", "gpi_len": 3}, ["Invalid GPI length"]),
        ({"gpi": "1234%", "gpi_raw": "1234*", "gpi_len": 4, "ast": 5}, []),
        ({"gpi": "12%34", "gpi_raw": "12*34", "gpi_len": 2, "ast": 3}, ["Invalid GPI"]),
        ({"gpi": "%12", "gpi_raw": "*12", "gpi_len": 3, "ast": 1}, ["Invalid GPI length", "Invalid GPI", "Invalid GPI"]),
        ({"gpi": "1" * 16, "gpi_len": 16}, ["Invalid GPI length", "Invalid GPI length"]),
        ({"gpi": "12", "gpi_len": 2, "b_g": "b"}, ["B_G must be specified with GPI"]),
        ({"gpi": "12", "gpi_len": 2, "b_g": " ", "ms_ss": None}, ["B_G must be specified with GPI", "MS_SS must be specified with GPI"]),
    ],
)
def test_common_rules(spark, values, expected):
    assert messages(spark, PLAIN, **values) == expected


def test_required_text_in_every_spelling_of_missing(spark):
    run = CampaignParams(campaign_id=30)
    names = list(inputs.FAMILIES["fdro"])
    good = dict.fromkeys(names, "text") | {
        "GRDFTHR": "y", "class": "msb", "INSULIN_CALL": "N", "add_back_merge_drug_hyper_ind": " ",
        "RXCHANGE_SPC": "N", "RXCHANGE_MAIL": "Y", "RXCHANGE_RETAIL": "N",
    }
    assert messages(spark, run, **good) == []
    for missing in MISSING:
        assert messages(spark, run, **good | {"Lbl_Name": missing}) == ["Label Name cannot be blank"]
        assert messages(spark, run, **good | {"HYPER_ALTERNATIVE_TEXT": missing, "PTHYPERSTELLENT": missing}) == [
            "HYPER ALTERNATIVE TEXT cannot be blank"
        ]
        both = good | {"HYPER_ALTERNATIVE_TEXT": missing, "PTHYPERSTELLENT": missing, "MDHYPERSTELLENT": missing}
        assert messages(spark, run, **both) == []
        assert messages(spark, run, **good | {"GRDFTHR": missing, "INSULIN_CALL": missing}) == [
            "Invalid Insulin calls Value"
        ]


def test_intake_form_rules_and_dropped_columns(spark):
    run = CampaignParams(campaign_id=24, context=p.INTAKE)
    working = {"_exceedlmt": "010010", "_exceed_rlimit": 1, "_exceed_mlimit": 0}
    rows = validate_quality(frame(spark, CLEAN | working | {"ndc11": "12345678901"}), run)
    assert not [c for c in rows.columns if c.startswith("_")]
    assert rows.first()["validation_msg"] == (
        "Only 1 of NDC11, NDC9 or GPI can be populated; retail qty unit exceeds 200 char; "
        "mail qty unit exceeds 200 char; Combined retail quantity limit fields exceeds 200 char"
    )
    assert messages(spark, run, **working | {"_exceedlmt": None, "_exceed_rlimit": None}) == []


def test_optional_message_columns(spark):
    run = CampaignParams(campaign_id=66)
    given = {"gf": None, "RXCHANGE_SPC": "N", "RXCHANGE_MAIL": "N", "RXCHANGE_RETAIL": "N", "DrugMsg_IB12": "x" * 301}
    assert messages(spark, run, **given) == ["Invalid Length of DrugMsg_IB12"]
    assert messages(spark, run, **given | {"DrugMsg_IB12": "x" * 300}) == []


def test_opioid_rules(spark):
    run = CampaignParams(campaign_id=52)
    given = {"alternative_text": " exclude ", "opioid_daily_dose_limit": None, "opioid_daily_dose_text": None}
    assert messages(spark, run, **given) == []
    assert messages(spark, run, **given | {"alternative_text": None}) == ["Invalid Daily Dose Limit", "Missing Daily Dose Text"]


def test_repeated_rows_are_reported_once(spark):
    bad = CLEAN | {"rec_type": None}
    rows = frame(spark, bad, bad, CLEAN, bad | {"age_min": 7})
    assert validate_quality(rows, PLAIN).count() == 2
    assert issue_counts(rows, PLAIN).collect()[0].asDict() == {"message": "Invalid rec type", "n_issues": 2}


def test_issue_positions(spark):
    rows = issues_per_row(frame(spark, CLEAN | {"ndc9": "1.2E+09"}), PLAIN, ["ndc9"]).orderBy("position").collect()
    assert [(r.position, r.message) for r in rows] == [(0, "Invalid NDC9 length"), (1, "Invalid NDC9")]


def test_rules_run_once_without_a_filter_below(spark):
    plan = validate_quality(frame(spark, CLEAN), PLAIN)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Invalid rec type") == 1


FORMULARY = [(v, f, t) for v in ("N", "t", "T", "X", None, "", "e") for f, t in (("1", "2"), (" ", "2"), ("1", None))]


@pytest.mark.parametrize(
    ("run", "expected"),
    [
        (CampaignParams(campaign_id=561, run_type="CF"), Counter({"X": 3, None: 3, "": 3})),
        (CampaignParams(campaign_id=64), Counter({"X": 3, None: 3, "": 3})),
        (CampaignParams(campaign_id=64, run_type="CF"), Counter({"X": 3, None: 3, "": 3, "t": 2, "T": 2})),
        (CampaignParams(campaign_id=65, run_type="CF"), Counter()),
    ],
)
def test_target_indicator(spark, run, expected):
    rows = spark.createDataFrame(FORMULARY + FORMULARY, "drug_tgt_ind string, tier_from string, tier_to string")
    assert Counter(r.drug_tgt_ind for r in validate_target_indicator(rows, run).collect()) == expected


def test_wide_rows_are_dealt_out_before_they_are_gathered(spark):
    """A task that reads a whole file must not hold its rows to find repeated ones."""
    report = validate_quality(frame(spark, *[CLEAN | {"rec_type": "Z", "ndc9": f"{k % 70:09d}"} for k in range(200)]), PLAIN)
    assert report.count() == len(report.collect()) == 70
    executed = report._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in executed[: executed.index("Exchange")] and "HashAggregate" not in executed[executed.index("Exchange") :].split("Initial Plan")[0]
    assert executed.split("Initial Plan")[-1].count("Exchange") == 1


def test_a_constant_column_costs_no_second_shuffle(spark):
    """Normalising adds columns with one value, which Spark takes out of an aggregate's keys."""
    report = validate_quality(frame(spark, *[CLEAN | {"rec_type": "Z", "ndc9": f"{k % 70:09d}"} for k in range(200)]).withColumn("constant", F.lit(0)), PLAIN)
    rows = report.collect()
    assert len(rows) == len(set(rows)) == 70 and report.columns[-2:] == ["constant", "validation_msg"]
    assert report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange") == 1


def test_rows_far_wider_than_their_table_are_dealt_out_first(spark, tmp_path):
    spark.range(1000).selectExpr("id as p_partkey", "'Brand#12' p_brand", "1 p_size", "'name' p_name", "'type' p_type").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    read = lambda spread: inputs.read_input(spark, str(tmp_path), inputs.family_rows("vf"), spread)
    assert read(False).rdd.getNumPartitions() == 1 < read(True).rdd.getNumPartitions()
    assert sorted(map(repr, read(True).collect())) == sorted(map(repr, read(False).collect()))
