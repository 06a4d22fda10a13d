import pytest

from rxsieve.operators.normalize import normalize_drug_rows
from rxsieve.params import INTAKE, CampaignParams

SCHEMA = (
    "age_min int, age_max int, gpi string, ndc11 string, ndc9 string, b_g string, ms_ss string, drug_category string, "
    "retail_qty_limit string, retail_qty_unit string, retail_qty_time string, "
    "mail_qty_limit string, mail_qty_unit string, mail_qty_time string"
)
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
PLAIN = CampaignParams(campaign_id=24)
FORM = CampaignParams(campaign_id=24, context=INTAKE)


def normalized(spark, run=PLAIN, **values):
    frame = spark.createDataFrame([tuple(values.get(n) for n in NAMES)], SCHEMA)
    return normalize_drug_rows(frame, run).first().asDict()


@pytest.mark.parametrize(
    ("given", "low", "high"), [((None, None), 0, 999), ((0, 0), 0, 999), ((18, 65), 18, 65), ((5, None), 5, 999)]
)
def test_ages(spark, given, low, high):
    row = normalized(spark, age_min=given[0], age_max=given[1])
    assert (row["age_min"], row["age_max"]) == (low, high)


@pytest.mark.parametrize(
    ("gpi", "stem", "length", "converted", "star", "join"),
    [
        ("1234*", "1234", 4, "1234%", 5, "WILDCARD"),
        ("12*34", "12", 2, "12%34", 3, "WILDCARD"),
        ("1*", "1", 1, "1%", 2, "WILDCARD"),
        ("*12", "%12", 3, "%12", 1, "WILDCARD"),
        ("12?4", "12_4", 4, "12_4", 0, "WILDCARD"),
        (" 1234 ", "1234", 4, " 1234 ", 0, ""),
        ("", "", 0, "", 0, ""),
        (" ", "", 0, " ", 0, ""),
        (None, "", 0, None, 0, ""),
    ],
)
def test_gpi(spark, gpi, stem, length, converted, star, join):
    row = normalized(spark, gpi=gpi)
    got = (row["drug_sub"], row["gpi_len"], row["gpi"], row["ast"], row["sql_join"], row["gpi_raw"])
    assert got == (stem, length, converted, star, join, gpi)
    assert (row["druglvl"], row["drug_code"]) == (("GPI", stem) if stem else (None, None))


@pytest.mark.parametrize(
    ("codes", "level", "code", "join"),
    [
        ({"ndc11": "12345678*", "ndc9": "1", "gpi": "2"}, "NDC11", "12345678%", "WILDCARD"),
        ({"ndc11": "1234567890?"}, "NDC11", "1234567890_", "WILDCARD"),
        ({"ndc11": " ", "ndc9": "123456789", "gpi": "12*"}, "NDC9", "123456789", ""),
        ({"ndc9": "12345678*"}, "NDC9", "12345678*", ""),
        ({}, None, None, ""),
    ],
)
def test_code_level(spark, codes, level, code, join):
    row = normalized(spark, **codes)
    assert (row["druglvl"], row["drug_code"], row["sql_join"]) == (level, code, join)


def test_indicator_defaults(spark):
    assert [normalized(spark, b_g=v)["b_g"] for v in (None, "", "  ", "B")] == ["A", "A", "A", "B"]
    # On the intake form a GPI row keeps its blank, for the rules to report.
    assert normalized(spark, FORM, gpi="12", ms_ss=" ")["ms_ss"] == " "
    assert normalized(spark, FORM, gpi="12", ms_ss=None)["ms_ss"] is None
    assert normalized(spark, FORM, gpi=" ", ms_ss=None)["ms_ss"] == "A"


def limits(spark, run, limit=None, unit=None, time=None):
    row = normalized(spark, run, retail_qty_limit=limit, retail_qty_unit=unit, retail_qty_time=time)
    return row["rlimit"], row["_exceed_rlimit"], row["mlimit"]


def test_standard_limits(spark):
    assert limits(spark, PLAIN, " 30 ", "tabs", "10") == ("30 tabs/10 days", 0, " ")
    assert limits(spark, PLAIN, "30") == ("30 / days", 0, " ")
    assert limits(spark, PLAIN, "", " ", None) == (" ", 0, " ")
    assert limits(spark, PLAIN, "", ".", "5")[0] == " "
    assert limits(spark, PLAIN, "1", "x" * 300)[0] == "1 " + "x" * 300 + "/ days"


def test_intake_form_limits(spark):
    fits = "x" * (200 - len("1 /2 days"))
    assert limits(spark, FORM, "1", fits, "2") == (f"1 {fits}/2 days", 0, " ")
    text, flag, _ = limits(spark, FORM, "1", fits + "x", "2")
    assert (len(text), flag) == (200, 1)
    assert limits(spark, FORM, None, ".", None) == (" ", 0, " ")


def test_limits_by_campaign(spark):
    for campaign in (67, 68, 554):
        run = CampaignParams(campaign_id=campaign, context=INTAKE)
        assert limits(spark, run, " 30 ", "tabs", "10") == ("30", 0, " ")
        assert limits(spark, run, None, "tabs", None) == ("", 0, " ")
    for run in (CampaignParams(campaign_id=66), CampaignParams(campaign_id=20), CampaignParams(campaign_id=558)):
        assert limits(spark, run, "30", "tabs", "10") == (None, 0, None)
    client = CampaignParams(campaign_id=20, client_specific="Y")
    assert limits(spark, client, "30", "tabs", "10")[0] == "30 tabs/10 days"
    # The form's context comes before the exemption.
    assert limits(spark, CampaignParams(campaign_id=66, context=INTAKE), "30", "tabs", "10")[0] == "30 tabs/10 days"


def test_category_and_absent_columns(spark):
    assert normalized(spark, drug_category=" ANTI ")["drugcat"] == "ANTI"
    bare = normalize_drug_rows(spark.createDataFrame([("12*",)], "gpi string"), PLAIN).first()
    assert (bare.age_max, bare.druglvl, bare.drug_code, bare.b_g, bare.drugcat) == (999, "GPI", "12", "A", "")


def test_text_ages(spark):
    frame = spark.createDataFrame([("0", ""), ("18", "65")], "age_min string, age_max string")
    assert [(r.age_min, r.age_max) for r in normalize_drug_rows(frame, PLAIN).collect()] == [("0", "999"), ("18", "65")]
