import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rxsieve.operators import checks
from rxsieve.params import CampaignParams
from rxsieve.plans.intake import checked, discard_matches, validate_intake
from rxsieve.sources import tables
from tests.conftest import rows_of

COLUMNS = ["rec_type", "drug_defn", "drug_id", "drug_desc", "druglvl", "b_g", "ms_ss", "brnd_gnrc_cd",
           "drug_multi_src_cd", "pbm_drug_multi_src_cd", "otc_drug_ind", "mony_m", "mony_o", "mony_n", "mony_y",
           "rx", "otc", "ndc9", "ndc11", "gpi"]


def validity(spark, *rows):
    data = [tuple(r.get(c) for c in COLUMNS) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in COLUMNS))


def row(rec_type, defn, drug_id, desc, **more):
    return {"rec_type": rec_type, "drug_defn": defn, "drug_id": drug_id, "drug_desc": desc, **more}


@pytest.mark.parametrize(
    ("values", "kept"),
    [
        ({"b_g": "B", "brnd_gnrc_cd": "GNRC"}, False),
        ({"b_g": "G", "brnd_gnrc_cd": "BRND"}, False),
        ({"b_g": "B", "brnd_gnrc_cd": "BRND"}, True),
        ({"b_g": "B", "brnd_gnrc_cd": None}, True),
        ({"b_g": None, "brnd_gnrc_cd": "GNRC"}, True),
        ({"ms_ss": "MS", "drug_multi_src_cd": "SINGLE"}, False),
        ({"ms_ss": "M", "drug_multi_src_cd": "SINGLE"}, False),
        ({"ms_ss": "S", "drug_multi_src_cd": "MULTI"}, False),
        ({"ms_ss": "SS", "drug_multi_src_cd": None}, True),
        ({"ms_ss": "SS", "drug_multi_src_cd": "MULTI", "b_g": None}, False),
    ],
)
def test_prune_generic(spark, values, kept):
    frame = validity(spark, row("I", "PBM ", "1", "x", **values))
    assert checks.prune_matches(frame, CampaignParams(campaign_id=30)).count() == int(kept)


@pytest.mark.parametrize(
    ("values", "kept"),
    [
        ({"mony_m": "E", "pbm_drug_multi_src_cd": "M"}, False),
        ({"mony_m": "E", "pbm_drug_multi_src_cd": "O"}, True),
        ({"mony_y": "E", "pbm_drug_multi_src_cd": "Y"}, False),
        ({"mony_o": "E", "pbm_drug_multi_src_cd": None}, True),
        ({"rx": "E", "otc_drug_ind": None}, False),
        ({"rx": "E", "otc_drug_ind": "N"}, False),
        ({"rx": "E", "otc_drug_ind": "Y"}, True),
        ({"otc": "E", "otc_drug_ind": "Y"}, False),
        ({"otc": "E", "otc_drug_ind": None}, True),
        ({"otc": None, "otc_drug_ind": "Y"}, True),
        ({"rx": "E", "otc_drug_ind": None, "druglvl": "NDC9"}, True),
        ({"rx": "E", "otc_drug_ind": None, "druglvl": None}, True),
        ({"b_g": "B", "brnd_gnrc_cd": "GNRC"}, True),
    ],
)
def test_prune_by_switches(spark, values, kept):
    frame = validity(spark, row("I", "PBM ", "1", "x", **({"druglvl": "GPI"} | values)))
    assert checks.prune_matches(frame, CampaignParams(campaign_id=66)).count() == int(kept)


@pytest.fixture
def duplicated(spark):
    return validity(
        spark,
        # Duplicated under both definitions: the report lists every row twice.
        row("I", "PBM ", "1", "a"), row("I", "PBM ", "1", "b"), row("I", "MDDB", "1", "a"), row("I", "MDDB", "1", "b"),
        # Duplicated under one: its clean MDDB row is listed as well.
        row("I", "PBM ", "2", "a"), row("I", "PBM ", "2", "b"), row("I", "MDDB", "2", "c"),
        # Clean, and the same product as an exclusion.
        row("I", "PBM ", "3", "a"), row("E", "PBM ", "1", "a"),
        # Products without id form a group but join with nothing.
        row("I", "PBM ", None, "n"), row("I", "PBM ", None, "m"),
    )


def test_duplicate_groups(duplicated):
    assert rows_of(checks.duplicate_groups(duplicated)) == sorted(
        [("I", "PBM ", "1", 2), ("I", "MDDB", "1", 2), ("I", "PBM ", "2", 2), ("I", "PBM ", None, 2)], key=repr
    )


def test_duplicate_report_fans_out(duplicated):
    listed = Counter((r.rec_type, r.drug_id, r.drug_desc) for r in checks.duplicate_report(duplicated).collect())
    assert listed == {("I", "1", "a"): 4, ("I", "1", "b"): 4, ("I", "2", "a"): 1, ("I", "2", "b"): 1, ("I", "2", "c"): 1}


def test_duplicate_rows_once_each(duplicated):
    listed = Counter((r.drug_defn, r.drug_id, r.drug_desc) for r in checks.duplicate_rows(duplicated).collect())
    assert set(listed.values()) == {1}
    assert ("MDDB", "2", "c") not in listed and ("PBM ", None, "n") in listed and len(listed) == 8


def test_duplicates_without_broadcast(duplicated, shuffled_joins):
    assert checks.duplicate_rows(duplicated).count() == 8
    assert checks.duplicate_report(duplicated).count() == 11


def exclusions(spark, included, excluded):
    rows = [row("I", "PBM ", i, "x") for i in included] + [row("E", "PBM ", e, "x") for e in excluded]
    return [r.drug_id for r in checks.invalid_exclusions(validity(spark, *rows)).orderBy("drug_id").collect()]


def test_exclusions_keep_repeats(spark):
    assert exclusions(spark, ["1", "2", "2"], ["1", "3", "3"]) == ["3", "3"]


def test_exclusions_with_unknown_inclusion(spark):
    assert exclusions(spark, ["1", None], ["1", "3"]) == []


def test_exclusions_with_unknown_exclusion(spark):
    assert exclusions(spark, ["1"], ["1", None, "4"]) == ["4"]


def test_exclusions_without_inclusions(spark):
    assert exclusions(spark, [], ["1", None]) == [None, "1"]


def test_exclusions_shuffle_instead_of_collecting(spark, shuffled_joins):
    assert exclusions(spark, ["1", "2"], ["2", "5"]) == ["5"]


def test_intake_plan(spark):
    drugs = spark.createDataFrame(
        [("I", "00000000001", "NDC11", "a"), ("I", "00000000%", "NDC11", "b"), ("E", "99", "GPI", "c")],
        "rec_type string, drug_code string, druglvl string, drug_desc string",
    ).selectExpr("*", "'' as ndc9", "'' as ndc11", "'' as gpi", "'A' as b_g", "'A' as ms_ss")
    catalog = spark.createDataFrame(
        [(1, "00000000001", "0101"), (2, "00000000002", "9999")], "drug_prod_gid long, drug_id string, gpi_cd string"
    ).selectExpr(
        "*", "'BRND' as brnd_gnrc_cd", "'MULTI' as drug_multi_src_cd", "'M' as pbm_drug_multi_src_cd",
        "'BRND' as mddb_brnd_gnrc_cd", "'MULTI' as mddb_drug_multi_src_cd", "'M' as mddb_multsrc_cd",
        "'N' as otc_drug_ind",
    )
    run = CampaignParams(campaign_id=30)
    left = lambda: {f for k in ("spark.checkpoint.dir", "spark.sql.warehouse.dir") for f in Path(spark.conf.get(k).removeprefix("file:")).rglob("*")}
    before = left()
    lazy = validate_intake(drugs, catalog, run)
    assert lazy.duplicates.count() == 8 and left() == before
    for _ in range(2):  # the table is rebuilt
        result = validate_intake(drugs, catalog, run, table="drug_validity")
    assert spark.table("drug_validity").count() == result.validity.count() == lazy.validity.count() == 8
    assert [r.drug_id for r in result.inclusions_table.collect()] == sorted(r.drug_id for r in result.inclusions_table.collect())
    assert Counter(r.drug_desc for r in result.duplicates.collect()) == {"a": 4, "b": 4}
    assert result.exclusions.count() == 0
    assert result.inclusions_table.count() == 6 and result.exclusions_table.count() == 2
    tables.drop_table(spark, "drug_validity")
    assert not tables.table_exists(spark, "drug_validity")


@pytest.mark.parametrize("seed", range(6))
def test_counts_in_one_pass(spark, seed):
    """As many as the reports have rows, with NULLs, without inclusions, and without rows."""
    rng = random.Random(seed)
    ids = ["1", "2", "3", None] if seed % 2 else ["1", "2", "3", "4"]
    kinds = ["E", None] if seed == 4 else ["I", "E", "E", None]
    rows = [row(rng.choice(kinds), rng.choice(["PBM ", "MDDB"]), rng.choice(ids), str(k)) for k in range(0 if seed == 5 else 14)]
    frame = validity(spark, *rows)
    counts = checks.finding_counts(frame).first()
    assert tuple(counts) == (checks.duplicate_report(frame).count(), checks.invalid_exclusions(frame).count())
    assert rows_of(checks.duplicate_report_by_product(frame)) == rows_of(checks.duplicate_report(frame))


def test_bucketed_matches_are_not_shuffled_again(spark):
    rows = [row("I" if k % 3 else "E", "PBM ", str(k % 40), str(k)) for k in range(200)]
    tables.replace_table(validity(spark, *rows), "bucketed_matches", ["drug_id"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = checked(tables.read_table(spark, "bucketed_matches"), bucketed=True)
        for frame in (found.duplicates, found.exclusions):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan
            # the facts about all inclusions are one row
            assert [line for line in plan.splitlines() if "Exchange" in line and "SinglePartition" not in line] == []
        assert rows_of(found.duplicates) == rows_of(checks.duplicate_report(validity(spark, *rows)))
        assert rows_of(found.exclusions) == rows_of(checks.invalid_exclusions(validity(spark, *rows)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        discard_matches(spark, "bucketed_matches")
    assert not tables.table_exists(spark, "bucketed_matches")
    discard_matches(spark, "bucketed_matches")


def test_delete_writes_only_what_loses_rows(spark):
    """MONY switches delete GPI rows alone: the files of the other levels stay, a level that loses all rows goes, unknown conditions keep."""
    run = CampaignParams(campaign_id=66)
    gone = {"mony_m": "E", "pbm_drug_multi_src_cd": "M"}
    rows = [row("I", "PBM ", str(k), "d", druglvl=level, **(gone if k % 2 else {})) for k, level in enumerate(["GPI", "GPI", "NDC9", "NDC9", "NDC11", None, None])]
    rows.append(row("I", "PBM ", "9", "d", druglvl="GPI", mony_m="E", rx="I"))
    frame = validity(spark, *rows)
    tables.replace_table(frame, "stored_matches", partitions=["druglvl"])
    try:
        before = set(spark.table("stored_matches").inputFiles())
        assert tables.delete_rows(spark, "stored_matches", checks.contradicts(run), ["druglvl"]) == 1
        after = set(spark.table("stored_matches").inputFiles())
        assert {f for f in before if "druglvl=GPI" not in f} == {f for f in after if "druglvl=GPI" not in f} != after
        assert rows_of(spark.table("stored_matches").select(COLUMNS)) == rows_of(checks.prune_matches(frame, run).select(COLUMNS))
        assert tables.delete_rows(spark, "stored_matches", checks.contradicts(run), ["druglvl"]) == 0
        assert tables.delete_rows(spark, "stored_matches", F.col("drug_id") == "4", ["druglvl"]) == 1
        assert rows_of(spark.table("stored_matches").select("druglvl").distinct()) == [("GPI",), ("NDC9",), (None,)]
    finally:
        tables.drop_table(spark, "stored_matches")


def test_checks_broadcast_nothing(spark, tmp_path):
    """What the checks join with grows with the matches, so it must not pass through the driver for looking small."""
    rows = [row(("I", "E")[k % 3 == 0], "PBM ", str(k % 400), "x" if k < 400 else "y") for k in range(600)]
    validity(spark, *rows).write.parquet(str(tmp_path / "matches"))
    stored = spark.read.parquet(str(tmp_path / "matches"))
    gathered = stored.distinct()
    found = {f"{check.__name__} {kind}": check(frame) for check in (checks.duplicate_report, checks.duplicate_rows, checks.invalid_exclusions, checks.duplicate_report_by_product) for kind, frame in (("stored", stored), ("gathered", gathered))}
    for name, frame in found.items():
        assert frame.collect(), name
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan, name
