"""The equi-join match against the definition: LIKE over all pairs, in plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rxsieve.operators import match
from rxsieve.operators.match import DRUG_COLUMNS, MDDB, MONY_COLUMNS, PBM, PRODUCT_COLUMNS, drug_validity, match_products
from rxsieve.params import CampaignParams
from tests.conftest import rows_of

DRUG_SCHEMA = ", ".join(f"{c} string" for c in DRUG_COLUMNS)
PRODUCT_SCHEMA = "drug_prod_gid long, " + ", ".join(f"{c} string" for c in PRODUCT_COLUMNS[1:])


def like(text, pattern):
    parts = {"_": ".", "%": ".*"}
    return re.fullmatch("".join(parts.get(c, re.escape(c)) for c in pattern), text, re.S) is not None


def matches(drug, product):
    level, code = drug["druglvl"], drug["drug_code"]
    if code is None or not code.strip():
        return False
    if level == "NDC11":
        return product["drug_id"] is not None and like(product["drug_id"], code)
    if level == "NDC9":
        return product["drug_id"] is not None and product["drug_id"][:9] == code
    if level == "GPI":
        return product["gpi_cd"] is not None and like(product["gpi_cd"].strip(" "), code.strip(" ") + "%")
    return False


def drug(level, code, **more):
    return dict.fromkeys(DRUG_COLUMNS) | {"rec_type": "I", "druglvl": level, "drug_code": code} | more


def product(gid, drug_id, gpi, **more):
    return dict.fromkeys(PRODUCT_COLUMNS) | {"drug_prod_gid": gid, "drug_id": drug_id, "gpi_cd": gpi} | more


def frames(spark, drugs, products):
    return (
        spark.createDataFrame([tuple(d[c] for c in DRUG_COLUMNS) for d in drugs], DRUG_SCHEMA),
        spark.createDataFrame([tuple(p[c] for c in PRODUCT_COLUMNS) for p in products], PRODUCT_SCHEMA),
    )


def expected_pairs(drugs, products):
    pairs = {
        tuple(p[c] for c in PRODUCT_COLUMNS) + tuple(d[c] for c in DRUG_COLUMNS)
        for d in drugs
        for p in products
        if p["drug_prod_gid"] is not None and matches(d, p)
    }
    return sorted(pairs, key=repr)


def random_inputs(seed):
    rng = random.Random(seed)

    def digits(n):
        return "".join(rng.choice("012") for _ in range(n))

    products = [
        product(
            rng.choice([None, *range(1, 30)]),
            rng.choice([None, digits(11), digits(11), digits(11), digits(7), ""]),
            rng.choice([None, digits(14), digits(14), " " + digits(6) + " ", "01" + digits(12)]),
        )
        for _ in range(150)
    ]
    known = [p["drug_id"] for p in products if p["drug_id"]]
    gpis = [p["gpi_cd"].strip() for p in products if p["gpi_cd"]]

    def blurred(code):
        return "".join(rng.choice([c, c, c, "_", "%"]) for c in code)

    drugs = []
    for i in range(150):
        whole, gpi = rng.choice(known), rng.choice(gpis)
        level, code = rng.choice(
            [
                ("NDC11", whole),
                ("NDC11", whole[: rng.randint(1, 8)] + "%"),
                ("NDC11", "%" + whole[rng.randint(1, 6) :]),
                ("NDC11", "_" + whole[1:]),
                ("NDC11", blurred(whole)),
                ("NDC11", rng.choice(["%", "___________", "%%", "_%"])),
                ("NDC9", whole[:9]),
                ("NDC9", "1%"),
                ("GPI", gpi[: rng.randint(1, 14)]),
                ("GPI", " " + gpi[:4] + " "),
                ("GPI", blurred(gpi[:8])),
                ("GPI", "%" + gpi[2:5]),
                (rng.choice(["GPI", "NDC11", "NDC9"]), rng.choice(["", "  ", None])),
                (None, whole),
            ]
        )
        drugs.append(drug(level, code, rec_type=rng.choice("IE"), drug_desc=f"row {i % 40}"))
    copies = rng.randint(1, 60)
    return drugs + [drugs[0]] * copies, products + [products[0]] * copies


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_like_over_all_pairs(spark, seed):
    drugs, products = random_inputs(seed)
    assert rows_of(match_products(*frames(spark, drugs, products))) == expected_pairs(drugs, products)


@pytest.mark.parametrize("seed", [1, 4])
def test_equals_like_over_all_pairs_without_broadcast(spark, shuffled_joins, seed):
    drugs, products = random_inputs(seed)
    matched = match_products(*frames(spark, drugs, products))
    assert rows_of(matched) == expected_pairs(drugs, products)
    plan = matched._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Broadcast" not in plan


def test_backslash_is_an_ordinary_character(spark):
    drugs, products = [drug("NDC11", "1\\2_")], [product(1, "1\\23", "01"), product(2, "123", "01")]
    assert [r.drug_prod_gid for r in match_products(*frames(spark, drugs, products)).collect()] == [1]


def test_inner_piece_found_twice_matches_once(spark):
    drugs, products = [drug("NDC11", "%12%")], [product(1, "12312412", "01")]
    assert match_products(*frames(spark, drugs, products)).count() == 1


def test_no_codes_no_matches(spark):
    drugs, products = frames(spark, [drug("NDC11", " ")], [product(1, "123", "01")])
    assert match_products(drugs, products).count() == 0
    assert match_products(drugs.limit(0), products).count() == 0


def test_one_short_prefix_for_a_third_of_the_catalogue(spark, shuffled_joins):
    products = [product(i, f"{i:011d}", ("01" if i % 3 == 0 else f"{i % 89 + 10:02d}") + f"{i:012d}") for i in range(900)]
    drugs = [drug("GPI", "01", drug_desc=str(i)) for i in range(5)]
    assert match_products(*frames(spark, drugs, products)).count() == 5 * 300


def test_one_long_prefix_for_a_third_of_the_catalogue_is_split(spark, shuffled_joins):
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        gpi = "if(id % 3 = 0, '0102030405', '7' || lpad(cast(id as string), 9, '0')) || '0000' as gpi_cd"
        others = [f"cast(null as string) as {c}" for c in PRODUCT_COLUMNS[3:]]
        ids = spark.range(0, 300000, 1, 8)
        products = ids.selectExpr("id as drug_prod_gid", "lpad(cast(id as string), 11, '0') as drug_id", gpi, *others)
        drugs = [drug("GPI", "0102030405")] + [drug("GPI", f"7{i:09d}") for i in range(1, 500)]
        matched = match_products(frames(spark, drugs, [])[0], products)
        assert len(matched.collect()) == 100000 + sum(1 for i in range(1, 500) if i % 3)
        assert "skew=true" in matched._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_copies_do_not_multiply(spark):
    drugs = [drug("GPI", "01", drug_desc=str(i)) for i in range(20)] * 30
    products = [product(1, "00000000001", "0102")] * 2000
    matched = match_products(*frames(spark, drugs, products))
    assert matched.count() == 20


def test_building_the_match_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    drugs, products = frames(spark, [drug("GPI", "01")], [product(1, "1", "0102")])
    plan = match_products(drugs, products)._jdf.queryExecution().optimizedPlan().toString()
    assert len(tracker.getJobIdsForGroup(None)) == before
    # the pieces are joined to the codes before any other catalogue column is read
    pieces = plan[plan.index("Generate explode") :]
    assert "brnd_gnrc_cd" not in pieces[: pieces.index("LogicalRDD")].split("Filter")[0]


def test_validity_holds_both_definitions_once(spark):
    base = dict(brnd_gnrc_cd="BRND", mddb_brnd_gnrc_cd="GNRC", drug_multi_src_cd="SINGLE", mddb_drug_multi_src_cd="MULTI")
    # Same projection under two GPI codes: the distinct result lists it once.
    products = [product(1, "11111111111", "0102", **base), product(1, "11111111111", "0103", **base)]
    rows = drug_validity(*frames(spark, [drug("GPI", "01")], products), CampaignParams(campaign_id=30)).collect()
    assert sorted((r.drug_defn, r.brnd_gnrc_cd, r.drug_multi_src_cd) for r in rows) == [
        (MDDB, "GNRC", "MULTI"),
        (PBM, "BRND", "SINGLE"),
    ]
    assert PBM == "PBM "


def test_switch_columns_only_for_their_campaigns(spark):
    drugs, products = frames(spark, [drug("GPI", "01")], [product(1, "1", "0102")])
    with_switches = drugs.selectExpr("*", *[f"'I' as {c}" for c in MONY_COLUMNS])
    plain = drug_validity(with_switches, products, CampaignParams(campaign_id=30))
    mony = drug_validity(with_switches, products, CampaignParams(campaign_id=554))
    assert mony.columns == plain.columns + MONY_COLUMNS


def test_codes_that_begin_with_a_wildcard_ask_for_one_piece_a_product(spark):
    """Whatever ends a code is looked up among the ends of the products, which are one a product and length."""
    products = [product(k, f"{k * 7919 % 10**11:011d}", None) for k in range(1, 200)]
    codes = ["%" + p["drug_id"][-4:] for p in products[::5]] + ["%" + p["drug_id"][3:5] + "%" + p["drug_id"][-3:] for p in products[::9]] + ["__" + products[3]["drug_id"][2:], "%9", "_%", "%_1"]
    drugs = [drug("NDC11", c) for c in codes]
    d, p = frames(spark, drugs, products)
    assert rows_of(match_products(d, p)) == expected_pairs(drugs, products)
    offered = match._pieces(p.select("drug_id", "gpi_cd").distinct(), F.array(F.struct(F.lit("T").alias("origin"), F.lit(4).alias("n"))))
    assert offered.count() == len(products)
    anchored = match._anchored(d.select("druglvl", "drug_code").distinct())
    assert {r.piece[0] for r in anchored.where("drug_code rlike '^%[0-9]+$'").collect()} == {"T"}
    assert {r.rest for r in anchored.where("drug_code rlike '^%[0-9]+$'").collect()} == {match.DECIDED}


def test_tables_are_never_broadcast(spark, tmp_path):
    """Packed files look small; their rows must not pass through the driver for it."""
    drugs = [drug("GPI", f"{k:04d}") for k in range(50)]
    d, p = frames(spark, drugs, [product(k, f"{k:011d}", f"{k:06d}") for k in range(5000)])
    d.write.parquet(str(tmp_path / "drugs"))
    p.write.parquet(str(tmp_path / "products"))
    found = drug_validity(spark.read.parquet(str(tmp_path / "drugs")), spark.read.parquet(str(tmp_path / "products")), CampaignParams(campaign_id=30))
    assert len(found.collect()) == 2 * 5000
    plan = found._jdf.queryExecution().executedPlan()
    assert "BroadcastExchange" not in plan.toString() and "SortMergeJoin" in plan.toString()
