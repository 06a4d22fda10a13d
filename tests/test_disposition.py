import pytest

from rxsieve.operators import disposition, summary
from rxsieve.operators.disposition import campaign_flags, dispose_issues, message_pairs, run_flags, run_messages, run_text
from rxsieve.params import CampaignParams
from rxsieve.plans import findings
from tests.conftest import rows_of

RUN = CampaignParams(main_dir="/jobs", email_subject="intake")
ISSUE = "run_id long, seq long, campaign_id int, message_id int, message_text string"


@pytest.fixture
def messages(spark):
    return spark.createDataFrame(
        [
            (1, "FAILURE MESSAGE", " bad "), (2, "WARNING MESSAGE", "hm"), (3, "INFORMATIVE MESSAGE ", "fyi"),
            (1, "WARNING MESSAGE", "listed twice"),
        ],
        "dqi_message_id int, dqi_message_type string, dqi_mco_message string",
    )


@pytest.fixture
def campaigns(spark):
    return spark.createDataFrame(
        [(30, "A", None, "Y"), (31, "B", " ", "N"), (32, "C", "go", "Y"), (32, "C", "go", "Y"), (600, "D", "go", "Y")],
        "dqi_campaign_id int, dqi_campaign_name string, dqi_targeting_message string, dqi_messages string",
    )


def disposed(spark, messages, campaigns, *issues, run=RUN):
    frame = spark.createDataFrame([(1, i, *issue) for i, issue in enumerate(issues)], ISSUE)
    return dispose_issues(frame, messages, campaigns, run).orderBy("seq").collect()


@pytest.mark.parametrize(
    ("issue", "subject", "triage_text", "abort", "application", "sends"),
    [
        ((30, 0, "boom"), "FAILED!! intake", None, True, "DQI", True),
        ((30, 1, "x"), "FAILED!! intake", None, True, "DQI", True),
        ((30, 2, "x"), "WARNING!! intake", None, False, None, False),
        ((30, 3, "x"), "INFORMATIVE!! intake", None, False, None, False),
        ((30, 99, "x"), "FAILED!! intake", None, True, "DQI", True),
        ((31, 0, "boom"), "FAILED!! intake", None, True, None, False),
        ((32, 0, "two flags"), "FAILED!! intake", None, True, None, False),
        ((33, 0, "no campaign"), "FAILED!! intake", None, True, None, False),
        ((600, 0, "boom"), None, "boom", False, None, False),
        ((600, 1, "x"), None, "bad", False, None, False),
        ((600, 2, "x"), None, None, False, None, False),
        ((600, 3, "x"), None, None, False, None, False),
        ((600, 99, "x"), None, "Critical error encountered", False, None, False),
    ],
)
def test_disposition(spark, messages, campaigns, issue, subject, triage_text, abort, application, sends):
    (row,) = disposed(spark, messages, campaigns, issue)
    assert (row.subject, row.triage_text, row.abort, row.application, row.send_summary) == (
        subject, triage_text, abort, application, sends,
    )
    assert row.campaign_class == ("triage" if issue[0] >= 500 else "regular")
    assert row.triage_error == int(triage_text is not None)


def test_test_installation(spark, messages, campaigns):
    run = CampaignParams(main_dir="/jobs/bss_test/a")
    rows = disposed(spark, messages, campaigns, (30, 0, "x"), (30, 2, "x"), run=run)
    assert [(r.application, r.send_summary) for r in rows] == [("MDP", False), (None, False)]


def test_run_roll_up_does_not_depend_on_numbering(spark, messages, campaigns):
    seqs = [99_999, 100_001, 250_000, 5_000_000_000]
    issues = [(7, s, 600, 0, f"m{i}") for i, s in enumerate(seqs)] + [(8, 0, 30, 2, "x"), (9, 0, 600, 2, "x"), (9, 1, 600, 0, "y")]
    rows = dispose_issues(spark.createDataFrame(issues, ISSUE), messages, campaigns, RUN)
    assert sorted(map(tuple, run_messages(rows).collect())) == [*((7, s, f"m{i}") for i, s in enumerate(seqs)), (9, 1, "y")]
    assert rows_of(run_text(rows, 7)) == [("m0|m1|m2|m3",)]
    assert rows_of(run_text(rows, 8)) == [("",)]
    assert rows_of(run_flags(rows)) == [(7, 4, 1, False, False), (8, 1, 0, False, False), (9, 2, 1, False, False)]


@pytest.mark.parametrize(
    ("texts", "whole"),
    [(["", "z", ""], "z|"), (["", ""], ""), (["a", "", "b"], "a||b"), ([None, "z"], "N|z"), (["|", "z"], "||z")],
)
def test_run_text_starts_with_the_first_that_is_not_empty(spark, messages, campaigns, texts, whole):
    issues = [(1, i, 600, 0, t) for i, t in enumerate(texts)]
    rows = dispose_issues(spark.createDataFrame(issues, ISSUE), messages, campaigns, RUN)
    assert rows_of(run_text(rows, 1)) == [(whole,)]


def test_message_pairs(spark, messages):
    pairs = message_pairs(messages.filter("dqi_message_id = 3"))
    assert rows_of(pairs) == [(3, "dqi_mco_message", "fyi"), (3, "dqi_message_type", "INFORMATIVE MESSAGE")]


def test_campaign_flags(spark):
    frame = spark.createDataFrame(
        [(1, "Y"), (2, "Y"), (2, "N"), (2, "Y"), (2, None), (3, None)], "dqi_campaign_id int, dqi_messages string"
    )
    assert rows_of(campaign_flags(frame)) == sorted([(1, "Y", 1), (2, "Y", 2), (2, "N", 1), (2, None, 1), (3, None, 1)], key=repr)


def test_a_campaign_is_flagged_by_a_single_yes(spark):
    flags = [(1, "Y"), (2, "Y"), (2, "Y"), (3, "Y"), (3, ""), (4, "Y"), (4, None), (5, None), (6, ""), (7, "N"), (8, "Y"), (8, " ")]
    frame = spark.createDataFrame(flags, "dqi_campaign_id int, dqi_messages string")
    assert [i for i, flagged in rows_of(disposition.notified_campaigns(frame)) if flagged] == [1, 3]


def test_plain_issues_look_nothing_up(spark, messages, campaigns):
    named = messages.union(spark.createDataFrame([(0, "WARNING MESSAGE", "x")], messages.schema))
    (row,) = disposed(spark, named, campaigns, (600, 0, "boom"))
    assert (row.triage_text, row.message_type) == ("boom", None)




def test_check_counts_and_stops(spark, messages, campaigns):
    some, none = spark.range(3), spark.range(0)
    counts = findings.check_counts(
        {findings.DUPLICATES: none, findings.EXCLUSIONS: some, findings.QUALITY: some, findings.TARGET_INDICATOR: some}
    )
    assert [(r.check_seq, r.message_id, r.n_rows) for r in counts.collect()] == [(1, 5, 0), (2, 6, 3), (1, 21, 3), (2, 74, 3)]
    assert rows_of(findings.first_failures(counts)) == [
        ("intake", 2, "invalid_exclusions", 6, 3), ("quality", 1, "quality", 21, 3),
    ]
    issues = findings.raised_issues(counts, 5, CampaignParams(campaign_id=30))
    assert sorted(r.message_id for r in dispose_issues(issues, messages, campaigns, RUN).collect()) == [6, 21, 74]


PROJECT = "prjct_id string, title_nm string, prod_id string, prod_subcat_id string"


def test_project_details(spark):
    projects = spark.createDataFrame(
        [
            ("1", " Drug's \"A\", B & C ", "spec-ial/ty", "abcd"), ("1", "Zed", "zzzzzz", "zzzzzz"),
            ("2", None, None, "12-45"), ("3", "same", "abcde", "abcde"), ("3", "same,", "abcde", "abcde"),
        ],
        PROJECT,
    )
    default = summary.DEFAULT_PRODUCT
    assert rows_of(summary.project_details(projects)) == [
        ("1", "Drugs A B  C", "spec ial ty", default), ("2", "", default, "12 45"), ("3", "same", "abcde", "abcde"),
    ]
    assert summary.project_titles(projects).filter("prjct_id = '3'").count() == 1


RUNS = "ticket string, activity string, campaign_id int, mailing_name string, program string, project string, client_name string"


def test_run_summaries(spark, campaigns):
    runs = spark.createDataFrame([("1", "A1", 32, "m", "p", "j", "c"), ("9", "A2", 77, "m", "p", "j", "c")], RUNS)
    projects = spark.createDataFrame([("1", "Title", "abcde", "xyzzy")], PROJECT)
    count = summary.drug_count(runs["campaign_id"], spark.range(4), spark.range(6))
    one, nine = summary.run_summaries(runs, campaigns, projects, count).orderBy("ticket").collect()
    assert (one.subject, one.campaign_name, one.targeting_message, one.product_id) == ("SUCCESS!! A1 - 1 Title", "C", "go", "abcde")
    assert (nine.subject, nine.campaign_name, nine.targeting_message) == ("SUCCESS!! A2 - 9 ", "Unknown Campaign", None)
    assert (nine.product_id, nine.drug_count) == (summary.DEFAULT_PRODUCT, None)
    bare = summary.run_summaries(runs, campaigns, None).orderBy("ticket").first()
    assert (bare.subject, bare.subproduct_id) == ("SUCCESS!! A1 - 1 ", summary.DEFAULT_PRODUCT)


def test_drug_counts(spark):
    ids = spark.createDataFrame([(c,) for c in (63, 26, 67, 566, 30, 52, 52, 1, None)], "campaign_id int")
    assert rows_of(summary.drug_counts(ids, spark.range(4), spark.range(6))) == [
        (26, 4), (30, 6), (52, 6), (566, 4), (63, 4), (67, 4),
    ]


def test_texts_of_all_runs(spark):
    """Empty texts are dropped until one is not; later ones stay; a bar of the text's own stays too."""
    said = {1: ["", "", "a", "", "b"], 2: ["", ""], 3: ["|x", "y"], 4: ["only"], None: ["", "n"]}
    rows = [(run, 10 - k, t) for run, texts in said.items() for k, t in enumerate(reversed(texts))] + [(5, 1, None)]
    disposed = spark.createDataFrame(rows, "run_id long, seq long, triage_text string")
    got = {r.run_id: r.msg_fail for r in disposition.run_texts(disposed).collect()}
    assert got == {1: "a||b", 2: "", 3: "|x|y", 4: "only", None: "n"}
    for run, text in got.items():
        if run is not None:
            assert disposition.run_text(disposed, run).first().msg_fail == text
