"""Stand-in inputs derived from the given tables.

Each input is one SELECT both Spark and DuckDB run, with the source tables in
braces. Every input covers its whole source table, and codes are built so that
matches grow in step with the table, not with its square.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rxsieve.session import partitions

NDC = "lpad(cast(p_partkey * 37 as varchar(20)), 11, '0')"
GPI = (
    "lpad(substr(p_brand, 7), 2, '0') || lpad(cast(p_size as varchar(20)), 2, '0')"
    " || lpad(cast(p_partkey as varchar(20)), 10, '0')"
)

CATALOG = f"""
select case when p_partkey % 97 = 0 then null else p_partkey + 1 end as drug_prod_gid,
  {NDC} as drug_id, {GPI} as gpi_cd,
  case when p_partkey % 2 = 0 then 'BRND' else 'GNRC' end as brnd_gnrc_cd,
  case p_partkey % 3 when 0 then 'SINGLE' when 1 then 'MULTI' else null end as drug_multi_src_cd,
  case p_partkey % 5 when 0 then 'M' when 1 then 'O' when 2 then 'N' when 3 then 'Y' else null end as pbm_drug_multi_src_cd,
  case when p_partkey % 7 = 0 then 'BRND' else 'GNRC' end as mddb_brnd_gnrc_cd,
  case when p_partkey % 4 = 0 then 'SINGLE' else 'MULTI' end as mddb_drug_multi_src_cd,
  case p_partkey % 6 when 0 then 'M' when 1 then 'O' when 2 then 'N' else 'Y' end as mddb_multsrc_cd,
  case p_partkey % 11 when 0 then 'Y' when 1 then null else 'N' end as otc_drug_ind
from {{part}}
"""

# A fixed handful of codes (keys under 60) is short, or starts or goes on with a wildcard; all others are selective.
_CODED = f"""
select *,
  case when p_partkey < 20 or p_partkey between 40 and 44 or p_partkey between 50 and 54 then 'GPI'
    when p_partkey between 20 and 39 or p_partkey between 45 and 49 or p_partkey between 55 and 57 then 'NDC11'
    else case p_partkey % 3 when 0 then 'NDC11' when 1 then 'NDC9' else 'GPI' end end as druglvl,
  case when p_partkey < 20 then substr({GPI}, 1, 2)
    when p_partkey < 30 then '_' || substr({NDC}, 2, 10)
    when p_partkey < 40 then '%' || substr({NDC}, 7, 5)
    when p_partkey < 45 then substr({GPI}, 1, 3) || '_' || substr({GPI}, 5, 8)
    when p_partkey < 50 then substr({NDC}, 1, 3) || '_' || substr({NDC}, 5, 6) || '%'
    when p_partkey < 55 then substr({GPI}, 1, 4) || ' '
    when p_partkey = 55 then '___________'
    when p_partkey = 56 then ' '
    when p_partkey = 57 then null
    when p_partkey % 3 = 0 then case when p_partkey % 2 = 0 then substr({NDC}, 1, 8) || '%' else {NDC} end
    when p_partkey % 3 = 1 then substr({NDC}, 1, 9)
    else substr({GPI}, 1, case p_partkey % 4 when 0 then 14 when 1 then 12 else 10 end) end as drug_code
from {{part}}
"""

INTAKE = f"""
select case when p_partkey % 5 = 0 then 'E' else 'I' end as rec_type, druglvl, drug_code,
  case when druglvl = 'NDC9' then drug_code end as ndc9,
  case when druglvl = 'NDC11' then drug_code end as ndc11,
  case when druglvl = 'GPI' then drug_code end as gpi,
  p_name as drug_desc,
  case p_partkey % 4 when 0 then 'B' when 1 then 'G' else 'A' end as b_g,
  case p_partkey % 7 when 0 then 'MS' when 1 then 'SS' else 'A' end as ms_ss,
  case when p_partkey % 8 = 0 then 'E' else 'I' end as mony_m,
  case when p_partkey % 9 = 0 then 'E' else null end as mony_o,
  'I' as mony_n, 'I' as mony_y,
  case when p_partkey % 13 = 0 then 'E' else 'I' end as rx,
  case when p_partkey % 14 = 2 then 'E' else null end as otc
from ({_CODED}) coded
"""

_RAW_COLUMNS = f"""p_partkey as row_no,
  case p_partkey % 9 when 0 then 'E' when 8 then 'X' else 'I' end as rec_type,
  case when p_partkey % 101 = 5 then '1.2E+10' when p_partkey % 103 = 6 then '12345-78901'
    when p_partkey % 3 = 0 then case when p_partkey % 2 = 0 then substr({NDC}, 1, 8) || '*'
      when p_partkey % 15 = 0 then substr({NDC}, 1, 10) || '?' when p_partkey % 21 = 0 then substr({NDC}, 1, 10)
      else {NDC} end
    else '' end as ndc11,
  case when p_partkey % 107 = 7 then '12345678*' when p_partkey % 109 = 8 then '1234-5678'
    when p_partkey % 113 = 9 then '123,45678' when p_partkey % 127 = 10 then '1.2e+09'
    when p_partkey % 3 = 1 then substr({NDC}, 1, case when p_partkey % 10 = 1 then 8 else 9 end) else '' end as ndc9,
  case when p_partkey % 131 = 11 then '1.2E+08' when p_partkey % 137 = 12 then '1.2e+08'
    when p_partkey % 139 = 13 then '1234567890123456'
    when p_partkey % 3 = 2 then case p_partkey % 8 when 0 then '*12' when 1 then '1*' when 2 then '12?4'
      when 3 then '12*34' else substr({GPI}, 1, 4) || case when p_partkey % 2 = 0 then '*' else '' end end
    when p_partkey % 30 = 1 then '1234' when p_partkey % 6 = 1 then null else '' end as gpi,
  case p_partkey % 5 when 0 then 'B' when 1 then 'g' when 2 then '' when 3 then null else 'Q' end as b_g,
  case p_partkey % 6 when 0 then 'MS' when 1 then 'SS' when 2 then '' when 3 then 'M' when 4 then null else 'A' end as ms_ss,
  case when p_partkey % 7 = 0 then null else p_size end as age_min,
  case p_partkey % 4 when 0 then null when 1 then 0 else 65 end as age_max,
  p_type as drug_category,
  case p_partkey % 3 when 0 then cast(p_size as varchar(11)) when 1 then '' else null end as retail_qty_limit,
  case when p_partkey % 3 = 0 then case when p_partkey % 12 = 0 then repeat('x', 210) else 'tabs' end
    when p_partkey % 11 = 1 then '.' else null end as retail_qty_unit,
  case when p_partkey % 3 = 0 then '30' else null end as retail_qty_time,
  case when p_partkey % 2 = 0 then '90' else null end as mail_qty_limit,
  case when p_partkey % 2 = 0 then 'tabs' when p_partkey % 5 = 0 then '.' else '' end as mail_qty_unit,
  case when p_partkey % 2 = 0 then '90' else '' end as mail_qty_time"""


def _cycle(k: int, values: list[str]) -> str:
    """Column ``k`` of a family runs through ``values`` along the part keys."""
    arms = " ".join(f"when {i} then {v}" for i, v in enumerate(values[:-1]))
    return f"case (p_partkey * {2 * k + 1} + {k}) % {len(values)} {arms} else {values[-1]} end"


def one_of(*allowed: str) -> list[str]:
    named = [f"'{a}'" for a in allowed]
    return ["'Z'", "''", "' '", "null", *named, *named, *named]


def given_text() -> list[str]:
    return ["' '", "null", *["p_name"] * 5]


def text_up_to(limit: int) -> list[str]:
    fits = "p_name" if limit >= 30 else "p_type" if limit >= 10 else "'I'"
    return [f"repeat('x', {limit + 1})", "' '", "null", *[fits] * 8]


EXCHANGE = {c: one_of("N", "Y") for c in ("RXCHANGE_SPC", "RXCHANGE_MAIL", "RXCHANGE_RETAIL")}
_ADD_BACK_TEXT = ["'text'", "''", "null", "'more text'"]
_DATE = ["null", *["date '2024-01-01'"] * 12]
_CHANGE_TYPE = ["'FE'", "'QL'", "'PA'", "'ZZ'", "null", "'LC-OB'", "'DNT'", "'ST'"]
_LETTER = ["'NA'", "'L1'", "' '", "null", "'NA'"]

# Column names per rule family; with the values they run through.
FAMILIES: dict[str, dict[str, list[str]]] = {
    "common": {},
    "fdro": {
        "GRDFTHR": one_of("N", "y", "M"),
        "class": one_of("OTHER", "msb", "SPECIALTY", "STRIPS/KITS"),
        **{
            c: given_text()
            for c in (
                "Lbl_Name", "XDRUG_TEXT", "DRUGMSG", "GSTP_ALTERNATIVE_TEXT", "MDXSTELLENT", "MDPASTELLENT",
                "PTXSTELLENT", "PTPASTELLENT", "PTHYPERSTELLENT", "MDHYPERSTELLENT", "HYPER_ALTERNATIVE_TEXT",
                "HYPER_GSTP_ALTERNATIVE_TEXT",
            )
        },
        "INSULIN_CALL": one_of("N", "Y"),
        **{
            c: given_text()
            for c in (
                "alternative_text", "add_back_messaging", "PTXAddbkStellent", "PTPAAddbkStellent",
                "add_back_messaging_hyper", "PTHyperAddbk",
            )
        },
        "add_back_merge_drug_hyper_ind": one_of("Y", "N"),
        **EXCHANGE,
    },
    "acf": {
        "GF": one_of("Y", "N", "M"),
        "insulin calls": text_up_to(12),
        "DRUG NAME": text_up_to(100),
        "PT_LTR": text_up_to(30),
        "Add-back PT_LTR": text_up_to(30),
        "Insert": text_up_to(30),
        "PT_LTR_RETAIL": text_up_to(30),
        "Add-back_Retail": text_up_to(30),
        "MD_LTR": text_up_to(30),
        "VF_ACSF_PT_LTR": text_up_to(30),
        "VF-ACSF_MD_LTR": text_up_to(30),
        "Add-Back Merge Field": text_up_to(300),
        "include or exclude": text_up_to(1),
        "alternative_text": given_text(),
        **{f"DrugMsg_IB{i}": text_up_to(300) for i in (1, 2, 3, 12)},
        **EXCHANGE,
    },
    "bc": {
        "PUE FLAG": one_of("Y", "N", "M"),
        "SPCLTY MANAGED": one_of("Y", "N"),
        "CALL TYPE": one_of("E", "S", "N"),
        "EFFECTIVE DATE": _DATE,
        "NDC": [f"substr({NDC}, 1, 10)", "null", *[NDC] * 9],
        "DRUG LABEL NAME": text_up_to(100),
        "DRUG BRAND NAME": text_up_to(100),
        "DRUG ABBR NAME": text_up_to(100),
        "ALTERNATIVES": text_up_to(300),
        "ADD BACK": one_of("Y", "N"),
        "ADD BACK LANGUAGE": ["repeat('x', 301)", *_ADD_BACK_TEXT],
        "PRODUCT CODE": one_of("SP-PDPD", "FE-MNPA", "FE-TS"),
        "MEMBER LETTER TEMPLATE ID": text_up_to(30),
        "MEMBER LETTER INSERT TEMPLATE ID": text_up_to(30),
        "ADD BACK MEMBER LETTER TEMPLATE": ["repeat('x', 31)", *_ADD_BACK_TEXT, "' '", "null"],
        "ADD BACK MEMBER LETTER INSERT TE": text_up_to(30),
        "MEMBER CALL TEMPLATE ID": text_up_to(30),
        "PRESCRIBER LETTER TEMPLATE ID": text_up_to(30),
        "GSTP ALTERNATIVES": given_text(),
        **EXCHANGE,
    },
    "exchange": {"alternative_text": given_text(), **EXCHANGE},
    "gstp": {"alternative_text": given_text()},
    "balance": {
        "change_type": ["'EX'", "'ST'", "'QL'", "null", "' '"],
        "alternative_text": given_text(),
        "gf": one_of("n", "Y", "M"),
        **{f"DrugMsg_IB{i}": text_up_to(300) for i in (1, 4, 12)},
        **EXCHANGE,
    },
    "intake": {"_exceedlmt": ["'100001'", "'000000'", "'011110'", "null", "'000000'"]},
    "vf": {
        "PUE_FLAG": one_of("Y", "M", "N"),
        "SPECIALTY_MANAGED_PRODUCT": one_of("Y", "N"),
        "CALL_TYPE": one_of("I", "N", "S"),
        "EFF_DATE": _DATE,
        "DRUG LABEL NAME": text_up_to(100),
        "DRUG BRAND NAME": text_up_to(50),
        "DRUG ABBR NAME": text_up_to(50),
        "CHANGE_TYPE_PBM": _CHANGE_TYPE,
        "PBM_ALTERNATIVE": given_text(),
        "CHANGE_TYPE_MDDB": [*_CHANGE_TYPE, "'SP'"],
        "MDDB_ALTERNATIVE": given_text(),
        "PBM_ADD_BACK_PRODUCT": _ADD_BACK_TEXT,
        "PBM_ADD_BACK_TEMPLATE": [*_ADD_BACK_TEXT, "' '"],
        "MDDB_ADD_BACK_PRODUCT": [*_ADD_BACK_TEXT, "' '"],
        "MDDB_ADD_BACK_TEMPLATE": _ADD_BACK_TEXT,
        "PBM_MONY_CODE": one_of("M", "O", "N", "Y"),
        "MDDB_MONY_CODE": one_of("M", "O", "N", "Y"),
        "FORMULARY_DESCRIPTION_PBM": given_text(),
        "FORMULARY_GROUP_PBM": one_of("F", "NF"),
        "FORMULARY_DESCRIPTION_MDDB": given_text(),
        "FORMULARY_GROUP_MDDB": one_of("F", "NF"),
        "CALL_TEMPLATE": ["'NA'", "' '", "'T1'", "null", "'T2'"],
        **{
            c: _LETTER
            for c in (
                "MBR_LETTER_PBM", "MBR_LETTER_INSERT_PBM", "MBR_LETTER_PA_PBM", "MBR_LETTER_BE_PBM",
                "PRESCRIBER_LETTER_PBM", "MBR_LETTER_MDDB", "MBR_LETTER_INSERT_MDDB", "MBR_LETTER_PA_MDDB",
                "MBR_LETTER_BE_MDDB", "PRESCRIBER_LETTER_MDDB",
            )
        },
        **EXCHANGE,
    },
    "opioid": {
        "alternative_text": ["'Exclude '", "'text'", "null", "' '"],
        "opioid_daily_dose_limit": ["null", "1.5", "90.0"],
        "opioid_daily_dose_text": given_text(),
    },
}


# Ages as decimals and as text.
AGES = """
select p_partkey as row_no, cast(p_partkey % 7 as decimal(5, 1)) as age_min,
  case p_partkey % 6 when 0 then '0.0' when 1 then '0' when 2 then '' when 3 then null when 4 then ' 65 ' else 'old' end as age_max
from {part}
"""


def family_rows(family: str) -> str:
    """Raw drug rows with the columns of one rule family."""
    extra = [f',\n  {_cycle(k, values)} as "{c}"' for k, (c, values) in enumerate(FAMILIES[family].items())]
    return f"select {_RAW_COLUMNS}{''.join(extra)}\nfrom {{part}}"


FORMULARY = """
select p_partkey as row_no,
  case p_partkey % 9 when 0 then 'N' when 1 then 'T' when 2 then 'E' when 3 then 't' when 4 then 'X' when 5 then null
    when 6 then '' else 'n' end as drug_tgt_ind,
  case when p_partkey % 4 = 0 then '' else '1' end as tier_from,
  case p_partkey % 6 when 0 then '' when 1 then null else '2' end as tier_to
from {part}
"""

# Some campaigns and messages are listed twice, with other values; some flags are empty or unknown.
CAMPAIGNS = """
select n_nationkey % 20 * 25 as dqi_campaign_id, n_name as dqi_campaign_name,
  case when n_nationkey % 3 = 0 then null else 'targets ' || n_name end as dqi_targeting_message,
  case n_nationkey * 3 % 7 when 3 then 'N' when 4 then '' when 5 then null else 'Y' end as dqi_messages
from {nation}
"""

MESSAGES = """
select n_nationkey % 20 as dqi_message_id,
  case n_nationkey % 3 when 0 then 'FAILURE MESSAGE' when 1 then 'WARNING MESSAGE' else 'INFORMATIVE MESSAGE' end as dqi_message_type,
  ' text for ' || n_name || ' ' as dqi_mco_message
from {nation}
"""

# Message records of every conversation turn: a message table that grows with the data.
TURN_MESSAGES = """
select conv_id * 1000 + turn as dqi_message_id, ' ' || upper(role) || ' MESSAGE ' as dqi_message_type,
  text as dqi_mco_message
from {conversations}
"""

# Campaign flags given once per customer: many rows, few campaigns.
CUSTOMER_FLAGS = """
select c_nationkey * 25 + c_custkey % 1000 * 1000 as dqi_campaign_id,
  case c_custkey % 5 when 0 then 'N' when 1 then null else 'Y' end as dqi_messages
from {customer}
"""

ISSUES = """
select user_id as run_id, event_id * 1000 + 5000000000 as seq, cast(case when event_id % 3 = 0 then 500 + user_id % 5 * 25 else user_id % 20 * 25 end as int) as campaign_id,
  cast(event_id % 31 as int) as message_id, case event_id % 8 when 0 then '' when 4 then null else event_type end as message_text
from {events}
"""

RUN_VARIABLES = """
select 'T' || cast(user_id as varchar(20)) as dqi_ticket, 'A' || cast(user_id % 10 as varchar(20)) as dqi_aprimo_activity,
  event_id as mbr_process_id, event_id + 1 as phys_process_id,
  case when event_id % 2 = 0 then 'GLOBAL' else 'LOCAL' end as dqi_macro_scope, event_type as dqi_macro_variable,
  props as dqi_macro_value, user_id as dqi_user_id, 'user ' || cast(user_id as varchar(20)) as dqi_user_name,
  event_id % 100 as dqi_job_id, ts as run_ts
from {events}
"""

# Every project is listed twice.
PROJECTS = """
select cast(floor(doc_id / 2) as bigint) as prjct_id, text as title_nm, source as prod_id, lang as prod_subcat_id from {documents}
"""

RUNS = """
select cast(doc_id as varchar(20)) as ticket, 'A' || cast(doc_id % 17 as varchar(20)) as activity,
  cast(case doc_id % 32 when 27 then 63 when 28 then 26 when 29 then 30 when 30 then 52 else doc_id % 32 * 25 end as int) as campaign_id,
  'mailing ' || lang as mailing_name, source as program, 'P' || cast(doc_id % 7 as varchar(20)) as project, lang as client_name
from {documents}
"""


def read_input(spark: SparkSession, sf_dir: str, sql: str, spread: bool = False) -> DataFrame:
    """Run an input's SELECT over the Parquet tables it names.

    ``spread``: the rows are dealt to the session's partitions first. For inputs far wider than their table, of which a task
    would otherwise read a million rows.
    """
    names = [t for t in ("part", "nation", "customer", "events", "documents", "conversations") if f"{{{t}}}" in sql]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in names}
    if spread:
        tables = {t: rows.repartition(partitions(spark), *rows.columns) for t, rows in tables.items()}
    return spark.sql(sql.replace('"', "`"), **tables)
