"""Checked sums of the applicant's columns in every generation, and of the child tables of generation 6: the same
figures as in ``preset_sums``, from SQL that states every column and slice by itself."""

from __future__ import annotations

from rowloom.operators import schema
from rowloom.plans import credit
from rowloom.plans.catalog.preset_sums import _CHILDREN, _IDS, _STATUSES, _TEXT, _h, _sums, feature_sums
from rowloom.plans.catalog.presets import credit_tables
from rowloom.plans.catalog.registry import INSTALMENTS, query

_K = "c_custkey"


def _days(seed: int, span: int) -> str:
    return f"trunc(-1 - {_h(_K, seed)} * {span})"


# The customers in the role of applicants.
_APPLICANT = f"""a0 AS (
  SELECT c_custkey AS SK_ID_CURR, CASE WHEN c_acctbal > 0 THEN (c_acctbal > 5000)::INT END AS TARGET,
    CASE WHEN c_nationkey > 2 THEN {_h(_K, 1)} END AS EXT_SOURCE_1, {_h(_K, 2)} AS EXT_SOURCE_2,
    CASE WHEN c_nationkey < 20 THEN {_h(_K, 3)} + c_acctbal / 100000 END AS EXT_SOURCE_3,
    abs(c_acctbal)::DOUBLE * 40 AS AMT_CREDIT, abs(c_acctbal)::DOUBLE * (1 + {_h(_K, 4)}) AS AMT_ANNUITY,
    20000 + {_h(_K, 5)} * 100000 AS AMT_INCOME_TOTAL, abs(c_acctbal)::DOUBLE * 38 AS AMT_GOODS_PRICE,
    trunc({_h(_K, 6)} * 3) AS AMT_REQ_CREDIT_BUREAU_DAY, trunc({_h(_K, 7)} * 5) AS AMT_REQ_CREDIT_BUREAU_YEAR,
    trunc({_h(_K, 8)} * 4) AS CNT_CHILDREN, trunc(1 + {_h(_K, 9)} * 4) AS CNT_FAM_MEMBERS, {_days(10, 20000)} AS DAYS_BIRTH,
    CASE WHEN c_nationkey = 0 THEN 365243 ELSE {_days(11, 5000)} END AS DAYS_EMPLOYED, {_days(12, 4000)} AS DAYS_ID_PUBLISH,
    {_days(13, 9000)} AS DAYS_REGISTRATION, {_days(14, 3)} + 1 AS DAYS_LAST_PHONE_CHANGE,
    CASE WHEN c_nationkey > 2 THEN trunc({_h(_K, 15)} * 20) END AS OWN_CAR_AGE, 1 + c_nationkey % 3 AS REGION_RATING_CLIENT_W_CITY,
    trunc({_h(_K, 16)} * 24) AS HOUR_APPR_PROCESS_START, {_h(_K, 17)} / 10 AS REGION_POPULATION_RELATIVE,
    ({_h(_K, 22)} > 0.5)::INT AS FLAG_DOCUMENT_2, ({_h(_K, 23)} > 0.5)::INT AS FLAG_DOCUMENT_3,
    ({_h(_K, 30)} > 0.3)::INT AS FLAG_MOBIL, ({_h(_K, 31)} > 0.3)::INT AS FLAG_EMP_PHONE, ({_h(_K, 32)} > 0.3)::INT AS FLAG_WORK_PHONE,
    ({_h(_K, 33)} > 0.3)::INT AS FLAG_CONT_MOBILE, trunc({_h(_K, 40)} * 6) AS OBS_30_CNT_SOCIAL_CIRCLE, trunc({_h(_K, 41)} * 6) AS OBS_60_CNT_SOCIAL_CIRCLE,
    trunc({_h(_K, 50)} * 3) AS DEF_30_CNT_SOCIAL_CIRCLE, trunc({_h(_K, 51)} * 3) AS DEF_60_CNT_SOCIAL_CIRCLE,
    ({_h(_K, 60)} > 0.9)::INT AS REG_REGION_NOT_LIVE_REGION, ({_h(_K, 61)} > 0.9)::INT AS REG_REGION_NOT_WORK_REGION,
    ({_h(_K, 62)} > 0.9)::INT AS LIVE_REGION_NOT_WORK_REGION, c_mktsegment AS NAME_INCOME_TYPE,
    'R' || (c_nationkey % 5) AS NAME_EDUCATION_TYPE, CASE WHEN c_nationkey > 2 THEN 'N' || c_nationkey END AS OCCUPATION_TYPE
  FROM customer)"""
_GIVEN = [
    "TARGET", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "AMT_CREDIT", "AMT_ANNUITY", "AMT_INCOME_TOTAL", "AMT_GOODS_PRICE", "AMT_REQ_CREDIT_BUREAU_DAY",
    "AMT_REQ_CREDIT_BUREAU_YEAR", "CNT_CHILDREN", "CNT_FAM_MEMBERS", "DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_ID_PUBLISH", "DAYS_REGISTRATION", "DAYS_LAST_PHONE_CHANGE",
    "OWN_CAR_AGE", "REGION_RATING_CLIENT_W_CITY", "HOUR_APPR_PROCESS_START", "REGION_POPULATION_RELATIVE", "FLAG_DOCUMENT_2", "FLAG_DOCUMENT_3", "FLAG_MOBIL",
    "FLAG_EMP_PHONE", "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE", "OBS_30_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE", "DEF_30_CNT_SOCIAL_CIRCLE",
    "DEF_60_CNT_SOCIAL_CIRCLE", "REG_REGION_NOT_LIVE_REGION", "REG_REGION_NOT_WORK_REGION", "LIVE_REGION_NOT_WORK_REGION",
]
_EXTS = "[EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3]"
_NONE = "(EXT_SOURCE_1 IS NULL)::INT + (EXT_SOURCE_2 IS NULL)::INT + (EXT_SOURCE_3 IS NULL)::INT"


def _over(a: str, b: str, plus: str = "") -> str:
    return f"({a})::DOUBLE / nullif(({b})::DOUBLE{plus}, 0)"


# The applicant's columns of generations 1 to 5, and which generations have them.
_EARLY = [
    ("APP_CREDIT_INCOME_RATIO", _over("AMT_CREDIT", "AMT_INCOME_TOTAL"), "1 1v2 3 4 5"),
    ("APP_ANNUITY_INCOME_RATIO", _over("AMT_ANNUITY", "AMT_INCOME_TOTAL"), "1 1v2 2 3 4 5"),
    ("APP_CREDIT_ANNUITY_RATIO", _over("AMT_CREDIT", "AMT_ANNUITY"), "1 1v2 2 3 4 5"),
    ("APP_GOODS_CREDIT_RATIO", _over("AMT_GOODS_PRICE", "AMT_CREDIT"), "1 1v2 2 3 4 5"),
    ("APP_INCOME_PER_PERSON", _over("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"), "1 1v2 3 4 5"),
    ("APP_EMPLOYED_BIRTH_RATIO", _over("DAYS_EMPLOYED", "DAYS_BIRTH"), "1 1v2 2 3 4 5"),
    ("APP_ANNUITY_LENGTH", _over("AMT_ANNUITY", "AMT_CREDIT"), "1 1v2 3 4 5"),
    ("APP_CREDIT_GOODS_RATIO", _over("AMT_CREDIT", "AMT_GOODS_PRICE"), "1v2"),
    ("APP_CREDIT_DOWNPAYMENT", "AMT_GOODS_PRICE - AMT_CREDIT", "1v2 4 5"),
    ("APP_AGE_INT", "coalesce(trunc(-DAYS_BIRTH / 365.0::DOUBLE), 0)", "1v2 4 5"),
    ("APP_EXT_SOURCE_1_BY_3", _over("EXT_SOURCE_1", "EXT_SOURCE_3"), "1v2 4 5"),
    ("APP_EXT_SOURCE_2_BY_3", _over("EXT_SOURCE_2", "EXT_SOURCE_3"), "1v2 4 5"),
    ("APP_EXT_SOURCES_PROD", "EXT_SOURCE_1 * EXT_SOURCE_2 * EXT_SOURCE_3", "1 1v2 2 3 4 5"),
    ("APP_EXT_SOURCES_MEAN", f"list_aggregate({_EXTS}, 'avg')", "1 1v2 2 3 4 5"),
    ("APP_EXT_SOURCES_STD", f"list_aggregate({_EXTS}, 'stddev_samp')", "1 1v2 3 4 5"),
    ("APP_EXT_SOURCES_NAN_COUNT", _NONE, "1 1v2 2 3 4 5"),
]

# The applicant's columns of generation 6 up to its count of missing values, in two steps since some
# rest on others, and behind it.
_SIX_FIRST = [
    ("EXT_MEAN", f"list_aggregate({_EXTS}, 'avg')"), ("EXT_STD", f"list_aggregate({_EXTS}, 'stddev_samp')"), ("EXT_PROD", "EXT_SOURCE_1 * EXT_SOURCE_2 * EXT_SOURCE_3"),
    ("EXT_MIN", "least(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3)"), ("EXT_MAX", "greatest(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3)"), ("EXT_NANCOUNT", _NONE),
    ("EXT_S1xS2", "EXT_SOURCE_1 * EXT_SOURCE_2"), ("EXT_S1xS3", "EXT_SOURCE_1 * EXT_SOURCE_3"), ("EXT_S2xS3", "EXT_SOURCE_2 * EXT_SOURCE_3"),
    ("EXT_S2divS3", _over("EXT_SOURCE_2", "EXT_SOURCE_3", " + 0.0001::DOUBLE")), ("EXT_S1divS2", _over("EXT_SOURCE_1", "EXT_SOURCE_2", " + 0.0001::DOUBLE")),
    *[(f"EXT_SOURCE_{i}_SQ", f"EXT_SOURCE_{i} ** 2") for i in (1, 2, 3)], *[(f"EXT_SOURCE_{i}_CB", f"EXT_SOURCE_{i} ** 3") for i in (1, 2, 3)],
    *[(f"EXT_S{i}xBIRTH", f"EXT_SOURCE_{i} * DAYS_BIRTH") for i in (2, 1, 3)], *[(f"EXT_S{i}xEMPL", f"EXT_SOURCE_{i} * DAYS_EMPLOYED") for i in (2, 3)],
    ("GP1", "EXT_SOURCE_2 ** 2 * EXT_SOURCE_3"), ("GP2", _over("EXT_SOURCE_1 * DAYS_BIRTH", "AMT_ANNUITY", " + 1")), ("GP3", "EXT_SOURCE_2 * REGION_RATING_CLIENT_W_CITY"),
    ("GP4", "EXT_SOURCE_3 * ln(1 + abs(DAYS_BIRTH))"), ("GP5", _over("AMT_ANNUITY * EXT_SOURCE_3", "AMT_INCOME_TOTAL", " + 1")),
    ("GP6", _over("EXT_SOURCE_1 * DAYS_ID_PUBLISH", "DAYS_BIRTH", " + 1")), ("GP7", _over("EXT_SOURCE_2 * AMT_CREDIT", "AMT_GOODS_PRICE", " + 1")),
    ("GP8", _over("EXT_SOURCE_1 * EXT_SOURCE_2 * EXT_SOURCE_3", "AMT_CREDIT", " + 1")),
    ("GP9", _over(f"list_aggregate({_EXTS}, 'avg') * DAYS_EMPLOYED", "DAYS_BIRTH", " - 1")), ("GP10", _over("(AMT_GOODS_PRICE - AMT_CREDIT) * EXT_SOURCE_2", "AMT_ANNUITY", " + 1")),
    ("CREDIT_INCOME_RATIO", _over("AMT_CREDIT", "AMT_INCOME_TOTAL", " + 1")), ("ANNUITY_INCOME_RATIO", _over("AMT_ANNUITY", "AMT_INCOME_TOTAL", " + 1")),
    ("CREDIT_ANNUITY_RATIO", _over("AMT_CREDIT", "AMT_ANNUITY", " + 1")), ("CREDIT_GOODS_RATIO", _over("AMT_CREDIT", "AMT_GOODS_PRICE", " + 1")),
    ("GOODS_INCOME_RATIO", _over("AMT_GOODS_PRICE", "AMT_INCOME_TOTAL", " + 1")), ("INCOME_PER_CHILD", _over("AMT_INCOME_TOTAL", "CNT_CHILDREN", " + 1")),
    ("INCOME_PER_FAM", _over("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS", " + 1")), ("ANNUITY_CREDIT_RATIO", _over("AMT_ANNUITY", "AMT_CREDIT", " + 1")),
    ("PAYMENT_LENGTH", _over("AMT_CREDIT", "AMT_ANNUITY", " + 1")), ("DOWN_PAYMENT", "AMT_GOODS_PRICE - AMT_CREDIT"),
    ("DOWN_PAYMENT_RATIO", _over("AMT_GOODS_PRICE - AMT_CREDIT", "AMT_GOODS_PRICE", " + 1")),
    ("DAYS_BIRTH_YRS", "DAYS_BIRTH / -365.25::DOUBLE"), ("DAYS_EMPLOYED_YRS", "DAYS_EMPLOYED / -365.25::DOUBLE"),
    ("EMPLOYED_TO_BIRTH", _over("DAYS_EMPLOYED", "DAYS_BIRTH", " + 1")), ("CAR_AGE_TO_BIRTH", _over("OWN_CAR_AGE", "DAYS_BIRTH / -365.25::DOUBLE", " + 1")),
    ("ID_PUBLISH_TO_BIRTH", _over("DAYS_ID_PUBLISH", "DAYS_BIRTH", " + 1")), ("PHONE_TO_BIRTH", _over("DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH", " + 1")),
    ("PHONE_TO_EMPLOYED", _over("DAYS_LAST_PHONE_CHANGE", "DAYS_EMPLOYED", " + 1")), ("REG_TO_BIRTH", _over("DAYS_REGISTRATION", "DAYS_BIRTH", " + 1")),
    ("AGE_RANGE", "(SELECT min(b) FROM range(10) r(b) WHERE DAYS_BIRTH / -365.25::DOUBLE > 0 AND DAYS_BIRTH / -365.25::DOUBLE <= [25, 30, 35, 40, 45, 50, 55, 60, 65, 100][b + 1])"),
    ("INCOME_EMPLOYED", "AMT_INCOME_TOTAL * (DAYS_EMPLOYED / -365.25::DOUBLE)"), ("DOCUMENT_COUNT", "FLAG_DOCUMENT_2 + FLAG_DOCUMENT_3"),
    ("DEF_30_RATIO", _over("DEF_30_CNT_SOCIAL_CIRCLE", "OBS_30_CNT_SOCIAL_CIRCLE", " + 1")), ("DEF_60_RATIO", _over("DEF_60_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE", " + 1")),
]
_SIX_LATE = [
    ("CITY_RATING_x_EXT2", "REGION_RATING_CLIENT_W_CITY * EXT_SOURCE_2"), ("EMPLOYED_TO_ID", _over("DAYS_EMPLOYED", "DAYS_ID_PUBLISH", " + 1")),
    ("ID_TO_BIRTH_RATIO", _over("DAYS_ID_PUBLISH", "DAYS_BIRTH", " + 1")), ("REG_TO_EMPLOYED_RATIO", _over("DAYS_REGISTRATION", "DAYS_EMPLOYED", " + 1")),
    ("CREDIT_PER_PERSON", _over("AMT_CREDIT", "CNT_FAM_MEMBERS", " + 1")), ("ANNUITY_PER_PERSON", _over("AMT_ANNUITY", "CNT_FAM_MEMBERS", " + 1")),
    ("INCOME_CREDIT_PERC", _over("AMT_INCOME_TOTAL", "AMT_CREDIT", " + 1")), ("INCOME_ANNUITY_PERC", _over("AMT_INCOME_TOTAL", "AMT_ANNUITY", " + 1")),
    ("EXT_RANGE", "EXT_MAX - EXT_MIN"), ("EXT_SOURCE_SPREAD", _over("EXT_STD", "EXT_MEAN", " + 0.0001::DOUBLE")),
    ("PHONE_MINUS_REG", "DAYS_LAST_PHONE_CHANGE - DAYS_REGISTRATION"), ("CAR_EMPLOYED_RATIO", _over("OWN_CAR_AGE", "DAYS_EMPLOYED_YRS", " + 1")),
    ("CHILDREN_RATIO", _over("CNT_CHILDREN", "CNT_FAM_MEMBERS", " + 1")), ("OBS_30_60_RATIO", _over("OBS_30_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE", " + 1")),
    ("DEF_30_60_RATIO", _over("DEF_30_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE", " + 1")),
    ("AMT_REQ_SUM", "AMT_REQ_CREDIT_BUREAU_DAY + AMT_REQ_CREDIT_BUREAU_YEAR"), ("FLAG_CONTACTS_SUM", "FLAG_MOBIL + FLAG_EMP_PHONE + FLAG_WORK_PHONE + FLAG_CONT_MOBILE"),
    ("CREDIT_TERM", _over("AMT_ANNUITY", "AMT_CREDIT", " + 1")), ("DAYS_EMPLOYED_PERC", _over("DAYS_EMPLOYED", "DAYS_BIRTH", " + 1")),
    ("INCOME_CREDIT_PERC2", _over("AMT_INCOME_TOTAL", "AMT_CREDIT", " + 1")), ("EXT_WEIGHTED", "2 * EXT_SOURCE_2 + EXT_SOURCE_3 + 0.5::DOUBLE * EXT_SOURCE_1"),
    ("REGION_POP_x_EXT", "REGION_POPULATION_RELATIVE * EXT_MEAN"), ("HOUR_APPR_x_EXT2", "HOUR_APPR_PROCESS_START * EXT_SOURCE_2"),
    ("LIVE_REGION_DIFF", "REG_REGION_NOT_LIVE_REGION + REG_REGION_NOT_WORK_REGION + LIVE_REGION_NOT_WORK_REGION"),
]


def _figures(cells: list[str], source: str) -> str:
    """Long form of features of ``source`` (one row per id) and their sums."""
    listed = ", ".join(f"{{'feature': '{c}', 'x': ({c})::DOUBLE}}" for c in cells)
    return f"""f AS (SELECT SK_ID_CURR AS id, unnest([{listed}], recursive := true) FROM {source}) {_SHOWN}"""


_SHOWN = """
SELECT feature, count(x) AS n, printf('%.5e', sum(x) * 1.037163491::DOUBLE + 0.0) AS total, printf('%.5e', sum(x * (id % 97 + 1)) * 1.037163491::DOUBLE + 0.0) AS weighted
FROM f GROUP BY feature HAVING count(x) > 0"""


def _replaced(changes: dict[str, str]) -> str:
    return "* REPLACE (" + ", ".join(f"{sql} AS {c}" for c, sql in changes.items()) + ")"


def applicant_sql(generation: str) -> str:
    if generation != "6":
        new = [(c, sql) for c, sql, has in _EARLY if generation in has.split()]
        blank = _replaced({"DAYS_EMPLOYED": "nullif(DAYS_EMPLOYED, 365243)", "DAYS_LAST_PHONE_CHANGE": "nullif(DAYS_LAST_PHONE_CHANGE, 0)"})
        return f"""WITH {_APPLICANT}, a1 AS (SELECT {blank} FROM a0),
a2 AS (SELECT *, {', '.join(f'{sql} AS {c}' for c, sql in new)} FROM a1),
{_figures([*_GIVEN, *[c for c, _ in new]], 'a2')}"""
    texts = ["NAME_INCOME_TYPE", "NAME_EDUCATION_TYPE", "OCCUPATION_TYPE"]
    early = ["DAYS_EMPLOYED_ANOM", *[c for c, _ in _SIX_FIRST]]
    # The label is not counted among the missing values.
    nulls = " + ".join(f"({c} IS NULL)::INT" for c in ("SK_ID_CURR", *_GIVEN[1:], *texts, *early))
    return f"""WITH {_APPLICANT},
a1 AS (SELECT {_replaced({'DAYS_EMPLOYED': 'nullif(DAYS_EMPLOYED, 365243)'})}, (DAYS_EMPLOYED = 365243)::INT AS DAYS_EMPLOYED_ANOM FROM a0),
a2 AS (SELECT *, {', '.join(f'{sql} AS {c}' for c, sql in _SIX_FIRST)} FROM a1),
a3 AS (SELECT *, {nulls} AS APP_NULLS, {', '.join(f'{sql} AS {c}' for c, sql in _SIX_LATE)} FROM a2),
{_figures([*_GIVEN, *early, 'APP_NULLS', *[c for c, _ in _SIX_LATE]], 'a3')}"""


def _applicant(generation: str):
    def build(spark, d):
        wide = credit.applicant_features(credit_tables(spark, d)["application"], generation)
        numeric, text = schema.column_classes(wide.drop(credit.KEY))
        return feature_sums(wide.drop(*text))

    return build


for _generation in ("1", "1v2", "2", "3", "4", "5", "6"):
    query(f"credit_application_gen{_generation}_sums", applicant_sql(_generation))(_applicant(_generation))


# Derived columns of the child tables in generation 6, by table.
_NEW = {
    "bureau": [
        ("DEBT_CREDIT_RATIO", _over("AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM", " + 1")), ("OVERDUE_DEBT_RATIO", _over("AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_SUM_DEBT", " + 1")),
        ("AMT_ANNUITY_CREDIT", _over("AMT_ANNUITY", "AMT_CREDIT_SUM", " + 1")), ("CREDIT_OVERDUE_RATIO", _over("AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_SUM", " + 1")),
        ("CREDIT_DURATION", "DAYS_CREDIT_ENDDATE - DAYS_CREDIT"), ("ENDDATE_DIFF", "DAYS_CREDIT_ENDDATE - DAYS_ENDDATE_FACT"), ("DAYS_CREDIT_UPDATE_DIFF", "DAYS_CREDIT_UPDATE - DAYS_CREDIT"),
    ],
    "previous": [
        ("APP_CREDIT_RATIO", _over("AMT_APPLICATION", "AMT_CREDIT", " + 1")), ("CREDIT_GOODS_P", _over("AMT_CREDIT", "AMT_GOODS_PRICE", " + 1")),
        ("APP_GOODS_RATIO", _over("AMT_APPLICATION", "AMT_GOODS_PRICE", " + 1")), ("DOWN_PAYMENT_P", _over("AMT_DOWN_PAYMENT", "AMT_CREDIT", " + 1")),
        ("INTEREST_RATE", _over("CNT_PAYMENT * AMT_ANNUITY - AMT_CREDIT", "AMT_CREDIT", " + 1")), ("DAYS_FIRST_DUE_DIFF", "DAYS_FIRST_DUE - DAYS_FIRST_DRAWING"),
        ("DAYS_LAST_DUE_DIFF", "DAYS_LAST_DUE_1ST_VERSION - DAYS_LAST_DUE"), ("INTEREST_SHARE", "CNT_PAYMENT * AMT_ANNUITY - AMT_CREDIT"),
    ],
    "pos": [("SK_DPD_RATIO", _over("SK_DPD", "SK_DPD_DEF", " + 1")), ("LATE_POS", "coalesce(SK_DPD > 0, false)::INT")],
    "card": [
        ("CC_BAL_LIM_RATIO", _over("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", " + 1")), ("CC_PAY_TOTAL_RATIO", _over("AMT_PAYMENT_TOTAL_CURRENT", "AMT_TOTAL_RECEIVABLE", " + 1")),
        ("CC_DRAW_LIM", _over("AMT_DRAWINGS_CURRENT", "AMT_CREDIT_LIMIT_ACTUAL", " + 1")), ("CC_MIN_PAY_RATIO", _over("AMT_INST_MIN_REGULARITY", "AMT_PAYMENT_CURRENT", " + 1")),
        ("CC_LATE", "coalesce(SK_DPD > 0, false)::INT"),
    ],
    "installments": [
        ("PAYMENT_DIFF", "AMT_INSTALMENT - AMT_PAYMENT"), ("PAYMENT_PERC", _over("AMT_PAYMENT", "AMT_INSTALMENT", " + 0.001::DOUBLE")),
        ("DPD", "greatest(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT, 0)"), ("DBD", "greatest(DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT, 0)"),
        ("LATE_PAYMENT", "coalesce(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT > 0, false)::INT"), ("SIGNIFICANT_UNDERPAY", "coalesce(AMT_INSTALMENT - AMT_PAYMENT > 100, false)::INT"),
    ],
}
# Prefix, time, slices (name, condition, columns, statistics), decay and trend of each table.
_MMS, _STATUS4 = ("MEAN", "MAX", "SUM"), ("MEAN", "SUM", "MAX", "MIN")
_ACTIVE = ["AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "DAYS_CREDIT", "DAYS_CREDIT_ENDDATE", "DEBT_CREDIT_RATIO"]
_DECIDED = ["AMT_CREDIT", "AMT_APPLICATION", "AMT_ANNUITY", "DAYS_DECISION"]
_PLANS = {
    "bureau": (
        "BURO", "DAYS_CREDIT", [(s.upper(), f"CREDIT_ACTIVE = '{s}'", _ACTIVE, _STATUS4) for s in ("Active", "Closed")],
        {"6M": -180, "1Y": -365, "2Y": -730, "3Y": -1095, "5Y": -1825}, ["AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "CREDIT_DAY_OVERDUE", "DEBT_CREDIT_RATIO"],
        (["AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "DEBT_CREDIT_RATIO"], 0.001), ["AMT_CREDIT_SUM_DEBT", "DEBT_CREDIT_RATIO"],
    ),
    "previous": (
        "PREV", "DAYS_DECISION",
        [(s.upper(), f"NAME_CONTRACT_STATUS = '{s}'", _DECIDED, ("MEAN", "MAX", "MIN")) for s in ("Approved", "Refused", "Canceled")]
        + [(n, f"NAME_CONTRACT_TYPE = '{s}'", ["AMT_CREDIT", "AMT_ANNUITY", "APP_CREDIT_RATIO"], ("MEAN", "SUM", "MAX")) for n, s in (("CASH", "Cash loans"), ("REVOLV", "Revolving loans"))],
        {"6M": -180, "1Y": -365, "2Y": -730, "3Y": -1095}, ["AMT_CREDIT", "AMT_ANNUITY", "APP_CREDIT_RATIO", "INTEREST_RATE"],
        (["AMT_CREDIT", "AMT_ANNUITY", "APP_CREDIT_RATIO"], 0.001), [],
    ),
    "pos": (
        "POS", "MONTHS_BALANCE", [], {"3M": -3, "6M": -6, "12M": -12, "24M": -24}, ["SK_DPD", "SK_DPD_DEF", "CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE"],
        (["SK_DPD", "CNT_INSTALMENT_FUTURE"], 0.02), ["SK_DPD"],
    ),
    "card": (
        "CC", "MONTHS_BALANCE", [], {"3M": -3, "6M": -6, "12M": -12, "24M": -24}, ["AMT_BALANCE", "CC_BAL_LIM_RATIO", "CC_DRAW_LIM", "SK_DPD"],
        (["AMT_BALANCE", "CC_BAL_LIM_RATIO", "SK_DPD"], 0.02), ["AMT_BALANCE", "CC_BAL_LIM_RATIO"],
    ),
    "installments": (
        "INS", "DAYS_INSTALMENT", [], {"6M": -180, "1Y": -365, "2Y": -730}, ["DPD", "PAYMENT_PERC", "PAYMENT_DIFF", "LATE_PAYMENT"],
        (["DPD", "PAYMENT_PERC", "PAYMENT_DIFF"], 0.001), ["DPD", "PAYMENT_PERC"],
    ),
}
# Single figures per applicant; per loan first (name, figure), then mean, max and deviation over loans;
# and columns whose newest value counts.
_SINGLE = {
    "bureau": [("BURO_CREDIT_TYPE_NUNIQUE", "count(DISTINCT CREDIT_TYPE)"), ("BURO_OVERDUE_EVER", "coalesce(max(CREDIT_DAY_OVERDUE) > 0, false)::INT")],
    "previous": [("PREV_APPROVAL_RATE", "avg(coalesce(NAME_CONTRACT_STATUS = 'Approved', false)::INT)")],
    "pos": [
        ("POS_LATE_RATE", "avg(LATE_POS)"),
        ("POS_COMPLETED_RATE", "nullif(count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Completed'), 0) / count(*)::DOUBLE"),
    ],
    "card": [("CC_LATE_RATE", "avg(CC_LATE)")],
    "installments": [
        ("INS_LATE_RATE", "avg(LATE_PAYMENT)"), ("INS_SIGUNDERPAY_RATE", "avg(SIGNIFICANT_UNDERPAY)"), ("INS_VERSION_NUNIQUE", "count(DISTINCT NUM_INSTALMENT_VERSION)"),
        ("INS_VERSION_MAX", "max(NUM_INSTALMENT_VERSION)"), ("INS_VERSION_MEAN", "avg(NUM_INSTALMENT_VERSION)"),
    ],
}
_LOANS = {
    "pos": [("POS_PL_DPD_MAX", "max(SK_DPD)"), ("POS_PL_DPD_MEAN", "avg(SK_DPD)"), ("POS_PL_LATE_RATE", "avg(LATE_POS)"), ("POS_PL_MONTHS", "count(MONTHS_BALANCE)")],
    "card": [
        ("CC_PL_BAL_LIM_MAX", "max(CC_BAL_LIM_RATIO)"), ("CC_PL_BAL_LIM_MEAN", "avg(CC_BAL_LIM_RATIO)"), ("CC_PL_DRAW_MEAN", "avg(CC_DRAW_LIM)"),
        ("CC_PL_DPD_MAX", "max(SK_DPD)"), ("CC_PL_LATE_RATE", "avg(CC_LATE)"),
    ],
    "installments": [
        ("INS_PL_DPD_MEAN", "avg(DPD)"), ("INS_PL_DPD_MAX", "max(DPD)"), ("INS_PL_LATE_SUM", "coalesce(sum(LATE_PAYMENT), 0)"), ("INS_PL_LATE_RATE", "avg(LATE_PAYMENT)"),
        ("INS_PL_PAYPERC_MEAN", "avg(PAYMENT_PERC)"), ("INS_PL_PAYPERC_MIN", "min(PAYMENT_PERC)"), ("INS_PL_PAYDIFF_MAX", "max(PAYMENT_DIFF)"), ("INS_PL_COUNT", "count(*)"),
    ],
}
_NEWEST = {
    "bureau": ["DAYS_CREDIT", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "DEBT_CREDIT_RATIO", "CREDIT_DAY_OVERDUE"],
    "previous": ["DAYS_DECISION", "AMT_CREDIT", "APP_CREDIT_RATIO", "INTEREST_RATE"],
}
_FIGURE = {"MEAN": "avg(v)", "MAX": "max(v)", "MIN": "min(v)", "SUM": "coalesce(sum(v), 0)", "VAR": "var_samp(v)"}
_NAME = lambda x: f"upper(trim(regexp_replace({x}, '[^0-9A-Za-z]+', '_', 'g'), '_'))"


def child6_sql(table: str) -> str:
    source, columns = _CHILDREN[table]
    prefix, time, statuses, windows, watched, (decayed, rate), trends = _PLANS[table]
    names = [c for c, _ in columns]
    balance, more = "", []
    if table == "bureau":
        balance = f""",
b AS (SELECT l_orderkey AS SK_ID_BUREAU, min(-l_linenumber) AS BB_MONTHS_BALANCE_MIN, max(-l_linenumber) AS BB_MONTHS_BALANCE_MAX, count(*) AS BB_MONTHS_BALANCE_SIZE,
             {', '.join(f"count(*) FILTER (WHERE l_returnflag = '{v}') AS BB_STATUS_{v}" for v in _STATUSES)} FROM lineitem GROUP BY 1)"""
        more = ["BB_MONTHS_BALANCE_MIN", "BB_MONTHS_BALANCE_MAX", "BB_MONTHS_BALANCE_SIZE", *[f"BB_STATUS_{v}" for v in _STATUSES]]
    blank = {c: f"nullif({c}, 365243)" for c in names if table == "previous" and c.startswith("DAYS_")}
    listed = ", ".join(f"{blank.get(c, c)} AS {c}" for c in names) + "".join(f", {c}" for c in more)
    own = [*names, *more, *[c for c, _ in _NEW[table]]]
    numbers = [c for c in own if c not in _IDS and c not in _TEXT]
    parts = []

    def slice_(name: str, condition: str, cols: list[str], stats, count: bool = True) -> None:
        head = f"{prefix}_{name}_" if name else f"{prefix}_"
        cells = ", ".join(f"{{'c': '{c}', 'v': ({c})::DOUBLE}}" for c in cols)
        figures = ", ".join(f"{{'s': '{s}', 'x': ({_FIGURE[s]})::DOUBLE}}" for s in stats)
        parts.append(f"""SELECT id, {_NAME(f"'{head}' || c || '_' || s")} AS feature, x FROM (
  SELECT SK_ID_CURR AS id, c, unnest([{figures}], recursive := true) FROM (SELECT SK_ID_CURR, unnest([{cells}], recursive := true) FROM k WHERE {condition}) GROUP BY SK_ID_CURR, c)""")
        if count:
            parts.append(f"SELECT SK_ID_CURR AS id, '{head}COUNT' AS feature, count(*)::DOUBLE AS x FROM k WHERE {condition} GROUP BY 1")

    slice_("", "true", numbers, ("MIN", "MAX", "MEAN", "SUM", "VAR"))
    for name, condition, cols, stats in statuses:
        slice_(name, condition, cols, stats)
    for name, cut in windows.items():
        slice_(name, f"{time} >= {cut}", watched, _MMS)
    if table != "card":
        for c in own:
            if c in _TEXT:
                parts.append(f"""SELECT SK_ID_CURR AS id, {_NAME(f"'{prefix}_{c}_' || coalesce(u.v, 'nan') || '_MEAN'")} AS feature, avg(({c} IS NOT DISTINCT FROM u.v)::INT) AS x
  FROM k, (SELECT DISTINCT {c} AS v FROM k WHERE {c} IS NOT NULL UNION ALL SELECT NULL) u GROUP BY SK_ID_CURR, u.v""")
    if table == "installments":
        for n in (3, 5, 10, 30):
            for cols, stats in ((["DPD"], ("MEAN", "MAX")), (["PAYMENT_PERC", "PAYMENT_DIFF", "LATE_PAYMENT"], ("MEAN",))):
                slice_(f"LAST{n}", f"n <= {n}", cols, stats, count=False)
    for c in decayed:
        whole = f"{c} IS NOT NULL AND {time} IS NOT NULL"
        w = f"exp({rate!r}::DOUBLE * {time})"
        parts.append(f"SELECT SK_ID_CURR AS id, '{prefix}_{c}_TWMEAN' AS feature, sum({c} * {w}) FILTER (WHERE {whole}) / nullif(sum({w}) FILTER (WHERE {whole}), 0) AS x FROM k GROUP BY 1")
    for c in trends:
        parts.append(f"""SELECT SK_ID_CURR AS id, '{prefix}_{c}_TREND' AS feature,
  CASE WHEN count(*) >= 3 THEN covar_pop(({c})::DOUBLE, {time}::DOUBLE) * count(*) / (var_pop({time}::DOUBLE) * count(*) + 1e-8::DOUBLE) END AS x
  FROM k WHERE {c} IS NOT NULL AND {time} IS NOT NULL GROUP BY 1""")
    for name, sql in _SINGLE[table]:
        parts.append(f"SELECT SK_ID_CURR AS id, '{name}' AS feature, ({sql})::DOUBLE AS x FROM k GROUP BY 1")
    if table in _LOANS:
        per = ", ".join(f"({sql})::DOUBLE AS {name}" for name, sql in _LOANS[table])
        cells = ", ".join(f"{{'c': '{name}', 'v': {name}}}" for name, _ in _LOANS[table])
        figures = "{'s': 'MEAN', 'x': avg(v)}, {'s': 'MAX', 'x': max(v)}, {'s': 'STD', 'x': stddev_samp(v)}"
        parts.append(f"""SELECT id, c || '_' || s AS feature, x FROM (SELECT SK_ID_CURR AS id, c, unnest([{figures}], recursive := true) FROM (
  SELECT SK_ID_CURR, unnest([{cells}], recursive := true) FROM (SELECT SK_ID_CURR, SK_ID_PREV, {per} FROM k WHERE SK_ID_PREV IS NOT NULL GROUP BY 1, 2)) GROUP BY SK_ID_CURR, c)""")
    for c in _NEWEST.get(table, []):
        parts.append(f"SELECT SK_ID_CURR AS id, '{prefix}_LAST_{c}' AS feature, ({c})::DOUBLE AS x FROM k WHERE {c} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY n) = 1")
    # Newest first, ties by all other columns; a table with a joined key has that key first.
    order = own if table != "bureau" else ["SK_ID_BUREAU", *[c for c in own if c != "SK_ID_BUREAU"]]
    order = [time, *[c for c in order if c not in (time, "SK_ID_CURR")]]
    body = "\nUNION ALL\n".join(parts)
    return f"""WITH {INSTALMENTS}{balance},
c0 AS (SELECT {', '.join(f'{sql} AS {c}' for c, sql in columns)} FROM {source}),
c1 AS (SELECT {listed} FROM c0{' LEFT JOIN b USING (SK_ID_BUREAU)' if table == 'bureau' else ''}),
c2 AS (SELECT *, {', '.join(f'{sql} AS {c}' for c, sql in _NEW[table])} FROM c1),
k AS (SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY {', '.join(f'{c} DESC NULLS LAST' for c in order)}) AS n FROM c2 WHERE SK_ID_CURR IS NOT NULL),
f AS ({body}){_SHOWN}"""


for _table in _CHILDREN:
    query(f"credit_{_table}_gen6_sums", child6_sql(_table))(_sums(_table, "6"))
