"""Presets for the credit schema: derived columns, slices and rollups of each generation.

A generation is one of "1", "1v2", "2", "3", "4", "5", "6". Divisions by zero give NULL; ids
are never aggregated; category lists and 0/1 columns are determined once per table, so that all
slices of a table have the same columns.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions import expr as E
from rowloom.operators import rollup as R
from rowloom.operators import schema
from rowloom.operators.assemble import join_features, union_by_name
from rowloom.operators.encode import Factorize
from rowloom.operators.rollup import Decay, Slice, Trend
from rowloom.session import dropped_shuffles, is_planned_small, stored

KEY, LABEL = "SK_ID_CURR", "TARGET"
IDS = ("SK_ID_CURR", "SK_ID_PREV", "SK_ID_BUREAU")
GENERATIONS = ("1", "1v2", "2", "3", "4", "5", "6")

# Keys and file names of prediction files, most preferred first.
PREDICTION_FILES = [
    ("sub6", "submission6.csv"),
    ("sub4", "submission4.csv"),
    ("sub3", "submission3.csv"),
    ("sub1", "submission1_v2.csv"),
    ("sub_blend", "submission_blend.csv"),
    ("sub_blend_v2_raw", "submission_blend_v2_raw.csv"),
    ("sub_blend_v2_d", "submission_blend_v2_d.csv"),
    ("sub5", "submission5.csv"),
    ("sub2", "submission2.csv"),
    ("sub0", "submission.csv"),
]

# Blend candidates (name, weights, mode) of the three blend rounds.
BLEND_1 = [("submission_blend", {"sub0": 0.85, "sub2": 0.15}, "rank")]
BLEND_2 = [
    ("submission_blend_v2_a", {"sub4": 0.85, "sub_blend": 0.15}, "rank"),
    ("submission_blend_v2_b", {"sub4": 0.70, "sub_blend": 0.15, "sub1": 0.15}, "rank"),
    ("submission_blend_v2_c", {"sub4": 0.60, "sub3": 0.25, "sub_blend": 0.15}, "rank"),
    ("submission_blend_v2_d", {"sub4": 0.55, "sub1": 0.20, "sub3": 0.15, "sub_blend": 0.10}, "rank"),
    ("submission_blend_v2_raw", {"sub4": 0.70, "sub3": 0.20, "sub1": 0.10}, "raw"),
]
BLEND_3 = [
    ("submission_blend_v3_a", {"sub6": 0.90, "sub_blend": 0.10}, "rank"),
    ("submission_blend_v3_b", {"sub6": 0.80, "sub_blend": 0.10, "sub1": 0.10}, "rank"),
    ("submission_blend_v3_c", {"sub6": 0.75, "sub4": 0.15, "sub_blend": 0.10}, "raw"),
    ("submission_blend_v3_d", {"sub6": 0.70, "sub_blend_v2_raw": 0.20, "sub1": 0.10}, "raw"),
    ("submission_blend_v3_e", {"sub6": 0.70, "sub_blend_v2_d": 0.20, "sub_blend": 0.10}, "rank"),
    ("submission_blend_v3_f", {"sub6": 0.65, "sub4": 0.15, "sub3": 0.10, "sub_blend": 0.10}, "raw"),
]

# Sentinels for a missing day.
NO_DAY = 365243

# Ratios of the applicant, generations 1 to 5: (name, numerator, denominator, eps).
APPLICANT_RATIOS = [
    ("APP_CREDIT_INCOME_RATIO", "AMT_CREDIT", "AMT_INCOME_TOTAL", 0),
    ("APP_ANNUITY_INCOME_RATIO", "AMT_ANNUITY", "AMT_INCOME_TOTAL", 0),
    ("APP_CREDIT_ANNUITY_RATIO", "AMT_CREDIT", "AMT_ANNUITY", 0),
    ("APP_GOODS_CREDIT_RATIO", "AMT_GOODS_PRICE", "AMT_CREDIT", 0),
    ("APP_INCOME_PER_PERSON", "AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS", 0),
    ("APP_EMPLOYED_BIRTH_RATIO", "DAYS_EMPLOYED", "DAYS_BIRTH", 0),
    ("APP_ANNUITY_LENGTH", "AMT_ANNUITY", "AMT_CREDIT", 0),
    ("APP_CREDIT_GOODS_RATIO", "AMT_CREDIT", "AMT_GOODS_PRICE", 0),
    ("APP_EXT_SOURCE_1_BY_3", "EXT_SOURCE_1", "EXT_SOURCE_3", 0),
    ("APP_EXT_SOURCE_2_BY_3", "EXT_SOURCE_2", "EXT_SOURCE_3", 0),
]
EXT = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]

# Applicant columns of generation 6 that precede its null count.
APPLICANT6_FORMULAS = [
    ("EXT_PROD", "EXT_SOURCE_1 * EXT_SOURCE_2 * EXT_SOURCE_3"),
    ("EXT_S1xS2", "EXT_SOURCE_1 * EXT_SOURCE_2"),
    ("EXT_S1xS3", "EXT_SOURCE_1 * EXT_SOURCE_3"),
    ("EXT_S2xS3", "EXT_SOURCE_2 * EXT_SOURCE_3"),
    ("EXT_SOURCE_1_SQ", "power(EXT_SOURCE_1, 2)"),
    ("EXT_SOURCE_1_CB", "power(EXT_SOURCE_1, 3)"),
    ("EXT_SOURCE_2_SQ", "power(EXT_SOURCE_2, 2)"),
    ("EXT_SOURCE_2_CB", "power(EXT_SOURCE_2, 3)"),
    ("EXT_SOURCE_3_SQ", "power(EXT_SOURCE_3, 2)"),
    ("EXT_SOURCE_3_CB", "power(EXT_SOURCE_3, 3)"),
    ("EXT_S2xBIRTH", "EXT_SOURCE_2 * DAYS_BIRTH"),
    ("EXT_S1xBIRTH", "EXT_SOURCE_1 * DAYS_BIRTH"),
    ("EXT_S3xBIRTH", "EXT_SOURCE_3 * DAYS_BIRTH"),
    ("EXT_S2xEMPL", "EXT_SOURCE_2 * DAYS_EMPLOYED"),
    ("EXT_S3xEMPL", "EXT_SOURCE_3 * DAYS_EMPLOYED"),
    ("GP1", "power(EXT_SOURCE_2, 2) * EXT_SOURCE_3"),
    ("GP3", "EXT_SOURCE_2 * REGION_RATING_CLIENT_W_CITY"),
    ("GP4", "EXT_SOURCE_3 * ln(1 + abs(DAYS_BIRTH))"),
    ("DOWN_PAYMENT", "AMT_GOODS_PRICE - AMT_CREDIT"),
    ("DAYS_BIRTH_YRS", "DAYS_BIRTH / -365.25e0"),
    ("DAYS_EMPLOYED_YRS", "DAYS_EMPLOYED / -365.25e0"),
    ("INCOME_EMPLOYED", "AMT_INCOME_TOTAL * (DAYS_EMPLOYED / -365.25e0)"),
]
APPLICANT6_RATIOS = [
    ("EXT_S2divS3", "EXT_SOURCE_2", "EXT_SOURCE_3", 1e-4),
    ("EXT_S1divS2", "EXT_SOURCE_1", "EXT_SOURCE_2", 1e-4),
    ("GP2", "EXT_SOURCE_1 * DAYS_BIRTH", "AMT_ANNUITY", 1),
    ("GP5", "AMT_ANNUITY * EXT_SOURCE_3", "AMT_INCOME_TOTAL", 1),
    ("GP6", "EXT_SOURCE_1 * DAYS_ID_PUBLISH", "DAYS_BIRTH", 1),
    ("GP7", "EXT_SOURCE_2 * AMT_CREDIT", "AMT_GOODS_PRICE", 1),
    ("GP8", "EXT_SOURCE_1 * EXT_SOURCE_2 * EXT_SOURCE_3", "AMT_CREDIT", 1),
    ("GP9", "EXT_MEAN * DAYS_EMPLOYED", "DAYS_BIRTH", -1),
    ("GP10", "(AMT_GOODS_PRICE - AMT_CREDIT) * EXT_SOURCE_2", "AMT_ANNUITY", 1),
    ("CREDIT_INCOME_RATIO", "AMT_CREDIT", "AMT_INCOME_TOTAL", 1),
    ("ANNUITY_INCOME_RATIO", "AMT_ANNUITY", "AMT_INCOME_TOTAL", 1),
    ("CREDIT_ANNUITY_RATIO", "AMT_CREDIT", "AMT_ANNUITY", 1),
    ("CREDIT_GOODS_RATIO", "AMT_CREDIT", "AMT_GOODS_PRICE", 1),
    ("GOODS_INCOME_RATIO", "AMT_GOODS_PRICE", "AMT_INCOME_TOTAL", 1),
    ("INCOME_PER_CHILD", "AMT_INCOME_TOTAL", "CNT_CHILDREN", 1),
    ("INCOME_PER_FAM", "AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS", 1),
    ("ANNUITY_CREDIT_RATIO", "AMT_ANNUITY", "AMT_CREDIT", 1),
    ("PAYMENT_LENGTH", "AMT_CREDIT", "AMT_ANNUITY", 1),
    ("DOWN_PAYMENT_RATIO", "DOWN_PAYMENT", "AMT_GOODS_PRICE", 1),
    ("EMPLOYED_TO_BIRTH", "DAYS_EMPLOYED", "DAYS_BIRTH", 1),
    ("CAR_AGE_TO_BIRTH", "OWN_CAR_AGE", "DAYS_BIRTH_YRS", 1),
    ("ID_PUBLISH_TO_BIRTH", "DAYS_ID_PUBLISH", "DAYS_BIRTH", 1),
    ("PHONE_TO_BIRTH", "DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH", 1),
    ("PHONE_TO_EMPLOYED", "DAYS_LAST_PHONE_CHANGE", "DAYS_EMPLOYED", 1),
    ("REG_TO_BIRTH", "DAYS_REGISTRATION", "DAYS_BIRTH", 1),
    ("DEF_30_RATIO", "DEF_30_CNT_SOCIAL_CIRCLE", "OBS_30_CNT_SOCIAL_CIRCLE", 1),
    ("DEF_60_RATIO", "DEF_60_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE", 1),
]
# Applicant columns of generation 6 that follow its null count.
APPLICANT6_LATE_FORMULAS = [
    ("CITY_RATING_x_EXT2", "REGION_RATING_CLIENT_W_CITY * EXT_SOURCE_2"),
    ("EXT_RANGE", "EXT_MAX - EXT_MIN"),
    ("PHONE_MINUS_REG", "DAYS_LAST_PHONE_CHANGE - DAYS_REGISTRATION"),
    ("EXT_WEIGHTED", "2 * EXT_SOURCE_2 + EXT_SOURCE_3 + 0.5e0 * EXT_SOURCE_1"),
    ("REGION_POP_x_EXT", "REGION_POPULATION_RELATIVE * EXT_MEAN"),
    ("HOUR_APPR_x_EXT2", "HOUR_APPR_PROCESS_START * EXT_SOURCE_2"),
]
APPLICANT6_LATE_RATIOS = [
    ("EMPLOYED_TO_ID", "DAYS_EMPLOYED", "DAYS_ID_PUBLISH", 1),
    ("ID_TO_BIRTH_RATIO", "DAYS_ID_PUBLISH", "DAYS_BIRTH", 1),
    ("REG_TO_EMPLOYED_RATIO", "DAYS_REGISTRATION", "DAYS_EMPLOYED", 1),
    ("CREDIT_PER_PERSON", "AMT_CREDIT", "CNT_FAM_MEMBERS", 1),
    ("ANNUITY_PER_PERSON", "AMT_ANNUITY", "CNT_FAM_MEMBERS", 1),
    ("INCOME_CREDIT_PERC", "AMT_INCOME_TOTAL", "AMT_CREDIT", 1),
    ("INCOME_ANNUITY_PERC", "AMT_INCOME_TOTAL", "AMT_ANNUITY", 1),
    ("EXT_SOURCE_SPREAD", "EXT_STD", "EXT_MEAN", 1e-4),
    ("CAR_EMPLOYED_RATIO", "OWN_CAR_AGE", "DAYS_EMPLOYED_YRS", 1),
    ("CHILDREN_RATIO", "CNT_CHILDREN", "CNT_FAM_MEMBERS", 1),
    ("OBS_30_60_RATIO", "OBS_30_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE", 1),
    ("DEF_30_60_RATIO", "DEF_30_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE", 1),
    ("CREDIT_TERM", "AMT_ANNUITY", "AMT_CREDIT", 1),
    ("DAYS_EMPLOYED_PERC", "DAYS_EMPLOYED", "DAYS_BIRTH", 1),
    ("INCOME_CREDIT_PERC2", "AMT_INCOME_TOTAL", "AMT_CREDIT", 1),
]
AGE_EDGES = [0, 25, 30, 35, 40, 45, 50, 55, 60, 65, 100]
CONTACT_FLAGS = ["FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE", "FLAG_PHONE", "FLAG_EMAIL"]
REGION_FLAGS = ["REG_REGION_NOT_LIVE_REGION", "REG_REGION_NOT_WORK_REGION", "LIVE_REGION_NOT_WORK_REGION"]

# Derived columns of the child tables in generation 6.
CHILD6_RATIOS = {
    "bureau": [
        ("DEBT_CREDIT_RATIO", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM", 1),
        ("OVERDUE_DEBT_RATIO", "AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_SUM_DEBT", 1),
        ("AMT_ANNUITY_CREDIT", "AMT_ANNUITY", "AMT_CREDIT_SUM", 1),
        ("CREDIT_OVERDUE_RATIO", "AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_SUM", 1),
    ],
    "previous": [
        ("APP_CREDIT_RATIO", "AMT_APPLICATION", "AMT_CREDIT", 1),
        ("CREDIT_GOODS_P", "AMT_CREDIT", "AMT_GOODS_PRICE", 1),
        ("APP_GOODS_RATIO", "AMT_APPLICATION", "AMT_GOODS_PRICE", 1),
        ("DOWN_PAYMENT_P", "AMT_DOWN_PAYMENT", "AMT_CREDIT", 1),
        ("INTEREST_RATE", "CNT_PAYMENT * AMT_ANNUITY - AMT_CREDIT", "AMT_CREDIT", 1),
    ],
    "pos": [("SK_DPD_RATIO", "SK_DPD", "SK_DPD_DEF", 1)],
    "card": [
        ("CC_BAL_LIM_RATIO", "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", 1),
        ("CC_PAY_TOTAL_RATIO", "AMT_PAYMENT_TOTAL_CURRENT", "AMT_TOTAL_RECEIVABLE", 1),
        ("CC_DRAW_LIM", "AMT_DRAWINGS_CURRENT", "AMT_CREDIT_LIMIT_ACTUAL", 1),
        ("CC_MIN_PAY_RATIO", "AMT_INST_MIN_REGULARITY", "AMT_PAYMENT_CURRENT", 1),
    ],
    "installments": [("PAYMENT_PERC", "AMT_PAYMENT", "AMT_INSTALMENT", 0.001)],
}
CHILD6_FORMULAS = {
    "bureau": [
        ("CREDIT_DURATION", "DAYS_CREDIT_ENDDATE - DAYS_CREDIT"),
        ("ENDDATE_DIFF", "DAYS_CREDIT_ENDDATE - DAYS_ENDDATE_FACT"),
        ("DAYS_CREDIT_UPDATE_DIFF", "DAYS_CREDIT_UPDATE - DAYS_CREDIT"),
    ],
    "previous": [
        ("DAYS_FIRST_DUE_DIFF", "DAYS_FIRST_DUE - DAYS_FIRST_DRAWING"),
        ("DAYS_LAST_DUE_DIFF", "DAYS_LAST_DUE_1ST_VERSION - DAYS_LAST_DUE"),
        ("INTEREST_SHARE", "CNT_PAYMENT * AMT_ANNUITY - AMT_CREDIT"),
    ],
    "pos": [],
    "card": [],
    "installments": [("PAYMENT_DIFF", "AMT_INSTALMENT - AMT_PAYMENT")],
}
PREFIX6 = {"bureau": "BURO", "previous": "PREV", "pos": "POS", "card": "CC", "installments": "INS"}
PREFIX = {**PREFIX6, "installments": "INSTAL"}
TIME = {
    "bureau": "DAYS_CREDIT",
    "previous": "DAYS_DECISION",
    "pos": "MONTHS_BALANCE",
    "card": "MONTHS_BALANCE",
    "installments": "DAYS_INSTALMENT",
}

# Slices of generations 1 to 5: recency (name, cutoff), last k, first k.
_12M = {"bureau": -365, "previous": -365, "installments": -365, "pos": -12, "card": -12}


def _recent(table: str, name: str, cutoff: int | None = None) -> Slice:
    return Slice(name, f"{TIME[table]} >= {_12M[table] if cutoff is None else cutoff}")


RECENCY: dict[str, dict[str, list[tuple[str, int | None]]]] = {
    "1": {t: [("RECENT", -730 if t == "previous" else None)] for t in TIME},
    "1v2": {
        "bureau": [("RECENT_12M", None)],
        "previous": [("RECENT_24M", -730)],
        "pos": [("RECENT_12M", None)],
        "installments": [("LAST_60D", -60), ("LAST_90D", -90), ("LAST_180D", -180), ("LAST_365D", -365)],
        "card": [("RECENT_12M", None)],
    },
    "2": {t: [("RECENT", None)] for t in TIME},
    "3": {
        t: [("RECENT_12M", None)] + ([("RECENT_24M", -730)] if t in ("bureau", "previous") else []) for t in TIME
    },
}
RECENCY["4"] = RECENCY["5"] = RECENCY["3"]
LAST_K = {
    "1v2": {"previous": (3, 5), "pos": (3, 5, 10), "installments": (2, 3, 5), "card": (3, 5, 10)},
    "4": {**{t: (1, 3, 5, 10) for t in TIME}, "previous": (3, 5)},
}
LAST_K["5"] = LAST_K["4"]
FIRST_K = {g: {"previous": (2, 4)} for g in ("1v2", "4", "5")}
RATIO_PAIRS = {
    "2": [("BURO_RECENT_AMT_CREDIT_SUM_DEBT_MEAN", "BURO_AMT_CREDIT_SUM_DEBT_MEAN", "BURO_TREND_DEBT_RATIO")],
    "3": [
        ("BURO_RECENT_12M_AMT_CREDIT_SUM_DEBT_MEAN", "BURO_AMT_CREDIT_SUM_DEBT_MEAN", "BURO_TREND_DEBT_RATIO_12M"),
        ("BURO_RECENT_24M_AMT_CREDIT_SUM_DEBT_MEAN", "BURO_AMT_CREDIT_SUM_DEBT_MEAN", "BURO_TREND_DEBT_RATIO_24M"),
    ],
}
RATIO_PAIRS["4"] = RATIO_PAIRS["5"] = [
    *RATIO_PAIRS["3"],
    ("BURO_LAST_1_AMT_CREDIT_SUM_DEBT_MEAN", "BURO_AMT_CREDIT_SUM_DEBT_MEAN", "BURO_LAST1_DEBT_RATIO"),
    ("BURO_LAST_3_AMT_CREDIT_SUM_DEBT_MEAN", "BURO_AMT_CREDIT_SUM_DEBT_MEAN", "BURO_LAST3_DEBT_RATIO"),
]

# Rollups of generation 6.
WINDOWS6 = {
    "bureau": (["AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "CREDIT_DAY_OVERDUE", "DEBT_CREDIT_RATIO"],
               {"6M": -180, "1Y": -365, "2Y": -730, "3Y": -1095, "5Y": -1825}),
    "previous": (["AMT_CREDIT", "AMT_ANNUITY", "APP_CREDIT_RATIO", "INTEREST_RATE"],
                 {"6M": -180, "1Y": -365, "2Y": -730, "3Y": -1095}),
    "pos": (["SK_DPD", "SK_DPD_DEF", "CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE"],
            {"3M": -3, "6M": -6, "12M": -12, "24M": -24}),
    "card": (["AMT_BALANCE", "CC_BAL_LIM_RATIO", "CC_DRAW_LIM", "SK_DPD"],
             {"3M": -3, "6M": -6, "12M": -12, "24M": -24}),
    "installments": (["DPD", "PAYMENT_PERC", "PAYMENT_DIFF", "LATE_PAYMENT"],
                     {"6M": -180, "1Y": -365, "2Y": -730}),
}
DECAY6 = {
    "bureau": (["AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "DEBT_CREDIT_RATIO"], 0.001),
    "previous": (["AMT_CREDIT", "AMT_ANNUITY", "APP_CREDIT_RATIO"], 0.001),
    "pos": (["SK_DPD", "CNT_INSTALMENT_FUTURE"], 0.02),
    "card": (["AMT_BALANCE", "CC_BAL_LIM_RATIO", "SK_DPD"], 0.02),
    "installments": (["DPD", "PAYMENT_PERC", "PAYMENT_DIFF"], 0.001),
}
TREND6 = {
    "bureau": ["AMT_CREDIT_SUM_DEBT", "DEBT_CREDIT_RATIO"],
    "previous": [],
    "pos": ["SK_DPD"],
    "card": ["AMT_BALANCE", "CC_BAL_LIM_RATIO"],
    "installments": ["DPD", "PAYMENT_PERC"],
}
STATUS6 = {
    "bureau": [
        (s.upper(), "CREDIT_ACTIVE", s,
         ["AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "DAYS_CREDIT", "DAYS_CREDIT_ENDDATE", "DEBT_CREDIT_RATIO"],
         ["mean", "sum", "max", "min"])
        for s in ("Active", "Closed")
    ],
    "previous": [
        (s.upper(), "NAME_CONTRACT_STATUS", s, ["AMT_CREDIT", "AMT_APPLICATION", "AMT_ANNUITY", "DAYS_DECISION"],
         ["mean", "max", "min"])
        for s in ("Approved", "Refused", "Canceled")
    ] + [
        (label, "NAME_CONTRACT_TYPE", s, ["AMT_CREDIT", "AMT_ANNUITY", "APP_CREDIT_RATIO"], ["mean", "sum", "max"])
        for label, s in (("CASH", "Cash loans"), ("REVOLV", "Revolving loans"))
    ],
}
LATEST6 = {
    "bureau": ["DAYS_CREDIT", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "DEBT_CREDIT_RATIO", "CREDIT_DAY_OVERDUE"],
    "previous": ["DAYS_DECISION", "AMT_CREDIT", "APP_CREDIT_RATIO", "INTEREST_RATE"],
}
PER_LOAN6 = {
    "pos": {
        "POS_PL_DPD_MAX": ("SK_DPD", "max"),
        "POS_PL_DPD_MEAN": ("SK_DPD", "mean"),
        "POS_PL_LATE_RATE": ("LATE_POS", "mean"),
        "POS_PL_MONTHS": ("MONTHS_BALANCE", "count"),
    },
    "card": {
        "CC_PL_BAL_LIM_MAX": ("CC_BAL_LIM_RATIO", "max"),
        "CC_PL_BAL_LIM_MEAN": ("CC_BAL_LIM_RATIO", "mean"),
        "CC_PL_DRAW_MEAN": ("CC_DRAW_LIM", "mean"),
        "CC_PL_DPD_MAX": ("SK_DPD", "max"),
        "CC_PL_LATE_RATE": ("CC_LATE", "mean"),
    },
    "installments": {
        "INS_PL_DPD_MEAN": ("DPD", "mean"),
        "INS_PL_DPD_MAX": ("DPD", "max"),
        "INS_PL_LATE_SUM": ("LATE_PAYMENT", "sum"),
        "INS_PL_LATE_RATE": ("LATE_PAYMENT", "mean"),
        "INS_PL_PAYPERC_MEAN": ("PAYMENT_PERC", "mean"),
        "INS_PL_PAYPERC_MIN": ("PAYMENT_PERC", "min"),
        "INS_PL_PAYDIFF_MAX": ("PAYMENT_DIFF", "max"),
        "INS_PL_COUNT": ("DPD", "size"),
    },
}
LAST6 = {"DPD": ["mean", "max"], "PAYMENT_PERC": ["mean"], "PAYMENT_DIFF": ["mean"], "LATE_PAYMENT": ["mean"]}


def add_ratios(df: DataFrame, specs: Sequence[tuple[str, str, str, float]]) -> DataFrame:
    return df.withColumns({name: E.ratio(F.expr(num), F.expr(den), eps) for name, num, den, eps in specs})


def add_formulas(df: DataFrame, specs: Sequence[tuple[str, str]]) -> DataFrame:
    return df.withColumns({name: F.expr(text) for name, text in specs}) if specs else df


def applicant_features(df: DataFrame, generation: str) -> DataFrame:
    """Derived columns of the parent table (labelled and unlabelled rows together)."""
    if generation == "6":
        return _applicant6(df)
    df = df.withColumns(
        {
            "DAYS_EMPLOYED": E.null_if("DAYS_EMPLOYED", NO_DAY),
            "DAYS_LAST_PHONE_CHANGE": E.null_if("DAYS_LAST_PHONE_CHANGE", 0),
        }
    )
    by_3 = {"APP_EXT_SOURCE_1_BY_3", "APP_EXT_SOURCE_2_BY_3"}
    short = {"APP_ANNUITY_INCOME_RATIO", "APP_CREDIT_ANNUITY_RATIO", "APP_GOODS_CREDIT_RATIO", "APP_EMPLOYED_BIRTH_RATIO"}

    def wanted(name: str) -> bool:
        if generation == "2":
            return name in short
        if name == "APP_CREDIT_GOODS_RATIO":
            return generation == "1v2"
        return name not in by_3 or generation in ("1v2", "4", "5")

    df = add_ratios(df, [r for r in APPLICANT_RATIOS if wanted(r[0])])
    added = {
        "APP_EXT_SOURCES_PROD": E.product(*EXT),
        "APP_EXT_SOURCES_MEAN": E.row_mean(EXT),
        "APP_EXT_SOURCES_NAN_COUNT": E.null_count(EXT),
    }
    if generation != "2":
        added["APP_EXT_SOURCES_STD"] = E.row_std(EXT)
    if generation in ("1v2", "4", "5"):
        added["APP_CREDIT_DOWNPAYMENT"] = E.difference("AMT_GOODS_PRICE", "AMT_CREDIT")
        added["APP_AGE_INT"] = E.whole_years("DAYS_BIRTH")
    df = df.withColumns(added)
    if generation == "1v2" and "REGION_ID_POPULATION" in df.columns:
        df = Factorize("REGION_ID_POPULATION", KEY, "APP_REGION_ID").fit(df).transform(df)
    return df


def _applicant6(df: DataFrame) -> DataFrame:
    raw = df.columns
    df = df.withColumn("DAYS_EMPLOYED_ANOM", E.sentinel_flag("DAYS_EMPLOYED", NO_DAY)).withColumn(
        "DAYS_EMPLOYED", E.null_if("DAYS_EMPLOYED", NO_DAY)
    )
    df = df.withColumns(
        {
            "EXT_MEAN": E.row_mean(EXT),
            "EXT_STD": E.row_std(EXT),
            "EXT_MIN": E.row_min(EXT),
            "EXT_MAX": E.row_max(EXT),
            "EXT_NANCOUNT": E.null_count(EXT),
        }
    )
    df = add_ratios(add_formulas(df, APPLICANT6_FORMULAS), APPLICANT6_RATIOS)
    df = df.withColumns(
        {
            "AGE_RANGE": E.bin_right("DAYS_BIRTH_YRS", AGE_EDGES),
            "DOCUMENT_COUNT": E.row_sum([c for c in raw if "FLAG_DOCUMENT" in c]),
        }
    )
    df = df.withColumn("APP_NULLS", E.null_count([c for c in df.columns if c != LABEL]))
    df = add_ratios(add_formulas(df, APPLICANT6_LATE_FORMULAS), APPLICANT6_LATE_RATIOS)
    contacts = [c for c in CONTACT_FLAGS if c in raw]
    sums = {
        "AMT_REQ_SUM": E.row_sum([c for c in raw if c.startswith("AMT_REQ_CREDIT_BUREAU_")]),
        "LIVE_REGION_DIFF": sum(
            (F.col(c).cast("double") for c in REGION_FLAGS if c in raw), start=F.lit(0.0)
        ),
    }
    if contacts:
        sums["FLAG_CONTACTS_SUM"] = E.row_sum(contacts)
    return df.withColumns(sums)


def blank_days(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: E.null_if(c, NO_DAY) for c in cols if c in df.columns}) if cols else df


def derive_child(df: DataFrame, table: str, generation: str) -> DataFrame:
    """Row-level columns of a child table."""
    if table == "previous":
        df = blank_days(df, [c for c in df.columns if c.startswith("DAYS_")])
    if generation == "6":
        df = add_ratios(add_formulas(df, CHILD6_FORMULAS[table]), CHILD6_RATIOS[table])
        if table == "pos":
            df = df.withColumn("LATE_POS", E.flag(F.col("SK_DPD") > 0))
        if table == "card":
            df = df.withColumn("CC_LATE", E.flag(F.col("SK_DPD") > 0))
        if table == "installments":
            df = df.withColumns(
                {
                    "DPD": E.clip_low(F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")),
                    "DBD": E.clip_low(F.col("DAYS_INSTALMENT") - F.col("DAYS_ENTRY_PAYMENT")),
                }
            ).withColumns(
                {
                    "LATE_PAYMENT": E.flag(F.col("DPD") > 0),
                    "SIGNIFICANT_UNDERPAY": E.flag(F.col("PAYMENT_DIFF") > 100),
                }
            )
        return df
    plus = 1 if generation == "2" else 0
    if table == "bureau":
        if generation != "2":
            df = blank_days(df, ["DAYS_CREDIT_ENDDATE"])
            df = add_ratios(df, [("AMT_CREDIT_SUM_DEBT_OVER_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM", 0)])
        if generation in ("2", "3", "4", "5"):
            df = df.withColumn("BURO_CREDIT_ACTIVE_BINARY", E.flag(F.col("CREDIT_ACTIVE") == "Active"))
    if table == "previous":
        if generation != "2":
            df = add_ratios(df, [("PREV_APP_CREDIT_PERC", "AMT_APPLICATION", "AMT_CREDIT", 0)])
        if generation in ("2", "3", "4", "5"):
            df = df.withColumn("PREV_INTEREST_EST", E.interest_estimate("AMT_ANNUITY", "CNT_PAYMENT", "AMT_CREDIT", plus))
        if generation in ("1v2", "4", "5"):
            df = add_ratios(df, [("PREV_CREDIT_GOODS_RATIO", "AMT_CREDIT", "AMT_GOODS_PRICE", 0)])
    if table == "installments":
        late = F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")
        df = add_ratios(df, [("PAYMENT_PERC", "AMT_PAYMENT", "AMT_INSTALMENT", plus)])
        df = df.withColumn("DPD", E.clip_low(late))
        if generation in ("1v2", "4", "5"):
            df = df.withColumns(
                {"PAYMENT_DIFF": E.difference("AMT_PAYMENT", "AMT_INSTALMENT"), "IS_PAST_DUE": E.flag(late > 0)}
            )
    return df


def with_balance(bureau: DataFrame, balance: DataFrame | None, generation: str) -> DataFrame:
    """Bureau rows with the rollup of their monthly statuses."""
    if balance is None:
        return bureau
    values = schema.categories(balance, ["STATUS"])
    if generation == "6":
        rolled = R.pivot_count(
            balance, "SK_ID_BUREAU", "STATUS", [v for v in values["STATUS"] if v is not None], "BB", "MONTHS_BALANCE"
        )
    else:
        rolled = R.rollup(
            balance, "SK_ID_BUREAU", "BB", ["MONTHS_BALANCE"], values, slices=[Slice(count=True)],
            num_stats=["min", "max"], cat_stats=["mean"],
        ).withColumnRenamed("BB_COUNT", "BB_MONTHS_BALANCE_SIZE")
    return bureau.join(rolled, "SK_ID_BUREAU", "left")


def _order(df: DataFrame, table: str) -> tuple[str, ...]:
    """Time first, then every other column: the same rows win on every run."""
    return (TIME[table], *[c for c in df.columns if c not in (TIME[table], KEY)])


def child_features(df: DataFrame, table: str, generation: str) -> DataFrame:
    """All rollups of one child table, one row per applicant."""
    if table in LAST_K.get(generation, {}) and not is_planned_small(df):
        # Types, categories, hot applicants and slices are found in passes of their own.
        with dropped_shuffles(df.sparkSession):
            df = stored(df, table)
    df = derive_child(df, table, generation)
    numeric, text = schema.column_classes(df.drop(*IDS))
    if generation == "6":
        return _child6(df, table, numeric, text)
    binary = schema.binary_columns(df, numeric)
    numeric = [c for c in numeric if c not in binary]
    order = _order(df, table)
    slices = [Slice(), *[_recent(table, n, cut) for n, cut in RECENCY[generation][table]]]
    slices += [Slice(f"LAST_{k}", last_k=k, order=order) for k in LAST_K.get(generation, {}).get(table, ())]
    slices += [Slice(f"FIRST_{k}", first_k=k, order=order) for k in FIRST_K.get(generation, {}).get(table, ())]
    if table == "installments" and generation in ("1v2", "4", "5"):
        slices.append(Slice("PAST_DUE", "IS_PAST_DUE = 1"))
        slices += [Slice(f"NUM_{i}", f"NUM_INSTALMENT_NUMBER = {i}") for i in (1, 2, 3, 4)]
    out = R.rollup(
        df, KEY, PREFIX[table], numeric, schema.categories(df, text), binary, slices,
        cat_stats=["mean", "sum"] if generation in ("1v2", "4", "5") else ["mean"], together=True,
    )
    if table == "bureau":
        out = R.ratio_of(out, RATIO_PAIRS.get(generation, []), 1 if generation == "2" else 0)
    if generation == "1v2" and table == "bureau":
        active = df.where(F.col("CREDIT_ACTIVE") == "Active").groupBy(KEY)
        out = out.join(active.agg(F.max("DAYS_CREDIT").alias("LAST_ACTIVE_DAYS_CREDIT")), KEY, "left")
    if generation == "1v2" and table == "previous" and "PRODUCT_COMBINATION" in df.columns:
        last = R.latest_values(df, KEY, ["PRODUCT_COMBINATION"], order, "_LAST").withColumnRenamed(
            "LAST_PRODUCT_COMBINATION", "PRODUCT_COMBINATION"
        )
        cells = {
            schema.clean_name(f"PREV_LAST_PRODUCT_COMBINATION_{'nan' if v is None else v}"): E.flag(
                F.col("PRODUCT_COMBINATION").eqNullSafe(F.lit(v))
            )
            for v in schema.categories(df, ["PRODUCT_COMBINATION"])["PRODUCT_COMBINATION"]
        }
        out = out.join(last.withColumns(cells).drop("PRODUCT_COMBINATION"), KEY, "left")
    return out


def _child6(df: DataFrame, table: str, numeric: list[str], text: list[str]) -> DataFrame:
    prefix, time = PREFIX6[table], TIME[table]
    shares = {} if table == "card" else schema.categories(df, text)
    window_cols, windows = WINDOWS6[table]
    slices = [Slice(num={c: ["min", "max", "mean", "sum", "var"] for c in numeric}, count=True)]
    slices += [
        Slice(name, f"{column} = '{value}'", num={c: stats for c in cols}, shares=False, count=True)
        for name, column, value, cols, stats in STATUS6.get(table, [])
    ]
    slices += [
        Slice(name, f"{time} >= {cut}", num={c: ["mean", "max", "sum"] for c in window_cols}, shares=False, count=True)
        for name, cut in windows.items()
    ]
    extra = {}
    if table == "bureau":
        extra["BURO_CREDIT_TYPE_NUNIQUE"] = R.Distinct("CREDIT_TYPE")
        extra["BURO_OVERDUE_EVER"] = R.stat("any", "CREDIT_DAY_OVERDUE")
    if table == "previous":
        extra["PREV_APPROVAL_RATE"] = F.avg(E.flag(F.col("NAME_CONTRACT_STATUS") == "Approved"))
    if table == "pos":
        extra["POS_LATE_RATE"] = F.avg("LATE_POS")
        done = E.flag(F.col("NAME_CONTRACT_STATUS") == "Completed")
        extra["POS_COMPLETED_RATE"] = F.nullif(F.sum(done), F.lit(0)) / F.count(F.lit(1))
    if table == "card":
        extra["CC_LATE_RATE"] = F.avg("CC_LATE")
    if table == "installments":
        extra["INS_LATE_RATE"] = F.avg("LATE_PAYMENT")
        extra["INS_SIGUNDERPAY_RATE"] = F.avg("SIGNIFICANT_UNDERPAY")
        order = _order(df, table)
        slices += [Slice(f"LAST{k}", last_k=k, order=order, num=LAST6, shares=False) for k in (3, 5, 10, 30)]
        if "NUM_INSTALMENT_VERSION" in df.columns:
            for name, how in (("NUNIQUE", "nunique"), ("MAX", "max"), ("MEAN", "mean")):
                extra[f"INS_VERSION_{name}"] = R.Distinct("NUM_INSTALMENT_VERSION") if how == "nunique" else R.stat(how, "NUM_INSTALMENT_VERSION")
    decay_cols, rate = DECAY6[table]
    trends = [Trend(TREND6[table], time)] if TREND6[table] else []
    out = R.rollup(
        df, KEY, prefix, numeric, shares, slices=slices, cat_stats=["mean"],
        decays=[Decay(decay_cols, time, rate)], trends=trends, extra=extra,
    )
    if table in PER_LOAN6:
        out = out.join(R.two_level(df, KEY, "SK_ID_PREV", PER_LOAN6[table]), KEY, "left")
    if table in LATEST6:
        out = out.join(R.latest_values(df, KEY, LATEST6[table], _order(df, table), f"{prefix}_LAST"), KEY, "left")
    return out


def build_dataset(
    tables: Mapping[str, DataFrame], generation: str, enrich: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """One wide row per applicant. ``enrich`` adds columns to the derived applicant table.

    ``tables`` has ``train`` and ``test`` (or one ``application`` with a nullable label) and
    any of bureau, bureau_balance, previous, pos, card, installments; absent ones are skipped.
    """
    if "application" in tables:
        base = tables["application"]
    else:
        base = union_by_name(tables["train"], tables["test"])
    base = applicant_features(base, generation)
    if enrich:
        base = enrich(base)
    features = []
    for name in ("bureau", "previous", "pos", "installments", "card"):
        if name not in tables:
            continue
        child = tables[name]
        if name == "bureau":
            child = with_balance(child, tables.get("bureau_balance"), generation)
        features.append(child_features(child, name, generation))
    return join_features(base, features, KEY)
