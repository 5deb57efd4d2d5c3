"""Presets on small hand-made tables."""

import math

import pytest

from rowloom.plans import credit

BUREAU = (
    "SK_ID_CURR long, SK_ID_BUREAU long, DAYS_CREDIT int, CREDIT_ACTIVE string, CREDIT_TYPE string, "
    "AMT_CREDIT_SUM double, AMT_CREDIT_SUM_DEBT double, AMT_CREDIT_SUM_OVERDUE double, AMT_ANNUITY double, "
    "CREDIT_DAY_OVERDUE int, DAYS_CREDIT_ENDDATE double, DAYS_ENDDATE_FACT double, DAYS_CREDIT_UPDATE double"
)


@pytest.fixture(scope="module")
def bureau(spark):
    rows = [
        (1, 11, -100, "Active", "x", 100.0, 50.0, 0.0, 5.0, 0, 365243.0, None, -10.0),
        (1, 12, -500, "Closed", "y", 300.0, None, 3.0, None, 4, -90.0, -95.0, -80.0),
        (1, 13, -900, "Closed", "x", 0.0, 20.0, 0.0, 1.0, 0, -400.0, -410.0, -300.0),
        (2, 21, -2000, "Sold", "x", 10.0, 1.0, 0.0, 1.0, 0, -5.0, None, -1.0),
    ]
    return spark.createDataFrame(rows, BUREAU).cache()


def test_bureau_generation_4(spark, bureau):
    balance = spark.createDataFrame(
        [(11, -1, "C"), (11, -2, "0"), (12, -1, "C")], "SK_ID_BUREAU long, MONTHS_BALANCE int, STATUS string"
    )
    out = credit.child_features(credit.with_balance(bureau, balance, "4"), "bureau", "4")
    got = {r["SK_ID_CURR"]: r.asDict() for r in out.collect()}
    one = got[1]
    assert one["BURO_AMT_CREDIT_SUM_DEBT_MEAN"] == 35.0 and one["BURO_AMT_CREDIT_SUM_DEBT_SUM"] == 70.0
    assert one["BURO_RECENT_12M_AMT_CREDIT_SUM_DEBT_MEAN"] == 50.0
    assert one["BURO_TREND_DEBT_RATIO_12M"] == pytest.approx(50 / 35)
    assert one["BURO_LAST_1_AMT_CREDIT_SUM_MEAN"] == 100.0 and one["BURO_LAST_3_AMT_CREDIT_SUM_SUM"] == 400.0
    assert one["BURO_DAYS_CREDIT_ENDDATE_MAX"] == -90.0  # the sentinel is missing
    assert one["BURO_AMT_CREDIT_SUM_DEBT_OVER_SUM_MEAN"] == 0.5  # zero denominators are missing
    assert one["BURO_CREDIT_ACTIVE_ACTIVE_MEAN"] == pytest.approx(1 / 3)
    assert one["BURO_BURO_CREDIT_ACTIVE_BINARY_SUM"] == 1
    assert one["BURO_BB_STATUS_C_MEAN_MEAN"] == pytest.approx(0.75)
    assert got[2]["BURO_RECENT_24M_AMT_CREDIT_SUM_SUM"] is None
    assert not [c for c in out.columns if "SK_ID_BUREAU" in c]


def test_bureau_generation_6(bureau):
    out = credit.child_features(credit.with_balance(bureau, None, "6"), "bureau", "6")
    got = {r["SK_ID_CURR"]: r.asDict() for r in out.collect()}
    one, two = got[1], got[2]
    assert one["BURO_COUNT"] == 3 and one["BURO_ACTIVE_COUNT"] == 1 and two["BURO_CLOSED_COUNT"] is None
    assert one["BURO_1Y_AMT_CREDIT_SUM_SUM"] == 100.0 and two["BURO_5Y_COUNT"] is None
    w = [math.exp(0.001 * t) for t in (-100, -500, -900)]
    assert one["BURO_AMT_CREDIT_SUM_TWMEAN"] == pytest.approx((w[0] * 100 + w[1] * 300) / sum(w))
    assert one["BURO_LAST_AMT_CREDIT_SUM_DEBT"] == 50.0 and one["BURO_CREDIT_TYPE_NUNIQUE"] == 2
    assert (one["BURO_OVERDUE_EVER"], two["BURO_OVERDUE_EVER"]) == (1, 0)
    assert one["BURO_DEBT_CREDIT_RATIO_MAX"] == pytest.approx(20.0)


def test_active_last_only_in_1v2(bureau):
    got = {r["SK_ID_CURR"]: r for r in credit.child_features(bureau, "bureau", "1v2").collect()}
    assert got[1]["LAST_ACTIVE_DAYS_CREDIT"] == -100 and got[2]["LAST_ACTIVE_DAYS_CREDIT"] is None
    assert "BURO_RECENT_AMT_CREDIT_SUM_MEAN" in credit.child_features(bureau, "bureau", "1").columns


def test_installments(spark):
    rows = [
        (1, 5, -10.0, -8.0, 100.0, 90.0, 1, 1.0),
        (1, 5, -40.0, -45.0, 100.0, 100.0, 2, 1.0),
        (1, 6, -400.0, None, 500.0, 300.0, 3, 2.0),
    ]
    df = spark.createDataFrame(
        rows,
        "SK_ID_CURR long, SK_ID_PREV long, DAYS_INSTALMENT double, DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, "
        "AMT_PAYMENT double, NUM_INSTALMENT_NUMBER int, NUM_INSTALMENT_VERSION double",
    )
    six = credit.child_features(df, "installments", "6").first().asDict()
    assert six["INS_DPD_MAX"] == 2.0 and six["INS_DBD_MAX"] == 5.0
    assert six["INS_LATE_RATE"] == pytest.approx(1 / 3) and six["INS_SIGUNDERPAY_RATE"] == pytest.approx(1 / 3)
    assert six["INS_PL_COUNT_MAX"] == 2 and six["INS_PL_LATE_SUM_MEAN"] == 0.5
    assert six["INS_VERSION_NUNIQUE"] == 2 and six["INS_LAST3_PAYMENT_DIFF_MEAN"] == pytest.approx(70.0)
    assert six["INS_DPD_TREND"] is None
    four = credit.child_features(df, "installments", "4").first().asDict()
    assert four["INSTAL_PAYMENT_DIFF_MIN"] == -200.0  # paid minus due in generation 4
    assert four["INSTAL_NUM_4_AMT_PAYMENT_SUM"] is None and four["INSTAL_PAST_DUE_AMT_PAYMENT_SUM"] == 90.0
    late = credit.child_features(df, "installments", "1v2").first().asDict()
    assert late["INSTAL_LAST_60D_AMT_PAYMENT_SUM"] == 190.0 and late["INSTAL_LAST_2_AMT_PAYMENT_SUM"] == 190.0


def test_applicant_formulas(spark):
    from rowloom.plans.catalog.presets import credit_tables

    app = credit_tables(spark, "/root/testdata/sf0.001")["application"]
    for raw, row in zip(app.orderBy("SK_ID_CURR").collect(), credit.applicant_features(app, "6").orderBy("SK_ID_CURR").collect()):
        e1, e2, e3 = raw["EXT_SOURCE_1"], raw["EXT_SOURCE_2"], raw["EXT_SOURCE_3"]
        present = [e for e in (e1, e2, e3) if e is not None]
        assert row["EXT_MEAN"] == pytest.approx(sum(present) / len(present))
        assert row["EXT_NANCOUNT"] == 3 - len(present)
        employed = None if raw["DAYS_EMPLOYED"] == 365243 else raw["DAYS_EMPLOYED"]
        assert row["DAYS_EMPLOYED"] == employed and row["DAYS_EMPLOYED_ANOM"] == int(employed is None)
        if e3 is not None:
            assert row["GP1"] == pytest.approx(e2**2 * e3)
            assert row["GP4"] == pytest.approx(e3 * math.log1p(abs(raw["DAYS_BIRTH"])))
        assert row["GP7"] == pytest.approx(e2 * raw["AMT_CREDIT"] / (raw["AMT_GOODS_PRICE"] + 1))
        assert row["CREDIT_TERM"] == pytest.approx(raw["AMT_ANNUITY"] / (raw["AMT_CREDIT"] + 1))
        assert row["AMT_REQ_SUM"] == raw["AMT_REQ_CREDIT_BUREAU_DAY"] + raw["AMT_REQ_CREDIT_BUREAU_YEAR"]
        years = raw["DAYS_BIRTH"] / -365.25
        edges = credit.AGE_EDGES
        assert row["AGE_RANGE"] == next(i for i, hi in enumerate(edges[1:]) if edges[i] < years <= hi)
    four = credit.applicant_features(app, "4").columns
    two = credit.applicant_features(app, "2").columns
    assert "APP_EXT_SOURCE_1_BY_3" in four and "APP_CREDIT_DOWNPAYMENT" in four
    assert "APP_EXT_SOURCES_STD" not in two and "APP_CREDIT_INCOME_RATIO" not in two
