"""The flagship feature table, and the credit presets on the given tables in credit roles."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.functions import expr as E
from rowloom.operators import rollup
from rowloom.operators.assemble import join_features
from rowloom.operators.rollup import Decay, Slice, Trend
from rowloom.plans import credit
from rowloom.plans.catalog.aggregates import _decay, rounded, sql_stats
from rowloom.plans.catalog.registry import BALANCES, DECISIONS, INSTALMENTS, balances, decisions, instalments, query, table

_DAYS = ((180, "6M"), (365, "1Y"), (730, "2Y"))
_STATS = ["mean", "max", "sum"]


@query(
    "feature_table",
    f"""WITH {DECISIONS}, {INSTALMENTS}, {BALANCES},
    d AS (SELECT id, {sql_stats('amount', 'DEC_AMOUNT', _STATS)}, count(*) AS DEC_COUNT,
        {', '.join(sql_stats('amount', f'DEC_{n}_AMOUNT', _STATS, f't >= -{days}') for days, n in _DAYS)},
        {_decay('amount', 0.001)} AS DEC_AMOUNT_TWMEAN,
        round(CASE WHEN count(*) >= 3 THEN covar_pop(amount, t) * count(*) / (var_pop(t) * count(*) + 1e-8) END, 6) AS DEC_AMOUNT_TREND
        FROM decisions GROUP BY id),
    k AS (SELECT id, {', '.join(sql_stats('amount', f'DEC_LAST_{k}_AMOUNT', _STATS, f'rn <= {k}') for k in (1, 3, 5))}
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY t DESC, loan DESC) AS rn FROM decisions) GROUP BY id),
    i AS (SELECT id, {sql_stats('paid', 'INS_PAID', _STATS)}, {sql_stats('dpd', 'INS_DPD', ['mean', 'max'])},
        {sql_stats('paid', 'INS_PAST_DUE_PAID', _STATS, 'dpd > 0')}, {sql_stats('paid', 'INS_NUM_1_PAID', _STATS, 'number = 1')}
        FROM instalments GROUP BY id),
    p AS (SELECT id, {', '.join(sql_stats(c, f'PL_{c.upper()}', ['mean', 'max', 'std']) for c in ('dpd_max', 'n'))}
        FROM (SELECT id, loan, max(dpd) AS dpd_max, count(*) AS n FROM instalments GROUP BY id, loan) GROUP BY id),
    b AS (SELECT id, {sql_stats('value', 'EV_VALUE', _STATS)}, round(avg((status = 'error')::INT), 6) AS EV_STATUS_ERROR_MEAN
        FROM balances GROUP BY id)
    SELECT c_custkey AS id, round(c_acctbal, 6) AS balance, (c_nationkey = 0)::INT AS nation_missing,
           d.* EXCLUDE id, k.* EXCLUDE id, i.* EXCLUDE id, p.* EXCLUDE id, b.* EXCLUDE id
    FROM customer LEFT JOIN d ON d.id = c_custkey LEFT JOIN k ON k.id = c_custkey LEFT JOIN i ON i.id = c_custkey
    LEFT JOIN p ON p.id = c_custkey LEFT JOIN b ON b.id = c_custkey""",
)
def feature_table(spark, d):
    """One wide row per customer out of three child tables."""
    base = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_acctbal").alias("balance"),
        E.sentinel_flag("c_nationkey", 0).alias("nation_missing"),
    )
    amounts = {"amount": _STATS}
    dec = rollup.rollup(
        decisions(spark, d),
        "id",
        "DEC",
        slices=[
            Slice(num=amounts, count=True),
            *[Slice(n, f"t >= -{days}", num=amounts) for days, n in _DAYS],
            *[Slice(f"LAST_{k}", last_k=k, order=("t", "loan"), num=amounts) for k in (1, 3, 5)],
        ],
        decays=[Decay(["amount"], "t", 0.001)],
        trends=[Trend(["amount"], "t")],
    )
    rows = instalments(spark, d)
    paid = {"paid": _STATS}
    ins = rollup.rollup(
        rows,
        "id",
        "INS",
        slices=[
            Slice(num={**paid, "dpd": ["mean", "max"]}),
            Slice("PAST_DUE", "dpd > 0", num=paid),
            Slice("NUM_1", "number = 1", num=paid),
        ],
    )
    loans = rollup.two_level(rows, "id", "loan", {"PL_DPD_MAX": ("dpd", "max"), "PL_N": ("loan", "size")})
    events = rollup.rollup(
        balances(spark, d), "id", "EV", categories={"status": ["error"]}, slices=[Slice(num={"value": _STATS})], cat_stats=["mean"]
    )
    return rounded(join_features(base, [dec, ins, loans, events], "id"))


def credit_tables(spark, d):
    """The given tables in the roles of the credit schema; every value comes from them."""
    c, o, li, ev = (table(spark, d, n) for n in ("customer", "orders", "lineitem", "events"))

    def h(key, seed):
        return E.hash_fraction(E.uniform_hash(key, seed))

    def days(key, seed, span):
        return (-1 - h(key, seed) * span).cast("int")

    key = "c_custkey"
    present = F.col("c_nationkey") > 2
    application = c.select(
        F.col(key).alias("SK_ID_CURR"),
        F.when(F.col("c_acctbal") > 0, (F.col("c_acctbal") > 5000).cast("int")).alias("TARGET"),
        F.when(present, h(key, 1)).alias("EXT_SOURCE_1"),
        h(key, 2).alias("EXT_SOURCE_2"),
        F.when(F.col("c_nationkey") < 20, h(key, 3) + F.col("c_acctbal") / 100000).alias("EXT_SOURCE_3"),
        (F.abs("c_acctbal") * 40).alias("AMT_CREDIT"),
        (F.abs("c_acctbal") * (1 + h(key, 4))).alias("AMT_ANNUITY"),
        (20000 + h(key, 5) * 100000).alias("AMT_INCOME_TOTAL"),
        (F.abs("c_acctbal") * 38).alias("AMT_GOODS_PRICE"),
        (h(key, 6) * 3).cast("int").alias("AMT_REQ_CREDIT_BUREAU_DAY"),
        (h(key, 7) * 5).cast("int").alias("AMT_REQ_CREDIT_BUREAU_YEAR"),
        (h(key, 8) * 4).cast("int").alias("CNT_CHILDREN"),
        (1 + h(key, 9) * 4).cast("int").cast("double").alias("CNT_FAM_MEMBERS"),
        days(key, 10, 20000).alias("DAYS_BIRTH"),
        F.when(F.col("c_nationkey") == 0, F.lit(365243)).otherwise(days(key, 11, 5000)).alias("DAYS_EMPLOYED"),
        days(key, 12, 4000).alias("DAYS_ID_PUBLISH"),
        days(key, 13, 9000).cast("double").alias("DAYS_REGISTRATION"),
        (days(key, 14, 3) + 1).cast("double").alias("DAYS_LAST_PHONE_CHANGE"),
        F.when(present, (h(key, 15) * 20).cast("int").cast("double")).alias("OWN_CAR_AGE"),
        (1 + F.col("c_nationkey") % 3).alias("REGION_RATING_CLIENT_W_CITY"),
        (h(key, 16) * 24).cast("int").alias("HOUR_APPR_PROCESS_START"),
        (h(key, 17) / 10).alias("REGION_POPULATION_RELATIVE"),
        *[(h(key, 20 + i) > 0.5).cast("int").alias(f"FLAG_DOCUMENT_{i}") for i in (2, 3)],
        *[(h(key, 30 + i) > 0.3).cast("int").alias(f) for i, f in enumerate(credit.CONTACT_FLAGS[:4])],
        *[(h(key, 40 + i) * 6).cast("int").cast("double").alias(f"OBS_{m}_CNT_SOCIAL_CIRCLE") for i, m in enumerate((30, 60))],
        *[(h(key, 50 + i) * 3).cast("int").cast("double").alias(f"DEF_{m}_CNT_SOCIAL_CIRCLE") for i, m in enumerate((30, 60))],
        *[(h(key, 60 + i) > 0.9).cast("int").alias(f) for i, f in enumerate(credit.REGION_FLAGS)],
        F.col("c_mktsegment").alias("NAME_INCOME_TYPE"),
        F.concat(F.lit("R"), (F.col("c_nationkey") % 5).cast("string")).alias("NAME_EDUCATION_TYPE"),
        F.when(present, F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))).alias("OCCUPATION_TYPE"),
    )
    newest = table(spark, d, "orders").select(F.max("o_orderdate")).scalar()
    age = F.datediff("o_orderdate", newest)
    price = F.col("o_totalprice")
    bureau = o.select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderkey").alias("SK_ID_BUREAU"),
        age.alias("DAYS_CREDIT"),
        F.when(F.col("o_orderstatus") == "F", "Active").when(F.col("o_orderstatus") == "O", "Closed").alias("CREDIT_ACTIVE"),
        F.col("o_orderpriority").alias("CREDIT_TYPE"),
        price.alias("AMT_CREDIT_SUM"),
        F.when(F.col("o_orderstatus") != "P", price * h("o_orderkey", 1)).alias("AMT_CREDIT_SUM_DEBT"),
        (price * F.greatest(h("o_orderkey", 2) - 0.9, F.lit(0.0))).alias("AMT_CREDIT_SUM_OVERDUE"),
        (price / 20).alias("AMT_ANNUITY"),
        (F.greatest(h("o_orderkey", 3) - 0.8, F.lit(0.0)) * 100).cast("int").alias("CREDIT_DAY_OVERDUE"),
        F.when(h("o_orderkey", 4) > 0.9, F.lit(365243)).otherwise(age + 400).cast("double").alias("DAYS_CREDIT_ENDDATE"),
        (age + 350).cast("double").alias("DAYS_ENDDATE_FACT"),
        (age + 10).cast("double").alias("DAYS_CREDIT_UPDATE"),
    )
    balance = li.select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"), (-F.col("l_linenumber")).alias("MONTHS_BALANCE"), F.col("l_returnflag").alias("STATUS")
    )
    previous = o.select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderkey").alias("SK_ID_PREV"),
        age.alias("DAYS_DECISION"),
        price.alias("AMT_APPLICATION"),
        (price * (0.8 + h("o_orderkey", 5) / 2)).alias("AMT_CREDIT"),
        (price / 15).alias("AMT_ANNUITY"),
        F.when(F.col("o_orderpriority") != "5-LOW", price).alias("AMT_GOODS_PRICE"),
        (price * 0.1).alias("AMT_DOWN_PAYMENT"),
        (6 + h("o_orderkey", 6) * 30).cast("int").cast("double").alias("CNT_PAYMENT"),
        (age + 30).cast("double").alias("DAYS_FIRST_DUE"),
        F.when(h("o_orderkey", 7) > 0.3, F.lit(365243.0)).otherwise(age + 25).alias("DAYS_FIRST_DRAWING"),
        (age + 300).cast("double").alias("DAYS_LAST_DUE"),
        (age + 330).cast("double").alias("DAYS_LAST_DUE_1ST_VERSION"),
        F.when(F.col("o_orderstatus") == "F", "Approved").when(F.col("o_orderstatus") == "O", "Refused").otherwise("Canceled").alias("NAME_CONTRACT_STATUS"),
        F.when(h("o_orderkey", 8) > 0.7, "Revolving loans").otherwise("Cash loans").alias("NAME_CONTRACT_TYPE"),
        F.col("o_orderpriority").alias("PRODUCT_COMBINATION"),
    )
    latest = table(spark, d, "events").select(F.max("ts")).scalar()
    month = F.datediff("ts", latest)
    pos = ev.select(
        F.col("user_id").alias("SK_ID_CURR"),
        (F.col("user_id") * 100 + (h("event_id", 1) * 5).cast("int")).alias("SK_ID_PREV"),
        month.alias("MONTHS_BALANCE"),
        F.when(F.col("event_type") == "error", F.col("value")).otherwise(0.0).cast("int").alias("SK_DPD"),
        (F.col("value") / 10).cast("int").alias("SK_DPD_DEF"),
        (h("event_id", 2) * 24).cast("int").cast("double").alias("CNT_INSTALMENT"),
        F.when(F.col("event_type") != "view", (h("event_id", 3) * 12).cast("int").cast("double")).alias("CNT_INSTALMENT_FUTURE"),
        F.when(F.col("event_type") == "purchase", "Completed").otherwise("Active").alias("NAME_CONTRACT_STATUS"),
    )
    card = ev.select(
        F.col("user_id").alias("SK_ID_CURR"),
        (F.col("user_id") * 100 + (h("event_id", 4) * 3).cast("int")).alias("SK_ID_PREV"),
        month.alias("MONTHS_BALANCE"),
        F.col("value").alias("AMT_BALANCE"),
        (h("event_id", 5) * 200).cast("int").alias("AMT_CREDIT_LIMIT_ACTUAL"),
        (F.col("value") * 0.3).alias("AMT_PAYMENT_TOTAL_CURRENT"),
        (F.col("value") * 0.25).alias("AMT_PAYMENT_CURRENT"),
        (F.col("value") * 1.1).alias("AMT_TOTAL_RECEIVABLE"),
        F.when(F.col("event_type") != "view", F.col("value") * 0.5).alias("AMT_DRAWINGS_CURRENT"),
        (F.col("value") * 0.05).alias("AMT_INST_MIN_REGULARITY"),
        F.when(F.col("event_type") == "error", F.lit(3)).otherwise(0).alias("SK_DPD"),
    )
    rows = instalments(spark, d)
    installments = rows.select(
        F.col("id").alias("SK_ID_CURR"),
        F.col("loan").alias("SK_ID_PREV"),
        F.col("t").cast("double").alias("DAYS_INSTALMENT"),
        (F.col("t") + F.col("dpd") - F.col("dbd")).cast("double").alias("DAYS_ENTRY_PAYMENT"),
        (F.col("due") * 100).alias("AMT_INSTALMENT"),
        (F.col("paid") * 100).alias("AMT_PAYMENT"),
        F.coalesce("number", F.lit(7)).alias("NUM_INSTALMENT_NUMBER"),
        (F.col("version") % 4).cast("double").alias("NUM_INSTALMENT_VERSION"),
    )
    return {
        "application": application,
        "bureau": bureau,
        "bureau_balance": balance,
        "previous": previous,
        "pos": pos,
        "card": card,
        "installments": installments,
    }


def _features(name: str, generation: str):
    def build(spark, d):
        tables = credit_tables(spark, d)
        if name == "application":
            return credit.applicant_features(tables[name], generation)
        child = tables[name]
        if name == "bureau":
            child = credit.with_balance(child, tables["bureau_balance"], generation)
        return credit.child_features(child, name, generation)

    return build


for _generation in ("4", "6"):
    for _name in ("application", "bureau", "previous", "pos", "card", "installments"):
        query(f"credit_{_name}_gen{_generation}")(_features(_name, _generation))
