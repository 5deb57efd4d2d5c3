"""Checked sums of the credit presets of generations 1 to 5: per feature the number of values, their sum and a sum
weighted by the entity, which the SQL computes from the slices as stated here, in long form.

A feature that is present but has no value anywhere does not count. Numbers are compared to six digits, after scaling by an odd figure, so that none sits on a rounding edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.plans import credit
from rowloom.plans.catalog.presets import credit_tables
from rowloom.plans.catalog.registry import INSTALMENTS, query


def feature_sums(wide: DataFrame, key: str = "SK_ID_CURR") -> DataFrame:
    """(feature, n, total, weighted) of every numeric column."""
    cells = [F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("x")) for c in wide.columns if c != key]
    long = wide.select((F.col(key) % 97 + 1).cast("double").alias("w"), F.inline(F.array(*cells))).where("x IS NOT NULL")
    shown = lambda v: F.format_string("%.5e", v * 1.037163491 + 0.0)
    return long.groupBy("feature").agg(F.count("x").alias("n"), shown(F.sum("x")).alias("total"), shown(F.sum(F.col("x") * F.col("w"))).alias("weighted"))


def _h(key: str, seed: int) -> str:
    return f"(cast('0x' || substr(md5(concat({key}, '-{seed}')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)"


_AGE = "date_diff('day', (SELECT max(o_orderdate) FROM orders), o_orderdate)"
_MONTH = "date_diff('day', (SELECT max(ts) FROM events)::DATE, ts::DATE)"
_O, _E = "o_orderkey", "event_id"

# The child tables in their credit roles: (column, SQL) in order.
_CHILDREN: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "bureau": (
        "orders",
        [
            ("SK_ID_CURR", "o_custkey"), ("SK_ID_BUREAU", _O), ("DAYS_CREDIT", _AGE),
            ("CREDIT_ACTIVE", "CASE o_orderstatus WHEN 'F' THEN 'Active' WHEN 'O' THEN 'Closed' END"), ("CREDIT_TYPE", "o_orderpriority"),
            ("AMT_CREDIT_SUM", "o_totalprice"), ("AMT_CREDIT_SUM_DEBT", f"CASE WHEN o_orderstatus <> 'P' THEN o_totalprice * {_h(_O, 1)} END"),
            ("AMT_CREDIT_SUM_OVERDUE", f"o_totalprice * greatest({_h(_O, 2)} - 0.9::DOUBLE, 0)"), ("AMT_ANNUITY", "o_totalprice / 20"),
            ("CREDIT_DAY_OVERDUE", f"trunc(greatest({_h(_O, 3)} - 0.8::DOUBLE, 0) * 100)"),
            ("DAYS_CREDIT_ENDDATE", f"CASE WHEN {_h(_O, 4)} > 0.9 THEN 365243 ELSE {_AGE} + 400 END"), ("DAYS_ENDDATE_FACT", f"{_AGE} + 350"),
            ("DAYS_CREDIT_UPDATE", f"{_AGE} + 10"),
        ],
    ),
    "previous": (
        "orders",
        [
            ("SK_ID_CURR", "o_custkey"), ("SK_ID_PREV", _O), ("DAYS_DECISION", _AGE), ("AMT_APPLICATION", "o_totalprice"),
            ("AMT_CREDIT", f"o_totalprice * (0.8::DOUBLE + {_h(_O, 5)} / 2)"), ("AMT_ANNUITY", "o_totalprice / 15"),
            ("AMT_GOODS_PRICE", "CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END"), ("AMT_DOWN_PAYMENT", "o_totalprice * 0.1::DOUBLE"),
            ("CNT_PAYMENT", f"trunc(6 + {_h(_O, 6)} * 30)"), ("DAYS_FIRST_DUE", f"{_AGE} + 30"),
            ("DAYS_FIRST_DRAWING", f"CASE WHEN {_h(_O, 7)} > 0.3 THEN 365243 ELSE {_AGE} + 25 END"), ("DAYS_LAST_DUE", f"{_AGE} + 300"),
            ("DAYS_LAST_DUE_1ST_VERSION", f"{_AGE} + 330"),
            ("NAME_CONTRACT_STATUS", "CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused' ELSE 'Canceled' END"),
            ("NAME_CONTRACT_TYPE", f"CASE WHEN {_h(_O, 8)} > 0.7 THEN 'Revolving loans' ELSE 'Cash loans' END"), ("PRODUCT_COMBINATION", "o_orderpriority"),
        ],
    ),
    "pos": (
        "events",
        [
            ("SK_ID_CURR", "user_id"), ("SK_ID_PREV", f"user_id * 100 + trunc({_h(_E, 1)} * 5)"), ("MONTHS_BALANCE", _MONTH),
            ("SK_DPD", "CASE WHEN event_type = 'error' THEN trunc(value) ELSE 0 END"), ("SK_DPD_DEF", "trunc(value / 10)"),
            ("CNT_INSTALMENT", f"trunc({_h(_E, 2)} * 24)"), ("CNT_INSTALMENT_FUTURE", f"CASE WHEN event_type <> 'view' THEN trunc({_h(_E, 3)} * 12) END"),
            ("NAME_CONTRACT_STATUS", "CASE WHEN event_type = 'purchase' THEN 'Completed' ELSE 'Active' END"),
        ],
    ),
    "card": (
        "events",
        [
            ("SK_ID_CURR", "user_id"), ("SK_ID_PREV", f"user_id * 100 + trunc({_h(_E, 4)} * 3)"), ("MONTHS_BALANCE", _MONTH), ("AMT_BALANCE", "value"),
            ("AMT_CREDIT_LIMIT_ACTUAL", f"trunc({_h(_E, 5)} * 200)"), ("AMT_PAYMENT_TOTAL_CURRENT", "value * 0.3::DOUBLE"),
            ("AMT_PAYMENT_CURRENT", "value * 0.25::DOUBLE"), ("AMT_TOTAL_RECEIVABLE", "value * 1.1::DOUBLE"),
            ("AMT_DRAWINGS_CURRENT", "CASE WHEN event_type <> 'view' THEN value * 0.5::DOUBLE END"), ("AMT_INST_MIN_REGULARITY", "value * 0.05::DOUBLE"),
            ("SK_DPD", "CASE WHEN event_type = 'error' THEN 3 ELSE 0 END"),
        ],
    ),
    "installments": (
        "instalments",
        [
            ("SK_ID_CURR", "id"), ("SK_ID_PREV", "loan"), ("DAYS_INSTALMENT", "t"), ("DAYS_ENTRY_PAYMENT", "t + dpd - dbd"), ("AMT_INSTALMENT", "due * 100"),
            ("AMT_PAYMENT", "paid * 100"), ("NUM_INSTALMENT_NUMBER", "coalesce(number, 7)"), ("NUM_INSTALMENT_VERSION", "version % 4"),
        ],
    ),
}
_TEXT = {"CREDIT_ACTIVE", "CREDIT_TYPE", "NAME_CONTRACT_STATUS", "NAME_CONTRACT_TYPE", "PRODUCT_COMBINATION"}
_IDS = {"SK_ID_CURR", "SK_ID_PREV", "SK_ID_BUREAU"}
_STATUSES = ["A", "N", "R"]  # return flags, in the role of monthly statuses


def _derived(table: str, generation: str) -> tuple[dict[str, str], list[tuple[str, str]]]:
    """Columns that a generation blanks, and those that it adds."""
    late = "DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT"
    rich = generation in ("1v2", "4", "5")
    if table == "bureau":
        blank = {} if generation == "2" else {"DAYS_CREDIT_ENDDATE": "nullif(DAYS_CREDIT_ENDDATE, 365243)"}
        new = [] if generation == "2" else [("AMT_CREDIT_SUM_DEBT_OVER_SUM", "AMT_CREDIT_SUM_DEBT / nullif(AMT_CREDIT_SUM, 0)")]
        if generation in ("2", "3", "4", "5"):
            new.append(("BURO_CREDIT_ACTIVE_BINARY", "coalesce(CREDIT_ACTIVE = 'Active', false)::INT"))
        return blank, new
    if table == "previous":
        days = ["DAYS_DECISION", "DAYS_FIRST_DUE", "DAYS_FIRST_DRAWING", "DAYS_LAST_DUE", "DAYS_LAST_DUE_1ST_VERSION"]
        new = [] if generation == "2" else [("PREV_APP_CREDIT_PERC", "AMT_APPLICATION / nullif(AMT_CREDIT, 0)")]
        if generation in ("2", "3", "4", "5"):
            below = "AMT_CREDIT + 1" if generation == "2" else "AMT_CREDIT"
            new.append(("PREV_INTEREST_EST", f"AMT_ANNUITY * CNT_PAYMENT / nullif({below}, 0) - 1"))
        if rich:
            new.append(("PREV_CREDIT_GOODS_RATIO", "AMT_CREDIT / nullif(AMT_GOODS_PRICE, 0)"))
        return {c: f"nullif({c}, 365243)" for c in days}, new
    if table == "installments":
        new = [("PAYMENT_PERC", f"AMT_PAYMENT / nullif(AMT_INSTALMENT{' + 1' if generation == '2' else ''}, 0)"), ("DPD", f"greatest({late}, 0)")]
        if rich:
            new += [("PAYMENT_DIFF", "AMT_PAYMENT - AMT_INSTALMENT"), ("IS_PAST_DUE", f"coalesce({late} > 0, false)::INT")]
        return {}, new
    return {}, []


def _slices(table: str, generation: str) -> list[tuple[str, str]]:
    """(name, condition) of every slice; n counts the newest rows, o the oldest."""
    time = {"bureau": "DAYS_CREDIT", "previous": "DAYS_DECISION", "installments": "DAYS_INSTALMENT"}.get(table, "MONTHS_BALANCE")
    year = -12 if table in ("pos", "card") else -365
    out = [("", "true")]
    if generation == "1":
        out.append(("RECENT", f"{time} >= {-730 if table == 'previous' else year}"))
    elif generation == "2":
        out.append(("RECENT", f"{time} >= {year}"))
    elif generation == "1v2":
        if table == "installments":
            out += [(f"LAST_{d}D", f"{time} >= {-d}") for d in (60, 90, 180, 365)]
        elif table == "previous":
            out.append(("RECENT_24M", f"{time} >= -730"))
        else:
            out.append(("RECENT_12M", f"{time} >= {year}"))
        newest = {"previous": (3, 5), "pos": (3, 5, 10), "installments": (2, 3, 5), "card": (3, 5, 10)}.get(table, ())
        out += [(f"LAST_{k}", f"n <= {k}") for k in newest]
    else:
        out.append(("RECENT_12M", f"{time} >= {year}"))
        if table in ("bureau", "previous"):
            out.append(("RECENT_24M", f"{time} >= -730"))
        if generation in ("4", "5"):
            out += [(f"LAST_{k}", f"n <= {k}") for k in ((3, 5) if table == "previous" else (1, 3, 5, 10))]
    if table == "previous" and generation in ("1v2", "4", "5"):
        out += [(f"FIRST_{k}", f"o <= {k}") for k in (2, 4)]
    if table == "installments" and generation in ("1v2", "4", "5"):
        out += [("PAST_DUE", "IS_PAST_DUE = 1")] + [(f"NUM_{i}", f"NUM_INSTALMENT_NUMBER = {i}") for i in (1, 2, 3, 4)]
    return out


def sums_sql(table: str, generation: str) -> str:
    source, columns = _CHILDREN[table]
    prefix = {"bureau": "BURO", "previous": "PREV", "pos": "POS", "card": "CC", "installments": "INSTAL"}[table]
    blank, new = _derived(table, generation)
    names = [c for c, _ in columns]
    balance = ""
    if table == "bureau":
        shares = ", ".join(f"avg((l_returnflag = '{v}')::INT) AS BB_STATUS_{v}_MEAN" for v in _STATUSES)
        balance = f""",
b AS (SELECT l_orderkey AS SK_ID_BUREAU, min(-l_linenumber) AS BB_MONTHS_BALANCE_MIN, max(-l_linenumber) AS BB_MONTHS_BALANCE_MAX,
             {shares}, avg((l_returnflag IS NULL)::INT) AS BB_STATUS_NAN_MEAN, count(*) AS BB_MONTHS_BALANCE_SIZE FROM lineitem GROUP BY 1)"""
        more = ["BB_MONTHS_BALANCE_MIN", "BB_MONTHS_BALANCE_MAX", *[f"BB_STATUS_{v}_MEAN" for v in _STATUSES], "BB_STATUS_NAN_MEAN", "BB_MONTHS_BALANCE_SIZE"]
    else:
        more = []
    base = ", ".join(f"{sql} AS {c}" for c, sql in columns)
    blanked = ", ".join(f"{blank.get(c, c)} AS {c}" for c in names) + "".join(f", {c}" for c in more)
    added = "".join(f", {sql} AS {c}" for c, sql in new)
    own = [*names, *more, *[c for c, _ in new]]
    order = ["DAYS_CREDIT" if table == "bureau" else "DAYS_DECISION" if table == "previous" else "DAYS_INSTALMENT" if table == "installments" else "MONTHS_BALANCE"]
    # A table with a joined key has that key first.
    listed = own if table != "bureau" else ["SK_ID_BUREAU", *[c for c in own if c != "SK_ID_BUREAU"]]
    order += [c for c in listed if c not in (*order, "SK_ID_CURR")]
    numbers = [c for c in own if c not in _IDS and c not in _TEXT]
    texts = [c for c in own if c in _TEXT]
    clean = lambda x: f"upper(trim(regexp_replace({x}, '[^0-9A-Za-z]+', '_', 'g'), '_'))"
    parts = []
    stats = {"MEAN": "avg(v)", "MAX": "max(v)", "MIN": "min(v)", "SUM": "coalesce(sum(v), 0)", "VAR": "var_samp(v)"}
    share_stats = ("MEAN", "SUM") if generation in ("1v2", "4", "5") else ("MEAN",)
    cells = ", ".join(f"{{'c': '{c}', 'v': {c}::DOUBLE}}" for c in numbers)
    for name, condition in _slices(table, generation):
        head = f"{prefix}_{name}_" if name else f"{prefix}_"
        parts.append(f"""SELECT id, {clean(f"'{head}' || c || '_' || s")} AS feature, x FROM (
  SELECT SK_ID_CURR AS id, c, unnest([{', '.join(f"{{'s': '{s}', 'x': {sql}::DOUBLE}}" for s, sql in stats.items())}], recursive := true)
  FROM (SELECT SK_ID_CURR, unnest([{cells}], recursive := true) FROM k WHERE {condition}) GROUP BY SK_ID_CURR, c)
WHERE (c IN (SELECT c FROM two)) = false OR s IN ({', '.join(f"'{s}'" for s in share_stats)})""")
        for c in texts:
            parts.append(f"""SELECT id, {clean(f"'{head}{c}_' || label || '_' || s")} AS feature, x FROM (
  SELECT SK_ID_CURR AS id, coalesce(u.v, 'nan') AS label, unnest([{', '.join(f"{{'s': '{s}', 'x': {('avg' if s == 'MEAN' else 'sum')}(({c} IS NOT DISTINCT FROM u.v)::INT)::DOUBLE}}" for s in share_stats)}], recursive := true)
  FROM k, (SELECT DISTINCT {c} AS v FROM k WHERE {c} IS NOT NULL UNION ALL SELECT NULL) u WHERE {condition} GROUP BY SK_ID_CURR, u.v)""")
    if table == "bureau":
        plus = " + 1" if generation == "2" else ""
        pairs = {
            "2": [("RECENT", "TREND_DEBT_RATIO")],
            "3": [("RECENT_12M", "TREND_DEBT_RATIO_12M"), ("RECENT_24M", "TREND_DEBT_RATIO_24M")],
        }
        pairs["4"] = pairs["5"] = [*pairs["3"], ("LAST_1", "LAST1_DEBT_RATIO"), ("LAST_3", "LAST3_DEBT_RATIO")]
        conditions = dict(_slices(table, generation))
        for name, label in pairs.get(generation, []):
            parts.append(f"""SELECT SK_ID_CURR AS id, 'BURO_{label}' AS feature,
  avg(AMT_CREDIT_SUM_DEBT) FILTER (WHERE {conditions[name]}) / nullif(avg(AMT_CREDIT_SUM_DEBT){plus}, 0) AS x FROM k GROUP BY 1""")
        if generation == "1v2":
            parts.append("SELECT SK_ID_CURR AS id, 'LAST_ACTIVE_DAYS_CREDIT' AS feature, max(DAYS_CREDIT)::DOUBLE AS x FROM k WHERE CREDIT_ACTIVE = 'Active' GROUP BY 1")
    if table == "previous" and generation == "1v2":
        parts.append(f"""SELECT id, {clean("'PREV_LAST_PRODUCT_COMBINATION_' || v")} AS feature, (v = p)::INT::DOUBLE AS x
  FROM (SELECT SK_ID_CURR AS id, PRODUCT_COMBINATION AS p FROM k QUALIFY row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY n) = 1),
       (SELECT DISTINCT PRODUCT_COMBINATION AS v FROM k)
  UNION ALL SELECT SK_ID_CURR, 'PREV_LAST_PRODUCT_COMBINATION_NAN', 0 FROM k GROUP BY 1""")
    body = "\nUNION ALL\n".join(parts)
    return f"""WITH {INSTALMENTS}{balance},
c0 AS (SELECT {base} FROM {source}),
c1 AS (SELECT {blanked} FROM c0{' LEFT JOIN b USING (SK_ID_BUREAU)' if table == 'bureau' else ''}),
c2 AS (SELECT *{added} FROM c1),
k AS (SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY {', '.join(f'{c} DESC NULLS LAST' for c in order)}) AS n,
             row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY {', '.join(f'{c} ASC NULLS LAST' for c in order)}) AS o FROM c2 WHERE SK_ID_CURR IS NOT NULL),
two AS (SELECT c FROM (SELECT unnest([{cells}], recursive := true) FROM k) GROUP BY c HAVING count(*) FILTER (WHERE v NOT IN (0, 1)) = 0),
f AS ({body})
SELECT feature, count(x) AS n, printf('%.5e', sum(x) * 1.037163491::DOUBLE + 0.0) AS total, printf('%.5e', sum(x * (id % 97 + 1)) * 1.037163491::DOUBLE + 0.0) AS weighted
FROM f GROUP BY feature HAVING count(x) > 0"""


def _sums(table: str, generation: str):
    def build(spark, d):
        tables = credit_tables(spark, d)
        child = tables[table]
        if table == "bureau":
            child = credit.with_balance(child, tables["bureau_balance"], generation)
        return feature_sums(credit.child_features(child, table, generation))

    return build


for _generation in ("1", "1v2", "2", "3", "4"):  # the child tables of generation 5 are those of 4
    for _table in _CHILDREN:
        query(f"credit_{_table}_gen{_generation}_sums", sums_sql(_table, _generation))(_sums(_table, _generation))
