"""Scalar expressions, schema operators and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.functions import expr as E
from rowloom.operators import assemble, encode, folds, schema
from rowloom.plans.catalog.registry import (
    APPLICANTS,
    DECISIONS,
    INSTALMENTS,
    applicants,
    decisions,
    instalments,
    query,
    r6,
    table,
)


@query("sentinel_to_null", "SELECT c_custkey, nullif(c_nationkey, 0) AS nation FROM customer")
def sentinel_to_null(spark, d):
    return table(spark, d, "customer").select("c_custkey", E.null_if("c_nationkey", 0).alias("nation"))


@query("sentinel_flag", "SELECT c_custkey, (c_nationkey = 0)::INT AS anomalous FROM customer")
def sentinel_flag(spark, d):
    return table(spark, d, "customer").select("c_custkey", E.sentinel_flag("c_nationkey", 0).alias("anomalous"))


@query(
    "ratio_plain",
    "SELECT o_orderkey, round(o_totalprice / nullif(extract(day FROM o_orderdate) - 1, 0), 6) AS r FROM orders",
)
def ratio_plain(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", r6(E.ratio("o_totalprice", F.dayofmonth("o_orderdate") - 1)).alias("r")
    )


@query(
    "safe_divide",
    """SELECT l_orderkey, l_linenumber, l_quantity,
              round(l_tax / nullif(l_discount, 0), 6) AS tax_share FROM lineitem""",
)
def safe_divide(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", r6(E.ratio("l_tax", "l_discount")).alias("tax_share")
    )


@query(
    "ratio_offset",
    f"""WITH {DECISIONS}
    SELECT loan, round(amount / nullif(t + 1, 0), 6) AS plus_one, round(amount / nullif(t - 1, 0), 6) AS minus_one,
           round(amount / nullif(t + 0.001::DOUBLE, 0), 6) AS small FROM decisions""",
)
def ratio_offset(spark, d):
    return decisions(spark, d).select(
        "loan",
        r6(E.ratio("amount", "t", 1)).alias("plus_one"),
        r6(E.ratio("amount", "t", -1)).alias("minus_one"),
        r6(E.ratio("amount", "t", 0.001)).alias("small"),
    )


@query(
    "difference",
    f"WITH {INSTALMENTS} SELECT loan, number, quantity, round(paid - due, 6) AS diff FROM instalments",
)
def difference(spark, d):
    return instalments(spark, d).select("loan", "number", "quantity", r6(E.difference("paid", "due")).alias("diff"))


@query(
    "interaction_poly",
    f"""WITH {APPLICANTS}
    SELECT id, round(e_share * chars, 6) AS prod, round(pow(e_share, 2), 6) AS sq, round(pow(e_share, 3), 6) AS cube,
           round(2.0::DOUBLE * e_share + 0.5::DOUBLE * lines, 6) AS weighted FROM applicants""",
)
def interaction_poly(spark, d):
    return applicants(spark, d).select(
        "id",
        r6(E.product("e_share", "chars")).alias("prod"),
        r6(F.pow("e_share", F.lit(2))).alias("sq"),
        r6(F.pow("e_share", F.lit(3))).alias("cube"),
        r6(E.weighted_sum({"e_share": 2, "lines": 0.5})).alias("weighted"),
    )


@query(
    "row_stats",
    f"""WITH {APPLICANTS}, long AS (
      SELECT id, unnest([chars, spaces, lines]) AS v FROM applicants)
    SELECT id, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS lo, max(v) AS hi,
           max(v) - min(v) AS span FROM long GROUP BY id""",
)
def row_stats(spark, d):
    cols = ["chars", "spaces", "lines"]
    return applicants(spark, d).select(
        "id",
        r6(E.row_mean(cols)).alias("mean"),
        r6(E.row_std(cols)).alias("std"),
        E.row_min(cols).alias("lo"),
        E.row_max(cols).alias("hi"),
        E.row_range(cols).alias("span"),
    )


@query(
    "row_null_count",
    f"""WITH {APPLICANTS}
    SELECT id, (lines IS NULL)::INT + (lang IS NULL)::INT AS chosen,
           (lang IS NULL)::INT + (source IS NULL)::INT + (chars IS NULL)::INT + (spaces IS NULL)::INT
           + (lines IS NULL)::INT + (e_share IS NULL)::INT + (target IS NULL)::INT + (toxic IS NULL)::INT AS whole
    FROM applicants""",
)
def row_null_count(spark, d):
    a = applicants(spark, d)
    return a.select(
        "id", E.null_count(["lines", "lang"]).alias("chosen"), E.null_count([c for c in a.columns]).alias("whole")
    )


@query(
    "row_sum_pattern",
    """SELECT l_orderkey, l_linenumber, l_extendedprice,
              round(l_quantity + l_discount + coalesce(try_cast(l_returnflag AS DOUBLE), 0), 6) AS total, 0.0 AS nothing
       FROM lineitem""",
)
def row_sum_pattern(spark, d):
    li = table(spark, d, "lineitem")
    chosen = [c for c in li.columns if c in ("l_quantity", "l_discount", "l_returnflag", "l_absent")]
    return li.select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        r6(E.row_sum(chosen)).alias("total"),
        E.row_sum([c for c in li.columns if c.startswith("FLAG_")]).alias("nothing"),
    )


@query(
    "bin_right_closed",
    """SELECT p_partkey, CASE WHEN p_size <= 0 THEN NULL WHEN p_size <= 10 THEN 0 WHEN p_size <= 25 THEN 1
              WHEN p_size <= 30 THEN 2 WHEN p_size <= 45 THEN 3 END AS bin FROM part""",
)
def bin_right_closed(spark, d):
    return table(spark, d, "part").select("p_partkey", E.bin_right("p_size", [0, 10, 25, 30, 45]).alias("bin"))


@query(
    "log_abs",
    f"WITH {DECISIONS} SELECT loan, round(ln(1 + abs(t)), 6) AS la, round(exp(0.001::DOUBLE * t), 6) AS w FROM decisions",
)
def log_abs(spark, d):
    return decisions(spark, d).select(
        "loan", r6(E.log_abs("t")).alias("la"), r6(F.exp(F.lit(0.001) * F.col("t"))).alias("w")
    )


@query(
    "age_years",
    f"""WITH {DECISIONS} SELECT loan, round(t / -365.25::DOUBLE, 6) AS years,
        trunc(-t / 365.0::DOUBLE)::INT AS whole FROM decisions""",
)
def age_years(spark, d):
    return decisions(spark, d).select("loan", r6(E.years("t")).alias("years"), E.whole_years("t").alias("whole"))


@query(
    "days_past_due",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
              greatest(date_diff('day', o_orderdate, l_shipdate), 0) AS dpd,
              greatest(date_diff('day', l_shipdate, o_orderdate), 0) AS dbd
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def days_past_due(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    rows = assemble.label_children(table(spark, d, "lineitem"), orders, "l_orderkey")
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        E.clip_low(F.datediff("l_shipdate", "o_orderdate")).alias("dpd"),
        E.clip_low(F.datediff("o_orderdate", "l_shipdate")).alias("dbd"),
    )


@query(
    "predicate_flags",
    f"""WITH {APPLICANTS} SELECT id, coalesce((lines > 3)::INT, 0) AS many_lines,
        coalesce((lang = 'en')::INT, 0) AS english, coalesce((e_share - 0.1::DOUBLE > 0)::INT, 0) AS e_rich FROM applicants""",
)
def predicate_flags(spark, d):
    return applicants(spark, d).select(
        "id",
        E.flag(F.col("lines") > 3).alias("many_lines"),
        E.flag(F.col("lang") == "en").alias("english"),
        E.flag(F.col("e_share") - F.lit(0.1) > 0).alias("e_rich"),
    )


@query(
    "inf_to_null",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
              round(CASE WHEN l_discount > 0.02::DOUBLE THEN l_tax END, 6) AS tax FROM lineitem""",
)
def inf_to_null(spark, d):
    poisoned = (
        F.when(F.col("l_discount") > 0.02, F.col("l_tax"))
        .when(F.col("l_discount") > 0.01, F.lit(float("inf")))
        .when(F.col("l_discount") > 0.0, F.lit(float("-inf")))
        .otherwise(F.lit(float("nan")))
    )
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", r6(E.blank_inf(poisoned)).alias("tax")
    )


@query(
    "category_cross",
    f"WITH {APPLICANTS} SELECT id, coalesce(lang, 'nan') || '__' || coalesce(source, 'nan') AS crossed FROM applicants",
)
def category_cross(spark, d):
    return applicants(spark, d).select("id", E.cross(["lang", "source"]).alias("crossed"))


@query(
    "interest_estimate",
    f"""WITH {INSTALMENTS} SELECT loan, number, quantity, version,
        round(paid * number / nullif(due, 0) - 1, 6) AS rate,
        round((number * paid - due) / nullif(due + 1, 0), 6) AS share FROM instalments""",
)
def interest_estimate(spark, d):
    return instalments(spark, d).select(
        "loan",
        "number",
        "quantity",
        "version",
        r6(E.interest_estimate("paid", "number", "due")).alias("rate"),
        r6(E.ratio(F.col("number") * F.col("paid") - F.col("due"), "due", 1)).alias("share"),
    )


@query(
    "impute",
    f"""WITH {APPLICANTS} SELECT id, coalesce(lines, (SELECT median(lines) FROM applicants)) AS lines,
        coalesce(e_share, (SELECT median(e_share) FROM applicants)) AS e_share,
        coalesce(target, -999) AS target, coalesce(lang, '__nan__') AS lang FROM applicants""",
)
def impute(spark, d):
    a = applicants(spark, d)
    return encode.fit_transform(
        a,
        encode.Impute(["lines", "e_share"]),
        encode.Impute(["target"], -999),
        encode.Impute(["lang"], "__nan__"),
    ).select("id", "lines", "e_share", "target", "lang")


@query(
    "standardize",
    f"""WITH {APPLICANTS}, m AS (SELECT avg(chars) AS mc, stddev_pop(chars) AS sc, avg(lines) AS ml, stddev_pop(lines) AS sl,
        median(chars) AS med FROM applicants)
    SELECT id, round((chars - mc) / sc, 6) AS chars, round((lines - ml) / sl, 6) AS lines, med FROM applicants, m""",
)
def standardize(spark, d):
    from rowloom.operators.ordered import medians

    a = applicants(spark, d)
    z = encode.Standardize(["chars", "lines"]).fit(a).transform(a)
    middle = medians(a, ["chars"])
    return z.select("id", r6("chars").alias("chars"), r6("lines").alias("lines"), middle.scalar().alias("med"))


@query(
    "split_labelled",
    f"""WITH {APPLICANTS} SELECT id, 'train' AS part FROM applicants WHERE target IS NOT NULL
        UNION ALL SELECT id, 'test' FROM applicants WHERE target IS NULL""",
)
def split_labelled(spark, d):
    a = applicants(spark, d)
    train, test = assemble.labelled(a, "target"), assemble.unlabelled(a, "target")
    return train.select("id", F.lit("train").alias("part")).union(test.select("id", F.lit("test").alias("part")))


@query(
    "sample_n",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY md5(concat(o_orderkey, '-42')), o_orderkey LIMIT 3000",
)
def sample_n(spark, d):
    return folds.sample_n(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", 3000)


@query(
    "clean_names",
    """SELECT c_custkey AS C_CUSTKEY, c_acctbal AS ACCT_BAL, c_mktsegment AS ACCT_BAL_2, c_nationkey AS NATION_KEY_X
       FROM customer""",
)
def clean_names(spark, d):
    odd = table(spark, d, "customer").select(
        "c_custkey",
        F.col("c_acctbal").alias("acct bal"),
        F.col("c_mktsegment").alias("__acct--bal%"),
        F.col("c_nationkey").alias("nation (key): x"),
    )
    return schema.clean_names(odd)


@query(
    "narrow_types",
    """SELECT o_custkey, l_linenumber::TINYINT AS l_linenumber, l_quantity, (l_discount > 0.05::DOUBLE)::TINYINT AS big,
              date_diff('day', o_orderdate, l_shipdate)::SMALLINT AS gap
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def narrow_types(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    rows = assemble.label_children(table(spark, d, "lineitem"), orders, "l_orderkey").select(
        "o_custkey",
        F.col("l_linenumber").cast("long").alias("l_linenumber"),
        "l_quantity",
        (F.col("l_discount") > 0.05).alias("big"),
        F.datediff("l_shipdate", "o_orderdate").alias("gap"),
    )
    return schema.narrow(rows, keep=["o_custkey"])


@query(
    "coerce_numeric",
    """SELECT o_orderkey, try_cast(substr(o_orderpriority, 1, 1) AS DOUBLE) AS rank,
              try_cast(o_orderpriority AS DOUBLE) AS bad FROM orders""",
)
def coerce_numeric(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("rank"), F.col("o_orderpriority").alias("bad")
    )
    return schema.coerce_numeric(o, ["rank", "bad"])


_BINARY = ["l_linenumber", "l_quantity", "returned", "taxed", "absent"]


@query(
    "detect_binary",
    """SELECT unnest(['l_linenumber', 'l_quantity', 'returned', 'taxed', 'absent']) AS name,
              unnest([count(*) FILTER (WHERE l_linenumber NOT IN (0, 1)) = 0,
                      count(*) FILTER (WHERE l_quantity NOT IN (0, 1)) = 0, true, true, true])::INT AS is_binary
       FROM lineitem""",
)
def detect_binary(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_linenumber",
        "l_quantity",
        E.flag(F.col("l_returnflag") == "R").alias("returned"),
        F.when(F.col("l_tax") > 0, F.lit(1)).alias("taxed"),
        F.nullif("l_suppkey", F.col("l_suppkey")).alias("absent"),
    )
    found = schema.binary_columns(li)
    seen = li.select(F.count(F.lit(1)).alias("n"))
    cells = [F.struct(F.lit(c).alias("name"), F.lit(int(c in found)).alias("is_binary")) for c in _BINARY]
    return seen.select(F.inline(F.array(*cells)))


@query(
    "align_columns",
    f"""WITH {APPLICANTS} SELECT id, lang, source, chars, 'train' AS part FROM applicants WHERE target IS NOT NULL
        UNION ALL SELECT id, lang, source, chars, 'test' FROM applicants WHERE target IS NULL""",
)
def align_columns(spark, d):
    a = applicants(spark, d)
    left = assemble.labelled(a, "target").select("id", "lang", "target", "source", "chars")
    right = assemble.unlabelled(a, "target").select("chars", "id", "source", "lines", "lang")
    left, right = schema.align(left, right)
    return left.withColumn("part", F.lit("train")).union(right.withColumn("part", F.lit("test")))


@query(
    "drop_constant",
    "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN 1 END AS one_or_null FROM orders",
)
def drop_constant(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.lit(7).alias("same"),
        F.lit(None).cast("double").alias("nothing"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1)).alias("one_or_null"),
        (F.col("o_orderkey") - F.col("o_orderkey")).alias("zero"),
    )
    return schema.drop_constant(o)
