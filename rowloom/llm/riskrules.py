"""Quality rules whose cutoffs keep the false rejection of good documents below a stated risk.

Each rule bounds one ratio of a document from above. Labelled good documents are the holdout: per stratum
and rule they are counted into cells of a fixed ladder of cutoffs. A cutoff t is certified if the exact
binomial tail P(Bin(n, risk) <= rejected) is at most the error level, that is, if the hypothesis "more than
``risk`` of the good documents lie above t" is refused. Cutoffs are tried from the laxest to the strictest
and the first failure ends the trial (fixed sequence testing), so the ladder needs no correction; strata and
rules share the error level by Bonferroni, and rules share the risk evenly. With probability 1 - error, no
stratum then loses more than the stated share of its good documents to the rules. All certified cutoffs hold
at once, so the one that rejects the most labelled bad documents over good ones may be picked among them, the
laxer of equals; a rule that finds no bad documents rejects nothing.

Every statistic covers all labelled rows; counting is one grouped aggregation and only the counts of one
(stratum, rule) meet in a task. In a stratum whose own labels certify no cutoff of a rule, or that has no
labels at all, the rule rejects nothing: cutoffs of other strata bound nothing there. ``labels_needed`` gives
the fewest good labels that certify anything. Null strata and the stratum "" form one stratum. Copies of one text
are one label (``one_per_text``), since the bound is for independent ones. Ties of cutoffs go to the laxer one. Extra
columns stay, except ``failed``; without rows there are no cutoffs and no verdicts. Documents without words have ratio
zero. A label that is null is no label; several labels of one document count once, as good only if all of them
are good.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, exp, lgamma, log, log1p

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.arrowtext import free_name

#: Rules: name and SQL of a ratio between 0 and 1 that is large in bad documents.
RULES: dict[str, str] = {
    "symbols": "least(n_symbols / n_words, 1)",
    "lines": "n_dup_lines / n_lines",
    "windows": "n_repeat_words / n_words",
    "upper": "least(n_upper / word_chars, 1)",
    "marks": "least(n_marks / n_words, 1)",
    "short_words": "greatest(1 - word_chars / n_words / 10, 0)",
    "long_words": "least(word_chars / n_words / 100, 1)",
}

#: Cells of the ladder: cutoffs are the multiples of 1 / STEPS.
STEPS = 100


@dataclass(frozen=True)
class Risk:
    """``share`` of good documents that may be lost per stratum, ``error`` of the whole family of tests."""

    share: float = 0.05
    error: float = 0.05


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), summed from its largest term down until terms no longer count."""
    if k >= n or p <= 0:
        return 1.0
    if p >= 1:
        return 0.0
    if k > n * p:  # the other tail is the small one
        return 1.0 - binomial_tail(n - k - 1, n, 1 - p)
    term = exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(p) + (n - k) * log1p(-p))
    total, i = term, k
    while i > 0 and term > 1e-17 * total:
        term *= i * (1 - p) / ((n - i + 1) * p)
        total, i = total + term, i - 1
    return min(1.0, total)


def certified(good: dict[int, int], bad: dict[int, int], risk: float, error: float, steps: int = STEPS) -> tuple[int | None, int | None]:
    """The strictest certified rung and the best one: documents in a cell above it are rejected. None: no
    rung is certified, or none of them rejects more bad documents than good ones."""
    strictest, best, gain, lost, caught = None, None, 0, 0, 0
    n = sum(good.values())
    for rung in range(steps - 1, -1, -1):
        lost += good.get(rung + 1, 0)
        caught += bad.get(rung + 1, 0)
        if binomial_tail(lost, n, risk) > error:
            break
        strictest = rung
        if caught - lost > gain:
            best, gain = rung, caught - lost
    return strictest, best


def labels_needed(strata: int, risk: Risk = Risk(), rules: int = len(RULES)) -> int:
    """The fewest good labels of a stratum with which a rule that loses none of them is certified."""
    return ceil(log(risk.error / (rules * strata)) / log1p(-risk.share / rules))


def _ladder(stats: DataFrame, rules: dict[str, str], stratum: str) -> DataFrame:
    """One row per document and rule with the cell of its ratio (cell c: ratio in ((c-1)/STEPS, c/STEPS])."""
    cells = [F.struct(F.lit(name).alias("rule"), F.ceil(F.coalesce(F.expr(f"CASE WHEN n_words > 0 THEN {sql} END"), F.lit(0.0)) * STEPS - F.lit(1e-9)).cast("int").alias("cell")) for name, sql in rules.items()]
    return stats.select(F.coalesce(F.col(stratum), F.lit("")).alias("stratum"), "good", F.inline(F.array(*cells)))


def cutoffs(holdout: DataFrame, risk: Risk = Risk(), rules: dict[str, str] | None = None, stratum: str = "stratum") -> DataFrame:
    """(stratum, rule, n, strictest, rung) from text statistics with ``good`` (1 or 0); stratum "": null.

    ``n`` counts good documents. ``rung`` is the cutoff to use, null if there is none."""
    rules = rules or RULES
    sums = [F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")]
    ladder = _ladder(holdout, rules, stratum).groupBy("stratum", "rule", "cell").agg(*sums)
    families = ladder.agg(F.count_distinct("stratum").alias("strata"))
    share, error, count = risk.share, risk.error, len(rules)

    def grade(pdf: pd.DataFrame) -> pd.DataFrame:
        level = error / (count * int(pdf["strata"].iloc[0]))
        good, bad = (dict(zip(pdf["cell"].tolist(), pdf[c].tolist())) for c in ("good", "bad"))
        strictest, rung = certified(good, bad, share / count, level)
        whole = {k: pd.array([v], dtype="Int32") for k, v in (("strictest", strictest), ("rung", rung))}
        return pd.DataFrame({"stratum": [pdf["stratum"].iloc[0]], "rule": [pdf["rule"].iloc[0]], "n": [sum(good.values())], **whole})

    # At most STEPS + 1 rows meet per stratum and rule.
    return ladder.crossJoin(F.broadcast(families)).groupBy("stratum", "rule").applyInPandas(grade, "stratum string, rule string, n long, strictest int, rung int")


def verdicts(stats: DataFrame, limits: DataFrame, rules: dict[str, str] | None = None, stratum: str = "stratum") -> DataFrame:
    """``stats`` with the array column ``failed`` of the rules that a document breaks.

    ``limits`` has one row per stratum and rule; it is folded into one row per stratum before the join.
    A rule without a cutoff certified in the stratum itself rejects nothing there.
    """
    rules = rules or RULES
    fold = F.map_from_entries(F.collect_list(F.struct(F.col("rule"), F.coalesce("rung", F.lit(STEPS)).alias("rung"))))
    own = limits.where("strictest IS NOT NULL").groupBy("stratum").agg(fold.alias("__own")).withColumnRenamed("stratum", "__stratum")
    kept = [c for c in stats.columns if c != "failed"]
    mine, at = free_name(kept, "__own"), free_name(kept, "__stratum")
    own = own.withColumnRenamed("__own", mine).withColumnRenamed("__stratum", at)
    joined = stats.join(own, F.coalesce(F.col(stratum), F.lit("")) == F.col(at), "left")
    broken = []
    for name, sql in rules.items():
        cell = F.ceil(F.coalesce(F.expr(f"CASE WHEN n_words > 0 THEN {sql} END"), F.lit(0.0)) * STEPS - F.lit(1e-9))
        broken.append(F.when(cell > F.element_at(mine, F.lit(name)), F.lit(name)))
    return joined.select(*[F.col(f"`{c}`") for c in kept], F.array_compact(F.array(*broken)).alias("failed"))


def verdict_of_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, good): 1 if all quality labels of a document are 1, else 0."""
    return labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") == 1).cast("int").alias("good"))


def one_per_text(holdout: DataFrame, text_key: str, stratum: str = "stratum") -> DataFrame:
    """One row per stratum and text, good only if all its copies are; the statistics of equal texts are equal."""
    same = [c for c in holdout.columns if c not in (stratum, text_key, "good")]
    return holdout.groupBy(stratum, text_key).agg(F.min("good").alias("good"), *[F.max(c).alias(c) for c in same])
