"""Out-of-fold models on MLlib: every fit is distributed; the driver only loops over folds."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import add

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions import expr as E
from rowloom.operators.encode import Factorize, ordered_means
from rowloom.operators.folds import group_fold, with_folds
from rowloom.operators.joins import skew_join
from rowloom.operators.rollup import stat
from rowloom.operators.schema import column_classes
from rowloom.session import scratch_path

#: Stand-in for a missing value: MLlib trees learn no direction for missing values.
MISSING = -999.0

Maker = Callable[[], Estimator]


def gbt(seed: int = 42, trees: int = 60, rate: float = 0.1, depth: int = 5, rows: float = 0.8, cols: str = "0.3"):
    """Boosted trees that stop early on the held-out fold."""
    return GBTClassifier(
        labelCol="label",
        featuresCol="features",
        maxIter=trees,
        stepSize=rate,
        maxDepth=depth,
        subsamplingRate=rows,
        featureSubsetStrategy=cols,
        seed=seed,
        validationIndicatorCol="_held_out",
        validationTol=0.0,
    )


def forest(seed: int = 42, trees: int = 60, depth: int = 7, cols: str = "sqrt"):
    return RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, featureSubsetStrategy=cols, seed=seed
    )


def logistic(regularization: float = 0.01, rounds: int = 100):
    return LogisticRegression(labelCol="label", featuresCol="features", regParam=regularization, maxIter=rounds)


def families(seed: int = 42, trees: int = 60) -> dict[str, Maker]:
    """Three unlike learners, so that blends have something to gain."""
    return {
        "gbt": lambda: gbt(seed, trees),
        "forest": lambda: forest(seed, trees),
        "logistic": lambda: logistic(),
    }


def _absent(c: str) -> Column:
    return F.col(c).isNull() | F.isnan(F.col(c).cast("double"))


def nullable(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns with missing values, in one pass."""
    row = df.agg(*[F.count_if(_absent(c)).alias(c) for c in cols]).first()
    return [c for c in cols if row[c]]


def feature_vector(df: DataFrame, cols: Sequence[str], flags: Sequence[str] = ()) -> DataFrame:
    """Add ``features``: the columns with missing values filled, then one flag per column of
    ``flags`` (1 where it is missing)."""
    filled = [
        f"coalesce(CASE WHEN abs(cast(`{c}` AS double)) < double('infinity') THEN cast(`{c}` AS double) END, {MISSING}D)"
        f" AS `_f_{c}`"
        for c in cols
    ]
    marks = [f"cast(`{c}` IS NULL OR isnan(cast(`{c}` AS double)) AS double) AS `_m_{c}`" for c in flags]
    inputs = [f"_f_{c}" for c in cols] + [f"_m_{c}" for c in flags]
    wide = df.selectExpr("*", *filled, *marks)
    return VectorAssembler(inputCols=inputs, outputCol="features").transform(wide).drop(*inputs)


def positive(probability: str = "probability") -> Column:
    return F.element_at(vector_to_array(F.col(probability)), 2)


def _average(cols: Sequence[Column]) -> Column:
    return reduce(add, cols) / F.lit(float(len(cols)))


#: Column of the part a stored row lies in: its fold, or UNSEEN without one.
_PART, UNSEEN = "_part", -1


def stored_parts(rows: DataFrame, fold: str) -> DataFrame:
    """``rows`` written once with a folder per fold, so that a fit or a scoring reads the folds it needs."""
    parted = rows.withColumn(_PART, F.coalesce(F.col(fold).cast("int"), F.lit(UNSEEN)))
    path = scratch_path(rows.sparkSession, "folds")
    parted.write.partitionBy(_PART).parquet(path)
    return rows.sparkSession.read.schema(parted.schema).parquet(path)


def _of_fold(rows: DataFrame, f: int, own: Sequence[str]) -> DataFrame:
    """``features`` with the columns that model f has for itself, which are named with its number."""
    if not own:
        return rows
    assembler = VectorAssembler(inputCols=["features", *[f"{c}{f}" for c in own]], outputCol="_wide")
    return assembler.transform(rows).drop("features").withColumnRenamed("_wide", "features")


def _fitted_model(make: Maker, rows: DataFrame, f: int, path: str | None) -> Transformer:
    """The model of fold f: read from ``path`` if an earlier run has left it there whole, else fitted and saved."""
    if path:
        try:
            return PipelineModel.load(path)
        except Exception:  # nothing there, or a part of a model: fit it again
            pass
    estimator = make()
    if estimator.hasParam("validationIndicatorCol") and estimator.isDefined(estimator.validationIndicatorCol):
        model = estimator.fit(rows.withColumn("_held_out", F.col(_PART) == f))
    else:
        model = estimator.fit(rows.where(F.col(_PART) != f))
    if path:
        PipelineModel(stages=[model]).write().overwrite().save(path)
    return model


def fit_folds(rows: DataFrame, make: Maker, k: int, own: Sequence[str] = (), save_to: str | None = None) -> list[Transformer]:
    """One model per fold of ``stored_parts`` rows, trained without it; boosted trees watch the fold for early
    stopping. The fits run side by side, so the last tasks of one leave no executor idle."""
    train = rows.where(F.col("label").isNotNull() & (F.col(_PART) != UNSEEN))

    def fit(f: int) -> Transformer:
        return _fitted_model(make, _of_fold(train, f, own), f, f"{save_to}/{f}" if save_to else None)

    with ThreadPoolExecutor(max_workers=k) as pool:
        return list(pool.map(inheritable_thread_target(rows.sparkSession)(fit), range(k)))


def _scored_by(rows: DataFrame, model: Transformer, out: str) -> DataFrame:
    """One more score column. The score of a regressor is its prediction."""
    scored = model.transform(rows)
    score = positive() if "probability" in scored.columns else F.col("prediction")
    return scored.withColumn(out, score).drop("rawPrediction", "probability", "prediction")


def score_folds(rows: DataFrame, models: Mapping[str, Sequence[Transformer]], own: Sequence[str] = ()) -> DataFrame:
    """A row of fold f goes through model f alone; a row without a fold gets the mean of all models."""
    kept = [c for c in rows.columns if c != "features"]
    k = len(next(iter(models.values())))
    branches = []
    for f in range(k):
        part = _of_fold(rows.where(F.col(_PART) == f), f, own)
        for name, fitted in models.items():
            part = _scored_by(part, fitted[f], name)
        branches.append(part.select(*kept, *models))
    rest = rows.where((F.col(_PART) == UNSEEN) | (F.col(_PART) >= k))
    for name, fitted in models.items():
        for f, model in enumerate(fitted):
            scored = _scored_by(_of_fold(rest.withColumn("_plain", F.col("features")), f, own), model, f"_p{f}")
            rest = scored.drop("features").withColumnRenamed("_plain", "features")
        rest = rest.withColumn(name, _average([F.col(f"_p{f}") for f in range(k)])).drop(*[f"_p{f}" for f in range(k)])
    return reduce(DataFrame.unionByName, branches, rest.select(*kept, *models))


def oof_fit(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    makers: Mapping[str, Maker],
    fold: str = "fold",
    k: int = 5,
    flags: bool = True,
    categorical: Sequence[str] = (),
    save_to: str | None = None,
) -> DataFrame:
    """(key, label, fold, <model>...): out-of-fold scores of labelled rows, fold-mean scores of
    unlabelled rows, one column per model. ``flags`` adds a column per input with missing values.

    ``categorical`` names the features that are categories: each becomes its running label mean over the rows a
    model is trained on (``encode.ordered_means``), in place of its code. Models are saved under ``save_to``, if
    that is given, and a second run with the same inputs takes up those that are there.
    """
    plain = [c for c in features if c not in set(categorical)]
    cats = [c for c in features if c in set(categorical)]
    own: list[str] = []
    if cats:
        df = df.join(ordered_means(df, key, cols=cats, label=label, fold=fold, k=k), key, "left")
        own = [f"{c}_OTS" for c in cats]
    rows = feature_vector(df, plain, nullable(df, plain) if flags and plain else ()).select(
        key, F.col(label).cast("double").alias("label"), F.col(fold).alias("_fold"), "features", *[f"{c}{f}" for c in own for f in range(k)]
    )
    rows = stored_parts(rows, "_fold")
    models = {name: fit_folds(rows, make, k, own, f"{save_to}/{name}" if save_to else None) for name, make in makers.items()}
    return score_folds(rows, models, own).select(key, F.col("label").cast("int").alias(label), F.col("_fold").alias(fold), *makers)


def seed_average(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    make: Callable[[int], Estimator],
    seeds: Sequence[int] = (456, 789, 1234),
    k: int = 5,
    out: str = "seed_avg",
) -> DataFrame:
    """Scores averaged over seeds; each seed has its own folds."""
    parts = []
    for seed in seeds:
        folded = with_folds(df, key, label, k, seed)
        parts.append(oof_fit(folded, key, features, label, {"p": lambda seed=seed: make(seed)}, k=k))
    stacked = reduce(DataFrame.unionByName, parts)
    return stacked.groupBy(key).agg(F.max(label).alias(label), F.avg("p").alias(out))


def stack(
    df: DataFrame,
    key: str,
    scores: Sequence[str],
    label: str,
    raw: Sequence[str] = (),
    c: float = 0.35,
    k: int = 5,
    seed: int = 789,
    out: str = "stack_lr",
) -> DataFrame:
    """Second level: out-of-fold scores plus raw columns into a ridge logistic model.

    ``c`` is the inverse penalty on the summed loss, so the penalty on the mean loss is 1/(c n).
    """
    folded = with_folds(df, key, label, k, seed)
    n_train = df.where(F.col(label).isNotNull()).count() * (k - 1) / k

    def make() -> Estimator:
        return LogisticRegression(
            labelCol="label",
            featuresCol="features",
            regParam=1.0 / (c * max(n_train, 1)),
            elasticNetParam=0.0,
            standardization=False,
            maxIter=200,
        )

    return oof_fit(folded, key, [*scores, *raw], label, {out: make}, k=k, flags=False)


def child_submodel(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    row_key: str,
    features: Sequence[str],
    label: str,
    prefix: str,
    make: Maker,
    k: int = 5,
    seed: int = 42,
    high_risk: float = 0.15,
) -> DataFrame:
    """Score child rows with a model of the parent label, then roll the scores up per parent.

    Rows of a labelled parent get the parent's fold; a parent never sees a model of its own rows.
    """
    labels = parent.where(F.col(label).isNotNull()).select(key, F.col(label).alias("_y"))
    rows = skew_join(child.select(key, row_key, *features), labels, [key], "left").withColumn(
        "fold", F.when(F.col("_y").isNotNull(), group_fold(key, k, seed))
    )
    unique = rows.select(
        F.struct(key, row_key).alias("_row"), F.col("_y"), "fold", *features
    )
    scored = oof_fit(unique, "_row", features, "_y", {"score": make}, k=k)
    return score_rollup(scored.select(F.col(f"_row.{key}").alias(key), "score"), key, "score", prefix, high_risk)


def score_rollup(df: DataFrame, key: str, score: str, prefix: str, high_risk: float = 0.15) -> DataFrame:
    """Mean, max, min and deviation of row scores per entity, and the count above a threshold."""
    return df.groupBy(key).agg(
        *[stat(how, score).alias(f"{prefix}_SUB_{how.upper()}") for how in ("mean", "max", "min", "std")],
        F.count_if(F.col(score) > high_risk).alias(f"{prefix}_SUB_HIGHRISK"),
    )


def predict_column(
    df: DataFrame,
    key: str,
    target: str,
    features: Sequence[str],
    prefix: str = "APP",
    make: Callable[[], Estimator] | None = None,
) -> DataFrame:
    """Add a prediction of ``target`` from the other columns, the residual (0 where the target
    is missing) and a missing flag. The model sees all rows that have the target, their own
    included. The columns are always there; the prediction is NULL if no row has the target."""
    if df.where(F.col(target).isNotNull()).limit(1).count() == 0:
        empty = df.withColumn(f"{prefix}_{target}_PRED", F.lit(None).cast("double"))
        return residuals(empty, target, prefix)
    text = [c for c in features if c in column_classes(df)[1]]
    coded = df
    for c in text:
        step = Factorize(c, key, f"_code_{c}")
        filled = coded.withColumn(c, F.coalesce(c, F.lit("__MISSING__")))
        coded = step.fit(filled).transform(filled)
    inputs = [f"_code_{c}" if c in text else c for c in features]
    rows = feature_vector(coded, inputs).select(key, F.col(target).cast("double").alias("label"), "features")
    maker = make or (lambda: GBTRegressor(maxIter=40, stepSize=0.1, maxDepth=5, subsamplingRate=0.8, seed=42))
    model = maker().fit(rows.where(F.col("label").isNotNull()))
    predicted = model.transform(rows).select(key, F.col("prediction").alias(f"{prefix}_{target}_PRED"))
    return residuals(df.join(predicted, key, "left"), target, prefix)


def residuals(df: DataFrame, target: str, prefix: str = "APP") -> DataFrame:
    """Residual and missing flag beside an existing prediction column."""
    return df.withColumns(
        {
            f"{prefix}_{target}_DIFF": F.coalesce(F.col(target) - F.col(f"{prefix}_{target}_PRED"), F.lit(0.0)),
            f"{prefix}_{target}_MISSING": F.col(target).isNull().cast("int"),
        }
    )


def residual_summary(df: DataFrame, targets: Sequence[str], prefix: str = "APP", group: str = "EXT_SOURCE"):
    """Row-wise mean and deviation of the predictions, absolute sum and deviation of the residuals."""
    pred = [f"{prefix}_{t}_PRED" for t in targets if f"{prefix}_{t}_PRED" in df.columns]
    diff = [f"{prefix}_{t}_DIFF" for t in targets if f"{prefix}_{t}_DIFF" in df.columns]
    added = {}
    if pred:
        added[f"{prefix}_{group}_PRED_MEAN"] = E.row_mean(pred)
        added[f"{prefix}_{group}_PRED_STD"] = E.row_std(pred)
    if diff:
        added[f"{prefix}_{group}_DIFF_ABS_SUM"] = E.row_sum([F.abs(F.col(c)) for c in diff])
        added[f"{prefix}_{group}_DIFF_STD"] = E.row_std(diff)
    return df.withColumns(added) if added else df


