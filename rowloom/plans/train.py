"""From the credit tables to a prediction file, for each generation."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions import expr as E
from rowloom.operators import blend, encode, folds, knn, oof, rank, schema, select
from rowloom.operators.assemble import join_features
from rowloom.plans import credit
from rowloom.plans.credit import EXT, KEY, LABEL
from rowloom.plans.matrix import model_matrix
from rowloom.session import stored, stored_by
from rowloom.sources import io

FILES = {
    "train": "application_train.csv",
    "test": "application_test.csv",
    "bureau": "bureau.csv",
    "bureau_balance": "bureau_balance.csv",
    "previous": "previous_application.csv",
    "pos": "POS_CASH_balance.csv",
    "card": "credit_card_balance.csv",
    "installments": "installments_payments.csv",
}
OUTPUT = {
    "1": "submission.csv",
    "1v2": "submission1_v2.csv",
    "2": "submission2.csv",
    "3": "submission3.csv",
    "4": "submission4.csv",
    "5": "submission5.csv",
    "6": "submission6.csv",
}
# Weights of the generations that do not search for them.
FIXED_WEIGHTS = {
    "1": {"gbt": 0.7, "forest": 0.3},
    "1v2": {"gbt": 0.7, "forest": 0.3},
    "2": {"gbt": 0.4, "forest": 0.3, "logistic": 0.3},
}
# Encoder columns of generation 6.
CROSSES = [
    ("NAME_EDUCATION_TYPE", "NAME_INCOME_TYPE"),
    ("CODE_GENDER", "NAME_FAMILY_STATUS"),
    ("OCCUPATION_TYPE", "ORGANIZATION_TYPE"),
    ("AGE_RANGE", "NAME_EDUCATION_TYPE"),
]
GROUP_CATS = [
    "NAME_EDUCATION_TYPE", "ORGANIZATION_TYPE", "OCCUPATION_TYPE", "NAME_INCOME_TYPE", "CODE_GENDER", "AGE_RANGE",
]
GROUP_NUMS = [
    "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "EXT_MEAN", "CREDIT_ANNUITY_RATIO", "ANNUITY_INCOME_RATIO",
    "DAYS_EMPLOYED_YRS",
]
TARGET_CATS = [
    "NAME_EDUCATION_TYPE", "ORGANIZATION_TYPE", "OCCUPATION_TYPE", "NAME_INCOME_TYPE", "CODE_GENDER",
    "NAME_HOUSING_TYPE", "AGE_RANGE", "NAME_EDUCATION_TYPE__NAME_INCOME_TYPE", "CODE_GENDER__NAME_FAMILY_STATUS",
    "OCCUPATION_TYPE__ORGANIZATION_TYPE", "AGE_RANGE__NAME_EDUCATION_TYPE", "NAME_FAMILY_STATUS",
    "NAME_CONTRACT_TYPE",
]
STACK_RAW = [*EXT, "CREDIT_ANNUITY_RATIO", "KNN_TARGET_500", "ANNUITY_INCOME_RATIO"]
SUBMODELS = {"previous": "PREV", "bureau": "BURO", "installments": "INS"}


@dataclass
class Settings:
    """Sizes of a run; the defaults are the published ones where MLlib has the setting."""

    folds: int = 5
    seed: int = 42
    trees: int = 60
    knn: tuple[int, ...] = (500,)
    knn6: tuple[int, ...] = (200, 500)
    max_features: int = 900
    top_features: int = 400
    smoothing: float = 40.0
    min_rows: int = 80
    null_runs: int = 5
    null_sample: int = 60_000
    seeds: tuple[int, ...] = (456, 789, 1234)
    blend_step: float = 0.0125


@dataclass
class Result:
    """``reports`` holds the tables of a run: AUC per model, rank correlations of the models, and
    for searched weights the best ones per fold."""

    predictions: DataFrame
    oof_auc: float
    source: str
    weights: dict[str, float]
    features: list[str] = field(default_factory=list)
    reports: dict[str, DataFrame] = field(default_factory=dict)


def _reports(scored: DataFrame, names: list[str], grid: list | None = None) -> dict[str, DataFrame]:
    known = scored.where(F.col(LABEL).isNotNull())
    ranks = rank.rank_norm(known, KEY, names)
    tables = {"auc": rank.auc_by_model(known, LABEL, names), "rank_correlation": rank.corr_matrix(ranks, names)}
    if grid:
        tables["fold_weights"] = blend.best_vector(known, LABEL, names, grid, ["fold"])
    return tables


def load_tables(spark: SparkSession, data_dir: str, missing: str = "empty", limit: int | None = None):
    """The CSV tables of a folder; absent ones are left out (``missing="error"`` raises)."""
    tables = {}
    for name, file in FILES.items():
        path = f"{data_dir.rstrip('/')}/{file}"
        if not io.path_exists(spark, path):
            if missing == "error":
                raise FileNotFoundError(path)
            continue
        tables[name] = io.scan(spark, path, io.infer_csv_schema(spark, path, credit.IDS), limit=limit)
    return tables


def _present(df: DataFrame, cols) -> list[str]:
    return [c for c in cols if c in df.columns]


def encode6(df: DataFrame, s: Settings) -> DataFrame:
    """(key, new columns): frequency, crosses, group ratios and target encoding of generation 6."""
    text = schema.column_classes(df.drop(KEY, LABEL, "fold"))[1]
    pairs = [p for p in CROSSES if set(p) <= set(df.columns)]
    cats, nums = _present(df, GROUP_CATS), _present(df, GROUP_NUMS)
    single = _present(df, TARGET_CATS)
    given = list(dict.fromkeys([KEY, LABEL, "fold", *text, *cats, *nums, *single]))
    out = df.select(*given)
    out = encode.Frequency(text).fit(out).transform(out)
    out = out.withColumns({"__".join(p): E.cross(list(p)) for p in pairs})
    targets = _present(out, TARGET_CATS)
    out = encode.fit_transform(
        out,
        encode.GroupStats(cats, nums),
        encode.TargetMean(targets, LABEL, smoothing=s.smoothing, min_rows=s.min_rows),
    )
    return out.drop(*[c for c in given if c != KEY])


def submodel_tables(tables: Mapping[str, DataFrame], base: DataFrame, s: Settings) -> list[DataFrame]:
    """Row-level models of three child tables, rolled up."""
    out = []
    for name, prefix in SUBMODELS.items():
        if name not in tables:
            continue
        child = tables[name]
        numeric = schema.column_classes(child.drop(*credit.IDS))[0]
        child = credit.blank_days(child, [c for c in numeric if "DAYS_" in c])
        child = child.withColumn("_row", F.xxhash64(*child.columns))
        out.append(
            oof.child_submodel(
                child, base, KEY, "_row", numeric, LABEL, prefix,
                lambda: oof.gbt(s.seed, s.trees, 0.1, 5, cols="0.5"), s.folds, s.seed,
            )
        )
    return out


def run(tables: Mapping[str, DataFrame], generation: str, s: Settings | None = None) -> Result:
    s = s or Settings()
    return _run6(tables, s) if generation == "6" else _run_early(tables, generation, s)


def _run_early(tables: Mapping[str, DataFrame], generation: str, s: Settings) -> Result:
    df = credit.build_dataset(tables, generation, _predicted_sources if generation == "5" else None)
    text = schema.column_classes(df.drop(KEY, LABEL))[1]
    if text:
        df = encode.OneHot(text).fit(df).transform(df)
    # The wide table is written once, by buckets of the id; every later step scans the columns it needs, and joins on
    # the id move only the other side.
    wide = stored_by(df, KEY, "wide")
    placed = folds.stratified(wide, KEY, LABEL, s.folds, s.seed).select(KEY, "fold")
    near_cols = [*EXT, "APP_CREDIT_ANNUITY_RATIO"]
    folded = wide.select(KEY, LABEL, *near_cols).join(placed, KEY, "left")
    near = knn.target_mean(folded, KEY, near_cols, LABEL, ks=s.knn, fill="median", test="all", name="NEIGHBORS")
    near = near.select(KEY, F.col(f"NEIGHBORS_{s.knn[0]}").alias("NEIGHBORS_TARGET_MEAN"))
    df = schema.clean_names(join_features(wide, [near], KEY)).join(placed, KEY, "left")
    df = stored_by(df, KEY, "matrix")
    features = [c for c in df.columns if c not in (KEY, LABEL, "fold")]
    if generation in ("4", "5"):
        must = [c for c in features if c == "NEIGHBORS_TARGET_MEAN" or c.startswith("APP_EXT_SOURCE")]
        gains = select.gain_importance(df, KEY, features, LABEL, lambda: oof.gbt(s.seed, s.trees))
        kept = {r["feature"] for r in select.top_importance(gains, s.max_features, must).collect()}
        features = [c for c in features if c in kept]
    makers = oof.families(s.seed, s.trees)
    if generation in ("1", "1v2"):
        makers.pop("logistic")
    scored = stored_by(oof.oof_fit(df, KEY, features, LABEL, makers, k=s.folds), KEY, "scored")
    weights = FIXED_WEIGHTS.get(generation)
    names = list(makers)
    grid = None
    if weights is None:
        grid = blend.triple_grid() if len(names) == 3 else blend.pair_grid()
        top = blend.best_vector(scored, LABEL, names, grid).first()
        weights = {c: top[f"w_{c}"] for c in names}
    mixed = scored.select(KEY, LABEL, blend.mix(weights).alias("p"))
    score = rank.auc(mixed, LABEL, "p").first()["auc"]
    predictions = mixed.where(F.col(LABEL).isNull()).select(KEY, F.col("p").alias(LABEL))
    return Result(predictions, score, "blend", weights, features, _reports(scored, names, grid))


def _predicted_sources(base: DataFrame) -> DataFrame:
    """External scores predicted from the other applicant columns, the derived ones included."""
    inputs = [c for c in base.columns if c not in (KEY, LABEL, *EXT)]
    for target in EXT:
        base = oof.predict_column(base, KEY, target, inputs)
    return oof.residual_summary(base, EXT)


def _run6(tables: Mapping[str, DataFrame], s: Settings) -> Result:
    df = credit.build_dataset(tables, "6")
    df = join_features(df, submodel_tables(tables, df.select(KEY, LABEL), s), KEY)
    wide = stored_by(df, KEY, "wide")
    placed = folds.stratified(wide, KEY, LABEL, s.folds, s.seed).select(KEY, "fold")
    folded = stored_by(wide.join(placed, KEY, "left"), KEY, "folded")
    near_cols = [*EXT, "CREDIT_ANNUITY_RATIO"]
    near = knn.target_mean(
        folded.select(KEY, LABEL, "fold", *near_cols), KEY, near_cols, LABEL, ks=s.knn6, fill=-999, test="fold_avg"
    )
    df = stored_by(join_features(folded, [stored_by(encode6(folded, s), KEY, "encoded"), near], KEY), KEY, "encoded_wide")
    matrix = model_matrix(df, KEY, LABEL)
    wide = stored_by(matrix.frame, KEY, "matrix")
    shadow = select.null_importance(wide, KEY, matrix.features, LABEL, runs=s.null_runs, sample=s.null_sample, seed=s.seed)
    kept = {r["feature"] for r in select.keep_rule(shadow).where("keep = 1").collect()}
    features = [c for c in matrix.features if c in kept] or matrix.features
    gains = select.gain_importance(wide, KEY, features, LABEL, folds=(0, 1, 2), seed=s.seed)
    lists = select.subsets(gains, features, s.top_features)
    scored = oof.oof_fit(wide, KEY, lists["all"], LABEL, oof.families(s.seed, s.trees), k=s.folds, categorical=matrix.categorical)
    top = oof.oof_fit(
        folds.with_folds(wide, KEY, LABEL, s.folds, 123), KEY, lists["top"], LABEL,
        {"gbt_top": lambda: oof.gbt(123, s.trees, 0.1, 5, 0.75, "0.35")}, k=s.folds,
    )
    averaged = oof.seed_average(
        wide, KEY, lists["no_prefix"], LABEL, lambda seed: oof.gbt(seed, s.trees, 0.1, 6), s.seeds, s.folds
    )
    scored = stored_by(scored.join(top.select(KEY, "gbt_top"), KEY).join(averaged.select(KEY, "seed_avg"), KEY), KEY, "scored")
    names = [c for c in scored.columns if c not in (KEY, LABEL, "fold")]
    raw = _present(wide, STACK_RAW)
    stacked = oof.stack(
        scored.join(wide.select(KEY, *raw), KEY), KEY, names, LABEL, raw, k=s.folds
    )
    scored = stored_by(scored.join(stacked.select(KEY, "stack_lr"), KEY), KEY, "stacked")
    names.append("stack_lr")
    weights, blend_auc = blend.capped_weights(scored, KEY, LABEL, names, step=s.blend_step)
    stack_auc = rank.auc(scored, LABEL, "stack_lr").first()["auc"]
    unseen = scored.where(F.col(LABEL).isNull())
    if blend_auc >= stack_auc:
        predictions = blend.blend(unseen, KEY, weights, "rank", out=LABEL)
        return Result(predictions, blend_auc, "blend", weights, features, _reports(scored, names))
    stacked_only = unseen.select(KEY, F.col("stack_lr").alias(LABEL))
    return Result(stacked_only, stack_auc, "stack_lr", weights, features, _reports(scored, names))


def main(spark: SparkSession, data_dir: str, out_dir: str, generation: str, s: Settings | None = None) -> Result:
    """Read a folder of CSV tables, write the prediction file of one generation and the reports of the run."""
    tables = load_tables(spark, data_dir, "error" if generation == "6" else "empty")
    result = run(tables, generation, s)
    file = OUTPUT[generation]
    io.write_predictions(result.predictions, f"{out_dir.rstrip('/')}/{file}")
    io.write_reports({f"{file.removesuffix('.csv')}_{name}": t for name, t in result.reports.items()}, out_dir)
    return result


def blend_files(spark: SparkSession, roots, table, out_dir: str, anchor: str = "sub6") -> DataFrame:
    """Discover prediction files, blend each candidate and write it, with the correlations of the files and those to
    the anchor, weakest first; returns all blends."""
    found = io.discover(spark, roots, credit.PREDICTION_FILES, anchor).collect()
    wide = io.load_wide(spark, {r["key"]: r["path"] for r in found})
    names = [c for c in wide.columns if c != KEY]
    matrix = stored(rank.corr_matrix(wide, names), "correlations")
    io.write_reports({"prediction_correlation": matrix, "anchor_correlation": rank.anchor_correlations(matrix, anchor)}, out_dir)
    blends = stored(blend.candidates(wide, KEY, table, anchor))
    for (name,) in blends.select("candidate").distinct().collect():
        io.write_predictions(
            blends.where(F.col("candidate") == name).select(KEY, LABEL), f"{out_dir.rstrip('/')}/{name}.csv"
        )
    return blends
