"""From a wide applicant frame to a numeric model matrix."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.expr import blank_inf
from rowloom.operators import encode, schema
from rowloom.operators.select import corr_filter


@dataclass
class ModelMatrix:
    frame: DataFrame
    features: list[str]
    categorical: list[str]


def model_matrix(
    df: DataFrame, key: str, label: str, corr_limit: float = 0.985, coded: str = "label"
) -> ModelMatrix:
    """Code categories, blank infinities, clean names, drop constant and highly correlated
    columns (judged on labelled rows), and list the categorical columns that stay.

    ``coded`` is ``label`` (text order) or ``factorize`` (first appearance). Columns stay in their
    order, which decides what the correlation filter keeps. A column that is neither a number nor
    text is an error.
    """
    keep = [c for c in (key, label, "fold") if c in df.columns]
    given = [c for c in df.columns if c not in keep]
    numeric, text = schema.column_classes(df.drop(*keep))
    if len(numeric) + len(text) < len(given):
        raise ValueError(f"neither numbers nor text: {[c for c in given if c not in {*numeric, *text}]}")
    if text:
        # Coded on a narrow copy, so that the wide table is joined once and not per column.
        narrow = df.select(key, *text)
        for c in text:
            step = encode.LabelCode(c, "_code") if coded == "label" else encode.Factorize(c, key, "_code")
            narrow = step.fit(narrow).transform(narrow).drop(c).withColumnRenamed("_code", c)
        df = df.drop(*text).join(narrow, key)
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float") and f.name in numeric]
    df = df.withColumns({c: blank_inf(c) for c in floats}) if floats else df
    body = schema.clean_names(df.select(*given), upper=False)
    renamed = dict(zip(given, body.columns))
    df = df.select(*keep, *[F.col(c).alias(n) for c, n in renamed.items()])
    train = df.where(F.col(label).isNotNull())
    gone = set(schema.constant_columns(train.select(*renamed.values())))
    features = [c for c in renamed.values() if c not in gone]
    features = corr_filter(train, features, corr_limit)
    categorical = [renamed[c] for c in given if c in set(text) and renamed[c] in features]
    return ModelMatrix(df.select(*keep, *features), features, categorical)
