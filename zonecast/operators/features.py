"""Feature engineering as a fit/transform pair.

``fit_state`` computes the only data-dependent state (exact medians of the
numeric features and the sorted category list of each categorical feature) in a
few bounded aggregate jobs; ``transform`` is then a single narrow projection
(no shuffle, no UDF) that any number of rows can stream through.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast import schema as S
from zonecast.functions import dist_to_zone_center, zone_mid
from zonecast.operators.prep import available_features
from zonecast.operators.selection import column_medians

UNKNOWN = "Unknown"
MAX_CATEGORIES = 10_000  # columns of a matrix
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


@dataclass
class FeatureState:
    numeric: list[str]
    medians: dict[str, float | None]
    categorical: list[str]
    categories: dict[str, list[str]] = field(default_factory=dict)

    def encoded_names(self) -> list[str]:
        return [f"{c}_{v}" for c in self.categorical for v in self.categories[c][1:]]

    def feature_names(self) -> list[str]:
        return list(self.numeric) + self.encoded_names()

    def to_json(self) -> str:
        return json.dumps(self.__dict__, sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> "FeatureState":
        return cls(**json.loads(text))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(self.to_json(),)], "state string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FeatureState":
        return cls.from_json(spark.read.text(path).first()[0])


# --- F1 / F2 ------------------------------------------------------------------

def add_engineered(df: DataFrame) -> DataFrame:
    """zone_mid = (sz_top+sz_bot)/2 and its distance to the pitch; 0.0 when inputs are absent."""
    cols = df.columns
    zm = zone_mid() if ("sz_top" in cols and "sz_bot" in cols) else F.lit(0.0)
    out = df.withColumn("zone_mid", zm)
    if "plate_x" in cols and "plate_z" in cols:
        return out.withColumn("dist_to_zone_center", dist_to_zone_center())
    return out.withColumn("dist_to_zone_center", F.lit(0.0))


# --- fit ------------------------------------------------------------------------

def category_lists(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct values (null as 'Unknown') of each column, in one distinct job.

    A category becomes a column of the matrix, so the lists are as wide as the
    result; more than ``MAX_CATEGORIES`` of one column raise before any is collected."""
    if not columns:
        return {}
    long = df.select([F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value")
    distinct = long.distinct()
    wide = distinct.groupBy("column").count().filter(F.col("count") > MAX_CATEGORIES).collect()
    if wide:
        raise ValueError(f"not one-hot features (over {MAX_CATEGORIES} categories): {sorted(r['column'] for r in wide)}")
    rows = distinct.collect()
    out = {c: [] for c in columns}
    for r in rows:
        out[r["column"]].append(r["value"])
    return {c: sorted(v) for c, v in out.items()}


def fit_state(df: DataFrame, numeric: Sequence[str] = S.NUMERIC_FEATURES,
              categorical: Sequence[str] = S.CATEGORICAL_FEATURES) -> FeatureState:
    e = add_engineered(df)
    present_num = available_features(e, numeric)
    present_cat = available_features(e, categorical)
    return FeatureState(numeric=present_num, medians=column_medians(e, present_num),
                        categorical=present_cat, categories=category_lists(e, present_cat))


# --- transform pieces (F3 .. F7) -------------------------------------------------

def impute_expr(c: str, state: FeatureState) -> Column:
    m = state.medians.get(c)
    col = F.col(c).cast("double")
    col = F.when(F.isnan(col), F.lit(None)).otherwise(col)
    return col if m is None else F.coalesce(col, F.lit(float(m)))


def impute_median(df: DataFrame, state: FeatureState) -> DataFrame:
    e = add_engineered(df) if "zone_mid" not in df.columns else df
    return e.withColumns({c: impute_expr(c, state) for c in state.numeric if c in e.columns})


def fill_unknown(df: DataFrame, columns: Sequence[str] = S.CATEGORICAL_FEATURES) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)) for c in columns if c in df.columns})


def one_hot_exprs(state: FeatureState, source: dict[str, Column] | None = None) -> list[Column]:
    """Drop-first one-hot columns; an unseen category encodes as all zeros."""
    out = []
    for c in state.categorical:
        v = (source or {}).get(c, F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)))
        for cat in state.categories[c][1:]:
            out.append(F.when(v == F.lit(cat), F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{c}_{cat}"))
    return out


def coerce_numeric(c: Column, text: bool = False) -> Column:
    """The number, or 0.0 where there is none: null, NaN, and (for ``text``) anything but a plain decimal number."""
    number = F.when(c.rlike(NUMBER), F.trim(c).try_cast("double")) if text else c.try_cast("double")
    return F.when(F.isnan(number), F.lit(0.0)).otherwise(F.coalesce(number, F.lit(0.0)))


def feature_columns(df: DataFrame, state: FeatureState, serving: bool = False) -> list[Column]:
    """Ordered feature expressions over ``df`` (which must already have engineered columns).

    ``serving=True`` follows the what-if rule: a missing numeric value takes the
    fit median, except the engineered columns, which fall back to 0.0.
    """
    cols = []
    for c in state.numeric:
        if c in df.columns:
            if serving and c in S.ENGINEERED_FEATURES:
                expr = F.col(c).cast("double")
            else:
                expr = impute_expr(c, state)
        else:
            m = state.medians.get(c)
            expr = F.lit(0.0 if (m is None or (serving and c in S.ENGINEERED_FEATURES)) else float(m))
        cols.append(coerce_numeric(expr).alias(c))
    # an absent column is a column of missing values: 'Unknown', like a null
    src = {c: (F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)) if c in df.columns else F.lit(UNKNOWN))
           for c in state.categorical}
    cols += one_hot_exprs(state, src)
    return cols


def transform(df: DataFrame, state: FeatureState, keep: Sequence[str] = (), serving: bool = False) -> DataFrame:
    """Feature matrix: ``keep`` columns, then numeric features, then encoded categories."""
    e = add_engineered(df) if "zone_mid" not in df.columns else df
    return e.select(*[F.col(c) for c in keep], *feature_columns(e, state, serving))


def serving_frame(scenarios: DataFrame, state: FeatureState) -> DataFrame:
    """Scenario rows for what-if scoring: absent sz_top/sz_bot take the fit medians
    before the engineered columns are derived."""
    out = scenarios
    if "sz_top" not in out.columns or "sz_bot" not in out.columns:
        for c in ("sz_top", "sz_bot"):
            if c not in out.columns and state.medians.get(c) is not None:
                out = out.withColumn(c, F.lit(float(state.medians[c])))
    return add_engineered(out)


def featurize_with_state(scenarios: DataFrame, state: FeatureState, keep: Sequence[str] = ()) -> DataFrame:
    return transform(serving_frame(scenarios, state), state, keep, serving=True)


def assemble(df: DataFrame, state: FeatureState, output_col: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=state.feature_names(), outputCol=output_col).transform(df)
