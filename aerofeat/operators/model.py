"""Delay model: mean imputation → standardisation → logistic regression.

Matches the reference model's definition:

* missing (null or NaN) feature values are replaced by the column mean of the
  training set (``Imputer``);
* features are centred and divided by the **population** standard deviation
  of the imputed training set (a column with zero spread is only centred);
  the constants are computed in one aggregate and frozen into a
  ``SQLTransformer``, so the fitted model is a plain ``PipelineModel``;
* L2-regularised logistic regression with inverse strength ``C`` (default 1)
  on the summed loss: in Spark's mean-loss form that is
  ``regParam = 1 / (C · n)``, ``elasticNetParam = 0``, no internal
  standardisation, intercept not penalised.

Training runs as Spark ML jobs: one pass for the imputer means, one for the
scaling moments and row count, then one distributed gradient aggregation per
L-BFGS iteration.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import TRAIN_FEATURES

# --- fixed values -----------------------------------------------------------
MAX_ITER = 100
TOL = 1e-4
INVERSE_REGULARISATION = 1.0
# ---------------------------------------------------------------------------


def _imp(c):
    return f"{c}__imputed"


def _std(c):
    return f"{c}__scaled"


def fit_scaling(train: DataFrame, features=TRAIN_FEATURES) -> dict:
    """Means for imputation and (mean, population std) of the imputed
    columns, from two aggregates (one row each reaches the driver)."""
    feats = list(features)
    data = train.select(*[F.col(c).cast("double").alias(c) for c in feats])
    imputer = Imputer(strategy="mean", inputCols=feats, outputCols=[_imp(c) for c in feats]).fit(data)
    imputed = imputer.transform(data)
    mom = imputed.agg(F.count(F.lit(1)).alias("n"),
                      *[F.avg(_imp(c)).alias(f"m{i}") for i, c in enumerate(feats)],
                      *[F.stddev_pop(_imp(c)).alias(f"s{i}") for i, c in enumerate(feats)]).first()
    stats = {}
    for i, c in enumerate(feats):
        sd = mom[f"s{i}"]
        stats[c] = (mom[f"m{i}"], sd if sd and sd > 0 else 1.0)
    return {"imputer": imputer, "features": feats, "n": mom["n"], "stats": stats}


def scaling_transformer(fitted: dict, out=_std) -> SQLTransformer:
    exprs = [f"(`{_imp(c)}` - ({m!r})) / ({s!r}) AS `{out(c)}`"
             for c, (m, s) in fitted["stats"].items()]
    return SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")


def apply_scaling(df: DataFrame, fitted: dict) -> DataFrame:
    """Impute and standardise ``df`` in place of its feature columns."""
    feats = fitted["features"]
    cast = df.select(*[F.col(c).cast("double").alias(c) if c in feats else F.col(c)
                       for c in df.columns])
    out = scaling_transformer(fitted).transform(fitted["imputer"].transform(cast))
    return out.select(*[F.col(_std(c)).alias(c) if c in feats else F.col(c) for c in df.columns])


def fit_model(train: DataFrame, features=TRAIN_FEATURES, label: str = "target",
              C: float = INVERSE_REGULARISATION, max_iter: int = MAX_ITER,
              tol: float = TOL) -> PipelineModel:
    feats = list(features)
    data = train.select(*[F.col(c).cast("double").alias(c) for c in feats],
                        F.col(label).cast("double").alias("_label"))
    # the imputer, the moments and L-BFGS each pass over the training rows:
    # keep the compact typed rows (spilling to disk) instead of re-deriving
    # them from the source every time
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = fit_scaling(data, feats)
        n = fitted["n"]
        if not n:
            raise ValueError("empty training set")
        imputer, scaler = fitted["imputer"], scaling_transformer(fitted)
        assembler = VectorAssembler(inputCols=[_std(c) for c in feats], outputCol="features",
                                    handleInvalid="error")
        lr = LogisticRegression(featuresCol="features", labelCol="_label", maxIter=max_iter,
                                tol=tol, regParam=1.0 / (C * n), elasticNetParam=0.0,
                                standardization=False, fitIntercept=True, family="binomial")
        lr_model = lr.fit(assembler.transform(scaler.transform(imputer.transform(data))))
    finally:
        data.unpersist()
    return PipelineModel(stages=[imputer, scaler, assembler, lr_model])


def score(model: PipelineModel, df: DataFrame, keep: tuple | None = None) -> DataFrame:
    """Add ``probability`` (of the positive class) and ``prediction`` (bool).

    Works unchanged on a streaming DataFrame (each stage is a row-wise
    transform)."""
    out = model.transform(df)
    cols = list(df.columns) if keep is None else list(keep)
    return out.select(*cols,
                      vector_to_array("probability")[1].alias("probability"),
                      (F.col("prediction") > 0.5).alias("prediction"))


def coefficients(model: PipelineModel) -> dict:
    lr = model.stages[-1]
    return {"intercept": float(lr.intercept), "coefficients": [float(x) for x in lr.coefficients]}


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
