"""Modeling (M1-M23) on Spark ML.

* Split (M1) is a hash of the row's content against a threshold: stable across runs,
  engines and partitionings, no shuffle. ``exact=True`` takes exactly ceil(n * test_size)
  rows by radix selection on the hash instead.
* Preprocessing (M2-M5) is a ``Pipeline``: exact train medians and population standard
  deviations (a small Python estimator whose fit is one aggregate), then
  ``StringIndexer(keep, alphabetAsc)`` + ``OneHotEncoder(dropLast)`` so an unseen label is
  an all-zero vector, then ``VectorAssembler``. Vectors stay sparse.
* Regressors (M6-M14) are Spark ML estimators with the surveyed hyper-parameters; the log
  target (M15) is two ``SQLTransformer`` stages around the regressor, so every pipeline is
  plain Spark ML and persists with ``PipelineModel.save``.
* Metrics (M18-M23) are one grouped aggregate over a long predictions frame.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCols, HasPredictionCol
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kvadrat.session import checkpointed
from kvadrat import schema as S
from kvadrat.operators import stats as E
from kvadrat.operators.boosting import CompactGBTRegressor

FEATURES_COL = "features"

# ---------------------------------------------------------------------------
# M1: split
# ---------------------------------------------------------------------------

SPLIT_KEY = E.SAMPLE_KEY


def split_threshold(test_size: float) -> str:
    """Hex prefix below which a row's md5 falls into the test set."""
    return format(int(test_size * 16**8), "08x")


KEY_BITS = 60


def smallest(df: DataFrame, keys: list[str], k: int, digit: int = 12) -> Column:
    """Condition that holds for exactly the ``k`` rows of ``df`` with the smallest keys, by radix
    selection: rows are counted by the highest ``digit`` bits of the key, then by the next ones among the
    rows of the digit that holds the k-th, and so on; each count returns at most 2^digit rows, and
    few rounds are needed, for a round that takes or leaves a whole digit is the last. ``keys`` are
    long columns of ``KEY_BITS`` bits, a later one telling rows apart that are equal in those before."""
    below, same = F.lit(False), F.lit(True)
    if k <= 0:
        return below
    for key in keys:
        prefix = 0
        for shift in range(KEY_BITS - digit, -1, -digit):
            inside = same & (F.shiftright(key, shift + digit) == prefix)
            counts = df.filter(inside).groupBy(F.shiftright(key, shift).alias("prefix")).agg(F.count(F.lit(1)).alias("n")).collect()
            for row in sorted(counts, key=lambda r: r["prefix"]):
                if k <= row["n"]:
                    break
                k -= row["n"]
            else:  # fewer rows than asked for: all of them
                return below | same
            prefix = row["prefix"]
            if k == row["n"]:
                return below | (same & (F.shiftright(key, shift) <= prefix))
        below, same = below | (same & (F.col(key) < prefix)), same & (F.col(key) == prefix)
    raise ValueError("rows with equal keys cannot be told apart")


def with_split(
    df: DataFrame,
    test_size: float = S.TEST_SIZE,
    seed: int = S.RANDOM_STATE,
    key: list[str] | None = None,
    exact: bool = False,
) -> DataFrame:
    """M1: add ``is_test``. Default: md5(seed, key) prefix below the threshold (about
    ``test_size`` of the rows, decided row by row). ``exact``: the ceil(n * test_size)
    rows with the smallest hash, no more and no fewer. Rows that share a hash of the key are told
    apart by a hash of all their columns, equal rows by their numbers in the written frame."""
    key = key or SPLIT_KEY
    h = E.row_hash(key, seed)
    if not exact:
        return df.withColumn("is_test", F.substring(h, 1, 8) < F.lit(split_threshold(test_size)))
    bits = lambda c: F.shiftrightunsigned(c, 64 - KEY_BITS)
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    # written once: the numbers stay, and the selection reads three longs a row
    keyed = checkpointed(df.withColumns({
        "_k1": F.conv(F.substring(h, 1, KEY_BITS // 4), 16, 10).cast("long"),
        "_k2": bits(whole),
        "_k3": bits(F.xxhash64(F.monotonically_increasing_id())),
    }))
    k = math.ceil(keyed.count() * test_size)
    return keyed.withColumn("is_test", smallest(keyed, ["_k1", "_k2", "_k3"], k)).drop("_k1", "_k2", "_k3")


# ---------------------------------------------------------------------------
# M2, M3: exact median imputation + population standardization
# ---------------------------------------------------------------------------


class _NumericParams(HasInputCols, HasOutputCols):
    scale = Param(Params._dummy(), "scale", "standardize after imputing", TypeConverters.toBoolean)

    def __init__(self):
        super().__init__()
        self._setDefault(scale=True)


class MedianStandardizer(Estimator, _NumericParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fill nulls with the exact training median, then (x - mean) / population std.

    Fit is one aggregate over the training frame. A column whose training values are all
    missing cannot be imputed and fails with a clear message; a constant column gets scale 1.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, scale=True):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "MedianStandardizerModel":
        cols = self.getInputCols()
        found = E.quantile_columns(dataset, cols, [0.5]).collect()  # one row per column
        meds = {c: None for c in cols}
        meds.update({r["column_name"]: r["q0"] for r in found})
        empty = [c for c in cols if meds[c] is None]
        if empty:
            raise ValueError(f"Cannot impute columns with no observed training values: {', '.join(empty)}")
        filled = [F.coalesce(F.col(c).cast("double"), F.lit(float(meds[c]))) for c in cols]
        stats = dataset.agg(
            *[F.avg(v).alias(f"m{i}") for i, v in enumerate(filled)],
            *[F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(filled)],
        ).first()
        scale = self.getOrDefault("scale")
        centers = [float(stats[f"m{i}"]) if scale else 0.0 for i in range(len(cols))]
        scales = [
            (float(stats[f"s{i}"]) if scale and stats[f"s{i}"] not in (None, 0.0) else 1.0) for i in range(len(cols))
        ]
        model = MedianStandardizerModel(
            inputCols=cols,
            outputCols=self.getOutputCols(),
            medians=[float(meds[c]) for c in cols],
            centers=centers,
            scales=scales,
        )
        return model


class MedianStandardizerModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    medians = Param(Params._dummy(), "medians", "training medians", TypeConverters.toListFloat)
    centers = Param(Params._dummy(), "centers", "training means after imputation", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "training population stds", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, medians=None, centers=None, scales=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols, outs = self.getInputCols(), self.getOutputCols()
        med, cen, sca = (self.getOrDefault(p) for p in ("medians", "centers", "scales"))
        exprs = {
            o: (F.coalesce(F.col(c).cast("double"), F.lit(m)) - F.lit(ce)) / F.lit(sc)
            for c, o, m, ce, sc in zip(cols, outs, med, cen, sca)
        }
        return dataset.withColumns(exprs)


# ---------------------------------------------------------------------------
# M6: median baseline, M8: ridge
# ---------------------------------------------------------------------------


class MedianRegressor(Estimator, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """M6: always predicts the exact training median of the label."""

    @keyword_only
    def __init__(self, *, labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(labelCol="label", predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "ConstantModel":
        med = E.exact_quantiles(dataset, self.getLabelCol(), [0.5]).first()["q0"]
        return ConstantModel(predictionCol=self.getPredictionCol(), value=float(med))


class ConstantModel(Model, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    value = Param(Params._dummy(), "value", "constant prediction", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, predictionCol="prediction", value=0.0):
        super().__init__()
        self._setDefault(predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getPredictionCol(), F.lit(self.getOrDefault("value")))


class RidgeRegressor(Estimator, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """M8: ridge with penalty ``alpha * ||w||^2`` on the unscaled objective.

    Spark scales the L2 term by the label's standard deviation and averages the loss over n rows, so
    ``regParam = alpha * std(y) / n``; the statistics are one aggregate at fit time. Up to
    ``NORMAL_FEATURES`` features the normal equations are solved (std is the population's there).
    Beyond, where their matrix would not fit, L-BFGS needs one gradient a pass and no matrix (std is the
    sample's there); both minimise the same objective."""

    #: Spark's normal-equation solver takes no more.
    NORMAL_FEATURES = 4096

    alpha = Param(Params._dummy(), "alpha", "L2 strength", TypeConverters.toFloat)
    featuresCol = Param(Params._dummy(), "featuresCol", "features column", TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "passes of the wide solver", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, alpha=1.0, featuresCol=FEATURES_COL, labelCol="label", predictionCol="prediction", maxIter=500):
        super().__init__()
        self._setDefault(alpha=1.0, featuresCol=FEATURES_COL, labelCol="label", predictionCol="prediction", maxIter=500)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame):
        y, features = self.getLabelCol(), self.getOrDefault("featuresCol")
        st = dataset.agg(F.count(F.col(y)).alias("n"), F.stddev_pop(y).alias("pop"), F.stddev_samp(y).alias("samp")).first()
        first = dataset.select(features).first()
        wide = first is not None and first[0].size > self.NORMAL_FEATURES
        std = (st["samp"] if wide else st["pop"]) or 1.0
        lr = LinearRegression(
            featuresCol=features,
            labelCol=y,
            predictionCol=self.getPredictionCol(),
            regParam=self.getOrDefault("alpha") * std / max(st["n"], 1),
            elasticNetParam=0.0,
            standardization=False,
            solver="l-bfgs" if wide else "normal",
            maxIter=self.getOrDefault("maxIter"),
            tol=1e-10,
        )
        return lr.fit(dataset)


# ---------------------------------------------------------------------------
# M4, M5: preprocessing pipeline
# ---------------------------------------------------------------------------


def _idx(c: str) -> str:
    return f"{c}__idx"


def _ohe(c: str) -> str:
    return f"{c}__ohe"


def _num(c: str) -> str:
    return f"{c}__num"


NUMBERS = [_num(c) for c in S.MODEL_NUMERIC_FEATURES]
INDEXED = [_idx(c) for c in S.MODEL_CATEGORICAL_FEATURES]


def categorical_fill() -> SQLTransformer:
    """Constant imputation of the categorical inputs."""
    fills = ", ".join(
        f"coalesce(cast({c} as string), '{S.UNKNOWN}') as {c}__cat" for c in S.MODEL_CATEGORICAL_FEATURES
    )
    return SQLTransformer(statement=f"SELECT *, {fills} FROM __THIS__")


def preprocessing_stages(one_hot: bool = True, scale: bool = True) -> list:
    """M2-M5: numeric imputation/scaling, categorical fill + index (+ one-hot), assemble."""
    num = S.MODEL_NUMERIC_FEATURES
    cat = S.MODEL_CATEGORICAL_FEATURES
    stages: list = [
        MedianStandardizer(inputCols=num, outputCols=[_num(c) for c in num], scale=scale),
        categorical_fill(),
        StringIndexer(
            inputCols=[f"{c}__cat" for c in cat],
            outputCols=[_idx(c) for c in cat],
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
    ]
    if one_hot:
        stages.append(OneHotEncoder(inputCols=[_idx(c) for c in cat], outputCols=[_ohe(c) for c in cat], dropLast=True))
        cat_cols = [_ohe(c) for c in cat]
    else:
        cat_cols = [_idx(c) for c in cat]
    stages.append(VectorAssembler(inputCols=[_num(c) for c in num] + cat_cols, outputCol=FEATURES_COL, handleInvalid="keep"))
    return stages


def build_preprocessor(one_hot: bool = True, scale: bool = True) -> Pipeline:
    return Pipeline(stages=preprocessing_stages(one_hot, scale))


# ---------------------------------------------------------------------------
# Regressors and the model factory
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Sizes:
    """Ensemble sizes. ``REFERENCE`` keeps the surveyed values; ``SMALL`` is for tests."""

    rf_trees: int = 120
    rf_depth: int = 30
    et_trees: int = 800
    et_depth: int = 30
    gb_iter: int = 180
    hgb_iter: int = 160
    cat_iter: int = 700
    xgb_iter: int = 500


REFERENCE = Sizes()
SMALL = Sizes(rf_trees=20, rf_depth=8, et_trees=20, et_depth=8, gb_iter=20, hgb_iter=20, cat_iter=20, xgb_iter=20)


def _regressor(name: str, label: str, pred: str, sizes: Sizes, max_bins: int):
    seed = S.RANDOM_STATE
    common = dict(featuresCol=FEATURES_COL, labelCol=label, predictionCol=pred)
    # boosters read the columns that the features were assembled of
    booster = lambda **given: CompactGBTRegressor(**given).on(NUMBERS, INDEXED, one_hot=name != "catboost")
    builders = {
        "dummy_median": lambda: MedianRegressor(labelCol=label, predictionCol=pred),
        "linear_regression": lambda: LinearRegression(regParam=0.0, elasticNetParam=0.0, standardization=False, **common),
        "ridge_regression": lambda: RidgeRegressor(alpha=1.0, **common),
        "random_forest": lambda: RandomForestRegressor(
            numTrees=sizes.rf_trees, maxDepth=sizes.rf_depth, minInstancesPerNode=2, featureSubsetStrategy="all",
            maxBins=max_bins, seed=seed, **common,
        ),
        "extra_trees": lambda: RandomForestRegressor(
            numTrees=sizes.et_trees, maxDepth=sizes.et_depth, minInstancesPerNode=1, featureSubsetStrategy="0.8",
            bootstrap=False, maxBins=max_bins, seed=seed, **common,
        ),
        "gradient_boosting": lambda: booster(
            maxIter=sizes.gb_iter, stepSize=0.06, maxDepth=3, minInstancesPerNode=2, lossType="squared",
            maxBins=max_bins, seed=seed, **common,
        ),
        "hist_gradient_boosting": lambda: booster(
            maxIter=sizes.hgb_iter, stepSize=0.08, maxDepth=5, minInstancesPerNode=20, maxBins=255,
            lossType="squared", seed=seed, **common,
        ),
        "catboost": lambda: booster(
            maxIter=sizes.cat_iter, stepSize=0.05, maxDepth=6, lossType="absolute", maxBins=max_bins, seed=seed, **common,
        ),
        "xgboost": lambda: booster(
            maxIter=sizes.xgb_iter, stepSize=0.05, maxDepth=9, minInstancesPerNode=1, subsamplingRate=0.8,
            featureSubsetStrategy="0.8", maxBins=max_bins, seed=seed, **common,
        ),
    }
    if name not in builders:
        raise ValueError(f"Unknown model '{name}'. Supported models: {', '.join(sorted(builders))}")
    return builders[name]()


SUPPORTED_MODELS = sorted(
    [
        "dummy_median",
        "linear_regression",
        "ridge_regression",
        "random_forest",
        "extra_trees",
        "gradient_boosting",
        "hist_gradient_boosting",
        "catboost",
        "xgboost",
    ]
)


def parse_key(model_key: str) -> tuple[str, bool]:
    """(regressor, fitted on the log of the label) of a model key."""
    log_target = model_key.endswith(S.LOG_TARGET_SUFFIX)
    base = model_key[: -len(S.LOG_TARGET_SUFFIX)] if log_target else model_key
    if base not in SUPPORTED_MODELS:
        raise ValueError(f"Unknown model '{base}'. Supported models: {', '.join(SUPPORTED_MODELS)}")
    return base, log_target


def build_model_pipeline(
    model_key: str, sizes: Sizes = REFERENCE, max_bins: int = 32, label: str = S.TARGET
) -> Pipeline:
    """M16 (+M15): model key -> full Spark ML pipeline; ``*_log_target`` fits log1p(y)
    and returns expm1 of the prediction. Unknown keys raise listing the supported ones."""
    base, log_target = parse_key(model_key)
    # the native-category booster works on indexed categories (nominal splits, which need a bin
    # for each category), no one-hot; the others have numeric features only and keep fixed bins
    max_bins = max_bins if base == "catboost" else 32
    stages = preprocessing_stages(one_hot=base != "catboost", scale=base != "catboost")
    if log_target:
        stages = [SQLTransformer(statement=f"SELECT *, log1p({label}) AS _log_label FROM __THIS__")] + stages
        stages.append(_regressor(base, "_log_label", "_log_prediction", sizes, max_bins))
        stages.append(SQLTransformer(statement=EXPM1))
    else:
        stages.append(_regressor(base, label, "prediction", sizes, max_bins))
    return Pipeline(stages=stages)


def category_bins(df: DataFrame) -> int:
    """Smallest ``maxBins`` that lets trees split on every indexed category (one aggregate)."""
    counts = df.agg(*[F.count_distinct(c).alias(c) for c in S.MODEL_CATEGORICAL_FEATURES]).first()
    return max(32, max(int(counts[c]) for c in S.MODEL_CATEGORICAL_FEATURES) + 2)


# ---------------------------------------------------------------------------
# Train candidates
# ---------------------------------------------------------------------------


@dataclass
class TrainingResult:
    models: dict  # display name -> (model key, PipelineModel)
    predictions: DataFrame  # model, key columns, y, p (test rows, long form)
    metrics: DataFrame  # ranked metrics
    best_model_name: str
    best_model_key: str
    train_rows: int
    test_rows: int


def predictions_long(fitted: dict, test: DataFrame, id_cols: list[str], label: str = S.TARGET) -> DataFrame:
    """Union of (model, ids, y, p) for every fitted model on the same test frame."""
    out = None
    for name, (_, pm) in fitted.items():
        p = pm.transform(test).select(
            F.lit(name).alias("model"), *id_cols, F.col(label).alias("y"), F.col("prediction").cast("double").alias("p")
        )
        out = p if out is None else out.unionByName(p)
    return out


EXPM1 = "SELECT *, expm1(_log_prediction) AS prediction FROM __THIS__"


def fit_candidates(
    train: DataFrame, specs: list[tuple[str, str]], sizes: Sizes = REFERENCE, parallelism: int = 1, label: str = S.TARGET
) -> dict:
    """{name: (key, PipelineModel)}: preprocessing is fitted once per kind (one-hot or indexed) and
    shared by the pipelines, of which only the regressor is fitted for itself."""
    parsed = {key: parse_key(key) for _, key in specs}
    hot = {key: base != "catboost" for key, (base, _) in parsed.items()}
    shared = {kind: build_preprocessor(one_hot=kind, scale=kind).fit(train) for kind in sorted(set(hot.values()))}
    bins = category_bins(train) if False in shared else 32
    prepared = {
        kind: pre.transform(train).select(FEATURES_COL, *NUMBERS, *INDEXED, label, F.log1p(label).alias("_log_label")) for kind, pre in shared.items()}

    def fit(spec):
        name, key = spec
        (base, log_target), kind = parsed[key], hot[key]
        y, p = ("_log_label", "_log_prediction") if log_target else (label, "prediction")
        fitted = _regressor(base, y, p, sizes, 32 if kind else bins).fit(prepared[kind])
        stages = [shared[kind], fitted] + ([SQLTransformer(statement=EXPM1)] if log_target else [])
        return name, (key, PipelineModel(stages=stages))

    if parallelism > 1:
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(parallelism) as pool:
            return dict(pool.map(fit, specs))
    return dict(fit(s) for s in specs)


def predictions_at_once(fitted: dict, test: DataFrame, id_cols: list[str], label: str = S.TARGET) -> DataFrame:
    """(model, ids, y, p) of all models of ``fit_candidates`` from one pass over the test rows: each
    preprocessing is applied once, every model adds a column, and the columns are exploded."""
    inputs = list(dict.fromkeys([*id_cols, label, *S.MODEL_NUMERIC_FEATURES, *S.MODEL_CATEGORICAL_FEATURES]))
    rows, columns = test.select(*inputs), {}
    for pre in {id(pm.stages[0]): pm.stages[0] for _, pm in fitted.values()}.values():
        scored = pre.transform(rows)
        for name, (key, pm) in fitted.items():
            if pm.stages[0] is pre:
                out = f"_p{len(columns)}"
                scored = pm.stages[1].transform(scored).withColumnRenamed(pm.stages[1].getPredictionCol(), out)
                columns[name] = F.expm1(out) if parse_key(key)[1] else F.col(out).cast("double")
        rows = scored.select(*inputs, *[f"_p{i}" for i in range(len(columns))])
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), c.alias("p")) for n, c in columns.items()])).alias("_m")
    return rows.select(each, *id_cols, F.col(label).alias("y")).select("_m.model", *id_cols, "y", "_m.p")


def train_candidates(
    model_df: DataFrame,
    specs: list[tuple[str, str]] | None = None,
    test_size: float = S.TEST_SIZE,
    seed: int = S.RANDOM_STATE,
    sizes: Sizes = REFERENCE,
    parallelism: int = 1,
) -> TrainingResult:
    """Fit every spec on the same split, score the same test rows, rank by MAE.

    The split is checkpointed once (lineage cut, survives executor loss) and reused by all
    fits; preprocessing is fitted once and the test rows are read once for all models. Each fit is a distributed Spark ML job. ``parallelism`` > 1 submits several fits
    at once from a driver thread pool (as Spark's tuning estimators do)."""
    specs = specs or S.DEFAULT_MODEL_CANDIDATES
    data = model_df.filter(F.col(S.TARGET).isNotNull())
    split = with_split(data, test_size, seed).withColumn("_row", E.row_hash(SPLIT_KEY, seed))
    # what no fit or metric reads is not written
    split = checkpointed(split.select(*S.MODEL_NUMERIC_FEATURES, *S.MODEL_CATEGORICAL_FEATURES, S.TARGET, "is_test", "_row"))
    train = split.filter(~F.col("is_test"))
    test = split.filter(F.col("is_test"))
    fitted = fit_candidates(train, specs, sizes, parallelism)
    preds = predictions_at_once(fitted, test, ["_row"])
    metrics = rank_models(regression_metrics(preds))  # one row per model, scored once
    check_metrics(metrics, [name for name, _ in specs])
    best = metrics.filter(F.col("rank_by_mae") == 1).first()
    counts = split.groupBy("is_test").count().collect()
    n = {r["is_test"]: r["count"] for r in counts}
    return TrainingResult(
        models=fitted,
        predictions=preds,
        metrics=metrics,
        best_model_name=best["model"],
        best_model_key=fitted[best["model"]][0],
        train_rows=int(n.get(False, 0)),
        test_rows=int(n.get(True, 0)),
    )


# ---------------------------------------------------------------------------
# evaluation
# ---------------------------------------------------------------------------


def regression_metrics(preds: DataFrame, model: str = "model", y: str = "y", p: str = "p") -> DataFrame:
    """MAE, RMSE and R^2 per model in one aggregate (R^2 via var_pop, numerically
    stable). Models without rows do not appear; ``check_metrics`` raises on that."""
    err = F.col(y) - F.col(p)
    g = preds.groupBy(model).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(y).alias("n_y"),
        F.count(p).alias("n_p"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.sum(err * err).alias("_sse"),
        F.var_pop(y).alias("_var"),
    )
    r2 = F.when(F.col("_var") > 0, 1 - F.col("_sse") / (F.col("_var") * F.col("n")))
    return g.select(model, "mae", "rmse", r2.alias("r2"), "n", "n_y", "n_p")


EMPTY = "Regression evaluation requires at least one prediction."


def check_metrics(metrics: DataFrame, models: list[str] | None = None) -> None:
    """Raise like the reference for empty or misaligned prediction sets, from the metrics' own rows:
    the predictions are not made again. ``models`` are those that must have some."""
    rows = metrics.collect()  # one row per model
    if not rows or set(models or []) - {r["model"] for r in rows}:
        raise ValueError(EMPTY)
    if any(r["n"] != r["n_y"] or r["n"] != r["n_p"] for r in rows):
        raise ValueError("y_true and y_pred must have the same length.")


def rank_models(metrics: DataFrame) -> DataFrame:
    """Rank 1..n by MAE ascending (ties by name); a frame without a model raises, as the
    reference does. The metrics frame has one row per model: it is written once, and its single
    ordered window is bounded by the number of candidates."""
    metrics = checkpointed(metrics)
    if metrics.isEmpty():
        raise ValueError(EMPTY)
    w = Window.orderBy(F.col("mae").asc(), F.col("model").asc())
    return metrics.withColumn("rank_by_mae", F.row_number().over(w))


def best_model(metrics: DataFrame) -> DataFrame:
    """Name of the lowest-MAE model."""
    return metrics.agg(F.min_by("model", F.struct("mae", "model")).alias("best_model"))


def actual_vs_predicted(preds: DataFrame, n: int = 10, order_col: str = "_row") -> DataFrame:
    """Actual, predicted and absolute error of the first ``n`` test rows."""
    rows = preds.orderBy(order_col).limit(n)
    return rows.select(
        F.col("y").alias("actual_price_eur"),
        F.col("p").alias("predicted_price_eur"),
        F.abs(F.col("y") - F.col("p")).alias("absolute_error_eur"),
    )


def error_describe(preds: DataFrame, digits: int = 2) -> DataFrame:
    """Describe (quartiles) of actual, predicted and absolute error."""
    frame = preds.select(
        F.col("y").alias("actual_price_eur"),
        F.col("p").alias("predicted_price_eur"),
        F.abs(F.col("y") - F.col("p")).alias("absolute_error_eur"),
    )
    return E.describe(
        frame, ["actual_price_eur", "predicted_price_eur", "absolute_error_eur"], [0.25, 0.5, 0.75], digits
    )


def metric_rankings(metrics: DataFrame) -> DataFrame:
    """Position of every model under each metric (MAE, RMSE ascending; R^2 descending)."""
    long = metrics.select(
        "model",
        F.explode(
            F.array(
                F.struct(F.lit("mae").alias("metric"), F.col("mae").alias("value"), F.col("mae").alias("_k")),
                F.struct(F.lit("rmse").alias("metric"), F.col("rmse").alias("value"), F.col("rmse").alias("_k")),
                F.struct(F.lit("r2").alias("metric"), F.col("r2").alias("value"), (-F.col("r2")).alias("_k")),
            )
        ).alias("m"),
    ).select("model", "m.metric", "m.value", "m._k")
    w = Window.partitionBy("metric").orderBy(F.col("_k").asc_nulls_last(), F.col("model").asc())
    return long.withColumn("position", F.row_number().over(w)).drop("_k")
