"""Tree-ensemble models on MLlib: single model, regime-split seeded ensemble, importances.

Models are trained on calendar days. The fits of an ensemble do not depend on each other, so they
are submitted from a few driver threads and run side by side on the executors. Boosting stops when days that a
fit has held out stop gaining, so the number of rounds is a bound and not a cost.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martflow.functions.ordering import exact_quantiles, materialize
from martflow.operators.features import FEATURE_GROUPS, FORECAST_FEATURES, feature_columns
from martflow.operators.forecast import WEIGHTS, ForecastWeights, day_margin, regression_report

# Random seeds of the ensemble.
SEEDS = (42, 1337, 2024, 7, 99)
NUMERIC = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
# A text column with more values than this is an error: each value becomes a column of the model.
MAX_CATEGORIES = 1_000


# ---------------------------------------------------------------- single model


@dataclass(frozen=True)
class Preprocessing:
    """Median imputation of numbers; most frequent value and one-hot columns for categories."""

    numeric: list[str]
    categorical: list[str]
    fill: dict[str, str]
    medians: dict[str, float]
    model: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        prepared = df.fillna(self.fill) if self.fill else df
        return self.model.transform(_imputed(_as_double(prepared, self.numeric), self.medians))


def _as_double(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns}) if columns else df


def _imputed(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Each number as ``<name>_num``, its gaps filled with the training median."""
    return df.withColumns({f"{c}_num": F.coalesce(F.when(~F.isnan(c), F.col(c)), F.lit(m)) for c, m in medians.items()})


def fit_preprocessing(train: DataFrame, features: list[str]) -> Preprocessing:
    """Learn fills and category codes. Categories unseen in training get an all-zero code.

    Medians are exact. Booleans count as numbers. A text column of more than MAX_CATEGORIES values raises,
    because its codes are kept by the driver and by every row's vector.
    """
    types = dict(train.dtypes)
    numeric = [c for c in features if types[c].startswith(NUMERIC)]
    categorical = [c for c in features if c not in numeric]
    train = _as_double(train, numeric)
    fill: dict[str, str] = {}
    if categorical:
        # One row: the most frequent value of each column.
        modes = train.agg(*[F.mode(c, True).alias(c) for c in categorical]).first()
        fill = {c: modes[c] for c in categorical if modes[c] is not None}
        train = train.fillna(fill)
        sizes = train.agg(*[F.count_distinct(c).alias(c) for c in categorical]).first().asDict()
        if large := sorted(c for c, n in sizes.items() if n > MAX_CATEGORIES):
            raise ValueError(f"more than {MAX_CATEGORIES} categories in {', '.join(large)}")
    medians: dict[str, float] = {}
    if numeric:
        plain = train.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in numeric])
        cuts = exact_quantiles(plain, {c: (c, 0.5) for c in numeric})
        # One row; a column without any number is filled with 0.
        found = train.sparkSession.range(1).select(*[cuts[c].alias(c) for c in numeric]).first()
        medians = {c: found[c] if found[c] is not None else 0.0 for c in numeric}
        train = _imputed(train, medians)
    stages = []
    if categorical:
        codes, vectors = [f"{c}_code" for c in categorical], [f"{c}_vec" for c in categorical]
        stages.append(StringIndexer(inputCols=categorical, outputCols=codes, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=codes, outputCols=vectors, dropLast=True))
    inputs = [f"{c}_num" for c in numeric] + [f"{c}_vec" for c in categorical]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return Preprocessing(numeric, categorical, fill, medians, Pipeline(stages=stages).fit(train))


def build_learner(model_type: str, label: str, seed: int = 42) -> Estimator:
    if model_type == "random_forest":
        return RandomForestRegressor(labelCol=label, numTrees=300, maxDepth=10, seed=seed)
    return GBTRegressor(labelCol=label, maxIter=100, maxDepth=5, stepSize=0.1, seed=seed)


def stump_booster(label: str = "label", rounds: int = 3, step: float = 0.5) -> Estimator:
    """Boosted trees of one split each, on all rows and features: small enough to follow by hand."""
    return GBTRegressor(labelCol=label, maxIter=rounds, maxDepth=1, stepSize=step, maxBins=64)


@dataclass(frozen=True)
class SingleModel:
    """One fitted learner with its preprocessing."""

    prep: Preprocessing
    model: Model
    features: list[str]
    target_col: str
    date_col: str

    def predict(self, df: DataFrame) -> DataFrame:
        """The rows with their prediction as ``pred``; columns made on the way are dropped."""
        return self.model.transform(self.prep.transform(df)).select(*df.columns, F.col("prediction").alias("pred"))


def fit_single(
    train: DataFrame,
    target_col: str = "Revenue",
    date_col: str = "Date",
    model_type: str = "gbt",
    learner: Estimator | None = None,
) -> SingleModel:
    features = feature_columns(train, target_col, date_col)
    prep = fit_preprocessing(train, features)
    ready = materialize(prep.transform(train).select(F.col(target_col).alias("label"), "features"))
    return SingleModel(prep, (learner or build_learner(model_type, "label")).fit(ready), features, target_col, date_col)


def train_and_evaluate(
    train: DataFrame,
    valid: DataFrame,
    target_col: str = "Revenue",
    date_col: str = "Date",
    model_type: str = "gbt",
    learner: Estimator | None = None,
):
    """Fit one model, predict the validation days; returns (model, metrics, predictions)."""
    single = fit_single(train, target_col, date_col, model_type, learner)
    predictions = single.predict(valid).select(date_col, F.col(target_col).alias("actual"), "pred")
    return single.model, regression_report(predictions), predictions


def permutation_importance(single: SingleModel, days: DataFrame, shift: int = 45) -> DataFrame:
    """(feature, MAE, increase): the error when one feature's values move to other days, and by how much it grows.

    The permutation is fixed: in order of date, each day takes the value of the day ``shift`` places later, the last
    days those of the first. Days are a calendar, so they are numbered in one task.
    """
    numbered = materialize(days.withColumn("_row", F.row_number().over(Window.orderBy(single.date_col)) - 1))
    size = F.lit(max(1, numbered.count()))
    actual = F.col(single.target_col)
    frames = [single.predict(days).select(F.lit("").alias("feature"), actual.alias("actual"), "pred")]
    for feature in single.features:
        moved = numbered.select(F.pmod(F.col("_row") - shift, size).alias("_row"), F.col(feature))
        permuted = numbered.drop(feature).join(moved, "_row").select(*days.columns)
        frames.append(single.predict(permuted).select(F.lit(feature).alias("feature"), actual.alias("actual"), "pred"))
    errors = reduce(DataFrame.unionByName, frames).groupBy("feature").agg(F.avg(F.abs(F.col("actual") - F.col("pred"))).alias("MAE"))
    plain = errors.where(F.col("feature") == "").select(F.col("MAE").alias("_plain"))
    # one row a feature, against one row
    found = errors.where(F.col("feature") != "").crossJoin(F.broadcast(plain))
    return found.select("feature", "MAE", (F.col("MAE") - F.col("_plain")).alias("increase"))


# ---------------------------------------------------------------- ensemble


@dataclass(frozen=True)
class EnsembleSize:
    """How large each learner is. Jobs and registered queries share these defaults.

    ``boosted_rounds`` is an upper bound: a boosted fit holds out ``held_out`` of the days, by seed, and ends when a
    round lowers their error by less than ``tolerance`` of it.
    """

    boosted_rounds: int = 1_000
    forest_trees: int = 200
    depth: int = 6
    step: float = 0.1
    held_out: float = 0.1
    tolerance: float = 0.001
    seeds: tuple[int, ...] = SEEDS
    threads: int = 4


def _boosted(size: EnsembleSize, depth: int) -> Callable[[int], Estimator]:
    return lambda seed: GBTRegressor(
        maxIter=size.boosted_rounds, maxDepth=depth, stepSize=size.step, subsamplingRate=0.8,
        featureSubsetStrategy="0.8", seed=seed, validationIndicatorCol=f"held_{seed}", validationTol=size.tolerance,
    )


def _with_held_out(ready: DataFrame, size: EnsembleSize) -> DataFrame:
    """A column for each seed that tells its held-out days, by a hash of the day."""
    draw = lambda seed: F.pmod(F.xxhash64("Date", F.lit(seed)), F.lit(1_000)) < int(1_000 * size.held_out)
    return ready.withColumns({f"held_{seed}": draw(seed) for seed in size.seeds})


def _forest(size: EnsembleSize) -> Callable[[int], Estimator]:
    return lambda seed: RandomForestRegressor(
        numTrees=size.forest_trees, maxDepth=size.depth, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed
    )


def three_learners(size: EnsembleSize) -> list[Callable[[int], Estimator]]:
    """Deep boosted trees, shallower boosted trees, and a random forest."""
    return [_boosted(size, size.depth), _boosted(size, max(size.depth - 1, 1)), _forest(size)]


def _vectors(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep").transform(df)


@dataclass(frozen=True)
class Ensemble:
    """Fitted learners as (number of the learner, seed, model)."""

    members: list[tuple[int, int, Model]]
    features: list[str]
    log_target: bool

    def predict(self, test: DataFrame) -> DataFrame:
        """Mean prediction per day over all learners and seeds, on the original scale."""
        days = materialize(_vectors(test, self.features).select("Date", "features"))
        scale = F.expm1("prediction") if self.log_target else F.col("prediction")
        scored = [model.transform(days).select("Date", scale.alias("prediction")) for _, _, model in self.members]
        return reduce(DataFrame.unionByName, scored).groupBy("Date").agg(F.avg("prediction").alias("prediction"))

    def rounds(self, spark: SparkSession) -> DataFrame:
        """(learner, seed, trees): the rounds that each boosted fit has used, and the trees of each forest."""
        rows = [(k, seed, model.getNumTrees) for k, seed, model in self.members]
        return spark.createDataFrame(rows, "learner int, seed int, trees int")


def fit_ensemble(
    train: DataFrame,
    learners: list[Callable[[int], Estimator]],
    size: EnsembleSize,
    target: str = "Revenue",
    log_target: bool = True,
    features: list[str] = FORECAST_FEATURES,
) -> Ensemble:
    """Every learner with every seed."""
    label = F.log1p(F.col(target)) if log_target else F.col(target)
    vectors = _with_held_out(_vectors(train, features).withColumn("label", label), size)
    ready = materialize(vectors.select("features", "label", *[f"held_{seed}" for seed in size.seeds]))

    def fit(make: Callable[[int], Estimator], seed: int) -> Model:
        return make(seed).fit(ready)

    with ThreadPoolExecutor(size.threads) as pool:
        fits = [
            (k, seed, pool.submit(inheritable_thread_target(ready.sparkSession)(fit), make, seed))
            for k, make in enumerate(learners)
            for seed in size.seeds
        ]
        return Ensemble([(k, seed, f.result()) for k, seed, f in fits], features, log_target)


def ensemble_predict(
    train: DataFrame,
    test: DataFrame,
    learners: list[Callable[[int], Estimator]],
    size: EnsembleSize,
    target: str = "Revenue",
    log_target: bool = True,
    features: list[str] = FORECAST_FEATURES,
) -> DataFrame:
    """Mean prediction per day over all learners and seeds, on the original scale."""
    return fit_ensemble(train, learners, size, target, log_target, features).predict(test)


def regime_frames(features: DataFrame, first: int, split: int, last: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Training days before and after the split, and the horizon days."""
    train = features.where(F.col("role") == "train")
    before = train.where(F.col("Year").between(first, split))
    after = train.where(F.col("Year").between(split + 1, last))
    return before, after, features.where(F.col("role") == "test")


def regime_predictions(
    features: DataFrame,
    first: int,
    split: int,
    last: int,
    size: EnsembleSize,
    columns: list[str] = FORECAST_FEATURES,
) -> DataFrame:
    """Horizon days with pred_a and pred_b, one per training regime."""
    before, after, test = regime_frames(features, first, split, last)
    learners = three_learners(size)
    a = ensemble_predict(before, test, learners, size, features=columns)
    b = ensemble_predict(after, test, learners, size, features=columns)
    return test.join(a.withColumnRenamed("prediction", "pred_a"), "Date").join(
        b.withColumnRenamed("prediction", "pred_b"), "Date"
    )


def margin_predictions(
    features: DataFrame,
    first: int,
    split: int,
    last: int,
    size: EnsembleSize,
    w: ForecastWeights = WEIGHTS,
    columns: list[str] = FORECAST_FEATURES,
) -> DataFrame:
    """(Date, margin_a, margin_b) from boosted trees on the bounded daily margin."""
    before, after, test = regime_frames(features, first, split, last)
    learners = [_boosted(size, size.depth)]
    a, b = (
        ensemble_predict(
            day_margin(part, w), test, learners, size, target="Margin", log_target=False, features=columns
        )
        for part in (before, after)
    )
    return a.withColumnRenamed("prediction", "margin_a").join(b.withColumnRenamed("prediction", "margin_b"), "Date")


# ---------------------------------------------------------------- importance


def feature_importance(
    train: DataFrame, size: EnsembleSize, features: list[str] = FORECAST_FEATURES, target: str = "Revenue"
) -> DataFrame:
    """Importance and group of every feature in one boosted model; one row per feature."""
    ready = _with_held_out(_vectors(train, features).withColumn("label", F.log1p(target)), size)
    seed = size.seeds[0]
    model = _boosted(size, size.depth)(seed).fit(materialize(ready.select("features", "label", f"held_{seed}")))
    group_of = {c: g for g, members in FEATURE_GROUPS.items() for c in members}
    rows = [(f, group_of[f], float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    spark = train.sparkSession
    return spark.createDataFrame(rows, "feature string, feature_group string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def grouped_importance(importance: DataFrame) -> DataFrame:
    return importance.groupBy("feature_group").agg(F.sum("importance").alias("importance"))
