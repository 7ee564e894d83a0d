"""Grid training with Spark ML, imputation by each series' own model, and the store of models."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.functions.blocks import position
from loomcast.functions.joins import attach, match
from loomcast.operators.impute import choose_imputer, impute_chosen, score_imputers
from loomcast.operators.regression import kfold_contiguous, time_segments
from loomcast.operators.trees import KeyedTrees, predict_trees, train_trees
from loomcast.session import settle

SEED = 28

METRICS = {"neg_mean_squared_error": "mse", "neg_mean_absolute_error": "mae"}


def forest(**params) -> RandomForestRegressor:
    """A forest that looks at all features at every split, not a random subset."""
    return RandomForestRegressor(featureSubsetStrategy="all", seed=SEED, **params)


def boosted(**params) -> GBTRegressor:
    return GBTRegressor(seed=SEED, **params)


def expand_grid(grid: dict[str, Sequence]) -> list[dict]:
    """Every combination, in the order of the given lists."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def grid_train(
    make: Callable[..., Estimator],
    grid: dict[str, Sequence],
    df: DataFrame,
    features: Sequence[str],
    target: str,
    keys: Sequence[str],
    pos: str,
    scoring: str = "neg_mean_squared_error",
    time_series: bool = False,
    scaled: bool = False,
    folds: int = 5,
    parallelism: int = 4,
) -> dict:
    """Exhaustive grid over ``folds`` folds; refits the best setting on all rows.

    Returns ``{"scores": [best], "model": fitted pipeline, "params": …, "table": …}``.
    Every fit is a Spark job over all rows of its fold; settings × folds are the
    only things the driver loops over.  Scaling is fitted on the train rows.
    A fold whose score is not a number is left out of its setting's mean.
    """
    used = position(df.select(*keys, pos, *features, target).na.drop(), keys, pos, "_j")
    # tagged once and written once: every fit below reads it
    tag = time_segments if time_series else kfold_contiguous
    parts = settle(tag(used, keys, "_j", folds, "_part"))

    def split(fold: int) -> tuple[DataFrame, DataFrame]:
        part = F.col("_part")
        if time_series:
            return parts.where(part <= fold), parts.where(part == fold + 1)
        return parts.where(part != fold), parts.where(part == fold)

    evaluator = RegressionEvaluator(labelCol=target, metricName=METRICS[scoring])

    def stages(params: dict) -> Pipeline:
        source = "_raw" if scaled else "_features"
        chain = [VectorAssembler(inputCols=list(features), outputCol=source)]
        if scaled:
            chain.append(StandardScaler(inputCol="_raw", outputCol="_features", withMean=True))
        return Pipeline(stages=[*chain, make(featuresCol="_features", labelCol=target, **params)])

    settings = expand_grid(grid)

    def score(job: tuple[int, int]) -> float:
        train, test = split(job[1])
        return -evaluator.evaluate(stages(settings[job[0]]).fit(train).transform(test))

    jobs = list(product(range(len(settings)), range(folds)))
    with ThreadPoolExecutor(parallelism) as pool:
        values = list(pool.map(score, jobs))
    known = [[v for (s, _), v in zip(jobs, values) if s == k and not math.isnan(v)] for k in range(len(settings))]
    means = [sum(own) / len(own) if own else -math.inf for own in known]
    best = max(range(len(settings)), key=lambda k: means[k])
    return {
        "scores": [means[best]],
        "model": stages(settings[best]).fit(parts),
        "params": settings[best],
        "table": list(zip(settings, means)),
    }


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_or_train(spark: SparkSession, path: str, train: Callable[[], Model]) -> Model:
    """The saved model if there is one at ``path``, else a new one, saved there."""
    try:
        spark.read.text(f"{path}/metadata").limit(1).count()
    except AnalysisException:
        model = train()
        save_model(model, path)
        return model
    return load_model(path)


def save_trees(model: KeyedTrees, path: str) -> None:
    """Write every series' trees, scores and choice under ``path``."""
    for name in ("nodes", "scores", "best"):
        getattr(model, name).write.mode("overwrite").parquet(f"{path}/{name}")


def load_trees(spark: SparkSession, path: str, keys: Sequence[str], features: Sequence[str]) -> KeyedTrees:
    return KeyedTrees(*(spark.read.parquet(f"{path}/{name}") for name in ("nodes", "scores", "best")), list(keys), list(features))


def series_digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str], settings: str) -> DataFrame:
    """(keys, digest): what a fit of ``columns`` with ``settings`` would see of each series, whatever the order of its rows."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("\0null")) for c in columns]
    halves = [F.bit_xor(F.xxhash64(F.lit(k), *cells)) for k in (1, 2)]
    whole = F.concat_ws("|", F.lit(settings), F.count(F.lit(1)).cast("string"), *[h.cast("string") for h in halves])
    return df.groupBy(*keys).agg(F.sha2(whole, 256).alias("digest"))


def stored_trees(
    path: str,
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    features: Sequence[str],
    target: str,
    **settings,
) -> KeyedTrees:
    """The trees of every series from the store at ``path``; those that are not there are fitted and added.

    A fit is known by its keys, target and the digest of its rows and settings, so changed
    data or another grid is fitted anew, series by series, and the rest is read back.
    The choice is written last and names its run: a run that died leaves nothing behind
    that could be taken for a model.
    """
    keys, features = list(keys), list(features)
    spark, parts = df.sparkSession, ("nodes", "scores", "best")
    told = json.dumps([target, features, settings], sort_keys=True, default=str)
    asked = series_digests(df, keys, [pos, *features, target], told)
    asked = settle(asked)
    try:
        best = spark.read.parquet(f"{path}/best")
        have = match(asked, best.select(*keys, "digest", "run"), [*keys, "digest"])
    except AnalysisException:
        have = None
    missing = asked if have is None else match(asked, have.select(*keys, "digest"), [*keys, "digest"], "left_anti")
    if not missing.isEmpty():
        rows = attach(df, missing.select(*keys, F.lit(True).alias("_asked")), keys, "inner").drop("_asked")
        model = train_trees(rows, keys, pos, features, target, **settings)
        run = uuid.uuid4().hex
        for name in parts:
            marked = attach(getattr(model, name), missing, keys, "inner").withColumn("run", F.lit(run))
            marked.write.mode("append").parquet(f"{path}/{name}")
        have = match(asked, spark.read.parquet(f"{path}/best").select(*keys, "digest", "run"), [*keys, "digest"])
    have = settle(have.groupBy(*keys, "digest").agg(F.min("run").alias("run")))
    found = (match(spark.read.parquet(f"{path}/{name}"), have, [*keys, "digest", "run"]).drop("digest", "run") for name in parts)
    return KeyedTrees(*found, keys, features)


def impute_by_model(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    target: str,
    easy: Sequence[str],
    grid: dict[str, Sequence] | None = None,
    kind: str = "forest",
    folds: int = 5,
    store: str | None = None,
) -> tuple[DataFrame, DataFrame, KeyedTrees]:
    """Predict a difficult column from complete easy columns, with a model for each series.

    Returns (rows with ``prediction`` where the target is missing, the score per key, the
    trees).  A series without any known target has no model: NULL predictions and score.
    Trees do not change when features are standardised, so they are not.  With ``store``,
    fits are kept there and taken again while data and settings stay the same.
    """
    keys, easy = list(keys), list(easy)
    settings = {"grid": grid, "kind": kind, "folds": folds}
    if store:
        model = stored_trees(store, df, keys, pos, easy, target, **settings)
    else:
        model = train_trees(df, keys, pos, easy, target, **settings)
    spans = df.groupBy(*keys).agg((F.max(target) - F.min(target)).alias("_span"))
    error = F.sqrt(F.abs("score")) / F.nullif(F.col("_span"), F.lit(0.0))
    score = match(spans, model.best, keys, "left").select(*keys, F.lit("model").alias("method"), error.alias("nrmse"))
    guessed = predict_trees(df, model)
    return guessed.withColumn("prediction", F.when(F.col(target).isNull(), F.col("prediction"))), score, model


def impute_difficult(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    target: str,
    easy: Sequence[str],
    grid: dict[str, Sequence] | None = None,
    n: int = 50,
    seed: int = 42,
    folds: int = 5,
    exclude: Sequence[str] = ("knn",),
) -> tuple[DataFrame, DataFrame]:
    """Fill the missing rows of a difficult column with whatever scores best per series.

    The model competes with the window methods on unrounded scores.  Returns the
    filled rows and the score table.
    """
    keys = list(keys)
    predicted, score, _ = impute_by_model(df, keys, pos, target, easy, grid, folds=folds)
    scores = score_imputers(df, keys, pos, target, n, seed).unionByName(score)
    choice = choose_imputer(scores, keys, exclude)
    filled = impute_chosen(predicted, keys, pos, target, choice, out="_filled")
    best = F.when(F.col("method") == "model", F.coalesce("prediction", "_filled")).otherwise(
        F.col("_filled")
    )
    others = [c for c in df.columns if c != target]
    return (
        filled.select(*others, F.coalesce(F.col(target), best).alias(target), "method"),
        scores,
    )


def impute_chained(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    targets: Sequence[str],
    easy: Sequence[str],
    grid: dict[str, Sequence] | None = None,
    kind: str = "boosted",
    folds: int = 5,
) -> tuple[DataFrame, DataFrame]:
    """Older variant: fill columns one after the other, the last listed first.

    Each filled column becomes a feature for the next.  Returns the filled rows and
    the report (keys, variable, nrmsd) whose range is taken after filling.
    """
    keys, ready = list(keys), list(easy)
    report = None
    for target in reversed(list(targets)):
        predicted, _, model = impute_by_model(df, keys, pos, target, ready, grid, kind, folds)
        filled = settle(
            predicted.select(
                *[c for c in df.columns if c != target],
                F.coalesce(F.col(target), F.col("prediction")).alias(target),
            )
        )
        spans = filled.groupBy(*keys).agg((F.max(target) - F.min(target)).alias("_span"))
        error = F.sqrt(F.abs("score")) / F.nullif(F.col("_span"), F.lit(0.0))
        part = match(spans, model.best, keys, "left").select(
            *keys, F.lit(target).alias("variable"), error.alias("nrmsd")
        )
        report = part if report is None else report.unionByName(part)
        df = filled
        ready.append(target)
    return df, report
