"""Supervised models on Spark ML with the penalty and weighting conventions of the toolkit."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.runtime import col, cut_lineage, kept
from ..functions.scalars import to_class
from .features import polynomial
from .metrics import class_metrics, clipped, evaluate, select_threshold, selection_score
from .profile import class_weights
from .scale import apply_scaler, fit_scaler
from .search import log_uniform, random_polynomial_search
from .split import kfold

FEATURES, WEIGHT = "features", "__weight"
TREE_MEMORY_MB = 1024  # more memory per pass, fewer passes over the rows per tree level

# Weight of the validation and the cross-validation score in the tree search.
VALID_SHARE, CV_SHARE, CV_BRIER = 0.55, 0.45, 0.5


def assemble(df: DataFrame, cols: list[str], out: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


def add_weights(df: DataFrame, label: str, weights: dict | str | None) -> DataFrame:
    """Weight column: ``"balanced"``, a weight per class, or 1."""
    if weights is None:
        return df.withColumn(WEIGHT, F.lit(1.0))
    if weights == "balanced":
        weights = {r["label"]: r["weight"] for r in class_weights(df, label).collect()}  # one row per class
    out = F.lit(1.0)
    for c, w in weights.items():
        out = F.when(col(label) == F.lit(c), F.lit(float(w))).otherwise(out)
    return df.withColumn(WEIGHT, out)


def _fit(estimator, train: DataFrame, cols: list[str], label: str, weights, passes: int = 2) -> PipelineModel:
    """Fit on assembled and weighted rows; the result takes plain columns. Rows are kept when the
    estimator passes over them more than once."""
    stage = VectorAssembler(inputCols=list(cols), outputCol=FEATURES)
    rows = train.where(col(label).isNotNull()).select(*[col(c) for c in dict.fromkeys([*cols, label])])
    ready = stage.transform(add_weights(rows, label, weights)).select(FEATURES, label, WEIGHT)
    if estimator.hasParam("weightCol") and weights is not None:
        estimator = estimator.copy({estimator.weightCol: WEIGHT})
    if passes == 1:
        return PipelineModel([stage, estimator.fit(ready)])
    with kept(ready) as held:
        return PipelineModel([stage, estimator.fit(held)])


def tree_classifier(train: DataFrame, cols: list[str], label: str, depth: int = 10, criterion: str = "gini",
                    weights="balanced", min_leaf: int = 1, min_gain: float = 0.0, seed: int = 42) -> PipelineModel:
    return _fit(DecisionTreeClassifier(labelCol=label, featuresCol=FEATURES, maxDepth=depth, impurity=criterion,
                                       minInstancesPerNode=min_leaf, minInfoGain=min_gain, seed=seed), train, cols, label, weights)


def logistic(train: DataFrame, cols: list[str], label: str, c: float = 1.0, weights=None, max_iter: int = 1000,
             multinomial: bool = False) -> PipelineModel:
    """L2 with strength 1 / (c * sum of weights); the intercept is not penalised."""
    ready = add_weights(train.where(col(label).isNotNull()), label, weights)
    total = ready.agg(F.sum(WEIGHT)).first()[0]
    return _fit(LogisticRegression(labelCol=label, featuresCol=FEATURES, regParam=1.0 / (c * total), elasticNetParam=0.0,
                                   standardization=False, maxIter=max_iter, tol=1e-10,
                                   family="multinomial" if multinomial else "auto"), train, cols, label, weights)


def linear(train: DataFrame, cols: list[str], label: str) -> PipelineModel:
    return _fit(LinearRegression(labelCol=label, featuresCol=FEATURES, regParam=0.0, solver="normal"), train, cols, label, None, 1)


def ridge(train: DataFrame, cols: list[str], label: str, alpha: float = 1.0) -> PipelineModel:
    """Sum of squares plus alpha times the squared coefficients. Spark scales the penalty by the
    label's standard deviation, hence the factor."""
    n, spread = train.where(col(label).isNotNull()).agg(F.count(F.lit(1)), F.stddev_pop(col(label))).first()
    return _fit(LinearRegression(labelCol=label, featuresCol=FEATURES, regParam=alpha * spread / n, elasticNetParam=0.0,
                                 standardization=False, solver="normal"), train, cols, label, None, 1)


def lasso(train: DataFrame, cols: list[str], label: str, alpha: float = 1.0) -> PipelineModel:
    return _fit(LinearRegression(labelCol=label, featuresCol=FEATURES, regParam=alpha, elasticNetParam=1.0,
                                 standardization=False, solver="l-bfgs", maxIter=1000, tol=1e-9), train, cols, label, None)


def polynomial_regression(train: DataFrame, cols: list[str], label: str, degree: int, alpha: float, kind: str = "ridge"):
    """Polynomial terms, standard scaling, then ridge or lasso. Returns a function from rows to predictions, and the model."""
    wide, names = polynomial(train, cols, degree)
    scaler = fit_scaler(wide, names, "standard")
    model = {"ridge": ridge, "lasso": lasso}[kind](apply_scaler(wide, scaler), names, label, alpha)

    def predict(rows: DataFrame) -> DataFrame:
        return model.transform(apply_scaler(polynomial(rows, cols, degree)[0], scaler)).drop(FEATURES)
    return predict, model


def polynomial_logistic(train: DataFrame, cols: list[str], label: str, degree: int, c: float):
    wide, names = polynomial(train, cols, degree)
    scaler = fit_scaler(wide, names, "standard")
    model = logistic(apply_scaler(wide, scaler), names, label, c)

    def predict(rows: DataFrame) -> DataFrame:
        return model.transform(apply_scaler(polynomial(rows, cols, degree)[0], scaler)).drop(FEATURES)
    return predict, model


def forest(train: DataFrame, cols: list[str], label: str, trees: int = 100, depth: int = 10, min_leaf: int = 1,
           regression: bool = False, weights=None, seed: int = 42) -> PipelineModel:
    kind = RandomForestRegressor if regression else RandomForestClassifier
    return _fit(kind(labelCol=label, featuresCol=FEATURES, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed,
                     cacheNodeIds=True, maxMemoryInMB=TREE_MEMORY_MB), train, cols, label, weights)


def gbt(train: DataFrame, cols: list[str], label: str, trees: int = 100, depth: int = 3, rate: float = 0.1,
        regression: bool = False, min_leaf: int = 1, seed: int = 42) -> PipelineModel:
    """Boosted trees; more than two classes are handled one against the rest."""
    if regression:
        est = GBTRegressor(labelCol=label, featuresCol=FEATURES, maxIter=trees, maxDepth=depth, stepSize=rate,
                           minInstancesPerNode=min_leaf, seed=seed)
        return _fit(est, train, cols, label, None)
    est = GBTClassifier(labelCol=label, featuresCol=FEATURES, maxIter=trees, maxDepth=depth, stepSize=rate,
                        minInstancesPerNode=min_leaf, seed=seed)
    classes = train.agg(F.count_distinct(col(label))).first()[0]
    if classes > 2:
        est = OneVsRest(classifier=est, labelCol=label, featuresCol=FEATURES)
    return _fit(est, train, cols, label, None)


def tree_regressor(train: DataFrame, cols: list[str], label: str, depth: int = 5, min_leaf: int = 1, seed: int = 42) -> PipelineModel:
    return _fit(DecisionTreeRegressor(labelCol=label, featuresCol=FEATURES, maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed),
                train, cols, label, None)


def predict_class(model: Model, df: DataFrame, low: int = 0, high: int = 2) -> DataFrame:
    """Regression prediction as a class: nearest integer inside [low, high]."""
    return model.transform(df).withColumn("pred_class", to_class(F.col("prediction"), low, high))


def score(model: Model, df: DataFrame, label: str, threshold: float = 0.5, key: list[str] = ()) -> DataFrame:
    """(y, prob, pred) of a binary classifier, probability clipped away from 0 and 1."""
    out = model.transform(df).withColumn("prob", clipped(vector_to_array("probability")[1]))
    return out.select(*key, col(label).cast("int").alias("y"), "prob", (F.col("prob") >= threshold).cast("int").alias("pred"))


def importances(model: PipelineModel, cols: list[str], spark, k: int | None = None) -> DataFrame:
    values = model.stages[-1].featureImportances.toArray()
    rows = [(c, float(v)) for c, v in zip(cols, values)]
    out = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return out.limit(k) if k else out


def coefficients(model: PipelineModel, cols: list[str], spark) -> DataFrame:
    """(class, feature, value) with the intercept as its own row; class is null for one set of coefficients."""
    last = model.stages[-1]
    if hasattr(last, "coefficientMatrix") and last.numClasses > 2:
        m, b = last.coefficientMatrix.toArray(), last.interceptVector.toArray()
        rows = [(i, c, float(v)) for i in range(len(b)) for c, v in [*zip(cols, m[i]), ("intercept", b[i])]]
    else:
        rows = [(None, c, float(v)) for c, v in [*zip(cols, last.coefficients.toArray()), ("intercept", last.intercept)]]
    return spark.createDataFrame(rows, "class int, feature string, value double")


# search ---------------------------------------------------------------------------------

def grid(estimator, options: dict[str, list]) -> list:
    b = ParamGridBuilder()
    for name, values in options.items():
        b = b.addGrid(estimator.getParam(name), values)
    return b.build()


def cross_validate(estimator, maps: list, train: DataFrame, cols: list[str], label: str, key: list[str], folds: int = 3,
                   regression: bool = False, stratify: str | None = None, parallelism: int = 8, seed: int = 42):
    """Cross-validated search over explicit parameter maps on assembled, cached rows.

    Folds are stratified and depend on the key only. Returns (model, table of mean scores).
    """
    rows = train.where(col(label).isNotNull())
    if stratify is None and regression:
        rows = rows.withColumn("__all", F.lit(0))
    folded = kfold(rows, key, stratify or ("__all" if regression else label), folds, seed)
    ready = assemble(folded, cols).select(FEATURES, col(label).cast("double").alias("label"), "fold")
    metric = (RegressionEvaluator(labelCol="label", metricName="r2") if regression
              else MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy"))
    est = estimator.copy({estimator.labelCol: "label", estimator.featuresCol: FEATURES})
    with kept(ready) as held:
        model = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=metric, numFolds=folds, foldCol="fold",
                               parallelism=parallelism, seed=seed).fit(held)
    table = [(", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda x: x[0].name)), float(s), float(d))
             for m, s, d in zip(maps, model.avgMetrics, model.stdMetrics)]
    return model.bestModel, train.sparkSession.createDataFrame(table, "params string, mean_score double, std_score double") \
        .orderBy(F.desc("mean_score"), "params")


def grid_search(estimator, options: dict[str, list], train: DataFrame, cols: list[str], label: str, key: list[str], **more):
    return cross_validate(estimator, grid(estimator, options), train, cols, label, key, **more)


def random_search(train: DataFrame, cols: list[str], label: str, key: list[str], draws: int = 200, degrees: tuple[int, int] = (2, 9),
                  penalty: tuple[float, float] = (1e-5, 1e3), kind: str = "ridge", folds: int = 4, seed: int = 42) -> DataFrame:
    """Seeded draws of degree and log-uniform penalty for polynomial ridge, lasso or logistic models.

    Polynomial terms and scaling are learned inside each fold.
    """
    rng = random.Random(seed)
    drawn = [(rng.randint(*degrees), log_uniform(rng, *penalty)) for _ in range(draws)]
    rows = train.where(col(label).isNotNull())
    folded = kfold(rows.withColumn("__all", F.lit(0)) if kind != "logistic" else rows, key, "__all" if kind != "logistic" else label, folds, seed)
    return random_polynomial_search(folded, cols, label, drawn, kind, folds)


def out_of_fold(train: DataFrame, cols: list[str], label: str, key: list[str], folds: int = 4, seed: int = 42, **tree) -> DataFrame:
    """(y, prob) of every training row from the model that did not see it."""
    with kept(kfold(train, key, label, folds, seed)) as folded:
        parts = []
        for f in range(folds):
            model = tree_classifier(folded.where(F.col("fold") != f), cols, label, **tree)
            parts.append(score(model, folded.where(F.col("fold") == f), label))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return cut_lineage(out.select("y", "prob"))


def search_tree(train: DataFrame, valid: DataFrame, cols: list[str], label: str, key: list[str], options: dict[str, list],
                folds: int = 4, seed: int = 42, parallelism: int = 4) -> DataFrame:
    """Every combination of tree options, scored 0.55 on the validation rows and 0.45 out of fold,
    each at its own best threshold; best first. Options are those of ``tree_classifier``."""
    from itertools import product
    names = list(options)
    # a fold needs a row of the rarest class
    least = train.groupBy(col(label)).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n")).first()[0]
    folds = max(2, min(folds, least))

    def one(values):
        tree = dict(zip(names, values))
        oof = out_of_fold(train, cols, label, key, folds, seed, **tree)
        cv = selection_score(evaluate(oof, select_threshold(oof)).withColumn("brier", F.lit(CV_BRIER))).first()
        held = cut_lineage(score(tree_classifier(train, cols, label, **tree), valid, label))
        t = select_threshold(held)
        v = selection_score(evaluate(held, t)).first()
        total = VALID_SHARE * v["selection_score"] + CV_SHARE * cv["selection_score"]
        return (str(tree), t, float(total), cv["f1"], cv["balanced_accuracy"], v["f1"], v["balanced_accuracy"], v["specificity"],
                v["pr_auc"], v["roc_auc"])
    with ThreadPoolExecutor(parallelism) as pool:
        rows = list(pool.map(one, product(*options.values())))
    schema = ("params string, threshold double, selection_score double, cv_f1 double, cv_balanced_accuracy double, f1 double, "
              "balanced_accuracy double, specificity double, pr_auc double, roc_auc double")
    return train.sparkSession.createDataFrame(rows, schema).orderBy(*[F.desc_nulls_last(c) for c in (
        "selection_score", "balanced_accuracy", "specificity", "f1", "pr_auc", "roc_auc")])


def cv_report(fit, df: DataFrame, label: str, key: list[str], folds: int = 5, seed: int = 42) -> DataFrame:
    """Mean and std (n) over folds of accuracy and macro F1. ``fit`` takes training rows and gives a
    function from rows to rows with ``prediction``."""
    rows = []
    with kept(kfold(df, key, label, folds, seed)) as folded:
        for f in range(folds):
            predict = fit(folded.where(F.col("fold") != f))
            out = predict(folded.where(F.col("fold") == f)).select(col(label).cast("double").alias("y"), F.col("prediction").alias("pred"))
            m = class_metrics(out, "macro").first()
            rows.append((f, m["accuracy"], m["f1"]))
    table = df.sparkSession.createDataFrame(rows, "fold int, accuracy double, f1 double")
    return table.agg(F.avg("accuracy").alias("accuracy_mean"), F.stddev_pop("accuracy").alias("accuracy_std"),
                     F.avg("f1").alias("f1_mean"), F.stddev_pop("f1").alias("f1_std"), F.count(F.lit(1)).alias("n_folds"))


def compare_labels(metrics: DataFrame, values: list[str], before: str = "original", after: str = "corrected") -> DataFrame:
    """Metric per model with original and corrected labels, and the difference (columns model, labels, metrics)."""
    wide = metrics.groupBy("model").pivot("labels", [before, after]).agg(*[F.first(v).alias(v) for v in values])
    return wide.select("model", *[c for v in values for c in (
        F.col(f"{before}_{v}") if len(values) > 1 else F.col(before).alias(f"{before}_{v}"),
        F.col(f"{after}_{v}") if len(values) > 1 else F.col(after).alias(f"{after}_{v}"),
        ((F.col(f"{after}_{v}") if len(values) > 1 else F.col(after))
         - (F.col(f"{before}_{v}") if len(values) > 1 else F.col(before))).alias(f"delta_{v}"))])
