"""Supervised metrics from a scored table (y, pred[, prob]). Everything is an aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import in_order, previous, running_sum
from ..functions.quantiles import quantiles
from ..functions.runtime import bounded, col, cut_lineage, rows_from
from ..functions.scalars import PROB_FLOOR, clip

# Thresholds always tried, score quantiles tried, weights of the selection score.
BASE_THRESHOLDS = [0.15, 0.20, 0.25, 0.30, 0.40, 0.50, 0.60, 0.70]
FULL_LOW, FULL_HIGH, FULL_CUTS = 0.2, 0.8, 25
SCORE_QUANTILES = [0.20, 0.40, 0.60, 0.80]
SELECTION_WEIGHTS = {"f1": 0.28, "balanced_accuracy": 0.22, "specificity": 0.18, "pr_auc": 0.17, "roc_auc": 0.10}
BRIER_WEIGHT = 0.05

# Labels of a block of the confusion grid, blocks that one shuffled row stands for, rows of the result per task.
LABELS_PER_BLOCK, BLOCKS_PER_GROUP, CELLS_PER_TASK, MAX_GRID_TASKS = 256, 256, 2_000_000, 20_000


def _ratio(a, b) -> Column:
    return F.try_divide(a, b)


def _ratio0(a, b) -> Column:
    """Ratio with zero for an empty denominator."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def outcome_counts(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """(actual, predicted, n) for the pairs that occur."""
    return (df.where(col(y).isNotNull() & col(pred).isNotNull())
            .groupBy(col(y).alias("actual"), col(pred).alias("predicted")).agg(F.count(F.lit(1)).alias("n")))


def class_report(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """precision, recall, f1 and support per class; an empty denominator counts as 0."""
    counts = outcome_counts(df, y, pred)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("long")
    sides = counts.select(F.explode(F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("support"), zero.alias("predicted"), hit.cast("long").alias("tp")),
        F.struct(F.col("predicted").alias("label"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("tp")),
    )).alias("s")).select("s.*")
    per = sides.groupBy("label").agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    return per.select("label", _ratio0(F.col("tp"), F.col("predicted")).alias("precision"),
                      _ratio0(F.col("tp"), F.col("support")).alias("recall"),
                      _ratio0(2.0 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"), "support", "tp")


def class_metrics(df: DataFrame, average: str = "macro", y: str = "y", pred: str = "pred") -> DataFrame:
    """accuracy, precision, recall, f1; ``macro`` or ``weighted`` by support."""
    per = class_report(df, y, pred)
    if average == "macro":
        mean = lambda c: F.avg(c)
    else:
        mean = lambda c: F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    return per.agg(_ratio(F.sum("tp"), F.sum("support")).alias("accuracy"), mean("precision").alias("precision"),
                   mean("recall").alias("recall"), mean("f1").alias("f1"))


def confusion(df: DataFrame, labels: list | DataFrame, y: str = "y", pred: str = "pred", block: int | None = None) -> DataFrame:
    """Zero-filled (actual, predicted, n) over a label list or a one-column table of labels.

    The rows are counted once. The grid of labels is the result and never shuffled, nor are its rows of blocks: a label meets groups of
    ``BLOCKS_PER_GROUP`` blocks, takes the counts of a group by a join, and only then the group's blocks of ``block`` labels are written out.
    """
    size = block or LABELS_PER_BLOCK
    if isinstance(labels, DataFrame):
        one = cut_lineage(labels.select(F.col(labels.columns[0]).alias("actual")))
        n = one.count()
    else:
        kind, n = df.select(col(y)).schema[0].dataType, len(labels)
        one = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(x).cast(kind) for x in labels])).alias("actual"))
    blocks = max(1, -(-n // size))
    groups = -(-blocks // BLOCKS_PER_GROUP)
    tasks = min(MAX_GRID_TASKS, max(1, n * n // CELLS_PER_TASK))

    def block_of(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")

    def group_of(c: str) -> Column:
        return F.floor(F.col(c) / BLOCKS_PER_GROUP).cast("int")
    of_block = (one.groupBy(block_of("actual").alias("__block")).agg(F.collect_list(F.struct("actual")).alias("__labels"))
                .select("__block", F.col("__labels.actual").alias("__labels")))
    wanted = one.select(F.col("actual").alias("__label")).distinct()
    # both sides of the join lie in as many parts as the grid has tasks, so neither is dealt out again
    counts = (outcome_counts(df, y, pred).join(wanted, F.col("predicted") == F.col("__label"))
              .select(F.col("actual").alias("__a"), block_of("__label").alias("__b"), "__label", "n").withColumn("__g", group_of("__b"))
              .repartition(tasks, "__a", "__g")
              .groupBy("__a", "__g", "__b").agg(F.map_from_entries(F.collect_list(F.struct("__label", "n"))).alias("__n"))
              .groupBy("__a", "__g").agg(F.map_from_entries(F.collect_list(F.struct("__b", "__n"))).alias("__of")))
    light = one.withColumn("__group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).repartition(tasks, "actual", "__group")
    first = F.col("__group") * BLOCKS_PER_GROUP
    cells = (light.join(counts, (F.col("actual") == F.col("__a")) & (F.col("__group") == F.col("__g")), "left")
             .select("actual", "__of", F.explode(F.sequence(first, F.least(first + BLOCKS_PER_GROUP, F.lit(blocks)) - 1)).alias("__block"))
             .select("actual", "__block", F.try_element_at("__of", F.col("__block")).alias("__n"))
             .join(bounded(of_block), "__block").select("actual", "__n", F.explode("__labels").alias("predicted")))
    return cells.select("actual", "predicted", F.coalesce(F.try_element_at("__n", F.col("predicted")), F.lit(0)).cast("long").alias("n"))


def _rates(tp: Column, fp: Column, pos: Column, neg: Column) -> dict[str, Column]:
    fn, tn = pos - tp, neg - fp
    recall, specificity = _ratio(tp, pos), _ratio(tn, neg)
    balanced = F.coalesce((recall + specificity) / 2, recall, specificity)
    return {
        "tn": tn, "fp": fp, "fn": fn, "tp": tp, "accuracy": _ratio(tp + tn, pos + neg),
        "balanced_accuracy": balanced, "precision": _ratio0(tp, tp + fp), "recall": F.coalesce(recall, F.lit(0.0)),
        "specificity": specificity, "npv": _ratio(tn, tn + fn), "f1": _ratio0(2.0 * tp, 2 * tp + fp + fn),
    }


def clipped(prob: Column) -> Column:
    return clip(prob, F.lit(PROB_FLOOR), F.lit(1 - PROB_FLOOR))


def binary_metrics(df: DataFrame, threshold: float = 0.5, y: str = "y", prob: str = "prob") -> DataFrame:
    """Counts, rates, prevalence, Brier score and log loss at one threshold: one row, one pass."""
    p, t = clipped(col(prob)), col(y)
    agg = df.agg(
        F.count(F.lit(1)).alias("n"), F.avg(t.cast("double")).alias("prevalence"),
        F.count_if((p >= threshold) & (t == 1)).alias("__tp"), F.count_if((p >= threshold) & (t == 0)).alias("__fp"),
        F.count_if(t == 1).alias("__pos"), F.count_if(t == 0).alias("__neg"),
        F.avg((p - t) * (p - t)).alias("brier"),
        F.avg(-F.when(t == 1, F.ln(p)).otherwise(F.ln(1 - p))).alias("log_loss"))
    rates = _rates(F.col("__tp"), F.col("__fp"), F.col("__pos"), F.col("__neg"))
    return agg.select("n", "prevalence", F.lit(float(threshold)).alias("threshold"),
                      *[e.alias(n) for n, e in rates.items()], "brier", "log_loss")


def brier(df: DataFrame, y: str = "y", prob: str = "prob") -> DataFrame:
    return binary_metrics(df, 0.5, y, prob).select("brier")


def log_loss(df: DataFrame, y: str = "y", prob: str = "prob") -> DataFrame:
    return binary_metrics(df, 0.5, y, prob).select("log_loss")


def score_curve(df: DataFrame, y: str = "y", prob: str = "prob", rows_per_task: int | None = None) -> DataFrame:
    """Per distinct score, highest first: positives and negatives at it and at or above it."""
    counts = df.groupBy((-col(prob)).alias("__down")).agg(
        F.count_if(col(y) == 1).alias("pos"), F.count_if(col(y) == 0).alias("neg"))
    cum = in_order(cut_lineage(counts), [], ["__down"], {"tp": running_sum(F.col("pos")), "fp": running_sum(F.col("neg"))}, rows_per_task)
    return cum.select((-F.col("__down")).alias("score"), "pos", "neg", "tp", "fp")


def ranking_metrics(df: DataFrame, y: str = "y", prob: str = "prob", rows_per_task: int | None = None) -> DataFrame:
    """ROC AUC (ties count half, null with one class) and step-wise average precision, in one pass."""
    curve = score_curve(df, y, prob, rows_per_task)
    wins = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    steps = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    pos, neg = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    return curve.agg(_ratio(wins, pos * neg).alias("roc_auc"), _ratio0(steps, pos).alias("pr_auc"))


def roc_auc(df: DataFrame, y: str = "y", prob: str = "prob") -> DataFrame:
    return ranking_metrics(df, y, prob).select("roc_auc")


def average_precision(df: DataFrame, y: str = "y", prob: str = "prob") -> DataFrame:
    return ranking_metrics(df, y, prob).select("pr_auc")


def evaluate(df: DataFrame, threshold: float = 0.5, y: str = "y", prob: str = "prob") -> DataFrame:
    """All binary metrics in one row."""
    rank = ranking_metrics(df.select(col(y), clipped(col(prob)).alias(prob)), y, prob)
    both = rank.select(F.struct("roc_auc", "pr_auc")).scalar()  # one subquery for the two
    return (binary_metrics(df, threshold, y, prob).withColumn("__rank", both)
            .select("*", "__rank.roc_auc", "__rank.pr_auc").drop("__rank"))


def threshold_candidates(df: DataFrame, prob: str = "prob", rows_per_task: int | None = None, full: bool = False) -> DataFrame:
    """Fixed list, 0.5, rounded score quantiles, and midpoints between neighbouring distinct scores. ``full``: even cuts for the
    fixed list and every rounded score for the quantiles."""
    if full:
        fixed = sorted({0.5, *[round(FULL_LOW + i * (FULL_HIGH - FULL_LOW) / (FULL_CUTS - 1), 9) for i in range(FULL_CUTS)]})
    else:
        q = quantiles(df, [prob], SCORE_QUANTILES)[prob] or []
        fixed = sorted({0.5, *BASE_THRESHOLDS, *[round(v, 3) for v in q]})
    scores = df.select(F.bround(col(prob), 6).alias("s")).where(F.col("s").isNotNull()).distinct()
    mids = in_order(cut_lineage(scores), [], ["s"], {"p": previous(F.col("s"))}, rows_per_task).where("p is not null") \
        .select(F.bround((F.col("s") + F.col("p")) / 2, 6).alias("threshold"))
    given = df.sparkSession.createDataFrame([(float(v),) for v in fixed], "threshold double")
    if full:
        given = given.union(df.select(F.bround(col(prob), 3)).where(col(prob).isNotNull()).distinct())
    return mids.union(given).distinct()


def sweep(df: DataFrame, candidates: DataFrame, y: str = "y", prob: str = "prob",
          rows_per_task: int | None = None) -> DataFrame:
    """Metrics at every candidate threshold.

    Candidates are merged into the ordered scores and read their counts off the running
    totals, so the cost is one sort and not rows times candidates.
    """
    p = clipped(col(prob))
    scores = df.select((-p).alias("d"), (col(y) == 1).cast("long").alias("pos"), (col(y) == 0).cast("long").alias("neg"),
                       F.lit(0).alias("c"))
    marks = candidates.select((-F.col("threshold")).alias("d"), F.lit(0).cast("long").alias("pos"),
                              F.lit(0).cast("long").alias("neg"), F.lit(1).alias("c"))
    points = scores.unionByName(marks).groupBy("d").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.max("c").alias("c"))
    cum = in_order(cut_lineage(points), [], ["d"], {"__tp": running_sum(F.col("pos")), "__fp": running_sum(F.col("neg"))}, rows_per_task)
    totals = df.agg(F.struct(F.count_if(col(y) == 1).alias("p"), F.count_if(col(y) == 0).alias("n"))).scalar()
    rows = cum.where("c = 1").withColumn("__all", totals).withColumns({"__pos": F.col("__all.p"), "__neg": F.col("__all.n")})
    rates = _rates(F.col("__tp"), F.col("__fp"), F.col("__pos"), F.col("__neg"))
    return rows.select((-F.col("d")).alias("threshold"), *[e.alias(n) for n, e in rates.items()])


def threshold_table(df: DataFrame, y: str = "y", prob: str = "prob", rows_per_task: int | None = None, full: bool = False) -> DataFrame:
    """All candidates, best first."""
    table = sweep(df, threshold_candidates(df, prob, rows_per_task, full), y, prob, rows_per_task)
    return table.orderBy(*[F.desc_nulls_last(c) for c in ("balanced_accuracy", "f1", "specificity", "precision", "recall")], "threshold")


def select_threshold(df: DataFrame, y: str = "y", prob: str = "prob", full: bool = False) -> float:
    return threshold_table(df, y, prob, full=full).select("threshold").first()[0]


def selection_score(metrics: DataFrame) -> DataFrame:
    """Weighted score of a metrics table; an undefined metric counts as 0."""
    score = sum((w * F.coalesce(F.col(m), F.lit(0.0)) for m, w in SELECTION_WEIGHTS.items()), F.lit(0.0))
    return metrics.withColumn("selection_score", score + BRIER_WEIGHT * (1 - clip(F.col("brier"), F.lit(0.0), F.lit(1.0))))


def regression_metrics(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """MAE, RMSE, R2."""
    a, b = col(y).cast("double"), col(pred).cast("double")
    sse, n = F.sum((a - b) * (a - b)), F.count(a)
    return df.where(a.isNotNull() & b.isNotNull()).agg(
        F.avg(F.abs(a - b)).alias("mae"), F.sqrt(sse / n).alias("rmse"),
        (1 - F.try_divide(sse, F.var_pop(a) * n)).alias("r2"))


def best_model(metrics: DataFrame, by: str, name: str = "model") -> DataFrame:
    return metrics.orderBy(F.desc_nulls_last(by), name).limit(1)


def comparison(metrics: DataFrame, value: str = "accuracy", model: str = "model", split: str = "split") -> DataFrame:
    """One row per model with the value on train, valid and test and the train-test gap."""
    wide = metrics.groupBy(model).pivot(split, ["train", "valid", "test"]).agg(F.first(value))
    return wide.withColumn("gap", F.col("train") - F.col("test"))
