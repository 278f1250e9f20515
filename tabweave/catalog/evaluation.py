"""Decisions, losses, metrics, precision-recall curve and threshold search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.catalog.registry import query
from tabweave.catalog.views import (
    ITEM_SQL,
    PAIRS_SQL,
    QUALITY_SQL,
    TOXIC_SQL,
    item_scores,
    price_pairs,
    quality_scores,
    table,
    toxic_scores,
)
from tabweave.functions.scores import decide
from tabweave.operators.curve import precision_recall_curve
from tabweave.operators.losses import batch_squared_error, epoch_loss
from tabweave.operators.metrics import (
    binary_metrics,
    classification_report,
    confusion,
    confusion_array,
    regression_metrics,
)
from tabweave.operators.threshold import best_threshold
from tabweave.plans.evaluate import evaluate

CUTOFF = 0.45

DECIDED_SQL = f"{ITEM_SQL}, decided AS (SELECT y, CAST(p1 >= {CUTOFF}::DOUBLE AS INT) AS pred FROM scores)"

RATES_SQL = """counts AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE y = pred) AS hits,
         count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp,
         count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn
  FROM decided
), rates AS (
  SELECT *, round(hits / n, 6) AS accuracy, coalesce(round(tp / nullif(tp + fp, 0), 6), 0) AS precision,
         coalesce(round(tp / nullif(tp + fn, 0), 6), 0) AS recall,
         coalesce(round(2 * tp / nullif(2 * tp + fp + fn, 0), 6), 0) AS f1
  FROM counts
)"""

FIT_SQL = """fit AS (
  SELECT avg(abs(y - pred)) AS mae, avg((y - pred) * (y - pred)) AS mse,
         1 - sum((y - pred) * (y - pred)) / sum((y - mean) * (y - mean)) AS r2
  FROM pairs, (SELECT avg(y) AS mean FROM pairs)
)"""

CURVE_SQL = """points AS (
  SELECT p1 AS threshold, count(*) FILTER (WHERE y = 1) AS pos, count(*) AS n FROM scores GROUP BY p1
), summed AS (
  SELECT threshold, CAST(sum(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp,
         CAST(sum(n) OVER (ORDER BY threshold DESC) AS BIGINT) AS predicted_pos,
         CAST(sum(pos) OVER () AS BIGINT) AS positives
  FROM points
), curve AS (
  SELECT threshold, tp / predicted_pos AS precision, tp / positives AS recall, tp, predicted_pos FROM summed
)"""

BEST_F1_SQL = """SELECT threshold, round(precision, 6) AS precision, round(recall, 6) AS recall FROM curve
ORDER BY CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END DESC, threshold
LIMIT 1"""


def decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_scores(spark, sf_dir).select("y", decide(F.col("p1"), CUTOFF).alias("pred"))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(
    "m5_decision",
    f"""WITH {QUALITY_SQL}
SELECT doc_id, y, p, CAST(p >= 0.5::DOUBLE AND NOT isnan(p) AS INT) AS pred
FROM (SELECT *, CASE WHEN doc_id % 61 = 9 THEN 'NaN'::DOUBLE ELSE p1 END AS p FROM scores)""",
)
def m5_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some scores are no number, as those of a network that diverged."""
    p = F.when(F.col("doc_id") % 61 == 9, F.lit(float("nan"))).otherwise(F.col("p1")).alias("p")
    return quality_scores(spark, sf_dir).select("doc_id", "y", p).withColumn("pred", decide(F.col("p")))


@query(
    "m6_batch_squared_error",
    f"WITH {PAIRS_SQL} SELECT batch, count(*) AS n, round(avg((y - pred) * (y - pred)), 2) AS loss FROM pairs GROUP BY batch",
)
def m6_batch_squared_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_squared_error(price_pairs(spark, sf_dir), "batch", "pred", "y").withColumn("loss", F.round("loss", 2))


@query(
    "m7_epoch_loss",
    f"""WITH {PAIRS_SQL}, batches AS (SELECT batch, avg((y - pred) * (y - pred)) AS loss FROM pairs GROUP BY batch)
SELECT round(avg(loss), 2) AS loss FROM batches""",
)
def m7_epoch_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = batch_squared_error(price_pairs(spark, sf_dir), "batch", "pred", "y")
    return epoch_loss(batches).withColumn("loss", F.round("loss", 2))


@query(
    "e1_confusion",
    f"""WITH {DECIDED_SQL}
SELECT CAST(a AS INT) AS actual, CAST(p AS INT) AS predicted, count(y) AS n
FROM generate_series(0, 1) AS s(a) CROSS JOIN generate_series(0, 1) AS t(p)
LEFT JOIN decided ON y = a AND pred = p GROUP BY a, p""",
)
def e1_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion(decided(spark, sf_dir), "y", "pred")


@query(
    "e1_confusion_array",
    f"""WITH {DECIDED_SQL}, {RATES_SQL}
SELECT '[[' || tn || ',' || fp || '],[' || fn || ',' || tp || ']]' AS confusion_matrix FROM counts""",
)
def e1_confusion_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix of the run record, as JSON text."""
    array = confusion_array(confusion(decided(spark, sf_dir), "y", "pred"))
    return array.select(F.to_json("confusion_matrix").alias("confusion_matrix"))


@query(
    "e2_to_e5_binary_metrics",
    f"WITH {DECIDED_SQL}, {RATES_SQL} SELECT accuracy, precision, recall, f1 FROM rates",
)
def e2_to_e5_binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(binary_metrics(decided(spark, sf_dir), "y", "pred"), "accuracy", "precision", "recall", "f1")


def report_sql(source: str, classes: int) -> str:
    return f"""WITH {source}, grid AS (
  SELECT c AS label, count(*) FILTER (WHERE y = c AND pred = c) AS tp, count(*) FILTER (WHERE pred = c) AS guessed,
         count(*) FILTER (WHERE y = c) AS support
  FROM generate_series(0, {classes - 1}) AS s(c) CROSS JOIN decided GROUP BY c
), classes AS (
  SELECT label, tp, support, coalesce(tp / nullif(guessed, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall,
         coalesce(2 * tp / nullif(guessed + support, 0), 0) AS f1
  FROM grid
), lines AS (
  SELECT CAST(label AS VARCHAR) AS label, precision, recall, f1, support FROM classes
  UNION ALL
  SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM classes
  UNION ALL
  SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM classes
  UNION ALL
  SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
         sum(f1 * support) / sum(support), sum(support) FROM classes
)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM lines"""


@query("e6_classification_report", report_sql(DECIDED_SQL, 2))
def e6_classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = confusion(decided(spark, sf_dir), "y", "pred")
    return rounded(classification_report(grid), "precision", "recall", "f1")


# Four classes of line items: what they are, and a guess that never names the last one.
CLASSES_SQL = """decided AS (
  SELECT CAST(l_linenumber % 4 AS INT) AS y, CAST((l_linenumber + l_orderkey) % 3 AS INT) AS pred FROM lineitem
)"""


def classed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_linenumber") % 4).cast("int").alias("y"),
        ((F.col("l_linenumber") + F.col("l_orderkey")) % 3).cast("int").alias("pred"),
    )


@query(
    "e1_confusion_classes",
    f"""WITH {CLASSES_SQL}
SELECT CAST(a AS INT) AS actual, CAST(p AS INT) AS predicted, count(y) AS n
FROM generate_series(0, 3) AS s(a) CROSS JOIN generate_series(0, 3) AS t(p)
LEFT JOIN decided ON y = a AND pred = p GROUP BY a, p""",
)
def e1_confusion_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion(classed(spark, sf_dir), "y", "pred", 4)


@query("e6_report_classes", report_sql(CLASSES_SQL, 4))
def e6_report_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = confusion(classed(spark, sf_dir), "y", "pred", 4)
    return rounded(classification_report(grid, 4), "precision", "recall", "f1")


@query(
    "e7_to_e10_regression_metrics",
    f"""WITH {PAIRS_SQL}, {FIT_SQL}
SELECT round(mae, 4) AS mae, round(mse, 2) AS mse, round(sqrt(mse), 4) AS rmse, round(r2, 6) AS r2 FROM fit""",
)
def e7_to_e10_regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = regression_metrics(price_pairs(spark, sf_dir), "y", "pred")
    digits = {"mae": 4, "mse": 2, "rmse": 4, "r2": 6}
    return fit.select(*[F.round(c, d).alias(c) for c, d in digits.items()])


@query(
    "e11_precision_recall_curve",
    f"""WITH {ITEM_SQL}, {CURVE_SQL}
SELECT threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, tp, predicted_pos FROM curve""",
)
def e11_precision_recall_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = precision_recall_curve(item_scores(spark, sf_dir), "y", "p1", rows_per_slice=20_000)
    return rounded(curve, "precision", "recall")


@query("e12_best_f1", f"WITH {TOXIC_SQL}, {CURVE_SQL} {BEST_F1_SQL}")
def e12_best_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(best_threshold(toxic_scores(spark, sf_dir), "y", "p1"), "precision", "recall")


@query("e12_best_f1_quality", f"WITH {QUALITY_SQL}, {CURVE_SQL} {BEST_F1_SQL}")
def e12_best_f1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(best_threshold(quality_scores(spark, sf_dir), "y", "p1"), "precision", "recall")


def min_recall_sql(source: str, least: float) -> str:
    return f"""WITH {source}, {CURVE_SQL}, choice AS (
  SELECT *, recall >= {least} AS enough FROM curve
)
SELECT threshold, round(precision, 6) AS precision, round(recall, 6) AS recall FROM choice
ORDER BY enough DESC, CASE WHEN enough THEN precision ELSE recall END DESC, threshold LIMIT 1"""


@query("e13_best_min_recall", min_recall_sql(TOXIC_SQL, 0.5))
def e13_best_min_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = best_threshold(toxic_scores(spark, sf_dir), "y", "p1", "min_recall", 0.5)
    return rounded(best, "precision", "recall")


@query("e13_unreachable_recall", min_recall_sql(ITEM_SQL, 1.5))
def e13_unreachable_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No point reaches the minimum: the first point of highest recall is taken."""
    best = best_threshold(item_scores(spark, sf_dir), "y", "p1", "min_recall", 1.5)
    return rounded(best, "precision", "recall")


@query(
    "evaluate_classification",
    f"""WITH {DECIDED_SQL}, {RATES_SQL}
SELECT 'classification' AS mode, {CUTOFF}::DOUBLE AS threshold, accuracy, precision, recall, f1,
       '[[' || tn || ',' || fp || '],[' || fn || ',' || tp || ']]' AS confusion_matrix
FROM rates""",
)
def evaluate_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = evaluate(item_scores(spark, sf_dir), "y", "p1", "classification", CUTOFF)
    return rounded(record, "accuracy", "precision", "recall", "f1").withColumn(
        "confusion_matrix", F.to_json("confusion_matrix")
    )


@query(
    "evaluate_regression",
    f"""WITH {PAIRS_SQL}, {FIT_SQL}
SELECT 'regression' AS mode, round(mae, 4) AS mae, round(mse, 2) AS mse, round(sqrt(mse), 4) AS rmse, round(r2, 6) AS r2
FROM fit""",
)
def evaluate_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = {"mae": 4, "mse": 2, "rmse": 4, "r2": 6}
    record = evaluate(price_pairs(spark, sf_dir), "y", "pred", "regression")
    return record.select("mode", *[F.round(c, d).alias(c) for c, d in digits.items()])
