"""Scoring, losses, training, stopping and baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.catalog.evaluation import BEST_F1_SQL, CURVE_SQL
from tabweave.catalog.preparation import divided, prepared
from tabweave.catalog.registry import query
from tabweave.catalog.views import (
    CLEAN_SQL,
    EPOCHS_SQL,
    LOANS_SQL,
    VECTORS_SQL,
    epochs,
    formula_params,
    loans,
    split_sql,
    vectors,
)
from tabweave.functions.scores import regression_value
from tabweave.operators.baselines import BASELINE_NAME, coefficient_table, fit_linear, fit_logistic, score_linear
from tabweave.operators.batches import batches_by_size
from tabweave.operators.classes import class_weights, weight_list
from tabweave.operators.encode import assemble, keep_members, label_rows
from tabweave.operators.losses import batch_cross_entropy, weighted_cross_entropy
from tabweave.operators.network import INITIAL_SPREAD, MLPSpec, init_params
from tabweave.operators.runs import comparison
from tabweave.operators.scoring import score_mlp, validate_epoch, with_predictions
from tabweave.operators.stopping import early_stop
from tabweave.operators.training import parameter_table, place_rows, train_epoch
from tabweave.plans.evaluate import evaluate, evaluate_network, metrics_record, network_threshold
from tabweave.plans.fit import fit, load_best
from tabweave.sources.history import load_history, log_run
from tabweave.sources.schemas import LOAN_KEPT_STATUS
from tabweave.storage import scratch_path

WIDTH = 64
PLAIN = MLPSpec(WIDTH, 8, 2, "relu")
DEEP = MLPSpec(WIDTH, [8, 4], 2, "leaky_relu", norm="layer")
RUNNING = MLPSpec(WIDTH, 8, 2, "tanh", norm="batch")
SINGLE = MLPSpec(WIDTH, [6, 3], 1, "tanh")
WEIGHTS = [0.75, 1.5]


def _linear_sql(rows: int, columns: int, source: str, first: bool) -> str:
    weight = "((i * 31 + j * 17) % 11 - 5) / 10" if first else "((i * 7 + j * 5) % 9 - 4) / 10"
    bias = "(i % 3 - 1) / 10" if first else "0"
    return (
        f"list_transform(range(0, {rows}), lambda i: {bias} + list_sum(list_transform(range(0, {columns}), "
        f"lambda j: CAST({source}[j + 1] AS DOUBLE) * {weight})))"
    )


def mlp_sql(spec: MLPSpec) -> str:
    """The forward pass with formula weights over ``vectors``, ending in a list column ``logits``."""
    steps, source = [VECTORS_SQL], "vectors"
    hidden = spec.hidden_sizes
    x = "features"
    for layer, (rows, columns) in enumerate(spec.linear_shapes):
        last = layer == len(hidden)
        z = "logits" if last else f"z{layer}"
        steps.append(f"l{layer} AS (SELECT *, {_linear_sql(rows, columns, x, layer == 0)} AS {z} FROM {source})")
        source = f"l{layer}"
        if last:
            break
        if spec.norm == "layer":
            steps.append(
                f"m{layer} AS (SELECT *, list_avg({z}) AS mean{layer}, "
                f"list_avg(list_transform({z}, lambda v: v * v)) - list_avg({z}) * list_avg({z}) AS var{layer} FROM {source})"
            )
            steps.append(
                f"n{layer} AS (SELECT *, list_transform(range(0, {rows}), lambda i: ({z}[i + 1] - mean{layer}) "
                f"/ sqrt(var{layer} + 1e-5) * (1 + (i % 4) / 8) + (i % 4) / 8) AS s{layer} FROM m{layer})"
            )
            source, z = f"n{layer}", f"s{layer}"
        elif spec.norm == "batch":
            steps.append(
                f"n{layer} AS (SELECT *, list_transform(range(0, {rows}), lambda i: ({z}[i + 1] - 0.1 - (i % 4) / 8) "
                f"/ sqrt(0.5 + (i % 4) / 8 + 1e-5) * (1 + (i % 4) / 8) + (i % 4) / 8) AS s{layer} FROM {source})"
            )
            source, z = f"n{layer}", f"s{layer}"
        activation = {
            "relu": "CASE WHEN v > 0 THEN v ELSE 0 END",
            "leaky_relu": "CASE WHEN v > 0 THEN v ELSE 0.01 * v END",
            "tanh": "(exp(2 * v) - 1) / (exp(2 * v) + 1)",
        }[spec.activation]
        steps.append(f"a{layer} AS (SELECT *, list_transform({z}, lambda v: {activation}) AS h{layer} FROM {source})")
        source, x = f"a{layer}", f"h{layer}"
    return ",\n".join(steps) + f",\nscored AS (SELECT vec_id, label, batch, logits FROM {source})"


PAIR_SQL = "logits[1] AS l0, logits[2] AS l1"
PROBABILITY = "exp(l1 - greatest(l0, l1)) / (exp(l0 - greatest(l0, l1)) + exp(l1 - greatest(l0, l1)))"
NLL = "greatest(l0, l1) + ln(exp(l0 - greatest(l0, l1)) + exp(l1 - greatest(l0, l1))) - CASE WHEN label = 1 THEN l1 ELSE l0 END"
WEIGHT_SQL = f"CASE WHEN label = 1 THEN {WEIGHTS[1]}::DOUBLE ELSE {WEIGHTS[0]}::DOUBLE END"
# Adding 0 turns a rounded -0 into 0.
LOGITS_SQL = "SELECT vec_id, round(logits[1], 6) + 0.0 AS logit_0, round(logits[2], 6) + 0.0 AS logit_1 FROM scored"


def logit_columns(scored: DataFrame) -> DataFrame:
    return scored.select(
        "vec_id",
        (F.round(F.element_at("logits", 1), 6) + 0.0).alias("logit_0"),
        (F.round(F.element_at("logits", 2), 6) + 0.0).alias("logit_1"),
    )


def scored_vectors(spark: SparkSession, sf_dir: str, spec: MLPSpec = PLAIN) -> DataFrame:
    return score_mlp(vectors(spark, sf_dir), formula_params(spec), spec)


@query("m1_score_mlp", f"WITH {mlp_sql(PLAIN)} {LOGITS_SQL}")
def m1_score_mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logit_columns(scored_vectors(spark, sf_dir))


@query("m1_score_layer_norm", f"WITH {mlp_sql(DEEP)} {LOGITS_SQL}")
def m1_score_layer_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two hidden layers, leaky activation, layer norm."""
    return logit_columns(scored_vectors(spark, sf_dir, DEEP))


@query("m1_score_batch_norm", f"WITH {mlp_sql(RUNNING)} {LOGITS_SQL}")
def m1_score_batch_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch norm with its running statistics, tanh."""
    return logit_columns(scored_vectors(spark, sf_dir, RUNNING))


@query(
    "m2_m3_probability_and_class",
    f"""WITH {mlp_sql(PLAIN)}, pair AS (SELECT vec_id, {PAIR_SQL} FROM scored)
SELECT vec_id, round({PROBABILITY}, 6) AS p1, CASE WHEN l1 > l0 THEN 1 ELSE 0 END AS pred FROM pair""",
)
def m2_m3_probability_and_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = with_predictions(scored_vectors(spark, sf_dir))
    return predicted.select("vec_id", F.round("p1", 6).alias("p1"), "pred")


@query("m4_regression_value", f"WITH {mlp_sql(SINGLE)} SELECT vec_id, round(logits[1], 6) + 0.0 AS pred FROM scored")
def m4_regression_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_vectors(spark, sf_dir, SINGLE)
    return scored.select("vec_id", (F.round(regression_value(F.col("logits")), 6) + 0.0).alias("pred"))


@query(
    "m6_batch_cross_entropy",
    f"""WITH {mlp_sql(PLAIN)}, pair AS (SELECT label, batch, {PAIR_SQL} FROM scored)
SELECT batch, count(*) AS n, round(sum({WEIGHT_SQL} * ({NLL})) / sum({WEIGHT_SQL}), 6) AS loss FROM pair GROUP BY batch""",
)
def m6_batch_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    losses = batch_cross_entropy(scored_vectors(spark, sf_dir), "batch", "logits", "label", WEIGHTS)
    return losses.withColumn("loss", F.round("loss", 6))


@query(
    "m10_validation_epoch",
    f"""WITH {mlp_sql(PLAIN)}, pair AS (SELECT label, batch, {PAIR_SQL} FROM scored), judged AS (
  SELECT *, CASE WHEN l1 > l0 THEN 1 ELSE 0 END AS pred, {WEIGHT_SQL} AS w, {NLL} AS nll FROM pair
), batches AS (SELECT sum(w * nll) / sum(w) AS loss FROM judged GROUP BY batch), counts AS (
  SELECT count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp,
         count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn FROM judged
)
SELECT (SELECT round(avg(loss), 6) FROM batches) AS loss, coalesce(round(tp / nullif(tp + fp, 0), 6), 0) AS precision,
       coalesce(round(tp / nullif(tp + fn, 0), 6), 0) AS recall,
       coalesce(round(2 * tp / nullif(2 * tp + fp + fn, 0), 6), 0) AS f1
FROM counts""",
)
def m10_validation_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate_epoch(vectors(spark, sf_dir), formula_params(PLAIN), PLAIN, weights=WEIGHTS)
    return checked.select(*[F.round(c, 6).alias(c) for c in checked.columns])


@query(
    "m10_validation_regression",
    f"""WITH {mlp_sql(SINGLE)}, judged AS (SELECT batch, label - logits[1] AS e, label FROM scored),
batches AS (SELECT avg(e * e) AS loss FROM judged GROUP BY batch)
SELECT (SELECT round(avg(loss), 6) FROM batches) AS loss, round(avg(abs(e)), 6) AS mae, round(avg(e * e), 6) AS mse,
       round(sqrt(avg(e * e)), 6) AS rmse, round(1 - sum(e * e) / sum((label - mean) * (label - mean)), 6) AS r2
FROM judged, (SELECT avg(label) AS mean FROM judged)""",
)
def m10_validation_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate_epoch(vectors(spark, sf_dir), formula_params(SINGLE), SINGLE, "regression")
    return checked.select(*[F.round(c, 6).alias(c) for c in checked.columns])


BY_SIZE = 48
BY_SIZE_SQL = mlp_sql(PLAIN).replace(
    "CAST(floor(vec_id / 64.0) AS BIGINT) AS batch",
    f"(row_number() OVER (ORDER BY md5('42:' || CAST(vec_id AS VARCHAR))) - 1) // {BY_SIZE} AS batch",
)


@query(
    "m10_batches_by_size",
    f"""WITH {BY_SIZE_SQL}, pair AS (SELECT label, batch, {PAIR_SQL} FROM scored), judged AS (
  SELECT *, {WEIGHT_SQL} AS w, {NLL} AS nll FROM pair
)
SELECT batch, count(*) AS rows, round(sum(w * nll) / sum(w), 6) AS loss FROM judged GROUP BY batch""",
)
def m10_batches_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation losses of batches that hold a given number of rows."""
    rows = batches_by_size(vectors(spark, sf_dir).drop("batch"), BY_SIZE, key=["vec_id"])
    scored = score_mlp(rows, formula_params(PLAIN), PLAIN, keep=["batch", "label"])
    loss = weighted_cross_entropy("logits", "label", WEIGHTS, 2)
    return scored.groupBy("batch").agg(F.count(F.lit(1)).alias("rows"), F.round(loss, 6).alias("loss"))


# Parallel buckets of the training runs here. Trained weights depend on it, so it is a setting, not a guess from the data.
BUCKETS = 4

LOGISTIC = MLPSpec(WIDTH, [], 2)
STEP_SIZE, BATCH_SIZE = 0.5, 32

# A network without hidden layers is trained for one epoch: per bucket the mini-batches are walked
# through in order, each step moving the weights (two rows of 64) and the two biases.
TRAIN_SQL = f"""WITH RECURSIVE {VECTORS_SQL}, keyed AS (
  SELECT *, md5('42:' || CAST(vec_id AS VARCHAR)) AS place, md5('42:1:' || CAST(vec_id AS VARCHAR)) AS turn,
         {BUCKETS} AS buckets
  FROM vectors
), bucketed AS (
  SELECT *, CAST('0x' || substr(place, 1, 15) AS BIGINT) % buckets AS bucket FROM keyed
), numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY bucket ORDER BY turn) - 1) // {BATCH_SIZE} AS step FROM bucketed
), batches AS (
  SELECT bucket, step, list(features ORDER BY turn) AS xs, list(label ORDER BY turn) AS ys,
         list(CASE WHEN label = 1 THEN {WEIGHTS[1]}::DOUBLE ELSE {WEIGHTS[0]}::DOUBLE END ORDER BY turn) AS ws,
         count(*) AS n
  FROM numbered GROUP BY bucket, step
), start AS (
  SELECT list_transform(range(0, {2 * WIDTH}), lambda k: CAST((((k // {WIDTH}) * 31 + (k % {WIDTH}) * 17) % 11 - 5) / 10 AS DOUBLE)) AS w,
         list_transform(range(0, 2), lambda i: CAST((i % 3 - 1) / 10 AS DOUBLE)) AS b
), walk AS (
  SELECT bucket, CAST(-1 AS BIGINT) AS step, w, b, CAST(0 AS DOUBLE) AS loss, CAST(0 AS DOUBLE) AS norm
  FROM (SELECT DISTINCT bucket FROM batches), start
  UNION ALL
  SELECT bucket, step,
         list_transform(range(0, {2 * WIDTH}), lambda k: w[k + 1] - {STEP_SIZE} * (2 * (k // {WIDTH}) - 1) * gw[k % {WIDTH} + 1]) AS w,
         list_transform(range(0, 2), lambda i: b[i + 1] - {STEP_SIZE} * (2 * i - 1) * gb) AS b, loss,
         sqrt(2 * gb * gb + 2 * list_sum(list_transform(gw, lambda g: g * g))) AS norm
  FROM (
    SELECT bucket, step, w, b, list_sum(ds) AS gb,
           list_transform(range(1, {WIDTH + 1}), lambda m: list_sum(list_transform(range(1, n + 1), lambda r: ds[r] * xs[r][m]))) AS gw,
           list_sum(list_transform(range(1, n + 1), lambda r: ws[r] * -ln(CASE WHEN ys[r] = 1 THEN ps[r] ELSE 1 - ps[r] END))) / list_sum(ws) AS loss
    FROM (
      SELECT *, list_transform(range(1, n + 1), lambda r: ws[r] * (ps[r] - ys[r]) / list_sum(ws)) AS ds
      FROM (
        SELECT batches.*, walk.w, walk.b, list_transform(xs, lambda x: 1 / (1 + exp(
                 walk.b[1] - walk.b[2] + list_sum(list_transform(range(1, {WIDTH + 1}), lambda m: (walk.w[m] - walk.w[m + {WIDTH}]) * x[m])))) ) AS ps
        FROM walk JOIN batches ON batches.bucket = walk.bucket AND batches.step = walk.step + 1
      )
    )
  )
), ends AS (
  SELECT walk.bucket, w, b, rows FROM walk
  JOIN (SELECT bucket, max(step) AS step, CAST(sum(n) AS BIGINT) AS rows FROM batches GROUP BY bucket) AS l
    ON walk.bucket = l.bucket AND walk.step = l.step
)"""
TRAINED_SQL = f"""{TRAIN_SQL}, weights AS (
  SELECT 'weight' AS kind, k AS position, sum(w[k + 1] * rows) / sum(rows) AS value FROM ends, range(0, {2 * WIDTH}) AS s(k) GROUP BY k
  UNION ALL
  SELECT 'bias', k, sum(b[k + 1] * rows) / sum(rows) FROM ends, range(0, 2) AS s(k) GROUP BY k
)
SELECT kind, CAST(position AS INT) AS position, round(value, 6) + 0.0 AS value FROM weights"""


def logistic_epoch(spark: SparkSession, sf_dir: str):
    rows = vectors(spark, sf_dir).select("vec_id", "features", "label")
    data = place_rows(rows, BUCKETS, key="vec_id")
    return train_epoch(
        data, formula_params(LOGISTIC), LOGISTIC, lr=STEP_SIZE, batch_size=BATCH_SIZE, weights=WEIGHTS
    )


def parameter_rows(table: DataFrame) -> DataFrame:
    """One row per weight."""
    values = table.select("kind", F.posexplode("values").alias("position", "value"))
    return values.withColumn("value", F.round("value", 6) + 0.0)


@query("m9_train_epoch", TRAINED_SQL)
def m9_train_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights after one epoch in parallel buckets, averaged."""
    params, _ = logistic_epoch(spark, sf_dir)
    return parameter_rows(parameter_table(spark, params, LOGISTIC))


@query(
    "m8_gradient_norm",
    f"""{TRAIN_SQL}
SELECT round(avg(loss), 6) AS loss, round(avg(norm), 6) AS grad_norm FROM walk WHERE step >= 0""",
)
def m8_gradient_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean batch loss and mean gradient norm of the same epoch."""
    _, metrics = logistic_epoch(spark, sf_dir)
    return spark.createDataFrame([(metrics["loss"], metrics["grad_norm"])], "loss double, grad_norm double").select(
        *[F.round(c, 6).alias(c) for c in ("loss", "grad_norm")]
    )


@query("m9_fit_network")
def m9_fit_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prepared loans, a small network with layer norm and dropout, early stopping: losses per epoch."""
    ready = prepared(spark, sf_dir)
    train = assemble(ready.part("train"), keep=["order_key"])
    validation = batches_by_size(assemble(ready.part("val"), keep=["order_key"]), 64, key=["order_key"])
    rows = ready.sizes().filter("split = 'train'").first()
    spec = MLPSpec(rows["width"] - 3, [8], 2, "relu", 0.1, "layer")
    weights = weight_list(class_weights(ready.part("train"), "classification_target"))
    data = place_rows(train, BUCKETS)
    result = fit(data, validation, init_params(spec), spec, epochs=3, lr=0.05, weights=weights, patience=2)
    return result.epochs(spark, "loans")


@query("m11_initial_weights")
def m11_initial_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spread of the outputs over all embeddings under each kind of start weights."""
    rows = vectors(spark, sf_dir)
    width = rows.agg(F.max(F.size("features"))).first()[0]
    spec = MLPSpec(width, [32, 16], 1)
    out = None
    for init in INITIAL_SPREAD:
        scored = score_mlp(rows, init_params(spec, init), spec, keep=["vec_id"])
        value = regression_value(F.col("logits"))
        line = scored.agg(
            F.lit(init).alias("init"), F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")
        )
        out = line if out is None else out.unionByName(line)
    return out


# Spread of the start weights by kind, as it follows from a layer's width and height.
SPREAD_SQL = """CASE init WHEN 'kaiming_normal' THEN sqrt(2.0 / fan_in) WHEN 'kaiming_uniform' THEN sqrt(6.0 / fan_in)
  WHEN 'xavier_normal' THEN sqrt(2.0 / (fan_in + fan_out)) WHEN 'xavier_uniform' THEN sqrt(6.0 / (fan_in + fan_out))
  ELSE sqrt(1.0 / fan_in) END"""


@query(
    "m11_weight_spread",
    f"""WITH widths AS (SELECT CAST(max(len(embedding)) AS INT) AS width FROM embeddings), layers AS (
  SELECT 0 AS layer, width AS fan_in, 32 AS fan_out FROM widths UNION ALL SELECT 1, 32, 16 UNION ALL SELECT 2, 16, 1
), kinds(init) AS (VALUES ('kaiming_normal'), ('kaiming_uniform'), ('xavier_normal'), ('xavier_uniform'), ('default'))
SELECT init, layer, fan_in, fan_out, round({SPREAD_SQL}, 6) AS spread, true AS spread_met, true AS zero_biases FROM kinds, layers""",
)
def m11_weight_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per kind of start weights and layer: its size, the spread asked for, and whether the weights have it.

    Normal weights meet it if their deviation is within five standard errors, uniform ones if none lies
    beyond the bound and their deviation is that of the bound.
    """
    width = vectors(spark, sf_dir).agg(F.max(F.size("features"))).first()[0]
    spec = MLPSpec(width, [32, 16], 1)
    tables = None
    for init in INITIAL_SPREAD:
        table = parameter_table(spark, init_params(spec, init), spec).withColumn("init", F.lit(init))
        tables = table if tables is None else tables.unionByName(table)
    zero = F.forall("values", lambda v: v == 0)
    biases = tables.filter("kind = 'bias'").select("init", "layer", zero.alias("zero_biases"))
    fan_in, fan_out = F.element_at("shape", 2), F.element_at("shape", 1)
    weights = tables.filter("kind = 'weight'").select(
        "init", "layer", fan_in.alias("fan_in"), fan_out.alias("fan_out"), F.expr(SPREAD_SQL.replace("fan_in", "shape[1]").replace("fan_out", "shape[0]")).alias("spread"), F.explode("values").alias("w")
    )
    normal = F.col("init").endswith("normal")
    by_layer = weights.groupBy("init", "layer", "fan_in", "fan_out", "spread").agg(
        F.stddev_pop("w").alias("deviation"), F.max(F.abs("w")).alias("largest"), F.count("w").alias("n")
    )
    asked = F.when(normal, F.col("spread")).otherwise(F.col("spread") / F.sqrt(F.lit(3.0)))
    near = F.abs(F.col("deviation") / asked - 1) <= 5 / F.sqrt(2.0 * F.col("n"))
    met = near & (normal | (F.col("largest") <= F.col("spread")))
    return by_layer.join(biases, ["init", "layer"]).select(
        "init", "layer", "fan_in", "fan_out", F.round("spread", 6).alias("spread"), met.alias("spread_met"), "zero_biases"
    )


def stop_sql(patience: int, min_delta: float) -> str:
    better = f"(best IS NULL OR NOT (e.val_loss > best - {min_delta}::DOUBLE))"
    return f"""WITH RECURSIVE {EPOCHS_SQL}, walk AS (
  SELECT run_id, 0 AS epoch, CAST(NULL AS INT) AS best_epoch, CAST(NULL AS DOUBLE) AS best, 0 AS waited
  FROM (SELECT DISTINCT run_id FROM epochs)
  UNION ALL
  SELECT w.run_id, e.epoch, CASE WHEN {better} THEN e.epoch ELSE best_epoch END,
         CASE WHEN {better} THEN e.val_loss ELSE best END, CASE WHEN {better} THEN 0 ELSE waited + 1 END
  FROM walk AS w JOIN epochs AS e ON e.run_id IS NOT DISTINCT FROM w.run_id AND e.epoch = w.epoch + 1
  WHERE waited < {patience}
), ends AS (SELECT run_id, max(epoch) AS epoch FROM walk GROUP BY run_id)
SELECT w.run_id, CASE WHEN waited >= {patience} THEN w.epoch END AS stop_epoch, best_epoch, best AS best_loss
FROM walk AS w JOIN ends ON w.run_id IS NOT DISTINCT FROM ends.run_id AND w.epoch = ends.epoch"""


@query("m12_early_stop", stop_sql(5, 0.0))
def m12_early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return early_stop(epochs(spark, sf_dir))


@query("m12_early_stop_margin", stop_sql(12, 2.5))
def m12_early_stop_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return early_stop(epochs(spark, sf_dir), patience=12, min_delta=2.5)


@query("m12_early_stop_sliced", stop_sql(5, 0.0))
def m12_early_stop_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same runs, the one without an id included, looked at in slices of a few epochs."""
    return early_stop(epochs(spark, sf_dir), epochs_per_slice=7)


@query("m12_early_stop_margin_sliced", stop_sql(12, 2.5))
def m12_early_stop_margin_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return early_stop(epochs(spark, sf_dir), patience=12, min_delta=2.5, epochs_per_slice=9)


# The same network trained for some epochs in parallel buckets, on four fifths of the rows; the others check it. The step
# is so large that the losses go up and down and an epoch in the middle is the best one. The walk has one line per
# step, with a list of the buckets' weights; the first step of an epoch starts from their average by rows.
FIT_EPOCHS, FIT_STEP_SIZE, HELD_OUT = 5, 2.0, 5


def _mean_of_buckets(name: str, width: int) -> str:
    share = f"list_sum(list_transform(range(1, {BUCKETS + 1}), lambda j: {name}[j][k + 1] * rows[j]))"
    return f"list_transform(range(0, {width}), lambda k: {share} / list_sum(rows))"


FIT_SQL = f"""WITH RECURSIVE {VECTORS_SQL}, dealt AS (
  SELECT *, CAST('0x' || substr(md5('42:' || CAST(vec_id AS VARCHAR)), 1, 15) AS BIGINT) % {BUCKETS} AS bucket
  FROM vectors WHERE vec_id % {HELD_OUT} <> 0
), counted AS (
  SELECT bucket, count(*) AS n FROM dealt GROUP BY bucket
), sizes AS (
  SELECT list(n ORDER BY bucket) AS rows, CAST(ceil(max(n) / {BATCH_SIZE}.0) AS BIGINT) AS per_epoch FROM counted
), turns AS (
  SELECT dealt.*, e, row_number() OVER (PARTITION BY e, bucket ORDER BY md5('42:' || e || ':' || CAST(vec_id AS VARCHAR))) - 1 AS place
  FROM dealt, range(1, {FIT_EPOCHS + 1}) AS s(e)
), batches AS (
  SELECT (e - 1) * per_epoch + place // {BATCH_SIZE} AS step, bucket, list(features ORDER BY place) AS xs, list(label ORDER BY place) AS ys,
         list(CASE WHEN label = 1 THEN {WEIGHTS[1]}::DOUBLE ELSE {WEIGHTS[0]}::DOUBLE END ORDER BY place) AS ws, count(*) AS n
  FROM turns, sizes GROUP BY 1, 2
), slots AS (
  SELECT step, bucket, rows, step % per_epoch = 0 AS opens, coalesce(n, 0) AS n, coalesce(xs, []) AS xs, coalesce(ys, []) AS ys, coalesce(ws, []) AS ws
  FROM (SELECT step, bucket, rows, per_epoch FROM sizes, counted, (SELECT unnest(range(0, {FIT_EPOCHS} * per_epoch)) AS step FROM sizes))
  LEFT JOIN batches USING (step, bucket)
), start AS (
  SELECT list_transform(range(0, {2 * WIDTH}), lambda k: CAST((((k // {WIDTH}) * 31 + (k % {WIDTH}) * 17) % 11 - 5) / 10 AS DOUBLE)) AS w,
         list_transform(range(0, 2), lambda i: CAST((i % 3 - 1) / 10 AS DOUBLE)) AS b
), walk AS (
  SELECT CAST(-1 AS BIGINT) AS step, list_transform(range(0, {BUCKETS}), lambda j: w) AS all_w, list_transform(range(0, {BUCKETS}), lambda j: b) AS all_b,
         [CAST(NULL AS DOUBLE)] AS losses
  FROM start
  UNION ALL
  SELECT step, list(w ORDER BY bucket) AS all_w, list(b ORDER BY bucket) AS all_b, list(loss ORDER BY bucket) FILTER (WHERE n > 0) AS losses
  FROM (
    SELECT step, bucket, n,
           list_transform(range(0, {2 * WIDTH}), lambda k: w[k + 1] - {FIT_STEP_SIZE} * (2 * (k // {WIDTH}) - 1) * coalesce(gw[k % {WIDTH} + 1], 0)) AS w,
           list_transform(range(0, 2), lambda i: b[i + 1] - {FIT_STEP_SIZE} * (2 * i - 1) * coalesce(gb, 0)) AS b, loss
    FROM (
      SELECT step, bucket, n, w, b, list_sum(ds) AS gb,
             list_transform(range(1, {WIDTH + 1}), lambda m: list_sum(list_transform(range(1, n + 1), lambda r: ds[r] * xs[r][m]))) AS gw,
             list_sum(list_transform(range(1, n + 1), lambda r: ws[r] * -ln(CASE WHEN ys[r] = 1 THEN ps[r] ELSE 1 - ps[r] END))) / list_sum(ws) AS loss
      FROM (
        SELECT *, list_transform(range(1, n + 1), lambda r: ws[r] * (ps[r] - ys[r]) / list_sum(ws)) AS ds
        FROM (
          SELECT *, list_transform(xs, lambda x: 1 / (1 + exp(
                   b[1] - b[2] + list_sum(list_transform(range(1, {WIDTH + 1}), lambda m: (w[m] - w[m + {WIDTH}]) * x[m])))) ) AS ps
          FROM (
            SELECT slots.*, CASE WHEN opens THEN {_mean_of_buckets("all_w", 2 * WIDTH)} ELSE all_w[bucket + 1] END AS w,
                   CASE WHEN opens THEN {_mean_of_buckets("all_b", 2)} ELSE all_b[bucket + 1] END AS b
            FROM walk JOIN slots ON slots.step = walk.step + 1
          )
        )
      )
    )
  )
  GROUP BY step
), ended AS (
  SELECT CAST((step + 1) // per_epoch AS INT) AS epoch, {_mean_of_buckets("all_w", 2 * WIDTH)} AS w, {_mean_of_buckets("all_b", 2)} AS b
  FROM walk, sizes WHERE step >= 0 AND (step + 1) % per_epoch = 0
), trained AS (
  SELECT epoch, avg(loss) AS train_loss
  FROM (SELECT CAST(step // per_epoch + 1 AS INT) AS epoch, unnest(losses) AS loss FROM walk, sizes WHERE step >= 0) GROUP BY epoch
), pair AS (
  SELECT epoch, batch, label, b[1] + list_sum(list_transform(range(1, {WIDTH + 1}), lambda m: w[m] * features[m])) AS l0,
         b[2] + list_sum(list_transform(range(1, {WIDTH + 1}), lambda m: w[m + {WIDTH}] * features[m])) AS l1
  FROM ended, vectors WHERE vec_id % {HELD_OUT} = 0
), checked AS (
  SELECT epoch, avg(loss) AS val_loss
  FROM (SELECT epoch, batch, sum({WEIGHT_SQL} * ({NLL})) / sum({WEIGHT_SQL}) AS loss FROM pair GROUP BY epoch, batch)
  GROUP BY epoch
), best AS (SELECT epoch FROM checked ORDER BY val_loss, epoch DESC LIMIT 1)"""
BEST_SQL = f"""{FIT_SQL}
SELECT 'weight' AS kind, CAST(k AS INT) AS position, round(w[k + 1], 4) + 0.0 AS value FROM ended JOIN best USING (epoch), range(0, {2 * WIDTH}) AS s(k)
UNION ALL
SELECT 'bias', CAST(k AS INT), round(b[k + 1], 4) + 0.0 FROM ended JOIN best USING (epoch), range(0, 2) AS s(k)
UNION ALL
SELECT 'best_epoch', 0, CAST(epoch AS DOUBLE) FROM best"""


def fitted_logistic(spark: SparkSession, sf_dir: str, **options):
    """A whole fit in parallel buckets; its validation rows play no part in training."""
    rows = vectors(spark, sf_dir)
    held_out = F.col("vec_id") % HELD_OUT == 0
    return fit(
        place_rows(rows.where(~held_out), BUCKETS, key="vec_id"), rows.where(held_out), formula_params(LOGISTIC), LOGISTIC,
        **({"epochs": FIT_EPOCHS} | options), lr=FIT_STEP_SIZE, batch_size=BATCH_SIZE, weights=WEIGHTS, patience=FIT_EPOCHS,
    )


@query(
    "m9_fit_losses",
    f"""{FIT_SQL}
SELECT 'vectors' AS run_id, epoch, round(train_loss, 5) AS train_loss, round(val_loss, 5) AS val_loss FROM trained JOIN checked USING (epoch)""",
)
def m9_fit_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Losses of a whole fit from weights by formula."""
    losses = fitted_logistic(spark, sf_dir).epochs(spark, "vectors")
    return losses.select("run_id", "epoch", *[F.round(c, 5).alias(c) for c in ("train_loss", "val_loss")])


def best_rows(spark: SparkSession, params, epoch: int) -> DataFrame:
    values = parameter_table(spark, params, LOGISTIC).select("kind", F.posexplode("values").alias("position", "value"))
    last = spark.createDataFrame([("best_epoch", 0, float(epoch))], "kind string, position int, value double")
    return values.withColumn("value", F.round("value", 4) + 0.0).unionByName(last)


@query("m13_best_weights", BEST_SQL)
def m13_best_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train with validation, keep the best epoch's parameters, read them back."""
    path = scratch_path(spark, "best-weights")
    result = fitted_logistic(spark, sf_dir, best_path=path)
    return best_rows(spark, load_best(spark, path, result.best_epoch), result.best_epoch)


@query("m13_resumed_fit", BEST_SQL)
def m13_resumed_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fit in two calls: the second one goes on behind the epochs that the first one committed."""
    path = scratch_path(spark, "resumed-fit")
    fitted_logistic(spark, sf_dir, resume_path=path, epochs=2)
    result = fitted_logistic(spark, sf_dir, resume_path=path)
    return best_rows(spark, result.params, result.best_epoch)


JUDGED_SQL = f"""{mlp_sql(PLAIN)}, scores AS (
  SELECT label AS y, {PROBABILITY} AS p1 FROM (SELECT label, {PAIR_SQL} FROM scored)
)"""


@query(
    "evaluate_network",
    f"""WITH {JUDGED_SQL}, counts AS (
  SELECT count(*) FILTER (WHERE y = 1 AND p1 >= 0.52) AS tp, count(*) FILTER (WHERE y = 0 AND p1 >= 0.52) AS fp,
         count(*) FILTER (WHERE y = 1 AND p1 < 0.52) AS fn, count(*) FILTER (WHERE y = 0 AND p1 < 0.52) AS tn
  FROM scores
)
SELECT 'classification' AS mode, 0.52::DOUBLE AS threshold, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
       coalesce(round(tp / nullif(tp + fp, 0), 6), 0) AS precision, coalesce(round(tp / nullif(tp + fn, 0), 6), 0) AS recall,
       coalesce(round(2 * tp / nullif(2 * tp + fp + fn, 0), 6), 0) AS f1,
       '[[' || tn || ',' || fp || '],[' || fn || ',' || tp || ']]' AS confusion_matrix
FROM counts""",
)
def network_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blind evaluation of a network: scoring, decision and metrics in one job."""
    record = evaluate_network(vectors(spark, sf_dir), formula_params(PLAIN), PLAIN, threshold=0.52)
    return record.withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "f1")}).withColumn(
        "confusion_matrix", F.to_json("confusion_matrix")
    )


@query(
    "network_threshold",
    f"""WITH {JUDGED_SQL}, {CURVE_SQL}, best AS ({BEST_F1_SQL})
SELECT round(threshold, 6) AS threshold, precision, recall FROM best""",
)
def threshold_of_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = network_threshold(vectors(spark, sf_dir), formula_params(PLAIN), PLAIN)
    return best.select(*[F.round(c, 6).alias(c) for c in best.columns])


def baseline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan amount (in 100,000) and income (in 1,000, 0 if unknown) as features."""
    features = F.array(F.col("loan_amnt") / 100_000, F.coalesce("annual_inc", F.lit(0.0)) / 1_000)
    return loans(spark, sf_dir).select(features.alias("features"), "int_rate", "loan_status")


BASELINE_SQL = f"""{LOANS_SQL}, points AS (
  SELECT loan_amnt / 100000 AS a, coalesce(annual_inc, 0) / 1000 AS b, int_rate AS y,
         CASE WHEN loan_status = 'Fully Paid' THEN 0 ELSE 1 END AS c
  FROM loans
)"""


@query(
    "m14_linear_baseline",
    f"""WITH {BASELINE_SQL}, m AS (
  SELECT avg(a) AS a, avg(b) AS b, avg(y) AS y, covar_pop(a, a) AS aa, covar_pop(a, b) AS ab, covar_pop(b, b) AS bb,
         covar_pop(a, y) AS ay, covar_pop(b, y) AS "by"
  FROM points
), solved AS (
  SELECT *, (ay * bb - "by" * ab) / (aa * bb - ab * ab) AS wa, ("by" * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM m
)
SELECT 'intercept' AS term, round(y - wa * a - wb * b, 5) AS value FROM solved
UNION ALL SELECT 'amount', round(wa, 5) FROM solved UNION ALL SELECT 'income', round(wb, 5) FROM solved""",
)
def m14_linear_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fit_linear(baseline_rows(spark, sf_dir).withColumn("label", F.col("int_rate")))
    rows = coefficient_table(model, ["amount", "income"])
    return spark.createDataFrame(rows, "term string, value double").withColumn("value", F.round("value", 5))


# Newton steps of a logistic regression over ``weighted`` rows with two features.
NEWTON_SQL = """newton AS (
  SELECT 0 AS step, CAST(0 AS DOUBLE) AS w0, CAST(0 AS DOUBLE) AS w1, CAST(0 AS DOUBLE) AS w2
  UNION ALL
  SELECT step + 1,
         w0 + (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / d,
         w1 + (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / d,
         w2 + (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / d
  FROM (
    SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS d
    FROM (
      SELECT step, w0, w1, w2, sum(w * (c - p)) AS g0, sum(w * (c - p) * a) AS g1, sum(w * (c - p) * b) AS g2,
             sum(w * p * (1 - p)) AS h00, sum(w * p * (1 - p) * a) AS h01, sum(w * p * (1 - p) * b) AS h02,
             sum(w * p * (1 - p) * a * a) AS h11, sum(w * p * (1 - p) * a * b) AS h12, sum(w * p * (1 - p) * b * b) AS h22
      FROM (SELECT step, w0, w1, w2, a, b, c, w, 1 / (1 + exp(-(w0 + w1 * a + w2 * b))) AS p FROM newton, weighted WHERE step < 10)
      GROUP BY step, w0, w1, w2
    )
  )
)
SELECT 'intercept' AS term, round(w0, 4) AS value FROM newton WHERE step = 10
UNION ALL SELECT 'amount', round(w1, 4) FROM newton WHERE step = 10
UNION ALL SELECT 'income', round(w2, 4) FROM newton WHERE step = 10"""


@query(
    "m14_logistic_baseline",
    f"""WITH RECURSIVE {LOANS_SQL}, weighted AS (
  SELECT loan_amnt / 100000 AS a, coalesce(annual_inc, 0) / 1000 AS b, CASE WHEN loan_status = 'Fully Paid' THEN 0 ELSE 1 END AS c,
         CAST(1 AS DOUBLE) AS w
  FROM loans WHERE loan_status IN ('Fully Paid', 'Charged Off')
), {NEWTON_SQL}""",
)
def m14_logistic_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain baseline: all finished loans, both features, no weights."""
    rows = keep_members(baseline_rows(spark, sf_dir), "loan_status", LOAN_KEPT_STATUS)
    labelled = label_rows(rows, "loan_status", "Fully Paid", "label").select("features", "label")
    coefficients = coefficient_table(fit_logistic(labelled, tol=1e-12), ["amount", "income"])
    return spark.createDataFrame(coefficients, "term string, value double").withColumn("value", F.round("value", 4))


def split_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished loans with both features, both labels and their split."""
    features = F.array(F.col("loan_amnt") / 100_000, F.coalesce("annual_inc", F.lit(0.0)) / 1_000)
    return divided(spark, sf_dir).select(features.alias("features"), F.col("classification_target").alias("c"), "int_rate", "split")


SPLIT_POINTS_SQL = f"""{CLEAN_SQL}, {split_sql("cleaned", "loan_id")}, points AS (
  SELECT split, loan_amnt / 100000 AS a, coalesce(annual_inc, 0) / 1000 AS b, classification_target AS c, int_rate AS y FROM divided
)"""


@query(
    "m14_weighted_logistic",
    f"""WITH RECURSIVE {SPLIT_POINTS_SQL}, classes AS (
  SELECT c, count(*) AS n FROM points WHERE split = 'train' GROUP BY c
), weighted AS (
  SELECT a, b, points.c, (SELECT sum(n) FROM classes) / (2 * n) AS w FROM points JOIN classes USING (c) WHERE split = 'train'
), {NEWTON_SQL}""",
)
def m14_weighted_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The baseline as a comparison needs it: finished loans, training split, class weights, all features."""
    train = split_points(spark, sf_dir).filter("split = 'train'").select("features", F.col("c").alias("label"))
    weights = weight_list(class_weights(train, "label"))
    rows = coefficient_table(fit_logistic(train, weights, tol=1e-12), ["amount", "income"])
    return spark.createDataFrame(rows, "term string, value double").withColumn("value", F.round("value", 4))


@query(
    "baseline_run_record",
    f"""WITH {SPLIT_POINTS_SQL}, m AS (
  SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my, covar_pop(a, a) AS aa, covar_pop(a, b) AS ab, covar_pop(b, b) AS bb,
         covar_pop(a, y) AS ay, covar_pop(b, y) AS yb
  FROM points WHERE split = 'train'
), solved AS (
  SELECT *, (ay * bb - yb * ab) / (aa * bb - ab * ab) AS wa, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM m
), tested AS (
  SELECT y, y - (my + wa * (a - ma) + wb * (b - mb)) AS e FROM points, solved WHERE split = 'test'
)
SELECT 'Regressão Linear (Baseline)' AS display_name, 'baseline_linear_regression' AS model_name, true AS available,
       round(avg(abs(e)), 5) AS mae, round(avg(e * e), 5) AS mse, round(sqrt(avg(e * e)), 5) AS rmse,
       round(1 - sum(e * e) / (var_pop(y) * count(*)), 5) AS r2
FROM tested
UNION ALL SELECT 'MLP', 'mlp', false, NULL, NULL, NULL, NULL""",
)
def baseline_run_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear baseline from training rows to the comparison table: fit, blind test, logged record, comparison."""
    points = split_points(spark, sf_dir).withColumnRenamed("int_rate", "label")
    model = fit_linear(points.filter("split = 'train'"))
    record = metrics_record(evaluate(score_linear(points.filter("split = 'test'"), model), "label", "pred", "regression"))
    path = scratch_path(spark, "history")
    log_run(spark, "regression", BASELINE_NAME["regression"], record, path=path)
    table = comparison(load_history(spark, path), "regression")
    return table.select(
        "display_name", "model_name", "available", *[F.round(m, 5).alias(m) for m in ("mae", "mse", "rmse", "r2")]
    )
