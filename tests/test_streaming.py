from pyspark.sql import functions as F

from tabweave.operators.network import MLPSpec, init_params
from tabweave.operators.scoring import score_mlp, with_predictions
from tabweave.operators.encode import assemble
from tabweave.plans.prepare import clean, prepare
from tabweave.streaming.apply import score_open, score_stream


def test_fitted_steps_run_on_a_stream(spark, tmp_path):
    i = F.col("id")
    rows = spark.range(120).select(
        i.cast("string").alias("k"), (i % 11).cast("double").alias("amount"), F.concat(F.lit("g"), i % 3).alias("grade"),
        F.when(i % 2 == 0, "Fully Paid").when(i % 3 == 0, "Current").otherwise("Charged Off").alias("loan_status"),
        (i / 10).alias("int_rate"),
    )
    rows.write.parquet(str(tmp_path / "in"))
    fitted = prepare(rows, ["amount"], ["grade"], key=["k"])
    spec = MLPSpec(4, [3], 2)
    params = init_params(spec)

    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = (
        score_stream(stream, fitted, params, spec, "classification", ["k"]).select("k", "p1", "pred")
        .writeStream.format("memory").queryName("scored").option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    query.processAllAvailable()
    query.stop()

    batch = assemble(fitted.apply(clean(rows, ["grade"])), keep=["k"])
    expected = with_predictions(score_mlp(batch, params, spec)).select("k", "p1", "pred")
    assert sorted(map(tuple, spark.table("scored").collect())) == sorted(map(tuple, expected.collect()))
    assert spark.table("scored").count() == 100

    # Rows without an outcome, and without the columns for one.
    arriving = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")).drop("loan_status", "int_rate")
    query = (
        score_open(arriving, fitted, params, spec, "classification", ["k"]).select("k", "p1", "pred")
        .writeStream.format("memory").queryName("scored_open").option("checkpointLocation", str(tmp_path / "cp2")).start()
    )
    query.processAllAvailable()
    query.stop()
    found = set(map(tuple, spark.table("scored_open").collect()))
    assert len(found) == 120 and set(map(tuple, expected.collect())) <= found
