import pytest
from pyspark.sql import functions as F

from tabweave.operators.classes import class_counts, class_weights
from tabweave.operators.encode import assemble, fill_categories, fit_vocabulary, keep_members, label_rows, one_hot
from tabweave.operators.scaling import Scale, impute, standardize
from tabweave.plans.prepare import prepare, prepare_loans
from tabweave.sources.csv import scan_csv
from tabweave.sources.schemas import LOAN_CATEGORICAL, LOAN_COLUMNS, LOAN_NUMERIC

NUMERIC, CATEGORICAL = ["amount", "income"], ["grade", "purpose"]


def loans(spark, n=400):
    i = F.col("id")
    return spark.range(n).select(
        i.alias("k"),
        (i * 37 % 101).cast("double").alias("amount"),
        F.when(i % 6 != 0, i * 13 % 89).cast("double").alias("income"),
        F.element_at(F.array(*map(F.lit, ["A", "B.1", "< 1 year", "10+ years"])), (i % 4 + 1).cast("int")).alias("grade"),
        F.when(i % 5 == 0, None).otherwise(F.concat(F.lit("p"), i % 3)).alias("purpose"),
        F.when(i % 4 == 0, "Charged Off").when(i % 9 == 0, None).when(i % 7 == 0, "Current").otherwise("Fully Paid").alias("loan_status"),
        (i % 20 / 2).alias("int_rate"),
    )


def test_filter_drops_null_and_label_follows(spark):
    df = spark.createDataFrame([("Fully Paid",), ("Charged Off",), ("Current",), (None,)], "s string")
    kept = label_rows(keep_members(df, "s", ["Fully Paid", "Charged Off"]), "s", "Fully Paid", "y")
    assert sorted((r["s"], r["y"]) for r in kept.collect()) == [("Charged Off", 1), ("Fully Paid", 0)]


def test_fill_casts_first(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "a int, b string")
    assert [tuple(r) for r in fill_categories(df, ["a", "b"]).collect()] == [("1", "unknown"), ("unknown", "x")]


def test_one_hot_in_place_with_awkward_values(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (2, "<1", "y"), (3, "a.b", "x")], "k int, c string, d string")
    out = one_hot(df, fit_vocabulary(df, ["c"]))
    assert out.columns == ["k", "c_<1", "c_a b", "c_a.b", "d"]
    assert [tuple(r) for r in out.orderBy("k").collect()] == [(1, 0, 1, 0, "x"), (2, 1, 0, 0, "y"), (3, 0, 0, 1, "x")]


def test_one_hot_clashes_and_limits(spark):
    df = spark.createDataFrame([("a",), ("A",)], "c string")
    with pytest.raises(ValueError, match="clash"):
        one_hot(df, fit_vocabulary(df, ["c"]))
    with pytest.raises(ValueError, match="more than 5"):
        fit_vocabulary(spark.range(6).select(F.col("id").cast("string").alias("c")), ["c"], max_columns=5)


def test_unknown_value_gives_zeros(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    assert [tuple(r) for r in one_hot(df, {"c": ["a", "b"]}).collect()] == [(1, 0), (0, 0), (0, 0)]


def test_impute_then_scale_and_nan(spark):
    scales = {"v": Scale(3.0, 4.0, 2.0)}
    df = spark.createDataFrame([(6.0,), (None,), (float("nan"),)], "v double")
    plain = [r["v"] for r in standardize(impute(df, scales), scales).collect()]
    assert plain[:2] == [1.0, -0.5] and plain[2] != plain[2]
    assert [r["v"] for r in standardize(impute(df, scales, nan_as_null=True), scales).collect()] == [1.0, -0.5, -0.5]


def test_prepared_frame(spark):
    ready = prepare(loans(spark), NUMERIC, CATEGORICAL, key=["k"])
    hot = [c for c in ready.frame.columns if c.startswith(("grade_", "purpose_"))]
    assert ready.frame.columns == [
        *NUMERIC, "grade_10+ years", "grade_< 1 year", "grade_A", "grade_B.1",
        "purpose_p0", "purpose_p1", "purpose_p2", "purpose_unknown",
        "loan_status", "int_rate", "classification_target", "order_key", "split",
    ]
    one_per_category = [sum((F.col(f"`{c}`") for c in hot if c.startswith(p)), F.lit(0)).alias(p) for p in ("grade", "purpose")]
    assert [tuple(r) for r in ready.frame.select(*one_per_category).distinct().collect()] == [(1, 1)]
    train = ready.part("train").agg(F.avg("amount"), F.stddev_samp("amount")).first()
    assert train[0] == pytest.approx(0, abs=1e-9) and train[1] == pytest.approx(1)
    n = ready.frame.count()
    found = {r["split"]: (r["rows"], r["width"]) for r in ready.sizes().collect()}
    a, b = int(0.7 * n), int(0.15 * n)
    assert found == {"train": (a, 13), "val": (b, 13), "test": (n - a - b, 13)}


def test_vocabulary_from_train_only_and_staging(spark):
    staged = prepare(loans(spark), NUMERIC, CATEGORICAL, key=["k"], stage=True, vocabulary_from="train")
    plain = prepare(loans(spark), NUMERIC, CATEGORICAL, key=["k"])

    def rows(ready):
        rounded = ready.frame.withColumns({c: F.round(c, 9) for c in NUMERIC})
        return sorted(map(str, rounded.collect()))

    assert rows(staged) == rows(plain)


def test_assemble_modes(spark):
    df = spark.createDataFrame([(1.0, 0, 3.5, "Fully Paid", "train", "k1")], "a double, classification_target int, int_rate double, loan_status string, split string, order_key string")
    assert tuple(assemble(df).first()) == ([1.0], 0)
    assert assemble(df).dtypes == [("features", "array<float>"), ("label", "bigint")]
    assert assemble(df, "regression").dtypes[1] == ("label", "float")
    with pytest.raises(ValueError, match="mode"):
        assemble(df, "ranking")


def test_assemble_refuses_a_feature_without_values(spark):
    df = spark.createDataFrame([(None, 0, 1.0, "Fully Paid")], "a double, classification_target int, int_rate double, loan_status string")
    with pytest.raises(Exception, match="feature 'a' is null"):
        assemble(df).collect()


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2 + [(7,)] * 2, "y int")
    assert [tuple(r) for r in class_counts(df, "y", 3).orderBy("class_id").collect()] == [(0, 6, 10), (1, 2, 10), (2, 0, 10)]
    assert [r["weight"] for r in class_weights(df, "y").orderBy("class_id").collect()] == [10 / 12, 10 / 4]
    assert [r["weight"] for r in class_weights(df.limit(0), "y").orderBy("class_id").collect()] == [0.0, 0.0]


def test_tolerant_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,junk,b\n1,x,p\noops,x,"q,r"\n"1,2",x,s\n 6 ,x,t\nNaN,x,u\n7\n8,x,v,extra\n9,x,"say ""hi"""\n')
    out = scan_csv(spark, str(path), ["a"]).select("a", "b").collect()
    assert [str(r["a"]) for r in out] == ["1.0", "None", "None", "6.0", "nan", "7.0", "8.0", "9.0"]
    assert [r["b"] for r in out] == ["p", "q,r", "s", "t", "u", None, "v", 'say "hi"']


def test_csv_line_breaks_inside_quotes(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('a,b\n1,"two\nlines"\n2,z\n')
    assert [tuple(r) for r in scan_csv(spark, str(path), ["a"], multi_line=True).collect()] == [(1.0, "two\nlines"), (2.0, "z")]


def test_loan_table_from_csv(spark, tmp_path):
    """The 22 columns in another order, among others, without a key."""
    i = F.col("id")
    made = spark.range(300).select(
        i.alias("other"),
        *[F.concat("id", F.lit(".5")).alias(c) for c in reversed(LOAN_NUMERIC)],
        *[F.concat(F.lit(f"{c}-"), i % 3).alias(c) for c in LOAN_CATEGORICAL],
        F.when(i % 3 == 0, "Charged Off").otherwise("Fully Paid").alias("loan_status"),
        (i % 10).alias("int_rate"),
    )
    made.write.csv(str(tmp_path / "loans"), header=True)
    ready = prepare_loans(spark, str(tmp_path / "loans"))
    assert ready.frame.count() == 300
    assert len(ready.frame.columns) == len(LOAN_COLUMNS) - 7 + 21 + 3
    assert {r["split"]: r["rows"] for r in ready.sizes().collect()} == {"train": 210, "val": 45, "test": 45}
    features = assemble(ready.frame).first()
    assert len(features["features"]) == 13 + 21
