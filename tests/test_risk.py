import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, StandardScaler
from pyspark.sql import Observation
from pyspark.sql import functions as F

from helpers import TESTDATA, rows
from tideline import queries
from tideline.operators.ordered import running_totals
from tideline.plans import risk


@pytest.fixture(scope="module")
def loans(spark):
    return queries.loan_book(spark, TESTDATA)


@pytest.fixture(scope="module")
def glm(spark, loans, tmp_path_factory):
    # A session that has used an Observation must not keep the model from scoring.
    loans.observe(Observation("before training"), F.count(F.lit(1)).alias("n")).count()
    labelled = risk.store_training_table(risk.label_loans(loans), str(tmp_path_factory.mktemp("train") / "rows"))
    model = risk.train_glm(labelled)
    risk.best_threshold(model, labelled)
    return model


@pytest.fixture(scope="module")
def gbt(loans, tmp_path_factory):
    return risk.train_gbt(risk.store_training_table(risk.label_loans(loans), str(tmp_path_factory.mktemp("train") / "rows")))


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "p1 double, label double")


def test_small_curve(spark):
    df = scored(spark, [(.9, 1.), (.5, 0.), (.4, 1.), (.1, 0.)])
    assert risk.area_under_roc(df) == 0.75
    exact = [(r["fpr"], r["tpr"]) for r in risk.roc_points(df, bins=None).orderBy(F.desc("threshold")).collect()]
    assert exact == [(0, .5), (.5, .5), (.5, 1), (1, 1)]
    assert rows(risk.roc_points(df, bins=10), "fpr", "tpr") == sorted(exact, key=repr)


def test_area_matches_the_evaluator(spark):
    rng = random.Random(2)
    df = scored(spark, [(round(rng.random(), 3), float(rng.random() < .3)) for _ in range(3000)])
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="p1", numBins=0)
    assert risk.area_under_roc(df) == pytest.approx(evaluator.evaluate(df), abs=1e-12)


def test_running_totals_over_slices(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"), F.lit(1).cast("long").alias("n"))
    up = running_totals(df, "x", ["n"], slices=7).where("cum_n <> x + 1")
    down = running_totals(df, "x", ["n"], descending=True, slices=7).where("cum_n <> 1000 - x")
    assert up.count() == 0 and down.count() == 0
    single = running_totals(df.where("x = 3"), "x", ["n"])
    assert rows(single) == [(3.0, 1, 1)]


def test_labels(spark):
    df = spark.createDataFrame([("Default", " Source Verified"), ("Fully Paid", "Verified"), ("Current", "x")],
                               "loan_status string, verification_status string")
    labelled = risk.clean_verification(risk.label_loans(df))
    assert rows(labelled) == [("Default", "Verified", "true"), ("Fully Paid", "Verified", "false")]


def test_models_beat_chance(spark, loans, glm, gbt):
    labelled = risk.label_loans(loans)
    for model in (glm, gbt):
        result = risk.score(model, labelled)
        assert result.columns == ["p0", "p1", "label", "prediction"]
        assert risk.area_under_roc(result) > 0.7
        assert result.where("abs(p0 + p1 - 1) > 1e-9").count() == 0


def test_rows_are_prepared_once_per_training_set(loans, tmp_path, monkeypatch):
    rows_ = risk.store_training_table(risk.label_loans(loans), str(tmp_path / "rows"))
    stages = [*risk._shared_stages(True), StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
              LogisticRegression(featuresCol="scaled", maxIter=risk.GLM_ITERATIONS, elasticNetParam=risk.GLM_ELASTIC_NET)]
    grid = [{stages[-1].regParam: r} for r in risk.GLM_REG_PARAMS]
    for i, model in risk._KeptFeatures(stages=stages).fitMultiple(rows_, grid):
        plain = Pipeline(stages=stages).fit(rows_, grid[i])
        pairs = zip(*[[r["p1"] for r in risk.score(m, rows_).collect()] for m in (model, plain)])
        assert max(abs(a - b) for a, b in pairs) < 1e-9
    fits, fit = [], Imputer._fit
    monkeypatch.setattr(Imputer, "_fit", lambda self, given: fits.append(self) or fit(self, given))
    risk.train_glm(rows_)
    assert len(fits) == risk.FOLDS + 1


def test_trees_read_prepared_rows(loans, tmp_path, monkeypatch):
    rows_ = risk.store_training_table(risk.label_loans(loans), str(tmp_path / "rows"))
    given, fit = [], GBTClassifier._fit
    monkeypatch.setattr(GBTClassifier, "_fit", lambda self, found: given.append(found.storageLevel.useDisk) or fit(self, found))
    model = risk.train_gbt(rows_)
    assert given == [True]
    plain = Pipeline(stages=[*risk._shared_stages(False), GBTClassifier(
        featuresCol="features", labelCol="label", lossType="logistic", maxBins=risk.GBT_BINS, maxIter=risk.GBT_ITERATIONS,
        maxDepth=risk.GBT_DEPTH, seed=risk.SAMPLE_SEED)]).fit(rows_)
    assert rows(risk.score(model, rows_)) == rows(risk.score(plain, rows_))


def test_threshold_reaches_the_model(spark, loans, glm):
    pairs = [(r["p1"], r["label"], r["prediction"]) for r in risk.score(glm, risk.label_loans(loans)).collect()]
    positives = sum(label for _, label, _ in pairs)

    def f_measure(predicted):
        return 2 * sum(label for _, label, _ in predicted) / (len(predicted) + positives)
    best = max(f_measure([p for p in pairs if p[0] >= t]) for t in {p[0] for p in pairs})
    assert f_measure([p for p in pairs if p[2] == 1]) == pytest.approx(best, abs=1e-12)


def test_unseen_levels_missing_numbers_and_functions(spark, loans, glm, root):
    path = risk.publish_model(glm, root, "loan_risk", "production")
    assert path.endswith("loan_risk/production")
    model = risk.load_model(root, "loan_risk", "production")
    odd = loans.limit(50).withColumn("purpose", F.lit("it's new")).withColumn("annual_inc", F.lit(None).cast("double"))
    data = loans.unionByName(odd)
    risk.register_risk_function(spark, model)
    spark.udf.register("loan_risk_udf", risk.loan_risk_udf(spark, model))
    features = f"struct({', '.join([*risk.CATEGORICALS, *risk.NUMERICS])})"
    checked = risk.risk_predictions(model, data).selectExpr(
        "*", f"loan_risk_prediction({features}) AS by_sql", f"loan_risk_udf({features}) AS by_udf")
    assert checked.where("pred <> by_sql OR pred <> by_udf").count() == 0
    assert {r[0] for r in checked.select("pred").distinct().collect()} == {"0.0", "1.0"}
    plan = spark.createDataFrame(data.limit(1).collect(), data.schema).selectExpr(
        f"loan_risk_prediction({features})")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_trees_as_a_function(spark, loans, gbt):
    odd = loans.limit(50).withColumn("purpose", F.lit("it's new")).withColumn("annual_inc", F.lit(None).cast("double"))
    empty = loans.limit(20).withColumn("term", F.lit(None).cast("string")).withColumn("loan_amnt", F.lit(float("nan")))
    data = loans.unionByName(odd).unionByName(empty)
    features = f"struct({', '.join([*risk.CATEGORICALS, *risk.NUMERICS])})"
    spark.udf.register("loan_trees", risk.loan_risk_udf(spark, gbt))
    checked = risk.risk_predictions(gbt, data).selectExpr("pred", f"loan_trees({features}) AS by_udf")
    assert checked.where("pred <> by_udf").count() == 0
    assert {r[0] for r in checked.select("pred").distinct().collect()} == {"0.0", "1.0"}


def test_streamed_predictions_keep_the_input_columns(spark, loans, glm, root):
    loans.write.parquet(f"{root}/in")
    stream = risk.risk_predictions(glm, spark.readStream.schema(loans.schema).parquet(f"{root}/in"))
    query = (stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/ck")
             .trigger(availableNow=True).start(f"{root}/out"))
    query.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    assert out.columns == [*loans.columns, "pred"]
    assert rows(out) == rows(risk.risk_predictions(glm, loans))


def test_confusion_and_value(spark):
    df = spark.createDataFrame([(1., 1., -50.), (1., 0., 30.), (0., 1., -9.), (0., 0., 4.), (0., 0., 5.)],
                               "prediction double, label double, net double")
    confusion = risk.confusion_value(df, "net")
    assert (0.0, 0.0, 2, 9.0) in rows(confusion)
    assert risk.business_value(confusion).first()["value"] == 80.0


def test_sample_split_loses_nothing(spark, loans):
    small, rest = risk.sample_loans(loans, "o_orderkey")
    assert small.count() + rest.count() == loans.count() and small.count() < rest.count() / 10


def test_stored_tables(spark, loans):
    spark.sql("DROP TABLE IF EXISTS loanstats_train")
    risk.label_loans(loans).write.saveAsTable("loanstats_train")
    spark.sql("DROP TABLE IF EXISTS loan_stats")
    location = spark.conf.get("spark.sql.warehouse.dir")
    spark.sql(f"CREATE TABLE loan_stats USING parquet LOCATION '{location}/loanstats_train'")
    assert spark.table("loan_stats").count() == spark.table("loanstats_train").count() > 0
    states = risk.loans_per_state(spark.table("loan_stats"))
    assert states.agg(F.sum("ratio")).first()[0] == spark.table("loan_stats").where("annual_inc IS NOT NULL").count()


def test_curve_without_scores_and_with_one_class(spark):
    some = spark.createDataFrame([(.9, 1.), (.5, 0.), (.4, 1.), (.1, 0.), (None, 1.), (float("nan"), 0.), (.3, None)],
                                 "p1 double, label double")
    known = some.where("p1 IS NOT NULL AND NOT isnan(p1) AND label IS NOT NULL")
    for bins in (10, None):
        assert rows(risk.roc_points(some, bins=bins)) == rows(risk.roc_points(known, bins=bins))
        ends = rows(risk.roc_points(some, bins=bins, ends=True), "fpr", "tpr")
        assert (0.0, 0.0) in ends and (1.0, 1.0) in ends
    assert risk.area_under_roc(some) == 0.75
    one = known.where("label = 1")
    assert {r[0] for r in rows(risk.roc_points(one, bins=None), "fpr")} == {None}
    assert risk.area_under_roc(one) is None
