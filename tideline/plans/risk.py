"""Loan risk: labels, two classifiers, their evaluation, and scoring of batches and streams."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier, LogisticRegression,
                                       LogisticRegressionModel)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import (Imputer, ImputerModel, OneHotEncoder, SQLTransformer, StandardScaler,
                                StandardScalerModel, StringIndexer, StringIndexerModel,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.functions.parsing import merge_levels
from tideline.operators.ordered import running_totals
from tideline.session import ensure_checkpoint_dir, scratch_dir

# Statuses, features and settings of the two models.
FINISHED = ("Default", "Charged Off", "Fully Paid")
GOOD = "Fully Paid"
VERIFIED_ALIAS, VERIFIED = "Source Verified", "Verified"
CATEGORICALS = ("term", "home_ownership", "purpose", "addr_state", "verification_status",
                "application_type")
NUMERICS = ("loan_amnt", "annual_inc", "delinq_2yrs", "total_acc")
GLM_ITERATIONS, GLM_ELASTIC_NET, GLM_REG_PARAMS, FOLDS = 5, 0.5, (0.1, 0.02), 5
GBT_BINS, GBT_ITERATIONS, GBT_DEPTH = 52, 10, 5
SAMPLE_WEIGHTS, SAMPLE_SEED = (0.025, 0.975), 123

_LEVELS = {c: c for c in CATEGORICALS} | {"verification_status": "verification_level"}


def in_sample(loans: DataFrame, key: str) -> Column:
    """Whether a row belongs to the small training sample; decided by a hash of its key alone.

    Neither the partitioning nor the other rows matter, and nothing is sorted.
    """
    text = F.concat_ws("/", F.lit(str(SAMPLE_SEED)), F.col(key).cast("string"))
    place = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
    return place % 1000 < round(1000 * SAMPLE_WEIGHTS[0] / sum(SAMPLE_WEIGHTS))


def sample_loans(loans: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The small training sample and the rest."""
    small = in_sample(loans, key)
    return loans.where(small), loans.where(~small)


def label_loans(loans: DataFrame) -> DataFrame:
    """Finished loans with ``bad_loan`` = 'true' unless fully paid."""
    return (loans.where(F.col("loan_status").isin(*FINISHED))
            .withColumn("bad_loan", (F.col("loan_status") != GOOD).cast("string")))


def clean_verification(loans: DataFrame) -> DataFrame:
    return loans.withColumn("verification_status",
                            merge_levels("verification_status", VERIFIED_ALIAS, VERIFIED))


def loans_per_state(loans: DataFrame) -> DataFrame:
    """Loans with a known income per state; the count is called ``ratio``."""
    return loans.groupBy("addr_state").agg(F.count("annual_inc").alias("ratio"))


def store_training_table(labelled: DataFrame, path: str) -> DataFrame:
    """Write the rows once, in files of similar size, and read them back in a session of their own.

    Training reads its input many times; stored rows spare it the joins behind them.
    """
    labelled.hint("rebalance").write.mode("overwrite").parquet(path)
    return labelled.sparkSession.newSession().read.parquet(path)


def _shared_stages(one_hot: bool) -> list:
    """Level cleaning, indexing and imputing; the input columns stay as they are."""
    clean = SQLTransformer(statement=(
        f"SELECT *, trim(regexp_replace(verification_status, '{VERIFIED_ALIAS}', '{VERIFIED}')) "
        "AS verification_level FROM __THIS__"))
    levels = [_LEVELS[c] for c in CATEGORICALS]
    index = StringIndexer(inputCols=levels, outputCols=[f"{c}_idx" for c in CATEGORICALS],
                          handleInvalid="keep")
    filled = [f"{n}_filled" for n in NUMERICS]
    impute = Imputer(inputCols=list(NUMERICS), outputCols=filled)
    label = StringIndexer(inputCol="bad_loan", outputCol="label")
    stages = [clean, index]
    if one_hot:
        stages.append(OneHotEncoder(inputCols=[f"{c}_idx" for c in CATEGORICALS],
                                    outputCols=[f"{c}_class" for c in CATEGORICALS]))
    suffix = "class" if one_hot else "idx"
    assemble = VectorAssembler(inputCols=[f"{c}_{suffix}" for c in CATEGORICALS] + filled,
                               outputCol="features")
    return [*stages, impute, assemble, label]


class _KeptFeatures(Pipeline):
    """A pipeline whose learners read prepared rows.

    Preparing costs more than learning, and learners read their rows many times. So the stages before the learners are
    fitted once per table, whatever the grid, and their features lie on the executors' disks until the learners are
    done. Models are fitted one after the other: each fit keeps a copy of its rows in blocks.
    """

    def _learned(self, dataset: DataFrame, grid: Sequence[dict], centred: bool) -> list[PipelineModel]:
        learners = [s for s in self.getStages() if isinstance(s, (StandardScaler, LogisticRegression, GBTClassifier))]
        prepared = Pipeline(stages=[s for s in self.getStages() if s not in learners]).fit(dataset)
        rows = prepared.transform(dataset).select("features", "label").persist(StorageLevel.DISK_ONLY)
        try:
            stages, given = list(prepared.stages), rows
            for scaler in learners[:-1]:
                stages.append(scaler.fit(rows, None if centred else {scaler.withMean: False}))
                given = stages[-1].transform(given)
            return [PipelineModel([*stages, learners[-1].fit(given, params)]) for params in grid]
        finally:
            rows.unpersist()

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        return self._learned(dataset, [{}], centred=True)[0]

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[dict]) -> Iterator[tuple[int, PipelineModel]]:
        """One model per setting of the last stage, to be compared.

        A regression with an intercept centres its input itself. So these are scaled alone, which keeps their vectors
        sparse; their probabilities are those of the centred ones.
        """
        return iter([*enumerate(self._learned(dataset, paramMaps, centred=False))])


def train_glm(train: DataFrame, parallelism: int = FOLDS, seed: int = SAMPLE_SEED) -> PipelineModel:
    """Logistic regression on standardized features; the best of the grid by cross-validation.

    Folds are cut by a hash of the row, so a retried task sees the same folds. Train on a stored table (see
    ``store_training_table``): its rows are read many times, and a fitted regression keeps a reference to the session
    of its rows, which must not be one in which counters were observed.
    """
    scale = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    regression = LogisticRegression(featuresCol="scaled", maxIter=GLM_ITERATIONS,
                                    elasticNetParam=GLM_ELASTIC_NET)
    grid = ParamGridBuilder().addGrid(regression.regParam, list(GLM_REG_PARAMS)).build()
    fold = F.pmod(F.xxhash64(F.lit(seed), *train.columns), F.lit(FOLDS)).cast("int")
    search = CrossValidator(estimator=_KeptFeatures(stages=[*_shared_stages(True), scale, regression]),
                            estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(),
                            numFolds=FOLDS, foldCol="__fold", parallelism=parallelism)
    return search.fit(train.withColumn("__fold", fold)).bestModel


def train_gbt(train: DataFrame, seed: int = SAMPLE_SEED) -> PipelineModel:
    """Gradient-boosted trees on indexed categories."""
    trees = GBTClassifier(featuresCol="features", labelCol="label", lossType="logistic",
                          maxBins=GBT_BINS, maxIter=GBT_ITERATIONS, maxDepth=GBT_DEPTH, seed=seed)
    return _KeptFeatures(stages=[*_shared_stages(False), trees]).fit(train)


def score(model: PipelineModel, loans: DataFrame) -> DataFrame:
    """p0, p1, label and prediction of every loan."""
    probability = vector_to_array("probability")
    return (model.transform(loans)
            .select(probability[0].alias("p0"), probability[1].alias("p1"), "label", "prediction"))


def risk_predictions(model: PipelineModel, loans: DataFrame) -> DataFrame:
    """The loans, batch or stream, with the prediction as text in ``pred``."""
    return (model.transform(loans)
            .select(*[F.col(c) for c in loans.columns], F.col("prediction").cast("string").alias("pred")))


def _counts(scored: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """Positives and negatives per distinct score, combined before the shuffle.

    Rows without a score (NULL or NaN) or without a label count nowhere.
    """
    positive = F.col(label_col) > 0.5
    known = F.col(score_col).isNotNull() & ~F.isnan(F.col(score_col).cast("double")) & positive.isNotNull()
    return (scored.where(known).groupBy(F.col(score_col).alias("threshold"))
            .agg(F.count_if(positive).alias("positives"), F.count_if(~positive).alias("negatives")))


def _checkpointed(counts: DataFrame) -> DataFrame:
    """Distinct scores are read several times; score and count the rows only once."""
    ensure_checkpoint_dir(counts.sparkSession)
    return counts.checkpoint()


def roc_points(scored: DataFrame, score_col: str = "p1", label_col: str = "label",
               bins: int | None = 100, ends: bool = False) -> DataFrame:
    """threshold, fpr, tpr of the curve, from the highest threshold down.

    With ``bins`` scores in [0, 1] fall into that many equal ranges, and a point counts the rows
    at or above the lower end of a range. Without, every distinct score is a point. With ``ends`` the
    curve has its end points (0, 0) and (1, 1) too, with infinite thresholds. Rows without a score or
    label count nowhere; with one class only, the rate of the other is NULL.
    """
    sides = ["positives", "negatives"]
    if bins:
        place = F.when(F.col(score_col).isNotNull() & ~F.isnan(F.col(score_col).cast("double")), F.least(
            F.floor(F.col(score_col) * bins), F.lit(bins - 1)) / F.lit(float(bins)))
        counts = _counts(scored.withColumn("__place", place), "__place", label_col)
        # At most `bins` rows are left, so one partition holds them.
        down = Window.orderBy(F.col("threshold").desc()).rowsBetween(Window.unboundedPreceding, 0)
        everything = Window.partitionBy()
        curve = counts.select("threshold", *[F.sum(s).over(down).alias(f"cum_{s}") for s in sides],
                              *[F.sum(s).over(everything).alias(f"all_{s}") for s in sides])
    else:
        counts = _checkpointed(_counts(scored, score_col, label_col))
        totals = counts.agg(*[F.sum(s).alias(s) for s in sides]).first()
        curve = running_totals(counts, "threshold", sides, descending=True)
        curve = curve.select("*", *[F.lit(totals[s]).alias(f"all_{s}") for s in sides])
    curve = curve.select("threshold", F.try_divide("cum_negatives", "all_negatives").alias("fpr"),
                         F.try_divide("cum_positives", "all_positives").alias("tpr"))
    if not ends:
        return curve
    corners = [(math.inf, 0.0, 0.0), (-math.inf, 1.0, 1.0)]
    return curve.unionByName(scored.sparkSession.createDataFrame(corners, "threshold double, fpr double, tpr double"))


def stacked_roc(scored: Mapping[str, DataFrame], bins: int | None = 100) -> DataFrame:
    """Curves of several models, each tagged with its name."""
    curves = [roc_points(df, bins=bins).withColumn("model", F.lit(name))
              for name, df in scored.items()]
    stacked = curves[0]
    for curve in curves[1:]:
        stacked = stacked.union(curve)
    return stacked


def roc_area(scored: DataFrame, score_col: str = "p1", label_col: str = "label") -> DataFrame:
    """Exact area as one row ``auc``: the share of (positive, negative) pairs ranked right, ties
    counting half."""
    ranked = running_totals(_checkpointed(_counts(scored, score_col, label_col)), "threshold",
                            ["positives", "negatives"], descending=True)
    above = F.col("cum_positives") - F.col("positives") / 2
    return (ranked.agg(F.sum(above * F.col("negatives")).alias("pairs"),
                       F.sum("positives").alias("p"), F.sum("negatives").alias("n"))
            .select(F.try_divide("pairs", F.col("p").cast("double") * F.col("n")).alias("auc")))


def area_under_roc(scored: DataFrame, score_col: str = "p1", label_col: str = "label") -> float:
    return roc_area(scored, score_col, label_col).first()["auc"]


def f_measures(scored: DataFrame, score_col: str = "p1", label_col: str = "label") -> DataFrame:
    """F-measure at every distinct score, counting scores at or above it as positive."""
    counts = _checkpointed(_counts(scored, score_col, label_col))
    positives = counts.agg(F.sum("positives")).first()[0]
    ranked = running_totals(counts, "threshold", ["positives", "negatives"], descending=True)
    predicted = F.col("cum_positives") + F.col("cum_negatives")
    return ranked.select("threshold", (2 * F.col("cum_positives") / (predicted + F.lit(positives)))
                         .alias("f_measure"))


def best_threshold(model: PipelineModel, train: DataFrame) -> float:
    """Threshold with the largest F-measure on ``train``, set on the fitted model.

    The measure counts scores at or above a threshold, the model predicts above it. The fitted
    model therefore gets the middle between this threshold and the next lower one.
    """
    measures = f_measures(score(model, train))
    best = measures.agg(F.max_by("threshold", F.struct("f_measure", "threshold")).alias("t")).first()["t"]
    below = measures.where(F.col("threshold") < best).agg(F.max("threshold")).first()[0]
    model.stages[-1].setThreshold((best + (below or 0.0)) / 2)
    return best


def confusion_value(scored: DataFrame, net_col: str) -> DataFrame:
    """Rows and summed net value per prediction and label."""
    return (scored.groupBy("prediction", "label")
            .agg(F.count(F.lit(1)).alias("loans"), F.sum(net_col).alias("sum_net")))


def business_value(confusion: DataFrame) -> DataFrame:
    """value = -(loss avoided - profit forfeited), from a confusion table."""
    def net(label: int):
        chosen = (F.col("prediction") == 1) & (F.col("label") == label)
        return F.coalesce(F.sum(F.when(chosen, F.col("sum_net"))), F.lit(0))
    return confusion.agg((-(net(1) - net(0))).alias("value"))


def publish_model(model: PipelineModel, root: str, name: str, stage: str) -> str:
    """Save a model under its name and stage; replaces the one published there before."""
    path = f"{root.rstrip('/')}/{name}/{stage}"
    model.write().overwrite().save(path)
    return path


def load_model(root: str, name: str, stage: str) -> PipelineModel:
    return PipelineModel.load(f"{root.rstrip('/')}/{name}/{stage}")


def _stage(model: PipelineModel, kind):
    return next(s for s in model.stages if isinstance(s, kind))


def linear_terms(model: PipelineModel) -> dict:
    """A fitted regression as weights: per category level, per numeric column, and an offset.

    Its size is the number of category levels seen in training.
    """
    regression, scaler = _stage(model, LogisticRegressionModel), _stage(model, StandardScalerModel)
    indexer, imputer = _stage(model, StringIndexerModel), _stage(model, ImputerModel)
    scales = [1 / s if s else 0.0 for s in scaler.std.toArray()]
    weights = [float(c * s) for c, s in zip(regression.coefficients.toArray(), scales)]
    offset = float(regression.intercept - sum(w * m for w, m in zip(weights, scaler.mean.toArray())))
    levels, position = {}, 0
    for column, labels in zip(CATEGORICALS, indexer.labelsArray):
        levels[column] = dict(zip(labels, weights[position:position + len(labels)]))
        position += len(labels)
    fill = imputer.surrogateDF.first()
    numbers = {n: (float(fill[n]), weights[position + i]) for i, n in enumerate(NUMERICS)}
    threshold = regression.getThreshold()
    cut = math.inf if threshold >= 1 else -math.inf if threshold <= 0 else math.log(threshold / (1 - threshold))
    return {"levels": levels, "numbers": numbers, "offset": offset, "cut": cut}


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_risk_function(spark: SparkSession, model: PipelineModel,
                           name: str = "loan_risk_prediction") -> None:
    """Register the regression as a SQL function of a struct of the ten features.

    The function is SQL itself, so Spark inlines it into the calling query: no Python worker.
    """
    terms, parts = linear_terms(model), []
    for column, weights in terms["levels"].items():
        value = f"loan.{column}"
        if column == "verification_status":
            value = f"trim(regexp_replace({value}, '{VERIFIED_ALIAS}', '{VERIFIED}'))"
        branches = " ".join(f"WHEN {_text(level)} THEN {weight!r}D"
                            for level, weight in weights.items() if weight)
        if branches:
            parts.append(f"CASE {value} {branches} ELSE 0D END")
    for column, (fill, weight) in terms["numbers"].items():
        present = f"CASE WHEN isnan(loan.{column}) THEN NULL ELSE loan.{column} END"
        parts.append(f"coalesce({present}, {fill!r}D) * {weight!r}D")
    margin = " + ".join([f"{terms['offset']!r}D", *parts])
    fields = ", ".join([*[f"{c}: STRING" for c in CATEGORICALS], *[f"{n}: DOUBLE" for n in NUMERICS]])
    cut = "double('{}')".format("Infinity" if terms["cut"] > 0 else "-Infinity") \
        if math.isinf(terms["cut"]) else f"{terms['cut']!r}D"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(loan STRUCT<{fields}>) RETURNS STRING "
              f"RETURN CASE WHEN {margin} > {cut} THEN '1.0' ELSE '0.0' END")


def _levels(column: str, values: pd.Series) -> pd.Series:
    if column == "verification_status":
        return values.str.replace(VERIFIED_ALIAS, VERIFIED, regex=False).str.strip(" ")
    return values


def tree_terms(spark: SparkSession, model: PipelineModel) -> dict:
    """Fitted boosted trees as arrays over their nodes, with what turns a loan into the trees' inputs.

    They are read from the model's saved form. Their size is bounded by the number of trees, their depth and ``maxBins``.
    """
    indexer, imputer = _stage(model, StringIndexerModel), _stage(model, ImputerModel)
    path = scratch_dir(spark, "trees")
    _stage(model, GBTClassificationModel).write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    weights = {r[0]: r[2] for r in spark.read.parquet(f"{path}/treesMetadata").collect()}
    place = {(r["treeID"], r["id"]): i for i, r in enumerate(nodes)}
    categories = max([r["split"]["numCategories"] for r in nodes], default=0)
    member = np.zeros((len(nodes), max(1, categories)), bool)
    threshold = np.full(len(nodes), np.nan)
    children = np.arange(len(nodes)).repeat(2).reshape(-1, 2)  # a leaf leads to itself
    for i, r in enumerate(nodes):
        split = r["split"]
        if r["leftChild"] < 0:
            continue
        children[i] = [place[r["treeID"], r["leftChild"]], place[r["treeID"], r["rightChild"]]]
        if split["numCategories"] < 0:
            threshold[i] = split["leftCategoriesOrThreshold"][0]
        else:
            member[i, [int(c) for c in split["leftCategoriesOrThreshold"]]] = True
    fill = imputer.surrogateDF.first()
    trees = sorted(weights)
    return {"levels": {c: {level: i for i, level in enumerate(labels)}
                       for c, labels in zip(CATEGORICALS, indexer.labelsArray)},
            "fill": {n: float(fill[n]) for n in NUMERICS},
            "feature": np.array([max(0, r["split"]["featureIndex"]) for r in nodes]), "threshold": threshold,
            "member": member, "children": children, "value": np.array([r["prediction"] for r in nodes]),
            "roots": np.array([place[t, 0] for t in trees]), "weights": np.array([weights[t] for t in trees])}


def _tree_margins(terms: dict, loan: pd.DataFrame) -> np.ndarray:
    """Weighted sum of the trees' values; all loans go down one level of one tree at a time."""
    inputs = []
    for column, levels in terms["levels"].items():
        # A level that training has not seen, or none, has the number after the last.
        inputs.append(_levels(column, loan[column]).map(levels).fillna(len(levels)).to_numpy(np.float64))
    for column, fill in terms["fill"].items():
        inputs.append(loan[column].astype("float64").fillna(fill).to_numpy())
    values, rows = np.stack(inputs, axis=1), np.arange(len(loan))
    total = np.zeros(len(loan))
    widest = terms["member"].shape[1] - 1
    for root, weight in zip(terms["roots"], terms["weights"]):
        at = np.full(len(loan), root)
        while True:
            value = values[rows, terms["feature"][at]]
            cut = terms["threshold"][at]
            left = np.where(np.isnan(cut), terms["member"][at, np.clip(value, 0, widest).astype(int)], value <= cut)
            below = terms["children"][at, np.where(left, 0, 1)]
            if (below == at).all():
                break
            at = below
        total += weight * terms["value"][at]
    return total


def _linear_margins(terms: dict, loan: pd.DataFrame) -> np.ndarray:
    margin = pd.Series(terms["offset"], index=loan.index, dtype="float64")
    for column, weights in terms["levels"].items():
        margin += _levels(column, loan[column]).map(weights).fillna(0.0).astype("float64")
    for column, (fill, weight) in terms["numbers"].items():
        margin += loan[column].astype("float64").fillna(fill) * weight
    return margin.to_numpy()


def loan_risk_udf(spark: SparkSession, model: PipelineModel):
    """A fitted model, regression or trees, as an Arrow pandas UDF of a struct of the ten features."""
    is_tree = any(isinstance(s, GBTClassificationModel) for s in model.stages)
    terms = tree_terms(spark, model) if is_tree else linear_terms(model)
    shared = spark.sparkContext.broadcast(terms)

    @F.pandas_udf("string")
    def predict(loan: pd.DataFrame) -> pd.Series:
        margin = _tree_margins(shared.value, loan) if is_tree else _linear_margins(shared.value, loan)
        cut = 0.0 if is_tree else shared.value["cut"]
        return pd.Series(np.where(margin > cut, "1.0", "0.0"), index=loan.index)

    return predict
