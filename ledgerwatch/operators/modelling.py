"""Modelling on Spark: exact stratified split, standard scaling, balanced
class weights, distributed forest training, model comparison by k-fold
cross-validation, and batch scoring. Data never leaves the cluster."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import params as P
from ..functions.numeric import round_to
from ..session import materialize, scratch_path
from ..sources import versions as V
from . import boosting as BO
from . import forest as FO
from .evaluation import classification_metrics, roc_auc
from .windows import prefix_sums

PART_ROWS = 500_000         # rows of a partition at most, on average, where every row is costly
SPLIT_MODULUS = 104729
SPLIT_MULTIPLIER = 7919


def split_key(id_col: str) -> F.Column:
    """Repeatable pseudo-random order key of a row id of any width; a null id
    has key 0."""
    return (F.coalesce(F.pmod(F.col(id_col), F.lit(SPLIT_MODULUS)), F.lit(0)) * SPLIT_MULTIPLIER) % SPLIT_MODULUS


def with_class_rank(df: DataFrame, y: str = "is_fraud", id_col: str = "transaction_id") -> DataFrame:
    """Adds ``_rank``, 1 to n_class within each class in key order (key, then
    id; rows without id, or that repeat one, by a hash of the row), and ``_n``,
    the rows of the class. Rows without a class are a class of their own.

    The rank is a distributed prefix count over ranges of that order, written
    once, so no task holds a class, a key value or all rows without id; the
    class sizes, one row per class, are broadcast.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    d = df.withColumns({"_b": split_key(id_col), "_row": row, "_one": F.lit(1).cast("long")})
    d = prefix_sums(d, [y], [F.col("_b"), F.col(id_col).asc_nulls_first(), F.col("_row")], ["_one"], "class-rank")
    sizes = d.groupBy(F.col(y).alias("_class")).agg(F.count(F.lit(1)).alias("_n"))
    d = d.join(F.broadcast(sizes), F.col(y).eqNullSafe(F.col("_class")))
    return d.withColumn("_rank", F.col("_before__one") + 1).drop("_b", "_row", "_one", "_before__one", "_class")


def stratified_split(df: DataFrame, y: str = "is_fraud", id_col: str = "transaction_id",
                     test_fraction: float = 0.2) -> DataFrame:
    """M1: per class, exactly ``ceil(test_fraction · n_class)`` rows go to
    ``test`` — the first ones in key order — the rest to ``train``. Adds
    ``split``."""
    d = with_class_rank(df, y, id_col)
    return d.withColumn("split", F.when(F.col("_rank") <= F.ceil(F.col("_n") * F.lit(test_fraction)), "test").otherwise("train")).drop("_rank", "_n")


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over at least as many partitions as there are cores,
    for work that is costly by row. A split or a class of a table that was
    ranked by ranges lies in a few of its files."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // PART_ROWS))
    return df.repartition(parts)


def fit_scaler(train: DataFrame, features: list[str]) -> DataFrame:
    """M2 fit: one row of per-feature mean and population std."""
    return train.agg(*[F.avg(f).alias(f"_mu_{f}") for f in features],
                     *[F.stddev_pop(f).alias(f"_sd_{f}") for f in features])


def apply_scaler(df: DataFrame, stats: DataFrame, features: list[str]) -> DataFrame:
    """M2 apply: ``(x − mean) / std`` (a zero std scales by 1), the one-row
    statistics broadcast to every task."""
    j = df.crossJoin(F.broadcast(stats))
    out = [F.col(c) for c in df.columns if c not in features]
    for f in features:
        sd = F.col(f"_sd_{f}")
        out.append(((F.col(f) - F.col(f"_mu_{f}")) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)).alias(f))
    return j.select(*out)


def with_class_weight(df: DataFrame, y: str = "is_fraud") -> DataFrame:
    """M5 as a column: balanced weight n / (2 · n_class), from a per-class
    aggregate (one row per class, broadcast)."""
    counts = df.groupBy(y).agg(F.count(F.lit(1)).alias("_nc"))
    w = Window.partitionBy(F.lit(1))
    weights = counts.select(y, (F.sum("_nc").over(w) / (F.lit(2.0) * F.col("_nc"))).alias("class_weight"))
    return df.join(F.broadcast(weights), y)


def forest(num_trees: int = 200, max_depth: int = 15, seed: int = 42) -> RandomForestClassifier:
    """M3: the reference forest (200 trees, depth 15, balanced weights). Rows
    keep the node they reached in each tree between passes, so no pass walks
    the trees from their roots again."""
    return RandomForestClassifier(featuresCol="features", labelCol="is_fraud", weightCol="class_weight",
                                  numTrees=num_trees, maxDepth=max_depth, seed=seed, cacheNodeIds=True)


def without_summary(model):
    """The fitted model without its training summary. The summary holds the
    session, which can't go to tasks with the model once the session has
    observed a write's metrics."""
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return model


def fit_estimator(estimator, train: DataFrame, features: list[str], assembler: VectorAssembler):
    """The fitted estimator; forests and boosted trees of large tables are
    grown over binned rows."""
    grower = next((g for g in (FO, BO) if g.takes(estimator)), None)
    return without_summary(grower.fit(estimator, train, features, assembler.transform) if grower else estimator.fit(assembler.transform(train)))


def fit_pipeline(train: DataFrame, estimator, features: list[str] = P.MODEL_FEATURES) -> PipelineModel:
    """Assemble the model features in their fixed order and fit. Trees do not
    need scaling; linear models standardise internally."""
    asm = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    return PipelineModel([asm, fit_estimator(estimator, with_class_weight(train), features, asm)])


def score_batch(model: PipelineModel, df: DataFrame, version: str = "forest-v1") -> DataFrame:
    """M6: prediction, fraud probability (4 places), risk tier, version."""
    out = model.transform(df)
    p = vector_to_array(F.col("probability"))[1]
    return out.select("transaction_id", "is_fraud", F.col("prediction").cast("int").alias("prediction"),
                      round_to(p, 4).alias("fraud_probability"),
                      F.when(p > P.TIER_HIGH, "HIGH").when(p > P.TIER_MEDIUM, "MEDIUM").otherwise("LOW").alias("risk_level"),
                      F.lit(version).alias("model_version"), p.alias("score"))


def publish_model(spark: SparkSession, model: PipelineModel, store: str, name: str = "forest", **facts) -> int:
    """Save a fitted pipeline as the next version of the model store; scorers
    see it once its marker is created."""
    return V.commit(spark, f"{store}/{name}", lambda folder: model.write().save(folder), facts)


def load_model(spark: SparkSession, store: str, name: str = "forest", version: int | None = None) -> tuple[PipelineModel, str] | None:
    """(the saved pipeline, ``name-v<version>``): the newest version or the one
    named; None where nothing was published."""
    found = V.latest(spark, f"{store}/{name}") if version is None else (version, V.note(spark, f"{store}/{name}", version))
    return None if found is None else (PipelineModel.load(found[1]["folder"]), f"{name}-v{found[0]}")


def evaluate(scored: DataFrame) -> DataFrame:
    """Accuracy, FPR, F1, precision, recall and ROC AUC of a scored frame."""
    m = classification_metrics(scored)
    return m.crossJoin(roc_auc(scored).select("roc_auc")).select(
        "n", "accuracy", "false_positive_rate", "f1_score", "precision", "recall", "roc_auc")


def comparison_models(rows: float, seed: int = 42) -> dict[str, object]:
    """M4: the three compared estimators with their settings, for training
    on rows of total weight ``rows``. The logistic regression has an L2
    penalty of half the squared weights beside the summed weighted loss
    (Spark divides that sum by the total weight) and takes the inputs as they
    are scaled."""
    return {
        "LogisticRegression": LogisticRegression(featuresCol="features", labelCol="is_fraud", weightCol="class_weight", maxIter=1000,
                                                 regParam=1.0 / max(rows, 1.0), elasticNetParam=0.0, standardization=False),
        "GradientBoosting": GBTClassifier(featuresCol="features", labelCol="is_fraud", maxIter=100, maxDepth=3,
                                          stepSize=0.1, seed=seed),
        "RandomForest": forest(seed=seed),
    }


def comparison_table(df: DataFrame, folds: int, features: list[str] = P.MODEL_FEATURES) -> DataFrame:
    """M4's input, written once: label, balanced class weight, the features
    standardised over all rows and ``_fold`` (0 to ``folds`` - 1). Every fold
    gets each class's share to within a row. Partitioned by fold, so that a
    fit or a test reads its folds' files only."""
    d = with_class_rank(df.select("transaction_id", F.col("is_fraud").cast("int").alias("is_fraud"), *[F.col(f).cast("double").alias(f) for f in features]))
    ranked = materialize(with_class_weight(d.withColumn("_fold", ((F.col("_rank") - 1) % folds).cast("int")).drop("_rank", "_n")), "ranked")
    path = scratch_path(df.sparkSession, "folds")
    apply_scaler(ranked, fit_scaler(ranked, features), features).write.partitionBy("_fold").parquet(path)
    return df.sparkSession.read.schema(ranked.schema).parquet(path)


def model_comparison(df: DataFrame, folds: int = 5, seed: int = 42, models: dict | None = None,
                     parallelism: int = 4) -> DataFrame:
    """M4: stratified k-fold cross-validated accuracy and positive-class F1
    per model, both from one fit per fold. The fold fits are submitted
    concurrently (each fit is itself a distributed job); what reaches the
    driver is two numbers a fit. (The built-in cross-validator checks its fold
    column by a Python function on every row and knows one metric a fit.)"""
    table = comparison_table(df, folds)
    models = models or comparison_models(table.count() * (folds - 1) / folds, seed)
    asm = VectorAssembler(inputCols=P.MODEL_FEATURES, outputCol="features", handleInvalid="keep")
    jobs = [(name, k) for name in models for k in range(folds)]

    def run(job):
        name, k = job
        model = fit_estimator(models[name].copy(), table.where(F.col("_fold") != k), P.MODEL_FEATURES, asm)
        pred = model.transform(asm.transform(table.where(F.col("_fold") == k))).withColumn("prediction", F.col("prediction").cast("int"))
        m = classification_metrics(pred).first()
        return name, k, float(m["accuracy"]), float(m["f1_score"])

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        results = list(pool.map(run, jobs))
    rows = df.sparkSession.createDataFrame(results, "model string, fold int, accuracy double, f1_score double")
    return rows.groupBy("model").agg(F.avg("accuracy").alias("accuracy"), F.avg("f1_score").alias("f1_score"),
                                     F.count(F.lit(1)).alias("folds"))


def bounded_sample(df: DataFrame, k: int = 200, seed: int = 42, id_col: str = "transaction_id") -> DataFrame:
    """K8: a repeatable sample of exactly ``min(k, n)`` rows — the ``k``
    smallest by a seeded hash of the id. Runs as a distributed top-k
    (each task keeps its k best, the driver merges k × tasks rows)."""
    h = F.xxhash64(F.col(id_col), F.lit(seed))
    return df.withColumn("_h", h).orderBy("_h", id_col).limit(k).drop("_h")


def model_matrix(features: DataFrame, cols: list[str] = P.MODEL_FEATURES) -> DataFrame:
    """The model features in their fixed order plus the assembled
    vector."""
    asm = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")
    return asm.transform(features.select("transaction_id", "is_fraud", *cols))
