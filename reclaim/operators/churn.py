"""B. Churn scoring.

Scoring is a projection.  Evaluation never sorts the data globally: the
threshold sweep and the confusion counts come from a histogram of at most
62 threshold buckets, AUC from a range-partitioned rank sum of the unrounded
score.  A histogram variant of AUC works on the 4-digit score.
Training is MLlib logistic regression (distributed L-BFGS).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dims import RISK_BINS
from ..functions.exprs import attach, precise_sum, rnd
from ..session import delete_tables, ensure_checkpoint_dir

LOGIT_CLIP = 35.0
TRAIN_SHARE = 78  # percent of customers in the training split
SPLIT_SALT = 11
SCORE_DIGITS = 4

NUMERIC_FEATURES = [
    "tenure_months",
    "active_subscriptions",
    "monthly_revenue",
    "discount_rate",
    "support_tickets_90d",
    "late_shipments_90d",
    "email_engagement",
    "avg_days_between_orders",
]
CATEGORICAL_FEATURES = ["brand", "region", "acquisition_channel", "plan"]


def thresholds(start: float = 0.15, stop: float = 0.75, num: int = 61) -> list[float]:
    """The sweep grid, evaluated exactly like an evenly spaced float grid
    (``i * step + start``, last point pinned to ``stop``)."""
    return [float(t) for t in np.linspace(start, stop, num)]


def sigmoid(z: Column) -> Column:
    clipped = F.greatest(F.lit(-LOGIT_CLIP), F.least(F.lit(LOGIT_CLIP), z))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-clipped))


def risk_segment(score: Column) -> Column:
    """Right-closed bins with the lowest edge included; outside -> NULL."""
    out = F.when((score < 0) | (score > RISK_BINS[-1][0]), F.lit(None).cast("string"))
    for upper, label in RISK_BINS:
        out = out.when(score <= upper, label)
    return out


def score_customers(customers: DataFrame, logit: Column) -> DataFrame:
    """Add ``churn_risk_score`` (4 digits) and ``risk_segment``."""
    scored = customers.withColumn("churn_risk_score", rnd(sigmoid(logit), SCORE_DIGITS))
    return scored.withColumn("risk_segment", risk_segment(F.col("churn_risk_score")))


def split_bucket(customer_id: Column) -> Column:
    """Deterministic 0..99 bucket per customer of any id type, from the md5
    of the id's text: reproducible and computed row by row (no sort, no
    driver-side permutation), even for ids that step by a fixed amount."""
    digest = F.md5(F.concat(customer_id.cast("string"), F.lit(f"|{SPLIT_SALT}")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(100))


def is_holdout(df: DataFrame, id_col: str = "customer_id") -> Column:
    """The 22 % evaluation split (B2).  Every customer is still scored; the
    split only decides which customers the quality metrics are measured
    on, and it grows with the data."""
    return split_bucket(F.col(id_col)) >= TRAIN_SHARE


def _threshold_buckets(df: DataFrame, prob: str, label: str, grid: list[float]) -> DataFrame:
    """Counts per (bucket, label); bucket = number of grid points <= p, so
    p >= t_i exactly when bucket > i."""
    arr = F.array(*[F.lit(t) for t in grid])
    bucket = F.size(F.filter(arr, lambda t: F.col(prob) >= t))
    return df.groupBy(bucket.alias("bucket")).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) == 0).alias("neg"),
    )


def threshold_sweep(df: DataFrame, prob: str = "probability", label: str = "churned",
                    grid: list[float] | None = None) -> DataFrame:
    """Confusion counts and F1 for every grid threshold (<= 61 rows)."""
    grid = grid or thresholds()
    hist = _threshold_buckets(df, prob, label, grid)
    idx = F.explode(F.sequence(F.lit(0), F.lit(len(grid) - 1))).alias("i")
    per = hist.select("bucket", "pos", "neg", idx)
    above = F.col("bucket") > F.col("i")
    sweep = per.groupBy("i").agg(
        F.sum(F.when(above, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(above, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~above, F.col("pos")).otherwise(0)).alias("fn"),
        F.sum(F.when(~above, F.col("neg")).otherwise(0)).alias("tn"),
    )
    grid_col = F.array(*[F.lit(t) for t in grid])
    precision = F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1))
    recall = F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), F.lit(1))
    return (
        sweep.withColumn("threshold", F.element_at(grid_col, F.col("i") + 1))
        .withColumn("precision", precision)
        .withColumn("recall", recall)
        .withColumn(
            "f1",
            F.lit(2.0) * F.col("precision") * F.col("recall")
            / F.greatest(F.col("precision") + F.col("recall"), F.lit(1e-12)),
        )
    )


def best_threshold(df: DataFrame, prob: str = "probability", label: str = "churned") -> DataFrame:
    """The grid point with the highest F1; ties go to the lowest."""
    best = threshold_sweep(df, prob, label).orderBy(F.col("f1").desc(), F.col("i").asc()).limit(1)
    return best.select(
        rnd("threshold", 4).alias("decision_threshold"),
        rnd("f1", 4).alias("best_f1"),
        F.col("tp").alias("true_positives"),
        F.col("fp").alias("false_positives"),
        F.col("fn").alias("false_negatives"),
        F.col("tn").alias("true_negatives"),
    )


def _score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """Positives and negatives of every different score."""
    return df.groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) == 0).alias("neg"),
    )


def roc_auc(df: DataFrame, score: str = "logit", label: str = "churned") -> DataFrame:
    """B10 on the unrounded score: Mann-Whitney with tied scores sharing
    their average rank.  The different scores are sorted by range
    partitions; a running sum inside each partition plus the partitions'
    totals (one row per partition) gives the negatives below each score."""
    from ..session import materialize

    counts = _score_counts(df, score, label).orderBy(score)
    counts = materialize(counts.withColumn("part", F.spark_partition_id()), "auc_scores")
    totals = counts.groupBy("part").agg(F.sum("neg").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("below", F.coalesce(F.sum("neg").over(inside), F.lit(0))).join(F.broadcast(offsets), "part")
    return _auc(ranked.withColumn("neg_below", F.col("below") + F.col("offset")))


def roc_auc_histogram(df: DataFrame, score: str = "churn_risk_score", label: str = "churned") -> DataFrame:
    """AUC of the published 4-digit score: its histogram has at most 10,001
    rows, so the running sum over it is bounded."""
    w = Window.orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    return _auc(_score_counts(df, score, label).withColumn("neg_below", F.coalesce(F.sum("neg").over(w), F.lit(0))))


def _auc(ranked: DataFrame) -> DataFrame:
    """AUC from (pos, neg, neg_below) per different score; products of counts
    are decimals, so that billions of customers do not overflow."""
    big = lambda c: F.col(c).cast("decimal(18,0)")
    totals = ranked.agg(
        F.sum(F.lit(2) * big("pos") * big("neg_below") + big("pos") * big("neg")).alias("twice_wins"),
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
    )
    pairs = big("n_pos") * big("n_neg")
    return totals.select(
        F.when(F.coalesce(pairs, F.lit(0)) == 0, F.lit(0.5))
        .otherwise(F.col("twice_wins").cast("double") / F.lit(2.0) / pairs.cast("double"))
        .alias("roc_auc"),
        F.coalesce(F.col("n_pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.col("n_neg"), F.lit(0)).alias("negatives"),
    )


def classification_metrics(holdout: DataFrame, prob: str = "probability", label: str = "churned",
                           score: str = "logit") -> DataFrame:
    """One row of hold-out metrics at the best-F1 threshold."""
    best = threshold_sweep(holdout, prob, label).orderBy(F.col("f1").desc(), F.col("i").asc()).limit(1)
    n = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    metrics = best.select(
        rnd((F.col("tp") + F.col("tn")) / F.greatest(n, F.lit(1)), 4).alias("accuracy"),
        rnd("precision", 4).alias("precision"),
        rnd("recall", 4).alias("recall"),
        rnd("f1", 4).alias("f1"),
        rnd("threshold", 4).alias("decision_threshold"),
        F.col("tp").alias("true_positives"),
        F.col("tn").alias("true_negatives"),
        F.col("fp").alias("false_positives"),
        F.col("fn").alias("false_negatives"),
    )
    auc = roc_auc(holdout, score, label).select(rnd("roc_auc", 4).alias("roc_auc"))
    return attach(metrics, auc)


def top_risk(scored: DataFrame, n: int = 100) -> DataFrame:
    """The n riskiest customers (ties by id)."""
    return scored.orderBy(F.col("churn_risk_score").desc(), F.col("customer_id").asc()).limit(n)


# ---------------------------------------------------------------------------
# Model training with MLlib
# ---------------------------------------------------------------------------

def _feature_stages(numeric: list[str], categorical: list[str]):
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    # Descending alphabetical index + dropLast makes the alphabetically first
    # level the all-zero reference level (drop-first dummy coding).
    idx = StringIndexer(
        inputCols=categorical, outputCols=[f"{c}__idx" for c in categorical], stringOrderType="alphabetDesc"
    )
    ohe = OneHotEncoder(
        inputCols=[f"{c}__idx" for c in categorical],
        outputCols=[f"{c}__ohe" for c in categorical],
        dropLast=True,
    )
    asm = VectorAssembler(inputCols=numeric + [f"{c}__ohe" for c in categorical], outputCol="features")
    return [idx, ohe, asm]


def train_churn_model(customers: DataFrame, reg: float = 0.01, max_iter: int = 200):
    """Dummy coding is fitted on all customers (every level known,
    as when dummies are built before the split); the regression is fitted
    on the training split only.  Returns a PipelineModel.

    Training rows are persisted for the L-BFGS passes and released after.
    """
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression

    data = customers.withColumn("label", F.col("churned").cast("double"))
    features = Pipeline(stages=_feature_stages(NUMERIC_FEATURES, CATEGORICAL_FEATURES)).fit(data)
    lr = LogisticRegression(
        featuresCol="features",
        labelCol="label",
        regParam=reg,
        elasticNetParam=0.0,
        standardization=True,
        fitIntercept=True,
        maxIter=max_iter,
        tol=1e-10,
    )
    train = features.transform(data.where(~is_holdout(data))).select("features", "label").persist()
    try:
        fitted = lr.fit(train)
    finally:
        train.unpersist()
    return PipelineModel(stages=[*features.stages, _without_summary(fitted)])


def _without_summary(fitted):
    """The fitted regression, written to the checkpoint folder and read back.
    A model fresh from training holds its training summary, and with it the
    session, which cannot go to tasks once metrics have been observed."""
    import uuid

    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.sql import SparkSession

    path = f"{ensure_checkpoint_dir(SparkSession.active()).rstrip('/')}/reclaim-tables/model-{uuid.uuid4().hex}"
    fitted.write().overwrite().save(path)
    out = LogisticRegressionModel.load(path)
    delete_tables(SparkSession.active(), [path])
    return out


def feature_names(model) -> list[str]:
    """Names of the assembled vector slots: numeric names, then
    ``<column>_<level>`` for each kept dummy."""
    stages = model.stages
    names = list(NUMERIC_FEATURES)
    indexer = next(s for s in stages if type(s).__name__ == "StringIndexerModel")
    for c, labels in zip(CATEGORICAL_FEATURES, indexer.labelsArray):
        names.extend(f"{c}_{lvl}" for lvl in list(labels)[:-1])  # descending order; the last one is dropped
    return names


def churn_train_score(customers: DataFrame, model=None) -> DataFrame:
    """Score every customer (train and hold-out) with the fitted model."""
    from pyspark.ml.functions import vector_to_array

    model = model or train_churn_model(customers)
    out = model.transform(customers.withColumn("label", F.col("churned").cast("double")))
    prob = vector_to_array(F.col("probability")).getItem(1)
    scored = out.select(*customers.columns, rnd(prob, SCORE_DIGITS).alias("churn_risk_score"))
    return scored.withColumn("risk_segment", risk_segment(F.col("churn_risk_score")))


def model_drivers(customers: DataFrame, model=None, top: int = 12) -> DataFrame:
    """Coefficients on the standardized scale (original-scale weight x
    population std of the training feature), largest magnitude first."""
    from pyspark.ml.functions import vector_to_array

    model = model or train_churn_model(customers)
    lr = model.stages[-1]
    names = feature_names(model)
    data = customers.withColumn("label", F.col("churned").cast("double"))
    feats = model.transform(data.where(~is_holdout(data))).select(vector_to_array("features").alias("v"))
    n = len(names)
    stds = feats.agg(*[F.stddev_pop(F.col("v")[i]).alias(f"s{i}") for i in range(n)])
    coefs = [float(x) for x in lr.coefficients.toArray()]
    spark = customers.sparkSession
    weights = spark.createDataFrame([(i, names[i], coefs[i]) for i in range(n)], "i int, feature string, w double")
    sd = stds.select(F.posexplode(F.array(*[F.col(f"s{i}") for i in range(n)])).alias("i", "sd"))
    return (
        weights.join(F.broadcast(sd), "i")
        .select("feature", (F.col("w") * F.col("sd")).alias("coefficient"))
        .orderBy(F.abs("coefficient").desc(), F.col("feature").asc())
        .limit(top)
    )


def dummy_table(customers: DataFrame) -> DataFrame:
    """customer_id, churned, is_train and the feature values by name, as one
    map per customer: numeric features and a 0/1 value for each level of a
    categorical one but the alphabetically first (B1)."""
    levels = customers.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in CATEGORICAL_FEATURES]).first()
    pairs = [(c, F.col(c).cast("double")) for c in NUMERIC_FEATURES]
    for c in CATEGORICAL_FEATURES:
        pairs += [(f"{c}_{v}", (F.col(c) == v).cast("double")) for v in levels[c][1:]]
    features = F.map_from_arrays(F.array(*[F.lit(n) for n, _ in pairs]), F.array(*[x for _, x in pairs]))
    return customers.select("customer_id", F.col("churned").cast("double").alias("churned"), (~is_holdout(customers)).alias("is_train"), features.alias("features"))


def feature_table(customers: DataFrame) -> DataFrame:
    """Every feature with its mean and population std over the
    training customers."""
    long = dummy_table(customers).where("is_train").select(F.explode("features").alias("feature", "value"))
    n, value = F.count("value"), F.col("value")
    mean = precise_sum(value) / n
    # Exact sums of the values and their squares do not depend on row order.
    spread = F.sqrt(F.greatest(F.lit(0.0), precise_sum(value * value) / n - mean * mean))
    return long.groupBy("feature").agg(n.alias("customers"), rnd(mean, 6).alias("train_mean"), rnd(spread, 4).alias("train_std"))


def stationarity(customers: DataFrame, reg: float = 0.01, digits: int = 3) -> DataFrame:
    """Gradient of the penalized loss at the fitted weights, per
    standardized feature and for the intercept; a fitted model has none, so
    every rounded value is 0."""
    from pyspark.ml.functions import vector_to_array

    model = train_churn_model(customers, reg)
    names = feature_names(model)
    weights = [float(w) for w in model.stages[-1].coefficients.toArray()]
    data = customers.where(~is_holdout(customers)).withColumn("label", F.col("churned").cast("double"))
    rows = model.transform(data).select(
        vector_to_array("features").alias("x"), (vector_to_array("probability").getItem(1) - F.col("label")).alias("error")
    )
    n = len(names)
    stats = rows.agg(
        F.avg("error").alias("g"),
        *[F.avg(F.col("error") * F.col("x")[i]).alias(f"g{i}") for i in range(n)],
        *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(n)],
    ).first()  # one row

    def slope(i: int) -> float:
        s = stats[f"s{i}"]
        return stats[f"g{i}"] / s + reg * weights[i] * s if s else 0.0

    values = [("intercept", stats["g"])] + [(names[i], slope(i)) for i in range(n)]
    return customers.sparkSession.createDataFrame(
        [(name, round(v, digits) + 0.0) for name, v in values], "feature string, gradient double"
    )


def model_holdout(customers: DataFrame, model) -> DataFrame:
    """Hold-out customers with the model's unrounded probability (for the
    threshold sweep) and the 4-digit score (for AUC)."""
    from pyspark.ml.functions import vector_to_array

    data = customers.where(is_holdout(customers)).withColumn("label", F.col("churned").cast("double"))
    prob = vector_to_array(F.col("probability")).getItem(1)
    logit = vector_to_array(F.col("rawPrediction")).getItem(1)
    out = model.transform(data).select(*customers.columns, prob.alias("probability"), logit.alias("logit"))
    return out.withColumn("churn_risk_score", rnd("probability", SCORE_DIGITS))
