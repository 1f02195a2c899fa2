"""Purchase-propensity model: impute, scale, split, train, evaluate, score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import half_up
from ..schemas import FEATURES, LABEL
from .kpis import share
from .ranks import quantiles, ranking_metrics

KEYS = ["user_id", "prediction_date"]
#: Weight of the squared coefficients, and the largest slope of the loss that counts as its minimum.
REG, OPTIMAL = 0.01, 1e-5


def impute(df: DataFrame, cols: Sequence[str] = FEATURES, fill: float = 0.0) -> DataFrame:
    """Null and NaN become ``fill``; every feature comes out as double."""
    filled = {
        c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(fill)), F.lit(fill)) for c in cols
    }
    return df.withColumns(filled)


def scaling_pipeline(cols: Sequence[str] = FEATURES) -> Pipeline:
    assembler = VectorAssembler(
        inputCols=list(cols), outputCol="raw_features", handleInvalid="keep"
    )
    scaler = StandardScaler(
        inputCol="raw_features", outputCol="features", withMean=True, withStd=True
    )
    return Pipeline(stages=[assembler, scaler])


def prepare(
    df: DataFrame, model: PipelineModel | None = None, cols: Sequence[str] = FEATURES
) -> tuple[DataFrame, PipelineModel]:
    """Scaled feature vectors, with the fitted (or given) scaling pipeline."""
    clean = impute(df, cols)
    model = model or scaling_pipeline(cols).fit(clean)
    keep = [c for c in [*KEYS, "features", LABEL] if c == "features" or c in df.columns]
    return model.transform(clean).select(*keep), model


def split(
    df: DataFrame, train_percent: int = 80, keys: Sequence[str] = KEYS
) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the row's key: the same row always lands on the same side."""
    digest = F.substring(F.md5(F.concat_ws("|", *keys)), 1, 8)
    bucket = F.pmod(F.conv(digest, 16, 10).cast("bigint"), F.lit(100))
    return df.filter(bucket < train_percent), df.filter(bucket >= train_percent)


def random_split(
    df: DataFrame, train: float = 0.8, test: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Seeded random split. The draw depends on partitioning; ``split`` does not."""
    first, second = df.randomSplit([train, test], seed=seed)
    return first, second


def train(
    df: DataFrame, max_iter: int = 100, reg: float = REG, elastic_net: float = 0.0, tol: float = 1e-9
) -> LogisticRegressionModel:
    lr = LogisticRegression(
        featuresCol="features",
        labelCol=LABEL,
        maxIter=max_iter,
        regParam=reg,
        elasticNetParam=elastic_net,
        tol=tol,
    )
    return lr.fit(df)


def score(df: DataFrame, scaler: PipelineModel, model: LogisticRegressionModel) -> DataFrame:
    """Add ``purchase_probability`` (class 1) and ``prediction`` to the feature rows."""
    scored = model.transform(scaler.transform(impute(df)))
    return scored.withColumn("purchase_probability", vector_to_array("probability")[1]).drop(
        "raw_features", "features", "rawPrediction", "probability"
    )


def save(scaler: PipelineModel, model: LogisticRegressionModel, path: str) -> None:
    scaler.write().overwrite().save(f"{path}/scaler")
    model.write().overwrite().save(f"{path}/classifier")


def load(path: str) -> tuple[PipelineModel, LogisticRegressionModel]:
    scaler = PipelineModel.load(f"{path}/scaler")
    return scaler, LogisticRegressionModel.load(f"{path}/classifier")


def confusion(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    """The four confusion counts in one pass."""
    yes, hit = F.col(label) == 1, F.col("prediction") == 1
    no, miss = F.col(label) == 0, F.col("prediction") == 0
    return predictions.agg(
        F.count_if(yes & hit).alias("true_positive"),
        F.count_if(no & hit).alias("false_positive"),
        F.count_if(no & miss).alias("true_negative"),
        F.count_if(yes & miss).alias("false_negative"),
    )


def class_metrics(counts: DataFrame) -> DataFrame:
    """F1, precision and recall weighted by class, and accuracy, from the four counts."""
    tp, fp = F.col("true_positive"), F.col("false_positive")
    tn, fn = F.col("true_negative"), F.col("false_negative")
    n = tp + fp + tn + fn

    def over(num, den):
        return F.when(den > 0, num / den).otherwise(0.0)

    def weighted(pos, neg):
        return half_up(over(pos * (tp + fn) + neg * (tn + fp), n), 4)

    f1_pos, f1_neg = over(2 * tp, 2 * tp + fp + fn), over(2 * tn, 2 * tn + fn + fp)
    return counts.select(
        weighted(f1_pos, f1_neg).alias("f1"),
        weighted(over(tp, tp + fp), over(tn, tn + fn)).alias("precision"),
        weighted(over(tp, tp + fn), over(tn, tn + fp)).alias("recall"),
        half_up(over(tp + tn, n), 4).alias("accuracy"),
    )


def evaluate(predictions: DataFrame) -> DataFrame:
    """One row: both areas under curve, exact, plus the class metrics, four decimals each.

    ``predictions`` is read twice, so hand in a materialised frame.
    """
    areas = ranking_metrics(predictions, "purchase_probability", LABEL).first()
    return class_metrics(confusion(predictions)).select(
        F.lit(areas["auc_roc"]).cast("double").alias("auc_roc"), F.lit(areas["auc_pr"]).cast("double").alias("auc_pr"), "*"
    )


def gradient(vectors: DataFrame, model: LogisticRegressionModel, reg: float = REG, names: Sequence[str] = FEATURES) -> DataFrame:
    """(feature, gradient): the slope of the regularised loss at the fitted weights, in one pass.

    The loss is the mean log loss plus ``reg`` / 2 times the squared weights, the intercept
    being free. At its only minimum every slope is zero, so small slopes certify the fit.
    """
    x = vector_to_array("features")
    weights = [float(w) for w in model.coefficients]
    logit = F.lit(float(model.intercept))
    for k, w in enumerate(weights):
        logit = logit + x[k] * F.lit(w)
    residual = F.lit(1.0) / (F.lit(1.0) + F.exp(-logit)) - F.col(LABEL)
    slopes = [F.avg(residual * x[k]) + F.lit(reg * w) for k, w in enumerate(weights)]
    wide = vectors.agg(*[s.alias(f"g{k}") for k, s in enumerate(slopes)], F.avg(residual).alias("free"))
    rows = [F.struct(F.lit(n).alias("feature"), F.col(f"g{k}").alias("gradient")) for k, n in enumerate(names)]
    free = F.struct(F.lit("intercept").alias("feature"), F.col("free").alias("gradient"))
    return wide.select(F.inline(F.array(*rows, free)))


def importance(
    spark, model: LogisticRegressionModel, names: Sequence[str] = FEATURES
) -> DataFrame:
    """Coefficients by absolute size; one row per model input."""
    rows = [(n, round(float(c), 4)) for n, c in zip(names, model.coefficients, strict=True)]
    rows.sort(key=lambda r: -abs(r[1]))
    return spark.createDataFrame(rows, "feature string, coefficient double")


def label_balance(features: DataFrame) -> DataFrame:
    counts = features.groupBy(LABEL).agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("share_pct", share("rows"))


def describe(df: DataFrame, cols: Sequence[str] = FEATURES) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column, long form.

    The quartiles are exact: the least value with at least that share of the rows up to it.
    ``df`` is read twice.
    """
    stats = {
        "count": lambda c: F.count(c).cast("double"),
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    wide = typed.agg(*[f(c).alias(f"{c}|{s}") for c in cols for s, f in stats.items()])
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                *[F.round(F.col(f"{c}|{s}"), 6).alias(s) for s in stats],
            )
            for c in cols
        ]
    )
    quarter = lambda q: F.max(F.when(F.col("q") == q, F.col("value")))
    quartiles = quantiles(typed, cols, [0.25, 0.5, 0.75]).groupBy("feature").agg(
        quarter(0.25).alias("q1"), quarter(0.5).alias("median"), quarter(0.75).alias("q3")
    )
    return wide.select(F.inline(entries)).join(quartiles, "feature", "left")
