"""Customer segments and churn scores on distributed features.

Only model parameters reach the driver. Both functions return None instead of a result when
there is nothing to learn from; the caller then leaves earlier results in place.
"""

from __future__ import annotations

import logging

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.clustering import kmeans, nearest
from tidemark.operators.features import churn_label
from tidemark.plans.staging import SNAPSHOT

log = logging.getLogger(__name__)

FEATURES = ("recency_days", "frequency", "monetary")

# Label of each segment id, ids from the weakest to the strongest segment,
# and training parameters.
SEGMENT_LABELS = {0: "At Risk", 1: "Loyal", 2: "Promising", 3: "Champion"}
SEGMENT_ORDER = (0, 2, 1, 3)
RESTARTS = 10
SEED = 42
SEGMENT_ITERATIONS = 300
CHURN_ITERATIONS = 500
HIGH_RISK = 0.5

# Centres that move less than this, in scaled units, have settled; the loss that changes by
# less than this share has.
SEGMENT_TOLERANCE = 1e-6
CHURN_TOLERANCE = 1e-13


def _scaler(df: DataFrame) -> SQLTransformer | None:
    """Stage that standardises the features by their population statistics; None if no rows."""
    stats = [F.count(F.lit(1)).alias("n")]
    for c in FEATURES:
        value = F.col(c).cast("double")
        stats += [F.avg(value).alias(f"mean_{c}"), F.stddev_pop(value).alias(f"dev_{c}")]
    found = df.agg(*stats).first()
    if found["n"] == 0:
        return None
    scaled = [
        f"({c} - {found[f'mean_{c}']!r}D) / {(found[f'dev_{c}'] or 1.0)!r}D AS {c}_z"
        for c in FEATURES
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__")


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=[f"{c}_z" for c in FEATURES], outputCol="features")


def customer_segments(rfm: DataFrame, keep: list[str]) -> DataFrame | None:
    """Four k-means clusters, best of ten starts, numbered by the value of their centre.

    A centre's value is frequency plus monetary minus recency in scaled units, so a segment
    id means the same on every day. Fewer than four different customers make fewer clusters.
    All starts share each pass over the features. A feature that is NULL is an error.
    """
    scaler = _scaler(rfm)
    if scaler is None:
        log.warning("no features; nothing to segment")
        return None
    scaled = [f"{c}_z" for c in FEATURES]
    points = scaler.transform(rfm)
    missing = F.raise_error(F.lit("a feature is missing")).cast("double")
    points = points.select(*keep, *FEATURES, *[F.coalesce(F.col(c), missing).alias(c) for c in scaled])
    held = points.select(*scaled).persist()
    try:
        # Also fills the cache, before the starts share it.
        distinct = held.distinct().limit(len(SEGMENT_LABELS)).count()
        fits = kmeans(held, scaled, distinct, RESTARTS, SEED, SEGMENT_ITERATIONS, SEGMENT_TOLERANCE)
    finally:
        held.unpersist()
    for start, fit in enumerate(fits):
        if not fit.settled:
            log.warning("start %d stopped after %d iterations, unsettled", start, SEGMENT_ITERATIONS)
    centers = sorted(min(fits, key=lambda fit: fit.cost).centers, key=lambda z: (z[1] + z[2] - z[0], z))
    literals = [[F.lit(x) for x in center] for center in centers]
    segment = nearest(scaled, literals, SEGMENT_ORDER[: len(centers)]).getField("label")
    label = F.element_at(
        F.create_map(*[F.lit(x) for pair in SEGMENT_LABELS.items() for x in pair]), F.col("segment_id")
    )
    return (
        points.withColumn("segment_id", segment)
        .withColumn("segment_label", label)
        .select(*keep, *FEATURES, "segment_id", "segment_label")
    )


def churn_predictions(
    rfm: DataFrame, keep: list[str]
) -> tuple[DataFrame, PipelineModel] | None:
    """Churn probability by logistic regression on the recency-based label of one day.

    The loss is the mean log loss plus an L2 term of weight 1/n, the intercept left out.
    """
    labelled = churn_label(rfm, SNAPSHOT).persist()
    try:
        counts = {r.churned: r["count"] for r in labelled.groupBy("churned").count().collect()}
        if len(counts) < 2:
            log.warning("churn label has %d classes; no training", len(counts))
            return None
        scaler, assembler = _scaler(labelled), _assembler()
        points = assembler.transform(scaler.transform(labelled))
        model = LogisticRegression(
            labelCol="churned",
            maxIter=CHURN_ITERATIONS,
            tol=CHURN_TOLERANCE,
            regParam=1.0 / sum(counts.values()),
            elasticNetParam=0.0,
            standardization=False,
        ).fit(points)
        if model.summary.totalIterations >= CHURN_ITERATIONS:
            log.warning("churn fit stopped after %d iterations, unsettled", CHURN_ITERATIONS)
    finally:
        labelled.unpersist()
    fitted = PipelineModel(stages=[scaler, assembler, model])
    # The probability as a column expression: it stays inside codegen and does not carry the
    # training summary of the model into the tasks.
    margin = F.lit(float(model.intercept))
    for c, weight in zip(FEATURES, model.coefficients.toArray()):
        margin = margin + F.lit(float(weight)) * F.col(f"{c}_z")
    scored = scaler.transform(rfm).withColumn("churn_probability", 1 / (1 + F.exp(-margin)))
    scored = scored.withColumn("is_high_risk", F.col("churn_probability") >= HIGH_RISK)
    return scored.select(*keep, *FEATURES, "churn_probability", "is_high_risk"), fitted
