from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.ml import PipelineModel

from tests.conftest import tuples
from tidemark.plans import ml

DAY = dt.date(2026, 4, 1)
SCHEMA = "customer_key int, snapshot_date date, recency_days int, frequency int, monetary double"
KEEP = ["customer_key", "snapshot_date"]


def blobs(frame, per_cluster=25):
    """Four well separated groups of customers."""
    random.seed(3)
    centers = [(300, 2, 100.0), (200, 10, 900.0), (100, 20, 2000.0), (5, 60, 9000.0)]
    rows = []
    for number, (recency, frequency, monetary) in enumerate(centers):
        for i in range(per_cluster):
            rows.append(
                (
                    number * 1000 + i, DAY, recency + random.randint(-4, 4),
                    frequency + random.randint(-1, 1), monetary + random.uniform(-20, 20),
                )
            )
    return frame(rows, SCHEMA)


def test_segments_are_ranked_by_value(frame):
    found = ml.customer_segments(blobs(frame), KEEP)
    by_group = {}
    for row in found.collect():
        by_group.setdefault(row.customer_key // 1000, set()).add((row.segment_id, row.segment_label))
    assert by_group == {0: {(0, "At Risk")}, 1: {(2, "Promising")}, 2: {(1, "Loyal")}, 3: {(3, "Champion")}}


def test_segments_agree_between_runs(frame):
    assert tuples(ml.customer_segments(blobs(frame), KEEP)) == tuples(ml.customer_segments(blobs(frame), KEEP))


def test_nothing_to_learn_from(frame):
    assert ml.customer_segments(frame([], SCHEMA), KEEP) is None
    assert ml.churn_predictions(frame([], SCHEMA), KEEP) is None
    single_class = frame([(i, DAY, 50 + i % 5, 3, 10.0) for i in range(20)], SCHEMA)
    assert ml.churn_predictions(single_class, KEEP) is None, "no recency above 90 days"


def test_fewer_customers_than_segments(frame):
    few = frame([(1, DAY, 5, 9, 90.0), (2, DAY, 300, 1, 1.0)], SCHEMA)
    found = ml.customer_segments(few, KEEP).collect()
    assert len(found) == 2 and len({r.segment_id for r in found}) == 2
    same = frame([(i, DAY, 5, 9, 90.0) for i in range(6)], SCHEMA)
    assert len({r.segment_id for r in ml.customer_segments(same, KEEP).collect()}) == 1


def test_constant_feature_does_not_break_scaling(frame):
    rows = [(i, DAY, 10 * i, 3, float(i)) for i in range(30)]
    predictions, _ = ml.churn_predictions(frame(rows, SCHEMA), KEEP)
    assert all(math.isfinite(r.churn_probability) for r in predictions.collect())


@pytest.fixture
def scored(frame):
    random.seed(5)
    rows = [(i, DAY, random.randint(1, 400), random.randint(1, 30), random.uniform(5, 5000)) for i in range(200)]
    return rows, ml.churn_predictions(frame(rows, SCHEMA), KEEP)


def test_probabilities_are_the_regularised_optimum(scored):
    """At the optimum the gradient of sum(log loss) + |w|^2 / 2 vanishes."""
    rows, (predictions, fitted) = scored
    probability = {r.customer_key: r.churn_probability for r in predictions.collect()}
    recency = sorted(r[2] for r in rows)
    threshold = max(90.0, (recency[99] + recency[100]) / 2)
    label = {r[0]: float(r[2] > threshold) for r in rows}
    columns = list(zip(*[(r[2], r[3], r[4]) for r in rows]))
    means = [sum(c) / len(c) for c in columns]
    devs = [math.sqrt(sum((x - m) ** 2 for x in c) / len(c)) for c, m in zip(columns, means)]
    model = fitted.stages[-1]
    weights = model.coefficients.toArray()
    intercept_gradient = sum(probability[r[0]] - label[r[0]] for r in rows)
    assert abs(intercept_gradient) < 1e-2
    for j in range(3):
        gradient = sum(
            (probability[r[0]] - label[r[0]]) * (r[2 + j] - means[j]) / devs[j] for r in rows
        )
        assert abs(gradient + weights[j]) < 1e-2


def test_high_risk_flag(scored):
    _, (predictions, _) = scored
    rows = predictions.collect()
    assert all(r.is_high_risk == (r.churn_probability >= 0.5) for r in rows)
    assert 0 < sum(r.is_high_risk for r in rows) < len(rows)


def test_saved_model_gives_the_same_probabilities(frame, scored, tmp_path):
    rows, (predictions, fitted) = scored
    fitted.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model")).transform(frame(rows, SCHEMA))
    expected = {r.customer_key: r.churn_probability for r in predictions.collect()}
    for row in again.select("customer_key", "probability").collect():
        assert row.probability[1] == pytest.approx(expected[row.customer_key], abs=1e-9)
