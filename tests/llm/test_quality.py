"""Quality by importance: the counting, the draw, and accuracy on labels it has not seen."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality
from tidemark.llm.quality import fit, keep_good, resample
from tidemark.llm.ranks import kth_largest
from tidemark.llm.words import Texts

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("bits", [3, 20, 63])
def test_kth_largest(spark, frame, bits):
    draw = random.Random(bits)
    values = [draw.randint(-(1 << bits), (1 << bits) - 1) for _ in range(300)] + [5, 5, 5, None]
    df = frame([(v,) for v in values], "v long")
    ordered = sorted((v for v in values if v is not None), reverse=True)
    for k in (1, 2, 150, 303):
        assert kth_largest(df, "v", k) == ordered[k - 1]
    assert kth_largest(df, "v", 304) is None and kth_largest(df, "v", 0) is None


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    judged = resample(docs, labels.where(~held_out)).join(labels.where(held_out), "doc_id")
    shares = {r["quality"]: r["kept"] for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("kept")).collect()}
    assert shares[1] >= 0.97 and shares[0] <= 0.2


def test_keeps_as_many_as_expected_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    one = resample(docs, labels, margin=1.0).orderBy("doc_id").collect()
    share = labels.agg(F.avg("quality")).first()[0]
    assert sum(r["kept"] for r in one) == round(len(one) * share)
    assert one == resample(docs.repartition(5, "text"), labels, margin=1.0).orderBy("doc_id").collect()
    kept = keep_good(docs, labels, margin=1.0)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == [r["doc_id"] for r in one if r["kept"]]


def test_log_ratio_is_a_sum_over_n_grams(spark, frame):
    docs = frame([(i, "good words here" if i % 2 else "### bad ###") for i in range(40)], "doc_id long, text string")
    labels = frame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    model = fit(docs, labels)
    texts = ["good words here", "### bad ###", "good words here good words here", "", None]
    scored = frame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", model.log_ratio(F.col("text")).alias("r"))
    r = [x["r"] for x in scored.orderBy("i").collect()]
    assert r[0] > 0 > r[1] and r[2] > 2 * r[0] - abs(r[0]) and not r[3] and not r[4]


def test_edge_rows(spark, frame):
    docs = frame([(None, "a", 1), (1, None, 1), (2, "", 1), (3, "x " * 400000, 1), (3, "y", 1), (3, "y", 1)], "doc_id long, text string, _draw int")
    labels = frame([(3, 1), (3, 1), (None, 1), (1, None), (9, 0)], "doc_id long, quality int")
    assert resample(docs, labels).count() == 6
    assert resample(docs, labels.limit(0)).where("kept").count() == 6
    assert keep_good(docs, labels.limit(0)).columns == docs.columns
    assert resample(docs.limit(0), labels).count() == 0


def test_matches_plain_code(spark, frame):
    """Counts, ratios, noise, draws and kept rows again, one n-gram at a time."""
    draw = random.Random(5)
    good, bad = ["the sea was calm today", "we walked home, slowly"], ["buy now !!! $$$", "click here click here"]
    rows = [(i, " ".join(draw.choices(good if i % 3 else bad, k=draw.randrange(1, 9)))) for i in range(80)]
    rows += [(80, None), (81, ""), (None, "the sea"), (5, rows[5][1])]
    labels = [(i, int(i % 3 > 0)) for i in range(0, 60, 2)] + [(None, 1), (999, 1), (4, None)]
    docs = frame(rows, "doc_id long, text string")
    found = sorted((tuple(r) for r in quality.resample(docs, frame(labels, "doc_id long, quality int")).collect()), key=str)

    def grams(text):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        return quality.buckets(Texts(raw, np.array([0, len(raw)]), 0))[0].tolist()

    size = 1 << quality.BUCKET_BITS
    every, target = [1.0] * size, [0.0] * size
    liked = {i for i, q in labels if q == 1 and i is not None}
    for i, text in rows:
        for b in grams(text):
            every[b] += 1
            target[b] += i in liked
    whole = sum(every)
    every = [x / whole for x in every]
    target = [t + 4 * e * size for t, e in zip(target, every)]
    ratios = [round((math.log(t / sum_t) - math.log(e)) * quality.UNIT) for sum_t in [sum(target)] for t, e in zip(target, every)]
    hashed = docs.select("doc_id", "text", F.xxhash64(F.lit(23), "doc_id", F.xxhash64("text")).alias("h")).collect()
    expected = []
    for doc_id, text, h in hashed:
        some = grams(text)
        ratio = sum(ratios[b] for b in some) * quality.NORMAL_LENGTH // (len(some) + quality.SHORT)
        u = (((h % (1 << 64)) >> 11) + 0.5) / (1 << 53)
        expected.append((doc_id, ratio, ratio + round(-math.log(-math.log(u)) * quality.UNIT)))
    judged = [q for _, q in labels if q is not None]
    k = min(len(rows), round(len(rows) * min(1.0, quality.MARGIN * sum(judged) / len(judged))))
    least = sorted((x[2] for x in expected), reverse=True)[k - 1]
    for (doc_id, log_ratio, drawn, kept), (i, ratio, at) in zip(found, sorted(((i, r / quality.UNIT, d / quality.UNIT) for i, r, d in expected), key=str)):
        assert doc_id == i and abs(log_ratio - ratio) < 0.01 and abs(drawn - at) < 0.01
        assert kept == (drawn * quality.UNIT >= least) or abs(at * quality.UNIT - least) < 10_000
    assert abs(sum(r[3] for r in found) - k) <= 1
