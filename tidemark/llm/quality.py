"""Quality by importance: how much likelier a text is under good text than under all text.

Words and marks, and pairs of them, are hashed into a fixed number of buckets. Two bags of buckets
are counted: over all documents, and over a bounded sample of documents labelled good. A
document's importance is the ratio of its likelihoods under the two, of its n-grams taken as a
text of fixed length, for else length would decide. Adding Gumbel noise to its logarithm and
keeping the k largest draws k documents without replacement in proportion to importance.

One scan counts, a second scores. Tasks send one row per bucket to the shuffle, the driver holds
one number per bucket. Logarithms are rounded to whole units before they are summed, so a score does not
depend on how rows are dealt. The k-th largest value is found by counting digits, without a sort.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ranks import kth_largest
from tidemark.llm.shipping import ship
from tidemark.llm.words import LOWER, SPACE, Texts, blocks, find_words, slices, span_hashes, window_hashes
from tidemark.scratch import materialize

BUCKET_BITS = 14
NORMAL_LENGTH = 100  # n-grams that a log ratio is given for
SHORT = 10  # n-grams of neutral text that every text is given, so that very short ones say little
MOST_LABELLED = 50_000  # good documents that the target model is counted from, about
MARGIN = 1.01  # documents drawn, in shares of good ones among the labelled
UNIT = 1 << 20

_BYTES = np.arange(256)
_LETTER = (_BYTES >= 128) | ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122) & (_BYTES < 128) | (_BYTES >= 48) & (_BYTES <= 57)


def buckets(texts: Texts, bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts, and the text of each."""
    found, docs = [], []
    for low, high in blocks(texts.data) if len(texts) == 1 else [(0, len(texts.data))]:
        data = LOWER[texts.data[low:high]]
        kind = _LETTER[data]
        cuts = np.zeros(len(data), bool)
        cuts[1:] = (kind[1:] != kind[:-1]) & ~SPACE[data[1:]]
        offsets = np.array([0, high - low]) if len(texts) == 1 else texts.offsets
        words = find_words(Texts(data, offsets, 0), cuts)
        hashes = span_hashes(data, words.starts, words.ends)
        pairs = window_hashes(hashes, 2, 7)
        inside = words.docs[: len(pairs)] == words.docs[1:]
        found += [hashes, pairs[inside]]
        docs += [words.docs, words.docs[: len(pairs)][inside]]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(docs)


def _counts(docs: DataFrame, bits: int) -> DataFrame:
    """``bucket``, ``n_all``, ``n_good`` of the rows (``text``, ``good``)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, good = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for batch in batches:
            flags = np.asarray(batch.column("good"))
            for texts in slices(batch.column("text")):
                found, of = buckets(texts, bits)
                every += np.bincount(found, minlength=1 << bits)
                good += np.bincount(found[flags[texts.first :][of]], minlength=1 << bits)
        some = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(every[some]), pa.array(good[some])], names=["bucket", "n_all", "n_good"]
        )

    counted = docs.select("text", "good").mapInArrow(run, "bucket long, n_all long, n_good long")
    return counted.groupBy("bucket").agg(F.sum("n_all").alias("n_all"), F.sum("n_good").alias("n_good"))


class Model:
    """Log ratios by bucket, in units of 2**-20, and the share of labelled documents that are good."""

    def __init__(self, ratios: np.ndarray, good_share: float):
        self.ratios, self.good_share = ratios, good_share

    def log_ratio(self, text: Column) -> Column:
        """Log ratio of a text column, per 100 n-grams, in units of 2**-20; null text: 0."""
        ratios = self.ratios
        bits = int(len(ratios)).bit_length() - 1

        @F.arrow_udf("long")
        def score(column: pa.Array) -> pa.Array:
            parts = [np.zeros(0, np.int64)]
            for texts in slices(column):
                found, of = buckets(texts, bits)
                sums = np.zeros(len(texts), np.int64)
                np.add.at(sums, of, ratios[found])
                counts = np.bincount(of, minlength=len(texts))
                parts.append(sums * NORMAL_LENGTH // (counts + SHORT))
            return pa.array(np.concatenate(parts))

        return score(text)


def fit(docs: DataFrame, labels: DataFrame, bits: int = BUCKET_BITS, most: int = MOST_LABELLED) -> Model:
    """Count both models: all of ``docs``, and about ``most`` of those that ``labels`` call good.

    ``labels`` has ``doc_id`` and ``quality`` (1: good). Of more than ``most`` good labels, those
    with the smallest hashes of ``doc_id`` count, about that many. Without a good label every log
    ratio is 0 and the good share is 1.
    """
    known = labels.where("quality IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    n, n_good = known.agg(F.count(F.lit(1)), F.sum((F.col("quality") == 1).cast("long"))).first()
    if not n_good:
        return Model(np.zeros(1 << bits, np.int64), 1.0)
    good = known.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    fraction = min(1.0, most / n_good)
    good = good.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(UNIT)) < int(fraction * UNIT))
    # At most about ``most`` ids, whatever the size of the tables.
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(good.withColumn("good", F.lit(True))), "doc_id", "left"
    )
    counted = _counts(marked.select("text", F.coalesce("good", F.lit(False)).alias("good")), bits).collect()
    every, target = np.ones(1 << bits), np.zeros(1 << bits)
    for bucket, n_all, n_of_good in counted:
        every[bucket] += n_all
        target[bucket] += n_of_good
    every /= every.sum()
    # The target model starts from the model of all text, worth four n-grams a bucket, so that
    # n-grams a small sample lacks by chance hardly count against a text.
    target += 4 * every * len(every)
    ratios = np.log(target / target.sum()) - np.log(every)
    return Model(np.round(ratios * UNIT).astype(np.int64), n_good / n)


def _gumbel(seed: int, mark: Column) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", mark), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(u))


def scores(docs: DataFrame, model: Model, seed: int = 23) -> DataFrame:
    """``docs`` with ``_log_ratio`` and ``_draw``, the log ratio with Gumbel noise, in units of 2**-20."""
    text = F.col("text").cast("string")
    ratio = docs.withColumn("_log_ratio", F.coalesce(model.log_ratio(text), F.lit(0)).cast("long"))
    noise = F.round(_gumbel(seed, F.xxhash64(text)) * UNIT).cast("long")
    return ratio.withColumn("_draw", F.col("_log_ratio") + noise)


def threshold(scored: DataFrame, model: Model, margin: float = MARGIN) -> int:
    """The draw from which documents are kept: that of the k-th largest, k being the expected number of good ones."""
    rows = scored.count()
    k = min(rows, round(rows * min(1.0, margin * model.good_share)))
    least = kth_largest(scored, "_draw", k)
    return (1 << 62) if least is None else least


def resample(docs: DataFrame, labels: DataFrame, margin: float = MARGIN, seed: int = 23) -> DataFrame:
    """``doc_id``, ``log_ratio``, ``draw`` and ``kept`` of each document.

    As many documents are kept as the labels' share of good ones makes expect, times ``margin``.
    Equal draws at the limit, as repeated rows have, are kept together. Null or empty text: log
    ratio 0, drawn by noise alone. Null ``doc_id``: noise by the text. Texts of any length: whole.
    No labels: all kept. No rows: no rows. Other columns: ignored.
    """
    model = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = materialize(scores(rows, model, seed).drop("text"), "quality-scores")
    least = threshold(scored, model, margin)
    unit = F.lit(float(UNIT))
    return scored.select(
        "doc_id",
        (F.col("_log_ratio") / unit).alias("log_ratio"),
        (F.col("_draw") / unit).alias("draw"),
        (F.col("_draw") >= least).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, margin: float = MARGIN, seed: int = 23) -> DataFrame:
    """The kept rows of ``docs``, with all their columns. Texts are scored twice, never shuffled."""
    model = fit(docs, labels)
    drawn = scores(docs.select("doc_id", "text"), model, seed).select("_draw")
    least = threshold(materialize(drawn, "quality-draws"), model, margin)
    whole = docs.select(F.struct("*").alias("_row"), "doc_id", "text")
    return scores(whole, model, seed).where(F.col("_draw") >= least).select("_row.*")
