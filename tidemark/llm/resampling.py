"""Importance resampling towards a target: how much likelier a document's n-grams are there.

Runs of one to three words are counted in a fixed number of buckets, over all documents and
over all target texts. A bucket's gain is the logarithm of the ratio of its shares; a document's weight is
the sum over its n-grams, looked up in one array. Gumbel noise from a hash of the id makes the
largest scores a draw without replacement.

The number drawn is a share of the documents, so their least key has to be found: by
distributed quickselect. Random keys of those still in question become pivots, two that enclose the
place looked for; an exact count of the keys below, at and above each narrows the question; what is
left is written and asked again, until it is few enough to look at. Only the winners are sorted.

One scan counts, a second scores. The driver holds one number per bucket and a bounded sample of keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidemark.llm.checksums import joined, word_checksums
from tidemark.llm.shipping import ship
from tidemark.llm.words import LOWER, SPACE, Texts, blocks, find_words, slices
from tidemark.operators.keys import surrogate_key
from tidemark.scratch import materialize

BUCKETS = 10_000
RUN_WORDS = 3
LEAST_WORDS = 20
SHARE = (5, 100)
SEED = 42
PIVOT_KEYS = 1024  # keys that pivots are chosen from; as few are looked at directly

# Bytes outside words become spaces: all of ASCII but digits and letters. A-Z are lowered.
_FOLD = LOWER.copy()
_FOLD[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 32


def features(texts: Texts, buckets: int = BUCKETS, run_words: int = RUN_WORDS) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Buckets of the runs of consecutive words, the text of each, and the length of the run in words.

    A long text is taken block by block; runs reach over blocks.
    """
    folded = _FOLD[texts.data]
    before: list[np.ndarray] = []  # of the last words of the block before: checksum, with space, length
    for low, high in blocks(folded) if len(texts) == 1 else [(0, len(folded))]:
        data = folded[low:high]
        words = find_words(Texts(data, np.array([0, high - low]) if len(texts) == 1 else texts.offsets, 0))
        plain, spaced = word_checksums(data, words.starts, words.ends, ~SPACE[data])
        parts, docs, known = [plain, spaced, words.ends - words.starts], words.docs, 0
        if before:
            known = len(before[0])
            parts = [np.concatenate(x) for x in zip(before, parts)]
            docs = np.concatenate([np.zeros(known, docs.dtype), docs])
        plain, spaced, lengths = parts
        yield plain[known:].astype(np.int64) % buckets, docs[known:], 1
        so_far = spaced
        for n in range(2, run_words + 1):
            if len(plain) < n:
                break
            runs = joined(so_far[: len(plain) - n + 1], plain[n - 1 :], lengths[n - 1 :])
            of = docs[: len(runs)]
            new = (of == docs[n - 1 :]) & (np.arange(n - 1, len(plain)) >= known)
            yield runs[new].astype(np.int64) % buckets, of[new], n
            if n < run_words:
                so_far = joined(so_far[: len(plain) - n + 1], spaced[n - 1 :], lengths[n - 1 :] + 1)
        before = [x[-(run_words - 1) :] for x in parts] if run_words > 1 else []


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, run_words: int = RUN_WORDS) -> np.ndarray:
    """How many features of the column ``text`` each bucket holds."""
    ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch.column("text")):
                for found, _, _ in features(part, buckets, run_words):
                    counts += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bucket", "n"])

    found = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the logarithm of the ratio of each bucket's shares, rounded down."""
    n_raw, n_target, n = float(raw.sum()), float(target.sum()), float(len(raw))
    ratio = [((t + 1.0) * (n_raw + n)) / ((s + 1.0) * (n_target + n)) for s, t in zip(raw.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, run_words: int = RUN_WORDS) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` of each row, and a hash of its text."""
    ship(docs.sparkSession)
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                n_words, n_features, weight = (np.zeros(len(part), np.int64) for _ in range(3))
                for found, of, n in features(part, buckets, run_words):
                    counts = np.bincount(of, minlength=len(part))
                    n_features += counts
                    n_words += counts if n == 1 else 0
                    sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(gain[found])])
                    ends = np.cumsum(counts)
                    weight += sums[ends] - sums[ends - counts]
                taken = [batch.column(c).slice(part.first, len(part)) for c in ("doc_id", "text_hash")]
                yield pa.RecordBatch.from_arrays(
                    [*taken, pa.array(n_words), pa.array(n_features), pa.array(weight)],
                    names=["doc_id", "text_hash", "n_words", "n_features", "weight"],
                )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, "doc_id long, text_hash long, n_words long, n_features long, weight long"
    )


def gumbel(seed: int) -> Column:
    """A thousand times Gumbel noise from the hash of ``doc_id``, rounded down."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    h = F.conv(F.substring(hashed, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def _literal(key: Row, like: DataFrame) -> Column:
    fields = like.schema["key"].dataType.fields
    return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(key, fields)])


def kth_smallest(keys: DataFrame, k: int, sample: int = PIVOT_KEYS) -> Row | None:
    """The ``k``-th smallest ``key``, a struct without nulls; no two may be equal. None if there are fewer.

    Each round draws ``sample`` of the keys still in question and takes two of them, three deviations to
    either side of the place looked for, as pivots. What lies between them, or on the side that
    the counts name, is written and goes into the next round.
    """
    n, turn = keys.count(), 0
    if not 1 <= k <= n:
        return None
    while n > sample:
        order = F.xxhash64(F.lit(turn), "key")
        drawn = sorted(r["key"] for r in keys.orderBy(order).limit(sample).collect())
        place, slack = k / n * len(drawn), 3 * math.sqrt(len(drawn)) / 2
        low, high = (drawn[min(max(int(x), 0), len(drawn) - 1)] for x in (place - slack, place + slack))
        one, two, key = _literal(low, keys), _literal(high, keys), F.col("key")
        cases = [key < one, key == one, (key > one) & (key < two), (key == two) & (key != one), key > two]
        counts = keys.agg(*[F.sum(F.when(c, 1).otherwise(0)).alias(f"n{i}") for i, c in enumerate(cases)]).first()
        for i, count in enumerate(counts):
            if k <= count:
                break
            k -= count
        if i in (1, 3):
            return low if i == 1 else high
        keys, n, turn = materialize(keys.where(cases[i]), "keys-in-question"), counts[i], turn + 1
    return sorted(r["key"] for r in keys.collect())[k - 1]


def resample(
    docs: DataFrame,
    target: DataFrame,
    share: tuple[int, int] = SHARE,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score``, ``rank`` and ``n_words`` of each row (``doc_id``, ``text``).

    ``target`` has ``text``. Of the documents with ``least_words`` words or more, ``share`` (of
    a whole, rounded down) with the highest scores are drawn and ranked from 1, ties to the smaller ``doc_id``,
    then by a hash of the text; rows that agree in all of these are taken in any order. The others'
    rank is null. Null or empty text: no features, weight 0, not drawn where words are asked for. Null
    ``doc_id``: weighed, but score and rank are null. Rows that share a ``doc_id`` are rows of their
    own with the same noise. Texts of any length: whole. No rows: no rows; no target text: every
    bucket's target count is 0. Other columns: ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gain = gains(bucket_counts(rows, buckets), bucket_counts(target, buckets))
    scored = weighed(rows, gain).withColumn("score", F.col("weight") + gumbel(seed))
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    key = F.struct((-F.col("score")).alias("score"), "doc_id", "text_hash", "row")
    asked = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    keys = scored.where(asked).select(key.alias("key"))
    k = keys.count() * share[0] // share[1]
    out = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    last = kth_smallest(keys, k, PIVOT_KEYS)
    if last is None:
        return scored.withColumn("rank", F.lit(None).cast("long")).select(*out)
    won = F.coalesce(asked & (key <= _literal(last, keys)), F.lit(False))
    winners = scored.where(won).withColumn("least_first", -F.col("score"))
    ranked = surrogate_key(winners, "rank", ["least_first", "doc_id", "text_hash", "row"])
    rest = scored.where(~won).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*out).unionByName(rest.select(*out))
