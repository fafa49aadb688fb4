"""Quality rules on whole texts, and lines that too many documents of a host share.

One scan measures each text and hashes its normalised lines. Lines are counted over all documents
of a host, each document once; a line above the limit is boilerplate. What boilerplate leaves of a
document decides whether it is kept. The scan's rows, which hold numbers only, are written once;
counts are combined before the shuffle, and only lines above the limit are joined back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.line_dedup import drop_lines
from tidemark.llm.shipping import ship
from tidemark.llm.words import LOWER, SPACE, HashedWords, Texts, hashed_words, mix, signed, slices, span_hashes, window_hashes
from tidemark.scratch import materialize

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = (50, 100)  # repeated words may be 50 of 100
LEAST_DOCUMENTS = 20  # a line in fewer documents of a host is never boilerplate
MOST_SHARE = 0.1  # of a host's documents
MOST_REMOVED = 0.5  # of a document's words

MEASURES = "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def repeated_words(words: HashedWords, size: int = 3) -> np.ndarray:
    """How many words of each text lie in windows that the text holds more than once."""
    n = len(words.hashes) - size + 1
    counts = np.zeros(len(words.bounds) - 1, np.int64)
    if n <= 0:
        return counts
    inside = np.flatnonzero(words.docs[:n] == words.docs[size - 1 :])
    keys = window_hashes(words.hashes, size)[inside]
    keys = mix(keys + words.docs[inside].astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words.hashes), bool)
    for j in range(size):
        covered[inside[twice] + j] = True
    np.add.at(counts, words.docs[covered], 1)
    return counts


def _by_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _lines(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and texts of all lines."""
    breaks = np.flatnonzero(texts.data == 10)
    filled = np.flatnonzero(np.diff(texts.offsets) > 0)
    starts = np.union1d(breaks + 1, texts.offsets[:-1][filled])
    starts = starts[starts < len(texts.data)]
    docs = np.searchsorted(texts.offsets, starts, side="right") - 1
    ends = np.minimum(np.append(starts[1:], len(texts.data)), texts.offsets[docs + 1])
    ends -= (texts.data[ends - 1] == 10) & (ends > starts)
    return starts, ends, docs


def measure(texts: Texts) -> dict[str, np.ndarray]:
    """The measures of each text, and its distinct normalised lines with their words."""
    words = hashed_words(texts)
    solid = ~SPACE[texts.data] & ((texts.data & 0xC0) != 0x80)
    starts, ends, docs = _lines(texts)
    first = np.searchsorted(words.starts, starts)
    n_words = np.searchsorted(words.starts, ends) - first
    full = n_words > 0
    starts, ends, docs, first, n_words = (x[full] for x in (starts, ends, docs, first, n_words))
    exact = span_hashes(texts.data, starts, ends) + docs.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
    _, seen_first = np.unique(exact, return_index=True)
    again = np.ones(len(exact), bool)
    again[seen_first] = False
    # Normalised: ASCII letters lowered, digits alike, words joined by one space.
    fold = LOWER.copy()
    fold[48:58] = 48
    folded = hashed_words(texts, fold).hashes
    sums = np.zeros(len(folded) + 1, np.uint64)
    place = np.arange(len(folded)) - np.repeat(first, n_words) if full.any() else np.zeros(0, np.int64)
    if len(place):
        np.cumsum(mix(folded + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), out=sums[1:])
    lines = mix(sums[first + n_words] - sums[first] + n_words.astype(np.uint64))
    breaks = np.flatnonzero(texts.data == 10)
    at = np.searchsorted(breaks, starts) - np.searchsorted(breaks, texts.offsets[docs])
    return {
        "n_words": np.diff(words.bounds),
        "word_chars": _by_text(solid, texts.offsets),
        "n_symbols": _by_text(_SYMBOL[texts.data], texts.offsets),
        "n_dup_lines": np.bincount(docs[again], minlength=len(texts)),
        "n_repeat_words": repeated_words(words),
        "line": lines,
        "line_words": n_words,
        "line_at": at,
        "line_doc": docs,
    }


def _list(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def measures(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` (plus ``text``), the measures of each text, and its lines."""
    ship(docs.sparkSession)
    schema = docs.select(*columns).schema
    for name in MEASURES:
        schema = schema.add(name, "long")
    numbers = T.ArrayType(T.LongType())
    schema = schema.add("lines", numbers).add("line_words", numbers).add("line_at", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column("text")):
                found = measure(texts)
                bounds = np.searchsorted(found["line_doc"], np.arange(len(texts) + 1))
                rest = [batch.column(c).slice(texts.first, len(texts)) for c in columns]
                rest += [pa.array(found[name].astype(np.int64)) for name in MEASURES]
                rest += [_list(signed(found["line"]), bounds), _list(found["line_words"].astype(np.int64), bounds)]
                rest += [_list(found["line_at"].astype(np.int32), bounds)]
                yield pa.RecordBatch.from_arrays(rest, names=schema.names)

    return docs.select(*columns, "text").mapInArrow(run, schema)


def base_failed() -> Column:
    """Too short, or made of repeats."""
    most, of = MOST_REPEATED
    return (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * of > F.col("n_words") * most)


def host_hash() -> Column:
    return F.xxhash64(F.col("source").cast("string"), F.col("source").isNull())


def _rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        host_hash().alias("host"),
        F.monotonically_increasing_id().alias("row_no"),
        F.xxhash64(text).alias("text_mark"),
        text.alias("text"),
    )


def _boilerplate(found: DataFrame, least_documents: int, most_share: float) -> DataFrame:
    """The boilerplate lines of each row: ``row_no``, ``words``, ``at``."""
    hosts = found.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"))
    own = found.select("host", F.explode(F.array_distinct("lines")).alias("line"))
    counts = own.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_documents)
    frequent = counts.join(hosts, "host").where(F.col("n") > F.lit(most_share) * F.col("n_docs")).select("host", "line")
    zipped = F.explode(F.arrays_zip("lines", "line_words", "line_at")).alias("x")
    lines = found.select("row_no", "host", zipped).select(
        "row_no", "host", F.col("x.lines").alias("line"), F.col("x.line_words").alias("words"), F.col("x.line_at").alias("at")
    )
    return lines.join(frequent, ["host", "line"]).select("row_no", "words", "at")


def judge_lines(
    docs: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    most_share: float = MOST_SHARE,
    most_removed: float = MOST_REMOVED,
) -> DataFrame:
    """Measures of ``docs`` (``doc_id``, ``text``, ``source``) and whether each is kept.

    A line is boilerplate of its host (``source``) if at least ``least_documents`` and more than
    ``most_share`` of the host's documents have it. ``n_removed_words`` counts the words of a
    document's boilerplate lines, whose places are in ``gone``. A document is depleted, and
    rejected, if they are more than ``most_removed`` of its words. ``base_failed`` documents are
    rejected before that; their lines count. ``text_mark`` is a hash of the text.
    Null or empty text: no words, fails the base rules. Null source: a host. Repeated rows:
    documents of their own. Null ``doc_id``: kept as null. No rows: no rows. Other columns: ignored.
    """
    keys = ["doc_id", "host", "row_no", "text_mark"]
    found = materialize(measures(_rows(docs), keys), "line-measures")
    removed = _boilerplate(found, least_documents, most_share).groupBy("row_no")
    removed = removed.agg(F.sum("words").alias("n_removed_words"), F.collect_set("at").alias("gone"))
    joined = found.join(removed, "row_no", "left").withColumn("base_failed", base_failed())
    gone = F.coalesce("n_removed_words", F.lit(0).cast("long"))
    kept = ~F.col("base_failed") & (gone <= F.lit(most_removed) * F.col("n_words"))
    return joined.select(
        "doc_id", *MEASURES, "base_failed", gone.alias("n_removed_words"), kept.alias("kept"), "host", "text_mark", "gone"
    )


def clean_lines(docs: DataFrame, **limits: float) -> DataFrame:
    """The kept documents of ``judge_lines`` without their boilerplate lines; adds ``n_lines``, ``n_removed``.

    Columns of these names are replaced, others kept as they are. Rows that agree in id, source and text have
    one verdict and each stays; with another source they have their own. Null text: has no words and goes.
    Null ``source``: a host; null ``doc_id``: rows with it are told apart by host and text. No rows: no rows.
    """
    judged = judge_lines(docs, **limits)
    of_host = F.xxhash64("text_mark", "host").alias("text_mark")
    gone = judged.groupBy("doc_id", of_host).agg(F.first("gone", True).alias("gone"), F.max("kept").alias("kept"))
    mark = F.xxhash64(F.xxhash64(F.col("text").cast("string")), host_hash())
    return drop_lines(docs, materialize(gone.where("kept"), "line-verdicts"), "inner", mark)
