"""Remove word runs that occur in an earlier document, by a compacted graph of repeated k-mers.

A window of k words is an edge of the corpus' De Bruijn graph. Only edges on repeated paths matter,
so each window is first represented by its anchor, the run of four words in it with the smallest
hash; equal windows have equal anchors, and neighbouring windows mostly share one. Anchors that
only one text has drop out after one aggregation. The windows of the others become edges; an
edge's source is the place in the smallest document id that has it. Joining edges with their
sources gives each occurrence a pair of coordinates. Where both advance together the path does not
branch, and the occurrences compact into one span. A span is removed only if the digest of its
words equals that of the words at its source coordinates.

Texts that occur as a whole in an earlier document are covered entirely, so one copy of each text
stands for all in the search. Rows that are shuffled are hashes and places, one per anchor, not
one per word; texts are shuffled where an anchor or a span asks for them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.shipping import ship
from tidemark.llm.words import HashedWords, Texts, hashed_words, mix, signed, slices, window_hashes
from tidemark.scratch import materialize, materialize_last, releasing

WINDOW_WORDS = 13
ANCHOR_WORDS = 4
BROADCAST_IDS = 1_000_000
NO_ID = (1 << 63) - 1  # stands for a null id, after all others


def anchors(words: HashedWords, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``size`` words inside a text: its first word, and the hash of its anchor."""
    width = min(ANCHOR_WORDS, size)
    n = len(words.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = window_hashes(words.hashes, width, 3)
    least = grams[:n].copy()
    for j in range(1, size - width + 1):
        np.minimum(least, grams[j : j + n], out=least)
    starts = np.flatnonzero(words.docs[:n] == words.docs[size - 1 :])
    return starts, least[starts]


def content_hashes(words: HashedWords) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the word sequence of each text."""
    place = np.arange(len(words.hashes)) - words.bounds[words.docs] if len(words.docs) else np.zeros(0, np.int64)
    out = []
    for seed in (1, 2):
        marked = mix(words.hashes + mix(place.astype(np.uint64) * np.uint64(2) + np.uint64(seed)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(marked)])
        out.append(signed(sums[words.bounds[1:]] - sums[words.bounds[:-1]]))
    return out[0], out[1]


def _described(docs: DataFrame, size: int) -> DataFrame:
    """``doc``, two content hashes and the number of words of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column("text")):
                words = hashed_words(texts)
                one, two = content_hashes(words)
                columns = [batch.column("doc").slice(texts.first, len(texts)), pa.array(one), pa.array(two)]
                columns.append(pa.array(np.diff(words.bounds)))
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "one", "two", "n_words"])

    return docs.mapInArrow(run, "doc long, one long, two long, n_words long")


def _anchor_rows(docs: DataFrame, size: int) -> DataFrame:
    """Each document's distinct anchors: ``anchor``, ``doc`` and the content's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column("text")):
                words = hashed_words(texts)
                starts, hashes = anchors(words, size)
                docs_ = words.docs[starts]
                new = np.ones(len(starts), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (docs_[1:] != docs_[:-1])
                one, _ = content_hashes(words)
                ids = np.asarray(batch.column("doc").slice(texts.first, len(texts)))
                docs_, hashes = docs_[new], hashes[new]
                columns = [pa.array(signed(hashes)), pa.array(ids[docs_]), pa.array(signed(one)[docs_])]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "doc", "content"])

    return docs.mapInArrow(run, "anchor long, doc long, content long")


def _edge_rows(flagged: DataFrame, size: int) -> DataFrame:
    """Windows with a repeated anchor: ``edge``, ``doc``, ``content``, ``at``; ``flagged`` has the anchors of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("anchors")
            for texts in slices(batch.column("text")):
                words = hashed_words(texts)
                starts, hashes = anchors(words, size)
                some = lists.slice(texts.first, len(texts))
                wanted = np.asarray(some.flatten()).view(np.uint64)
                owners = np.repeat(np.arange(len(texts)), np.asarray(pc.list_value_length(some)))
                # An anchor and its text as one number; a chance match only adds edges to look at.
                keys = hashes ^ mix(words.docs[starts].astype(np.uint64))
                starts = starts[np.isin(keys, wanted ^ mix(owners.astype(np.uint64)))]
                edges = window_hashes(words.hashes, size, 9)[starts] if len(starts) else np.zeros(0, np.uint64)
                of = words.docs[starts]
                one, _ = content_hashes(words)
                ids = np.asarray(batch.column("doc").slice(texts.first, len(texts)))
                at = (starts - words.bounds[of]).astype(np.int32)
                columns = [pa.array(signed(edges)), pa.array(ids[of]), pa.array(signed(one)[of]), pa.array(at)]
                yield pa.RecordBatch.from_arrays(columns, names=["edge", "doc", "content", "at"])

    return flagged.select("doc", "text", "anchors").mapInArrow(run, "edge long, doc long, content long, at int")


def _span_words(texts: Texts, words: HashedWords, start: int, n: int) -> bytes:
    """Words ``start`` to ``start + n - 1`` of the only text, joined by one space."""
    data = texts.data.tobytes() if n > 64 else None
    spans = zip(words.starts[start : start + n].tolist(), words.ends[start : start + n].tolist())
    return b" ".join((data[a:b] if data is not None else texts.data[a:b].tobytes()) for a, b in spans)


def _digests(sources: DataFrame) -> DataFrame:
    """``source``, ``source_at``, ``n`` and the digest of the words there; ``sources`` has each text's spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = []
                (text,) = slices(batch.column("text").slice(i, 1))
                words = hashed_words(text)
                for span in batch.column("spans")[i].as_py():
                    at, n = span["source_at"], span["n"]
                    if at + n <= len(words.starts):
                        rows.append((batch.column("doc")[i].as_py(), at, n, hashlib.sha256(_span_words(text, words, at, n)).digest()))
                columns = list(zip(*rows)) if rows else [()] * 4
                types = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], names=["source", "source_at", "n", "digest"]
                )

    return sources.select("doc", "text", "spans").mapInArrow(run, "source long, source_at int, n int, digest binary")


def _cut(rows: DataFrame) -> DataFrame:
    """Documents without their verified spans; ``copied`` lists contents that an earlier document has as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 256):
                batch = whole.slice(low, 256)
                n_words, n_removed, kept = [], [], []
                for i in range(batch.num_rows):
                    (text,) = slices(batch.column("text").slice(i, 1))
                    words = hashed_words(text)
                    total = len(words.starts)
                    gone = np.zeros(total, bool)
                    one = int(content_hashes(words)[0][0])
                    if one in (batch.column("copied")[i].as_py() or ()):
                        gone[:] = True
                    else:
                        for span in batch.column("spans")[i].as_py() or ():
                            at, n = span["at"], span["n"]
                            if span["content"] != one or at + n > total:
                                continue
                            if hashlib.sha256(_span_words(text, words, at, n)).digest() == span["digest"]:
                                gone[at : at + n] = True
                    data = text.data.tobytes()
                    spans = zip(words.starts[~gone].tolist(), words.ends[~gone].tolist())
                    kept.append(b" ".join(data[a:b] for a, b in spans).decode("utf-8", "replace"))
                    n_words.append(total)
                    n_removed.append(int(gone.sum()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "text"],
                )

    return rows.select("doc_id", "text", "copied", "spans").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, text string"
    )


def _listed(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """Rows of ``docs`` that ``lists`` names by ``doc``, joined to it; texts it doesn't name are not shuffled
    if the names are few enough to be sent to all tasks."""
    ids = lists.select("doc")
    if ids.count() <= BROADCAST_IDS:
        docs = docs.join(F.broadcast(ids), "doc", "left_semi")
    return docs.join(lists, "doc")


def repeated_edges(docs: DataFrame, size: int, contents: DataFrame) -> DataFrame:
    """Windows whose anchor another text has too: ``edge``, ``doc``, ``content``, ``at``; see ``_edge_rows``.

    ``contents`` names each content's first document; only those are searched.
    """
    rows = _anchor_rows(docs, size)
    repeated = rows.groupBy("anchor").agg(F.min("content").alias("low"), F.max("content").alias("high"))
    repeated = materialize(repeated.where("low <> high").select("anchor"), "repeated-anchors")
    flagged = rows.select("anchor", "doc").join(repeated, "anchor", "left_semi")
    lists = flagged.groupBy("doc").agg(F.collect_set("anchor").alias("anchors"))
    lists = materialize(lists.join(contents.select(F.col("first").alias("doc")).distinct(), "doc", "left_semi"), "flagged")
    return _edge_rows(_listed(docs, lists), size)


def repeated_paths(edges: DataFrame, size: int) -> DataFrame:
    """Maximal runs of words that also stand, in one piece, in an earlier document: ``doc``, ``content``, ``at``,
    ``n`` words, ``source``, ``source_at``."""
    sources = edges.groupBy("edge").agg(
        F.min("doc").alias("source"), F.min_by("at", "doc").alias("source_at"), F.max("doc").alias("last")
    )
    # A table of its own, so that the join has two plain shuffles and a frequent edge can be split.
    sources = materialize(sources.where("source < last").drop("last"), "edge-sources")
    later = edges.join(sources, "edge").where("doc > source").drop("edge")
    # Occurrences whose two coordinates advance together form one path.
    order = Window.partitionBy("doc", "content").orderBy("at")
    slope = F.col("at") - F.col("source_at")
    goes_on = (
        (F.lag("at").over(order) == F.col("at") - 1)
        & (F.lag("source").over(order) == F.col("source"))
        & (F.lag(slope).over(order) == slope)
    )
    marked = later.withColumn("opens", F.when(goes_on, 0).otherwise(1))
    marked = marked.withColumn("path", F.sum("opens").over(order))
    spans = marked.groupBy("doc", "content", "path").agg(
        F.min("at").alias("at"),
        (F.count(F.lit(1)) + (size - 1)).cast("int").alias("n"),
        F.first("source").alias("source"),
        F.min("source_at").alias("source_at"),
    )
    return spans.drop("path")


def repeated_spans(docs: DataFrame, size: int, contents: DataFrame) -> DataFrame:
    """The repeated paths of ``docs`` and the ``digest`` of the words at their source.

    The edges, several times as many as the paths, are deleted once these are written.
    """

    def paths() -> DataFrame:
        edges = materialize_last(spark, lambda: repeated_edges(docs, size, contents), "edges")
        return repeated_paths(edges, size)

    spark = docs.sparkSession
    spans = materialize_last(spark, paths, "spans")
    named = spans.groupBy(F.col("source").alias("doc")).agg(F.collect_set(F.struct("source_at", "n")).alias("spans"))
    digests = _digests(_listed(docs, materialize(named, "sources")))
    return spans.join(digests, ["source", "source_at", "n"])


def verdicts(docs: DataFrame, size: int) -> DataFrame:
    """Of each document that loses words, ``doc``, the ``spans`` that go, and ``copied``, its contents that go whole."""
    described = materialize(_described(docs, size), "contents")
    same = ["one", "two", "n_words"]
    contents = materialize(described.groupBy(*same).agg(F.min("doc").alias("first")), "first-contents")
    spans = repeated_spans(docs, size, contents.where(F.col("n_words") >= size))
    lists = spans.groupBy("doc").agg(F.collect_list(F.struct("content", "at", "n", "digest")).alias("spans"))
    copies = described.where(F.col("n_words") >= size).join(contents, same).where("doc > first")
    copies = copies.groupBy("doc").agg(F.collect_set("one").alias("copied"))
    return lists.join(copies, "doc", "full_outer")


def remove_repeats(docs: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """Documents without the words that windows from earlier documents cover.

    A window is ``size`` consecutive words of one document; a word goes if a window over it also
    stands in a document with a smaller ``doc_id``. Windows are judged on the input. Gives
    ``doc_id``, ``n_words``, ``n_removed`` and ``text``, the kept words joined by one space.
    Null or empty text: no words, empty text. Fewer than ``size`` words: nothing goes. Null
    ``doc_id``: later than all others, not than each other. Rows that share a ``doc_id`` are not
    earlier than each other; each is cut by itself. Texts of any length: whole. No rows: no rows.
    Other columns: ignored.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    placed = rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text")
    with releasing(docs.sparkSession):
        told = materialize_last(docs.sparkSession, lambda: verdicts(placed, size), "verdicts")
        few = told.count() <= BROADCAST_IDS
    marked = rows.withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID)))
    if few:  # then texts that stay as they are need no shuffle
        ids = F.broadcast(told.select("doc"))
        touched = marked.join(ids, "doc", "left_semi").join(told, "doc")
        joined = touched.unionByName(marked.join(ids, "doc", "left_anti"), allowMissingColumns=True)
    else:
        joined = marked.join(told, "doc", "left")
    return _cut(joined)
