"""Remove repeated runs of three lines, wherever they stand.

Every three consecutive lines of a document make a window. A window that also starts earlier, in
a document with a smaller id or further up in the same one, is a later occurrence, and all lines
that later occurrences cover go. Lines are compared without the white space around them; lines
without a word are no part of any window and stay.

The windows are written once as two 64-bit hashes, a document and a line number; texts are not
shuffled for the search. The first place of each window is a minimum that is combined before the
shuffle, and only windows found twice are joined back, which splits frequent ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import materialize

WINDOW_LINES = 3
BLANKS = " \t\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]"


def line_windows(docs: DataFrame, size: int = WINDOW_LINES) -> DataFrame:
    """``doc_id``, ``text_mark``, ``at`` (places of the lines) and two hashes of each window."""
    lines = F.transform(
        F.split("text", "\n", -1), lambda line, at: F.struct(F.trim(line, F.lit(BLANKS)).alias("line"), at.alias("at"))
    )
    solid = F.filter(lines, lambda x: x["line"] != "")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_mark"), solid.alias("lines"))
    rows = rows.where(F.size("lines") >= size)

    def window(k):
        members = [F.get("lines", k + j) for j in range(size)]
        return F.struct(
            F.array(*(m["at"] for m in members)).alias("at"),
            F.xxhash64(F.lit(1), *(m["line"] for m in members)).alias("one"),
            F.xxhash64(F.lit(2), *(m["line"] for m in reversed(members))).alias("two"),
        )

    found = F.transform(F.sequence(F.lit(0), F.size("lines") - size), window)
    return rows.select("doc_id", "text_mark", F.explode(found).alias("w")).select("doc_id", "text_mark", "w.*")


def repeated_lines(docs: DataFrame, size: int = WINDOW_LINES) -> DataFrame:
    """``doc_id``, ``text_mark``, ``gone``: the places of the lines that later occurrences cover."""
    windows = materialize(line_windows(docs, size), "line-windows")
    # One number orders all starts: the document's id, null last, then the line.
    id_part = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(str(1 << 63)).cast("decimal(20,0)"))
    start = (id_part * F.lit(str(1 << 31)).cast("decimal(11,0)") + F.element_at("at", 1)).cast("decimal(38,0)")
    windows = windows.withColumn("start", start)
    firsts = windows.groupBy("one", "two").agg(F.min("start").alias("first"), F.count(F.lit(1)).alias("n"))
    # Written, so that the join has two plain shuffles and a frequent window can be split.
    firsts = materialize(firsts.where("n > 1").drop("n"), "repeated-windows")
    later = windows.join(firsts, ["one", "two"]).where("start > first")
    covered = later.select("doc_id", "text_mark", F.explode("at").alias("at"))
    return covered.groupBy("doc_id", "text_mark").agg(F.collect_set("at").alias("gone"))


def drop_lines(docs: DataFrame, gone: DataFrame, how: str = "left", mark: Column | None = None) -> DataFrame:
    """``docs`` without the lines at the places ``gone`` of each ``doc_id`` and ``text_mark``.

    ``mark`` is what ``text_mark`` is compared with, by default a hash of the text. Adds ``n_lines`` and ``n_removed``; columns of these names are replaced.
    """
    rows = docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    whole = rows.select(F.struct("*").alias("doc"), (F.xxhash64("text") if mark is None else mark).alias("mark"))
    same = whole["doc.doc_id"].eqNullSafe(gone["doc_id"]) & (whole["mark"] == gone["text_mark"])
    joined = whole.join(gone, same, how).select("doc", "gone")
    lines = F.split("doc.text", "\n", -1)
    n_lines = F.coalesce(F.size(lines), F.lit(0))
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone")
    kept = F.array_join(F.transform(places, lambda at: F.get(lines, at)), "\n")
    text = F.when(F.col("gone").isNull(), F.col("doc.text")).otherwise(kept)
    out = joined.select(
        "doc",
        text.alias("text"),
        F.when(F.col("doc.text").isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
    own = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    return out.select(*(F.col("doc").getField(c).alias(c) for c in own), "text", "n_lines", "n_removed")


def dedup_lines(docs: DataFrame, size: int = WINDOW_LINES) -> DataFrame:
    """``docs`` (``doc_id``, ``text`` and any more columns) without repeated runs of lines.

    Adds ``n_lines`` and ``n_removed`` and puts the kept lines, joined by newlines, into ``text``;
    columns of these names are replaced, others kept as they are.
    Null text: stays null, no lines. Empty text: one blank line. Fewer than ``size`` lines with a
    word: unchanged. Null ``doc_id``: comes after all others; the rows with it count as one
    document each, at the same place, so none of them is later than another. Rows repeated in id
    and text are likewise at the same place and get the same lines. No rows: no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return drop_lines(docs, repeated_lines(rows, size))
