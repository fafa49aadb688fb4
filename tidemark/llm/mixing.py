"""Mix sources to target weights by a low-discrepancy schedule over equal blocks of words.

A source's documents are shuffled by hash, laid end to end and cut into blocks of equally many
words. A schedule of slots says which source gives the next block: slot ``i`` is the ``i``-th
van der Corput point, mapped through the sources' cumulative weights; its rank among its source's
slots says which block it takes. So every stretch of the mix has the sources in proportion.
Only DataFrame operations are used. Running totals are taken inside small ranges of hashes, whose
totals are summed up in two more levels, so that a source with a third of all rows is dealt over
many tasks. Texts are read once, for their sizes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.scratch import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
BLOCK_WORDS = 256
RANGE_ROWS = 1024  # rows of one source that are summed in order, at the least
RANGE_BITS = 10  # ranges that are summed in order
KEPT = "doc_id", "source", "size", "source_size", "target", "one", "two"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def running_total(df: DataFrame, group: str, span: str, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Add as ``name`` the sum of ``value`` over the rows of ``group`` before each row.

    Rows go by ``span``, a number that does not depend on the group and of which a group has
    few rows, then by ``order``. No task gets more than one span's or 1024 spans' totals at once.
    """
    before = Window.unboundedPreceding, -1
    inside = Window.partitionBy(group, span).orderBy(*order).rowsBetween(*before)
    zero = F.lit(0).cast("long")
    far = F.shiftright(F.col(span), RANGE_BITS)
    spans = df.groupBy(group, span).agg(F.sum(value).alias("_sum")).withColumn("_far", far)
    spans = spans.withColumn(
        "_near", F.sum("_sum").over(Window.partitionBy(group, "_far").orderBy(span).rowsBetween(*before))
    )
    fars = spans.groupBy(group, "_far").agg(F.sum("_sum").alias("_far_sum"))
    fars = fars.select(
        group,
        "_far",
        F.sum("_far_sum").over(Window.partitionBy(group).orderBy("_far").rowsBetween(*before)).alias("_before"),
    )
    bases = spans.join(fars, [group, "_far"]).select(
        group, span, (F.coalesce("_near", zero) + F.coalesce("_before", zero)).alias("_base")
    )
    summed = df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), zero))
    return summed.join(bases, [group, span]).withColumn(name, F.col("_inside") + F.col("_base")).drop("_inside", "_base")


def _span_bits(rows: int) -> int:
    return max(0, math.ceil(math.log2(max(rows, 1) / RANGE_ROWS)))


def row_keys(rest: Sequence[str] = ()) -> list[Column]:
    """Two hashes, ``one`` and ``two``, of a document's id, source and text and of ``rest``; none is null."""
    parts = [F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string")]
    parts += [F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest]))] if rest else []
    parts += [x.isNull() for x in parts]
    return [F.xxhash64(F.lit(seed), *parts).alias(name) for seed, name in ((1, "one"), (2, "two"))]


def sizes(docs: DataFrame, seed: int, rest: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``source``, words and hashes of each document; written, so texts are read once."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"),
        *row_keys(rest),
    )
    return materialize(rows.withColumn("mark", F.xxhash64(F.lit(seed), "one")), "mix-sizes")


def source_targets(
    sized: DataFrame, share: float = 1.5, most: float = 2.0, weights: Sequence[float] = WEIGHTS
) -> DataFrame:
    """One row per source: ``source_no``, ``source``, ``source_size``, ``target`` words.

    Sources in code-point order, null last, take ``weights`` in turn and share ``share`` times
    all words by them. No target is above ``most`` times its source's size; what is above is
    shared again among the others by weight.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    table = F.array(*map(F.lit, weights))
    sources = totals.withColumn("source_no", number.cast("long"))
    sources = sources.withColumn(
        "weight", F.element_at(table, (F.col("source_no") % len(weights) + 1).cast("int")).cast("double")
    )
    sources = materialize(sources.withColumn("most", F.col("source_size") * F.lit(float(most))), "mix-sources")
    whole, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    goal = share * (whole or 0)
    level, full = (goal / weight if weight else 0.0), -1
    while True:
        above = F.col("weight") * F.lit(level) > F.col("most")
        n, fixed, free = sources.agg(
            F.sum(above.cast("long")), F.sum(F.when(above, F.col("most"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n == full or not free:
            break
        full, level = n, (goal - (fixed or 0.0)) / free
    target = F.least("most", F.col("weight") * F.lit(level))
    return sources.select("source_no", "source", "source_size", target.alias("target"))


def _slots(plan: DataFrame, total: int) -> DataFrame:
    """The schedule: ``slot``, ``source_no``, ``rank`` for as many slots as each source needs."""
    bits = max(1, math.ceil(math.log2(max(total, 2))))
    n_sources = plan.count()
    cells = min(bits, max(0, math.ceil(math.log2(max(4 * n_sources, total / 4096, 1)))))
    shift = bits - cells
    upto = F.sum("need").over(Window.orderBy("source_no"))
    scale = float(1 << bits) / total
    edges = plan.withColumn("_high", F.round(upto * F.lit(scale)).cast("long")).withColumn(
        "_low", F.round((upto - F.col("need")) * F.lit(scale)).cast("long")
    )
    edges = edges.where("_low < _high").select(
        "source_no",
        "_low",
        "_high",
        F.explode(F.sequence(F.shiftright("_low", shift), F.shiftright(F.col("_high") - 1, shift))).alias("_cell"),
    )
    points = plan.sparkSession.range(total).withColumn(
        "_point", F.conv(F.reverse(F.lpad(F.bin("id"), bits, "0")), 2, 10).cast("long")
    )
    points = points.withColumn("_cell", F.shiftright("_point", shift))
    drawn = points.join(edges, "_cell").where("_point >= _low AND _point < _high")
    drawn = drawn.select(F.col("id").alias("slot"), "source_no", F.shiftright("id", 10).alias("_span"))
    drawn = drawn.withColumn("_one", F.lit(1).cast("long"))
    ranked = running_total(drawn, "source_no", "_span", ["slot"], "_one", "rank").select("slot", "source_no", "rank")
    counts = drawn.groupBy("source_no").agg(F.count(F.lit(1)).alias("_drawn"))
    lacking = plan.join(counts, "source_no", "left").withColumn("_drawn", F.coalesce("_drawn", F.lit(0)))
    lacking = lacking.where("_drawn < need").select(
        "source_no", "_drawn", F.explode(F.expr("sequence(_drawn, need - 1)")).alias("rank")
    )
    lacking = lacking.select(
        (F.lit(total) + (F.col("rank") - F.col("_drawn")) * n_sources + F.col("source_no")).alias("slot"),
        "source_no",
        "rank",
    )
    return ranked.unionByName(lacking).join(plan, "source_no").where("rank < need")


def mix(
    docs: DataFrame,
    share: float = 1.5,
    most: float = 2.0,
    weights: Sequence[float] = WEIGHTS,
    block: int = BLOCK_WORDS,
    seed: int = 17,
    rest: Sequence[str] = (),
) -> DataFrame:
    """What the mix takes of each document, one row per document and pass over its source.

    ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``epoch`` (passes count from
    0), ``taken`` words, from the document's word ``first``; ``slot`` is where the mix first
    takes some of it. Blocks that no pass takes are summed up in a row with null ``epoch``.
    ``one`` and ``two`` are ``row_keys`` of the document, over the columns ``rest`` as well.
    A pass takes documents whole but for the one at which a source's words are complete.
    Taken words of a source are its target, rounded. The schedule's surplus or lack, a few slots
    a source, is settled at its end.

    Null or empty text: size 0. Null source: a source, the last. Null or repeated ``doc_id``:
    rows count as documents of their own. A text longer than a block: spans blocks. No rows: no
    rows. Other columns: ignored. Reruns agree; equal rows are interchangeable.
    One task orders the sources; it gets one row for each.
    """
    sized = sizes(docs, seed, rest)
    sources = source_targets(sized, share, most, weights)
    take = F.round("target").cast("long")
    n_blocks = F.ceil(F.col("source_size") / F.lit(block))
    rest = F.col("take") - F.floor(F.col("take") / F.nullif("source_size", F.lit(0))) * F.col("source_size")
    plan = sources.withColumn("take", take).withColumn("n_blocks", n_blocks)
    need = F.floor(F.col("take") / F.nullif("source_size", F.lit(0))) * F.col("n_blocks") + F.ceil(rest / F.lit(block))
    plan = materialize(
        plan.withColumn("need", F.when(F.col("source_size") > 0, need).otherwise(F.lit(0)).cast("long")), "mix-plan"
    )
    rows, total = sized.count(), plan.agg(F.sum("need")).first()[0] or 0
    named = sized.join(plan.drop("take", "n_blocks", "need"), sized["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    empty = named.where("size = 0").select(*KEPT, *_nothing())
    if total == 0:
        return named.select(*KEPT, *_nothing())
    bits = _span_bits(rows)
    span = F.shiftrightunsigned("mark", 64 - bits) if bits else F.lit(0).cast("long")
    filled = named.where("size > 0").withColumn("_span", span)
    placed = running_total(filled, "source_no", "_span", ["mark", "two"], "size", "pos")
    pieces = placed.withColumn(
        "block", F.explode(F.expr(f"sequence(pos div {block}, (pos + size - 1) div {block})"))
    )
    schedule = _slots(plan, total).select(
        "source_no",
        "slot",
        (F.col("rank") % F.col("n_blocks")).alias("block"),
        F.floor(F.col("rank") / F.col("n_blocks")).alias("epoch"),
        F.col("take").alias("_take"),
    )
    joined = pieces.join(schedule, ["source_no", "block"], "left")
    low = F.greatest("pos", F.col("block") * block)
    end = F.least(F.col("block") * block + block, F.col("_take") - F.col("epoch") * F.col("source_size"))
    high = F.least(F.col("pos") + F.col("size"), end)
    none = F.lit(0).cast("long")
    got = F.when(F.col("slot").isNull(), none).otherwise(F.greatest(high - low, none))
    got = joined.withColumn("_got", got).withColumn("_low", low)
    some = F.col("_got") > 0
    taken = (
        got.groupBy("source_no", "pos", *KEPT, F.when(some, F.col("epoch")).alias("epoch"))
        .agg(
            F.coalesce(F.sum("_got"), F.lit(0)).alias("taken"),
            F.min(F.when(some, F.col("_low") - F.col("pos"))).alias("first"),
            F.min(F.when(some, F.col("slot"))).alias("slot"),
        )
        .select(*KEPT, "epoch", "taken", "first", "slot", "source_no", "pos")
    )
    return taken.unionByName(empty)


def _nothing() -> list[Column]:
    names = (("epoch", None), ("taken", 0), ("first", None), ("slot", None), ("source_no", None), ("pos", None))
    return [F.lit(value).cast(T.LongType()).alias(name) for name, value in names]


def taken_words(mixed: DataFrame) -> DataFrame:
    """One row per document of a mix, with the words of all passes, their number and the slot of the first."""
    names, told = ["doc_id", "size", "source_size", "target"], ["taken", "passes", "slot"]
    filled = mixed.where("pos IS NOT NULL").groupBy("source_no", "pos", *names)
    filled = filled.agg(F.sum("taken").alias("taken"), F.count("epoch").alias("passes"), F.min("slot").alias("slot"))
    empty = mixed.where("pos IS NULL").withColumn("passes", F.lit(0).cast("long"))
    return filled.select(*names, *told).unionByName(empty.select(*names, *told))


def mixed_documents(docs: DataFrame, in_order: bool = True, **how: object) -> DataFrame:
    """The mix as rows of ``docs``: each document once per pass that takes some of it, in the order of the schedule.

    Rows are dealt and sorted by slot, so written files follow each other as the mix goes; without
    ``in_order`` they stay where their join leaves them, which saves a shuffle of all texts. The
    document at which a source is complete is cut to the words taken, joined by one space.
    Documents that no pass takes, and those without words, are left out. Rows that agree in all
    columns are as many rows of the mix; those that differ in any stay apart.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "source", "text")]
    passes = mix(docs, rest=rest, **how).where("taken > 0").select("one", "two", "size", "first", "taken", "slot")
    # One of the rows that agree in everything stands for them; each task sends one at most.
    keys = Window.partitionBy("one", "two").orderBy("one")
    whole = docs.select(F.struct("*").alias("_doc"), *row_keys(rest))
    whole = whole.withColumn("_nth", F.row_number().over(keys)).where("_nth = 1")
    joined = whole.join(passes, ["one", "two"])
    if in_order:
        joined = joined.repartitionByRange("slot").sortWithinPartitions("slot")
    full = F.col("_doc.text").cast("string")
    words = F.regexp_extract_all(full, F.lit(f"({WORD})"), F.lit(1))
    some = F.array_join(F.slice(words, (F.col("first") + 1).cast("int"), F.col("taken").cast("int")), " ")
    text = F.when(F.col("taken") < F.col("size"), some).otherwise(full)
    return joined.select(*(text.alias(c) if c == "text" else F.col("_doc").getField(c).alias(c) for c in docs.columns))
