"""Near duplicates: documents whose word shingles agree to at least four fifths.

Texts with the same shingles form a class and one of them stands for it. A class is hashed into
MinHash samples; bands of samples name its buckets. The samples are also folded into an odd
sketch, a bitmap that each sample flips a bit of: the bits in which two sketches differ tell how
many samples differ, most precisely for similar texts. In every bucket all members are held
against one of them, the one that a hash of bucket and member puts first; pairs whose sketches
differ too much go, the others are confirmed on their full sets. Linked classes become
components. So a group of copies of any size costs a few pairs per member.

Buckets that then still hold several components are searched again. In small ones the pairs that sizes
and sketches pass are confirmed one by one. Large ones are dealt over blocks of members: a task
gets two blocks with their sets, compares those pairs that no bucket before has, that lie in
different components and that sizes and sketches pass, and gives a spanning forest of the links it
finds. So no pair leaves a task; what grows with the square of a group of texts just below the
threshold is arithmetic on blocks, not rows. Every pair that shares a bucket is either
confirmed, or refuted, or in one component already.

Two texts at the threshold share no bucket with probability (1 - 0.8**4)**32, 5 in 100 million,
and their sketches differ too much (five standard deviations) with 3 in 10 million.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shipping import ship
from tidemark.llm.vector_dup import forest
from tidemark.llm.words import LOWER, Texts, gather, hashed_words, mix, signed, slices, stream, window_hashes
from tidemark.scratch import materialize

SHINGLE_WORDS = 5
PERCENT = 80
BANDS, BAND_ROWS = 32, 4
SAMPLES = BANDS * BAND_ROWS
SKETCH_BITS = 256
LEAST_ESTIMATE = 0.55  # of the sketches, for a threshold of 0.8
LARGE_BUCKET = 32  # larger buckets are compared in blocks, with the same result
BLOCK_ROWS, BLOCK_BYTES = 1024, 8 << 20  # members, and bytes of their sets, in a block
COMMON_PAIRS = 4096  # pairs of rows with a shingle from which on a matrix product counts it
BROADCAST_IDS = 1_000_000
CACHED_SHINGLES = 4_000_000

_MULTIPLIERS = (stream(31, SAMPLES) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (stream(32, SAMPLES) >> np.uint64(32)).astype(np.uint32)

SKETCHED = "doc_id long, n_shingles long, one long, two long, bands array<long>, sketch array<long>"


def shingle_sets(texts: Texts, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, and the bounds of each text's.

    A text with fewer words than a shingle has one, the whole sequence; without words, none.
    """
    words = hashed_words(texts, LOWER)
    n_words = np.diff(words.bounds)
    windows = window_hashes(words.hashes, size)
    inside = words.docs[: len(windows)] == words.docs[size - 1 : size - 1 + len(windows)]
    parts, docs = [windows[inside]], [words.docs[: len(windows)][inside]]
    for n in range(1, size):
        short = np.flatnonzero(n_words == n)
        if len(short):
            parts.append(window_hashes(words.hashes, n, n)[words.bounds[short]])
            docs.append(short)
    hashes, docs = np.concatenate(parts), np.concatenate(docs)
    order = np.lexsort((hashes, docs))
    hashes, docs = hashes[order], docs[order]
    if len(hashes):
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
        hashes, docs = hashes[new], docs[new]
    return hashes, np.searchsorted(docs, np.arange(len(texts) + 1))


def min_hashes(hashes: np.ndarray, begins: np.ndarray, n: int = SAMPLES) -> np.ndarray:
    """``n`` minima for each run of hashes that starts at ``begins``; no run may be empty."""
    values = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(begins), n), np.uint32)
    for k in range(n):
        scattered = (values + _SHIFTS[k]) * _MULTIPLIERS[k]
        scattered ^= scattered >> np.uint32(15)
        scattered *= np.uint32(0x2C1B3C6D)
        out[:, k] = np.minimum.reduceat(scattered, begins)
    return out


def odd_sketches(samples: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity bitmaps of the samples, ``bits`` bits in 64-bit numbers."""
    out = np.zeros((len(samples), bits // 64), np.uint64)
    rows = np.arange(len(samples))
    for k in range(samples.shape[1]):
        place = mix(samples[:, k].astype(np.uint64) + (np.uint64(k) << np.uint64(40))) % np.uint64(bits)
        out[rows, (place >> np.uint64(6)).astype(np.int64)] ^= np.uint64(1) << (place & np.uint64(63))
    return out


def most_differing_bits(estimate: float, samples: int = SAMPLES, bits: int = SKETCH_BITS) -> int:
    """Bits in which two sketches may differ and still estimate a similarity of ``estimate``."""
    differing = 2 * samples * (1 - estimate)
    return math.ceil(bits * (1 - (1 - 2 / bits) ** differing) / 2)


def band_keys(samples: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(samples), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(samples), band + 1, np.uint64)
        for row in range(BAND_ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + samples[:, band * BAND_ROWS + row])
        keys[:, band] = key
    return keys


def _lists(values: np.ndarray, rows: np.ndarray, n: int) -> pa.Array:
    """A list column with ``values`` at ``rows`` and empty lists elsewhere."""
    lengths = np.zeros(n, np.int32)
    lengths[rows] = values.shape[1] if len(rows) else 0
    bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(signed(np.ascontiguousarray(values.reshape(-1)))))


def sketches(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """Set size, two hashes of the set, bucket names and sketch of each document."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column("text")):
                hashes, bounds = shingle_sets(texts, size)
                counts = np.diff(bounds)
                full = np.flatnonzero(counts)
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes + np.uint64(s)))]) for s in (1, 2)]
                one, two = (signed(x[bounds[1:]] - x[bounds[:-1]]) for x in sums)
                samples = min_hashes(hashes, bounds[:-1][full]) if len(full) else np.zeros((0, SAMPLES), np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(texts.first, len(texts)),
                        pa.array(counts.astype(np.int64)),
                        pa.array(one),
                        pa.array(two),
                        _lists(band_keys(samples), full, len(texts)),
                        _lists(odd_sketches(samples), full, len(texts)),
                    ],
                    names=["doc_id", "n_shingles", "one", "two", "bands", "sketch"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, SKETCHED)


def differing_bits(a: str, b: str) -> Column:
    """In how many bits two sketch columns differ."""
    parts = [F.bit_count(F.get(a, i).bitwiseXOR(F.get(b, i))) for i in range(SKETCH_BITS // 64)]
    return sum(parts[1:], parts[0])


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of the documents named in ``ids``, each text once."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", "left_semi")


def confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets agree to ``percent`` of their union."""
    ship(docs.sparkSession)
    pairs = materialize(pairs, "candidate-pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    texts = materialize(texts_of(docs, materialize(ids, "candidate-ids")), "candidate-texts")
    both = pairs.join(texts.toDF("a", "left_text"), "a").join(texts.toDF("b", "right_text"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[bytes, np.ndarray] = {}  # of texts seen last; a document stands in many pairs
        held = 0
        for batch in batches:
            keep = []
            for texts in zip(batch.column("left_text"), batch.column("right_text")):
                pair = []
                for text in texts:
                    raw = text.as_buffer().to_pybytes()
                    found = sets.get(raw)
                    if found is None:
                        whole = Texts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), 0)
                        found = shingle_sets(whole, size)[0]
                        if held > CACHED_SHINGLES:
                            sets.clear()
                            held = 0
                        sets[raw] = found
                        held += len(found)
                    pair.append(found)
                total = len(pair[0]) + len(pair[1])
                together = np.sort(np.concatenate(pair), kind="stable")
                shared = int((together[1:] == together[:-1]).sum())
                keep.append(total > 0 and 100 * shared >= percent * (total - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "left_text", "right_text").mapInArrow(run, "a long, b long").distinct()


def full_sets(texts: DataFrame, size: int) -> DataFrame:
    """``rep`` and ``members``, the sorted hashes of its shingles as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                hashes, bounds = shingle_sets(part, size)
                offsets = pa.py_buffer((bounds * 8).astype(np.int32))
                sets = pa.Array.from_buffers(pa.binary(), len(part), [None, offsets, pa.py_buffer(hashes)])
                ids = batch.column("doc_id").slice(part.first, len(part))
                yield pa.RecordBatch.from_arrays([ids, sets], names=["rep", "members"])

    return texts.select("doc_id", "text").mapInArrow(run, "rep long, members binary")


def overlaps(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many values each set of ``one`` shares with each of ``two``; values of a set differ.

    Values that few pairs share are counted pair by pair, others by products of 0-1 matrices.
    """
    out = np.zeros(len(one) * len(two), np.int64)
    sides = [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (one, two)]
    _, numbers = np.unique(np.concatenate(sides), return_inverse=True)
    codes = np.split(numbers.reshape(-1), [len(sides[0])])
    rows = [np.repeat(np.arange(len(x)), [len(y) for y in x]) for x in (one, two)]
    n = int(numbers.max()) + 1 if len(numbers) else 0
    counts = [np.bincount(c, minlength=n) for c in codes]
    pairs = counts[0] * counts[1]
    common = np.flatnonzero(pairs >= COMMON_PAIRS)
    for low in range(0, len(common), 2048):
        place = np.full(n, -1)
        place[common[low : low + 2048]] = np.arange(len(common[low : low + 2048]))
        flags = []
        for code, row, x in zip(codes, rows, (one, two)):
            at = place[code]
            flag = np.zeros((len(x), min(2048, len(common) - low)), np.float32)
            flag[row[at >= 0], at[at >= 0]] = 1
            flags.append(flag)
        out += (flags[0] @ flags[1].T).astype(np.int64).reshape(-1)
    rare = (pairs > 0) & (pairs < COMMON_PAIRS)
    order = np.argsort(codes[0], kind="stable")
    begins = np.cumsum(counts[0]) - counts[0]
    right = np.flatnonzero(rare[codes[1]])
    ends = np.cumsum(counts[0][codes[1][right]])
    low = 0
    while low < len(right):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + (4 << 20), "right")))
        some = right[low:high]
        lengths = counts[0][codes[1][some]]
        left = rows[0][order[gather(begins[codes[1][some]], lengths)]]
        out += np.bincount(left * len(two) + np.repeat(rows[1][some], lengths), minlength=len(out))
        low = high
    return out.reshape(len(one), len(two))


def _block_links(table: pa.Table, percent: int) -> pa.Table:
    """A spanning forest of the links between two blocks of a bucket, or within one."""
    table = table.combine_chunks()
    alone = table["one"][0].as_py() == table["two"][0].as_py()
    left = np.ones(table.num_rows, bool) if alone else np.asarray(table["is_left"])
    empty = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    if not left.any() or (not alone and left.all()):
        return empty

    def lists(name: str) -> np.ndarray:
        column = table[name].combine_chunks() if isinstance(table[name], pa.ChunkedArray) else table[name]
        return np.asarray(column.flatten()).reshape(table.num_rows, -1)

    ids, part, n = (np.asarray(table[c]) for c in ("rep", "part", "n_shingles"))
    bands, sketch = lists("bands"), lists("sketch").view(np.uint64)
    sides = (left, left) if alone else (left, ~left)
    a, b = (np.flatnonzero(x) for x in sides)
    if alone:
        asked = np.triu(np.ones((len(a), len(b)), bool), 1)
    else:
        asked = np.ones((len(a), len(b)), bool)
    asked &= part[a][:, None] != part[b]
    asked &= np.minimum(n[a][:, None], n[b]) * 100 >= np.maximum(n[a][:, None], n[b]) * percent
    band = int(np.flatnonzero(bands[0] == table["bucket"][0].as_py())[0])
    for before in range(band):  # the first bucket that a pair shares is the one that counts
        asked &= bands[a, before][:, None] != bands[b, before]
    differing = np.zeros((len(a), len(b)), np.int64)
    for word in range(sketch.shape[1]):
        differing += np.bitwise_count(sketch[a, word][:, None] ^ sketch[b, word])
    asked &= differing <= _most_differing(percent)
    rows, columns = np.flatnonzero(asked.any(axis=1)), np.flatnonzero(asked.any(axis=0))
    if not len(rows):
        return empty
    members = table["members"]
    sets = [[np.frombuffer(members[int(i)].as_buffer(), np.uint64) for i in x] for x in (a[rows], b[columns])]
    shared = overlaps(*sets)
    union = n[a[rows]][:, None] + n[b[columns]] - shared
    linked = (100 * shared >= percent * union) & asked[np.ix_(rows, columns)]
    of_rows, of_columns = forest(linked)
    found, n_parts = np.concatenate([ids[a[rows]], ids[b[columns]]]), np.concatenate([of_rows, of_columns])
    roots = np.zeros(int(n_parts.max()) + 1, np.int64)
    roots[n_parts[n_parts >= 0][::-1]] = found[n_parts >= 0][::-1]
    kept = np.flatnonzero(n_parts >= 0)
    ends = roots[n_parts[kept]]
    differ = found[kept] != ends
    return pa.table({"a": pa.array(found[kept][differ]), "b": pa.array(ends[differ])})


def large_bucket_links(parts: DataFrame, heads: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between members (``rep``, ``part``) of large buckets: no pair, but a spanning forest per task."""
    ids = materialize(parts.select(F.col("rep").alias("doc_id")).distinct(), "large-bucket-ids")
    texts = materialize(texts_of(docs, ids), "large-bucket-texts")
    told = heads.select("rep", "n_shingles", "sketch", "bands").join(full_sets(texts, size).distinct(), "rep")
    # A document id may stand on several texts; the class has the set of the size that it names.
    told = told.where(F.length("members") == 8 * F.col("n_shingles"))
    told = materialize(told, "large-bucket-sets")
    members = parts.select("bucket", "rep", "part").join(told, "rep")
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_ROWS, F.sum(F.length("members")) / BLOCK_BYTES))
    counts = materialize(members.groupBy("bucket").agg(blocks.alias("n_blocks")), "bucket-blocks")
    dealt = members.join(counts, "bucket").withColumn("block", F.pmod(F.xxhash64("bucket", "rep"), F.col("n_blocks")))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    dealt = dealt.select(
        "bucket",
        F.least("block", "with").alias("one"),
        F.greatest("block", "with").alias("two"),
        (F.col("block") <= F.col("with")).alias("is_left"),
        *("rep", "part", "n_shingles", "bands", "sketch", "members"),
    )

    def solve(table: pa.Table) -> pa.Table:
        return _block_links(table, percent)

    return dealt.groupBy("bucket", "one", "two").applyInArrow(solve, "a long, b long").distinct()


def link_classes(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketched rows; those with words and their class (``rep``); the component of each class that has links."""
    rows = docs.where("doc_id IS NOT NULL")
    found = materialize(sketches(docs, size), "sketches")
    named = found.where("doc_id IS NOT NULL AND n_shingles > 0")
    same = ["n_shingles", "one", "two"]
    # Written, so that the join of a class with very many copies can be split.
    classes = materialize(named.groupBy(*same).agg(F.min("doc_id").alias("rep")), "classes")
    members = materialize(named.select("doc_id", *same).join(classes, same), "members")
    heads = named.withColumnRenamed("doc_id", "rep").join(classes, [*same, "rep"]).dropDuplicates([*same])
    heads = materialize(heads.select("rep", "n_shingles", "bands", "sketch"), "class-heads")
    # A document id that stands on several texts links their classes.
    several = members.select("doc_id", "rep").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    links = members.join(several, "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    buckets = heads.select(F.explode("bands").alias("bucket"), "rep")
    hubs = buckets.groupBy("bucket").agg(F.min_by("rep", F.xxhash64("rep", "bucket")).alias("hub"), F.count(F.lit(1)).alias("n"))
    shared = materialize(buckets.join(hubs.where("n > 1"), "bucket"), "buckets")
    pairs = shared.where("rep <> hub").select(F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b")).distinct()
    left = heads.select(F.col("rep").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("s_a"))
    right = heads.select(F.col("rep").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("s_b"))
    near = _alike(percent)
    pairs = pairs.join(left, "a").join(right, "b").where(near).select("a", "b").distinct()
    links = materialize(links.unionByName(confirmed(pairs, rows, size, percent)), "confirmed")
    linked = materialize(components(links), "components")

    # Buckets of more than two that still hold several components: pairs with no hub in them.
    parts = shared.where("n > 2").join(linked, F.col("rep") == F.col("node"), "left")
    parts = parts.select("bucket", "rep", "hub", "n", F.coalesce("component", "rep").alias("part"))
    mixed = parts.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    parts = materialize(parts.where("rep <> hub").join(mixed.select("bucket"), "bucket"), "mixed-buckets")
    if parts.isEmpty():
        return found, members, linked
    large = F.col("n") > LARGE_BUCKET
    in_blocks = large_bucket_links(parts.where(large), heads, rows, size, percent)
    small = materialize(parts.where(~large).join(heads.drop("bands"), "rep"), "mixed-members")
    names = {"rep": "", "part": "p_", "n_shingles": "n_", "sketch": "s_"}
    one = small.select("bucket", *(F.col(x).alias(f"{y}a") for x, y in names.items()))
    other = small.select("bucket", *(F.col(x).alias(f"{y}b") for x, y in names.items()))
    apart = (F.col("a") < F.col("b")) & (F.col("p_a") != F.col("p_b"))
    again = one.join(other, (one["bucket"] == other["bucket"]) & apart & near)
    more = confirmed(again.select("a", "b").distinct(), rows, size, percent).unionByName(in_blocks)
    links = materialize(links.unionByName(more), "confirmed")
    return found, members, materialize(components(links), "components")


def _most_differing(percent: int) -> int:
    """Bits in which the sketches of a pair at the threshold differ at most, but for five deviations."""
    return most_differing_bits(max(0.0, percent / 100 - (0.8 - LEAST_ESTIMATE)))


def _alike(percent: int) -> Column:
    """Sizes that allow the threshold, and sketches that do not speak against it."""
    sizes = (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    return sizes & (differing_bits("s_a", "s_b") <= _most_differing(percent))


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` of each document (``doc_id``, ``text``).

    Documents are linked if their sets of ``size``-word shingles, A-Z lowered, share at least
    ``percent`` of their union; ``component_id`` is the smallest ``doc_id`` that links lead to,
    and that document is kept. Fewer words: the whole sequence is one shingle. Null or empty
    text, or no word: linked with nothing. Null ``doc_id``: linked with nothing, null component,
    kept. Rows that share a ``doc_id`` are one document: each gets its own row, their texts are
    linked. Texts of any length: whole. No rows: no rows. Other columns: ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found, members, linked = link_classes(rows, size, percent)
    told = members.join(linked, members["rep"] == linked["node"], "left")
    told = told.select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    rest = found.where("doc_id IS NULL OR n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return told.unionByName(rest).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
