"""Phrases whose words stand together more often than their frequencies make expect.

Every word starts a window: its language, itself and the words after it within its piece of text.
A window's count and those of all its beginnings are sums over ranges of sorted windows, so counts are
kept as weighted acyclic automata. Tasks sort the windows of a shard and build its automata. Regular
samples of all shards' windows cut the order into ranges; each range's automata are united, weights
added. A beginning that reaches over a range's border is put together from its borders' sums. Frequent phrases
stay, as one automaton per range.

The counts of a phrase's parts lie in other ranges. Each range asks: the automaton of the parts it needs,
one per range that has them, each part once with the largest count of a phrase that asks for it. There it is
composed with the counts; the answer goes back, and the counts that came along tell which
phrases are covered by longer ones. So a word that all phrases share is asked for once a range, and no
group grows with a word's frequency; ranges that are asked much answer in several tasks.

The driver holds the ranges' bounds, chosen from a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.shipping import ship
from tidemark.llm.transducers import EMPTY, Weighted, compose, cut, decode, encode, range_of, sorted_alphabet, union, weighted
from tidemark.llm.words import LOWER, SPACE, Texts, blocks, find_words, slices
from tidemark.scratch import materialize

MOST_WORDS = 3
LEAST_COUNT = 10
COVERED = (50, 100)  # a phrase goes if a longer one has this share of its count
TOP = 2000
SCALE = 1_000_000
NO_LANGUAGE = "und"

MOST_SAMPLES = 1_000_000


@dataclass(frozen=True)
class Sizes:
    """What a task holds at a time; larger executors may take more."""

    shard_words: int = 1 << 20  # words that a task sorts at a time
    shard_bytes: int = 64 << 20  # of their distinct words, repeated for each slice of texts
    chunk_rows: int = 1 << 18  # windows of one automaton of a shard
    range_rows: int = 1 << 20  # windows in one range, those of several shards each by itself, about
    answer_bytes: int = 32 << 20  # of questions that one task answers

    @property
    def sample_rows(self) -> int:
        """Windows of which one is a sample."""
        return max(1, self.range_rows // 32)


CUTS = b".,;:!?\n\x0b\x0c\r"
_FOLD = LOWER.copy()
_FOLD[[9, *CUTS]] = 32
_CUT = np.zeros(256, bool)
_CUT[list(CUTS)] = True

SHARD = "samples array<binary>, n_rows long, automaton binary"
RANGE = "range int, edge array<binary>, weight long, automaton binary"
ANSWER = "range int, kind int, automaton binary"
COUNTS, ANSWERS, LONGER = 0, 1, 2


class Shard:
    """Words of some texts: numbers among distinct symbols, which stand beside them piece by piece."""

    def __init__(self, most_words: int, sizes: Sizes):
        self.most_words, self.sizes = most_words, sizes
        self._empty()

    def _empty(self) -> None:
        self.symbols: list[pa.Array] = []
        self.n_symbols = self.bytes = self.n = 0
        self.words: list[np.ndarray] = []
        self.begins: list[np.ndarray] = []
        self.languages: list[np.ndarray] = []

    def add(self, words: pa.DictionaryArray, begins: np.ndarray, languages: pa.DictionaryArray) -> None:
        for coded, parts in ((words, self.words), (languages, self.languages)):
            parts.append(np.asarray(coded.indices) + self.n_symbols)
            self.symbols.append(coded.dictionary)
            self.n_symbols += len(coded.dictionary)
            self.bytes += coded.dictionary.nbytes
        self.begins.append(begins)
        self.n += len(begins)

    def full(self) -> bool:
        return self.n >= self.sizes.shard_words or self.bytes >= self.sizes.shard_bytes

    def windows(self, last: bool) -> Weighted | None:
        """Counted windows. But for the last time, the last words stay: their windows are not known yet."""
        if not self.n:
            return None
        words, begins, languages = (np.concatenate(x) for x in (self.words, self.begins, self.languages))
        alphabet, numbers = sorted_alphabet(pa.concat_arrays(self.symbols))
        words, languages = numbers[words], numbers[languages]
        n = len(words) if last else max(0, len(words) - self.most_words + 1)
        piece = np.cumsum(begins)
        places = [languages[:n], words[:n]]
        for ahead in range(1, self.most_words):
            place = np.zeros(n, np.int64)
            some = max(0, min(n, len(words) - ahead))
            place[:some] = np.where(piece[:some] == piece[ahead : ahead + some], words[ahead : ahead + some], 0)
            places.append(place)
        rows = weighted(alphabet, places) if n else None
        self._empty()
        if n < len(words):
            again = [alphabet.take(pa.array(x[n:])).dictionary_encode() for x in (words, languages)]
            self.add(again[0], begins[n:], again[1])
        return rows


def split_words(texts: Texts) -> Iterator[tuple[pa.DictionaryArray, np.ndarray, np.ndarray]]:
    """Words, whether each begins a piece, and its text.

    A long text is taken block by block; its words are one sequence.
    """
    folded = _FOLD[texts.data]
    cut_before = True
    for low, high in blocks(folded) if len(texts) == 1 else [(0, len(folded))]:
        data = folded[low:high]
        found = find_words(Texts(data, np.array([0, high - low]) if len(texts) == 1 else texts.offsets, 0))
        cuts = np.cumsum(_CUT[texts.data[low:high]])
        if not len(found.starts):
            cut_before |= bool(len(cuts) and cuts[-1])
            continue
        at = cuts[found.starts]
        begins = np.ones(len(at), bool)
        begins[1:] = (at[1:] != at[:-1]) | (found.docs[1:] != found.docs[:-1])
        begins[0] = cut_before or bool(at[0])
        cut_before = bool(cuts[-1] > at[-1])
        offsets = np.zeros(len(found.starts) + 1, np.int64)
        np.cumsum(found.ends - found.starts, out=offsets[1:])
        solid = pa.py_buffer(data[~SPACE[data]])
        words = pa.Array.from_buffers(pa.large_binary(), len(found.starts), [None, pa.py_buffer(offsets), solid])
        yield words.dictionary_encode(), begins, found.docs


def shards(docs: DataFrame, most_words: int = MOST_WORDS, sizes: Sizes = Sizes()) -> DataFrame:
    """Automata of the windows of ``docs`` (``lang``, ``text``), with samples of their windows."""
    ship(docs.sparkSession)

    def emit(rows: Weighted | None, draw: np.random.Generator) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(rows) if rows is not None else 0, sizes.chunk_rows):
            chunk = rows.part(low, min(low + sizes.chunk_rows, len(rows)))
            at = np.arange(draw.integers(sizes.sample_rows), len(chunk), sizes.sample_rows)
            samples = [symbol for key in chunk.keys(at) for symbol in key]
            yield pa.RecordBatch.from_arrays(
                [pa.array([samples], pa.list_(pa.binary())), pa.array([len(chunk)], pa.int64()), pa.array([encode(chunk)], pa.binary())],
                names=["samples", "n_rows", "automaton"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, draw = Shard(most_words, sizes), np.random.default_rng(11)
        for batch in batches:
            languages = batch.column("lang").cast(pa.large_binary())
            for texts in slices(batch.column("text")):
                named = languages.slice(texts.first, len(texts)).dictionary_encode()
                for words, begins, of in split_words(texts):
                    shard.add(words, begins, named.take(pa.array(of)))
                    if shard.full():
                        yield from emit(shard.windows(False), draw)
        yield from emit(shard.windows(True), draw)

    return docs.select("lang", "text").mapInArrow(run, SHARD)


def range_bounds(written: DataFrame, depth: int, range_rows: int) -> list[tuple[bytes, ...]]:
    """Where ranges of about ``range_rows`` windows begin, but the first; from at most about ``MOST_SAMPLES`` samples."""
    n_rows, n_samples = written.agg(F.sum("n_rows"), F.sum(F.size("samples"))).first()
    if not n_rows or n_rows <= range_rows:
        return []
    starts = F.sequence(F.lit(0), F.size("samples") - depth, F.lit(depth))
    keys = written.where(F.size("samples") > 0).select(F.explode(F.transform(starts, lambda i: F.slice("samples", i + 1, depth))).alias("key"))
    share = MOST_SAMPLES / max(1, n_samples // depth)
    if share < 1:
        keys = keys.where(F.pmod(F.hash("key"), F.lit(1 << 20)) < int(share * (1 << 20)))
    found = sorted(tuple(bytes(x) for x in r["key"]) for r in keys.collect())
    n = -(-n_rows // range_rows)
    return sorted({found[len(found) * i // n] for i in range(1, n)}) if found else []


def _blobs(table: pa.Table, kind: int | None = None) -> list[bytes]:
    if kind is not None:
        table = table.filter(pa.array(np.asarray(table["kind"]) == kind))
    return [x.as_py() for x in table["automaton"]]


def _united(blobs: list[bytes], how: np.ufunc = np.add) -> Weighted:
    return union([decode(x) for x in blobs], how)


def deal(written: DataFrame, bounds: list[tuple[bytes, ...]]) -> DataFrame:
    """Automata of shards, cut at the bounds: ``range`` and ``automaton``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("automaton"):
                parts = cut(decode(blob.as_py()), bounds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _ in parts], pa.int32()), pa.array([encode(x) for _, x in parts], pa.binary())],
                    names=["range", "automaton"],
                )

    return written.select("automaton").mapInArrow(run, "range int, automaton binary")


def _range_counts(table: pa.Table, least: int) -> pa.Table:
    """Counts of phrases that lie in one range, and sums of those that may go on in the next."""
    number = table["range"][0].as_py()
    rows = _united(_blobs(table))
    depth, n = len(rows.places), len(rows)
    kept_places, kept_weights, edges, sums = [[] for _ in range(depth)], [], [], []
    changed = np.zeros(n, bool)
    changed[0] = True
    for size in range(1, depth + 1):
        p = rows.places[size - 1]
        changed[1:] |= p[1:] != p[:-1]
        begins = np.flatnonzero(changed)
        counts = np.add.reduceat(rows.weights, begins)
        phrase = rows.places[size - 1][begins] != 0  # else a shorter one that ends its piece
        phrase |= size == 1  # an empty language is one
        if size < depth:
            for i in sorted({0, len(begins) - 1}):
                if phrase[i]:
                    edges.append([*rows.keys([begins[i]])[0][:size], *[EMPTY] * (depth - size)])
                    sums.append(int(counts[i]))
            phrase[[0, -1]] = False
        chosen = phrase & (counts >= (least if size > 1 else 1))
        for i in range(depth):
            kept_places[i].append(rows.places[i][begins[chosen]] if i < size else np.zeros(int(chosen.sum()), np.int64))
        kept_weights.append(counts[chosen])
    inside = weighted(rows.alphabet, [np.concatenate(x) for x in kept_places], np.concatenate(kept_weights))
    blobs = [encode(inside)] if len(inside) else []
    total = len(edges) + len(blobs)
    return pa.table(
        {
            "range": pa.array([number] * total, pa.int32()),
            "edge": pa.array(edges + [None] * len(blobs), pa.list_(pa.binary())),
            "weight": pa.array(sums + [None] * len(blobs), pa.int64()),
            "automaton": pa.array([None] * len(edges) + blobs, pa.binary()),
        }
    )


def phrase_counts(dealt: DataFrame, bounds: list[tuple[bytes, ...]], least: int) -> DataFrame:
    """``range`` and ``automaton``: all phrases found ``least`` times or more, and the languages' totals."""

    def count(table: pa.Table) -> pa.Table:
        return _range_counts(table, least)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [tuple(k) for k in batch.column("edge").to_pylist()]
            alphabet, numbers = sorted_alphabet(pa.array([s for k in keys for s in k], pa.large_binary()))
            numbers = numbers.reshape(len(keys), -1)
            homes = np.array([range_of(bounds, k) for k in keys])
            weights = np.asarray(batch.column("weight")).astype(np.int64)
            for home in np.unique(homes):
                some = homes == home
                rows = weighted(alphabet, [np.ascontiguousarray(c) for c in numbers[some].T], weights[some])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(home)], pa.int32()), pa.array([encode(rows)], pa.binary())], names=["range", "automaton"]
                )

    counted = materialize(dealt.groupBy("range").applyInArrow(count, RANGE), "range-counts")
    edges = counted.where("edge IS NOT NULL").groupBy("edge").agg(F.sum("weight").alias("weight"))
    total = F.element_at("edge", 2) == F.lit(b"")
    edges = edges.where((F.col("weight") >= least) | total)
    settled = edges.mapInArrow(settle, "range int, automaton binary")
    return counted.where("automaton IS NOT NULL").select("range", "automaton").unionByName(settled)


def _phrases(rows: Weighted) -> np.ndarray:
    """How many words each sequence has."""
    return sum((p != 0).astype(np.int64) for p in rows.places[1:])


def _parts(rows: Weighted, lengths: np.ndarray, begin: int, end: np.ndarray | int) -> list[np.ndarray]:
    """The language and the words from ``begin`` up to ``end`` of sequences."""
    depth = len(rows.places)
    empty = np.zeros(len(rows), np.int64)
    out = [rows.places[0]]
    for i in range(1, depth):
        at = begin + i
        out.append(np.where(begin + i <= end, rows.places[at], 0) if at < depth else empty)
    return out


def _ask(table: pa.Table, bounds: list[tuple[bytes, ...]]) -> pa.Table:
    """The parts that a range's phrases need, by the range that has them."""
    source = table["range"][0].as_py()
    rows = _united(_blobs(table))
    lengths = _phrases(rows)
    chosen = lengths >= 2
    rows, lengths = rows.where(chosen), lengths[chosen]
    homes, blobs = [], []
    if len(rows):
        places, longer = [_parts(rows, lengths, 0, 0)], [np.zeros(len(rows), np.int64)]  # the language's total
        for k in range(1, len(rows.places) - 1):
            some = lengths > k
            part, n = rows.where(some), lengths[some]
            for begin, end, last in ((0, np.full(len(part), k), n - 1 == k), (k, n, np.full(len(part), k == 1))):
                places.append(_parts(part, n, begin, end))
                longer.append(np.where(last, part.weights, 0))
        columns = [np.concatenate(c) for c in zip(*places)]
        asked = weighted(rows.alphabet, columns, np.concatenate(longer), np.maximum)
        for home, part in cut(asked, bounds):
            homes.append(home)
            blobs.append(encode(part))
    return pa.table(
        {
            "home": pa.array(homes, pa.int32()),
            "source": pa.array([source] * len(homes), pa.int32()),
            "automaton": pa.array(blobs, pa.binary()),
        }
    )


def _answer(table: pa.Table) -> pa.Table:
    """The counts asked for, by the range that asks; and the largest count of a longer phrase for each phrase here."""
    home = table["home"][0].as_py()
    sources = np.asarray(table["source"].fill_null(-1))
    blobs = [x.as_py() for x in table["automaton"]]
    known = [decode(b) for b, s in zip(blobs, sources) if s < 0]
    ranges, kinds, out, longer = [], [], [], []
    for blob, source in zip(blobs, sources):
        if source < 0 or not known:
            continue
        asked = decode(blob)
        counts = sum(compose(asked, k) for k in known)
        ranges.append(int(source))
        kinds.append(ANSWERS)
        out.append(encode(Weighted(asked.alphabet, asked.places, counts)))
        told = asked.where((asked.weights > 0) & (_phrases(asked) >= 2))
        if len(told):
            longer.append(told)
    if longer:
        ranges.append(home)
        kinds.append(LONGER)
        out.append(encode(union(longer, np.maximum)))
    return pa.table({"range": pa.array(ranges, pa.int32()), "kind": pa.array(kinds, pa.int32()), "automaton": pa.array(out, pa.binary())})


SCORED = "lang string, phrase string, a long, l long, r long, n long, score long"


def _score(table: pa.Table, top: int, covered: tuple[int, int]) -> pa.Table:
    """The first phrases of each language in one range."""
    names = ["lang", "phrase", "a", "l", "r", "n", "score"]
    types = [pa.string(), pa.string(), *[pa.int64()] * 5]
    counts = _blobs(table, COUNTS)
    rows = _united(counts) if counts else None
    found: list[tuple] = []
    if rows is not None:
        rows = rows.where(_phrases(rows) >= 2)
    if rows is not None and len(rows):
        overs = _blobs(table, LONGER)
        if overs:
            rows = rows.where(covered[1] * compose(rows, _united(overs, np.maximum)) < covered[0] * rows.weights)
        lengths = _phrases(rows)
        answers = _united(_blobs(table, ANSWERS), np.maximum)

        def of(part: Weighted, places: list[np.ndarray]) -> np.ndarray:
            return compose(Weighted(part.alphabet, places, part.weights), answers)

        best = [None] * len(rows)
        weights = rows.weights.tolist()
        for k in range(1, len(rows.places) - 1):
            some = np.flatnonzero(lengths > k)
            part, n = rows.where(some), lengths[some]
            left = of(part, _parts(part, n, 0, np.full(len(part), k))).tolist()
            right = of(part, _parts(part, n, k, n)).tolist()
            for i, l, r in zip(some.tolist(), left, right):
                score = SCALE * weights[i] * weights[i] // (l * r)  # whole numbers of any size
                if best[i] is None or score < best[i][0]:
                    best[i] = score, l, r
        totals = of(rows, _parts(rows, lengths, 0, 0)).tolist()
        columns = [rows.alphabet.take(pa.array(p)).to_pylist() for p in rows.places]
        by_language: dict[bytes, list] = {}
        for i, key in enumerate(zip(*columns)):
            score, l, r = best[i]
            phrase = b" ".join(w for w in key[1:] if w)
            by_language.setdefault(key[0], []).append((-score, -weights[i], phrase, l, r, totals[i]))
        for language, some in by_language.items():
            for score, a, phrase, l, r, n in sorted(some)[:top]:
                found.append((language.decode(), phrase.decode(), -a, l, r, n, -score))
    columns = list(zip(*found)) if found else [()] * len(names)
    return pa.table({name: pa.array(c, t) for name, c, t in zip(names, columns, types)})


def collocations(
    docs: DataFrame,
    most_words: int = MOST_WORDS,
    least: int = LEAST_COUNT,
    top: int = TOP,
    covered: tuple[int, int] = COVERED,
    sizes: Sizes = Sizes(),
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the first ``top`` phrases of each language.

    Texts (``text``, ``lang``) are split at ``.,;:!?`` and line ends into pieces, these at spaces and tabs
    into words, A-Z lowered. Phrases of 2 to ``most_words`` words found ``least`` times or more are
    cut in two; ``score`` is a million times a * a / (l * r), rounded down, for the counts of phrase
    and parts, at the cut with the lowest. A phrase of which a longer one has the share ``covered``
    goes. Order: score, a, phrase by its bytes. Null ``lang``: ``und``, together with texts that say so. Null
    or empty text, or no word: nothing. Rows count as often as they stand; other columns are
    ignored. Texts and words of any length: whole. No rows: no rows.
    """
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    written = materialize(shards(rows, most_words, sizes), "shards")
    bounds = range_bounds(written, most_words + 1, sizes.range_rows)
    counts = materialize(phrase_counts(deal(written, bounds), bounds, least), "phrase-counts")

    def ask(table: pa.Table) -> pa.Table:
        return _ask(table, bounds)

    def score(table: pa.Table) -> pa.Table:
        return _score(table, top, covered)

    asked = counts.groupBy("range").applyInArrow(ask, "home int, source int, automaton binary")
    asked = materialize(asked, "questions")
    # A range that is asked much answers in several tasks.
    crowds = asked.groupBy("home").agg(F.ceil(F.sum(F.length("automaton")) / sizes.answer_bytes).alias("n_tasks"))
    crowds = materialize(crowds, "question-sizes")
    tasks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_tasks") - 1)).alias("task")
    known = counts.join(crowds, counts["range"] == crowds["home"]).select("home", tasks, F.lit(None).cast("int").alias("source"), "automaton")
    dealt = asked.join(crowds, "home").select(
        "home", F.pmod(F.xxhash64("source"), F.col("n_tasks")).cast("long").alias("task"), "source", "automaton"
    )
    answers = known.unionByName(dealt).groupBy("home", "task").applyInArrow(_answer, ANSWER)
    both = counts.select("range", F.lit(COUNTS).alias("kind"), "automaton").unionByName(materialize(answers, "answers"))
    scored = both.groupBy("range").applyInArrow(score, SCORED)
    first = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(first).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
