"""Token counts of texts under a unigram vocabulary, by dynamic programming over a trie.

Words of a batch go into a trie, each distinct word once. A node stands for a prefix and holds the
score of its best segmentation and how many tokens that has; both follow from the node's
ancestors, so a prefix is computed once, however many words share it. A word's count is what the
node at its end holds. Counts of a text are sums over its words.

Nothing is shuffled: a task's trie depends on its own rows, is kept by the worker from batch to
batch and starts anew when it is full, which changes speed and never counts.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shipping import ship
from tidemark.llm.words import Texts, gather, hashed_words, slices

BOUNDARY = "▁"  # opens each word, as the piece file spells it
MOST_NODES = 400_000
MOST_WORDS = 400_000
LONG_WORD = 200  # characters; longer words are computed without being stored
UNIT = 1 << 20
CHARACTER_BITS = 21  # of a key, below the bits of a node or state
NO_PIECE = np.iinfo(np.int64).min


@functools.cache
def piece_scores(path: str) -> tuple[dict[str, int], int]:
    """Whole-number scores of the pieces in a file, and that of a character without a piece.

    The file orders its pieces by stored score; the piece of rank r gets the probability that
    Zipf's law gives it, in units of 2**-20 of the logarithm. An unknown character is ten below
    the last piece and costs one token for each of its bytes.
    """
    import sentencepiece

    file = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(file.get_piece_size()) if not (file.is_control(i) or file.is_unknown(i) or file.is_byte(i))]
    ids.sort(key=lambda i: (-file.get_score(i), i))
    total = math.log(sum(1 / r for r in range(1, len(ids) + 1)))
    scores = {file.id_to_piece(i): round(-UNIT * (math.log(r) + total)) for r, i in enumerate(ids, 1)}
    return scores, min(scores.values()) - 10 * UNIT


class PrefixTrie:
    """Best segmentations of all prefixes of the words in it, as arrays over its nodes.

    Words are added many at a time, one character of each at a time: the nodes of one depth
    are settled together, from those above them.
    """

    def __init__(self, scores: dict[str, int], unknown: int):
        self.unknown = unknown
        self.longest = max(map(len, scores))
        # A state is a run of characters that ends a piece. An edge puts a character before a
        # run: no longer piece can end where a shorter run ends none.
        self.runs = {"": 0}
        for piece in scores:
            for begin in range(len(piece) - 1, -1, -1):
                self.runs.setdefault(piece[begin:], len(self.runs))
        edges = sorted((self.runs[run[1:]] << CHARACTER_BITS | ord(run[0]), to) for run, to in self.runs.items() if run)
        edges.append((np.iinfo(np.int64).max, 0))
        self.edges, self.states = np.array(edges, np.int64).T.copy()
        self.scores = np.array([scores.get(run, NO_PIECE) for run in self.runs], np.int64)
        self.clear()

    def clear(self) -> None:
        """Leave the root, the empty prefix, with no tokens."""
        self.size = 1
        self.children: dict[int, int] = {}  # by node and character
        # Of each node: its best score, the tokens of that, the node above and its character.
        self.best, self.tokens, self.parents, self.characters = np.zeros((4, 1024), np.int64)

    def _settle(self, nodes: np.ndarray) -> None:
        """Score nodes whose parents are settled; the higher score wins, of equal scores the fewer tokens."""
        parents = self.parents[nodes]
        best = self.best[parents] + self.unknown
        tokens = self.tokens[parents] + utf8_bytes(self.characters[nodes])
        at, ends, states = np.arange(len(nodes)), nodes, np.zeros(len(nodes), np.int64)
        while len(at):
            wanted = states << CHARACTER_BITS | self.characters[ends]
            edges = np.searchsorted(self.edges, wanted)
            hit = self.edges[edges] == wanted
            at, ends, states = at[hit], self.parents[ends[hit]], self.states[edges[hit]]
            piece = np.flatnonzero(self.scores[states] != NO_PIECE)
            to, score = at[piece], self.best[ends[piece]] + self.scores[states[piece]]
            fewer = self.tokens[ends[piece]] + 1
            better = (score > best[to]) | ((score == best[to]) & (fewer < tokens[to]))
            best[to[better]], tokens[to[better]] = score[better], fewer[better]
            inside = ends > 0
            at, ends, states = at[inside], ends[inside], states[inside]
        self.best[nodes], self.tokens[nodes] = best, tokens

    def _below(self, keys: np.ndarray) -> np.ndarray:
        """The nodes of different (node, character) keys; those that are missing are added."""
        nodes = np.fromiter(map(self.children.get, keys.tolist(), itertools.repeat(0)), np.int64, len(keys))
        new = np.flatnonzero(nodes == 0)
        if len(new):
            added = np.arange(self.size, self.size + len(new))
            self.size += len(new)
            while len(self.best) < self.size:
                arrays = (self.best, self.tokens, self.parents, self.characters)
                self.best, self.tokens, self.parents, self.characters = [np.concatenate([x, np.zeros_like(x)]) for x in arrays]
            nodes[new] = added
            self.parents[added], self.characters[added] = keys[new] >> CHARACTER_BITS, keys[new] & (1 << CHARACTER_BITS) - 1
            self.children.update(zip(keys[new].tolist(), added.tolist()))
            self._settle(added)
        return nodes

    def counts(self, points: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of the best segmentations of words, given as runs of code points.

        The words join the trie; very long ones are computed without being stored.
        """
        nodes = np.zeros(len(starts), np.int64)
        active, depth = np.flatnonzero((lengths > 0) & (lengths <= LONG_WORD)), 0
        while len(active):
            keys = nodes[active] << CHARACTER_BITS | points[starts[active] + depth]
            keys, back = np.unique(keys, return_inverse=True)
            nodes[active] = self._below(keys)[back]
            depth += 1
            active = active[lengths[active] > depth]
        counts = self.tokens[nodes]
        for i in np.flatnonzero(lengths > LONG_WORD).tolist():
            run = points[starts[i] : starts[i] + lengths[i]]
            counts[i] = self._alone(run.astype("<u4").tobytes().decode("utf-32-le"))
        return counts

    def count(self, word: str) -> int:
        """Tokens of the word's best segmentation."""
        points = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.int64)
        return int(self.counts(points, np.zeros(1, np.int64), np.array([len(points)]))[0])

    def _alone(self, word: str) -> int:
        """The same without the trie; as many prefixes are held as the longest piece has characters."""
        recent = deque([(0, 0)], self.longest)  # score and tokens of the prefixes before, newest first
        for end, last in enumerate(word, 1):
            top, least = recent[0]
            top, least = top + self.unknown, least + len(last.encode())
            for begin, (score, tokens) in zip(range(end - 1, -1, -1), recent):
                state = self.runs.get(word[begin:end])
                if state is None:
                    break
                piece = int(self.scores[state])
                if piece != NO_PIECE and (score + piece > top or score + piece == top and tokens + 1 < least):
                    top, least = score + piece, tokens + 1
            recent.appendleft((top, least))
        return recent[0][1]


def utf8_bytes(points: np.ndarray) -> np.ndarray:
    """Bytes of each code point in UTF-8."""
    return 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)


def opened_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words with the opening sign before each, and where each word starts and its length."""
    opening = np.frombuffer(BOUNDARY.encode(), np.uint8)
    lengths = ends - starts
    steps = lengths + len(opening) + 1  # a space after each word, which is in none
    at = np.cumsum(steps) - steps
    spaced = np.full(int(steps.sum()), ord(" "), np.uint8)
    spaced[at[:, None] + np.arange(len(opening))] = opening
    spaced[gather(at + len(opening), lengths)] = data[gather(starts, lengths)]
    text = spaced.tobytes().decode("utf-8", "replace")
    points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    stops = np.flatnonzero(points == ord(" "))
    begins = np.concatenate([[0], stops[:-1] + 1])
    return points, begins, stops - begins


class Counter:
    """Counts by word, kept by a worker."""

    def __init__(self, path: str):
        self.trie, self.known = PrefixTrie(*piece_scores(path)), {}

    def words(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Words and tokens of each text."""
        words = hashed_words(texts)
        back, keys = pd.factorize(words.hashes)
        if len(self.known) + len(keys) > MOST_WORDS or self.trie.size > MOST_NODES:
            self.known.clear()
            self.trie.clear()
        listed = keys.tolist()
        counts = np.fromiter(map(self.known.get, listed, itertools.repeat(-1)), np.int64, len(listed))
        new = np.flatnonzero(counts < 0)
        if len(new):
            seen = np.zeros(len(keys), np.int64)
            seen[back] = np.arange(len(back))
            at = seen[new]
            counts[new] = self.trie.counts(*opened_words(texts.data, words.starts[at], words.ends[at]))
            self.known.update(zip(keys[new].tolist(), counts[new].tolist()))
        sums = np.concatenate([[0], np.cumsum(counts[back])]) if len(back) else np.zeros(1, np.int64)
        return np.diff(words.bounds), sums[words.bounds[1:]] - sums[words.bounds[:-1]]


@functools.cache
def counter(path: str) -> Counter:
    """The worker's counter for a piece file."""
    return Counter(path)


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_words`` and ``n_tokens`` of each document (``doc_id``, ``text``).

    Each word, with the word-opening sign before it, is cut into the pieces with the highest sum
    of scores; of equal sums, into the fewest. A character without a piece is as many tokens as
    it has bytes. Null or empty text: 0. Null ``doc_id``: kept as null. Repeated rows: a row each.
    Texts and words of any length: whole. No rows: no rows. Other columns: ignored.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(path)
        for batch in batches:
            for texts in slices(batch.column("text")):
                n_words, n_tokens = counts.words(texts)
                ids = batch.column("doc_id").slice(texts.first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n_words), pa.array(n_tokens)], names=["doc_id", "n_words", "n_tokens"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_tokens long")
