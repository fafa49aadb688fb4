"""Token counts against a plain search over all segmentations."""

from __future__ import annotations

import functools
import random
import re

import public_tokenizers
import pytest

from tidemark.llm.token_counts import LONG_WORD, PrefixTrie, piece_scores, token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(word, scores, unknown):
    @functools.cache
    def best(i):
        if i == len(word):
            return 0, 0
        rest = best(i + 1)
        found = [(rest[0] + unknown, rest[1] - len(word[i].encode()))]
        for j in range(i + 1, len(word) + 1):
            if word[i:j] in scores:
                rest = best(j)
                found.append((rest[0] + scores[word[i:j]], rest[1] - 1))
        return max(found)

    return -best(0)[1]


@pytest.mark.parametrize("seed", range(3))
def test_trie_against_all_segmentations(seed):
    draw = random.Random(seed)
    scores = {"".join(draw.choice("abc") for _ in range(draw.randint(1, 4))): -draw.randint(1, 6) for _ in range(20)}
    trie = PrefixTrie(scores, -20)
    for _ in range(300):
        word = "".join(draw.choice("abcé") for _ in range(draw.randint(0, 9)))
        assert trie.count(word) == brute(word, scores, -20)


def test_prefixes_are_computed_once():
    trie = PrefixTrie({"a": -1, "ab": -1}, -9)
    trie.count("abab")
    nodes = trie.size
    trie.count("aba")
    trie.count("abab")
    assert trie.size == nodes
    trie.count("abac")
    assert trie.size == nodes + 1


def test_long_words_are_not_stored():
    scores = {"a": -3, "aa": -4, "aaa": -5}
    trie = PrefixTrie(scores, -9)
    assert trie.count("a" * (LONG_WORD + 1)) == brute("a" * (LONG_WORD + 1), scores, -9)
    assert trie.size == 1


def test_documents(spark, frame):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(25).select("doc_id", "text").collect()
    docs = [(r[0], r[1]) for r in rows] + [(None, "a b"), (900, None), (901, ""), (902, "中文 😀"), (902, "中文 😀"), (903, "x" * 3000)]
    scores, unknown = piece_scores(PATH)
    counts = {}

    def count(word):
        if len(word) > 900:
            counts[word] = PrefixTrie(scores, unknown).count("▁" + word)
        elif word not in counts:
            counts[word] = brute("▁" + word, scores, unknown)
        return counts[word]

    expected = []
    for doc_id, text in docs:
        words = WORD.findall(text or "")
        expected.append((doc_id, len(words), sum(map(count, words))))
    df = frame([(*d, 1) for d in docs], "doc_id long, text string, n_words int")
    assert sorted(map(tuple, token_counts(df, PATH).collect()), key=str) == sorted(expected, key=str)


def test_no_rows(spark, frame):
    assert token_counts(frame([], "doc_id long, text string"), PATH).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_long_words_against_all_segmentations(seed):
    draw = random.Random(seed)
    scores = {"".join(draw.choice("abc") for _ in range(draw.randint(1, 4))): -draw.randint(1, 6) for _ in range(20)}
    word = "".join(draw.choice("abcé😀") for _ in range(LONG_WORD + 1 + draw.randint(0, 99)))
    assert PrefixTrie(scores, -20).count(word) == brute(word, scores, -20)
