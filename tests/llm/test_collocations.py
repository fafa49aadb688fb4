"""Phrases and automata against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import collocations as module
from tidemark.llm import transducers, words
from tidemark.llm.collocations import Shard, Sizes, collocations, range_bounds, shards, split_words
from tidemark.llm.transducers import Weighted, compose, cut, decode, encode, range_of, sorted_alphabet, union, weighted

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SMALL = Sizes(shard_words=200, shard_bytes=4000, chunk_rows=64, range_rows=100, answer_bytes=300)


def brute(rows, most_words, least, top, covered=(50, 100)):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for n in range(1, most_words + 1):
                counts[lang].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        phrases = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in phrases.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    if covered[1] * a >= covered[0] * f[p[i : i + n]]:
                        gone.add(p[i : i + n])
        scored = []
        for p, a in phrases.items():
            if p not in gone:
                cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r) for r in collocations(df, **options).collect())


def corpus(n, seed):
    draw = random.Random(seed)
    vocabulary = ["the", "The", "of", "naïve", "Ünder", "x", "日本", "new", "york", "\x01", "a-b"]
    texts = []
    for _ in range(n):
        some = draw.choices(vocabulary, weights=[9, 3, 5, 2, 1, 4, 1, 2, 2, 1, 1], k=draw.randrange(60))
        some = [w if draw.random() > 0.1 else draw.choice(["new york city", "out of the blue,", "\tend.\n"]) for w in some]
        texts.append((draw.choice(["en", "en", "fr", None, "", "the"]), draw.choice([" ", "  ", " \t"]).join(some)))
    return texts


@pytest.mark.parametrize("most_words", [2, 3, 4])
def test_matches_plain_counting(spark, frame, most_words):
    rows = corpus(120, most_words) + [("en", None), (None, ""), ("und", "new york new york"), ("en", "the " * 700)]
    df = frame([(*r, 1, "s") for r in rows], "lang string, text string, n long, automaton string").repartition(5)
    expected = brute(rows, most_words, 4, 12)
    assert found(df, most_words=most_words, least=4, top=12, sizes=SMALL) == expected
    if most_words == 3:
        assert found(df, most_words=3, least=4, top=12) == expected


def test_no_rows_and_no_words(spark, frame):
    assert found(frame([], "lang string, text string")) == []
    assert found(frame([("en", " ., \n"), (None, None)], "lang string, text string"), least=1) == []


def test_large_counts_stay_exact(spark, frame):
    """Products of counts beyond 64 bits, given as automata instead of texts."""
    alphabet, _ = sorted_alphabet(pa.array([b"en", b"x", b"y"], pa.large_binary()))
    a = 3_000_000_019
    rows = Weighted(alphabet, [np.array([1, 1]), np.array([2, 2]), np.array([3, 3]), np.array([0, 2])], np.array([a, 7]))
    answers = Weighted(
        alphabet, [np.array([1] * 4), np.array([0, 2, 3, 2]), np.array([0, 0, 0, 3]), np.zeros(4, int)], np.array([9 * a, 2 * a, 3 * a, a + 7])
    )
    answers = weighted(alphabet, answers.places, answers.weights)
    table = pa.table({"range": [0, 0], "kind": [0, 1], "automaton": [encode(rows.part(0, 1)), encode(answers)]})
    scored = module._score(table, 10, (50, 100)).to_pylist()
    assert scored == [
        {"lang": "en", "phrase": "x y", "a": a, "l": 2 * a, "r": 3 * a, "n": 9 * a, "score": 1_000_000 * a * a // (6 * a * a)}
    ]


def test_ranges_hold_a_hot_word(spark, frame):
    """A word that starts a third of all windows is spread over ranges; no range is far larger than asked."""
    draw = random.Random(3)
    texts = [("en", " ".join(w for i in range(200) for w in ("the", f"w{draw.randrange(4000)}", f"v{draw.randrange(4000)}"))) for _ in range(40)]
    df = frame(texts, "lang string, text string").repartition(4)
    sizes = Sizes(shard_words=2000, shard_bytes=1 << 20, chunk_rows=500, range_rows=1500, answer_bytes=1000)
    written = shards(df, 3, sizes).cache()
    bounds = range_bounds(written, 4, sizes.range_rows)
    dealt = module.deal(written, bounds).collect()
    n_rows = Counter()
    for r in dealt:
        n_rows[r["range"]] += len(decode(bytes(r["automaton"])))
    assert len(n_rows) >= 8 and max(n_rows.values()) < 2 * sizes.range_rows
    assert sum(b[1] == b"the" for b in bounds) >= 2
    assert found(df, least=3, sizes=sizes) == brute(texts, 3, 3, 2000)


@pytest.mark.parametrize("size", [5, 50, 1 << 20])
def test_long_text_in_blocks(size, monkeypatch):
    monkeypatch.setattr(module, "blocks", lambda data: words.blocks(data, size))
    text = " ".join(t for _, t in corpus(30, 9)) + " " + "z" * 300
    raw = np.frombuffer(text.encode(), np.uint8)
    shard = Shard(3, Sizes(shard_words=97))
    parts = []
    for found_words, begins, of in split_words(words.Texts(raw, np.array([0, len(raw)]), 0)):
        shard.add(found_words, begins, pa.array([b"en"] * len(begins), pa.large_binary()).dictionary_encode())
        if shard.full():
            parts.append(shard.windows(False))
    parts.append(shard.windows(True))
    rows = union([p for p in parts if p is not None])
    counted = Counter()
    for key, n in zip(rows.keys(range(len(rows))), rows.weights.tolist()):
        counted[tuple(x.decode() for x in key if x)[1:]] += n
    expected = Counter()
    for piece in re.split("[.,;:!?\x0a-\x0d]", text.translate(LOWER)):
        w = re.findall("[^\x20\x09]+", piece)
        expected.update(tuple(w[i : i + 3]) for i in range(len(w)))
    assert counted == expected


@pytest.mark.parametrize("n", [1, 2, 60, 3000])
def test_automata(n):
    draw = np.random.default_rng(n)
    symbols = [b"", b"a", b"b", b"bb", b"\xc3\xa9"]
    alphabet, _ = sorted_alphabet(pa.array(symbols, pa.large_binary()))
    rows = weighted(alphabet, [draw.integers(0, 5, n) for _ in range(4)], draw.choice([1, 1, 1, 5, 10**12], n))
    again = decode(encode(rows))
    keys = rows.keys(range(len(rows)))
    assert keys == sorted(set(keys)) == again.keys(range(len(again))) and (again.weights == rows.weights).all()
    bounds = sorted({(b"a", b"bb", b"", b""), (b"b", b"c", b"", b""), (b"bb", b"a", b"a", b"b"), (b"\xff", b"", b"", b"")})
    parts = [(i, k) for i, part in cut(rows, bounds) for k in part.keys(range(len(part)))]
    assert parts == [(range_of(bounds, k), k) for k in keys]
    twice = union([rows, again.part(0, len(again) // 2), again.part(len(again) // 2, len(again))])
    assert (compose(rows, twice) == 2 * rows.weights).all()
    assert (compose(rows, rows.part(0, 1))[1:] == 0).all()


def test_equal_states_are_shared():
    """Ten beginnings with the same continuations, in the same proportion to nothing, are one state."""
    alphabet, numbers = sorted_alphabet(pa.array([f"{i}".encode() for i in range(300)], pa.large_binary()))
    places = [np.repeat(numbers[:200], 40), np.tile(numbers[200:240], 200)]
    assert len(encode(weighted(alphabet, places))) < 1800
    shared = transducers._states(np.arange(0, 8000, 40), [places[1], np.zeros(8000, np.int64)])
    assert len(shared[0]) == 1


def test_sums_are_rows(spark, frame):
    rows = corpus(50, 1)
    written = shards(frame(rows, "lang string, text string").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text"), 3, SMALL)
    n = sum(len(re.findall("[^\x20\x09.,;:!?\x0a-\x0d]+", t)) for _, t in rows)
    assert sum(int(decode(bytes(r["automaton"])).weights.sum()) for r in written.collect()) == n
