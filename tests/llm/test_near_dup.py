"""Near duplicates against all pairs, the sketches' estimates, and components."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import tuples
from tidemark.llm import near_dup
from tidemark.llm.components import components
from tidemark.llm.near_dup import (
    SAMPLES,
    SKETCH_BITS,
    min_hashes,
    most_differing_bits,
    near_duplicates,
    odd_sketches,
    shingle_sets,
)
from tidemark.scratch import materialize
from tidemark.llm.words import slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(docs, size, percent=80):
    sets = [shingles(t, size) for _, t in docs]
    parent = {d: d for d, _ in docs if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(docs):
        for j in range(i):
            b = docs[j][0]
            if a is None or b is None or not sets[i] or not sets[j]:
                continue
            shared = len(sets[i] & sets[j])
            if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [(d, len(s), None if d is None else root(d), d is None or root(d) == d) for (d, _), s in zip(docs, sets)]


def key(rows):
    return sorted(rows, key=lambda r: [(v is not None, str(type(v)), v) for v in r])


def edited(draw, words, n):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return words


@pytest.mark.parametrize("size", [4, 5])
def test_random_groups(spark, frame, size):
    draw = random.Random(size)
    docs = []
    for _ in range(12):
        base = [f"w{draw.randrange(400)}" for _ in range(draw.choice([3, 30, 120]))]
        for _ in range(draw.randint(1, 12)):
            docs.append(" ".join(edited(draw, base, draw.randint(0, 4))).replace("w1", draw.choice(["w1", "W1"])))
    docs = list(enumerate(draw.sample(docs, len(docs)), 100))
    found = near_duplicates(frame(docs, "doc_id long, text string"), size=size)
    assert tuples(found) == key(brute(docs, size))


def test_a_chain_and_a_large_group(spark, frame):
    draw = random.Random(2)
    base = [f"c{i}" for i in range(200)]
    chain, docs = list(base), []
    for i in range(30):
        docs.append(" ".join(chain))
        chain[i * 6 % 200] = f"x{i}"
    docs += [" ".join(edited(draw, [f"g{i}" for i in range(150)], 5)) for _ in range(200)]
    docs += [" ".join(["same", "words", "here", "again", "now"])] * 50
    docs = list(enumerate(docs))
    assert tuples(near_duplicates(frame(docs, "doc_id long, text string"))) == key(brute(docs, 5))


@pytest.mark.parametrize("large", [2, 10**9])
def test_large_and_small_buckets_have_one_result(spark, frame, large, monkeypatch):
    monkeypatch.setattr(near_dup, "LARGE_BUCKET", large)
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", 25)
    draw = random.Random(8)
    base = [f"g{i}" for i in range(90)]
    docs = [" ".join(edited(draw, base, draw.randrange(9))) for _ in range(120)]
    for _ in range(3):  # far from the rest, near each other
        far = edited(draw, base, 12)
        docs += [" ".join(edited(draw, far, draw.randrange(3))) for _ in range(5)]
    docs = list(enumerate(docs)) + [(7, docs[3]), (500, docs[5]), (500, docs[5]), (500, "quite other words stand in here")]
    found = near_duplicates(frame(docs, "doc_id long, text string"))
    assert tuples(found) == key(brute(docs, 5))


def test_a_group_below_the_threshold_sends_no_pairs(spark, frame, monkeypatch):
    """Texts of one origin, each too far from most others: rows grow with the texts, not with their pairs."""
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", 64)
    made, links = {}, near_dup.large_bucket_links

    def counted(parts, heads, docs, size, percent):
        found = materialize(links(parts, heads, docs, size, percent), "found")
        made[n] = parts.count(), found.count()
        return found

    monkeypatch.setattr(near_dup, "large_bucket_links", counted)
    for n in (200, 400):
        draw = random.Random(n)
        base = [f"g{i}" for i in range(100)]
        docs = [(i, " ".join(edited(draw, base, 5))) for i in range(n)]
        assert tuples(near_duplicates(frame(docs, "doc_id long, text string"))) == key(brute(docs, 5))
    # A member stands in at most 32 buckets, and a task gives each member at most one link.
    for n, (asked, found) in made.items():
        assert n < asked <= 32 * n and found <= asked


def test_overlaps():
    draw = np.random.default_rng(3)
    sets = [[np.unique(draw.integers(0, 300, draw.integers(0, 200)).astype(np.uint64)) for _ in range(n)] for n in (90, 70)]
    sets[0] += [np.array([2**64 - 1, 5], np.uint64)] * 3
    found = near_dup.overlaps(*sets)
    assert found.tolist() == [[len(np.intersect1d(a, b)) for b in sets[1]] for a in sets[0]]
    assert near_dup.overlaps([], sets[1]).shape == (0, 70) and near_dup.overlaps([sets[0][0]], [np.zeros(0, np.uint64)]).tolist() == [[0]]


def test_edge_rows(spark, frame):
    long_text = " ".join(f"t{i % 7919}" for i in range(200_000))
    docs = [
        (1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One  TWO"), (6, "one"), (None, "one two"), (None, None),
        (7, "a b c d e f"), (7, "a b c d e f"), (8, long_text), (9, long_text + " end"), (10, "ÄÖ one two three four"),
        (11, "äö one two three four"),
    ]
    df = frame([(*d, [1], 2) for d in docs], "doc_id long, text string, bands array<int>, rep int")
    assert tuples(near_duplicates(df)) == key(brute(docs, 5))


def test_an_id_on_two_texts_links_them(spark, frame):
    docs = [(1, "a b c d e f g"), (2, "h i j k l m n"), (3, "a b c d e f g"), (3, "h i j k l m n")]
    rows = tuples(near_duplicates(frame(docs, "doc_id long, text string")).select("doc_id", "component_id"))
    assert rows == [(1, 1), (2, 1), (3, 1), (3, 1)]


def test_no_rows(spark, frame):
    assert near_duplicates(frame([], "doc_id long, text string")).count() == 0


def test_sketches_estimate_similarity():
    draw = np.random.default_rng(0)
    for similarity, tolerance in ((0.5, 0.1), (0.8, 0.04), (0.95, 0.02)):
        shared = round(2000 * similarity / (1 + similarity))
        bits = []
        for _ in range(100):
            own = draw.integers(0, 2**64 - 1, 2 * 1000 - shared, dtype=np.uint64)
            a, b = own[:1000], own[1000 - shared :]
            sketch = odd_sketches(min_hashes(np.concatenate([a, b]), np.array([0, len(a)])))
            bits.append(int(np.bitwise_count(sketch[0] ^ sketch[1]).sum()))
        guess = 1 + SKETCH_BITS / (4 * SAMPLES) * np.log(1 - 2 * np.mean(bits) / SKETCH_BITS)
        assert abs(guess - similarity) < tolerance
        if similarity >= 0.8:
            assert max(bits) <= most_differing_bits(0.55)


def test_shingles_of_slices():
    texts = ["A b c d e", None, "", "x", "a B c D e", "x y z"]
    (part,) = slices(pa.array(texts))
    _, bounds = shingle_sets(part, 4)
    assert np.diff(bounds).tolist() == [len(shingles(t, 4)) for t in texts]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, frame, seed):
    draw = random.Random(seed)
    links = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)]
    parent = {x: x for link in links for x in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert tuples(components(frame(links, "a long, b long"))) == sorted((x, root(x)) for x in linked)
