"""Mixing: targets by hand, words per source, evenness of the schedule, reruns."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from tidemark.llm.mixing import mix, mixed_documents, source_targets, sizes, taken_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(source_sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    order = sorted(source_sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, target, open_ = share * sum(source_sizes.values()), {}, set(order)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * unit > most * source_sizes[s]}
        if not above:
            target.update({s: weight[s] * unit for s in open_})
            break
        for s in above:
            target[s] = most * source_sizes[s]
            left -= target[s]
        open_ -= above
    return target


def documents(seed, n=400):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        source = draw.choice(["a"] * 8 + ["b", "c", "Z", "é", None, "d"])
        rows.append((i, " ".join(["w"] * draw.choice([0, 1, 5, 40, 700])), source))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_takes_the_targets(spark, frame, seed):
    rows = documents(seed) + [(900, None, "a"), (None, "x y z", "b"), (None, "x y z", "b"), (901, "w " * 5000, "c"), (902, "", "empty")]
    df = frame([(*r, 5, "s") for r in rows], "doc_id long, text string, source string, size int, rank string")
    found = taken_words(mix(df)).collect()
    assert len(found) == len(rows)
    totals, takens, targets = defaultdict(int), defaultdict(int), {}
    by_doc = {r[0]: r for r in rows if r[0] is not None}
    for _, text, source in rows:
        totals[source] += len(WORD.findall(text or ""))
    expected = brute_targets(totals)
    for r in found:
        source = by_doc[r["doc_id"]][2] if r["doc_id"] is not None else "b"
        assert r["source_size"] == totals[source]
        assert r["target"] == pytest.approx(expected[source], rel=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"]
        takens[source] += r["taken"]
    for source, target in expected.items():
        assert takens[source] == round(target)


def test_schedule_is_even(spark, frame):
    rows = [(i, "w " * 64, "abc"[i % 3]) for i in range(600)]
    mixed = mix(frame(rows, "doc_id long, text string, source string"), block=64).where("taken > 0").orderBy("slot").collect()
    goal = defaultdict(int)
    for r in mixed:
        goal[r["source"]] += 1
    seen = defaultdict(int)
    for i, r in enumerate(mixed, 1):
        seen[r["source"]] += 1
        for source, n in goal.items():
            assert abs(seen[source] - n * i / len(mixed)) < 6


def test_takes_less_than_all_of_a_light_source(spark, frame):
    rows = [(i, "w " * (i % 50), "abc"[i % 3]) for i in range(600)]
    takens, sizes_, targets = defaultdict(int), defaultdict(int), {}
    for r in mix(frame(rows, "doc_id long, text string, source string"), block=16).collect():
        takens[r["source"]] += r["taken"]
        targets[r["source"]] = r["target"]
        if r["epoch"] is not None:
            sizes_[r["source"], r["epoch"]] += r["taken"]
    assert {s: round(t) for s, t in targets.items()} == dict(takens)
    assert set(sizes_) == {("a", 0), ("a", 1), ("b", 0), ("b", 1), ("c", 0)} or ("c", 1) not in sizes_


def test_reruns_agree(spark, frame):
    rows = documents(5)
    df = frame(rows, "doc_id long, text string, source string")
    names = ["doc_id", "epoch", "taken", "first", "slot"]
    one = sorted(mix(df).select(*names).collect(), key=str)
    other = sorted(mix(df.repartition(7, "text")).select(*names).collect(), key=str)
    assert one == other


def test_no_words_and_no_rows(spark, frame):
    schema = "doc_id long, text string, source string"
    empty = taken_words(mix(frame([(1, "", "a"), (1, "", "a"), (2, None, None)], schema))).collect()
    assert [(r["taken"], r["target"]) for r in empty] == [(0, 0.0)] * 3
    assert taken_words(mix(frame([], schema))).count() == 0


def test_one_source(spark, frame):
    df = frame([(1, "a b c", "x")], "doc_id long, text string, source string")
    assert [tuple(r) for r in taken_words(mix(df)).select("size", "target", "taken").collect()] == [(3, 4.5, 5)]


def test_targets_of_equal_sources(spark, frame):
    df = frame([(i, "a b c d", s) for i, s in enumerate("abcdef")], "doc_id long, text string, source string")
    targets = {r["source"]: r["target"] for r in source_targets(sizes(df, 1)).collect()}
    assert targets == pytest.approx(brute_targets(dict.fromkeys("abcdef", 4)))


def test_rows_that_differ_in_another_column_stay_apart(spark, frame):
    rows = [(1, "a b c", "s", "en", {"k": 1}), (1, "a b c", "s", "fr", {"k": 1}), (1, "a b c", "s", "fr", {"k": 2})]
    rows += [(1, "a b c", "s", "fr", {"k": 2}), (None, "a b c", "s", None, None)]
    df = frame(rows, "doc_id long, text string, source string, lang string, more map<string, int>")
    found = [(r["lang"], (r["more"] or {}).get("k")) for r in mixed_documents(df, share=1.0).collect()]
    assert sorted(found, key=str) == sorted([("en", 1), ("fr", 1), ("fr", 2), ("fr", 2), (None, None)], key=str)


def test_the_schedule_orders_the_mix(spark, frame):
    """Every quarter of the mix has the sources in proportion, in the query's slots and in the mixed rows."""
    draw = random.Random(6)
    rows = [(i, " ".join(["w"] * draw.randrange(60, 140)), draw.choice("aabbc")) for i in range(900)]
    df = frame(rows, "doc_id long, text string, source string")
    source_of = {i: s for i, _, s in rows}
    first_pass = sorted((r["slot"], source_of[r["doc_id"]], r["size"]) for r in taken_words(mix(df, block=64)).collect() if r["passes"])
    mixed = [(r["source"], len(r["text"].split())) for r in mixed_documents(df, block=64).collect()]
    assert len(first_pass) > 500 and sum(n for _, n in mixed) == round(1.5 * sum(len(t.split()) for _, t, _ in rows))
    for n_parts, words in ((1, [(s, n) for _, s, n in first_pass if s == "a"]), (4, mixed)):
        shares = []
        for part in range(n_parts):
            some = words[len(words) * part // n_parts : len(words) * (part + 1) // n_parts]
            total = sum(n for _, n in some)
            shares.append({s: sum(n for x, n in some if x == s) / total for s in "abc"})
        if n_parts > 1:
            assert all(max(x[s] for x in shares) - min(x[s] for x in shares) < 0.12 for s in "abc")
    slots = {s: [i for i, (_, x, _) in enumerate(first_pass) if x == s] for s in "abc"}
    assert all(min(x) < len(first_pass) * 0.1 for x in slots.values()), "no source waits for another"
