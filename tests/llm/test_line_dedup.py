"""Line dedup against a plain walk over all lines."""

from __future__ import annotations

import random

from tests.conftest import tuples
from tidemark.llm.line_dedup import dedup_lines


def brute(docs, size=3):
    solids = []
    for doc_id, text in docs:
        lines = (text if text is not None else "").split("\n")
        solid = [(i, x.strip(" \t\x0b\x0c\r")) for i, x in enumerate(lines)]
        solids.append([x for x in solid if x[1]])
    first = {}
    for (doc_id, _), solid in zip(docs, solids):
        for k in range(len(solid) - size + 1):
            place = (doc_id if doc_id is not None else 1 << 63, solid[k][0])
            key = tuple(x[1] for x in solid[k : k + size])
            first[key] = min(first.get(key, place), place)
    out = []
    for (doc_id, text), solid in zip(docs, solids):
        gone = set()
        for k in range(len(solid) - size + 1):
            place = (doc_id if doc_id is not None else 1 << 63, solid[k][0])
            if place > first[tuple(x[1] for x in solid[k : k + size])]:
                gone.update(x[0] for x in solid[k : k + size])
        if text is None:
            out.append((doc_id, None, 0, 0))
            continue
        lines = text.split("\n")
        out.append((doc_id, "\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone)))
    return out


def key(rows):
    return sorted(rows, key=lambda r: [(v is not None, str(type(v)), v) for v in r])


def test_random_documents(spark, frame):
    draw = random.Random(3)
    for _ in range(3):
        docs = []
        for i in range(60):
            lines = [draw.choice(["a", "b", " b\t", "c d", "", "  ", "e"]) for _ in range(draw.randint(0, 14))]
            docs.append((i, "\n".join(lines)))
        found = dedup_lines(frame(docs, "doc_id long, text string")).select("doc_id", "text", "n_lines", "n_removed")
        assert tuples(found) == key(brute(docs))


def test_edge_rows(spark, frame):
    text = "one\ntwo\nthree\nfour"
    long_text = "\n".join(f"line {i % 5000}" for i in range(20000))
    docs = [(None, text), (None, text), (3, None), (4, ""), (5, text), (5, text), (6, text + "\nfive"), (7, "one\ntwo"), (8, long_text)]
    df = frame([(*d, "x", 1, [2]) for d in docs], "doc_id long, text string, gone string, n_lines int, at array<int>")
    found = dedup_lines(df)
    assert found.columns == ["doc_id", "gone", "at", "text", "n_lines", "n_removed"]
    assert tuples(found.select("doc_id", "text", "n_lines", "n_removed")) == key(brute(docs))


def test_no_rows(spark, frame):
    assert dedup_lines(frame([], "doc_id long, text string")).count() == 0
