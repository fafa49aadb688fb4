"""Substring dedup against a plain walk over all windows."""

from __future__ import annotations

import os
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import tuples
from tidemark.llm.substring_dedup import anchors, remove_repeats
from tidemark.llm.words import hashed_words, slices, window_hashes
from tidemark.scratch import SHUFFLE_CLEANUP, releasing, shared_folder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = (1 << 63) - 1


def brute(docs, size):
    first = {}
    words = [(LAST if d is None else d, WORD.findall(t or "")) for d, t in docs]
    for d, w in words:
        for i in range(len(w) - size + 1):
            window = tuple(w[i : i + size])
            first[window] = min(first.get(window, d), d)
    out = []
    for (doc_id, _), (d, w) in zip(docs, words):
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < d:
                gone.update(range(i, i + size))
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def key(rows):
    return sorted(rows, key=lambda r: [(v is not None, str(type(v)), v) for v in r])


@pytest.mark.parametrize("size", [3, 5, 13])
def test_random_documents(spark, frame, size):
    draw = random.Random(size)
    passages = [[f"p{draw.randrange(30)}" for _ in range(draw.randint(size - 1, 40))] for _ in range(6)]
    docs = []
    for i in range(80):
        text = []
        for _ in range(draw.randint(0, 4)):
            text += [f"o{draw.randrange(10**5)}" for _ in range(draw.randint(0, 15))]
            passage = draw.choice(passages)
            low = draw.randint(0, 5)
            text += passage[low : low + draw.randint(1, 40)]
        docs.append((i, draw.choice([" ", "\n", "  "]).join(text)))
    docs += [(200 + i, docs[i * 7][1]) for i in range(5)]
    found = remove_repeats(frame(docs, "doc_id long, text string"), size)
    assert tuples(found) == key(brute(docs, size))


def test_few_words_repeat_everywhere(spark, frame):
    draw = random.Random(1)
    docs = [(i, " ".join(draw.choice("ab") for _ in range(draw.randint(0, 60)))) for i in range(60)]
    assert tuples(remove_repeats(frame(docs, "doc_id long, text string"), 5)) == key(brute(docs, 5))


def test_edge_rows(spark, frame):
    text = "a b c d e f"
    long_text = " ".join(f"t{i % 7919}" for i in range(100_000))
    docs = [
        (1, None), (2, ""), (3, "a b"), (4, text), (5, text), (5, text + " g"), (5, text + " g"), (None, text), (None, text),
        (None, "q r s t"), (None, "q r s t"), (6, long_text), (7, "x " + long_text), (8, "é\x0bü\x85 b c d"), (9, "é ü\x85 b c d"),
        (LAST - 1, "A b c d e f"),
    ]
    df = frame([(*d, 3, "s") for d in docs], "doc_id long, text string, doc int, spans string")
    assert tuples(remove_repeats(df, 3)) == key(brute(docs, 3))


def test_no_rows(spark, frame):
    assert remove_repeats(frame([], "doc_id long, text string")).count() == 0


def test_equal_windows_have_equal_anchors():
    draw = random.Random(5)
    texts = [" ".join(draw.choice(["a", "bb", "c", "dd"]) for _ in range(draw.randint(0, 80))) for _ in range(50)]
    (part,) = slices(pa.array(texts))
    words = hashed_words(part)
    starts, found = anchors(words, 8)
    windows = window_hashes(words.hashes, 8)[starts]
    by_window = {}
    for window, anchor in zip(windows.tolist(), found.tolist()):
        assert by_window.setdefault(window, anchor) == anchor
    assert len(np.unique(found)) < len(np.unique(windows))


def scratch_tables(spark):
    folder = f"{shared_folder(spark).removeprefix('file://')}/tidemark/{spark.sparkContext.applicationId}"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = manager.getAllFiles().mkString("\n").split("\n")
    return {n for n in names if os.path.basename(n).startswith("shuffle_")}


def test_only_the_verdicts_stay_on_disk(spark, frame):
    draw = random.Random(7)
    passage = [f"p{i}" for i in range(40)]
    docs = []
    for i in range(60):
        low = draw.randint(0, 20)
        docs.append((i // 2, " ".join([f"o{draw.randrange(10**5)}" for _ in range(5)] + passage[low : low + 18])))
    docs += [(90, docs[0][1]), (None, docs[8][1])]
    tables, files = scratch_tables(spark), shuffle_files(spark)
    found = remove_repeats(frame(docs, "doc_id long, text string"), 5)
    assert [n.split("-")[0] for n in scratch_tables(spark) - tables] == ["verdicts"]
    until = time.time() + 20  # files are removed in the background
    while shuffle_files(spark) - files and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - files
    assert SHUFFLE_CLEANUP not in spark.conf.getAll
    for _ in range(2):
        assert tuples(found) == key(brute(docs, 5))


def test_a_sessions_own_setting_stays(spark):
    spark.conf.set(SHUFFLE_CLEANUP, "false")
    try:
        with releasing(spark):
            assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
        assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP)
    with pytest.raises(ValueError), releasing(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        raise ValueError
    assert SHUFFLE_CLEANUP not in spark.conf.getAll
