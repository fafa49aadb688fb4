"""Packing against plain tokenization of every text, and the window rules."""

from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing, token_ids
from tidemark.llm.packing import RoomTree, best_fit_decreasing, pack
from tidemark.llm.queries import op1_packing
from tidemark.llm.shipping import BATCH_LIMIT, ship
from tidemark.llm.token_ids import Encoder
from tidemark.llm.words import Texts

PATH = public_tokenizers.path("word_bpe_49k.json")
SF_DIR = "/root/testdata/sf0.001"


def check_windows(rows, window):
    by_window = {}
    for r in rows:
        by_window.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_window.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= window
    return len(by_window)


def test_query_holds_every_id_once(spark):
    rows = [r.asDict() for r in op1_packing(spark, SF_DIR).collect()]
    tokenizer = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == {d["doc_id"] for d in docs}
    total = 0
    for d in docs:
        ids = np.array(tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(pieces[d["doc_id"]], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
        total += at
    used = check_windows(rows, 2048)
    assert used <= -(-total // 2048) * 1.02 + 1


def test_edge_rows(spark, frame):
    long_text = "word " * 5000
    docs = frame(
        [(1, None, 9), (2, "", 9), (None, "a b", 9), (3, "same", 9), (3, "same", 9), (4, long_text, 9), (5, "<|endoftext|> x<|y", 9)],
        "doc_id long, text string, start long",
    )
    rows = [r.asDict() for r in pack(docs, PATH, window=256).collect()]
    assert sum(r["doc_tokens"] for r in rows if r["doc_id"] in (1, 2)) == 2
    assert sum(r["length"] for r in rows if r["doc_id"] == 3) == 4
    assert sum(r["length"] for r in rows if r["doc_id"] == 4) == 5001
    special = next(r for r in rows if r["doc_id"] == 5)
    expected = Tokenizer.from_file(PATH).encode("<|endoftext|> x<|y", add_special_tokens=False).ids
    assert np.frombuffer(special["ids"], "<u4").tolist() == [*expected, 1]
    check_windows(rows, 256)


def test_no_rows(spark, frame):
    assert pack(frame([], "doc_id long, text string"), PATH).count() == 0


def test_result_does_not_depend_on_row_order(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    one = pack(docs, PATH).orderBy("doc_id", "start").collect()
    other = pack(docs.repartition(5, "text"), PATH).orderBy("doc_id", "start").collect()
    assert one == other


@pytest.mark.parametrize("seed", range(4))
def test_takes_the_tightest_window(seed):
    draw = random.Random(seed)
    window = 50
    lengths = sorted((draw.randint(1, window) for _ in range(300)), reverse=True)
    windows, offsets = best_fit_decreasing(np.array(lengths), window)
    free = []
    for length, target, offset in zip(lengths, windows.tolist(), offsets.tolist()):
        fits = [room for room in free if room >= length]
        if fits:
            assert free[target] == min(fits)
        else:
            assert target == len(free)
            free.append(window)
        assert offset == window - free[target]
        free[target] -= length


def test_room_tree_finds_nothing_in_an_empty_tree():
    assert RoomTree(7).tightest(1) == -1


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_of_other_tokenizer_files(name):
    """Files that tell cases apart get the ids of whole texts, as all do."""
    texts = ["Hello World, it's ÜBER", "", "x  Y\n\nZ", "<|end|> A", " lead", "CamelCase 12", "日本語"]
    coder = Encoder(public_tokenizers.path(name))
    raw = [t.encode() for t in texts]
    ids, bounds = coder.encode(Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), 0))
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def distinct_words(n, per_text=200):
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(n)]
    return [" ".join(words[i : i + per_text]) for i in range(0, n, per_text)]


def test_memory_of_a_worker_is_bounded():
    """Two MB of different words, of which none repeats: what they take beside the tokenizer itself."""
    token_ids.encoder(PATH).forget()
    texts = distinct_words(200_000)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})
    tracemalloc.start()
    largest = max(out.nbytes for out in packing._cut(batch, PATH, 1, 2048))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20
    assert largest < 2 << 20


def test_words_met_again_have_the_same_ids(monkeypatch):
    """Few words are asked for at a time, and the store overflows."""
    monkeypatch.setattr(token_ids, "ASKED_WORDS", 7)
    monkeypatch.setattr(token_ids, "STORED_WORDS", 500)
    coder = Encoder(PATH)
    texts = distinct_words(1000, 50)
    texts = [*texts[:6], *texts[:6], *texts, "", *texts[::-1]]
    whole = Tokenizer.from_file(PATH)
    for low in range(0, len(texts), 3):
        raw = [t.encode() for t in texts[low : low + 3]]
        ids, bounds = coder.encode(Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), 0))
        expected = [whole.encode(t, add_special_tokens=False).ids for t in texts[low : low + 3]]
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == expected


def test_batches_are_smaller_unless_the_session_has_a_limit(spark, frame):
    docs = frame([(1, "a b")], "doc_id long, text string")
    before = spark.conf.getAll.get(BATCH_LIMIT)
    ship(spark)
    packed = pack(docs, PATH)
    assert spark.conf.get(BATCH_LIMIT) == str(1 << 20)
    assert packed.count() == 1
    ship(spark)
    assert spark.conf.get(BATCH_LIMIT) == str(8 << 20)
    spark.conf.set(BATCH_LIMIT, "123456")
    try:
        pack(docs, PATH)
        assert spark.conf.get(BATCH_LIMIT) == "123456"
    finally:
        spark.conf.set(BATCH_LIMIT, before or str(8 << 20))


def test_large_groups_come_back_in_small_batches(spark, frame):
    """A group of 1200 pieces, each in its place; more pieces than one batch holds."""
    docs = frame([(i, "word " * (i % 40)) for i in range(1200)], "doc_id long, text string")
    rows = [r.asDict() for r in pack(docs, PATH, window=64).collect()]
    assert sorted(r["doc_id"] for r in rows) == list(range(1200))
    assert all(len(r["ids"]) == 4 * r["length"] for r in rows)
    check_windows(rows, 64)
