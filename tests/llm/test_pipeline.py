"""Each stage of the pipeline, on what the one before it kept, against plain code."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import test_line_dedup as line_cases
from tests.llm import test_mixing as mixing_cases
from tests.llm import test_near_dup as near_cases
from tests.llm.test_packing import check_windows
from tidemark.llm.quality import resample

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept.append(docs)
    return kept


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_columns(stages):
    for before, after in zip(stages, stages[1:-1]):
        assert after.dtypes == before.dtypes


def test_quality(spark, stages):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    kept = {r["doc_id"] for r in resample(stages[0], labels).where("kept").collect()}
    assert rows(stages[1].orderBy("doc_id")) == rows(stages[0].where(stages[0]["doc_id"].isin(list(kept))).orderBy("doc_id"))


def test_line_dedup(stages):
    before = rows(stages[1])
    expected = {}
    for doc_id, text, _, n_removed in line_cases.brute([(r["doc_id"], r["text"]) for r in before]):
        if not n_removed or WORD.search(text):
            expected[doc_id] = text
    after = rows(stages[2])
    assert {r["doc_id"]: r["text"] for r in after} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_near_duplicates(stages):
    judged = near_cases.brute([(r["doc_id"], r["text"]) for r in rows(stages[2])], 5)
    assert sorted(r["doc_id"] for r in rows(stages[3])) == sorted(r[0] for r in judged if r[3])


def test_mixing(stages):
    before, after = rows(stages[3]), rows(stages[4])
    sizes, takes = Counter(), Counter()
    texts, cut = {}, defaultdict(int)
    for r in before:
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
        texts[r["doc_id"]] = r["text"]
    for r in after:
        takes[r["source"]] += len(WORD.findall(r["text"]))
        if r["text"] != texts[r["doc_id"]]:
            cut[r["source"]] += 1
            words = WORD.findall(texts[r["doc_id"]])
            assert " ".join(words).startswith(r["text"])
    assert {s: round(t) for s, t in mixing_cases.brute_targets(sizes).items()} == dict(takes)
    assert max(cut.values(), default=0) <= 1
    assert max(Counter(r["doc_id"] for r in after).values()) <= 2


def test_packing(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = sum(len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in rows(stages[4]))
    pieces = rows(stages[5])
    assert sum(r["length"] for r in pieces) == expected
    check_windows(pieces, 2048)


def test_run_is_registered(spark, stages):
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    names = ["doc_id", "start", "length", "sequence_id", "offset", "ids"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).select(*names).collect())) == sorted(
        map(tuple, stages[5].select(*names).collect())
    )


def test_stages_take_odd_rows(spark, frame, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, one int, doc string, gone int, n_lines string, n_removed string"
    odd = [
        (None, None, None, None, None, 1, "x", 2), (1, "", "en", "s", 0, 1, "x", 2), (2, "a b c d e f g\n" * 4, None, None, 9, 1, "x", 2),
        (2, "a b c d e f g\n" * 4, None, None, 9, 1, "x", 2), (3, "h i j k l m", "en", "s", None, 1, "x", 2),
        (4, "word " * 30000, "en", "t", None, 1, "x", 2),
    ]
    frame([(1, 1), (4, 1), (3, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    odd = [(*row, f"lines{i}", "kept") for i, row in enumerate(odd)]
    lines = corpus_pipeline.drop_repeated_lines(spark, frame(odd, schema), "")
    assert {(r["n_lines"], r["n_removed"]) for r in lines.collect()} <= {(row[-2], "kept") for row in odd}
    for docs in (frame(odd, schema), frame([], schema)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.dtypes == docs.dtypes
            out.collect()
        docs = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        docs.collect()


def test_repeated_rows_are_mixed_as_often(spark, frame):
    df = frame([(1, "a b c", "s")] * 3 + [(2, "d e f g", "s")], "doc_id long, text string, source string")
    out = corpus_pipeline.mix_sources(spark, df, "")
    assert sum(len(r["text"].split()) for r in out.collect()) == round(1.5 * 13)
