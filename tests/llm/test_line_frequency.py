"""Quality measures and line limits against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from tidemark.llm.line_frequency import clean_lines, clean_lines, judge_lines, measure
from tidemark.llm.words import hashed_words, slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def normal(line):
    words = [re.sub("[0-9]", "0", w) for w in WORD.findall(line)]
    return tuple(re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words)


def brute_verdicts(docs, least, share, most):
    hosts, lines = Counter(), defaultdict(Counter)
    for _, text, source in docs:
        hosts[source] += 1
        lines[source].update({normal(x) for x in (text or "").split("\n")} - {()})
    out = []
    for doc_id, text, source in docs:
        n, chars, symbols, dup, repeat = brute_measures(text)
        removed = 0
        for line in (text or "").split("\n"):
            count = lines[source][normal(line)]
            if normal(line) and count >= least and count > share * hosts[source]:
                removed += len(normal(line))
        failed = n < 50 or 100 * repeat > 50 * n
        out.append((doc_id, n, chars, symbols, dup, repeat, failed, removed, not failed and removed <= most * n))
    return out


def random_text(draw):
    alphabet = ["a", "B", "b", "é", "#", "12", "13", "|x", "\x0b", "中文", "x<y"]
    lines = [" ".join(draw.choice(alphabet) for _ in range(draw.randint(0, 6))) for _ in range(draw.randint(0, 9))]
    return draw.choice(["", "\n", " "]) + "\n".join(lines) + draw.choice(["", "\n", "\n\n"])


@pytest.mark.parametrize("most", [40, 1 << 20])
def test_measures(most):
    draw = random.Random(most)
    texts = [random_text(draw) for _ in range(400)] + ["", None, "\n", "a", "x " * 90]
    for part in slices(pa.array(texts), most):
        found = measure(part)
        for i in range(len(part)):
            row = tuple(int(found[c][i]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
            assert row == brute_measures(texts[part.first + i])


def test_long_text_is_scanned_in_blocks():
    text = " ".join(f"w{i % 1000}" for i in range(400_000))
    (part,) = slices(pa.array([text]))
    words = hashed_words(part)
    assert len(words.hashes) == 400_000 and len(set(words.hashes.tolist())) == 1000
    assert measure(part)["n_repeat_words"][0] == 400_000


KEYS = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed n_removed_words kept".split()


def test_verdicts(spark, frame):
    draw = random.Random(8)
    docs = []
    for i in range(300):
        own = [" ".join(draw.choice("abcdefgh") + str(draw.randint(0, 999)) + "q" * draw.randint(0, 9) for _ in range(12)) for _ in range(draw.randint(3, 8))]
        common = draw.choice([[], ["Cookie Notice 1 of 9"], ["cookie notice 2 of 8"] * 30])
        docs.append((i, "\n".join(own + common), draw.choice(["h1", "h1", "h2", None])))
    docs += [(None, "x y", "h1"), (None, "x y", "h1"), (900, None, None), (901, "", "h9")]
    df = frame([(*d, 1) for d in docs], "doc_id long, text string, source string, host int")
    found = judge_lines(df, least_documents=5, most_share=0.2, most_removed=0.3).select(*KEYS).collect()
    expected = brute_verdicts(docs, 5, 0.2, 0.3)
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert 0 < sum(r["kept"] for r in found) < len(docs)
    cleaned = clean_lines(df, least_documents=5, most_share=0.2, most_removed=0.3).collect()
    assert {r["doc_id"] for r in cleaned} == {r["doc_id"] for r in found if r["kept"]}
    assert all("ookie" not in r["text"] for r in cleaned)


def test_no_rows(spark, frame):
    assert judge_lines(frame([], "doc_id long, text string, source string")).count() == 0


def test_clean_lines_by_host(spark, frame):
    """The same document under two hosts: only the host whose limit names the line loses it."""
    own = lambda i: " ".join(f"own{i}x{j}" for j in range(60))
    rows = [(i, f"shared line here\n{own(i)}", "one") for i in range(25)]
    rows += [(3, f"shared line here\n{own(3)}", "two"), (None, f"shared line here\n{own(99)}", None), (50, None, "one")]
    df = frame([(*r, "mine", 5) for r in rows], "doc_id long, text string, source string, n_lines string, host int")
    found = {(r["doc_id"], r["source"]): (r["text"], r["n_removed"]) for r in clean_lines(df).collect()}
    assert len(found) == 27 and (50, "one") not in found
    assert found[3, "one"] == (own(3), 1) and found[3, "two"] == (f"shared line here\n{own(3)}", 0)
    assert found[None, None][1] == 0
