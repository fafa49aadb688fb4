"""Token ids of whole texts by a public tokenizer file, word by word.

The tokenizers used here end a token at white space and wherever letters meet punctuation, so
a word's ids do not depend on its neighbours. Each worker keeps the ids of the words it met
(bounded; a full store starts anew) and asks the tokenizer only for new ones. Texts that may
hold a special token's string go to the tokenizer whole.
"""

from __future__ import annotations

import functools
import itertools
import os
import re

import numpy as np
import pandas as pd

from tidemark.llm.words import LOWER, Texts, blocks, find_words, gather, span_hashes

STORED_WORDS = 200_000
BLOCK_BYTES = 1 << 18  # of text looked up at a time; the temporaries on its words take many times that
ASKED_WORDS = 4096  # new words that the tokenizer is asked for at a time
#: Words of Latin letters alone, or of ASCII marks alone (apostrophes may join letters).
PLAIN = re.compile(r"[a-zß-öø-ÿ]+|[!-&(-/:-@\[-`{-~]+")

_ASCII = np.arange(256)
_LETTER = ((_ASCII >= 97) & (_ASCII <= 122)) | ((_ASCII >= 65) & (_ASCII <= 90))
_MARK = (_ASCII > 32) & (_ASCII < 127) & ~_LETTER & ~((_ASCII >= 48) & (_ASCII <= 57)) & (_ASCII != 39)
_TAIL = (_ASCII >= 0x80) & (_ASCII <= 0xBF) & (_ASCII != 0x97) & (_ASCII != 0xB7)


def letter_edges(data: np.ndarray) -> np.ndarray:
    """Bytes at which a Latin letter meets an ASCII mark other than an apostrophe, either way round."""
    cuts = np.zeros(len(data), bool)
    if len(data) < 2:
        return cuts
    ends, begins, marks = _LETTER[data], _LETTER[data], _MARK[data]
    accented = (data[:-1] == 0xC3) & _TAIL[data[1:]]
    ends[1:] |= accented
    begins[:-1] |= accented
    cuts[1:] = (ends[:-1] & marks[1:]) | (marks[:-1] & begins[1:])
    return cuts


def _room(values: np.ndarray, n: int) -> np.ndarray:
    """``values`` with room for ``n`` numbers."""
    if n <= len(values):
        return values
    return np.concatenate([values, np.zeros(max(n, 2 * len(values)) - len(values), values.dtype)])


class Encoder:
    """Ids of texts, as the tokenizer in ``path`` gives them without special tokens added."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.bytewise = self._byte_letters()
        self.forget()
        self.by_word = self._splits_as_supposed()

    def _byte_letters(self) -> dict[int, str]:
        """How the tokenizer's byte alphabet spells each plain letter; empty if plain words are not one piece."""
        letters = {}
        for x in [*range(33, 127), *range(0xDF, 0x100)]:
            pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(chr(x))
            if len(pieces) != 1:
                return {}
            letters[x] = pieces[0][0]
        for sample in ("naïveté", "+-"):
            spelled = sample.translate(letters)
            if [x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(sample)] != [spelled]:
                return {}
            direct = [x.id for x in self.model.tokenize(spelled)]
            if self.tokenizer.encode(sample, add_special_tokens=False).ids != direct:
                return {}
        return letters

    def _splits_as_supposed(self) -> bool:
        """Whether words by themselves, A-Z lowered, get the ids that they have in whole texts."""
        samples = ("A Plain Text", "naïve ÜBER 123,45 (it's) a\tb\n\nc", "x  y", " lead", "snake_case CamelCase!?", "日本語 text", "")
        raw = [x.encode() for x in samples]
        texts = Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), 0)
        self.by_word = True
        ids, bounds = self.encode(texts)
        self.forget()
        whole = [self.tokenizer.encode(x, add_special_tokens=False).ids for x in samples]
        return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == whole

    def forget(self) -> None:
        # The hashes of the stored words, ascending, and the places of their ids; a dict of Python numbers is several times as large.
        self.known, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 16, np.int64)
        self.lengths = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _ask(self, words: list[str]) -> list[list[int]]:
        """Ids of each word. Plain words are one piece each for the tokenizer's model; the others take all its steps."""
        found = [self._plain(w) for w in words]
        rest = [i for i, x in enumerate(found) if x is None]
        for i, coded in zip(rest, self.tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)):
            found[i] = coded.ids
        return found

    def _plain(self, word: str) -> list[int] | None:
        if not word.isascii():
            word = word.lower()
        if not self.bytewise or not PLAIN.fullmatch(word):
            return None
        if not word.isascii():
            word = word.translate(self.bytewise)
        return [x.id for x in self.model.tokenize(word)]

    def _places(self, keys: np.ndarray) -> np.ndarray:
        """The places of words by their hashes; -1: not stored."""
        if not len(self.known):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
        return np.where(self.known[at] == keys, self.slots[at], -1)

    def _store(self, keys: np.ndarray, words: list[str]) -> np.ndarray:
        """Keep the ids of new words, each once; their places."""
        found = self._ask(words)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        n, slots = int(lengths.sum()), np.arange(len(self.known), len(self.known) + len(keys))
        self.ids = _room(self.ids, self.used + n)
        self.starts, self.lengths = _room(self.starts, slots[-1] + 1), _room(self.lengths, slots[-1] + 1)
        self.ids[self.used : self.used + n] = np.fromiter(itertools.chain.from_iterable(found), np.uint32, n)
        self.starts[slots] = self.used + np.cumsum(lengths) - lengths
        self.lengths[slots] = lengths
        order = np.argsort(keys)
        at = np.searchsorted(self.known, keys[order])
        self.known, self.slots = np.insert(self.known, at, keys[order]), np.insert(self.slots, at, slots[order])
        self.used += n
        return slots

    def _block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of adjacent texts and where each text's ids begin."""
        words = find_words(Texts(data, offsets, 0), letter_edges(data))
        if not len(words.starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        hashes = span_hashes(data, words.starts, words.ends)
        back, keys = pd.factorize(hashes)
        if len(self.known) + len(keys) > STORED_WORDS:
            self.forget()
        places = self._places(keys)
        new = np.flatnonzero(places < 0)
        if len(new):
            raw, seen = data.tobytes(), np.zeros(len(keys), np.int64)
            seen[back] = np.arange(len(back))
            for low in range(0, len(new), ASKED_WORDS):
                some = new[low : low + ASKED_WORDS]
                spans = zip(words.starts[seen[some]].tolist(), words.ends[seen[some]].tolist())
                places[some] = self._store(keys[some], [raw[a:b].decode("utf-8", "replace") for a, b in spans])
        slots = places[back]
        lengths = self.lengths[slots]
        sums = np.concatenate([[0], np.cumsum(lengths)])
        return self.ids[gather(self.starts[slots], lengths)], sums[words.bounds]

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, bounds)``: text ``i`` has ``ids[bounds[i]:bounds[i + 1]]``.

        Files whose rules are others, such as those that tell cases apart, encode whole texts.
        """
        if not self.by_word:
            parts = [self._coded(texts.data[a:b].tobytes()) for a, b in zip(texts.offsets, texts.offsets[1:])]
            parts = parts or [np.zeros(0, np.uint32)]
            return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])[: len(texts) + 1]
        lowered = LOWER[texts.data]
        special = np.flatnonzero((lowered[:-1] == 60) & (lowered[1:] == 124))
        if len(special):
            parts = [self._whole(texts, i) for i in range(len(texts))]
        elif len(texts) == 1:
            parts = [self._block(lowered[a:b], np.array([0, b - a]))[0] for a, b in blocks(lowered, BLOCK_BYTES)]
            parts = [np.concatenate(parts)] if parts else [np.zeros(0, np.uint32)]
        else:
            return self._block(lowered, texts.offsets)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])

    def _whole(self, texts: Texts, i: int) -> np.ndarray:
        text = texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes()
        if b"<|" in text:
            return self._coded(text)
        one = Texts(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 0)
        return self.encode(one)[0]

    def _coded(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32)


@functools.cache
def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    return Encoder(path)
