"""Token ids of whole texts with a given vocabulary file, encoded inside tasks.

The two vocabularies split a text at white space, and after letters that are followed
by a mark, before any merge, so each run between such places is encoded once and
remembered. Texts in which that does not hold for sure (white space beyond ASCII,
strings that may be special tokens) are given to the tokenizer whole.
"""

from __future__ import annotations

import os
import re
import unicodedata
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Entries of a worker's memory; beyond it keeps only what the texts at hand hold.
MEMORY = 250_000
#: Texts that are encoded at a time: a word they share is looked up once.
TEXTS = 1000

_ODD = "[\x1c-\x1f\x85\xa0 ᠎ -‍    ⁠　﻿]|<\\|"
_IS_SPACE = np.isin(np.arange(256), [*b" \t\n\r\x0b\x0c"])

#: Marks that end a run of letters are a token part of their own in both vocabularies;
#: an apostrophe may be part of a short form.
_IS_MARK = np.isin(np.arange(256), [*b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"])

#: Letters that are one class for both vocabularies' patterns, in any context.
_LATIN = "".join(c for c in map(chr, range(0x130)) if c.isalpha())
_WORD = re.compile(f" ?[{_LATIN}]+")
#: Whether a letter ends at a byte, by the byte before it and itself.
_IS_LETTER = np.zeros((256, 256), bool)
for _c in map(str.encode, _LATIN):
    _IS_LETTER[_c[0] if len(_c) > 1 else slice(None), _c[-1]] = True

_encoders: dict[tuple[str, bool], Encoder] = {}


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encoder(path: str, spaces: bool) -> Encoder:
    """This worker's encoder; ``spaces``: white space is part of the ids."""
    if (path, spaces) not in _encoders:
        _encoders[path, spaces] = Encoder(path, spaces)
    return _encoders[path, spaces]


def byte_characters() -> str:
    """The character that stands for each byte in byte-level vocabularies.

    Printable bytes of Latin-1 stand for themselves, the others for the characters
    from 256 on, in order.
    """
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b) if b in seen else chr(next(others)) for b in range(256))


class Encoder:
    def __init__(self, path: str, spaces: bool):
        # tasks are the units of parallel work
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(True) <= 1 << 16 else "<u4")
        self.spaces = spaces
        self.characters = byte_characters()
        self._forget()

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[list[int]]:
        """Words of Latin letters, each one unit of the merges: no splitting is needed."""
        lines = "\n".join(words)
        if not self.spaces:
            lines = unicodedata.normalize("NFC", lines).lower()
        units = lines.encode().decode("latin-1").translate(self.characters).split(self.characters[10])
        tokenize = self.model.tokenize
        return [[t.id for t in tokenize(unit)] for unit in units] if words else []

    def _learn(self, runs: list[str]) -> list[list[int]]:
        """The ids of runs."""
        is_word = _WORD.fullmatch
        words = [r for r in runs if is_word(r)]
        if len(words) == len(runs):
            return self._words(words)
        found = dict(zip(words, self._words(words)))
        others = [r for r in runs if r not in found]
        if not self.spaces:
            found.update((r, []) for r in others if r.isspace())
            others = [r for r in others if r not in found]
        found.update(zip(others, self._encode(others)))
        return list(map(found.__getitem__, runs))

    def _slots(self, runs: list[str]) -> np.ndarray:
        """Where the ids of runs, all different, are remembered."""
        slots = np.fromiter(map(self.known.get, runs, repeat(-1)), np.int64, len(runs))
        new = np.flatnonzero(slots < 0)
        if len(new):
            words = list(map(runs.__getitem__, new.tolist()))
            learnt = self._learn(words)
            if len(self.known) + len(new) > MEMORY:
                old = np.flatnonzero(slots >= 0)
                self._keep(list(map(runs.__getitem__, old.tolist())), slots[old])
                slots[old] = np.arange(len(old))
            slots[new] = np.arange(len(self.known), len(self.known) + len(new))
            self._remember(words, learnt)
        return slots

    def _forget(self) -> None:
        #: number of each known run; its ids are flat[starts[n]:starts[n + 1]]
        self.known: dict[str, int] = {}
        self.starts, self.flat = np.zeros(1, np.int64), np.empty(0, self.dtype)

    def _keep(self, runs: list[str], slots: np.ndarray) -> None:
        """Forget all but some of the known runs."""
        flat, first, sizes = self.flat, self.starts[slots], self.starts[slots + 1] - self.starts[slots]
        self.known = dict(zip(runs, range(len(runs))))
        self.starts = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        self.flat = flat[np.repeat(first - self.starts[:-1], sizes) + np.arange(self.starts[-1])]

    def _remember(self, runs: list[str], ids: list[list[int]]) -> None:
        self.known.update(zip(runs, range(len(self.known), len(self.known) + len(runs))))
        ends = self.starts[-1] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        flat = np.fromiter(chain.from_iterable(ids), self.dtype, ends[-1] - self.starts[-1])
        self.starts, self.flat = np.concatenate([self.starts, ends]), np.concatenate([self.flat, flat])

    def encode(self, texts: pa.StringArray | list[str | None]) -> list[np.ndarray]:
        """The ids of each text; a null text is empty."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string())
        whole = pc.fill_null(pc.match_substring_regex(texts, _ODD), False)
        odd = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        strings = texts.take(odd).to_pylist()
        if len(odd) or texts.null_count:
            texts = pc.fill_null(pc.if_else(whole, "", texts), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.empty(0, np.uint8)
        ends = (offsets - offsets[0]).astype(np.int64)
        edges = cuts(raw, ends, self.spaces)
        out = [np.empty(0, self.dtype)] * len(texts)
        if len(raw):
            runs = pa.StringArray.from_buffers(
                len(edges), pa.py_buffer(np.append(edges, len(raw)).astype(np.int32)), pa.py_buffer(raw.tobytes()))
            coded = runs.dictionary_encode()
            slots = self._slots(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
            first, sizes = self.starts[slots], self.starts[slots + 1] - self.starts[slots]
            after = np.concatenate([[0], np.cumsum(sizes)])
            ids = self.flat[np.repeat(first - after[:-1], sizes) + np.arange(after[-1])]
            at = after[np.searchsorted(edges, ends)]
            out = [ids[a:b] for a, b in zip(at.tolist(), at[1:].tolist())]
        for i, found in zip(odd, self._encode(strings)):
            out[i] = np.array(found, self.dtype)
        return out


def cuts(raw: np.ndarray, ends: np.ndarray, spaces: bool) -> np.ndarray:
    """Where the runs of some texts begin; ``ends`` holds where texts begin and end.

    Runs of white space and of other characters take turns. With ``spaces``, what
    comes before a word is cut once more before its last character, which belongs to
    the word if it is a space. Marks after a letter begin a run.
    """
    white = _IS_SPACE[raw]
    new = np.zeros(len(raw) + 1, bool)
    new[1:-1] = white[1:] != white[:-1]
    texts = ends[:-1][np.diff(ends) > 0]
    if spaces:
        begins = np.zeros(len(raw), bool)
        begins[texts] = True
        words = np.flatnonzero(new[:-1] & ~white & ~begins)
        words = words[white[words - 1]]
        new[words - 1] = True
        new[words[raw[words - 1] == 32]] = False
    marks = np.flatnonzero(_IS_MARK[raw[1:]]) + 1
    new[marks[_IS_LETTER[raw[marks - 2], raw[marks - 1]]]] = True
    new[texts] = True
    return np.flatnonzero(new[:-1])
