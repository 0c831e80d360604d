"""Token ids by the tokenizers library, encoding each distinct word once."""

from __future__ import annotations

import re
import sys
from array import array

import numpy as np
from tokenizers import Tokenizer

#: Parts of texts, and words in them, that an encoder remembers; beyond that it starts anew.
PARTS, WORDS = 450_000, 30_000
#: Texts that a task is handed at a time.
TEXTS = 1_000
#: Characters of what is remembered; longer parts are encoded each time.
LONGEST = 64
_ENCODERS: dict[tuple[str, str], Encoder] = {}
_PART_START = re.compile(r"(?=[ \n]\S)")
#: A part of one word of these letters and a run of these signs after it is cut between them, and nowhere else, by all tokenizers here.
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
_SIGNS = "!\"#$%&()*+,./:;<=>?@[]^_`{|}~-"
#: How byte-level vocabularies write bytes: printable Latin-1 signs as they are, others from 256 on in order.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
_BYTE_SIGNS = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(_SHOWN))}


class _Remembered(dict):
    """Key to its ids; made on first use."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key: str) -> bytes:
        ids = self.make(key)
        if len(key) <= LONGEST:
            if len(self) >= self.most:
                self.clear()
            self[key] = ids
        return ids


class Encoder:
    """Encodes whole texts with a tokenizer file; ids are those of encode(text, add_special_tokens=False), as little-endian
    numbers of `width` bytes (2 where the vocabulary allows it, else 4).

    style "words": the tokenizer lowers case, splits at white space and drops it, so a text's ids are those of its words.
    style "bytes": the tokenizer's own pattern starts a piece at each space or line end before a sign that isn't white space,
    so a text's ids are those of the parts between such places. style "whole": nothing is known, texts are encoded whole.
    A part that is one word of plain letters, with signs after it or without, goes to the tokenizer's model by word and
    signs, which the pattern always parts; any other part goes through the whole tokenizer. Texts with a special token of
    the tokenizer are encoded whole."""

    def __init__(self, path: str, style: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.style = style
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.model = self.tokenizer.model
        self.words = _Remembered(self._word, WORDS)
        self.first, self.rest, self.lines = (_Remembered(self._after(before), PARTS) for before in ("", " ", "\n"))

    def packed(self, ids: list[int]) -> bytes:
        found = array(self.code, ids)
        if sys.byteorder == "big":
            found.byteswap()
        return found.tobytes()

    def _whole(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        shown = word.replace(" ", _BYTE_SIGNS[32]) if word.isascii() and word != "\n" else "".join(map(_BYTE_SIGNS.__getitem__, word.encode()))
        return self.packed([t.id for t in self.model.tokenize(shown)])

    def _after(self, before: str):
        space = before.replace("\n", "")

        def make(part: str) -> bytes | None:
            if before and (not part or part[0].isspace()):
                return None  # the place before it isn't where a piece starts
            word = part.rstrip(_SIGNS)
            blank, letters = (" ", word[1:]) if not space and word[:1] == " " else (space, word)
            if not (letters.isascii() and letters.isalpha() or _LETTERS.fullmatch(letters)):
                return self._whole(before + part)
            out = self.words[letters.lower()] if self.style == "words" else self._word(blank + letters)
            if len(word) < len(part):
                out += self.words[part[len(word) :]]
            return self.words[before] + out if before == "\n" else out

        return make

    def forget(self) -> None:
        """Lets go of what is remembered: a worker's next task may be another operator's."""
        for held in (self.words, self.first, self.rest, self.lines):
            held.clear()

    def encode(self, text: str) -> bytes:
        if self.style == "whole" or any(s in text for s in self.special):
            return self._whole(text)
        if self.style == "words":
            return b"".join(map(self.first.__getitem__, text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")))
        out = []
        for i, line in enumerate(text.split("\n")):
            head, *tail = line.split(" ")
            out.append(self.lines[head] if i else self.first[head])
            out += map(self.rest.__getitem__, tail)
        if None in out:  # white space side by side: cut only before a single one
            return b"".join(map(self.first.__getitem__, _PART_START.split(text)))
        return b"".join(out)


def encoder(path: str, style: str) -> Encoder:
    """One encoder for each worker process."""
    if (path, style) not in _ENCODERS:
        _ENCODERS[path, style] = Encoder(path, style)
    return _ENCODERS[path, style]


def forget_all() -> None:
    """Lets go of what this worker's encoders remember."""
    for one in _ENCODERS.values():
        one.forget()


def widened(ids: bytes, width: int) -> bytes:
    """Ids as unsigned 32-bit numbers."""
    return ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()
