"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

The last token of a prefix's encoding is unique, and the rest of that encoding is the encoding of the shorter prefix before
it. So a word is read once: at each place a suffix automaton of the vocabulary gives the tokens that end there, longest
first, and the one that may follow the token stored for the place where it starts is stored for this place. Back-pointers
from the end give the ids.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType
from tokenizers import Tokenizer

from .common import text_of

#: Words that a worker remembers; beyond that it starts anew. Longer ones are never kept.
WORDS, LONGEST = 300_000, 48
#: Pairs of tokens whose compatibility a worker remembers.
PAIRS = 500_000
#: Bytes of texts, and ids, that are turned into one batch of ids, unless one row alone has more.
UNITS = 2_000_000
NEVER = 1 << 60
#: How the tokenizer's pattern cuts texts of Latin-1 in lower case; white space goes.
_LETTERS, _DIGITS, _SPACES = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
_WORDS = re.compile(f"[{_LETTERS}]+|[{_DIGITS}]|'(?:s|t|re|ve|m|ll|d)|[^{_SPACES}{_LETTERS}{_DIGITS}]+")
_BEYOND = re.compile("[^\x00-\xff]")
#: How byte-level vocabularies write bytes: printable Latin-1 signs as they are, others from 256 on in order.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
_SIGNS = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(_SHOWN))}
_BYTES = {sign: b for b, sign in _SIGNS.items()}
_HELD: dict[tuple[type, str], object] = {}


class SuffixAutomaton:
    """All factors of the vocabulary's tokens. A token can't be preceded by anything where it begins, so it is the longest
    factor of its state, and a state's token is known by the state alone. at: the next state by symbol; links: the state of
    the longest suffix in another state; tokens: the token of a state or -1; nearest: the first state with a token along
    links, the state itself included (0: none)."""

    def __init__(self, tokens: dict[int, tuple[int, ...]]):
        self.at, self.links, self.length, self.tokens = [{}], [-1], [0], [-1]
        for token, symbols in tokens.items():
            last = 0
            for s in symbols:
                last = self._extended(last, s)
            self.tokens[last] = token
        self.nearest = [0] * len(self.at)
        for state in sorted(range(1, len(self.at)), key=self.length.__getitem__):
            self.nearest[state] = state if self.tokens[state] >= 0 else self.nearest[self.links[state]]

    def _new(self, length: int, at: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.at.append(at)
        self.links.append(link)
        self.tokens.append(-1)
        return len(self.at) - 1

    def _split(self, p: int, s: int, q: int) -> int:
        """The state of p's longest factor followed by s: q, or a new one that takes the shorter factors of q over."""
        if self.length[q] == self.length[p] + 1:
            return q
        own = self._new(self.length[p] + 1, dict(self.at[q]), self.links[q])
        self.links[q] = own
        while p >= 0 and self.at[p].get(s) == q:
            self.at[p][s] = own
            p = self.links[p]
        return own

    def _extended(self, last: int, s: int) -> int:
        there = self.at[last].get(s)
        if there is not None:
            return self._split(last, s, there)
        new, p = self._new(self.length[last] + 1, {}, 0), last
        while p >= 0 and s not in self.at[p]:
            self.at[p][s] = new
            p = self.links[p]
        if p >= 0:
            self.links[new] = self._split(p, s, self.at[p][s])
        return new


class Vocabulary:
    """Tokens as runs of symbols, what each was merged from and when. Symbols: a token that no merge makes is one."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str):
        made = {}
        for rank, (a, b) in enumerate(merges):
            made.setdefault(vocab[a + b], (rank, vocab[a], vocab[b]))
        self.end, self.rank, self.left, self.right = end, {}, {}, {}
        self.merged = {(a, b): rank for rank, a, b in made.values()}
        self.symbol = {word: i for word, i in vocab.items() if i not in made}
        spelled = {i: (i,) for i in self.symbol.values()}
        for token, (rank, a, b) in sorted(made.items(), key=lambda x: x[1]):
            if a not in spelled or b not in spelled:
                raise ValueError("a merge uses a token that is only made later")
            self.rank[token], self.left[token], self.right[token] = rank, a, b
            spelled[token] = spelled[a] + spelled[b]
        reached = {i for i in spelled if i not in self.rank or self._quiet(self.left[i], self.right[i], self.rank[i])}
        self.size = {i: len(spelled[i]) for i in reached}
        self.automaton = SuffixAutomaton({i: spelled[i] for i in reached})
        self.endings: list[list[tuple[int, int]] | None] = [None] * len(self.automaton.at)
        self.known: dict[int, dict[int, bool]] = {i: {} for i in reached}
        self.remembered = 0

    def _quiet(self, a: int, b: int, until: int) -> bool:
        """Whether no merge earlier than `until` takes what ends a together with what begins b. From the whole tokens back
        in time: of the two beside the boundary the one that was made last was not there before, its part was. A merge
        across the boundary loses to the merge that made a's neighbour go (earlier, or as early and further left)."""
        a_until, b_until = until, until
        while True:
            across = self.merged.get((a, b), NEVER)
            if across < a_until and across <= b_until and across < until:
                return False
            made_a, made_b = self.rank.get(a, -1), self.rank.get(b, -1)
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:  # of two alike the left one was made first
                a, a_until = self.right[a], made_a
            else:
                b, b_until = self.left[b], made_b

    def follows(self, a: int, b: int) -> bool:
        """Whether b can follow a in an encoding."""
        found = self.known[a].get(b)
        if found is None:
            if self.remembered >= PAIRS:
                self.remembered = 0
                for held in self.known.values():
                    held.clear()
            self.remembered += 1
            found = self.known[a][b] = self._quiet(a, b, NEVER)
        return found

    def _ending(self, state: int) -> list[tuple[int, int]]:
        """Tokens that end where the automaton is in a state whose longest factor was read, longest first, with their lengths."""
        auto, found, at = self.automaton, [], self.automaton.nearest[state]
        while at > 0:
            found.append((auto.tokens[at], self.size[auto.tokens[at]]))
            at = auto.nearest[auto.links[at]]
        self.endings[state] = found
        return found

    def ids_of(self, words: list[str]) -> Iterator[list[int]]:
        """The encoding of each word of the tokenizer's byte signs: for each prefix its last token, then back from the end.
        What is stored for a prefix holds for all words that begin with it, so of sorted words each goes on where it parts
        from the one before; only a word's last symbol is another one, that of a word's end."""
        symbol, auto, endings, known, end = self.symbol, self.automaton, self.endings, self.known, self.end
        at, links, lengths = auto.at, auto.links, auto.length
        last, back, reached, read, before = [-1], [0], [0], [0], ""
        for word in words:
            most, i = min(len(word), len(before)) - 1, 0
            while i < most and word[i] == before[i]:
                i += 1
            del last[i + 1 :], back[i + 1 :], reached[i + 1 :], read[i + 1 :]
            symbols = [*map(symbol.__getitem__, word[i:-1])]
            if word:
                symbols.append(symbol[word[-1] + end])
            state, length = reached[i], read[i]
            held, before = at[state], word
            for s in symbols:
                i += 1
                while s not in held:
                    state = links[state]
                    length, held = lengths[state], at[state]
                state = held[s]
                held = at[state]
                length += 1
                full = state if length == lengths[state] else links[state]
                for token, size in endings[full] or self._ending(full):
                    left = last[i - size]
                    if left < 0:
                        break
                    fits = known[left].get(token)
                    if fits or fits is None and self.follows(left, token):
                        break
                last.append(token)
                back.append(size)
                reached.append(state)
                read.append(length)
            out = []
            while i:
                out.append(last[i])
                i -= back[i]
            yield out[::-1]


def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    if model["type"] != "BPE" or not model["end_of_word_suffix"] or model["continuing_subword_prefix"] or model["ignore_merges"] or spec["decoder"]:
        raise ValueError("only word-wise BPE with signs for the ends of words, whose tokens decode as they are")
    return spec


class Encoder:
    """Encodes as the tokenizers library does with a file of word-wise BPE (lower case, white space dropped, signs for the
    ends of words), its truncation and padding aside. The library's normaliser and pattern cut texts into words; ids come
    from Vocabulary."""

    def __init__(self, path: str):
        spec = _spec(path)
        model, self.tokenizer = spec["model"], Tokenizer.from_file(path)
        self.vocabulary = Vocabulary(model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]], model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cuts = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words: dict[str, bytes] = {s: array("i", [i]).tobytes() for s, i in self.special.items()}

    def _cut(self, text: str) -> list[str]:
        """Words in order. Latin-1 has no signs that join others, so the pattern alone cuts it; else the library cuts."""
        if not _BEYOND.search(text):
            return _WORDS.findall(text.lower())
        found = []
        for piece in text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "):
            if not _BEYOND.search(piece):
                found += _WORDS.findall(piece.lower())
            else:
                signs = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(piece))
                found += [bytes(map(_BYTES.__getitem__, w)).decode(errors="surrogateescape") for w, _ in signs]
        return found

    def _words_of(self, text: str) -> list[str]:
        """The same with special tokens, which are words of their own. No word has a special token in it: it would be one."""
        if not self.special or "<|" not in text and not any(s in text for s in self.special):
            return self._cut(text)
        return [w for part in self.cuts.split(text) for w in ([part] if part in self.special else self._cut(part))]

    def _learn(self, words: set[str]) -> None:
        """Encodes words that aren't remembered, in order, so that they share their beginnings."""
        new = words.difference(self.words)
        if len(self.words) + len(new) > WORDS:
            self.words = {s: array("i", [i]).tobytes() for s, i in self.special.items()}
            new = words.difference(self.words)
        signs = sorted((w if w.isascii() and w.isprintable() else "".join(map(_SIGNS.__getitem__, w.encode(errors="surrogateescape"))), w) for w in new)
        for (_, w), ids in zip(signs, self.vocabulary.ids_of([s for s, _ in signs]), strict=True):
            self.words[w] = array("i", ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as signed numbers of four bytes. Special tokens in a text are those tokens."""
        cut = [self._words_of(t) for t in texts]
        self._learn({w for words in cut for w in words})
        out = [b"".join(map(self.words.__getitem__, words)) for words in cut]
        for w in [w for words in cut for w in words if len(w) > LONGEST]:
            if w not in self.special:
                self.words.pop(w, None)
        return out


class Decoder:
    """Decodes as the library does: tokens as the vocabulary writes them with a space between, special tokens too. Ids that
    aren't in the vocabulary are left out."""

    def __init__(self, path: str):
        spec = _spec(path)
        shown = {i: w for w, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.shown = pa.array([shown.get(i) for i in range(max(shown) + 1)], pa.string())

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """A text for each list."""
        offsets, flat = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False)
        flat, offsets = flat[offsets[0] : offsets[-1]], offsets - offsets[0]
        known = (flat >= 0) & (flat < len(self.shown))
        if not known.all() or self.shown.null_count:
            known[known] = self.shown.is_valid().to_numpy(zero_copy_only=False)[flat[known]]
            offsets = np.concatenate(([0], np.cumsum(known)))[offsets].astype(np.int32)
            flat = flat[known]
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), self.shown.take(pa.array(flat))), " ")


def _held(kind: type, path: str):
    """One of each kind and file for each worker process."""
    if (kind, path) not in _HELD:
        _HELD[kind, path] = kind(path)
    return _HELD[kind, path]


def _cuts(sizes: np.ndarray, most: int):
    """Places that cut rows into runs of `most` at most in sum, or of one row."""
    at, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > at and total + n > most:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


def _replaced(df: DataFrame, column: str, value, field: StructField, convert, sizes) -> DataFrame:
    """df with `column` replaced by convert() of `value`, where it stands, as field; other columns pass."""
    at = [c.lower() for c in df.columns].index(column.lower())
    schema = StructType([*df.schema.fields[:at], field, *df.schema.fields[at + 1 :]])

    def run(batches):
        for batch in batches:
            for a, b in _cuts(sizes(batch.column(at)), UNITS):
                part = batch.slice(a, b - a)
                columns = [convert(c) if i == at else c for i, c in enumerate(part.columns)]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    return df.withColumn(column, value).mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """docs with `out` (array<int>), the token ids of each whole text, in the place of the text; no special tokens are added.

    Null texts count as empty and have no ids. A text may be of any length: it is encoded word by word, and a single word in
    time and memory in proportion to its length. Rows that repeat are rows of their own; other columns pass; no rows: none."""

    def convert(texts: pa.Array) -> pa.Array:
        found = _held(Encoder, path).encode(texts.to_pylist())
        offsets = np.concatenate(([0], np.cumsum([len(f) // 4 for f in found]))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), np.int32)))

    return _replaced(docs, text_col, text_of(docs, text_col), StructField(out, ArrayType(IntegerType())), convert, lambda texts: pc.binary_length(texts).to_numpy())


def decode(rows: DataFrame, path: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """rows with `out`, the text of each row's token ids, in the place of the ids, special tokens included: tokens as the
    vocabulary writes them, with a space between. Null ids and null lists count as none; unknown ids are left out."""

    def convert(ids: pa.Array) -> pa.Array:
        return _held(Decoder, path).decode(ids)

    value = F.filter(F.coalesce(F.col(ids_col), F.array().cast("array<int>")), lambda i: i.isNotNull())
    return _replaced(rows, ids_col, value, StructField(out, StringType()), convert, lambda ids: np.diff(ids.offsets.to_numpy()))
