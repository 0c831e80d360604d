"""Language identification: scripts narrow the candidates, Viterbi over words labels spans."""

import json
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, text_of

# First and last code point of the letters of each script.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF)],
    "armenian": [(0x531, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}

#: Rows of each language that the model learns from, about; rows are taken by a hash of their id.
FIT_ROWS = 2_000
#: Character runs that the model keeps, at most.
MODEL_GRAMS = 200_000
LENGTHS = (2, 3, 4)
#: What a change of language between two words costs, in units of a word's log score.
SWITCH = 6.0
#: Words that a task remembers the scores of.
MEMORY = 300_000
#: Texts whose words are labelled side by side, and words of them, at most (one text can be longer).
TEXT_BLOCK, WORD_BLOCK = 512, 400_000
#: A longer word is cut into pieces of PIECE letters (and CONTEXT letters of the next, so that runs across the cut count).
LONG, PIECE, CONTEXT = 40, 10, 3
#: Stands where a piece goes on in its word; str.split() takes it for white space, so no word has it.
_JOIN = "\x1f"
UNKNOWN = "und"
#: Words whose runs are looked up at a time.
WORDS = 4096
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1 << 14)
def script_of(letter: str) -> str:
    code = ord(letter)
    for name, ranges in SCRIPTS.items():
        if any(a <= code <= b for a, b in ranges):
            return name
    return "other"


def word_script(word: str) -> str:
    """The script of the first letter of a script known here."""
    return next((s for s in map(script_of, filter(str.isalpha, word)) if s != "other"), "other")

def word_of(token: str) -> str:
    """A lower-case token without signs and digits at either end; empty if it has no letter."""
    w = token.strip(_EDGES)
    return w if w and any(map(str.isalpha, w)) else ""


def _script_runs(word: str) -> Iterator[str]:
    """Cuts between letters of two scripts; signs, digits and letters of no script known here go with what is before them."""
    start, now = 0, "other"
    for i, c in enumerate(word):
        script = script_of(c) if c.isalpha() else "other"
        if script not in ("other", now):
            if now != "other":
                yield word[start:i]
                start = i
            now = script
    yield word[start:]


def pieces_of(token: str) -> list[str]:
    """The token whole if it is short and of one script; else cut at script changes, and a long one at signs and by length too."""
    if len(token) <= LONG:
        return [token] if token.isascii() else list(_script_runs(token))
    out = []
    for part in "".join(" " if unicodedata.category(c)[0] in "PSZC" else c for c in token).split():
        for run in (part,) if part.isascii() else _script_runs(part):
            if len(run) <= LONG:
                out.append(run)
            else:
                out += [(_JOIN if i else "") + run[i : i + PIECE + CONTEXT] + (_JOIN if i + PIECE + CONTEXT < len(run) else "") for i in range(0, len(run), PIECE)]
    return out


def words_of_token(token: str) -> list[str]:
    """The words of a lower-case token, whole or in pieces."""
    return [w for w in map(word_of, pieces_of(token)) if w]


def words_of(text: str) -> list[str]:
    return [w for t in text.lower().split() for w in words_of_token(t)]


_EDGES = "".join(map(chr, (*range(33, 65), *range(91, 97), *range(123, 127), 0xAB, 0xBB, 0xBF, 0xA1, 0x2018, 0x2019, 0x201C, 0x201D, 0x2026)))


def framed(word: str) -> str:
    """The word with its ends marked, where it doesn't go on in another piece."""
    return ("" if word[0] == _JOIN else "_") + word.strip(_JOIN) + ("" if word[-1] == _JOIN else "_")


def _keys_at(codes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit key of the run of `size` letters at each place."""
    key = np.full(len(at), size, np.uint64)
    for k in range(size):
        key = (key ^ codes[at + k]) * _FACTOR
        key ^= key >> np.uint64(29)
    return key


def gram_keys(line: str, lengths: np.ndarray) -> np.ndarray:
    """The keys of runs of letters that stand end to end in line."""
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts, out = np.cumsum(lengths) - lengths, np.zeros(len(lengths), np.uint64)
    for size in np.unique(lengths).tolist():
        some = np.flatnonzero(lengths == size)
        out[some] = _keys_at(codes, starts[some], size)
    return out


def grams_of(word: str) -> list[str]:
    w = framed(word)
    return [w[i : i + n] for n in LENGTHS for i in range(len(w) - n + 1)]


class Model:
    """Log probabilities of character runs by language, and the scripts each language is written in."""

    def __init__(self, langs, grams, scripts, floor):
        self.langs, self.grams, self.scripts, self.floor = list(langs), grams, {k: set(v) for k, v in scripts.items()}, list(floor)
        self._memory: dict[str, int] = {}  # the row of a token's word; none: -1; several words: -2 less their place below
        self._several: list[np.ndarray] = []
        self._table = np.zeros((0, len(self.langs)))
        keys = gram_keys("".join(grams), np.array([len(g) for g in grams], np.int64))
        self._order = np.argsort(keys, kind="stable")
        self._keys = keys[self._order]
        self._logs = np.array([self.floor, *grams.values()], float).reshape(len(grams) + 1, len(self.langs))
        self._ascii = all("latin" in x for x in self.scripts.values())

    def to_json(self) -> str:
        return json.dumps([self.langs, self.grams, {k: sorted(v) for k, v in self.scripts.items()}, self.floor])

    @classmethod
    def from_json(cls, text: str) -> "Model":
        return cls(*json.loads(text))

    def _sums(self, line: str, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the log probabilities of all runs of each framed word, and how many they are. line: the words end to end."""
        ends = np.cumsum(lengths)
        left = np.repeat(ends, lengths) - np.arange(len(line))  # letters from here to the word's end
        codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        sums, n = np.zeros((len(line), len(self.langs))), np.zeros(len(line))
        for size in LENGTHS:
            at = np.flatnonzero(left >= size)
            keys = _keys_at(codes, at, size)
            found = np.minimum(np.searchsorted(self._keys, keys), max(len(self._keys) - 1, 0))
            row = np.where(self._keys[found] == keys, self._order[found] + 1, 0) if len(self._keys) else np.zeros(len(at), np.int64)
            sums[at] += self._logs[row]
            n[at] += 1
        starts = ends - lengths
        return np.add.reduceat(sums, starts, axis=0), np.add.reduceat(n, starts)

    def _score(self, words: list[str]) -> np.ndarray:
        """A log score for each word and language; languages not written in the word's script are far below, unless none is."""
        total, n = np.zeros((len(words), len(self.langs))), np.zeros(len(words))
        for first in range(0, len(words), WORDS):
            some = [framed(w) for w in words[first : first + WORDS]]
            part = slice(first, first + len(some))
            total[part], n[part] = self._sums("".join(some), np.array([len(w) for w in some], np.int64))
        length = np.array([len(w) for w in words], float)
        out = total * (4.0 / n * np.clip(length / 3, 1.0, 3.0))[:, None]
        for i, w in enumerate(words):
            if not w.isascii() or not self._ascii:
                script = word_script(w)
                fits = np.array([script in self.scripts[x] for x in self.langs])
                if fits.any() and not fits.all():
                    out[i] -= np.where(fits, 0.0, 50.0)
        return out

    def score_rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(scores, number of words of each text): a row for each word of the texts, laid end to end."""
        if len(self._memory) > MEMORY:
            self._memory, self._several, self._table = {}, [], self._table[:0]
        tokens = [t.lower().split() for t in texts]
        new = set().union(*tokens).difference(self._memory)
        if new:
            named = {t: words_of_token(t) for t in new}
            words = sorted(set().union(*named.values()))
            if words:
                first = len(self._table)
                self._table = np.concatenate([self._table, self._score(words)])
                place = {w: first + i for i, w in enumerate(words)}
            for t, found in named.items():
                if len(found) < 2:
                    self._memory[t] = place[found[0]] if found else -1
                else:
                    self._memory[t] = -2 - len(self._several)
                    self._several.append(np.array([place[w] for w in found], np.int64))
        lengths = np.array([len(t) for t in tokens], np.int64)
        rows = np.fromiter((r for t in tokens for r in map(self._memory.__getitem__, t)), np.int64, int(lengths.sum()))
        ends = np.cumsum(lengths)
        counts = (rows >= 0).astype(np.int64)
        several = np.flatnonzero(rows < -1)
        if len(several):
            held = [self._several[-2 - r] for r in rows[several].tolist()]
            counts[several] = [len(x) for x in held]
            out, upto = np.empty(int(counts.sum()), np.int64), np.cumsum(counts)
            one = rows >= 0
            out[upto[one] - 1] = rows[one]
            for x, end in zip(held, upto[several].tolist(), strict=True):
                out[end - len(x) : end] = x
            for t in {t for t in new if len(t) > LONG}:  # long ones are seldom seen again
                del self._memory[t]
        else:
            out, upto = rows[rows >= 0], np.cumsum(counts)
        sums = np.concatenate(([0], upto))
        return self._table[out], sums[ends] - sums[ends - lengths]


def label_words(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """A path of viterbi()'s value, with the steps left out where staying in one language is provably best.

    For a text, let `best` be the language of the highest total, and let a word's gain be what the best of all other
    languages has over it. A path is `best` but for some runs of words; a run gives its words' gains at most, and each run
    comes with a change of language, unless it is the whole text in one other language, which gains nothing since
    `best` has the highest total. So if no run of words gains `switch`, no path is better than staying."""
    if not len(scores):
        return np.zeros(0, np.int64)
    some = np.flatnonzero(lengths)
    n = lengths[some]
    starts = np.cumsum(n) - n
    best = np.add.reduceat(scores, starts, axis=0).argmax(1)
    path = np.repeat(best, n)
    if scores.shape[1] == 1:
        return path
    own = scores[np.arange(len(scores)), path]
    rest = scores.copy()
    rest[np.arange(len(scores)), path] = -np.inf
    gain = rest.max(1) - own
    # sums so far less the least of those before, for all texts at once: each text lies so far below the one before it that
    # the least begins anew
    far = np.repeat(np.arange(len(some)) * (2 * np.abs(gain).sum() + 1), n)
    upto = np.cumsum(gain) - far
    before = upto - gain
    ends = np.cumsum(n) - 1
    first = np.maximum.reduceat(upto, starts) - before[starts]
    last = upto[ends] - np.minimum.reduceat(before, starts)
    middle = np.maximum.reduceat(upto - np.minimum.accumulate(before), starts)
    # sums of many texts are rounded: what is near a cost goes the long way
    near = 1e-6 * (1 + far[-1] * 1e-9)
    hard = (np.maximum(first, last) >= switch - near) | (middle >= 2 * switch - near)
    if hard.any():
        at = np.repeat(hard, n)
        path[at] = _in_pieces(scores[at], n[hard], switch)
    return path


def _in_pieces(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """viterbi() with texts cut at words that settle their own language: where one is ahead of all others by two changes, a path
    through another can't be better. Such a word ends one piece and begins the next."""
    two = np.partition(scores, -2, axis=1)
    last = np.cumsum(lengths) - 1
    settled = two[:, -1] - two[:, -2] >= 2 * switch
    settled[last] = False
    times = 1 + settled
    at, first = np.repeat(np.arange(len(scores)), times), np.cumsum(times) - times
    ends = np.sort(np.concatenate([first[settled], first[last]]))
    return viterbi(scores[at], np.diff(ends, prepend=-1), switch)[first]


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """The best language of each word for texts laid end to end: a path's value is its words' scores less a penalty for each change.

    All texts advance one word a step, the longest first, so steps are array operations over the texts still running."""
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    n = lengths[order]
    steps = int(n[0]) if len(n) else 0
    alive = np.searchsorted(-n, -np.arange(steps), side="left")  # texts with more than t words
    value = np.zeros((len(n), scores.shape[1]))
    back = np.zeros(scores.shape, np.int8 if scores.shape[1] < 128 else np.int32)
    for t in range(steps):
        k = alive[t]
        now = value[:k]
        at = starts[:k] + t
        if t:
            best = now.argmax(1)
            top = now[np.arange(k), best][:, None] - switch
            stay = now >= top
            back[at] = np.where(stay, np.arange(now.shape[1])[None, :], best[:, None])
            now = np.where(stay, now, top)
        value[:k] = now + scores[at]
    path = np.zeros(len(scores), back.dtype)
    state = value.argmax(1)
    for t in range(steps - 1, -1, -1):
        k = alive[t]
        at = starts[:k] + t
        path[at] = state[:k]
        state[:k] = back[at, state[:k]]
    return path


def fit_model(labelled: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id", rows: int = FIT_ROWS) -> Model:
    """Learns from rows with a language, about `rows` of each (all of rarer ones), chosen by a hash of the id."""
    lang = F.col(label_col)
    there = {r[0]: r[1] for r in labelled.filter(lang.isNotNull()).groupBy(lang.cast("string").alias("lang")).count().collect()}
    if not there:
        return Model([], {}, {}, [])
    share = F.create_map(*[x for k, n in there.items() for x in (F.lit(k), F.lit(min(1.0, rows / n)))])
    taken = labelled.filter(lang.isNotNull() & (F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 20)) < share[lang.cast("string")] * (1 << 20))).select(lang.cast("string").alias("lang"), text_of(labelled, text_col).alias("t"))

    def count(batches):
        found: Counter = Counter()
        for batch in batches:
            words: dict[str, Counter] = {}
            for code, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words.setdefault(code, Counter()).update(text.lower().split())
            for code, counted in words.items():
                for token, n in counted.items():
                    for w in words_of_token(token):
                        for g in grams_of(w):
                            found[(code, g)] += n
                        found[(code, "\t" + ("latin" if w.isascii() else word_script(w)))] += n
            if len(found) > 500_000:
                yield _counted(found)
                found = Counter()
        yield _counted(found)

    def _counted(found):
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(list(found.values()), pa.int64())], ["lang", "g", "n"])

    counts = taken.mapInArrow(count, "lang string, g string, n long").groupBy("lang", "g").agg(F.sum("n").alias("n"))
    langs = sorted(there)
    sums = counts.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"), F.sum("n").alias("n"))
    kept = sums.orderBy(F.desc("n"), "g").limit(MODEL_GRAMS).collect()
    table = {r.g: [r.by.get(x, 0) for x in langs] for r in kept}
    scripts = {g[1:]: v for g, v in table.items() if g.startswith("\t")}
    words = [max(1, sum(v[k] for v in scripts.values())) for k in range(len(langs))]
    used = {x: [s for s, v in scripts.items() if v[k] > 0.01 * words[k]] or list(scripts) for k, x in enumerate(langs)}
    grams = {g: v for g, v in table.items() if not g.startswith("\t")}
    by_length = {n: [sum(v[k] for g, v in grams.items() if len(g) == n) for k in range(len(langs))] for n in LENGTHS}
    sizes = {n: sum(len(g) == n for g in grams) + 1 for n in LENGTHS}
    logs = {g: [round(log((c + 0.5) / (by_length[len(g)][k] + 0.5 * sizes[len(g)])), 4) for k, c in enumerate(v)] for g, v in grams.items()}
    floor = [round(log(0.5 / (max(b[k] for b in by_length.values()) + 1)), 4) for k in range(len(langs))]
    floor = [min(floor)] * len(langs)
    return Model(langs, logs, used, floor)


def _predict(model: Model, texts: list[str], switch: float):
    if not model.langs:
        return [(UNKNOWN, 0.0)] * len(texts)
    scores, lengths = model.score_rows(texts)
    path = label_words(scores, lengths, switch)
    out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
    some = np.flatnonzero(lengths)
    if not len(some):
        return out
    n, k = lengths[some], len(model.langs)
    starts = np.cumsum(n) - n
    held = np.bincount(np.repeat(np.arange(len(some)), n) * k + path, minlength=len(some) * k).reshape(-1, k)
    total = np.add.reduceat(scores, starts, axis=0)
    # the most words, then the highest total, then the first in order
    best = np.where(held == held.max(1, keepdims=True), total, -np.inf).argmax(1)
    rows = np.arange(len(some))
    top, rest = total[rows, best], total.copy()
    rest[rows, best] = -1e9
    sure = 1 / (1 + np.exp(-np.clip((top - rest.max(1)) / np.sqrt(n), -30, 30)))
    score = held[rows, best] / n * sure
    for i, lang, value in zip(some.tolist(), best.tolist(), score.tolist(), strict=True):
        out[i] = (model.langs[lang], value)
    return out


def _cuts(texts: list[str]):
    """Blocks of texts, by number and length."""
    block, size = [], 0
    for t in texts:
        if block and (len(block) == TEXT_BLOCK or size + len(t) > 6 * WORD_BLOCK):
            yield block
            block, size = [], 0
        block.append(t)
        size += len(t)
    if block:
        yield block


def identify(docs: DataFrame, model: Model, text_col: str = "text", switch: float = SWITCH) -> DataFrame:
    """docs with lang_pred (the language of most words; `und` for null texts and those without a letter) and score (0 to 1).

    Columns of those names are replaced, all others stay. Whole texts count, however long. Ties go to the higher total
    score, then to the first language in order. Rows that repeat are rows of their own. An empty table gives no rows."""
    data = docs.sparkSession.sparkContext.broadcast(model.to_json())

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one = Model.from_json(data.value)
        for texts in batches:
            found = [x for block in _cuts(texts.tolist()) for x in _predict(one, block, switch)]
            yield pd.DataFrame(found, columns=["lang", "score"])

    found = free_name(docs, "found")
    both = docs.withColumn(found, run(text_of(docs, text_col)))
    return both.withColumn("lang_pred", F.col(f"{found}.lang")).withColumn("score", F.col(f"{found}.score")).drop(found)


def spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH) -> DataFrame:
    """doc_id, first_word, n_words, lang: the runs of words of one language in each text, in order.

    Words are counted as pieces_of() cuts them: a long one, or one of several scripts, is several. Null texts and those
    without a letter have no run; rows that repeat have their runs each."""
    data = docs.sparkSession.sparkContext.broadcast(model.to_json())
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        one = Model.from_json(data.value)
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                path = label_words(*one.score_rows([text]), switch) if one.langs else np.zeros(0, int)
                edges = [0, *(np.flatnonzero(path[1:] != path[:-1]) + 1).tolist(), len(path)] if len(path) else []
                rows += [(key, s, e - s, one.langs[path[s]]) for s, e in zip(edges, edges[1:], strict=False)]
            yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=["doc_id", "first_word", "n_words", "lang"]).astype({"first_word": "int64", "n_words": "int64"}), schema=pa.schema([batch.schema.field(0), pa.field("first_word", pa.int64()), pa.field("n_words", pa.int64()), pa.field("lang", pa.string())]), preserve_index=False)

    return docs.select(F.col(id_col).alias("doc_id"), text_of(docs, text_col).alias("t")).mapInArrow(run, f"doc_id {kind}, first_word long, n_words long, lang string")
