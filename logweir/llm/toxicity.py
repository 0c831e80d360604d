"""Toxicity by a weighted lexicon, matched after folding look-alike letters and digits, normalised by length."""

import json
import re
from collections import Counter
from collections.abc import Iterator
from math import exp, log, log1p

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, forget, free_name, stored, text_of

# Letters that look like Latin ones, and the signs that stand in for letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "з": "e", "и": "u", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "п": "n", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "i", "ь": "b",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ς": "c",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʏ": "y", "ո": "n", "օ": "o", "ս": "u", "հ": "h", "ց": "g",
}
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i", "€": "e", "£": "l"}
INVISIBLE = "­​‌‍⁠﻿"

#: Labelled rows that the lexicon is learned from, about at most.
FIT_ROWS = 20_000
#: Entries of the lexicon, at most.
LEXICON_ENTRIES = 5_000
#: Lengths of the beginnings of words that can be entries.
STEM_LENGTHS = range(4, 9)


def _table() -> dict[int, str | None]:
    table: dict[int, str | None] = {ord(k): v for k, v in LOOK_ALIKES.items()}
    table |= {0xFF41 + i: chr(97 + i) for i in range(26)}  # full-width letters
    table |= dict.fromkeys(map(ord, INVISIBLE))
    return table


_FOLD = _table()
_STAND = {ord(k): v for k, v in STAND_INS.items()}
_LOOKS = re.compile("[" + "".join(map(chr, _FOLD)) + "]")
_RUN = re.compile(r"[0-9@$!|€£]+")
_GAPS = re.compile(r"[\W\d_]+")


def _stand_in(m: re.Match) -> str:
    """A run of stand-ins as letters, where it touches a letter; punctuation that ends a word stays."""
    run, text = m[0], m.string
    if text[m.end() : m.end() + 1].isalpha():
        return run.translate(_STAND)
    if m.start() and text[m.start() - 1].isalpha():
        kept = run.rstrip("!|$@€£")
        return kept.translate(_STAND) + " " * (len(run) - len(kept))
    return run


def fold(text: str) -> str:
    """Lower case, look-alikes as Latin letters, stand-ins as letters where they touch letters, all else one space; a space at either end.

    l and i fold together, since 1 stands for both."""
    low = text.lower()
    if _LOOKS.search(low):
        low = low.translate(_FOLD)
    low = _RUN.sub(_stand_in, low)
    return " " + _GAPS.sub(" ", low).strip().replace("l", "i") + " "


def entries_of(folded: str) -> set[str]:
    """What of a folded text can be an entry: ' word ' and beginnings of words ' wor'."""
    out = set()
    for word in set(folded.split()):
        out.add(f" {word} ")
        for n in STEM_LENGTHS:
            if n < len(word):
                out.add(f" {word[:n]}")
    return out


class Lexicon:
    """Weighted entries, exception phrases and the calibration. score() is between 0 and 1, higher for likelier toxic."""

    def __init__(self, weights: dict[str, float], exceptions: list[str] = (), calibration: tuple[float, ...] = (-3.0, 1.0, 1.0)):
        self.weights, self.exceptions, self.calibration = dict(weights), list(exceptions), tuple(calibration)
        self._machine = None

    def to_json(self) -> str:
        return json.dumps([self.weights, self.exceptions, self.calibration])

    @classmethod
    def from_json(cls, text: str) -> "Lexicon":
        return cls(*json.loads(text))

    def machine(self):
        if self._machine is None:
            self._machine = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                self._machine.add_word(entry, (len(entry), weight))
            for phrase in self.exceptions:
                folded = fold(phrase)
                self._machine.add_word(folded, (len(folded), None))
            self._machine.make_automaton()
        return self._machine

    def features(self, text: str) -> tuple[float, float]:
        """Weight of all matched words, and the same by length. A word counts once, by its heaviest entry; one inside an exception phrase doesn't."""
        folded = fold(text)
        if not self.weights and not self.exceptions:
            return 0.0, 0.0
        heaviest: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        for end, (n, weight) in self.machine().iter(folded):
            start = end - n + 1
            if weight is None:
                excused.append((start, end))
            else:
                heaviest[start] = max(weight, heaviest.get(start, 0.0))
        total, upto, i = 0.0, -1, 0
        excused.sort()
        for at in sorted(heaviest):
            while i < len(excused) and excused[i][0] <= at:  # phrases that begin here or before, and the farthest end of any
                upto = max(upto, excused[i][1])
                i += 1
            if at >= upto:
                total += heaviest[at]
        words = folded.count(" ") - 1
        return log1p(total), 100 * total / (100 + words)

    def score(self, text: str) -> float:
        a, b, c = self.calibration
        total, dense = self.features(text)
        return 1 / (1 + exp(-max(-30.0, min(30.0, a + b * total + c * log1p(dense)))))


def fit_lexicon(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", id_col: str = "doc_id", rows: int = FIT_ROWS, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """Learns a lexicon from labelled rows (label 0 or 1; others are left out), about `rows` of them, by a hash of the id.

    An entry is a word or a beginning of words that toxic texts have far more often than others; its weight is the
    logarithm of that ratio. A longer word under a kept beginning that mostly occurs in texts that aren't toxic becomes an
    exception, beside the phrases given. The calibration is a logistic fit of two numbers, weight and weight by length.
    Without labels of both kinds the lexicon is empty and all scores are low.
    """
    y = F.col(label_col).cast("int")
    known = bounded(labelled.filter(y.isin(0, 1)), rows, id_col)
    sample = known.select(y.alias("y"), text_of(known, text_col).alias("t"))

    def count(batches):
        found: Counter = Counter()
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[("", y)] += 1
                for e in entries_of(fold(text)):
                    found[(e, y)] += 1
            if len(found) > 400_000:
                yield _counted(found)
                found = Counter()
        yield _counted(found)

    def _counted(found):
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.string()), pa.array([v * k[1] for k, v in found.items()], pa.int64()), pa.array([v * (1 - k[1]) for k, v in found.items()], pa.int64())], ["entry", "bad", "good"])

    counts = sample.mapInArrow(count, "entry string, bad long, good long").groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    counts = stored(counts, "entries")
    whole = {r.entry: (r.bad, r.good) for r in counts.filter("entry = ''").collect()}
    n1, n0 = whole.get("", (0, 0))
    if not n1 or not n0:
        forget(counts)
        return Lexicon({}, list(exceptions), (-3.0, 0.0, 0.0))
    ratio = F.log((F.col("bad") + 0.5) / (n1 + 1.0)) - F.log((F.col("good") + 0.5) / (n0 + 1.0))
    strong = counts.filter((F.col("entry") != "") & (F.col("bad") >= 4)).withColumn("w", ratio).filter(F.col("w") >= 3).orderBy(F.desc(F.col("w") * F.col("bad")), "entry").limit(LEXICON_ENTRIES).collect()
    kept: dict[str, float] = {}
    for r in sorted(strong, key=lambda r: (len(r.entry.strip()), r.entry)):
        word = r.entry.strip()
        above = [kept[f" {word[:n]}"] for n in STEM_LENGTHS if n < len(word) and f" {word[:n]}" in kept]
        if not above or r.w > max(above) + 1:
            kept[r.entry] = float(r.w)
    found = list(exceptions)
    if stems := [e for e in kept if not e.endswith(" ")]:
        mild = counts.filter(F.col("entry").endswith(" ") & (F.col("good") >= 4)).withColumn("w", ratio).filter(F.col("w") <= 0)
        mild = mild.filter(F.substring("entry", 1, min(map(len, stems))).isin(sorted({e[: min(map(len, stems))] for e in stems})))
        found += [r.entry.strip() for r in mild.orderBy(F.desc("good"), "entry").limit(LEXICON_ENTRIES).collect() if any(r.entry.startswith(e) for e in stems)]
    forget(counts)
    lexicon = Lexicon(kept, found)
    data = lexicon.to_json()

    def measure(batches):
        one = Lexicon.from_json(data)
        for batch in batches:
            x = [one.features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v[0] for v in x], pa.float64()), pa.array([log1p(v[1]) for v in x], pa.float64())], ["y", "a", "b"])

    lines = sample.mapInArrow(measure, "y int, a double, b double").groupBy("y", F.round("a", 3).alias("a"), F.round("b", 3).alias("b")).count().orderBy("y", "a", "b").collect()
    table = np.array([[r.y, r.a, r.b, r["count"]] for r in lines], float)
    lexicon.calibration = _logistic(table[:, 1:3], table[:, 0], table[:, 3])
    return lexicon


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, ...]:
    """Weights (bias first) by Newton's method with a small ridge; slopes below zero are set to zero."""
    free = [0, 1]
    w = np.zeros(3)
    for _ in range(3):
        z = np.column_stack([np.ones(len(x)), x[:, free]])
        v = np.zeros(z.shape[1])
        v[0] = log((n @ y + 1) / (n @ (1 - y) + 1))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ v, -30, 30)))
            g = z.T @ (n * (y - p)) - 0.1 * np.r_[0, v[1:]]
            h = (z * (n * p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(len(v))
            step = np.linalg.solve(h, g)
            v += step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
            if np.abs(step).max() < 1e-9:
                break
        w[:] = 0
        w[0] = v[0]
        for k, i in enumerate(free):
            w[i + 1] = v[k + 1]
        if not (w[1:] < 0).any():
            break
        free = [i for i in free if w[i + 1] >= 0]
    return tuple(float(c) for c in np.maximum(w, [-np.inf, 0, 0]))


def toxicity(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """docs with a column `out` (double from 0 to 1) for each row's whole text. Null and empty texts score as texts without a match. All other columns stay; `out` replaces one of its name."""
    data = lexicon.to_json()

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = Lexicon.from_json(data)
        for texts in batches:
            yield texts.map(one.score)

    return docs.withColumn(out, run(text_of(docs, text_col)))


def reject_toxic(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """docs whose score is below the threshold, columns as they were. Null and empty texts score as texts without a match;
    rows that repeat are judged each; no rows give no rows."""
    name = free_name(docs, "toxicity")
    return toxicity(docs, lexicon, text_col, name).filter(F.col(name) < threshold).drop(name)
