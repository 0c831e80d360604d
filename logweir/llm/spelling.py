"""Spelling variants: words that differ by one code point, found by dense tiles of common prefixes and suffixes."""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, forget, prefix_sums, stored, text_of

#: Letters of a run: ASCII's and those of Latin-1's last quarter.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
#: Words of a block, code points of a block at most, and words of a tile's side.
BLOCK, BLOCK_POINTS, TILE = 4096, 1 << 22, 192


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and run: every maximal run of letters of the whole texts, A-Z lower-cased and nothing else. Null and empty texts
    have none; repeated rows have theirs each."""
    run = F.col("run")
    low = F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(F.translate(run, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    found = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.regexp_extract_all(text_of(docs, text_col), F.lit(RUN), F.lit(0))).alias("run"))
    return found.select("doc_id", low.alias("run"))


def without(word, at):
    """The word without the code point at a place (from 0)."""
    at = at.cast("int")
    return F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))


def _reach(longer):
    """Two words at one edit have half of the longer one, the edited point left out, as common prefix or as common suffix."""
    return F.floor(longer / 2).cast("int")


_BLOCK = "route int, width int, block long, rows int, kind string, points binary, n binary, low string, high string"


def _blocks(words: DataFrame) -> DataFrame:
    """Words (word, n) in two orders, by prefix (route 0) and by suffix (route 1, where words stand reversed), in blocks of
    one length, as matrices of code points in the narrowest kind of number."""
    both = words.select("n", F.explode(F.array(F.struct(F.lit(0).alias("route"), F.col("word").alias("key")), F.struct(F.lit(1).alias("route"), F.reverse("word").alias("key")))).alias("k"))
    keyed = both.select("k.route", F.length("k.key").alias("width"), "k.key", "n", F.lit(1).alias("one"))
    placed = prefix_sums(keyed, ["route", "width"], ["key"], "one", "place", "words")
    size = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_POINTS) / F.greatest("width", F.lit(1)))))
    held = placed.groupBy("route", "width", F.floor(F.col("place") / size).cast("long").alias("block")).agg(F.sort_array(F.collect_list(F.struct("key", "n"))).alias("held"))

    def run(batches):
        for batch in batches:
            for route, width, block, held in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), strict=True):
                keys, n = (held.values.field(c) for c in ("key", "n"))
                points = np.frombuffer("".join(keys.to_pylist()).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(keys), width)
                kind = next(k for k in ("<u1", "<u2", "<u4") if points.max(initial=0) <= np.iinfo(k).max)
                row = (route, width, block, len(keys), kind, points.astype(kind).tobytes(), n.to_numpy().tobytes(), keys[0].as_py(), keys[-1].as_py())
                types = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], [c.split()[0] for c in _BLOCK.split(", ")])

    with batches_of(words.sparkSession, 16):
        return stored(held.mapInArrow(run, _BLOCK), "word-blocks")


class Block:
    """Words of one length in order."""

    def __init__(self, row: dict):
        self.route, self.width, self.name = row["route"], row["width"], (row["width"], row["block"])
        self.points = np.frombuffer(row["points"], row["kind"]).reshape(row["rows"], row["width"])
        self.n = np.frombuffer(row["n"], np.int64)
        self._words, self._prefixes = None, {}

    def words(self) -> pa.Array:
        if self._words is None:
            points = self.points[:, ::-1] if self.route else self.points
            whole = np.ascontiguousarray(points).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            self._words = pa.array([whole[i : i + self.width] for i in range(0, len(whole), self.width)] if self.width else [""] * len(self.n))
        return self._words

    def prefixes(self, reach: int) -> list[tuple[int, ...]]:
        if reach not in self._prefixes:
            self._prefixes = {reach: list(map(tuple, self.points[:, :reach].tolist()))}
        return self._prefixes[reach]


def _common(a: np.ndarray, b: np.ndarray, needed: int = 0) -> np.ndarray | None:
    """Length of the common prefix of each row of a and each row of b; None if no pair reaches `needed`."""
    out = np.zeros((len(a), len(b)), np.int32 if a.shape[1] > 120 else np.int8)
    same = np.ones(out.shape, bool)
    for k in range(min(a.shape[1], b.shape[1])):
        same &= a[:, k][:, None] == b[:, k][None, :]
        if not same.any():
            return None if k < needed else out
        out += same
    return out


def near_pairs(short: Block, long: Block) -> tuple[np.ndarray, np.ndarray]:
    """Places of words (of `short`, whose words are as long or one shorter, and of `long`) that differ by one edit: common
    prefix and suffix together reach the longer length minus one. Route 0 gives pairs whose common prefix has half of that,
    route 1 those that route 0 doesn't. Of a block beside itself each pair comes once."""
    found, reach = [np.zeros((2, 0), np.int64)], long.width // 2
    starts, itself = short.prefixes(reach), short.name == long.name
    ends = long.prefixes(reach)
    for i in range(0, len(long.n), TILE):
        rows = slice(i, min(i + TILE, len(long.n)))
        first, last = bisect_left(starts, ends[rows.start]), bisect_right(starts, ends[rows.stop - 1])
        for j in range(first, min(last, rows.stop) if itself else last, TILE):
            cols = slice(j, min(j + TILE, last))
            a, b = short.points[cols], long.points[rows]
            prefix = _common(a, b, reach)
            if prefix is None:
                continue
            suffix = _common(a[:, ::-1], b[:, ::-1])
            near = (prefix + suffix >= long.width - 1) & (prefix >= reach)
            if long.route:
                near &= suffix < reach
            if itself:
                near &= np.arange(cols.start, cols.stop)[:, None] < np.arange(rows.start, rows.stop)[None, :]
            s, t = np.nonzero(near)
            found.append(np.stack([s + cols.start, t + rows.start]))
    s, t = np.concatenate(found, axis=1)
    return s, t


def _met(blocks: DataFrame) -> DataFrame:
    """word, near, near_n: both directions of each pair of words at one edit."""
    meta = ["route", "width", "block", "low", "high"]
    a = blocks.select(*meta).alias("a")
    b = blocks.select(*meta, F.explode(F.array("width", F.col("width") - 1)).alias("shorter")).alias("b")
    cut = lambda c: F.substring(F.col(c), F.lit(1), _reach(F.col("b.width")))
    on = (F.col("a.route") == F.col("b.route")) & (F.col("a.width") == F.col("b.shorter")) & (cut("a.low") <= cut("b.high")) & (cut("b.low") <= cut("a.high"))
    on = on & ((F.col("a.width") < F.col("b.width")) | (F.col("a.block") <= F.col("b.block")))
    host = F.struct("b.route", "b.width", "b.block").alias("host")
    pairs = a.join(b, on).select(host, F.col("a.route").alias("route"), F.col("a.width").alias("width"), F.col("a.block").alias("block"))
    columns = [c.split()[0] for c in _BLOCK.split(", ")]
    hosts = blocks.select(F.struct("route", "width", "block").alias("host"), F.lit(0).alias("visits"), *columns)
    visitors = blocks.join(pairs, ["route", "width", "block"]).select("host", F.lit(1).alias("visits"), *columns)

    def run(batches):
        there = None
        for batch in batches:
            for row in batch.to_pylist():
                if not row["visits"]:
                    there = Block(row)
                    continue
                guest = there if (row["width"], row["block"]) == there.name else Block(row)
                s, t = near_pairs(guest, there)
                if len(s):
                    a, b = guest.words().take(pa.array(s)), there.words().take(pa.array(t))
                    n = np.concatenate([there.n[t], guest.n[s]])
                    yield pa.RecordBatch.from_arrays([pa.concat_arrays([a, b]), pa.concat_arrays([b, a]), pa.array(n)], ["word", "near", "near_n"])

    with batches_of(blocks.sparkSession, 16):
        dealt = hosts.unionByName(visitors).repartition("host").sortWithinPartitions("host", "visits")
        found = dealt.mapInArrow(run, "word string, near string, near_n long")
        best = F.min(F.struct((-F.col("near_n")).alias("low"), F.col("near").alias("near"))).alias("best")
        return stored(found.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best), "near")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: from each word of (word, form) along forms to the last. Forms must not run in circles. Each round doubles
    how far all have come, so rounds grow with the logarithm of the longest way."""
    held = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        a, b = held.alias("a"), held.alias("b")
        further = stored(a.join(b, F.col("a.root") == F.col("b.word"), "left").select("a.word", F.coalesce("b.root", "a.root").alias("root"), F.col("b.root").isNotNull().alias("moved")), "roots")
        moved = further.filter("moved").limit(1).count()
        forget(held)
        held = further.select("word", "root")
        if not moved:
            return held


def variant_groups(occurrences: DataFrame, least_length: int = 5, least_n: int = 3, times: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n for the distinct words of a table of occurrences (word) that have `least_length` code
    points or more and occur `least_n` times or more.

    Two words are near if one inserted, deleted or replaced code point makes one into the other. A word's form is its near
    word of largest n, ties to the first in order of code points, if that n is `times` its own or more, else null. root: the
    last word along forms, the word itself where there is none. n_near: near words, 0 if none. form_n: n of the form. Null
    words don't count; no words: no rows; columns beside word are left aside.

    Words are counted before they are shuffled. Then they stand in two orders, by prefix and by suffix, in blocks of one
    length. Words at one edit share half of the longer one at either end, so only blocks that can share so much of a prefix
    meet, and within them tiles that can. A tile compares its matrices of code points column by column."""
    if times < 2:
        raise ValueError("a form must be more frequent than its word")
    words = occurrences.select("word").filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_n)
    words = stored(words, "vocabulary")
    blocks = _blocks(words)
    near = _met(blocks)
    forget(blocks)
    met = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), (-F.col("best.low")).alias("near_n"), F.col("best.near").alias("near"))
    chosen = F.col("near_n") >= times * F.col("n")
    met = stored(met.select("word", "n", "n_near", F.when(chosen, F.col("near")).alias("form"), F.when(chosen, F.col("near_n")).alias("form_n")), "forms")
    last = roots(met.filter("form is not null"))
    return met.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
