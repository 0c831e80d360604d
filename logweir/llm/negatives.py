"""Hard-negative mining: exact integer scores by Strassen's multiplication, positives and windows kept in mergeable heaps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, stored
from .tiles import blocks_of_a_group, meetings, packed, placed, unpacked

#: Vectors of a block of candidates and of a block of anchors, and candidates of one tile.
CANDIDATE_BLOCK, ANCHOR_BLOCK, TILE = 4096, 1024, 512
#: A tile with a side of this size or less is multiplied without further recursion.
LEAF = 32
LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: Labels of a block up to which each label's rows and columns are multiplied alone.
FEW_LABELS = 16


def integer_vectors(table: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """vec_id, label, v: floor(scale * component) as longs, those beyond the range of longs at its ends. Rows go whose id, label
    or vector is null, or whose vector holds null or non-finite components. Columns of other names don't matter."""
    x = F.col("x")
    rows = table.select(F.col(id_col).alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("x")).dropna()
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return rows.filter(fine).select("vec_id", "label", F.transform(x, lambda c: F.floor(c * F.lit(scale))).alias("v"))


def _largest(a: np.ndarray) -> int:
    return max(int(a.max(initial=0)), -int(a.min(initial=0)))


def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times b: in doubles where no sum can reach 2^53, so that they are exact, else in int64."""
    if _largest(a) * _largest(b) * a.shape[1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _even(a: np.ndarray) -> np.ndarray:
    """a with a row and a column of zeros more where their number is odd."""
    rows, cols = a.shape[0] & 1, a.shape[1] & 1
    return np.pad(a, ((0, rows), (0, cols))) if rows or cols else a


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a times b, both int64, by seven products of halves instead of eight. Odd sides are padded with zeros. Additions wrap
    around 2^64 if they must, which cancels out: entries of the product are exact wherever they fit in 64 bits."""
    m, n = a.shape[0], b.shape[1]
    if min(m, n, a.shape[1]) <= leaf:
        return _leaf(a, b)
    a, b = _even(a), _even(b)
    i, j, k = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    out = np.empty((2 * i, 2 * k), np.int64)
    p = strassen(a11 + a22, b11 + b22, leaf)
    out[:i, :k], out[i:, k:] = p, p
    p = strassen(a21 + a22, b11, leaf)
    out[i:, :k] = p
    out[i:, k:] -= p
    p = strassen(a11, b12 - b22, leaf)
    out[:i, k:] = p
    out[i:, k:] += p
    p = strassen(a22, b21 - b11, leaf)
    out[:i, :k] += p
    out[i:, :k] += p
    p = strassen(a11 + a12, b22, leaf)
    out[:i, :k] -= p
    out[:i, k:] += p
    out[i:, k:] += strassen(a21 - a11, b11 + b12, leaf)
    out[:i, :k] += strassen(a12 - a22, b21 + b22, leaf)
    return out[:m, :n]


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a and b (int64), those beyond the range of longs at its ends."""
    if _largest(a) * _largest(b) * a.shape[1] <= MOST:
        return strassen(a, np.ascontiguousarray(b.T))
    whole = a.astype(object) @ b.astype(object).T
    return np.clip(whole, LEAST, MOST).astype(np.int64)


class Heaps:
    """For each of `rows` rows the k highest entries (score, then smaller id) pushed so far. Two heaps of the same row merge by
    pushing one's entries into the other; Spark does the same across tasks by ranks."""

    def __init__(self, rows: int, k: int):
        self.k, self.count = k, np.zeros(rows, np.int64)
        self.score, self.ids = np.full((rows, k), LEAST), np.full((rows, k), MOST)

    def admits(self, r: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which of these entries would stay now."""
        low, last = self.score[r, -1], self.ids[r, -1]
        return (score > low) | ((score == low) & (ids < last)) | (self.count[r] < self.k)

    def push(self, r: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(r):
            return
        touched = np.unique(r)
        old_r, old_c = np.nonzero(np.arange(self.k)[None, :] < self.count[touched][:, None])
        old_r = touched[old_r]
        r, score, ids = np.concatenate([old_r, r]), np.concatenate([self.score[old_r, old_c], score]), np.concatenate([self.ids[old_r, old_c], ids])
        order = np.lexsort((ids, ~score, r))  # ~score falls as score rises, and can't overflow
        r, score, ids = r[order], score[order], ids[order]
        starts = np.searchsorted(r, touched)
        place = np.arange(len(r)) - np.repeat(starts, np.diff(np.append(starts, len(r))))
        best = place < self.k
        self.score[r[best], place[best]], self.ids[r[best], place[best]] = score[best], ids[best]
        self.count[touched] = np.minimum(np.diff(np.append(starts, len(r))), self.k)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r, c = np.nonzero(np.arange(self.k)[None, :] < self.count[:, None])
        return r, self.score[r, c], self.ids[r, c]


class Block:
    """Vectors in order of their ids, so that the first of equal scores is the one that counts; packed until they are needed."""

    def __init__(self, row: dict):
        self.row = row
        self.ids, self.labels, self.places = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "places"))

    def whole(self, width: int) -> np.ndarray:
        return unpacked(self.row, width)


def _positive_entries(width: int, k: int):
    """Each anchor's k best rows of its label among the blocks of a group."""

    def meet(row, there):
        anchors = Block(row["r"])
        a, heaps = anchors.whole(width), Heaps(len(anchors.ids), k)
        for block in there:
            b = block.whole(width)
            common = np.intersect1d(anchors.labels, block.labels)
            parts = [(np.flatnonzero(anchors.labels == x), np.flatnonzero(block.labels == x)) for x in common] if len(common) <= FEW_LABELS else [(np.flatnonzero(np.isin(anchors.labels, common)), np.flatnonzero(np.isin(block.labels, common)))]
            for rows, all_cols in parts:
                for s in range(0, len(all_cols), TILE):
                    cols = all_cols[s : s + TILE]
                    tile = scores(a[rows], b[cols])
                    low = np.where(heaps.count[rows] < k, LEAST, heaps.score[rows, -1])
                    r, c = np.nonzero((tile >= low[:, None]) & (anchors.labels[rows][:, None] == block.labels[cols][None, :]) & (anchors.ids[rows][:, None] != block.ids[cols][None, :]))
                    found, score, ids = rows[r], tile[r, c], block.ids[cols[c]]
                    stay = heaps.admits(found, score, ids)
                    heaps.push(found[stay], score[stay], ids[stay])
        r, score, ids = heaps.entries()
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (anchors.places[r], ids, score)], ["place", "vec_id", "score"])

    return meet


def share_of(value: int, hundredths: int, up: bool) -> int:
    """value * hundredths / 100, rounded up or down, for integers of any size."""
    return -((-value * hundredths) // 100) if up else value * hundredths // 100


def _window_entries(width: int, k: int, low: int, high: int):
    """For each positive of each anchor the k best rows of other labels among the blocks of a group whose score lies within
    low and high hundredths of the positive's."""

    def meet(row, there):
        anchors = Block(row["r"])
        a = anchors.whole(width)
        number = {p: i for i, p in enumerate(anchors.places.tolist())}
        spans = sorted((number[w["place"]], w["rank"], share_of(w["score"], low, True), share_of(w["score"], high, False)) for w in row["extra"])
        owner, rank, least, most = (np.array(x, np.int64) for x in zip(*[s for s in spans if s[2] <= s[3]], strict=True)) if any(s[2] <= s[3] for s in spans) else (np.zeros(0, np.int64),) * 4
        heaps = Heaps(len(owner), k)
        begins = np.searchsorted(owner, np.arange(len(anchors.ids) + 1))
        windows = np.diff(begins)
        for block in there if len(owner) else []:
            b = block.whole(width)
            kinds = np.unique(block.labels)
            rows = np.flatnonzero((windows > 0) & ((anchors.labels != kinds[0]) | (len(kinds) > 1)))
            for s in range(0, len(block.ids) if len(rows) else 0, TILE):
                cols = slice(s, s + TILE)
                tile = scores(a[rows], b[cols])
                floor = np.where(heaps.count < k, least, np.maximum(least, heaps.score[:, -1]))
                lowest = np.minimum.reduceat(floor, begins[rows]) if len(rows) else floor
                highest = np.maximum.reduceat(most, begins[rows])
                r, c = np.nonzero((tile >= lowest[:, None]) & (tile <= highest[:, None]) & (anchors.labels[rows][:, None] != block.labels[cols][None, :]))
                score, ids = tile[r, c], block.ids[cols][c]
                for i in range(int(windows.max())):
                    has = windows[rows[r]] > i
                    w, sc, found = begins[rows[r[has]]] + i, score[has], ids[has]
                    stay = (sc >= floor[w]) & (sc <= most[w]) & heaps.admits(w, sc, found)
                    heaps.push(w[stay], sc[stay], found[stay])
        w, score, ids = heaps.entries()
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (anchors.places[owner[w]], rank[w], ids, score)], ["place", "positive_rank", "vec_id", "score"])

    return meet


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: hard negatives for each anchor and each of its
    first `positives` rows of the same label, whose own id is left out: the first `negatives` rows of other labels whose
    score lies within low and high hundredths of the positive's.

    Both tables have vec_id, label and v (longs), none of them null; other columns are left aside. Scores are integer inner
    products, higher ones first, ties to the smaller id. Fewer rows: all of them; a positive whose window is empty gives no
    row. Rows that repeat whole count once; with several vectors or labels an id is several rows. Vectors of unequal length:
    missing components are zero. Scores beyond the range of longs count as its ends. No rows or no anchors: no rows.

    Rows are placed in order of label and id, cut into blocks and packed. The first pass takes an anchor only to groups of
    blocks that hold its label, the second to all, and blocks of no other label are passed over. A block of anchors meets a
    tile of candidates in Strassen's product, and the scores go into heaps: of positives first, then one for each
    positive's window, whose place is only known when the heaps of positives of all tasks have been merged. A task keeps
    a group of candidate blocks of bounded size while blocks of anchors pass by, and gives a heap for each anchor."""
    spark, keys = rows.sparkSession, ["vec_id", "label", "v"]
    free = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    held = packed(placed(rows.select(keys).dropDuplicates(keys), "vectors"), CANDIDATE_BLOCK, "candidates")
    asked = stored(placed(anchors.select(keys).dropDuplicates(keys), "anchors"), "anchors")
    a_blocks = packed(asked, ANCHOR_BLOCK, "anchor-blocks")
    n, width, per_group = blocks_of_a_group(held)
    m, a_width, _ = blocks_of_a_group(a_blocks)
    if not n or not m:
        return free
    width = max(width, a_width)
    group = F.floor(F.col("block") / per_group).alias("group")
    ranked = "row_number() over (partition by {} order by score desc, vec_id)"
    with batches_of(spark, 4):
        own = a_blocks.select("block", F.explode("held").alias("label")).join(held.select(group, F.explode("held").alias("label")).distinct(), "label").select("block", "group").distinct()
        first = a_blocks.join(own, "block").withColumn("extra", F.lit(None).cast("int"))
        best = stored(meetings(held, first, "place long, vec_id long, score long", Block, _positive_entries(width, positives), per_group), "positive-heaps")
        best = stored(best.withColumn("rank", F.expr(ranked.format("place"))).filter(F.col("rank") <= positives), "positives")
        windows = best.groupBy(F.floor(F.col("place") / ANCHOR_BLOCK).cast("long").alias("block")).agg(F.collect_list(F.struct("place", "rank", "score")).alias("extra"))
        all_groups = F.explode(F.sequence(F.lit(0).cast("long"), F.lit((n - 1) // per_group).cast("long"))).alias("group")
        second = a_blocks.join(windows, "block").select("*", all_groups)
        kept = stored(meetings(held, second, "place long, positive_rank long, vec_id long, score long", Block, _window_entries(width, negatives, low, high), per_group), "window-heaps")
    kept = kept.withColumn("rank", F.expr(ranked.format("place, positive_rank"))).filter(F.col("rank") <= negatives)
    named = best.join(asked.select("place", F.col("vec_id").alias("anchor_id")), "place").select("place", F.col("rank").alias("positive_rank"), "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = kept.join(named, ["place", "positive_rank"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
