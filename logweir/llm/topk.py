"""Exact top-k search by a three-phase uniform threshold."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, stored
from .tiles import blocks_of_a_group, meetings, packed, placed, unpacked

#: Slices of the components; each has its own score list.
LISTS = 2
#: Vectors of a block of candidates and of a block of queries, the bounds of what a task holds of each.
CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 1024
#: Candidates within one ball, whose bound decides whether they are scored.
BALL = 256
#: Components whose signs put vectors of one direction in neighbouring blocks.
SIGNS = 16
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """vec_id and v: floor(scale * component) as longs, those beyond the range of longs at its ends. Null ids and vectors that
    are null, or hold null or non-finite components, go."""
    x = F.col("x")
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x")).filter(F.col("vec_id").isNotNull() & x.isNotNull())
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return rows.filter(fine).select("vec_id", F.transform(x, lambda c: F.floor(c * F.lit(scale))).alias("v"))


def _signed_order(rows: DataFrame) -> DataFrame:
    """vec_id, label, v: the signs of the first components as label, which puts vectors of one direction in neighbouring blocks."""
    signs = sum((F.when(F.coalesce(F.get("v", F.lit(i)), F.lit(0)) > 0, 1 << (SIGNS - 1 - i)).otherwise(0) for i in range(SIGNS)), F.lit(0))
    return rows.select("vec_id", signs.cast("long").alias("label"), "v")


class Block:
    """Vectors by slices, with a ball around each slice's part of every BALL of them. cutoffs: of vectors that ask, None where
    there is none."""

    def __init__(self, row: dict, slices: list[slice], cutoffs: dict[int, int] | None = None):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.cutoffs = [(cutoffs or {}).get(p) for p in np.frombuffer(row["places"], np.int64).tolist()]
        whole = unpacked(row, slices[-1].stop)
        near = whole.astype(np.float64)
        fine = np.abs(near).max(initial=0) ** 2 * near.shape[1] < 2.0**52
        self.parts = [(near if fine else whole.astype(object))[:, s] for s in slices]
        self.lengths = [np.sqrt((near[:, s] ** 2).sum(1)) for s in slices]
        self.cuts = [slice(i, min(i + BALL, len(near))) for i in range(0, len(near), BALL)]
        self.balls = []
        for s in slices:
            centres = np.stack([near[c, s].mean(0) for c in self.cuts])
            self.balls.append((centres, np.array([np.sqrt(((near[c, s] - m) ** 2).sum(1).max()) for c, m in zip(self.cuts, centres, strict=True)])))

    def bounds(self, queries: Block, k: int) -> np.ndarray:
        """No score of list k is above these, for each query and ball; rounded up by more than doubles lose."""
        centres, radius = self.balls[k]
        q, length = queries.parts[k].astype(np.float64), queries.lengths[k][:, None]
        return q @ centres.T + length * radius + 1 + 1e-9 * length * (radius + np.sqrt((centres**2).sum(1)))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times b transposed, exact: in doubles if both are, whose sums stay below 2^53, else in Python's integers."""
    if a.dtype == b.dtype == np.float64:
        most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
        if most < 2.0**53:
            return a @ b.T
    return _whole_numbers(a) @ _whole_numbers(b).T


def _whole_numbers(a: np.ndarray) -> np.ndarray:
    return a if a.dtype == object else a.astype(np.int64).astype(object)


def _resolved(queries: Block, block: Block, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Whole scores of the pairs (r, c)."""
    out = np.zeros(len(r), object)
    for q, v in zip(queries.parts, block.parts, strict=True):
        exact = q.dtype == v.dtype == np.float64 and np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * q.shape[1] < 2.0**53
        a, b = (q[r], v[c]) if exact else (_whole_numbers(q)[r], _whole_numbers(v)[c])
        out += [int(x) for x in (a * b).sum(1)]
    return out


def _pairs(queries: Block, block: Block, s: int, least: np.ndarray):
    """For each ball of the block that may hold scores of `least` or more in list s: its candidates, the queries for which
    it may, and their scores in that list."""
    bounds = block.bounds(queries, s)
    for ball, cut in enumerate(block.cuts):
        rows = np.flatnonzero(bounds[:, ball] >= least)
        if len(rows):
            yield cut, rows, _product(queries.parts[s][rows], block.parts[s][cut]).astype(np.float64)


def heads(queries: Block, block: Block, k: int) -> tuple[pa.RecordBatch, int]:
    """Phase one: each query's k best of each list in the block, resolved, and how many scores of lists that took."""
    computed, found = 0, []
    for s in range(len(queries.parts)):
        score, ids = np.full((len(queries.ids), k), -np.inf), np.full((len(queries.ids), k), -1)
        bounds = block.bounds(queries, s)
        for ball in np.argsort(-bounds.max(0)).tolist():  # likely balls first
            cut = block.cuts[ball]
            rows = np.flatnonzero(bounds[:, ball] > score.min(1))
            if not len(rows):
                continue
            part = _product(queries.parts[s][rows], block.parts[s][cut]).astype(np.float64)
            computed += part.size
            part[queries.ids[rows][:, None] == block.ids[cut][None, :]] = -np.inf
            both = np.concatenate([score[rows], part], axis=1)
            at = np.concatenate([ids[rows], np.broadcast_to(np.arange(cut.start, cut.stop), part.shape)], axis=1)
            best = np.argpartition(-both, k - 1, axis=1)[:, :k]
            score[rows], ids[rows] = np.take_along_axis(both, best, 1), np.take_along_axis(at, best, 1)
        r, c = np.nonzero(score > -np.inf)
        found.append(np.stack([r, ids[r, c]]))
    r, c = np.unique(np.concatenate(found, axis=1), axis=1)
    return _rows(queries.ids[r], block.ids[c], _resolved(queries, block, r, c)), computed + r.size * (len(queries.parts) - 1)


def entries(queries: Block, block: Block) -> tuple[pa.RecordBatch, int]:
    """Phases two and three: pairs that reach their query's cutoff, and how many scores of lists that took. Such a pair has
    its share of the cutoff in some list; the other lists' scores are computed only for pairs that have it."""
    lists, computed, found = len(queries.parts), 0, [np.zeros((2, 0), np.int64)]
    cutoffs = [None if c == LEAST else c for c in queries.cutoffs]  # at the end of the range scores below count as it
    least = np.array([-np.inf if c is None else float(c // lists) for c in cutoffs])
    least -= np.where(np.isfinite(least), np.abs(least), 0) * 1e-15  # as a double the share may have been rounded up
    for s in range(lists):
        for cut, rows, part in _pairs(queries, block, s, least):
            computed += part.size
            r, c = np.nonzero(part + np.abs(part) * 1e-15 >= least[rows][:, None])
            found.append(np.stack([rows[r], c + cut.start]))
    r, c = np.unique(np.concatenate(found, axis=1), axis=1)
    other = queries.ids[r] != block.ids[c]
    r, c = r[other], c[other]
    whole = _resolved(queries, block, r, c)
    keep = np.array([cutoffs[i] is None or w >= cutoffs[i] for i, w in zip(r.tolist(), whole, strict=True)], bool)
    return _rows(queries.ids[r[keep]], block.ids[c[keep]], whole[keep]), computed + r.size * (lists - 1)


def _rows(query_ids, ids, scores) -> pa.RecordBatch:
    held = [min(max(int(x), LEAST), MOST) for x in scores]
    return pa.RecordBatch.from_arrays([pa.array(query_ids, pa.int64()), pa.array(ids, pa.int64()), pa.array(held, pa.int64())], ["query_id", "vec_id", "score"])


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, lists: int = LISTS) -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates of the highest inner product for each query, its own id left out.

    Both tables have vec_id and v (longs). Ties go to the smaller id. Fewer candidates: all of them. Ids that repeat
    with one vector count once; with several, each is a candidate and an id can take several ranks. Vectors of unequal
    length: the missing components are zero. Scores beyond the range of longs count as its ends. No queries or no
    candidates: no rows.

    The components are cut into `lists` slices, each of which scores candidates in a list of its own; a score is the sum
    over lists. Phase one gathers the k best of every local list and resolves these: the k-th best whole score is a safe
    cutoff t, for the answer can't be lower. Phase two hands t to all lists: a candidate of score t or more has at least
    t / lists in some list, so only entries of that height are collected. Phase three resolves their scores in the other
    lists where the vectors lie, keeps what reaches t, and ranks.

    Candidates are dealt into full blocks in order of their first components' signs, and a ball around every few of them
    bounds their scores in a list: phase one passes over balls that can't better a list's k best so far, phase two those
    that don't reach t / lists. Phase one also tells how high the scores of a block of queries can be in each group of
    candidate blocks at all, so that in phase two queries move only to groups that may hold what they need. A task builds
    the blocks of its group once, and blocks of queries pass by. Vectors without any structure leave nothing to pass over,
    so their lists are scored in both phases, the other lists for entries alone. Of candidates with one vector, the k + 1
    smallest ids suffice.
    """
    schema, best = "query_id long, vec_id long, score long", "row_number() over (partition by query_id order by score desc, vec_id)"
    spark = candidates.sparkSession
    distinct = candidates.select("vec_id", "v").dropDuplicates(["vec_id", "v"]).withColumn("copy", F.expr("row_number() over (partition by v order by vec_id)")).filter(F.col("copy") <= k + 1)
    held = packed(placed(_signed_order(distinct), "vectors"), CANDIDATE_BLOCK, "candidates")
    asked = stored(placed(_signed_order(queries.select("vec_id", "v").dropDuplicates(["vec_id", "v"])), "queries"), "queries")
    q_blocks = packed(asked, QUERY_BLOCK, "query-blocks")
    n, width, per_group = blocks_of_a_group(held)
    m, q_width, _ = blocks_of_a_group(q_blocks)
    if not n or not m:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = max(width, q_width)
    edges = [width * i // lists for i in range(lists + 1)]
    slices = [slice(a, b) for a, b in zip(edges, edges[1:], strict=False) if b > a]
    build = lambda row: Block(row, slices)

    def local(row, there):
        q = Block(row["r"], slices)
        highest = max(float(block.bounds(q, s).max(initial=-np.inf)) for block in there for s in range(len(slices)))
        for block in there:
            found = heads(q, block, k)[0]
            yield pa.RecordBatch.from_arrays([*found.columns, pa.nulls(found.num_rows, pa.float64())], [*found.schema.names, "bound"])
        yield pa.RecordBatch.from_arrays([pa.array([row["r"]["block"]]), pa.array([row["group"]]), pa.nulls(1, pa.int64()), pa.array([highest])], ["query_id", "vec_id", "score", "bound"])

    def collect(row, there):
        q = Block(row["r"], slices, {x["place"]: x["cutoff"] for x in row["extra"] or []})
        for block in there:
            yield entries(q, block)[0]

    with batches_of(spark, 4):
        everywhere = q_blocks.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit((n - 1) // per_group).cast("long"))).alias("group"), F.lit(None).cast("int").alias("extra"))
        told = stored(meetings(held, everywhere, f"{schema}, bound double", build, local, per_group), "heads")
        first = told.filter("bound is null").drop("bound").distinct()
        cutoffs = first.withColumn("rank", F.expr(best)).filter(F.col("rank") == k).select("query_id", F.col("score").alias("cutoff"))
        cut = asked.join(cutoffs, asked.vec_id == cutoffs.query_id, "left").select(F.floor(F.col("place") / QUERY_BLOCK).cast("long").alias("block"), "place", "cutoff")
        extra = stored(cut.groupBy("block").agg(F.collect_list(F.when(F.col("cutoff").isNotNull(), F.struct("place", "cutoff"))).alias("extra"), F.min(F.coalesce("cutoff", F.lit(LEAST))).alias("least")), "cutoffs")
        groups = told.filter("bound is not null").select(F.col("query_id").alias("block"), F.col("vec_id").alias("group"), "bound")
        # a bound is rounded up by more than the share of a cutoff can be, as a double
        near = groups.join(extra, "block").filter((F.col("least") == LEAST) | (F.col("bound") >= F.floor(F.col("least") / lists) - F.abs(F.col("least").cast("double")) * 1e-15 - 1))
        second = stored(meetings(held, q_blocks.join(near.select("block", "group", "extra"), "block"), schema, build, collect, per_group), "entries")
    return second.withColumn("rank", F.expr(best)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
