"""Mixture-controlled packing: deficit round-robin over source queues."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, prefix_sums, stored, text_of
from .tokens import TEXTS, encoder, forget_all, widened

#: Tokens that one visit to a queue serves at least; a queue owed less in a window saves its credit for later ones.
LEAST_VISIT = 16
#: Sources whose schedule tasks work out for themselves; with more, visits are sorted.
SOURCES = 1_000
#: Bytes of ids that a task hands on at a time.
BATCH_BYTES = 1 << 23


def tokenised(docs: DataFrame, tokenizer: str, style: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """row, doc_id, source, ids, width, n for each row: the text's ids as numbers of `width` bytes, then end_id. Null texts count as empty."""

    def run(batches):
        one = encoder(tokenizer, style)
        end = one.packed([end_id])

        def made(batch, first, ids):
            part = batch.slice(first, len(ids))
            n = pa.array([len(x) // one.width for x in ids], pa.int64())
            return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(ids, pa.binary()), pa.array([one.width] * len(ids), pa.int32()), n], ["doc_id", "source", "ids", "width", "n"])

        for batch in batches:
            ids, first, size = [], 0, 0
            for text in batch.column(2):
                ids.append(one.encode(text.as_py() or "") + end)
                size += len(ids[-1])
                if size > BATCH_BYTES:
                    yield made(batch, first, ids)
                    ids, first, size = [], first + len(ids), 0
            yield made(batch, first, ids)

    kind = docs.schema[id_col].dataType.simpleString()
    source = F.col(source_col).cast("string") if source_col in docs.columns else F.lit(None).cast("string")
    return docs.select(F.col(id_col).alias("doc_id"), source.alias("source"), text_of(docs, text_col).alias("t")).mapInArrow(run, f"doc_id {kind}, source string, ids binary, width int, n long").withColumn("row", F.monotonically_increasing_id())


def pack(tokens: DataFrame, targets: dict[str, float] | None = None, length: int = 1024, least_visit: int = LEAST_VISIT) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source: each piece of each document's ids, once.

    tokens: what tokenised() gives, already stored (its row numbers must not change between jobs). targets: weights by
    source; by default, and for sources they don't name, a source's share of all tokens, so that all queues end
    together; so too where all weights are zero. A queue that runs out leaves its turn to the others. A null source is a queue of its own.

    Deficit round-robin: a source's queue is its documents in order of id. A round is a window's worth of tokens: each
    queue's quantum is its target share of `length`, so every round visits every source; what a quantum has beyond whole
    tokens is carried to the next round, and a source due less than least_visit tokens a round saves its credit until it has
    them. Documents are cut where a visit ends. The state of that loop has a closed form: the i-th quantum of a source begins
    at token floor(i * quantum) of its queue and is due at round (i + 1/2) * quantum / (share * length). So a visit's place
    is its place in its own queue and, for each other source, what that source's visits due before it served, which any
    partition can work out for its own documents: no deficit is lost between windows or partitions. Beyond SOURCES sources
    it is a sort by due round instead.
    As long as no queue has run out, any window holds of each source its share of `length`, give or take one token for
    each source and least_visit for each one that saves its credit, for rounds are that much longer or shorter. Sequences are windows over the scheduled stream, filled to the last token; what is left at the end is cut into
    sequences of powers of two, so nothing is padded. An empty table gives no sequences.

    Queues are prefix sums over ranges of (source, id), a hot source over many of them; only row numbers, sources and
    counts are sorted, and ids meet their places in the queues once at the end.
    """
    slim = tokens.select("source", "doc_id", "row", "n")
    queued = prefix_sums(slim, ["source"], ["doc_id", "row"], "n", "at", "queues")
    totals = tokens.groupBy("source").agg(F.sum("n").alias("total"))
    rates = visits_of(totals, targets, length, least_visit)
    total = tokens.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    edges = window_edges(total, length)
    few = rates.limit(SOURCES + 1).collect()
    if len(few) <= SOURCES:
        few.sort(key=lambda r: (r.of is not None, (r.of or "").encode()))
        at = {r.of: i for i, r in enumerate(few)}
        schedule = [np.array([r[k] for r in few], float) for k in ("quantum", "every", "total")]
        places = queued.select("row", "at")

        def placed(batch):
            source = np.array([at[s] for s in batch.column(1).to_pylist()], np.int64)
            return places_of(batch.column(3).to_numpy().astype(float), batch.column(4).to_numpy().astype(float), source, *schedule)

    else:
        places = _sorted_visits(queued, rates)

        def placed(batch):
            held = batch.column(3)
            doc = np.repeat(np.arange(len(held)), np.diff(held.offsets.to_numpy()))
            return doc, *(held.flatten().field(k).to_numpy() for k in ("start", "size", "place"))

    def run(batches):
        forget_all()  # tokenising tasks of a worker share what it remembers; from here on nothing is encoded
        for batch in batches:
            ids = [widened(i.as_py(), w) for i, w in zip(batch.column(2), batch.column(5).to_pylist(), strict=True)]
            doc, start, size, sequence, offset = cut_at(*placed(batch), *edges)
            crc = [zlib.crc32(ids[d][4 * a : 4 * (a + n)]) for d, a, n in zip(doc.tolist(), start.tolist(), size.tolist(), strict=True)]
            took = pa.array(doc, pa.int64())
            numbers = (start, size, np.array(crc, np.int64), batch.column(4).to_numpy()[doc], sequence, offset)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(took), *(pa.array(v, pa.int64()) for v in numbers), batch.column(1).take(took)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    met = tokens.join(places, "row").select("doc_id", "source", "ids", places.columns[-1], "n", "width")
    return met.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string")


def _sorted_visits(queued: DataFrame, rates: DataFrame) -> DataFrame:
    """row, pieces (start, size, place) from a sort of all visits by due round."""
    rated = queued.join(rates.drop("total"), queued.source.eqNullSafe(rates.of)).drop("of")
    # one visit more on either side, for products of fractions are rounded; those without tokens go
    first = F.greatest(F.floor(F.col("at") / F.col("quantum")) - 1, F.lit(0))
    last = F.floor((F.col("at") + F.col("n")) / F.col("quantum")) + 1
    visits = rated.withColumn("visit", F.explode(F.sequence(first, last)))
    begin, end = (F.floor((F.col("visit") + i) * F.col("quantum")) for i in (0, 1))
    cut = visits.select(
        "row",
        "source",
        F.greatest(begin - F.col("at"), F.lit(0)).alias("start"),
        F.least(end - F.col("at"), F.col("n")).alias("stop"),
        ((F.col("visit") + 0.5) * F.col("every")).alias("due"),
        F.greatest(begin, F.col("at")).alias("queue_at"),
    ).withColumn("size", F.col("stop") - F.col("start")).filter("size > 0")
    placed = prefix_sums(cut, [], ["due", "source", "queue_at"], "size", "place", "schedule")
    return placed.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "size", "place"))).alias("pieces"))


def places_of(at, n, source, quantum, every, total):
    """(document, start, size, place) of each piece of documents that begin at token `at` of their source's queue, in order.
    quantum, every, total: of the sources in their order."""
    q = quantum[source]
    first = np.maximum(np.floor(at / q) - 1, 0)
    count = (np.floor((at + n) / q) + 2 - first).astype(np.int64)
    doc = np.repeat(np.arange(len(at)), count)
    visit = first[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count))
    begin, end = np.floor(visit * q[doc]), np.floor((visit + 1) * q[doc])
    start, stop = np.maximum(begin - at[doc], 0), np.minimum(end - at[doc], n[doc])
    some = stop > start
    doc, visit, begin, start, stop = (x[some] for x in (doc, visit, begin, start, stop))
    own = source[doc]
    due = (visit + 0.5) * every[own]
    place = np.maximum(begin, at[doc])
    for s in range(len(quantum)):
        # visits of s before this one: near due / every, told exactly by their own due rounds
        least = np.maximum(np.floor(due / every[s] - 0.5) - 1, 0)
        for k in range(4):
            other = (least + k + 0.5) * every[s]
            if k == 0:
                seen = np.zeros(len(due))
            seen += (other < due) | ((other == due) & (s < own))
        served = np.minimum(np.floor((least + seen) * quantum[s]), total[s])
        place += np.where(own == s, 0, served)
    return doc, *(x.astype(np.int64) for x in (start, stop - start, place))


def window_edges(total: int, length: int) -> tuple[int, int, np.ndarray]:
    """(length, whole windows, first places of the sequences after them and the end): those are powers of two, large ones first."""
    at, edges = total - total % length, []
    for k in range(length.bit_length(), -1, -1):
        if (total - at) & (1 << k) and at + (1 << k) <= total:
            edges.append(at)
            at += 1 << k
    return length, (total - total % length) // length, np.array([*edges, total], np.int64)


def cut_at(doc, start, size, place, length, whole, edges):
    """(document, start, size, sequence, offset): pieces cut at the edges of sequences; neighbours of one document in one sequence become one."""

    def sequence_of(p):
        return np.where(p < whole * length, p // length, whole + np.searchsorted(edges, p, side="right") - 1)

    def begin_of(s):
        return np.where(s < whole, s * length, edges[np.clip(s - whole, 0, len(edges) - 1)])

    first = sequence_of(place)
    count = sequence_of(place + size - 1) - first + 1
    at = np.repeat(np.arange(len(doc)), count)
    sequence = first[at] + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    begin, end = begin_of(sequence), begin_of(sequence + 1)
    here = np.maximum(place[at], begin)
    doc, start, size, offset = doc[at], start[at] + here - place[at], np.minimum(place[at] + size[at], end) - here, here - begin
    if not len(doc):
        return doc, start, size, sequence, offset
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (sequence[1:] != sequence[:-1]) | (offset[1:] != offset[:-1] + size[:-1]) | (start[1:] != start[:-1] + size[:-1])
    at = np.flatnonzero(new)
    return doc[at], start[at], np.add.reduceat(size, at), sequence[at], offset[at]


def visits_of(totals: DataFrame, targets: dict[str, float] | None, length: int, least_visit: int) -> DataFrame:
    """of (the source), quantum (tokens of a visit), every (rounds from one visit to the next) and total from the sources' totals."""
    share = F.col("total").cast("double")
    if targets and min(targets.values()) < 0:
        raise ValueError("a weight can't be negative")
    if targets and sum(targets.values()):
        named = F.create_map(*[x for k, v in targets.items() for x in (F.lit(k), F.lit(float(v)))])
        whole = totals.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
        share = F.coalesce(named[F.coalesce("source", F.lit(""))] * float(whole) / sum(targets.values()), share)
    share = F.greatest(share, F.lit(1e-9))  # a target of nothing: after all others
    shares = totals.select(F.col("source").alias("of"), share.alias("share"), "total")
    summed = shares.agg(F.coalesce(F.sum("share"), F.lit(1.0))).first()[0]
    tokens = F.col("share") * (length / summed)
    return shares.withColumn("quantum", F.greatest(tokens, F.lit(float(least_visit)))).select("of", "quantum", (F.col("quantum") / tokens).alias("every"), "total")


def pack_documents(docs: DataFrame, tokenizer: str, style: str = "bytes", end_id: int = 0, targets: dict[str, float] | None = None, length: int = 1024, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Tokenises docs, stores the ids in the shared folder and packs them."""
    with batches_of(docs.sparkSession, TEXTS):
        tokens = stored(tokenised(docs, tokenizer, style, end_id, id_col, text_col, source_col), "token-ids")
    return pack(tokens, targets, length)
