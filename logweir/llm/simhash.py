"""Near-duplicates by SimHash over a Gray-ordered hierarchical index."""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_cells, join_hot, stored, text_mark, text_of
from .components import connected_components

SEED = 42
BITS = 64
#: Shingles hashed at a time, so that a very long text needs no more memory than a short one.
SHINGLE_BLOCK = 1 << 16
#: Rows of a leaf of the index, and children of an upper node.
FANOUT = 16
#: Row or node pairs compared at a time.
PAIR_BLOCK = 1 << 20
#: A node of a view that holds more rows is cut into blocks along the Gray order, and pairs of blocks become tasks.
NODE_ROWS = 8192
#: Blocks of such a node: twice as many as it holds NODE_ROWS, between these.
LEAST_BLOCKS, MOST_BLOCKS = 32, 1024
#: Bands that propose pairs by similarity, and minimum hashes in each.
BANDS, BAND_HASHES = 20, 5
#: Rows of a node that are held against each other in one piece, and rows of a larger node that are in all of its pieces.
SET_ROWS, SET_SAMPLE = 512, 64


# ------------------------------------------------------------------------------------------------ fingerprints


def shingle_hashes(text: str, words: int):
    """Blocks of the XXH64 of each shingle of the text, repeats included."""
    tokens = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()  # bytes.split() splits on \x20 and \x09-\x0D
    if not tokens:
        return
    joined = b" ".join(tokens)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(joined)]))
    n = max(1, len(tokens) - words + 1)
    ends = ends[len(ends) - n :] if len(tokens) >= words else ends[-1:]
    h = xxhash.xxh64_intdigest
    for i in range(0, n, SHINGLE_BLOCK):
        yield np.array([h(joined[s:e], SEED) for s, e in zip(starts[i : i + SHINGLE_BLOCK].tolist(), ends[i : i + SHINGLE_BLOCK].tolist(), strict=False)], np.uint64)


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str, words: int) -> int:
    """The SimHash of the text as a signed long."""
    return _voted(shingle_hashes(text, words))


def _voted(blocks) -> int:
    votes, total = np.zeros(BITS, np.int64), 0
    for hashes in blocks:
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(votes * 2 > total, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text", marks: bool = False) -> DataFrame:
    """doc_id, fp for each row, and with marks its text_mark. Null and empty texts have fingerprint zero."""

    def run(batches):
        for batch in batches:
            found = [fingerprint(t or "", words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64()), *batch.columns[2:]], ["doc_id", "fp", *batch.schema.names[2:]])

    kind = docs.schema[id_col].dataType.simpleString()
    mark = [text_mark(docs, text_col).alias("mark")] * marks
    return docs.select(F.col(id_col).alias("doc_id"), text_of(docs, text_col).alias("text"), *mark).mapInArrow(run, f"doc_id {kind}, fp long" + ", mark long" * marks)


# ---------------------------------------------------------------------------------------------------- the views


def choose_views(rows: int, max_bits: int, node_rows: int = NODE_ROWS // 4) -> tuple[int, int]:
    """(blocks, matched): cut 64 bits into so many blocks that two fingerprints at max_bits or fewer differing bits must
    agree in at least `matched` of them, with nodes of node_rows rows or fewer where bits are even. The fewest views win."""
    best = None
    for blocks in range(max_bits + 1, BITS + 1):
        matched = blocks - max_bits
        views = comb(blocks, matched)
        if views > 2000:
            break
        best = best or (blocks, matched)
        if rows / 2.0 ** (BITS * matched / blocks) <= node_rows:
            return blocks, matched
        best = (blocks, matched)
    return best


def block_masks(blocks: int) -> list[int]:
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]


def view_masks(blocks: int, matched: int) -> list[int]:
    return [sum(c) for c in combinations(block_masks(blocks), matched)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


# ------------------------------------------------------------------------------------------- the index of one node


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """The place of each code in Gray order: the prefix exclusive or of its bits."""
    out = fp.copy()
    for s in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(s)
    return out


class GrayIndex:
    """Fingerprints in Gray order under a hierarchy of nodes. A node has the bits that all below it share (its mask and
    pattern); neighbours in Gray order differ in few bits, so low nodes fix many bits and upper ones the common few."""

    def __init__(self, fp: np.ndarray):
        self.order = np.argsort(gray_rank(fp), kind="stable")
        self.fp = fp[self.order]
        self.levels = []  # from leaves to root: first row or child, end, and/or of all below
        low, high, n = self.fp, self.fp, len(fp)
        while True:
            at = np.arange(0, n, FANOUT)
            low, high = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)
            self.levels.append((at, np.minimum(at + FANOUT, n), low, ~(low ^ high)))
            n = len(at)
            if n == 1:
                return

    def pairs(self, other: GrayIndex, max_bits: int):
        """Blocks of (i, j, differences): rows of self and of other at max_bits or fewer, i < j where both are one.

        From the roots down: the differences that a pair of nodes has accumulated on bits which both have fixed never
        shrink further down, so a pair over max_bits is pruned with all below it."""
        same = self is other
        work = [(len(self.levels), len(other.levels), np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while work:
            p, q, i, j = work.pop()
            if len(i) * FANOUT * FANOUT > PAIR_BLOCK and len(i) > 1:
                half = len(i) // 2
                work += [(p, q, i[:half], j[:half]), (p, q, i[half:], j[half:])]
                continue
            if p == 0 and q == 0:
                bits = np.bitwise_count(self.fp[i] ^ other.fp[j])
                near = (bits <= max_bits) & ((i < j) if same else True)
                if near.any():
                    yield self.order[i[near]], other.order[j[near]], bits[near]
                continue
            i, j = self._down(p, i, j, True) if p >= q else other._down(q, i, j, False)
            p, q = (p - 1, q) if p >= q else (p, q - 1)
            if same and p == q:
                keep = i <= j
                i, j = i[keep], j[keep]
            if p and q:
                _, _, a, fixed_a = self.levels[p - 1]
                _, _, b, fixed_b = other.levels[q - 1]
                keep = np.bitwise_count((a[i] ^ b[j]) & fixed_a[i] & fixed_b[j]) <= max_bits
                i, j = i[keep], j[keep]
            if len(i):
                work.append((p, q, i, j))

    def _down(self, level: int, i, j, first: bool):
        """The pairs with the nodes of one side replaced by their children."""
        at, end, _, _ = self.levels[level - 1]
        mine = i if first else j
        n = end[mine] - at[mine]
        rest = np.repeat(j if first else i, n)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(at[mine], n)
        return (inner, rest) if first else (rest, inner)


def node_links(fp: np.ndarray, side: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of one node: fewer than rows, never a pair list. side 0: within; 1 and 2: across."""
    parts = [np.flatnonzero(side == s) for s in (0, 1, 2)]
    label = np.arange(len(fp))  # of each row, the row that stands for its component
    a, b = [], []
    for p, q in ((parts[0], parts[0]), (parts[1], parts[2])):
        if len(p) == 0 or len(q) == 0:
            continue
        left = GrayIndex(fp[p])
        right = left if p is q else GrayIndex(fp[q])
        for i, j, _ in left.pairs(right, max_bits):
            i, j = p[i], q[j]
            new = label[i] != label[j]  # most pairs of a family are connected already
            i, j = i[new], j[new]
            if len(i):
                _, first = np.unique(np.stack([label[i], label[j]]), axis=1, return_index=True)
                _join(label, i[first], j[first], a, b)
    return fp[a].view(np.int64), fp[b].view(np.int64)


def _join(label: np.ndarray, i: np.ndarray, j: np.ndarray, a: list, b: list) -> None:
    """Joins the components of i and j in label and notes the pairs that were needed for it in a and b."""
    up: dict[int, int] = {}

    def find(x):
        while x in up:
            x = up[x]
        return x

    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        rx, ry = find(int(label[x])), find(int(label[y]))
        if rx != ry:
            up[ry] = rx
            a.append(x)
            b.append(y)
    to = np.arange(len(label))
    for x in up:
        to[x] = find(x)
    label[:] = to[label]


def _links_of_sorted(max_bits: int):
    """Reads rows sorted by node and yields each node's links. A node's rows may span batches."""

    def flush(parts):
        fp, side = (np.concatenate([p[k] for p in parts]) for k in ("fp", "side"))
        node = np.concatenate([p["node"] for p in parts])
        starts = np.concatenate(([0], np.flatnonzero(node[1:] != node[:-1]) + 1, [len(node)]))
        a, b = [], []
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=False):
            if e - s > 1:
                x, y = node_links(fp[s:e].view(np.uint64), side[s:e], max_bits)
                a.append(x)
                b.append(y)
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def run(batches):
        kept = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(batch.schema.names)}
            last = int(np.searchsorted(rows["node"], rows["node"][-1]))  # the last node may go on in the next batch
            if last:
                yield flush([*kept, {n: v[:last] for n, v in rows.items()}])
                kept = []
            elif kept and kept[-1]["node"][-1] != rows["node"][0]:
                yield flush(kept)
                kept = []
            kept.append({n: v[last:].copy() for n, v in rows.items()})
        if kept:
            yield flush(kept)

    return run


# --------------------------------------------------------------------------------------------------- the search


def fingerprint_links(reps: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): links that connect what pairs of distinct fingerprints at max_bits or fewer differing bits connect.

    reps has one row for each distinct fingerprint: fp.

    Two near fingerprints agree in some blocks of bits whole (choose_views). Each view puts such blocks foremost: the
    top node of a fingerprint is its pattern under the view's mask, where near pairs have no difference yet, so a pair
    meets in at least one top node. Below it a node is a Gray-ordered hierarchy that prunes whole groups by accumulated
    differences (GrayIndex). Nodes are sorted and streamed, one in memory at a time. A node with more than NODE_ROWS
    rows, a family of copies, is cut into blocks along its Gray order; the blocks' masks prune pairs of blocks before
    any row is copied, and the remaining pairs are nodes of their own.
    """
    spark = reps.sparkSession
    blocks, matched = choose_views(reps.count(), max_bits)
    masks = [_signed(m) for m in view_masks(blocks, matched)]
    views = F.array(*[F.struct(F.lit(v).alias("view"), F.lit(m).alias("mask")) for v, m in enumerate(masks)])
    rows = reps.select("fp", F.explode(views).alias("v")).select("fp", F.xxhash64(F.col("v.view"), F.col("fp").bitwiseAND(F.col("v.mask"))).alias("node"))
    # two patterns with one 64-bit node key only share a node; no link depends on it
    large = stored(rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > NODE_ROWS), "large-nodes")
    side0 = F.lit(0).cast("byte").alias("side")
    if most := large.agg(F.max("n")).first()[0]:
        small = rows.join(large, "node", "left_anti").select("node", "fp", side0)
        blocks = min(max(LEAST_BLOCKS, 2 * most // NODE_ROWS), MOST_BLOCKS)
        nodes = small.unionByName(_cut(rows.join(large, "node", "left_semi"), max_bits, blocks))
    else:
        nodes = rows.select("node", "fp", side0)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = nodes.repartition(n, "node").sortWithinPartitions("node")
    return dealt.mapInArrow(_links_of_sorted(max_bits), "a long, b long").distinct()


def _cut(rows: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """The rows of large nodes, as nodes for each pair of blocks that the blocks' shared bits don't rule out."""
    rank = F.col("fp")
    for s in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, s))
    # Spark compares signed: half a turn keeps the order
    ranked = stored(rows.withColumn("rank", rank.bitwiseXOR(F.lit(-(1 << 63)))), "large-rows")
    cuts = ranked.groupBy("node").agg(F.percentile_approx("rank", [i / blocks for i in range(1, blocks)], 2000).alias("cuts"))
    placed = ranked.join(cuts, "node").withColumn("block", F.size(F.filter("cuts", lambda c: c < F.col("rank")))).drop("cuts", "rank")
    shared = placed.groupBy("node", "block").agg(F.expr("bit_and(fp)").alias("low"), F.expr("bit_or(fp)").alias("high")).withColumn("fixed", F.bitwise_not(F.col("low").bitwiseXOR(F.col("high")))).drop("high")
    p, q = shared.alias("p"), shared.alias("q")
    apart = F.bit_count(F.col("p.low").bitwiseXOR(F.col("q.low")).bitwiseAND(F.col("p.fixed")).bitwiseAND(F.col("q.fixed")))
    pairs = p.join(q, (F.col("p.node") == F.col("q.node")) & (F.col("p.block") <= F.col("q.block")) & (apart <= max_bits)).select(F.col("p.node").alias("node"), F.col("p.block").alias("x"), F.col("q.block").alias("y"))
    ends = pairs.select("node", "x", "y", F.explode(F.when(F.col("x") == F.col("y"), F.array(F.struct(F.col("x").alias("block"), F.lit(0).cast("byte").alias("side")))).otherwise(F.array(F.struct(F.col("x").alias("block"), F.lit(1).cast("byte").alias("side")), F.struct(F.col("y").alias("block"), F.lit(2).cast("byte").alias("side"))))).alias("e")).select("node", "x", "y", "e.block", "e.side")
    return placed.join(ends, ["node", "block"]).select(F.xxhash64("node", "x", "y").alias("node"), "fp", "side")


# ------------------------------------------------------------------------------------- pairs by exact similarity


def shingle_set(text: str, words: int) -> np.ndarray:
    """The distinct shingle hashes of the text, ascending."""
    return _distinct(shingle_hashes(text, words))


def _distinct(blocks) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *blocks]))


#: A minimum hash is the least of (shingle hash xor the one) times the other.
_XORS, _FACTORS = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * BAND_HASHES), dtype=np.uint64) | np.array([[0], [1]], np.uint64)


def minimum_hashes(hashes: np.ndarray) -> np.ndarray:
    least = np.full(len(_XORS), np.iinfo(np.uint64).max)
    for i in range(0, len(hashes), 512):
        least = np.minimum(least, ((hashes[i : i + 512, None] ^ _XORS) * _FACTORS).min(0))
    return least


def _set_key(hashes: np.ndarray) -> int:
    return _signed(xxhash.xxh64_intdigest(hashes.tobytes(), SEED))


def _banded(words: int):
    """Batches of (doc_id, text, mark) to doc_id, key (a hash of the shingle set), print (the fingerprint), bands (hashes of some
    minimum hashes each; none for an empty set), mark."""

    def run(batches):
        for batch in batches:
            keys, prints, bands = [], [], []
            for text in batch.column(1).to_pylist():
                blocks = list(shingle_hashes(text, words))
                hashes = _distinct(blocks)
                keys.append(_set_key(hashes))
                prints.append(_voted(blocks))
                least = minimum_hashes(hashes).reshape(BANDS, -1)
                bands.append([_signed(xxhash.xxh64_intdigest(b.tobytes(), SEED)) for b in least] if len(hashes) else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64()), pa.array(prints, pa.int64()), pa.array(bands, pa.list_(pa.int64())), batch.column(2)], ["doc_id", "key", "print", "bands", "mark"])

    return run


def _sets(words: int):
    """Batches of (key, text) to key, data (a byte of each minimum hash, then the shingle set), of the rows whose text has that key."""

    def run(batches):
        for batch in batches:
            keys, data = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hashes = shingle_set(text, words)
                if _set_key(hashes) == key:
                    keys.append(key)
                    data.append((minimum_hashes(hashes) >> np.uint64(20)).astype(np.uint8).tobytes() + hashes.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(data, pa.binary())], ["key", "data"])

    return run


def similar_in_node(root: np.ndarray, side: np.ndarray, data: list[bytes], similarity: float) -> tuple[list[int], list[int]]:
    """Pairs of rows (side 0: within; 1 and 2: across) that join what the node's similar pairs join. Rows of equal root are joined already.

    A pair is only skipped if it is joined already, if the sets' sizes rule it out, or if its minimum hashes agree less than
    five standard deviations below the similarity; all others are held against each other whole."""
    n = BANDS * BAND_HASHES
    _, label = np.unique(root, return_inverse=True)
    sketch = np.frombuffer(b"".join(x[:n] for x in data), np.uint8).reshape(-1, n)
    sets = [np.frombuffer(x, np.uint64, offset=n) for x in data]
    size = np.array([len(x) for x in sets])
    least = n * similarity - 5 * (n * similarity * (1 - similarity)) ** 0.5
    a, b = [], []
    for i in np.flatnonzero(side < 2).tolist():
        rest = np.flatnonzero((side == 2) if side[i] else (side == 0) & (np.arange(len(side)) > i))
        rest = rest[(label[rest] != label[i]) & (np.minimum(size[rest], size[i]) >= similarity * np.maximum(size[rest], size[i]) - 1e-9)]
        rest = rest[(sketch[rest] == sketch[i]).sum(1) >= least]
        for j in rest.tolist():
            if label[i] != label[j]:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if both >= similarity * (size[i] + size[j] - both) - 1e-9:
                    label[label == label[j]] = label[i]
                    a.append(i)
                    b.append(j)
    return a, b


def _similar_of_sorted(similarity: float):
    """Reads rows sorted by node and yields each node's links. A node's rows may span batches."""

    def flush(node):
        key, root, side = (np.array([r[k] for r in node]) for k in range(3))
        i, j = similar_in_node(root, side, [r[3] for r in node], similarity) if len(node) > 1 else ([], [])
        return key[i].tolist(), key[j].tolist()

    def run(batches):
        now, node = None, []
        for batch in batches:
            a, b = [], []
            for at, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != now:
                    x, y = flush(node) if node else ([], [])
                    a += x
                    b += y
                    now, node = at, []
                node.append(row)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        if node:
            a, b = flush(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def similar_links(classes: DataFrame, docs: DataFrame, words: int, similarity: float, groups: DataFrame | None = None) -> DataFrame:
    """(a, b): links that connect the classes (key, least: an id of the class, bands) which pairs at the similarity connect.

    Candidates share a band: all of some BAND_HASHES minimum hashes. At Jaccard 0.8 a pair shares one of the BANDS with
    0.9996. Classes of a band are a node, and so are those of each of groups (key, node), which fingerprints propose (print_groups);
    nodes of the same classes count once. Each candidate is checked by the shingle
    sets, made anew from the texts of classes that have a node and joined by key. Nodes of more than SET_ROWS rows are
    cut into chunks, with SET_SAMPLE rows of the node in each of its chunks. What is then outside of a large node's
    largest component is held against all of that node's chunks, so no candidate pair is left out that isn't joined.
    """
    spark = classes.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = classes.select("key", F.posexplode("bands").alias("view", "band")).select("key", F.xxhash64("view", "band").alias("node"))
    rows = rows if groups is None else stored(rows.unionByName(groups), "proposed")
    sums = rows.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.expr("bit_xor(xxhash64(key))").alias("x"), F.expr("bit_xor(xxhash64(key, 1))").alias("y"))
    once = sums.filter("rows > 1").groupBy("rows", "x", "y").agg(F.min("node").alias("node")).select("node", "rows")
    members = stored(rows.join(once, "node").select("key", "node", F.ceil(F.col("rows") / SET_ROWS).alias("chunks"), "rows"), "set-nodes")
    asked = members.select("key").distinct().join(classes.select("key", "least"), "key").select("key", F.col("least").alias("asked_id"))
    texts = docs.join(asked, docs["doc_id"].eqNullSafe(F.col("asked_id"))).select("key", "text")
    sets = stored(texts.mapInArrow(_sets(words), "key long, data binary").groupBy("key").agg(F.first("data").alias("data")), "shingle-sets")

    def checked(placed: DataFrame) -> DataFrame:
        dealt = placed.join(sets, "key").select("node", "key", "root", "side", "data").repartition(n, "node").sortWithinPartitions("node", "side", "key")
        return dealt.mapInArrow(_similar_of_sorted(similarity), "a long, b long")

    # two nodes with one 64-bit hash only share a node; no link depends on it
    chunk = F.pmod(F.xxhash64("key", "node"), F.col("chunks"))
    every = F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)
    sampled = F.pmod(F.xxhash64("node", "key"), F.col("rows")) < SET_SAMPLE
    spread = members.select("node", "key", F.explode(F.when((F.col("chunks") > 1) & sampled, every).otherwise(F.array(chunk))).alias("chunk"))
    links = stored(checked(spread.select(F.xxhash64("node", "chunk").alias("node"), "key", F.col("key").alias("root"), F.lit(0).alias("side"))), "set-links")
    large = members.filter("chunks > 1")
    if not large.limit(1).count():
        return links
    roots = connected_components(links)
    of = stored(large.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key")), "set-roots")
    main = of.groupBy("node", "root").agg(F.count(F.lit(1)).alias("size")).groupBy("node").agg(F.max_by("root", F.struct("size", "root")).alias("main"), (F.sum("size") - F.max("size")).alias("others"))
    left = of.join(main.filter("others > 0").withColumn("parts", F.ceil(F.col("others") / SET_ROWS)), "node")
    part = F.pmod(F.xxhash64("node", "key", F.lit(1)), F.col("parts"))
    ones = left.filter("root <> main").select("node", "key", "root", part.alias("part"), F.explode(every).alias("chunk"), F.lit(1).alias("side"))
    others = left.select("node", "key", "root", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), chunk.alias("chunk"), F.lit(2).alias("side"))
    crossed = ones.unionByName(others).select(F.xxhash64("node", "part", "chunk").alias("node"), "key", "root", "side")
    return links.unionByName(checked(crossed))


def print_groups(prints: DataFrame, max_bits: int) -> DataFrame:
    """(key, node): the classes of texts whose fingerprints (print) are connected at max_bits or fewer differing bits, by the
    operator's own search (fingerprint_links). Texts of one class can differ in fingerprint, as repeats count in it."""
    pairs = stored(prints.select("key", "print").distinct(), "prints-of-classes")
    roots = connected_components(fingerprint_links(pairs.select(F.col("print").alias("fp")).distinct(), max_bits))
    of = pairs.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    return of.select("key", F.xxhash64(F.lit(-1), "root").alias("node")).distinct()


def _similar_groups(docs: DataFrame, words: int, max_bits: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(F.col(id_col).alias("doc_id"), text_of(docs, text_col).alias("text"), text_mark(docs, text_col).alias("mark"))
    prints = stored(plain.mapInArrow(_banded(words), f"doc_id {kind}, key long, print long, bands array<long>, mark long"), "bands")
    classes = stored(prints.groupBy("key").agg(F.min("doc_id").alias("least"), F.first("bands").alias("bands"), F.count(F.lit(1)).alias("rows")), "classes")
    roots = connected_components(similar_links(classes, plain, words, similarity, print_groups(prints, max_bits)))
    return _named(prints, classes, roots, "key")


def _named(prints: DataFrame, classes: DataFrame, roots: DataFrame, key: str) -> DataFrame:
    """doc_id, fp (the key), mark, root, component_id for each row of prints. classes: key, least id, rows; roots: node, root of
    those that are linked. Components of one least id are told apart by their root."""
    rooted = stored(classes.join(roots.withColumnRenamed("node", key), key, "left").select(key, "least", "rows", F.coalesce("root", key).alias("root")), "rooted")
    components = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("classes")), "components")
    of = stored(join_hot(rooted, components, ["root"], "classes", rooted.count()).select(key, "rows", "root", "component_id"), "named")
    return join_hot(prints.select("doc_id", key, *[c for c in prints.columns if c == "mark"]), of, [key], "rows", prints.count()).withColumnRenamed(key, "fp")


def _grouped(docs: DataFrame, words: int, max_bits: int, similarity: float | None, id_col: str, text_col: str, marks: bool = False) -> DataFrame:
    if similarity is not None:
        return _similar_groups(docs, words, max_bits, similarity, id_col, text_col)
    prints = stored(fingerprints(docs, words, id_col, text_col, marks), "fingerprints")
    reps = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")), "reps")
    roots = connected_components(fingerprint_links(reps.select("fp"), max_bits))
    return _named(prints, reps, roots, "fp")


def near_duplicate_groups(docs: DataFrame, words: int = 5, max_bits: int = 4, similarity: float | None = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (long), component_id: the smallest doc_id reachable over links, for each row of docs.

    Without a similarity, fingerprints link at max_bits or fewer differing bits. With one, texts link whose shingle sets
    have that Jaccard similarity or more: fingerprints connected at max_bits propose pairs, minimum hashes those whose
    fingerprints lie further apart, and the sets themselves decide (similar_links), for texts with much filler have near
    fingerprints and little in common. fp is then a hash of the shingle set, and only texts of equal sets share it.

    Null and empty texts have fingerprint zero (with a similarity, the empty set) and link to each other like any text.
    Rows that repeat an id each get a row. Null ids name no component unless no other is in it. An empty table gives an
    empty result.
    """
    return _grouped(docs, words, max_bits, similarity, id_col, text_col).select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, words: int = 5, max_bits: int = 4, similarity: float | None = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each near-duplicate group: the one with the smallest id (null ids last; of its rows with several
    texts the one whose text has the least hash, of rows alike any one). A group is that of a text, so rows that share an id
    but not a text are looked at each for itself. Rows go by id and text (drop_cells)."""
    rows = _grouped(docs, words, max_bits, similarity, id_col, text_col, marks=True)
    cells = stored(rows.groupBy("root", "doc_id", "mark").agg(F.count(F.lit(1)).alias("n")), "cells")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("first")
    groups = stored(cells.groupBy("root").agg(first, F.count(F.lit(1)).alias("cells"), F.sum("n").alias("rows")).filter("rows > 1").drop("rows"), "keepers")
    met = join_hot(cells, groups, ["root"], "cells", cells.count())
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
    return drop_cells(docs, met.select("doc_id", "mark", "n", kept.alias("kept")), id_col, text_col)


def as_hex(fp):
    """16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
