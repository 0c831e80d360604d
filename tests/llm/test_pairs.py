"""Exact copies, near copies, components and top-k against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from logweir.llm import common, exact_dedup, simhash, topk
from logweir.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, keep_id string, text_sha string"


def table(spark, rows):
    """Documents with columns whose names clash with those that operators make."""
    return spark.createDataFrame([(i, t, "en", "s", "x", "y") for i, t in rows], SCHEMA)


ODD = [(1, "a b"), (2, "a \t b"), (3, "a  b"), (4, None), (5, ""), (6, "c"), (6, "c"), (7, "a b "), (None, "d"), (None, "d"), (8, " \n"), (9, " "), (10, "x" * 200_000), (11, "x" * 200_000 + " ")]


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("digests", [True, False])
def test_exact_groups(spark, digests):
    got = exact_dedup.duplicate_groups(table(spark, ODD), digests=digests).collect()
    assert len(got) == len(ODD)
    groups = {}
    for i, t in ODD:
        groups.setdefault(normal(t), []).append(i)
    wanted = sorted((str(i), str(min((x for x in ids if x is not None), default=None)), len(ids)) for ids in groups.values() for i in ids)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got) == wanted
    assert sum(r.kept for r in got) == len(groups)
    if digests:
        assert {r.text_sha256 for r in got} == {hashlib.sha256(t.encode()).hexdigest() for t in groups}


def test_exact_duplicates_go(spark):
    kept = exact_dedup.drop_duplicates(table(spark, ODD))
    assert kept.columns == table(spark, []).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 4, 6, 7, None, 8, 10, 11]))


@pytest.mark.parametrize("digests", [True, False])
def test_hot_groups_and_shuffled_survivors(spark, monkeypatch, digests):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(common, "HOT_KEYS", 10)
    rows = [(i, "hot  text" if i % 3 else f"text {i // 2} {i}") for i in range(300)] + [(i, "two") for i in (900, 901)]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.duplicate_groups(table(spark, rows), digests=digests).collect()}
    assert len(got) == 302 and got[1] == (1, 200, True) and got[299] == (1, 200, False) and got[901] == (900, 2, False) and got[3] == (3, 1, True)
    assert exact_dedup.drop_duplicates(table(spark, rows)).count() == 102


@pytest.mark.parametrize("bits", [64, 1 << 16])
def test_a_filter_lets_all_keys_through(spark, monkeypatch, bits):
    monkeypatch.setattr(common, "FILTER_BITS", bits)
    keys = spark.range(0, 3000, 3).select(F.when(F.col("id") > 0, F.col("id")).alias("k"))
    seen = common.Filter(keys, F.xxhash64("k"), 1000)
    rows = spark.range(6000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("x").alias("filter_word"))
    maybe, never = seen.maybe(rows, F.xxhash64("k")), seen.never(rows, F.xxhash64("k"))
    assert maybe.columns == rows.columns and maybe.join(keys, maybe.k.eqNullSafe(keys.k), "left_semi").count() == 1000
    assert maybe.count() + never.count() == 6000 and never.count() > (4000 if bits > 64 else -1)


@pytest.mark.parametrize("few", [200_000, 0])
def test_texts_stay_where_they_lie(spark, monkeypatch, few):
    """Rows that share an id, or have none, are told apart by their texts; what goes is found by id and text on either way."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", few)
    rng = random.Random(5)
    a, b, c, d = (" ".join(f"{x}{rng.getrandbits(30)}" for _ in range(60)) for x in "abcd")
    near = lambda t: t.replace(t.split()[30], "zz")
    rows = [(1, a), (1, b), (None, c), (None, d), (2, near(a)), (0, near(b)), (None, near(c)), (3, near(d)), (1, a), (4, None), (4, ""), (None, None)]
    kept = [(r.doc_id, r.text) for r in simhash.drop_near_duplicates(table(spark, rows)).collect()]
    assert (1, a) in kept and kept.count((1, a)) == 1 and (0, near(b)) in kept and (3, near(d)) in kept
    assert sum(t in (c, near(c)) for _, t in kept) == 1 and sum(not t for _, t in kept) == 1 and len(kept) == 5
    assert sorted((str(r.doc_id), r.text) for r in simhash.drop_near_duplicates(table(spark, rows[:4])).collect()) == sorted([("1", a), ("1", b), ("None", c), ("None", d)])
    same = [(1, "x  y"), (1, "x y"), (1, "z"), (None, "z"), (None, "w"), (None, "v"), (0, "x\ty"), (5, "u"), (5, "u"), (6, "u")]
    kept = sorted((str(r.doc_id), r.text) for r in exact_dedup.drop_duplicates(table(spark, same)).collect())
    assert kept == sorted([("0", "x\ty"), ("1", "z"), ("None", "w"), ("None", "v"), ("5", "u")])


def test_only_suspects_are_hashed(spark):
    rows = [(1, "abc"), (2, "abcd"), (3, "x" * 64 + "1"), (4, "x" * 64 + "2"), (5, "same"), (6, "same")]
    got = {r.doc_id: r.text_sha256 is not None for r in exact_dedup.duplicate_groups(table(spark, rows), digests=False).collect()}
    assert got == {1: False, 2: False, 3: True, 4: True, 5: True, 6: True}


def test_exact_on_no_rows(spark):
    assert exact_dedup.duplicate_groups(table(spark, [])).count() == 0
    assert exact_dedup.drop_duplicates(table(spark, [])).count() == 0


def plain_fingerprint(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints():
    for text in ("", "One", "a B c d e", "É é  a\tb\nc d e f g", "a b c d " * 50, "w " * 200_000):
        assert simhash.fingerprint(text, 4) & (1 << 64) - 1 == plain_fingerprint(text, 4)


def families(rng, n, spread):
    out = []
    for _ in range(n):
        base = rng.getrandbits(64)
        out.append(base)
        for _ in range(rng.randrange(4)):
            x = base
            for b in rng.sample(range(64), rng.randrange(1, spread)):
                x ^= 1 << b
            out.append(x)
    return sorted(set(out))


def plain_components(codes, most):
    root = {c: c for c in codes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(codes, 2):
        if (a ^ b).bit_count() <= most:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    groups = {}
    for c in codes:
        groups.setdefault(find(c), set()).add(c)
    return {frozenset(g) for g in groups.values() if len(g) > 1}


@pytest.mark.parametrize(("most", "node_rows"), [(4, 8192), (4, 8), (7, 8192), (12, 8192)])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, most, node_rows):
    monkeypatch.setattr(simhash, "NODE_ROWS", node_rows)
    rng = random.Random(most)
    codes = families(rng, 60, most + 3)
    if node_rows == 8:  # one family too large for a node
        codes = sorted({*codes, *(codes[0] ^ (1 << a) ^ (1 << b) for a, b in combinations(range(12), 2))})
    reps = spark.createDataFrame([(simhash._signed(x),) for x in codes], "fp long")
    found = {}
    for r in connected_components(simhash.fingerprint_links(reps, most)).collect():
        found.setdefault(r.root, set()).add(r.node & (1 << 64) - 1)
    assert {frozenset(g) for g in found.values()} == plain_components(codes, most)


def test_gray_index_finds_all_pairs():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    codes = np.unique(np.concatenate([base, base ^ np.uint64(1 << 9), base ^ np.uint64(7)]))
    index = simhash.GrayIndex(codes)
    found = {tuple(sorted(p)) for i, j, _ in index.pairs(index, 3) for p in zip(i.tolist(), j.tolist(), strict=True)}
    wanted = {(i, j) for i, j in combinations(range(len(codes)), 2) if (int(codes[i]) ^ int(codes[j])).bit_count() <= 3}
    assert found == wanted


def test_views_miss_no_pair():
    rng = random.Random(5)
    for most in (4, 8, 12):
        masks = simhash.view_masks(*simhash.choose_views(1000, most))
        for _ in range(200):
            x = 0
            for b in rng.sample(range(64), most):
                x |= 1 << b
            assert any(x & m == 0 for m in masks)


@pytest.mark.parametrize("hot", [10_000, 3])
def test_near_duplicates(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT_KEYS", hot)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    base = [" ".join(rng.choices(words, k=200)) for _ in range(6)]
    rows = [(i * 10, t) for i, t in enumerate(base)]
    rows += [(i * 10 + 1, t.replace(t.split()[100], "zz", 1)) for i, t in enumerate(base[:3])]
    rows += [(100, ""), (101, None), (102, " \n"), (0, base[0]), (0, base[0])]
    kept = simhash.drop_near_duplicates(table(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 10, 20, 30, 40, 50, 100]
    assert kept.columns == table(spark, []).columns
    assert simhash.drop_near_duplicates(table(spark, [])).count() == 0
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicate_groups(table(spark, rows), similarity=None, max_bits=4).collect()}
    assert groups[101] == groups[102] == 100 and groups[30] == 30


def overlapping(rng, shared, own, name):
    """Two texts of five-word shingles: about shared in common, own in each alone (the last words differ)."""
    head = [f"{name}{rng.getrandbits(40)}" for _ in range(shared + 4)]
    return [" ".join(head + [f"{name}{side}{i}" for i in range(own)]) for side in "ab"]


@pytest.mark.parametrize("rows", [512, 8])
def test_exact_similarity_decides(spark, monkeypatch, rows):
    monkeypatch.setattr(simhash, "SET_ROWS", rows)
    monkeypatch.setattr(simhash, "SET_SAMPLE", 2)
    rng = random.Random(7)
    texts = []
    for i in range(150):
        texts += overlapping(rng, 160, 20, f"n{i}x")  # 160 of 200: 0.8 exactly
    for i in range(150):
        texts += overlapping(rng, 158, 20, f"f{i}x")  # just below
    family = [f"c{i}" for i in range(200)]
    for i in range(40):  # a family around one text, with members that aren't similar to each other
        texts.append(" ".join([*family[: 3 * i], f"z{i}", *family[3 * i + 1 :]]) if i else " ".join(family))
    for i in range(40):  # unlike each other, but with one passage of nearly two thirds
        texts.append(" ".join(family[:120] + [f"p{i}x{k}" for k in range(70)]))
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicate_groups(table(spark, list(enumerate(texts)))).collect()}
    assert sum(groups[2 * i + 1] == 2 * i for i in range(150)) >= 148
    assert all(groups[i] == i for i in range(300, 600))
    assert all(groups[i] == 600 for i in range(600, 640))
    assert all(groups[i] == i for i in range(640, 680))


def test_filler_makes_no_copies(spark):
    rng = random.Random(8)
    words = [[f"u{rng.getrandbits(40)}" for _ in range(60)] for _ in range(4)]
    rows = [(i, " ".join(w) + " ha" * 200) for i, w in enumerate(words)]
    rows += [(10, rows[3][1].replace(words[3][0], "zz")), (11, rows[3][1] + " ha" * 300)]
    assert len({simhash.fingerprint(t, 5) for _, t in rows}) == 1
    assert sorted(r.doc_id for r in simhash.drop_near_duplicates(table(spark, rows)).collect()) == [0, 1, 2, 3]


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(300)] + [(1000, 1001), (5, 5), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in connected_components(links).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}
    assert connected_components(links.limit(0)).count() == 0


def plain_top(queries, rows, k):
    out = []
    for q, v in queries:
        near = sorted(((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in rows if i != q))[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(near, 1)]
    return sorted(out)


def test_top_k(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(9)]) for i in range(120)]
    rows += [(200 + i, rows[7][1]) for i in range(20)]  # one vector many times
    rows += [(300, None), (301, [None] + [0.5] * 8), (302, [float("nan")] * 9), (303, [float("inf")] * 9), (None, [0.1] * 9), (304, [0.0] * 9), (305, [0.3] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    df = df.unionByName(df.filter("vec_id = 40"))
    v = topk.quantised(df)
    plain = {r.vec_id: list(r.v) for r in v.collect()}
    assert 300 not in plain and 301 not in plain and 302 not in plain and 303 not in plain and None not in plain
    for k, lists in ((5, 2), (3, 1), (7, 3)):
        got = topk.top_k(v.filter("vec_id % 40 = 0"), v, k, lists)
        assert sorted(tuple(r) for r in got.collect()) == plain_top([(i, w) for i, w in plain.items() if i % 40 == 0], list(plain.items()), k)
    assert topk.top_k(v.filter("vec_id = 0"), v.filter("vec_id < 3"), 5).count() == 2
    assert topk.top_k(v.limit(0), v, 5).count() == 0
    assert topk.top_k(v.filter("vec_id = 0"), v.limit(0), 5).count() == 0


def blocked(vectors, first_id, slices, cutoffs):
    v = np.array(vectors, np.int64)
    row = {"ids": np.arange(first_id, first_id + len(v)).tobytes(), "places": np.arange(len(v)).tobytes(), "vectors": v.tobytes(), "kind": "<i8", "rows": len(v)}
    return topk.Block(row, slices, dict(enumerate(cutoffs)))


def test_clustered_vectors_spare_scores(monkeypatch):
    """Both phases together compute fewer scores of lists than there are, and lose none of the best."""
    monkeypatch.setattr(topk, "BALL", 32)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 24)) * 200
    rows = np.concatenate([np.floor(c + rng.normal(size=(32, 24)) * 20) for c in centres])
    asked = np.floor(centres[rng.integers(0, 40, 30)] + rng.normal(size=(30, 24)) * 20)
    slices = [slice(0, 12), slice(12, 24)]
    block = blocked(rows, 1000, slices, [None] * len(rows))
    first, one = topk.heads(blocked(asked, 0, slices, [None] * 30), block, 5)
    best = {}
    for q, _, s in zip(*(c.to_pylist() for c in first.columns), strict=True):
        best.setdefault(q, []).append(s)
    whole = asked @ rows.T
    cutoffs = [sorted(set(best[q]))[-5] if len(set(best[q])) > 4 else None for q in range(30)]
    assert all(c is None or c <= sorted(w)[-5] for c, w in zip(cutoffs, whole, strict=True))
    second, two = topk.entries(blocked(asked, 0, slices, cutoffs), block)
    assert one + two < 2 * whole.size
    got = {(q, i - 1000) for q, i in zip(second.column(0).to_pylist(), second.column(1).to_pylist(), strict=True)}
    assert got >= {(q, int(i)) for q in range(30) for i in np.argsort(-whole[q], kind="stable")[:5]}


def test_queries_move_only_to_groups_that_may_hold_what_they_need(spark, monkeypatch):
    """Clusters far apart: phase two asks few of the groups that phase one asked, and the result is that of brute force."""
    for name, value in (("CANDIDATE_BLOCK", 32), ("QUERY_BLOCK", 8), ("BALL", 8)):
        monkeypatch.setattr(topk, name, value)
    rng, visits = np.random.default_rng(4), []
    centres = rng.choice((-1, 1), size=(12, 16)) * 3000
    rows = [(i, [int(x) for x in centres[i % 12] + rng.integers(-40, 40, 16)]) for i in range(480)]
    v = spark.createDataFrame(rows, "vec_id long, v array<long>")
    plain = topk.meetings
    monkeypatch.setattr(topk, "meetings", lambda held, asking, *rest: visits.append(asking.count()) or plain(held, asking, *rest))
    got = topk.top_k(v.filter("vec_id % 5 = 0"), v, 4)
    assert sorted(tuple(r) for r in got.collect()) == plain_top([r for r in rows if r[0] % 5 == 0], rows, 4)
    assert visits[1] < visits[0] / 2


def test_scores_beyond_longs_count_as_the_ends(spark):
    rows = [(0, [1e18, 1e18]), (1, [1e18, 1e18]), (2, [-1e18, -1e18]), (3, [0.0, 0.5]), (4, [0.0, 0.25])]
    v = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = topk.top_k(v.filter("vec_id in (0, 3)"), v, 4).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == 0] == [(1, topk.MOST), (3, topk.MOST), (4, topk.MOST), (2, topk.LEAST)]
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == 3] == [0, 1, 4, 2]


def test_large_components_stay_exact(spark):
    rows = [(0, [4e9, 1.0]), (1, [4e9, 0.5]), (2, [4e9, 0.25]), (3, [1.0, 1.0])]
    v = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), scale=1.0)
    got = topk.top_k(v.filter("vec_id = 3"), v.filter("vec_id < 3"), 2)
    assert [(r.vec_id, r.score) for r in got.orderBy("rank").collect()] == [(0, 4_000_000_001), (1, 4_000_000_000)]


def test_fingerprints_propose_and_sets_decide(spark, monkeypatch):
    """Pairs that the operator's search finds are held against each other though no minimum hashes propose them."""
    bands = simhash._banded

    def none(words):
        run = bands(words)

        def without(batches):
            for batch in run(batches):
                at = batch.schema.get_field_index("bands")
                yield batch.set_column(at, "bands", type(batch.column(at)).from_buffers(batch.column(at).type, len(batch), [None, bytes_of(len(batch) + 1)], children=[batch.column(at).values.slice(0, 0)]))

        import pyarrow as pa

        def bytes_of(n):
            return pa.py_buffer(bytes(4 * n))

        return without

    monkeypatch.setattr(simhash, "_banded", none)
    rng = random.Random(9)
    text = [f"w{rng.getrandbits(40)}" for _ in range(3000)]
    words = [[f"u{rng.getrandbits(40)}" for _ in range(60)] for _ in range(3)]
    rows = [(0, " ".join(text)), (1, " ".join([*text[:1500], "zz", *text[1501:]]))]
    rows += [(10 + i, " ".join(w) + " ha" * 200) for i, w in enumerate(words)]
    prints = [simhash.fingerprint(t, 5) for _, t in rows]
    assert ((prints[0] ^ prints[1]) & ((1 << 64) - 1)).bit_count() <= 4 and len(set(prints[2:])) == 1
    assert sorted(r.doc_id for r in simhash.drop_near_duplicates(table(spark, rows)).collect()) == [0, 10, 11, 12]
