"""Packing, shards, mixing and the pipeline."""

from __future__ import annotations

import io
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweir.llm import mixing, packing, queries, simhash, sstable
from logweir.llm.common import stored
from logweir.llm.tokens import Encoder, widened
from tests.conftest import SMALL

TEXTS = ["a  b", "a\n b", "\n\nx", " x", "x ", "a \nb", "it's a's  'll", "日本 語abc é é x\t\ty", "A B ﬁ ǅ ß İ", "...hi--there_ a.b, c", "\x1cfoo \x85 bar \x0b z", "", "  ", "1234 5.6,7", "<|endoftext|> x", "Ürgh. Naïve, (ok)!\nNext line", "word" * 200]


@pytest.mark.parametrize(("name", "style"), [("byte_bpe_50k.json", "bytes"), ("word_bpe_49k.json", "words")])
def test_ids_equal_the_tokenizer(spark, name, style):
    e = Encoder(queries._tokenizer(name), style)
    rng = random.Random(0)
    texts = [*TEXTS, *("".join(rng.choices("ab é.\n '!1Z,", k=40)) for _ in range(500)), *(r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(30).collect())]
    for t in texts:
        assert np.frombuffer(widened(e.encode(t), e.width), "<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids, t


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, 0, "x") for i, t, s in rows], "doc_id long, text string, source string, row int, start string")


def check_packing(pieces, ids, length=1024):
    """Each id once, gapless sequences, sizes whole or powers of two."""
    total = sum(map(len, ids))
    seqs = {}
    for p in pieces:
        seqs.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at and n > 0
            at += n
        assert at == length or at & (at - 1) == 0
    assert sum(p.length for p in pieces) == total


def test_weights_of_nothing(spark):
    rows = [(i, "alpha beta gamma " * 40, f"s{i % 3}") for i in range(12)]
    path = queries._tokenizer("byte_bpe_50k.json")
    plain = sorted(map(tuple, packing.pack_documents(docs(spark, rows), path).collect()))
    assert sorted(map(tuple, packing.pack_documents(docs(spark, rows), path, targets={"s0": 0.0, "s1": 0.0}).collect())) == plain
    one = packing.pack_documents(docs(spark, rows), path, targets={"s0": 0.0, "s1": 1.0, "s2": 1.0}).collect()
    assert sum(r.length for r in one) == sum(r[2] for r in plain)
    assert min((r.sequence_id, r.offset) for r in one if r.source == "s0") > max((r.sequence_id, r.offset) for r in one if r.source == "s1")
    with pytest.raises(ValueError):
        packing.pack_documents(docs(spark, rows), path, targets={"s0": -1.0}).collect()


def test_packing(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(("alpha", "beta.", "gamma", "δ"), k=rng.randrange(1, 400))), "hot" if i % 3 else f"s{i % 7}") for i in range(60)]
    rows += [(100, None, None), (101, "", "s1"), (101, "", "s1"), (None, "lone", "s2"), (102, "long " * 9000, "s3")]
    path = queries._tokenizer("byte_bpe_50k.json")
    e = Encoder(path, "bytes")
    got = packing.pack_documents(docs(spark, rows), path).collect()
    ids = {i: [*e.tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t, _ in rows}
    check_packing(got, [[*e.tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for _, t, _ in rows])
    for p in got:
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert p.doc_tokens == len(ids[p.doc_id]) and len(part) == p.length
        assert p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())


def plain_schedule(queues, weights, length, least):
    """(source, first token, tokens) of visits by a plain loop: the queue that is due first is served, until all are empty."""
    rate = {s: length * weights[s] / sum(weights.values()) for s in queues}
    quantum = {s: max(r, least) for s, r in rate.items()}
    visit, at, out = dict.fromkeys(queues, 0), dict.fromkeys(queues, 0), []
    while left := [s for s in queues if at[s] < queues[s]]:
        s = min(left, key=lambda s: ((visit[s] + 0.5) * (quantum[s] / rate[s]), s))
        visit[s] += 1
        end = min(int(visit[s] * quantum[s]), queues[s])
        if end > at[s]:
            out.append((s, at[s], end - at[s]))
            at[s] = end
    return out


@pytest.mark.parametrize("most", [1_000, 2])
@pytest.mark.parametrize("targets", [None, {"a": 5, "b": 3, "c": 1.5, "d": 0.45, "e": 0.05}])
def test_schedule_equals_a_plain_round_robin(spark, monkeypatch, targets, most):
    """By either way: each task's own arithmetic, or a sort where there are more sources than `most`."""
    monkeypatch.setattr(packing, "SOURCES", most)
    rng = random.Random(4)
    sizes = {"a": 9000, "b": 7000, "c": 4000, "d": 300, "e": 40}
    rows, i = [], 0
    for source, left in sizes.items():
        while left:
            n = min(left, rng.choice((1, 7, 60, 900)))
            rows.append((i, source, "", 2, n, i))
            i, left = i + 1, left - n
    rng.shuffle(rows)
    table = spark.createDataFrame([(r[0], r[1], bytes(2 * r[4]), r[3], r[4], r[5]) for r in rows], "doc_id long, source string, ids binary, width int, n long, row long")
    pieces = sorted(packing.pack(stored(table, "t"), targets).collect(), key=lambda p: (p.sequence_id, p.offset))
    before, at = {}, dict.fromkeys(sizes, 0)
    for d, source, *_, n, _ in sorted(rows):
        before[d], at[source] = at[source], at[source] + n
    got = [(p.source, before[p.doc_id] + p.start + k) for p in pieces for k in range(p.length)]
    weights = {s: (targets or sizes)[s] for s in sizes}
    wanted = [(s, first + k) for s, first, n in plain_schedule(sizes, weights, 1024, packing.LEAST_VISIT) for k in range(n)]
    assert got == wanted
    end = min(max(i for i, (s, _) in enumerate(got) if s == source) for source in sizes) // 1024 - 1  # before any queue runs out
    share = {s: 1024 * w / sum(weights.values()) for s, w in weights.items()}
    few = sum(x < packing.LEAST_VISIT for x in share.values())
    assert end > 3 and few
    for w in range(end):
        window = [s for s, _ in got[1024 * w : 1024 * (w + 1)]]
        assert all(abs(window.count(s) - share[s]) <= len(share) + packing.LEAST_VISIT * few for s in share)


def test_packing_to_targets_and_nothing(spark):
    path = queries._tokenizer("byte_bpe_50k.json")
    rows = [(i, "word " * 600, "ab"[i % 2]) for i in range(20)]
    got = packing.pack_documents(docs(spark, rows), path, targets={"a": 0.75, "b": 0.25}).collect()
    first = [p for p in got if p.sequence_id < 6]
    for w in range(6):
        assert abs(sum(p.length for p in first if p.source == "a" and p.sequence_id == w) - 768) <= 2
    assert packing.pack_documents(docs(spark, []), path).count() == 0
    bare = docs(spark, rows[:1]).drop("source")
    assert packing.pack_documents(bare, path).agg(F.sum("length")).first()[0] > 0


def test_shards_round_trip_and_look_up(spark):
    rows = [(i * 7 - 50, f"text number {i} " * (i % 9), "s") for i in range(200)] + [(5000, None, "s"), (5001, "", "s"), (5001, "", "s"), (None, "none", "s")]
    path = queries._tokenizer("word_bpe_49k.json")
    manifest = sstable.write_shards(docs(spark, rows), sstable.shard_folder(spark), path, "words", 2, shards=5)
    got = sstable.read_shards(manifest).collect()
    e = Encoder(path, "words")
    wanted = sorted(((-(10**9) if i is None else i), [*e.tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for i, t, _ in rows)
    at = 0
    for r, (i, ids) in zip(sorted(got, key=lambda r: r.start), wanted, strict=True):
        assert (r.doc_id if r.doc_id is not None else -(10**9)) == i and r.start == at and np.frombuffer(r.ids, "<u4").tolist() == ids
        at += len(ids)
    files = manifest.collect()
    assert len(sstable.lookup(files, 5001)) == 2 and len(sstable.lookup(files, None)) == 1
    assert np.frombuffer(sstable.lookup(files, 20)[0], "<u4").tolist() == dict(wanted)[20]
    assert sstable.lookup(files, 21) == []
    assert all(a.greatest <= b.least for a, b in zip(sorted(files, key=lambda r: r.shard), sorted(files, key=lambda r: r.shard)[1:], strict=False))
    opened = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr(sstable, "_place", lambda uri: opened.append(uri) or sstable.pafs.FileSystem.from_uri(uri))
        sstable.lookup(files, 20)
    assert len(opened) == 1
    with pytest.MonkeyPatch.context() as m:
        m.setattr(sstable, "SHARD_BYTES", 100)
        assert sstable.write_shards(docs(spark, rows), sstable.shard_folder(spark), path, "words", 2).count() > 10
    assert sstable.read_shards(sstable.write_shards(docs(spark, []), sstable.shard_folder(spark), path, "words", 2)).count() == 0


def test_a_shard_alone(monkeypatch):
    monkeypatch.setattr(sstable, "BLOCK_BYTES", 64)
    out = io.BytesIO()
    w = sstable.ShardWriter(out)
    keys = [sstable.key_of(i) for i in (None, -5, 0, 3, 3, 3, 9, 10**12)]
    for n, k in enumerate(keys):
        w.add(k, np.arange(n, dtype="<u4").tobytes())
    w.finish()
    r = sstable.ShardReader(out)
    assert [k for k, _ in r] == keys and len(r.blocks) > 1
    assert len(r.get(sstable.key_of(3))) == 3 and r.get(sstable.key_of(4)) == []
    with pytest.raises(ValueError):
        w.add(sstable.key_of(1), b"")
    broken = bytearray(out.getvalue())
    broken[-sstable._FOOTER.size - 3] ^= 1
    with pytest.raises(ValueError):
        sstable.ShardReader(io.BytesIO(bytes(broken)))


def drawn_members(spark):
    rng = np.random.default_rng(0)
    p = rng.dirichlet((0.3, 0.3, 0.3), 500)
    members = stored(spark.createDataFrame([(i, int(rng.integers(1, 900)), x.tolist()) for i, x in enumerate(p)], "doc_id long, tokens long, p array<double>"), "m")
    return members, p, np.array([r.tokens for r in members.orderBy("doc_id").collect()], float)


@pytest.mark.parametrize("share", [(0.6, 0.3, 0.1), (0.98, 0.01, 0.01), (0.0, 0.5, 0.5)])
def test_rates_meet_targets_within_reach(spark, share):
    members, p, n = drawn_members(spark)
    target = np.array(share) * n.sum()
    fit = mixing.fit_rates(members, target.tolist())
    rate = np.maximum(0, 1 + p @ fit.step)
    assert np.allclose((rate * n) @ p, fit.totals) and fit.rounds < 30
    assert np.abs(fit.totals - target).max() < (1e-5 if min(share) else 1e-3) * n.sum()


@pytest.mark.parametrize("share", [(1.0, 0.0, 0.0), (0.999, 0.0, 0.001)])
def test_rates_are_optimal_where_targets_are_out_of_reach(spark, share):
    """Squared misses of convex least squares exceed the optimum by the gradient's gain at most: none here."""
    members, p, n = drawn_members(spark)
    target = np.array(share) * n.sum()
    fit = mixing.fit_rates(members, target.tolist())
    rate = np.maximum(0, 1 + p @ fit.step)
    gain = p @ (target - fit.totals)  # of raising each rate
    most = 2 * np.linalg.norm(target) * 3**0.5  # tokens of the optimum: its totals are within the miss of nothing
    gap = max(0.0, gain.max()) * most - (n * rate * gain).sum()
    miss = np.linalg.norm(target - fit.totals)
    assert miss - max(0.0, miss**2 - 2 * gap) ** 0.5 < 1e-3 * n.sum()
    slow = np.ones(500)
    for _ in range(20_000):
        slow = np.maximum(0, slow + p @ (target - (n * slow) @ p) / np.linalg.eigvalsh((p * n[:, None]).T @ p).max())
    assert miss <= np.linalg.norm(target - (n * slow) @ p) + 1e-6 * n.sum()


def test_weights_by_any_total(spark):
    members, p, n = drawn_members(spark)
    for share in ((0.6, 0.3, 0.1), (0.8, 0.15, 0.05)):
        fit = mixing.fit_rates(members, list(share), low=1.0, free_total=True)
        rate = np.maximum(1, 1 + p @ fit.step)
        totals = (rate * n) @ p
        assert np.abs(totals / totals.sum() - share).max() < 1e-4 and fit.miss < 1e-4


def test_mixing(spark):
    rows = [(i, ("good fine text " if i % 4 else "BAD!! SHOUT!! ") * 20, "high" if i % 4 else "low") for i in range(80)]
    known = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    model = mixing.fit_classifier(known.unionByName(spark.createDataFrame([(99, "x", None)], known.schema)), "domain")
    assert model.domains == ["high", "low"]
    table = docs(spark, [(i, t, "s") for i, t, _ in rows] + [(200, None, "s"), (201, "", "s"), (0, rows[0][1], "s"), (None, "good", "s"), (202, "fine " * 100_000 + "x" * 200_000, "s")])
    got = mixing.rates(table, model, {"high": 0.5, "low": 0.5}).collect()
    assert len(got) == 85 and all(r.rate >= 0 and r.miss < 1e-4 for r in got)
    low = sum(r.posteriors["low"] * r.tokens * r.rate for r in got)
    assert low / sum(r.tokens * r.rate for r in got) == pytest.approx(0.5, abs=0.01)
    prior = next(r for r in got if r.doc_id == 200)
    assert prior.tokens == 1 and prior.posteriors["low"] == pytest.approx(0.25)
    assert mixing.rates(table.limit(0), model, {"high": 1}).count() == 0
    assert mixing.mix(table.limit(0), model, {"high": 1}).count() == 0
    none = mixing.fit_classifier(known.limit(0), "domain")
    assert {r.rate for r in mixing.rates(table, none, {"x": 1}).collect()} == {1.0}
    clash = table.withColumn("membership", F.lit("x")).withColumn("rate", F.lit("y")).withColumn("copy", F.lit("z"))
    mixed = mixing.mix(clash, model, {"high": 0.5, "low": 0.5}, low=1.0, free_total=True)
    assert mixed.columns == clash.columns and mixed.select("doc_id").distinct().count() == 84
    assert mixed.count() > 85


def test_posteriors_equal_plain_sums(spark):
    rng = random.Random(3)
    words = ["Alpha", "beta!", "GAMMA", "delta?!", "e"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 90))), rng.choice("xyz")) for i in range(60)]
    model = mixing.fit_classifier(spark.createDataFrame(rows, "doc_id long, text string, domain string"), "domain")
    counts = {d: {} for d in "xyz"}
    for _, t, d in rows:
        for w in set(t.split()):
            for s in mixing.slots_of(w):
                counts[d][s] = counts[d].get(s, 0) + 1
    seen = set().union(*counts.values())
    log = {s: np.log([(counts[d].get(s, 0) + 1) / (sum(counts[d].values()) + len(seen)) for d in "xyz"]) for s in seen}
    for _, t, _ in rows:
        some = set(t.split())
        e = sum(log[s] - log[s].mean() for w in some for s in mixing.slots_of(w)) * min(1, mixing.SOFT_TOKENS / len(some))
        e = np.exp(e + np.log([sum(d == x for _, _, d in rows) / 60 for x in "xyz"]))
        assert np.allclose(model.posteriors([t])[0], e / e.sum(), atol=1e-5)


@pytest.mark.parametrize("high", [10, 5])
def test_the_stage_meets_its_targets(spark, tmp_path, high):
    """`high` of 15 documents are of the one domain, none is quite of one alone."""
    import corpus_pipeline

    rng = random.Random(high)
    words = {"high": [f"a{i}" for i in range(60)], "low": [f"b{i}" for i in range(60)]}
    rows = []
    for i in range(1500):
        mine, other = ("high", "low") if i % 15 < high else ("low", "high")
        share = rng.choice((0.02, 0.1, 0.3))
        rows.append((i, " ".join(rng.choice(words[other if rng.random() < share else mine]) for _ in range(20)), mine))
    spark.createDataFrame([(i, 0, int(d == "high")) for i, _, d in rows], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    table = docs(spark, [(i, t, "s") for i, t, _ in rows])
    got = corpus_pipeline.mix_domains(spark, table, str(tmp_path))
    model = mixing.fit_classifier(spark.createDataFrame(rows, "doc_id long, text string, domain string"), "domain")
    sums = mixing.memberships(got, model).agg(*[F.sum(F.col("tokens") * F.col("p")[k]) for k in range(2)]).first()
    assert {r.doc_id for r in got.select("doc_id").collect()} == set(range(1500))
    for k, d in enumerate(model.domains):
        assert abs(sums[k] / sum(sums) - corpus_pipeline.TARGETS[d]) < 0.02


def test_targets_out_of_reach_are_reported(spark):
    known = spark.createDataFrame([(i, f"w{i}", "ab"[i % 2]) for i in range(20)], "doc_id long, text string, domain string")
    model = mixing.fit_classifier(known, "domain")
    same = docs(spark, [(i, "none known", "s") for i in range(20)])
    with pytest.warns(UserWarning, match="not met"):
        got = mixing.rates(same, model, {"a": 0.8, "b": 0.2}, low=1.0, free_total=True).collect()
    assert len({r.miss for r in got}) == 1 and got[0].miss == pytest.approx(0.48, abs=0.01)


def plain_kept(texts: dict[int, str]) -> set[int]:
    """The smallest id of each group that pairs of Jaccard similarity of 0.8 or more connect, by all pairs."""
    sets = {i: set(simhash.shingle_set(t, 5).tolist()) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sorted(sets):
        for j in sets:
            if i < j and (len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i for i in sets if find(i) == i}


def test_pipeline(spark):
    """Each stage against brute force over its own input."""
    import corpus_pipeline as pipeline

    sf = SMALL
    at = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = at.columns, {}
    for name, stage in pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text or "" for r in at.collect()}
        if name == "toxicity":
            lexicon = queries.learned_lexicon(at, spark.read.parquet(f"{sf}/labels.parquet"))
            wanted = {i for i, t in before.items() if lexicon.score(t) < queries.TOXIC_FROM}
        elif name == "exact_dedup":
            least = {}
            for i in sorted(before):
                least.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[i]), i)
            wanted = set(least.values())
        else:
            wanted = plain_kept(before) if name == "near_dedup" else set(before)
        at = stored(stage(spark, at, sf), "t")
        assert at.columns == columns
        kept[name] = [r.doc_id for r in at.select("doc_id").collect()]
        assert set(kept[name]) == wanted and (name == "mixing" or len(kept[name]) == len(wanted)), name
    assert len(kept["toxicity"]) < 200 and len(kept["near_dedup"]) < len(kept["toxicity"])
    packed = pipeline.pack_sequences(spark, at, sf)
    e = Encoder(queries._tokenizer("byte_bpe_50k.json"), "bytes")
    check_packing(packed.collect(), [[*e.tokenizer.encode(r.text, add_special_tokens=False).ids, 0] for r in at.collect()])
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(kept["mixing"])


def test_pipeline_on_odd_rows(spark):
    import corpus_pipeline as pipeline

    base = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source").limit(40)
    odd = [(None, None, None, None), (None, "only", None, "s"), (9001, None, "en", None), (9002, "", "en", "s"), (9003, "same text here", "en", "s"), (9003, "same text here", "en", "s"), (9003, "other", "en", "s"), (9004, "word " * 60_000, "en", "s"), (9005, "x" * 200_000, None, "s")]
    at = base.unionByName(spark.createDataFrame(odd, base.schema)).withColumn("membership", F.lit("kept")).withColumn("rate", F.lit(1))
    columns = at.columns
    for name, stage in pipeline.STAGES:
        at = stored(stage(spark, at, SMALL), "odd")
        if name != "packing":
            assert at.columns == columns
            ids = {r.doc_id for r in at.select("doc_id").collect()}
            assert ids >= {None, 9003, 9004, 9005}, name
    assert at.agg(F.sum("length")).first()[0] > 60_000
    at = base.limit(0)
    for _, stage in pipeline.STAGES:
        at = stored(stage(spark, at, SMALL), "none")
        assert at.count() == 0


def test_tokenising_tasks_share_what_a_worker_remembers(spark, monkeypatch):
    import pyarrow as pa
    import public_tokenizers

    from logweir.llm import packing, tokens

    path, taken = public_tokenizers.path("byte_bpe_50k.json"), []
    docs = spark.createDataFrame([(1, "some words, some more words", "a")], "doc_id long, text string, source string")
    kind = type(docs)
    original = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda df, f, schema, *more: taken.append(f) or original(df, f, schema, *more))
    packing.tokenised(docs, path, "bytes", 0)
    batch = pa.record_batch({"doc_id": [1], "source": ["a"], "t": ["some words, some more words"]})
    for _ in range(2):  # tasks of one worker
        assert sum(b.num_rows for b in taken[0](iter([batch]))) == 1
    assert " words".strip() in tokens.encoder(path, "bytes").rest
    tokens.forget_all()
    assert not tokens.encoder(path, "bytes").rest
