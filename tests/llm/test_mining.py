"""Hard negatives, spelling variants and byte-pair encoding against brute force and the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logweir.llm import bpe, negatives, queries, spelling
from tests.conftest import SMALL

# ---------------------------------------------------------------- hard negatives


def test_strassen_is_exact():
    rng = np.random.default_rng(0)
    for m, d, n in ((1, 1, 1), (3, 5, 7), (33, 64, 65), (70, 100, 41), (130, 67, 129)):
        for most in (9, 1 << 20, 1 << 29):
            a, b = (rng.integers(-most, most + 1, s) for s in ((m, d), (d, n)))
            assert (negatives.strassen(a, b, leaf=4) == a @ b).all() and negatives.strassen(a, b, leaf=4).dtype == np.int64


def test_scores_at_the_ends_of_the_range():
    a = np.array([[(1 << 63) - 1, -(1 << 63)], [3, 4]])


def test_heaps_merge():
    rng = random.Random(1)
    entries = [(rng.randrange(6), rng.randrange(-5, 5), rng.randrange(1000)) for _ in range(600)]
    whole, parts = negatives.Heaps(6, 4), [negatives.Heaps(6, 4) for _ in range(3)]
    arrays = lambda rows: [np.array(x, np.int64) for x in zip(*rows, strict=True)]
    for i in range(0, 600, 50):
        whole.push(*arrays(entries[i : i + 50]))
        parts[i % 3].push(*arrays(entries[i : i + 50]))
    for p in parts[1:]:
        parts[0].push(*p.entries())
    want = {r: sorted(((-s, i) for q, s, i in entries if q == r))[:4] for r in range(6)}
    for heaps in (whole, parts[0]):
        assert {r: [(-s, i) for q, s, i in zip(*heaps.entries(), strict=True) if q == r] for r in range(6)} == want


def mined(rows, anchors, positives=5, keep=3, low=50, high=95):
    """Row by row. rows: (id, label, vector)."""
    rows, out = sorted({(i, y, tuple(v)) for i, y, v in rows}), []
    dot = lambda a, b: max(negatives.LEAST, min(negatives.MOST, sum(x * y for x, y in zip(a, b, strict=False))))
    for i, y, v in sorted({(i, y, tuple(v)) for i, y, v in anchors}):
        best = sorted((-dot(v, w), j) for j, z, w in rows if z == y and j != i)[:positives]
        for p, j in best:
            fits = sorted((-dot(v, w), k) for k, z, w in rows if z != y and low * -p <= 100 * dot(v, w) <= high * -p)[:keep]
            out += [(i, j, n, k, -p, -s) for n, (s, k) in enumerate(fits, 1)]
    return Counter(out)


def vectors(spark, rows):
    """With columns whose names clash with those that the operator makes."""
    return spark.createDataFrame([(i, y, v, 1, "x", 2) for i, y, v in rows], "vec_id long, label long, v array<long>, place int, block string, score int")


@pytest.mark.parametrize("case", ["plain", "ties", "many labels", "large", "uneven"])
def test_hard_negatives(spark, monkeypatch, case):
    for name, value in (("CANDIDATE_BLOCK", 32), ("ANCHOR_BLOCK", 8), ("TILE", 10), ("LEAF", 2)):
        monkeypatch.setattr(negatives, name, value)
    rng, n = random.Random(case), 150
    size, labels = {"ties": (2, 3), "large": (1 << 61, 3), "many labels": (40, 60)}.get(case, (40, 4))
    rows = [(i, 0 if rng.random() < 0.4 else rng.randrange(labels), [rng.randrange(-size, size + 1) for _ in range(6)]) for i in range(n)]
    if case == "uneven":
        rows = [(i, y, v[: rng.randrange(7)]) for i, y, v in rows] + [(i, y, v) for i, y, v in rows[:5]] + [(3, 1, [1, 2]), (3, 2, [9, 9, 9]), (500, 77, [1])]
    anchors = [r for r in rows if r[0] % 3 == 0]
    got = negatives.hard_negatives(vectors(spark, rows), vectors(spark, anchors)).collect()
    assert Counter(map(tuple, got)) == mined(rows, anchors)
    assert case == "large" or len(got) > 0


def test_no_hard_negatives(spark):
    none, some = vectors(spark, []), vectors(spark, [(1, 1, [1, 2]), (2, 1, [1, 3])])
    for rows, anchors in ((none, none), (some, none), (none, some), (some, some)):
        assert negatives.hard_negatives(rows, anchors).collect() == []


def test_rows_that_take_part(spark):
    rows = [(1, 1, [0.5, -0.001]), (None, 1, [1.0]), (2, None, [1.0]), (3, 1, None), (4, 1, [None, 1.0]), (5, 1, [float("nan")]), (6, 1, [float("inf")]), (7, 2, [1e300, -1e300])]
    made = negatives.integer_vectors(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect()
    assert {r.vec_id: r.v for r in made} == {1: [128, -1], 7: [negatives.MOST, negatives.LEAST]}


# ---------------------------------------------------------------- spelling variants


def grouped(counts, times=2):
    """word to (form, root, n, near words, the form's n), by deleting each code point of each word."""
    n, near, holes = counts, defaultdict(set), defaultdict(set)
    for w in n:
        for k in range(len(w)):
            holes[w[:k], w[k + 1 :], len(w)].add(w)
            short = w[:k] + w[k + 1 :]
            if short in n:
                near[w].add(short)
                near[short].add(w)
    for words in holes.values():
        for w in words:
            near[w] |= words - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= times * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def found(rows):
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize(("alphabet", "lengths"), [("ab", (5, 9)), ("abc", (5, 6)), ("aé日😀", (1, 6)), ("abcdefgh", (3, 5))])
def test_variants_equal_brute_force(spark, monkeypatch, alphabet, lengths):
    for name, value in (("BLOCK", 16), ("TILE", 5)):
        monkeypatch.setattr(spelling, name, value)
    rng = random.Random(alphabet)
    words = ["".join(rng.choices(alphabet, k=rng.randint(*lengths))) for _ in range(250)]
    counts = {w: rng.choice((3, 4, 6, 8, 12, 30, 60, 130)) for w in words}
    rows = spark.createDataFrame([(w, k, "x") for w, n in counts.items() for k in range(n)] + [(None, 0, "x")], "word string, n int, form string")
    got = found(spelling.variant_groups(rows, least_length=1).collect())
    assert got == grouped(counts)


def test_long_words_rare_words_and_none(spark):
    long = "é" + "ab" * 20_000
    words = [long] * 8 + [long[:30_000] + long[30_001:]] * 4 + [long + "x"] * 3 + ["short"] * 2 + ["four"] * 9 + ["lonely"] * 3 + [""] * 5
    got = found(spelling.variant_groups(spark.createDataFrame([(w,) for w in words], "word string")).collect())
    assert got == grouped({w: words.count(w) for w in (long, long[:30_000] + long[30_001:], long + "x", "lonely")})
    assert spelling.variant_groups(spark.createDataFrame([], "word string")).collect() == []
    with pytest.raises(ValueError):
        spelling.variant_groups(spark.createDataFrame([], "word string"), times=1)


def test_far_roots(spark):
    chain = ["a" * (5 + i) for i in range(7)]  # each word's form is the next
    rows = spark.createDataFrame([(w,) for i, w in enumerate(chain) for _ in range(3 * 2**i)], "word string")
    got = found(spelling.variant_groups(rows).collect())
    assert {w: r[1] for w, r in got.items()} == {w: chain[-1] for w in chain}


def test_runs(spark):
    rows = [(1, "Ab-cD ÀÉx×y Āb 日本 éf"), (2, None), (3, ""), (3, "Aa Aa"), (None, "z")]
    got = spelling.runs(spark.createDataFrame([(i, t, "r") for i, t in rows], "doc_id long, text string, run string")).collect()
    assert sorted((str(r.doc_id), r.run) for r in got) == sorted([("1", x) for x in ("ab", "cd", "ÀÉx×y", "b", "e", "f")] + [("3", "aa"), ("3", "aa"), ("None", "z")])


def test_spelling_query(spark):
    counts = Counter()
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    want = grouped({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})
    assert found(queries.op12_spelling(spark, SMALL).collect()) == want and any(r[0] for r in want.values())


# ---------------------------------------------------------------- byte-pair encoding

PATH = queries._tokenizer("word_bpe_49k.json")
TEXTS = ["", " ", "a  b\n\nc\td\re", "It's a's  'll DON'T we've", "日本 語abc é é x\t\ty", "A B ﬁ ǅ ß İ Σας ΟΔΟΣ", "\x1cfoo \x85 bar \x0b z\xa0y", "<|endoftext|> x<|startoftext|>'<|endoftext|>", "<|endoftext", "1234 5.6,7 ½²", "word" * 3000, "a" * 5000, "!?" * 3000, "🙂🙂x 👩‍👩‍👧", "\x00\x01 \x7f", "µªº×÷ÿ"]


@pytest.fixture(scope="module")
def coders():
    return bpe.Encoder(PATH), bpe.Decoder(PATH)


def test_ids_and_texts_equal_the_library(spark, coders):
    encoder, decoder = coders
    rng = random.Random(0)
    texts = [*TEXTS, *("".join(rng.choices("ab é.\n '!1Z,ſ日ĳ", k=50)) for _ in range(600)), *("".join(rng.choices("theinganreo", k=25)) for _ in range(600)), *(chr(c) + "a" + chr(c) for c in range(0x250)), *(r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())]
    got = [np.frombuffer(x, np.int32).tolist() for x in encoder.encode(texts)]
    back = decoder.decode(pa.array(got, pa.list_(pa.int32()))).to_pylist()
    for t, ids, text in zip(texts, got, back, strict=True):
        assert ids == encoder.tokenizer.encode(t, add_special_tokens=False).ids, t
        assert text == encoder.tokenizer.decode(ids, skip_special_tokens=False), t


def test_every_token_that_merges_reach_is_its_own_encoding(coders):
    vocabulary = coders[0].vocabulary
    texts = {i: w for i, w in enumerate(coders[1].shown.to_pylist()) if i in vocabulary.rank and w.endswith("</w>")}
    for i, w in list(texts.items())[::50]:
        assert list(vocabulary.ids_of([w.removesuffix("</w>")])) == [[t.id for t in coders[0].tokenizer.model.tokenize(w.removesuffix("</w>"))]]
        assert i not in vocabulary.size or next(vocabulary.ids_of([w.removesuffix("</w>")])) == [i]


def test_order_and_memory_don_t_matter(coders, monkeypatch):
    vocabulary, rng = coders[0].vocabulary, random.Random(2)
    words = sorted({"".join(rng.choices("abé".encode().decode("latin-1").replace("\xa9", "©"), k=rng.randrange(1, 12))) for _ in range(300)})
    want = dict(zip(words, vocabulary.ids_of(words), strict=True))
    rng.shuffle(words)
    assert dict(zip(words, vocabulary.ids_of(words), strict=True)) == want
    monkeypatch.setattr(bpe, "WORDS", 5)
    monkeypatch.setattr(bpe, "PAIRS", 5)
    small = bpe.Encoder(PATH)
    assert [small.encode([t])[0] for t in TEXTS] == coders[0].encode(TEXTS)


def test_suffix_automaton():
    rng = random.Random(3)
    tokens = {i: t for i, t in enumerate({tuple(rng.choices((1, 2, 3), k=rng.randrange(1, 7))) for _ in range(60)})}
    auto = bpe.SuffixAutomaton(tokens)
    for _ in range(200):
        line, state, length = rng.choices((1, 2, 3), k=30), 0, 0
        for i, s in enumerate(line, 1):
            while state and s not in auto.at[state]:
                state, length = auto.links[state], auto.length[auto.links[state]]
            if s in auto.at[state]:
                state, length = auto.at[state][s], length + 1
            at = auto.nearest[state] if length == auto.length[state] else auto.nearest[auto.links[state]] if state else 0
            ends = []
            while at > 0:
                ends.append(auto.tokens[at])
                at = auto.nearest[auto.links[at]]
            assert ends == sorted((t for t, x in tokens.items() if len(x) <= i and tuple(line[i - len(x) : i]) == x), key=lambda t: -len(tokens[t]))


def test_tables_of_texts(spark, monkeypatch):
    rows = [(i, t, "x", None) for i, t in enumerate([*TEXTS, None, "same", "same"])] + [(None, "no id", "y", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, IDs2 int")
    coded = bpe.encode(docs, PATH, out="tokens")
    assert coded.columns == ["doc_id", "tokens", "ids", "IDs2"]
    back = bpe.decode(coded.withColumn("copy", F.col("tokens")), PATH, ids_col="tokens").collect()
    library = bpe.Encoder(PATH).tokenizer
    want = {str(i): library.encode(t or "", add_special_tokens=False).ids for i, t, _, _ in rows}
    assert len(back) == len(rows) and all(r["copy"] == want[str(r.doc_id)] and r.text == library.decode(r["copy"], skip_special_tokens=False) for r in back)
    odd = spark.createDataFrame([(1, None), (2, []), (3, [320, None, 99_999, -1, 49407])], "id int, ids array<int>")
    assert {r.id: r.text for r in bpe.decode(odd, PATH).collect()} == {1: "", 2: "", 3: library.decode([320, 99_999, 49407], skip_special_tokens=False)}
    assert bpe.encode(spark.createDataFrame([], docs.schema), PATH).count() == 0
    assert list(bpe._cuts(np.array([3, 3, 9, 1, 1]), 6)) == [(0, 2), (2, 3), (3, 5)]


def test_bpe_query(spark):
    library = bpe.Encoder(PATH).tokenizer
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = set()
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.add((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    got = queries.op13_bpe(spark, SMALL)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and set(map(tuple, got.collect())) == want
