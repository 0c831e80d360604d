"""Soft-membership mixing: document rates whose expected domain token totals match targets."""

import re
import warnings
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches_of, bounded, free_name, stored, text_of

#: Labelled rows that the classifier is fitted on, about at most.
FIT_ROWS = 20_000
#: Features are hashed into so many slots; none is left out.
SLOTS = 1 << 18
#: A text's evidence is that of this many of its distinct tokens on average (all, where it has fewer), so that memberships
#: of long texts stay soft.
SOFT_TOKENS = 40.0
#: Rounds of projected gradient at most, the largest miss at which it stops, as a share of all tokens, and from which it is reported.
ROUNDS, TOLERANCE, REPORTED = 100, 1e-7, 1e-3
#: Weight of the rates' distance from 1 beside the squared miss, as a share of all tokens; it settles ties.
TIE = 1e-10
#: Texts that a task reads at a time, texts scored at a time, and tokens whose scores it remembers.
TEXTS, SLICE, MEMORY = 1_000, 256, 300_000
_SIGNS = re.compile(r"[^\w\s]+")


def _slot(feature: str) -> int:
    return xxhash.xxh32_intdigest(feature.encode("utf-8", "surrogatepass")) % SLOTS


@lru_cache(maxsize=1 << 14)
def _sign_slot(signs: str) -> int:
    return _slot(f"\x01{signs}")


_CAPITALS, _OTHERS = _slot("\x00U"), _slot("\x00l")


def slots_of(token: str) -> list[int]:
    """Slots of a token's features: the token in lower case, its runs of signs, and whether it is all capitals."""
    out = [_slot(token.lower()), _CAPITALS if len(token) > 1 and token.isupper() else _OTHERS]
    return out if token.isalnum() else out + [_sign_slot(s) for s in _SIGNS.findall(token)]


class Classifier:
    """Naive Bayes over the features of a text's distinct tokens. weights: a row of log probabilities for each slot, less
    their mean over domains; zeros for slots that no labelled text has."""

    def __init__(self, domains: list[str], priors: np.ndarray, weights: np.ndarray):
        self.domains, self.priors, self.weights = list(domains), np.asarray(priors, float), np.asarray(weights, np.float32)

    def scorer(self):
        """A function from texts to posteriors that remembers tokens' scores."""
        d = len(self.domains)
        rows: dict[str, int] = {}
        table = np.zeros((0, d), np.float32)

        def score(texts: list[str]) -> np.ndarray:
            nonlocal table
            out = np.empty((len(texts), d))
            for first in range(0, len(texts), SLICE):
                tokens = [set(t.split()) for t in texts[first : first + SLICE]]
                if len(rows) > MEMORY:
                    rows.clear()
                    table = table[:0]
                new = list(set().union(*tokens).difference(rows))
                if new:
                    slots = [slots_of(t) for t in new]
                    sizes = np.array([len(s) for s in slots])
                    sums = np.add.reduceat(self.weights[np.concatenate(slots)], np.cumsum(sizes) - sizes, axis=0)
                    rows.update(zip(new, range(len(table), len(table) + len(new)), strict=True))
                    table = np.concatenate([table, sums])
                for i, some in enumerate(tokens, first):
                    at = np.fromiter(map(rows.__getitem__, some), np.int64, len(some))
                    at.sort()  # one order of adding, whatever the set's
                    out[i] = self.priors + table[at].sum(0, dtype=float) * min(1.0, SOFT_TOKENS / max(1, len(some)))
            out -= out.max(1, keepdims=True, initial=-np.inf)
            np.exp(out, out=out)
            return out / out.sum(1, keepdims=True)

        return score

    def posteriors(self, texts: list[str]) -> np.ndarray:
        return self.scorer()(texts) if self.domains else np.zeros((len(texts), 0))


def fit_classifier(labelled: DataFrame, domain_col: str, text_col: str = "text", id_col: str = "doc_id", rows: int = FIT_ROWS) -> Classifier:
    """Learns domains from labelled rows, about `rows` of them at most, by a hash of the id; rows with a null domain are
    left out. A feature counts once for each distinct token of a text that has it. No rows: no domains.

    Domains are few (their counts are one array in each task); what comes to the driver is bounded by SLOTS for each."""
    domain = F.col(domain_col).cast("string")
    known = bounded(labelled.filter(domain.isNotNull()), rows, id_col)
    sample = known.select(domain.alias("d"), text_of(known, text_col).alias("t"))

    def count(batches):
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held = found.setdefault(d, np.zeros(SLOTS + 1, np.int64))
                held[SLOTS] += 1  # the place after all slots counts texts
                slots = [s for t in set(text.split()) for s in slots_of(t)]
                if slots:
                    np.add.at(held, slots, 1)
        for d, n in found.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([d] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], ["d", "slot", "n"])

    counts = sample.mapInArrow(count, "d string, slot int, n long").groupBy("d", "slot").agg(F.sum("n").alias("n")).toArrow()
    domains = sorted(set(counts["d"].unique().to_pylist()))
    if not domains:
        return Classifier([], np.zeros(0), np.zeros((SLOTS, 0)))
    table = np.zeros((SLOTS + 1, len(domains)))
    table[counts["slot"].to_numpy(), np.searchsorted(domains, counts["d"].to_numpy().astype(str))] = counts["n"].to_numpy()
    texts, table = table[SLOTS], table[:SLOTS]
    seen = table.any(1)
    weights = np.log((table + 1) / (table.sum(0) + seen.sum()))
    weights -= weights.mean(1, keepdims=True)
    return Classifier(domains, np.log(texts / texts.sum()), np.where(seen[:, None], weights, 0))


def membership(docs: DataFrame, model: Classifier, text_col: str = "text") -> Column:
    """A struct of tokens (white-space words, 1 at least) and p (posteriors in the order of model.domains) for each row."""
    data = docs.sparkSession.sparkContext.broadcast((model.domains, model.priors, model.weights))

    @F.pandas_udf("tokens long, p array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = Classifier(*data.value).scorer()
        for texts in batches:
            held = texts.tolist()
            yield pd.DataFrame({"tokens": [max(1, len(t.split())) for t in held], "p": list(score(held))})

    return run(text_of(docs, text_col))


def memberships(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, tokens, p for each row."""
    return docs.select(F.col(id_col).alias("doc_id"), membership(docs, model, text_col).alias("m")).select("doc_id", "m.tokens", "m.p")


class Fit(NamedTuple):
    """Rates as max(low, 1 + posteriors * step), the expected tokens by domain that they give, those aimed at, the
    largest miss as a share of the tokens aimed at, and the rounds taken."""

    step: np.ndarray
    totals: np.ndarray
    targets: np.ndarray
    miss: float
    rounds: int


def fit_rates(members: DataFrame, targets: list[float], low: float = 0.0, rounds: int = ROUNDS, tolerance: float = TOLERANCE, free_total: bool = False) -> Fit:
    """Least squares for rates of `low` (0 or more) and above: the sum over documents of rate * tokens * posteriors as
    near as can be to each domain's target, and among equals the rates nearest to 1.

    Projected gradient in its lazy form. In the metric of tokens a document's gradient is its posteriors times the miss,
    so the steps of all rounds add up to one vector for all documents, and a document's rate is the projection of
    1 + posteriors * that vector. It is all the state there is: a lost task needs nothing else. A round tries the step
    scaled by the Gram matrix of the documents not held at `low`, shorter ones, and the plain gradient step; each partition of
    the stored table adds up what the choice and the next round need, a few numbers for each trial. The value of the
    least squares' dual falls in every round; rounds end when the gradient is gone or no trial lowers it.

    free_total: targets are weights, which any total may meet; the miss is what parts the totals from their direction.
    """
    target = np.array(targets, float)
    d = len(target)
    onto = np.eye(d)  # what posteriors count for
    if free_total:
        onto = onto - np.outer(target, target) / max(float(target @ target), 1e-300)

    def sums(trials: np.ndarray) -> tuple[float, list[tuple[float, np.ndarray, np.ndarray, np.ndarray]]]:
        """All tokens, and for each trial the value without its linear part, the totals, the Gram matrix."""

        def run(batches):
            size = 1 + d + d * d
            added = np.zeros(1 + size * len(trials))
            for batch in batches:
                n = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
                p = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                q = p @ onto
                added[0] += n.sum()
                for k, z in enumerate(trials):
                    move = q @ z
                    rate = np.maximum(low, 1 + move)
                    free = np.flatnonzero(1 + move >= low)
                    at = 1 + k * size
                    added[at] += n @ (move * rate - 0.5 * (rate - 1) ** 2)
                    added[at + 1 : at + 1 + d] += (rate * n) @ p
                    added[at + 1 + d : at + size] += ((q[free] * n[free, None]).T @ q[free]).ravel()
            yield pa.RecordBatch.from_arrays([pa.array([added], pa.list_(pa.float64()))], ["v"])

        parts = members.select("tokens", "p").mapInArrow(run, "v array<double>").select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
        v = np.zeros(1 + (1 + d + d * d) * len(trials))
        for r in parts:
            v[r.i] = r.x
        return v[0], [(x[0], x[1 : 1 + d], x[1 + d :].reshape(d, d)) for x in v[1:].reshape(len(trials), -1)]

    step = np.zeros(d)
    whole, [(value, total, gram)] = sums(step[None, :])
    wanted = np.zeros(d) if free_total else target
    if not d or not gram.any():
        return Fit(step, total, target, 0.0 if not whole else 1.0, 0)
    largest, tie, done = float(np.linalg.eigvalsh(gram).max()), TIE * whole, 0
    for done in range(rounds):
        gradient = wanted - onto @ total - tie * step
        if np.abs(gradient).max() <= tolerance * max(whole, total.sum()):
            break
        scaled = np.linalg.solve(gram + tie * np.eye(d), gradient)
        trials = np.array([step + scaled * 4.0**-j for j in range(-1, 16)] + [step + gradient / largest])
        _, found = sums(trials)
        values = [v + 0.5 * tie * z @ z - z @ wanted for z, (v, _, _) in zip(trials, found, strict=True)]
        best = int(np.nanargmin(values))
        if not values[best] < value:
            break
        step, value, (_, total, gram) = trials[best], values[best], found[best]
    aimed = target * (total @ target / max(float(target @ target), 1e-300)) if free_total else target
    return Fit(onto @ step, total, aimed, float(np.abs(aimed - total).max() / max(aimed.sum(), 1e-300)), done)


def _fitted(members: DataFrame, model: Classifier, targets: dict[str, float], low: float, tokens: float | None, free_total: bool) -> Fit:
    weights = np.array([max(0.0, targets.get(x, 0.0)) for x in model.domains])
    weights = weights / max(weights.sum(), 1e-300)
    if not free_total:
        weights = weights * (tokens if tokens is not None else members.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0])
    fit = fit_rates(members, weights.tolist(), low, free_total=free_total)
    if fit.miss > REPORTED:
        warnings.warn(f"the mixture's targets are not met: expected tokens {fit.totals.round().tolist()} of {model.domains}, aimed at {fit.targets.round().tolist()}", stacklevel=3)
    return fit


def rate_of(p: str, fit: Fit, low: float) -> Column:
    moved = sum((F.col(p)[k] * F.lit(float(z)) for k, z in enumerate(fit.step)), F.lit(1.0))
    return F.greatest(F.lit(float(low)), moved)


def copies_of(doc_id: str, rate: str) -> Column:
    """The rate rounded by a hash of the id as a uniform number."""
    u = F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + F.when(u < F.col(rate) - F.floor(rate), 1).otherwise(0)).cast("long")


def rates(docs: DataFrame, model: Classifier, targets: dict[str, float], low: float = 0.0, tokens: float | None = None, free_total: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, tokens, posteriors (map), rate, copies, miss for each row of docs.

    targets: weight by domain, domains not named 0; the tokens aimed at are shared by weight. tokens: what they are in all,
    by default as many as docs has; free_total: whatever total meets the weights. copies is the rate rounded up or down
    by a hash of the id, so that expected totals hold: whoever repeats a row so often has the mixture. miss, alike in all
    rows: how far the expected totals are from the targets at most, as a share of all tokens aimed at; above a thousandth
    a warning says so too. Null and empty texts count one token and have the prior as posteriors. Rows that repeat an id are
    documents of their own. An empty table gives an empty result; without domains rates are 1.
    """
    with batches_of(docs.sparkSession, TEXTS):
        members = stored(memberships(docs, model, id_col, text_col), "memberships")
    if not model.domains:
        return members.select("doc_id", "tokens", F.create_map().cast("map<string,double>").alias("posteriors"), F.lit(1.0).alias("rate"), F.lit(1).cast("long").alias("copies"), F.lit(1.0).alias("miss"))
    fit = _fitted(members, model, targets, low, tokens, free_total)
    named = F.map_from_arrays(F.array(*map(F.lit, model.domains)), "p").alias("posteriors")
    return members.withColumn("rate", rate_of("p", fit, low)).select("doc_id", "tokens", named, "rate", copies_of("doc_id", "rate").alias("copies"), F.lit(fit.miss).alias("miss"))


def mix(docs: DataFrame, model: Classifier, targets: dict[str, float], low: float = 0.0, tokens: float | None = None, free_total: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with each row as often as its copies say (see rates()), columns as they were.

    Rows are stored with their memberships beside them, so each text is classified once and keeps its own rate."""
    if not model.domains:
        return docs
    m, rate, copy = free_name(docs, "membership"), free_name(docs, "rate"), free_name(docs, "copy")
    with batches_of(docs.sparkSession, TEXTS):
        held = stored(docs.withColumn(m, membership(docs, model, text_col)), "memberships")
    fit = _fitted(held.select(F.col(f"{m}.tokens").alias("tokens"), F.col(f"{m}.p").alias("p")), model, targets, low, tokens, free_total)
    rated = held.withColumn(rate, rate_of(f"{m}.p", fit, low))
    many = F.sequence(F.lit(1).cast("long"), copies_of(id_col, rate))
    return rated.filter(copies_of(id_col, rate) > 0).withColumn(copy, F.explode(many)).select(docs.columns)
