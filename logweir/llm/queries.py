"""The registered queries over the text tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, language, mixing, negatives, packing, pii, simhash, spelling, sstable, topk, toxicity, urls
from .common import held_out, labelled_sample

#: Weights of the domains that op1_mixing aims at.
MIXTURE = {"high": 0.75, "low": 0.2, "toxic": 0.05}
TOXIC_FROM = 0.3
#: Weights of the sources that op4_packing aims at: the first counts three times; sources not named keep their share.
SOURCE_TARGETS = {f"src{i}": 1.0 + 2.0 * (i == 0) for i in range(20)}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, domain of documents that the labelled table covers (mixing.FIT_ROWS of them at most): toxic, else high or low by quality."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")
    return labelled_sample(docs.select("doc_id", "text"), labels.select("doc_id", domain.alias("domain")), mixing.FIT_ROWS)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = mixing.fit_classifier(labelled_domains(docs, _table(spark, sf_dir, "labels")), "domain")
    found = mixing.rates(docs, model, MIXTURE)
    p = [F.coalesce(F.col("posteriors")[d], F.lit(0.0)).alias(f"p_{d}") for d in MIXTURE]
    return found.select("doc_id", "tokens", *p, "rate", "copies", "miss")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(_table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.filter(F.col("vec_id") % 50 == 0), vectors, 5)


OP2_SQL = """
WITH q AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE embedding IS NOT NULL),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
      FROM q a JOIN q b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def learned_lexicon(docs: DataFrame, labels: DataFrame) -> toxicity.Lexicon:
    """A lexicon from labelled documents that aren't held out, toxicity.FIT_ROWS of them at most."""
    known = labels.filter(~held_out(labels)).select("doc_id", "toxic")
    return toxicity.fit_lexicon(labelled_sample(docs.select("doc_id", "text"), known, toxicity.FIT_ROWS))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    lexicon = learned_lexicon(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.toxicity(docs.select("doc_id", "text"), lexicon, out="score")
    return scored.select("doc_id", held_out(docs).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), targets=SOURCE_TARGETS)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(_table(spark, sf_dir, "documents"))


OP5_SQL = """
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.fit_model(docs.filter(~held_out(docs)))
    return language.identify(docs.select("doc_id", "text", held_out(docs).alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin("email", "ip", "card", "phone"))
    counts = [F.size(F.filter(F.col("pii.kind"), lambda x: x == F.lit(kind))).cast("long").alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("pii")).alias("spans"))


URL_RULES = (urls.host_rule("block", "net"), urls.host_rule("allow", "example.net", "/en/"), urls.host_rule("block", "example.com", "/de/"), urls.host_rule("allow", "org", "/fr/"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


OP8_SQL = """
WITH u AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM h)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches(host, '(^|[.-])(spam|spam-farm|linkfarm|clickbait|cashback|payday-loans|getrichquick|freegift|giveaway|cheap-pills|pills|viagra|cialis|levitra|tramadol|xanax|steroids|casino|casinos|poker|roulette|blackjack|slots|betting|bookmaker|jackpot|lottery|sportsbook|porn|porno|xxx|sex|sexcams|hentai|escorts|camgirls|adultdating|hookup|milf|ads|adserver|adservice|adsystem|adnetwork|doubleclick|popads|popunder|tracker|tracking|pixel|telemetry|beacon|affiliate|affiliates|warez|torrent|torrents|keygen|cracks|nulled|serialz|phishing|malware|ransomware|botnet|exploit|spyware|stealer|carding|fakelogin)([.-]|$)') THEN 'block'
    WHEN regexp_matches(path, '(^|/)(wp-admin|wp-login\\.php|phpmyadmin|cpanel|administrator|login|signin|signup|register|cgi-bin|xmlrpc\\.php|feed|rss|trackback|cart|checkout|basket|wishlist|order-status|adclick|adserve|banner|banners|popunder|outgoing|redirect\\.php|goto\\.php)(/|$)') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicate_groups(_table(spark, sf_dir, "documents"), words=4, max_bits=4, similarity=None)
    return found.select("doc_id", simhash.as_hex("fp").alias("fingerprint"), "component_id")


def op10_sstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = sstable.write_shards(_table(spark, sf_dir, "documents"), sstable.shard_folder(spark), _tokenizer("word_bpe_49k.json"), "words", 2)
    return sstable.read_shards(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = negatives.integer_vectors(_table(spark, sf_dir, "embeddings"))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.hard_negatives(rows, rows.filter(F.col("vec_id") % 50 == 0), positives=5, negatives=3, low=50, high=95)


OP11_SQL = """
WITH q AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
    FROM q a JOIN q b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth FROM s WHERE same),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
    FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score WHERE p.nth <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.runs(_table(spark, sf_dir, "documents"))
    hashed = found.select("run", F.crc32(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "run")).alias("h"))
    damaged = F.when(F.col("h") % 97 == 0, spelling.without(F.col("run"), F.col("h") % F.length("run"))).otherwise(F.col("run"))
    return spelling.variant_groups(hashed.select(damaged.alias("word")), least_length=5, least_n=3, times=2)


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _tokenizer("word_bpe_49k.json")
    coded = bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    told = coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), "ids")
    return bpe.decode(told, path).select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_mixing, op2_topk, op3_toxicity, op4_packing, op5_exact_dedup, op6_language, op7_pii, op8_url_filter, op9_simhash, op10_sstable, op11_negatives, op12_spelling, op13_bpe)
}
SQL: dict[str, str] = {"op2_topk": OP2_SQL, "op5_exact_dedup": OP5_SQL, "op8_url_filter": OP8_SQL, "op11_negatives": OP11_SQL}

