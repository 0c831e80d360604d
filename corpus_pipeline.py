"""From documents to packed training sequences: toxicity, exact copies, near copies, mixture, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logweir.llm import exact_dedup, mixing, packing, simhash, toxicity
from logweir.llm.common import forget, stored
from logweir.llm.queries import TOXIC_FROM, labelled_domains, learned_lexicon

#: Weights of the domains that the mixture aims at.
TARGETS = {"high": 0.8, "low": 0.2}
#: Rows that Python workers are handed at a time: whole texts, some very long, so few.
ROWS_AT_A_TIME = "500"


def _configured(spark: SparkSession) -> None:
    """Stages are lazy, so the session itself keeps the setting for whoever runs them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_A_TIME)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon rejects go; null and empty texts stay. Whole texts are scored; repeated rows alike."""
    _configured(spark)
    lexicon = learned_lexicon(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject_toxic(docs, lexicon, TOXIC_FROM)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null as empty) the row with the smallest doc_id stays, a null id only where there is no other."""
    _configured(spark)
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest doc_id: five-word shingles, similarity of 0.8 or more, by
    the operator's search over fingerprints and by minimum hashes. Texts without a word are one group."""
    _configured(spark)
    return simhash.drop_near_duplicates(docs, words=5, max_bits=4, similarity=0.8)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of domains that are short of their target; rates stay at 1 or above, so that none is lost, and
    the total grows until the weights are met. Null and empty texts count as one token of the prior; no rows give no rows."""
    _configured(spark)
    labelled = labelled_domains(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).filter("domain <> 'toxic'")
    model = mixing.fit_classifier(labelled, "domain")
    return mixing.mix(docs, model, TARGETS, low=1.0, free_total=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens with every source in its proportion (null: a source of its own); null texts pack as their end alone."""
    _configured(spark)
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("mixing", mix_domains), ("packing", pack_sequences)]
#: SQL can't express these stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents, each one's result stored for the next and forgotten when that is stored too."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        after = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        forget(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
