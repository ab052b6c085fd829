"""A corpus pipeline: toxic documents go, one of each near-duplicate group stays, personal data is masked, the rest is packed.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept, and all but the last
return the columns of documents. Null doc_ids pass the near-duplicate stage as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm import packing, pii, simhash, toxicity
from loomgraph.llm.common import materialise, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group the row with the smallest doc_id stays; of repeated rows with that id in the group one."""
    key = "_key"
    while key in docs.columns:  # a name that no column of the documents has
        key = f"_{key}"
    keep = simhash.survivors(docs).withColumnRenamed("key", key)
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    kept = keyed.join(keep, ["doc_id", key], "left_semi").dropDuplicates(["doc_id", key]).drop(key)
    return kept.select(*docs.columns).unionByName(docs.filter("doc_id is null"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

#: A trained classifier, components and a field can't be said in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
