"""The corpus pipeline: from documents to packed sequences. Each stage takes (spark, docs, sf_dir), works on all that the
stage before kept, and returns a DataFrame; all but the last return the columns of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studygraph.llm import mixing, near_copies, packing, queries, substrings, toxicity
from studygraph.llm.shared import Written, clear, live, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores at 0.5 or more go."""
    docs = docs.select(COLUMNS)
    machine = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, machine, keep=True).filter("_score < 0.5").select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id stays; so do documents without an id."""
    gone = near_copies.near_copies(docs).filter("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(COLUMNS)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of 20 words that start earlier are cut out of the texts; every document stays."""
    done = substrings.remove_repeats(docs, window=20, keep=["lang", "source"])
    return done.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Four fifths of the tokens, dealt by weight to domains, languages and sources. One epoch: a document that came once
    through the deduplication is not repeated."""
    return mixing.mix(docs, [queries.domain(), F.col("lang"), F.col("source")], queries.WEIGHTS, budget=0.8, epochs=1, seed=17).select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of at most 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096, with_ids=False)


STAGES = [
    ("toxicity", reject_toxic),
    ("MinHash near-dedup", drop_near_copies),
    ("substring dedup", remove_repeats),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: SQL can express neither the learned score nor the packing; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again, and what a stage wrote on its way is
    deleted after it."""
    tables = Written(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        before = live()
        docs = tables.put(f"stage{i}", stage(spark, docs, sf_dir))
        clear(spark, live() - before - {tables.paths[f"stage{i}"]})
        if i:
            tables.drop(f"stage{i - 1}")
    return docs
