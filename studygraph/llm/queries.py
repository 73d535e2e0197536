"""The queries of this subpackage: each applies one operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studygraph.llm import alignment, embeddings, exact_copies, flac, importance, licenses, mixing, near_copies, packing, quality, substrings, token_store, toxicity
from studygraph.llm.shared import Written, fresh_path, table


def id_remainder(divisor: int) -> Column:
    """crc32 of doc_id as text, modulo divisor."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def domain() -> Column:
    """The domain of a source: five sources by number to each."""
    number = F.coalesce(F.regexp_extract("source", "([0-9]+)$", 1).try_cast("int"), F.lit(0))
    return F.element_at(F.array(*map(F.lit, ("web", "books", "code", "news"))), (F.pmod(F.floor(number / 5), F.lit(4)) + 1).cast("int"))


#: Target weights of the tree domain, language, source; sources of one language share alike.
WEIGHTS: dict[tuple[str, ...], float] = {("web",): 0.4, ("books",): 0.3, ("code",): 0.1, ("news",): 0.2} | {(d, lang): w for d in ("web", "books", "code", "news") for lang, w in (("en", 0.6), ("fr", 0.15), ("de", 0.15), ("es", 0.1))}


def op1_budget_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that a mixture of as many tokens as there are takes, in at most two epochs of each source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", mixing.tokens_of(F.col("text")).alias("n"))
    chosen = mixing.mix(docs, [domain(), F.col("lang"), F.col("source")], WEIGHTS, epochs=2, seed=17, tokens=F.col("n"))
    return chosen.select("doc_id", domain().alias("domain"), "lang", "source", F.col("_epoch").alias("epoch"), F.col("_tokens").alias("tokens"), F.col("_end").alias("tokens_end"))


def op2_anchored_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without runs of 20 words that start earlier."""
    done = substrings.remove_repeats(table(spark, sf_dir, "documents"), window=20)
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op3_perfect_hash_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of all documents as they are read back from a token store by key."""
    store = token_store.write_store(table(spark, sf_dir, "documents"), fresh_path(spark, "tokens"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return store.read(store.keys()).select(F.col("id").alias("doc_id"), "start", F.col("length").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document: five terms, similarity 0.8 or more."""
    return near_copies.near_copies(table(spark, sf_dir, "documents"))


def op5_flac_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The UTF-8 bytes of all texts, padded to a positive multiple of 192, stored as FLAC streams in the shared folder, and
    read back from there."""
    raw = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    pad = F.when(F.length("_raw") == 0, 192).otherwise(F.pmod(-F.length("_raw"), F.lit(192)))
    payloads = table(spark, sf_dir, "documents").select("doc_id", raw.alias("_raw")).select("doc_id", F.length("_raw").cast("long").alias("n_bytes"), F.concat("_raw", F.encode(F.repeat(F.lit(" "), pad), "UTF-8")).alias("payload"))
    played = flac.decode(Written(spark).put("media", flac.encode(payloads, "payload")))
    return played.select(
        "doc_id", "n_bytes", F.length("pcm").cast("long").alias("payload_bytes"), F.sha2("pcm", 256).alias("payload_sha256"), F.crc32(F.substring("pcm", -16, 16)).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "feature",
    )


def op6_linear_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096, with_ids=False)


def op7_toxicity_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = toxicity.learn(docs, labels.filter(id_remainder(5) != 0))
    held_out = F.coalesce(id_remainder(5) == 0, F.lit(False)).alias("held_out")
    return toxicity.score(docs, machine).select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents by the digest of their canonical form."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.KNOWN)


def op9_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.95."""
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"), similarity=0.95)


def op10_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ensemble = quality.learn(docs, labels.filter(id_remainder(3) != 1))
    held_out = F.coalesce(id_remainder(3) == 1, F.lit(False)).alias("held_out")
    return quality.score(docs, ensemble).select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_trie_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents of 20 words or more, drawn toward the benchmark's distribution, among all documents."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers meet in every document, and how often their ids meet in all."""
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the documents with the same text stays. The older half by id, up to the middle of all ids, is indexed first;
    the other is the batch that comes after it."""
    docs = table(spark, sf_dir, "documents")
    ends = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = 0 if ends[0] is None else (ends[0] + ends[1]) // 2
    return exact_copies.exact_copies(docs, F.col("doc_id") <= middle)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_budget_tree": op1_budget_tree,
    "op2_anchored_repeats": op2_anchored_repeats,
    "op3_perfect_hash_store": op3_perfect_hash_store,
    "op4_order_minhash": op4_order_minhash,
    "op5_flac_columns": op5_flac_columns,
    "op6_linear_grouping": op6_linear_grouping,
    "op7_toxicity_machine": op7_toxicity_machine,
    "op8_license_digests": op8_license_digests,
    "op9_projection_forest": op9_projection_forest,
    "op10_rule_ensemble": op10_rule_ensemble,
    "op11_trie_resample": op11_trie_resample,
    "op12_token_alignment": op12_token_alignment,
    "op13_digest_index": op13_digest_index,
}

DOMAIN_SQL = "['web', 'books', 'code', 'news'][(coalesce(TRY_CAST(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS INTEGER), 0) // 5) % 4 + 1]"

ORACLES: dict[str, str] = {
    "op1_budget_tree": mixing.mix_sql(DOMAIN_SQL, WEIGHTS, epochs=2, seed=17),
    "op2_anchored_repeats": substrings.repeats_sql(),
    "op8_license_digests": licenses.scan_sql(),
    "op9_projection_forest": embeddings.near_sql(),
    "op13_digest_index": exact_copies.copies_sql(),
}
