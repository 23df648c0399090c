"""The operators as queries over the given tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from roentra.llm import (
    bpe,
    exact_dedup,
    language_id,
    license_scan,
    merkle,
    merkle_sql,
    mixing,
    order_minhash,
    ordering,
    sharding,
    simhash,
    substring_dedup,
    toxicity,
    url_filter,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def bpe_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document, encoded and decoded."""
    vocabulary = bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.encode_and_decode(docs, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op1_bpe(spark, sf):
    return bpe_digests(_documents(spark, sf))


@query
def op2_simhash(spark, sf):
    found = simhash.near_duplicates(_documents(spark, sf), shingle=3, radius=2)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op5_exact_dedup(spark, sf):
    return exact_dedup.exact_duplicates(_documents(spark, sf))


ORACLES["op5_exact_dedup"] = r"""
WITH plain AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
    FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM plain
"""


@query
def op7_substring_dedup(spark, sf):
    found = substring_dedup.remove_repeats(_documents(spark, sf), window=35)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def order_minhash_edits(docs: DataFrame) -> DataFrame:
    """Every document with a third of it replaced from the next one, and the likeness of both."""
    ordered = ordering.with_next(
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id", "text"
    )
    size = F.char_length("value")
    moved = F.floor(size / 3).cast("int")
    edited = F.concat(
        F.substring("value", F.lit(1), size - moved), F.substring("next_value", F.lit(1), moved)
    )
    known = ordered.select(
        "bucket", "row", "key", "extra", size.cast("long").alias("n_chars"), "value",
        F.when(~F.col("extra"), edited).alias("edited"),
    )
    texts = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("value").alias("text")),
        F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")),
    )
    both = known.select("bucket", "row", F.explode(texts).alias("t")).select(
        "bucket", "row", "t.kind", "t.text"
    )
    found = order_minhash.signatures(both, "bucket", ["row", "kind"], "text")
    own, other = F.when(F.col("kind") == 0, F.col("signature")), F.when(
        F.col("kind") == 1, F.col("signature")
    )
    pairs = found.groupBy("bucket", "row").agg(F.max(own).alias("own"), F.max(other).alias("edit"))
    following = F.lead("own").over(Window.partitionBy("bucket").orderBy("row")).alias("following")
    pairs = pairs.select("bucket", "row", "own", "edit", following)
    facts = known.select(
        "bucket", "row", "key", "extra", "n_chars", F.sha2("edited", 256).alias("edited_sha256")
    )
    return facts.join(pairs, ["bucket", "row"]).where("NOT extra").select(
        F.col("key").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        order_minhash.as_text(F.col("own")).alias("fingerprint"),
        order_minhash.as_text(F.col("edit")).alias("edited_fingerprint"),
        order_minhash.likeness(F.col("own"), F.col("edit")).alias("near_edited"),
        order_minhash.likeness(F.col("own"), F.col("following")).alias("near_next"),
    )


@query
def op4_order_minhash(spark, sf):
    return order_minhash_edits(_documents(spark, sf))


@query
def op6_language_id(spark, sf):
    return language_id.identify(_documents(spark, sf)).select(
        "doc_id", "held_out", "lang_pred", "score", "accepted"
    )


# 40 shards, and a 41st on the last rack.
SHARDS = sharding.even_tree(4, 5, 2)
GROWN = SHARDS.grown(sharding.Shard(3, 4, 40))


@query
def op8_sharding(spark, sf):
    placed = sharding.assign(_documents(spark, sf), SHARDS)
    grown = sharding.place(GROWN, F.col("doc_id"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        grown.alias("grown_shard"),
    )


# Fixed values of the contract: host and beginning of path, verdict.
URL_RULES = [
    url_filter.Rule("org/", "allow"),
    url_filter.Rule("example.org/es/", "block"),
    url_filter.Rule("example.org/en/1", "block"),
    url_filter.Rule("com/fr/", "allow"),
    url_filter.Rule("com/de/", "block"),
]


@query
def op3_url_filter(spark, sf):
    return url_filter.judge(spark.read.parquet(f"{sf}/pages.parquet"), URL_RULES)


@query
def op9_mixing(spark, sf):
    return mixing.mixture(_documents(spark, sf), max_repeats=2.0)


@query
def op10_license_scan(spark, sf):
    return license_scan.scan(_documents(spark, sf))


@query
def op11_merkle_manifest(spark, sf):
    found = merkle.manifest(_documents(spark, sf), merkle.tampered())
    digests = {"leaf": "leaf", "subroot": "subroot", "root": "root", "proof": "proof_sha256", "folded": "folded_root"}
    return found.select(
        "doc_id",
        *[F.lower(F.hex(c)).alias(name) for c, name in digests.items()],
        (F.col("folded") == F.col("root")).alias("verified"),
    )


@query
def op12_toxicity(spark, sf):
    return toxicity.judge(_documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))


@query
def op13_whitening(spark, sf):
    return whitening.whiten(spark.read.parquet(f"{sf}/embeddings.parquet"))


ORACLES["op11_merkle_manifest"] = merkle_sql.ORACLE
ORACLES["op7_substring_dedup"] = r"""
WITH listed AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents
), windows AS (
    SELECT doc_id, i, md5(array_to_string(words[i:i + 34], ' ')) AS h
    FROM listed, unnest(range(1, len(words) - 33)) AS t(i)
), repeated AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM windows) WHERE n > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM repeated
), flat AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM listed
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
    FROM flat ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM listed LEFT JOIN kept USING (doc_id)
"""
