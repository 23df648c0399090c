"""From raw documents to token ids: five stages over whole tables.

Each stage takes (spark, docs, sf_dir) and returns a table. All but the last
return rows of ``documents`` with all their columns. Decisions find their rows by a key
that is the doc_id wherever it names one row, so rows without a doc_id and different rows
that share one are judged each on their own. Of rows that share a doc_id the first in the
table has it as its key, all others, and rows without one, stand behind all doc_ids in
the order of the table: where a stage keeps the smallest of a group, they go first.
Null and empty texts have no language and leave in the first stage; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roentra.llm import exact_dedup, language_id, mixing, simhash
from roentra.llm.queries import bpe_digests
from roentra.operators.durable import materialize

# No source is read more often than this.
MAX_REPEATS = 2.0


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a unique key column, and its name."""
    key = "_key"
    while key in docs.columns:
        key += "_"
    here, first, n = (f"{key}{c}" for c in ("_at", "_first", "_n"))
    repeats = F.col(n) > 1
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias(n))
    if ids.where(repeats | F.col("doc_id").isNull()).isEmpty():
        return docs.withColumn(key, F.col("doc_id")), key
    # Written, so that a row keeps its number whatever is computed anew.
    rows = materialize(docs.withColumn(here, F.monotonically_increasing_id()), "pipeline-rows")
    ids = rows.groupBy(F.col("doc_id").alias(f"{key}_id")).agg(
        F.count(F.lit(1)).alias(n), F.min(here).alias(first)
    )
    ids = ids.where(repeats | F.col(f"{key}_id").isNull())
    last = rows.agg(F.max("doc_id")).first()[0] or 0
    joined = rows.join(ids, F.col("doc_id").eqNullSafe(F.col(f"{key}_id")), "left")
    own = F.col(n).isNull() | (F.col("doc_id").isNotNull() & (F.col(here) == F.col(first)))
    named = joined.withColumn(
        key, F.when(own, F.col("doc_id")).otherwise(F.col(here) + F.lit(max(0, last) + 1))
    )
    return materialize(named.select(*docs.columns, key), "pipeline-keyed"), key


def _only(docs: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` whose key is in ``kept``, without the key."""
    return docs.join(kept.select(key), key, "left_semi").drop(key)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier does not reject."""
    docs, key = _keyed(docs)
    return _only(docs, language_id.identify(docs, key).where("accepted"), key)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest key; of repeated rows so the first."""
    docs, key = _keyed(docs)
    return _only(docs, exact_dedup.exact_duplicates(docs, key).where("kept"), key)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest key. Null texts and
    texts without words have fingerprint zero and are one group."""
    docs, key = _keyed(docs)
    groups = simhash.near_duplicates(docs, key, shingle=3, radius=2)
    return _only(docs, groups.where(F.col(key) == F.col("component_id")), key)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture reads it: at least once. A null source is a source;
    repeated rows count each; documents without words are read once."""
    docs, key = _keyed(docs)
    read = mixing.mixture(docs, key, max_repeats=MAX_REPEATS)
    return docs.join(read.select(key), key).drop(key)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts, a row for each reading; a null
    text counts as empty."""
    return bpe_digests(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]

# Models, fingerprint components and token merges are beyond SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
