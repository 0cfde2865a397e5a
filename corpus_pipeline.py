"""From documents to tokens: five stages, each written as Parquet and read again by the next.

All stages take the columns of ``documents`` and any more, whatever their names. A null text counts as
empty, null ids, languages and sources are values like any other, repeated rows stay rows each unless a
stage says otherwise, texts of any length are taken whole, and an empty table gives one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.llm.bpe import encode, read_ranks
from varve.llm.common import spare
from varve.llm.jaccard import keep_one
from varve.llm.mixing import MIX_SHARE, MIX_WEIGHTS, domain_of, mix
from varve.llm.rules import reject_bad
from varve.llm.secrets import redact
from varve.session import materialize, ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, null, empty and blank texts among them (fewer than ten words).

    Copies share a verdict. A long text is measured whole, in memory in proportion to it.
    """
    ship(spark)
    return reject_bad(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of least id stays.

    Null ids come last; of equal ids the text of least hash stays, and of repeated rows one. Texts without
    words are no duplicates and all stay.
    """
    ship(spark)
    return keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; ``n_chars`` follows the text where that changed.

    Null and empty texts stay as they are, repeated rows are redacted alike, and no row goes. Time grows
    with the length of a text and the number of its secrets.
    """
    was, clean = spare(docs, "__was", "__n")
    marked = redact(docs.withColumn(was, F.length("text")))
    changed = marked.withColumn(clean, F.length("text"))
    n_chars = F.when(F.col(clean) != F.col(was), F.col(clean).cast("long")).otherwise(F.col("n_chars"))
    return changed.select(*[n_chars.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the target weights of domains, languages and sources; a second epoch repeats rows.

    Texts without words cost nothing. Rows equal in id and text have one place in the order and are taken
    or left together. A null language or source is the empty name.
    """
    tokens, copies, one = spare(docs, "__tokens", "__copies", "__one")
    mixed = mix(docs, MIX_SHARE, MIX_WEIGHTS, domain=domain_of(), out=(tokens, copies))
    repeated = mixed.withColumn(one, F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"`{copies}`"))))
    return repeated.select(*[f"`{c}`" for c in docs.columns])


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, 32-bit little-endian, and a digest of the bytes they decode to.

    The columns are ``doc_id``, ``lang``, ``source``, ``n_tokens``, ``ids`` and ``decoded_sha256``; all others
    of the documents end here. An empty text has no ids and the digest of no bytes.
    """
    ship(spark)
    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = encode(docs.select("doc_id", "lang", "source", "text"), ["doc_id", "lang", "source"], ranks, public_tokenizers.PATTERN)
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("secret scans", secret_scans),
    ("source mix", source_mix),
    ("byte-level BPE", byte_bpe),
]

# The Jaccard groups and the merges of the tokenizer are beyond SQL; tests hold the rows against
# plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
