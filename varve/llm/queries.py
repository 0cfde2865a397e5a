"""The registered queries of the training-data operators, with their SQL where it can say them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.llm.common import remainder
from varve.llm.vector_sql import CLUSTERS_SQL, CODES_SQL
from varve.session import fresh_dir, ship

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    from varve.llm.secrets import RULES, find_secrets, span_list

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs)
    base = F.filter("spans", lambda s: s["kind"] < 3)

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{RULES[kind].kind}")

    counts = [count(kind) for kind in range(3)]
    return found.select(
        "doc_id", *counts, F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans")
    )


MIX_SQL = """
    WITH docs AS (
        SELECT doc_id, coalesce(text, '') AS body, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               len(regexp_extract_all(coalesce(text, ''), '[^ \x09-\x0D]+')) AS n_tokens,
               'domain' || CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1) = '' THEN 0
                    ELSE CAST(regexp_extract(source, '([0-9]{1,9})$', 1) AS BIGINT) % 4 END AS domain
        FROM documents),
    leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS HUGEINT) AS tokens FROM docs GROUP BY ALL),
    top AS (SELECT CAST(sum(tokens) * 9 // 10 AS HUGEINT) AS budget FROM leaves),
    c1 AS (SELECT domain, budget, sum(tokens) * 2 AS cap, CAST(1 AS HUGEINT) AS w FROM leaves, top GROUP BY domain, budget),
    w1 AS (SELECT *, sum(cap) OVER o AS to_here, coalesce(sum(w) OVER (ORDER BY CAST(cap AS DOUBLE) / w, domain
                ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS later
           FROM c1 WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / w, domain ROWS UNBOUNDED PRECEDING)),
    f1 AS (SELECT *, w * (budget - to_here) >= cap * later AS done FROM w1),
    b1 AS (SELECT domain, CASE WHEN done THEN cap ELSE
             ((budget - coalesce(sum(cap) FILTER (done) OVER (), 0)) * w) // sum(w) FILTER (NOT done) OVER () END AS budget FROM f1),
    c2 AS (SELECT domain, lang, budget, sum(tokens) * 2 AS cap,
                  CAST(CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 WHEN 'es' THEN 2 ELSE 1 END AS HUGEINT) AS w
           FROM leaves JOIN b1 USING (domain) GROUP BY domain, lang, budget),
    w2 AS (SELECT *, sum(cap) OVER (PARTITION BY domain ORDER BY CAST(cap AS DOUBLE) / w, lang ROWS UNBOUNDED PRECEDING) AS to_here,
                  coalesce(sum(w) OVER (PARTITION BY domain ORDER BY CAST(cap AS DOUBLE) / w, lang
                      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS later FROM c2),
    f2 AS (SELECT *, w * (budget - to_here) >= cap * later AS done FROM w2),
    b2 AS (SELECT domain, lang, CASE WHEN done THEN cap ELSE
             ((budget - coalesce(sum(cap) FILTER (done) OVER (PARTITION BY domain), 0)) * w)
             // sum(w) FILTER (NOT done) OVER (PARTITION BY domain) END AS budget FROM f2),
    c3 AS (SELECT domain, lang, source, budget, tokens * 2 AS cap, CAST(1 AS HUGEINT) AS w
           FROM leaves JOIN b2 USING (domain, lang)),
    w3 AS (SELECT *, sum(cap) OVER (PARTITION BY domain, lang ORDER BY CAST(cap AS DOUBLE) / w, source ROWS UNBOUNDED PRECEDING) AS to_here,
                  coalesce(sum(w) OVER (PARTITION BY domain, lang ORDER BY CAST(cap AS DOUBLE) / w, source
                      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS later FROM c3),
    f3 AS (SELECT *, w * (budget - to_here) >= cap * later AS done FROM w3),
    b3 AS (SELECT domain, lang, source, CASE WHEN done THEN cap ELSE
             ((budget - coalesce(sum(cap) FILTER (done) OVER (PARTITION BY domain, lang), 0)) * w)
             // sum(w) FILTER (NOT done) OVER (PARTITION BY domain, lang) END AS quota FROM f3),
    plan AS (SELECT domain, lang, source, CASE WHEN tokens = 0 THEN 2 ELSE quota // tokens END AS full_epochs,
                    CASE WHEN tokens = 0 THEN 0 ELSE quota % tokens END AS rest
             FROM leaves JOIN b3 USING (domain, lang, source)),
    keyed AS (SELECT docs.*, full_epochs, rest,
                     md5('mix:' || full_epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(body)) AS place
              FROM docs JOIN plan USING (domain, lang, source)),
    summed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place RANGE UNBOUNDED PRECEDING) AS to_here
               FROM keyed)
    SELECT doc_id, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens,
           CAST(full_epochs + CASE WHEN full_epochs < 2 AND to_here <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies
    FROM summed WHERE full_epochs + CASE WHEN full_epochs < 2 AND to_here <= rest THEN 1 ELSE 0 END > 0
"""


@query()
def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document, by what the documents with another remainder than 2 teach."""
    from varve.llm import lm
    from varve.llm.common import text_of

    docs = table(spark, sf_dir, "documents")
    return lm.score(docs, ["doc_id"], remainder("doc_id", 7) != 2, text_of())


@query()
def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels are learned from those whose remainder is not 0."""
    from varve.llm import crf

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = crf.learn(docs, labels.where(remainder("doc_id", 5) != 0))
    scored = crf.score(docs.withColumn("held_out", remainder("doc_id", 5) == 0), ["doc_id", "held_out"], model)
    return scored.select("doc_id", "held_out", "score", "predicted")


@query()
def op10_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of each whose id is divisible by 100."""
    from varve.llm.ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query(MIX_SQL)
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine tenths of all tokens, dealt to domains, languages and sources by weight, two epochs at most."""
    from varve.llm.mixing import MIX_SHARE, MIX_WEIGHTS, domain_of, mix

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    mixed = mix(docs, MIX_SHARE, MIX_WEIGHTS, domain=domain_of(), out=("n_tokens", "copies"))
    return mixed.select(
        "doc_id",
        domain_of().alias("domain"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
        "n_tokens",
        "copies",
    )


@query()
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes they decode to, as digests."""
    from varve.llm.bpe import encode_digests, read_ranks

    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return encode_digests(table(spark, sf_dir, "documents"), ["doc_id"], ranks, public_tokenizers.PATTERN)


@query()
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    from varve.llm.tokens import count_tokens, read_merges

    merges = read_merges(public_tokenizers.path("byte_bpe_50k.json"))
    return count_tokens(table(spark, sf_dir, "documents"), ["doc_id"], merges)


@query()
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    from varve.llm.jaccard import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op8_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the strings of 400 bytes that are found elsewhere too."""
    from varve.llm.repeats import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdict of every document."""
    from varve.llm.rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"), ["doc_id"])


@query(CODES_SQL)
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code of every vector by codebooks learned from all of them."""
    from varve.llm.lloyd import compress

    coded, books = compress(table(spark, sf_dir, "embeddings"))
    return coded.withColumn("codebooks_sha256", F.sha2(F.lit(books.text()), 256))


@query(CLUSTERS_SQL)
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector and what is known of it."""
    from varve.llm.centroids import cluster

    return cluster(table(spark, sf_dir, "embeddings"))[0]


@query()
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and digest of every document's ids in the token files."""
    from varve.llm.token_files import TokenFiles, id_digests, write_tokens

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        spec = file.read()
    path = fresh_dir(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, spec, end=2)
    return id_digests(TokenFiles(spark, path).tokens())
