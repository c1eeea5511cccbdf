"""Registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgermap.llm import clustering, merkle, personal_data, toxicity, url_filter
from ledgermap.llm.bpe_automaton import round_trip
from ledgermap.llm.clustering import cluster
from ledgermap.llm.common import read
from ledgermap.llm.exact_dedup import exact_duplicates
from ledgermap.llm.language import identify, train
from ledgermap.llm.near_dedup import near_duplicates
from ledgermap.llm.packing import pack
from ledgermap.llm.secret_scan import digests, scan
from ledgermap.llm.token_counts import token_counts
from ledgermap.llm.topk import top_k

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"), WORD_BPE)


@query
def op7_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read(spark, sf_dir, "documents"), WORD_BPE)


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), BYTE_BPE, digest=True)


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read(spark, sf_dir, "documents"))


ORACLE["op8_exact_dedup"] = r"""
WITH texts AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
        regexp_replace(coalesce(text, ''), '[ \t-\r]', '', 'g') AS plain
    FROM documents
)
SELECT doc_id,
    first_value(doc_id) OVER best AS keep_id,
    count(*) OVER (PARTITION BY plain) AS group_size,
    doc_id = first_value(doc_id) OVER best AS kept,
    sha256(plain) AS text_sha256
FROM texts
WINDOW best AS (PARTITION BY plain ORDER BY points DESC, doc_id)
"""


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(scan(read(spark, sf_dir, "documents")))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return identify(docs, train(docs))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages")).drop("score")


ORACLE["op1_url_filter"] = url_filter.expected_sql()


@query
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the rows whose id is divisible by 50."""
    vectors = read(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"))


ORACLE["op9_top_k"] = """
WITH vectors AS (
    SELECT row_number() OVER () AS row, vec_id, [floor(256 * v::DOUBLE)::BIGINT for v in embedding] AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND len([v for v in embedding if v IS NULL OR NOT isfinite(v)]) = 0
), scores AS (
    SELECT q.row, q.vec_id AS query_id, c.vec_id, list_dot_product(q.x::DOUBLE[], c.x::DOUBLE[])::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


@query
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(read(spark, sf_dir, "embeddings"))


ORACLE["op11_centroid_clustering"] = clustering.expected_sql()


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(read(spark, sf_dir, "documents"))


ORACLE["op12_merkle_manifest"] = merkle.expected_sql()


@query
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digests(personal_data.personal_data(read(spark, sf_dir, "documents")))
