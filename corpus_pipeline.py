"""Documents to training sequences: toxicity, exact and near duplicates, secrets, packing.

Each stage reads what the one before it kept, as Parquet. All but the last return the columns of
documents; the last returns the pieces of the packed sequences with their ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgermap.llm import toxicity
from ledgermap.llm.common import drop_stored, read, ship, stored
from ledgermap.llm.exact_dedup import drop_exact_duplicates
from ledgermap.llm.near_dedup import drop_near_duplicates
from ledgermap.llm.packing import pack
from ledgermap.llm.queries import BYTE_BPE
from ledgermap.llm.secret_scan import redact


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; all others stay. Learns from the labels of ``sf_dir``."""
    ship(spark)
    return toxicity.keep_clean(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space the longest stays, then the one with the smallest id."""
    ship(spark)
    return drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similarity the one with the smallest id stays."""
    ship(spark)
    return drop_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in them are replaced, and ``n_chars`` follows."""
    ship(spark)
    return redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 1024 ids."""
    ship(spark)
    return pack(docs, BYTE_BPE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: SQL cannot express the stages; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
            if before is not None:
                drop_stored(before)
            before = docs
    return docs
