"""From raw documents to encoded training text.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept. The
driver writes each result as Parquet and reads it again as the next stage's documents;
``run`` does the same in the shared folder.

Defined cases, for all stages: an empty table gives an empty one; all but the last return the
columns of their documents, whatever else these hold and whatever the names; repeated rows are
documents of their own; a very long text is read whole by one task. The rest is said at each stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kerbstream.llm import bpe, language, mixing, quality, queries, simhash
from kerbstream.llm.common import prepare, table
from kerbstream.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language go. Those of two languages stay, also where op7 flags them. Null
    and empty texts, and those without a letter, are in no language; so is every text if no
    labelled document can be learned from. Null ids and languages teach nothing. A tie goes to the
    first language by name."""
    prepare(spark)
    return language.in_a_language(docs)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules or lie outside their group's estimate go. Null and empty texts
    fail; null languages and sources are values like any other; ties are judged alike."""
    prepare(spark)
    return quality.kept_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id. Null ids
    come last, and of rows that tie one stays; texts without words are alike. Shingle length and bit
    distance are the operator's own."""
    prepare(spark)
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, which may be never. Null and empty texts have
    size 0; null sources are a source, the last one; of rows that tie any may be taken once more."""
    prepare(spark)
    return mixing.repeated(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: token counts and digests of ids and of the decoded bytes. Null and empty
    texts have no tokens; of other columns only the id is read, which may be null."""
    prepare(spark)
    return bpe.encoding_digests(
        docs, public_tokenizers.path(queries.CODEC_RANKS), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("quality", apply_quality_rules),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# Fitting a classifier and choosing copies are not expressible in SQL; see tests/llm.
ORACLE_SQL: str | None = None
