"""From raw documents to token ids: a pipeline of five stages.

Each stage takes the documents that the one before kept and returns documents again (same
columns); the last one returns their ids.  Stages are written to the shared scratch folder
and read back, so a lost executor repeats at most one of them.

1. ``language``: documents without a letter go, and no others: one whose n-grams no language
   holds stays (score 0).
2. ``near_duplicates``: of each group of linked documents the one with the smallest id stays.
3. ``secrets``: found secrets are replaced in the texts; every document stays.
4. ``mix_sources``: each document as often as its source's rate says.
5. ``byte_bpe``: the ids of every text, checked by decoding them.

Defined cases: null and empty texts have no letter and go in the first stage; texts of any
length are read whole; rows that repeat are copies, of which one stays; of linked documents the
smallest doc_id stays, and of rows that share it the smallest text; extra columns are carried
along whatever their names, up to the last stage; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import bpe, langid, mixing, ngram_join, secrets
from ledgerspark.llm.common import keep, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with a letter; learned from the documents themselves."""
    return langid.with_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies; rows without an id or words all stay."""
    return ngram_join.representatives(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets replaced; ``n_chars`` follows where there is one."""
    clean = secrets.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate and its draw say; a null source is a source."""
    return mixing.mixture(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids, and whether the ids decode to the text."""
    return bpe.token_ids(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secrets", redact_secrets),
          ("mix_sources", mix_sources), ("byte_bpe", encode)]

#: Language identification is learned, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
