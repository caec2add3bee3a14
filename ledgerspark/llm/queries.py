"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from ledgerspark.llm import (
    ann, bpe, langid, lm, mixing, near_vectors, ngram_join, pfor, quality, rules, search, secrets, trie)
from ledgerspark.llm.common import table


def op1_multi_index_search(spark, d):
    return ann.searched(table(spark, d, "embeddings"))


def op2_byte_bpe(spark, d):
    return bpe.digests(table(spark, d, "documents"))


def op3_token_blocks(spark, d):
    return pfor.written_and_read(table(spark, d, "documents").select("doc_id", "text"), as_text=False)


def op4_secret_scan(spark, d):
    return secrets.report(table(spark, d, "documents"))


def op5_ngram_join(spark, d):
    return ngram_join.components(table(spark, d, "documents").select("doc_id", "text"))


def op6_cap_filters(spark, d):
    return near_vectors.near_duplicates(table(spark, d, "embeddings"))


def op7_line_quality(spark, d):
    return quality.predicted(table(spark, d, "documents"), table(spark, d, "labels"))


def op8_language(spark, d):
    return langid.predicted(table(spark, d, "documents"))


def op9_skip_maxent(spark, d):
    return lm.scored(table(spark, d, "documents"))


def op10_mix_sources(spark, d):
    return mixing.taken(table(spark, d, "documents").select("doc_id", "source", "text"))


def op11_quality_rules(spark, d):
    return rules.judged(table(spark, d, "documents"))


def op12_prefix_trie(spark, d):
    return trie.nodes(table(spark, d, "conversations"))


def op13_ranked_search(spark, d):
    return search.searched(table(spark, d, "documents"), table(spark, d, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_multi_index_search, op2_byte_bpe, op3_token_blocks, op4_secret_scan, op5_ngram_join,
    op6_cap_filters, op7_line_quality, op8_language, op9_skip_maxent, op10_mix_sources,
    op11_quality_rules, op12_prefix_trie, op13_ranked_search)}
ORACLES = {"op10_mix_sources": mixing.ORACLE_SQL, "op11_quality_rules": rules.ORACLE_SQL,
           "op12_prefix_trie": trie.ORACLE_SQL, "op13_ranked_search": search.ORACLE_SQL}
