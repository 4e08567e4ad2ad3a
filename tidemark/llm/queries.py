"""Queries of the text problems."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, mixing, stuffing
from tidemark.runtime import materialise
from tidemark.sources.tables import table


def vocabulary_files() -> tuple[str, str]:
    """(path, pattern) of byte_bpe_50k as the installed collection of public vocabularies gives them."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    path, pattern = vocabulary_files()
    return bpe.encode_corpus(table(spark, sf, "documents"), key="doc_id", text="text", path=path, pattern=pattern)


def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    path, pattern = vocabulary_files()
    return materialise(bpe.count_tokens(table(spark, sf, "documents"), keys=["doc_id", "source"], text="text", path=path, pattern=pattern), "token-counts")


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(token_counts(spark, sf), table(spark, sf, "mix_targets"), key="doc_id", source="source")


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    counted, targets = token_counts(spark, sf), table(spark, sf, "mix_targets")
    return mixing.report(mixing.mix(counted, targets, key="doc_id", source="source"), counted, targets, "source")


def p9_exact(spark: SparkSession, sf: str) -> DataFrame:
    """The largest mix in which the sources that have documents stand exactly in proportion to their targets: smaller than the corpus where a source is scarce."""
    counted, targets = token_counts(spark, sf), table(spark, sf, "mix_targets")
    return mixing.report(mixing.mix(counted, targets, key="doc_id", source="source", fill=False), counted, targets, "source")


def p10_measures(spark: SparkSession, sf: str) -> DataFrame:
    """What each document was judged by."""
    return stuffing.judged(table(spark, sf, "documents"), key="doc_id", text="text", lang="lang")


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return stuffing.judged(table(spark, sf, "documents"), key="doc_id", text="text", lang="lang").filter("stuffed").select("doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p8_ids, p9_mix, p9_shares, p9_exact, p10_found, p10_measures)}

#: None of these can be put in SQL.
ORACLES: dict[str, str] = {}
