"""One query per operator, over its whole table, with its SQL where there is one."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bfd_packing, fill_in_middle, html_text, mixing, near_dup, oracle, projected_nn, quality_rules, secret_lexer,
               ss_packing, token_alignment, token_counts, warc_zip, weak_classifier)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op4_minhash_near_dup": oracle.NEAR, "op7_zip_warc": oracle.WARC, "op9_source_mixing": oracle.MIX,
                           "op12_fill_in_middle": oracle.FIM}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@_query
def op10_quality_rules(spark, sf):
    return quality_rules.judge(_table(spark, sf, "documents")).drop("row_key")


@_query
def op9_source_mixing(spark, sf):
    return mixing.mix(_table(spark, sf, "documents"))


@_query
def op8_sum_of_squares_packing(spark, sf):
    return ss_packing.pack(_table(spark, sf, "documents"))


@_query
def op1_quality_classifier(spark, sf):
    return weak_classifier.classify(_table(spark, sf, "documents")).drop("row_key")


@_query
def op4_minhash_near_dup(spark, sf):
    return near_dup.clusters(_table(spark, sf, "documents"))


@_query
def op5_projected_neighbours(spark, sf):
    return projected_nn.nearest(_table(spark, sf, "embeddings"))


@_query
def op7_zip_warc(spark, sf):
    return warc_zip.round_trip(spark, _table(spark, sf, "pages"))


@_query
def op2_bfd_packing(spark, sf):
    return bfd_packing.round_trip(spark, _table(spark, sf, "documents"))


@_query
def op6_section_tokens(spark, sf):
    return token_counts.count(_table(spark, sf, "documents"))


@_query
def op3_html_layout(spark, sf):
    return html_text.extract(_table(spark, sf, "pages"))


@_query
def op11_secret_lexer(spark, sf):
    return secret_lexer.digests(_table(spark, sf, "documents"))


@_query
def op12_fill_in_middle(spark, sf):
    return fill_in_middle.digests(_table(spark, sf, "documents"))


@_query
def op13_token_alignment(spark, sf):
    return token_alignment.digests(_table(spark, sf, "documents"))
