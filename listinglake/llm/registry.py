"""The registered queries of this folder, with their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from listinglake.llm import (
    decontaminate, embedding_dedup, license_scan, ngram_join, piece_codec, shard_packing,
    spelling_variants, substring_dedup, token_counts, token_files, toxicity, url_rules,
    whitening,
)
from listinglake.llm.common import Query


def queries() -> dict[str, Query]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_token_counts": token_counts.op1_token_counts,
        "op2_embedding_dedup": embedding_dedup.op2_embedding_dedup,
        "op3_url_filters": url_rules.op3_url_filters,
        "op4_toxicity": toxicity.op4_toxicity,
        "op5_sentencepiece": piece_codec.op5_sentencepiece,
        "op6_substring_dedup": substring_dedup.op6_substring_dedup,
        "op7_decontamination": decontaminate.op7_decontamination,
        "op8_sharding": shard_packing.op8_sharding,
        "op9_ngram_jaccard_join": ngram_join.op9_ngram_jaccard_join,
        "op10_license_scan": license_scan.op10_license_scan,
        "op11_whitening": whitening.op11_whitening,
        "op12_token_files": token_files.op12_token_files,
        "op13_spelling_variants": spelling_variants.op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    sql = {
        "op3_url_filters": url_rules.OP3_SQL,
        "op7_decontamination": decontaminate.OP7_SQL,
        "op10_license_scan": license_scan.OP10_SQL,
    }
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
