"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

import corpus_pipeline
from wardline.llm import (
    class_lm,
    decontaminate,
    exact_dedup,
    language,
    merkle,
    ngram_join,
    personal,
    piece_bpe,
    records,
    repeats,
    sql,
    token_alignment,
    toxicity,
    vector_graph,
)

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_token_records": records.op2_token_records,
    "op3_suffix_dedup": repeats.op3_suffix_dedup,
    "op4_ngram_join": ngram_join.op4_ngram_join,
    "op5_sentencepiece": piece_bpe.op5_sentencepiece,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_personal_data": personal.op8_personal_data,
    "op9_language": language.op9_language,
    "op10_class_lm": class_lm.op10_class_lm,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_token_alignment": token_alignment.op12_token_alignment,
    "op13_vector_graph": vector_graph.op13_vector_graph,
    "pipeline": corpus_pipeline.run,
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    own = {
        "op3_suffix_dedup": sql.SUFFIX_DEDUP,
        "op4_ngram_join": sql.NGRAM_JOIN,
        "op7_exact_dedup": exact_dedup.OP7_SQL,
        "op11_merkle_manifest": merkle.OP11_SQL,
    }
    return own | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
