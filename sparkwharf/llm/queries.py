"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from sparkwharf.llm import collocations, decontaminate, divergence, line_dedup, maxent, sharding, simhash, token_store, topk, toxicity, unigram, warc

QUERIES = {
    "op1_token_counts": unigram.op1_token_counts,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_warc_derivatives": warc.op3_warc_derivatives,
    "op4_benchmark_decontamination": decontaminate.op4_benchmark_decontamination,
    "op5_token_binary": token_store.op5_token_binary,
    "op6_lm_scoring": maxent.op6_lm_scoring,
    "op7_exact_topk": topk.op7_exact_topk,
    "op8_sentencepiece": unigram.op8_sentencepiece,
    "op9_simhash_near_dedup": simhash.op9_simhash_near_dedup,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_source_divergence": divergence.op11_source_divergence,
    "op12_sharding": sharding.op12_sharding,
    "op13_collocations": collocations.op13_collocations,
}

SQL = {"op7_exact_topk": topk.OP7_SQL, "op10_line_dedup": line_dedup.OP10_SQL, "op11_source_divergence": divergence.OP11_SQL, "op12_sharding": sharding.OP12_SQL, "op13_collocations": collocations.OP13_SQL}
