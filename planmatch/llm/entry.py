"""What __spark_entry__.py registers: one query per operator, and the corpus pipeline."""

from __future__ import annotations

from planmatch.llm import (
    ball_tree,
    context_tree,
    conversation_trie,
    decontaminate,
    hyper_language,
    sentencepieces,
    simhash_tiles,
    suffix_dedup,
    toxicity,
    topk_blocks,
    vector_packing,
    warc,
    wavelet,
)


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_wavelet_tokens": wavelet.query,
    "op2_decontaminate": decontaminate.query,
    "op3_sentencepiece": sentencepieces.query,
    "op4_warc": warc.query,
    "op5_toxicity": toxicity.query,
    "op6_simhash": simhash_tiles.query,
    "op7_context_tree": context_tree.query,
    "op8_language": hyper_language.query,
    "op9_suffix_dedup": suffix_dedup.query,
    "op10_topk": topk_blocks.query,
    "op11_ball_tree": ball_tree.query,
    "op12_conversation_trie": conversation_trie.query,
    "op13_vector_packing": vector_packing.query,
    "pipeline": pipeline,
}
