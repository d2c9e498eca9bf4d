"""Queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from loomstat.llm import decontaminate, hard_negatives, relative_lz
from loomstat.llm.bpe_stream import op4_bpe_round_trip
from loomstat.llm.context_tree import op8_context_tree_weighting
from loomstat.llm.decontaminate import op6_fm_index_decontamination
from loomstat.llm.hard_negatives import op13_l2ap_hard_negatives
from loomstat.llm.html_text import op1_line_block_extraction
from loomstat.llm.jaccard_join import op10_ngram_jaccard_join
from loomstat.llm.language_id import op2_byte_bigru_language
from loomstat.llm.pii import op3_pii_boosted_candidates
from loomstat.llm.quality import op9_kneser_ney_bands
from loomstat.llm.relative_lz import op11_relative_lz_dedup
from loomstat.llm.spelling import op12_partenum_spelling
from loomstat.llm.suffix_dedup import op7_difference_cover_dedup
from loomstat.llm.token_output import op5_token_output


def pipeline(spark, sf_dir):
    """All stages of the corpus pipeline over ``documents``."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_line_block_extraction,
    op2_byte_bigru_language,
    op3_pii_boosted_candidates,
    op4_bpe_round_trip,
    op5_token_output,
    op6_fm_index_decontamination,
    op7_difference_cover_dedup,
    op8_context_tree_weighting,
    op9_kneser_ney_bands,
    op10_ngram_jaccard_join,
    op11_relative_lz_dedup,
    op12_partenum_spelling,
    op13_l2ap_hard_negatives,
    pipeline,
)}
ORACLE: dict[str, str] = {
    "op6_fm_index_decontamination": decontaminate.ORACLE,
    "op11_relative_lz_dedup": relative_lz.ORACLE,
    "op13_l2ap_hard_negatives": hard_negatives.ORACLE,
}
