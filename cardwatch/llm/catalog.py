"""Queries of the subpackage and, where SQL can say it, the same as DuckDB SQL."""
from __future__ import annotations

from cardwatch.llm import (
    conversations, decontaminate, hardneg, jaccard, langid, linededup, permindex, pieces, sourcemix, suffixdedup, toxicity,
    urlfilter, warc,
)

CATALOG = {
    "op1_sentencepiece": pieces.op1_sentencepiece,
    "op2_permutation_index": permindex.op2_permutation_index,
    "op3_line_dedup": linededup.op3_line_dedup,
    "op4_fm_decontaminate": decontaminate.op4_fm_decontaminate,
    "op5_language_codes": langid.op5_language_codes,
    "op6_jaccard_join": jaccard.op6_jaccard_join,
    "op7_warc_zip": warc.op7_warc_zip,
    "op8_url_filter": urlfilter.op8_url_filter,
    "op9_suffix_dedup": suffixdedup.op9_suffix_dedup,
    "op10_toxicity_pu": toxicity.op10_toxicity_pu,
    "op11_conversation_repair": conversations.op11_conversation_repair,
    "op12_hard_negatives": hardneg.op12_hard_negatives,
    "op13_source_mix": sourcemix.op13_source_mix,
}

SQL = {
    "op3_line_dedup": linededup.SQL,
    "op4_fm_decontaminate": decontaminate.SQL,
    "op7_warc_zip": warc.SQL,
    "op8_url_filter": urlfilter.SQL,
    "op9_suffix_dedup": suffixdedup.SQL,
    "op11_conversation_repair": conversations.SQL,
    "op12_hard_negatives": hardneg.SQL,
    "op13_source_mix": sourcemix.SQL,
}
