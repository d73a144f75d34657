"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from cohortmill.llm.byte_bpe import op12_byte_bpe
from cohortmill.llm.conversations import op13_conversation_repair
from cohortmill.llm.decontamination import DECONTAMINATION_SQL, op5_decontamination
from cohortmill.llm.fingerprints import op9_fingerprints
from cohortmill.llm.languages import op3_languages
from cohortmill.llm.line_dedup import LINE_DEDUP_SQL, op10_line_dedup
from cohortmill.llm.near_dups import NEAR_DUPS_SQL, op2_near_dups
from cohortmill.llm.period_runs import op11_period_runs
from cohortmill.llm.pieces import op8_sentencepiece
from cohortmill.llm.secrets import op6_secrets
from cohortmill.llm.sharding import op7_sharding
from cohortmill.llm.url_filters import op4_url_filters
from cohortmill.llm.warc import WARC_SQL, op1_warc

LLM_QUERIES = {
    "op1_warc": op1_warc,
    "op2_near_dups": op2_near_dups,
    "op3_languages": op3_languages,
    "op4_url_filters": op4_url_filters,
    "op5_decontamination": op5_decontamination,
    "op6_secrets": op6_secrets,
    "op7_sharding": op7_sharding,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_fingerprints": op9_fingerprints,
    "op10_line_dedup": op10_line_dedup,
    "op11_period_runs": op11_period_runs,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_conversation_repair": op13_conversation_repair,
}

LLM_ORACLES = {
    "op1_warc": WARC_SQL,
    "op2_near_dups": NEAR_DUPS_SQL,
    "op5_decontamination": DECONTAMINATION_SQL,
    "op10_line_dedup": LINE_DEDUP_SQL,
}
