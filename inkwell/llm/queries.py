"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from inkwell.llm.bpe import op1_bpe
from inkwell.llm.chat import OP3_SQL, op3_chat_format
from inkwell.llm.hnsw import op2_nearest
from inkwell.llm.langid import op6_langid
from inkwell.llm.license_scan import op8_licenses
from inkwell.llm.line_dedup import OP12_SQL, op12_line_dedup
from inkwell.llm.mixing import OP10_SQL, op10_mix_sources
from inkwell.llm.periodic_runs import op13_periodic_runs
from inkwell.llm.pii import op9_pii
from inkwell.llm.quality import op5_quality
from inkwell.llm.simhash import op4_simhash
from inkwell.llm.toxicity import op7_toxicity
from inkwell.llm.whitening import op11_whitening

QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_nearest": op2_nearest,
    "op3_chat_format": op3_chat_format,
    "op4_simhash": op4_simhash,
    "op5_quality": op5_quality,
    "op6_langid": op6_langid,
    "op7_toxicity": op7_toxicity,
    "op8_licenses": op8_licenses,
    "op9_pii": op9_pii,
    "op10_mix_sources": op10_mix_sources,
    "op11_whitening": op11_whitening,
    "op12_line_dedup": op12_line_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLES = {"op3_chat_format": OP3_SQL, "op10_mix_sources": OP10_SQL, "op12_line_dedup": OP12_SQL}
