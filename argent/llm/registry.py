"""The queries of this package and their DuckDB SQL."""

from __future__ import annotations

from argent.llm.bpe import op2_bpe
from argent.llm.brown_lm import op10_brown_lm
from argent.llm.decontaminate import ORACLE_OP1, op1_decontaminate
from argent.llm.exact_dedup import ORACLE_OP8, op8_exact_dedup
from argent.llm.importance import op11_importance
from argent.llm.jaccard_join import op6_jaccard_join
from argent.llm.line_dedup import ORACLE_OP5, op5_line_dedup
from argent.llm.packing import op12_packing
from argent.llm.pii import op3_pii
from argent.llm.suffix_dedup import op9_suffix_dedup
from argent.llm.toxicity import op7_toxicity
from argent.llm.url_filter import ORACLE_OP4, op4_url_filter
from argent.llm.whitening import op13_whitening

QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_bpe": op2_bpe,
    "op3_pii": op3_pii,
    "op4_url_filter": op4_url_filter,
    "op5_line_dedup": op5_line_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_toxicity": op7_toxicity,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_brown_lm": op10_brown_lm,
    "op11_importance": op11_importance,
    "op12_packing": op12_packing,
    "op13_whitening": op13_whitening,
}

ORACLES = {
    "op1_decontaminate": ORACLE_OP1,
    "op4_url_filter": ORACLE_OP4,
    "op5_line_dedup": ORACLE_OP5,
    "op8_exact_dedup": ORACLE_OP8,
}
