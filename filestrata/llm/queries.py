"""The registered queries of these operators, with SQL where SQL can say them."""

from __future__ import annotations

from .bpe import op6_bpe
from .conversation_repair import OP12_SQL, op12_conversation_repair
from .exact_dedup import OP3_SQL, op3_exact_dedup
from .filter_audit import OP13_SQL, op13_filter_audit
from .html_extraction import op4_html_extraction
from .line_dedup import op9_line_dedup
from .mixing import OP10_SQL, op10_mixing
from .near_dup import op2_near_dedup
from .pii import op7_pii
from .quality import op11_quality
from .suffix_dedup import op1_suffix_dedup
from .toxicity import op5_toxicity
from .vector_search import OP8_SQL, op8_vector_search

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_near_dedup": op2_near_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_html_extraction": op4_html_extraction,
    "op5_toxicity": op5_toxicity,
    "op6_bpe": op6_bpe,
    "op7_pii": op7_pii,
    "op8_vector_search": op8_vector_search,
    "op9_line_dedup": op9_line_dedup,
    "op10_mixing": op10_mixing,
    "op11_quality": op11_quality,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_filter_audit": op13_filter_audit,
}
ORACLES = {"op3_exact_dedup": OP3_SQL, "op8_vector_search": OP8_SQL, "op10_mixing": OP10_SQL,
           "op12_conversation_repair": OP12_SQL, "op13_filter_audit": OP13_SQL}
