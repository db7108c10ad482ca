"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from tracewright.llm.html_text import op7_html
from tracewright.llm.langid import op4_language
from tracewright.llm.lm_score import op3_lm_score
from tracewright.llm.media import op6_media
from tracewright.llm.mixing import OP1_SQL, op1_mixing
from tracewright.llm.pieces import op9_pieces
from tracewright.llm.quality import op8_quality
from tracewright.llm.secrets import op5_secrets
from tracewright.llm.simhash import op2_simhash
from tracewright.llm.topk import OP10_SQL, op10_topk

_ALL = (op1_mixing, op2_simhash, op3_lm_score, op4_language, op5_secrets, op6_media, op7_html, op8_quality, op9_pieces, op10_topk)
QUERIES = {f.__name__: f for f in _ALL}
SQL = {"op1_mixing": OP1_SQL, "op10_topk": OP10_SQL}
