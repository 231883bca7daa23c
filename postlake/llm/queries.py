"""Queries of the numbered operators over their whole tables. Those without SQL are tested against brute force."""

from __future__ import annotations

from postlake.llm.decontaminate import op1_decontaminate
from postlake.llm.fm_quality import op2_quality_classifier
from postlake.llm.hard_negatives import op12_hard_negatives
from postlake.llm.importance import op11_importance_resampling
from postlake.llm.license_scan import op7_license_scan
from postlake.llm.main_text import op6_main_text
from postlake.llm.mixing import op9_mix_sources
from postlake.llm.near_dedup import op4_near_dedup
from postlake.llm.oracles import DECONTAMINATE, HARD_NEGATIVES, NEAR_DEDUP, RESAMPLING, TOP_K, WARC
from postlake.llm.pii import op3_pii
from postlake.llm.quality_rules import op5_quality_rules
from postlake.llm.token_counts import op8_token_counts
from postlake.llm.topk_search import op13_topk_search
from postlake.llm.warc import op10_warc

QUERIES = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_quality_classifier,
        op3_pii,
        op4_near_dedup,
        op5_quality_rules,
        op6_main_text,
        op7_license_scan,
        op8_token_counts,
        op9_mix_sources,
        op10_warc,
        op11_importance_resampling,
        op12_hard_negatives,
        op13_topk_search,
    )
}
ORACLES: dict[str, str] = {
    "op1_decontaminate": DECONTAMINATE,
    "op4_near_dedup": NEAR_DEDUP,
    "op10_warc": WARC,
    "op11_importance_resampling": RESAMPLING,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_topk_search": TOP_K,
}
