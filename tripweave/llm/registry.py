"""The registered queries of this subpackage and their check SQL, where SQL can express them."""

from __future__ import annotations

from tripweave.llm.audit import OP12_SQL, op12_filter_audit
from tripweave.llm.decontaminate import op4_decontamination
from tripweave.llm.html import op2_html_extraction
from tripweave.llm.jaccard import op9_jaccard_join
from tripweave.llm.language import op10_language_id
from tripweave.llm.licenses import op8_license_scan
from tripweave.llm.mixture import op6_mixture
from tripweave.llm.nearest import OP5_SQL, op5_nearest
from tripweave.llm.packing import op11_packing
from tripweave.llm.quality import op7_quality
from tripweave.llm.spelling import OP13_SQL, op13_spelling_variants
from tripweave.llm.toxicity import op1_toxicity
from tripweave.llm.urls import OP3_SQL, op3_url_filter

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_html_extraction": op2_html_extraction,
    "op3_url_filter": op3_url_filter,
    "op4_decontamination": op4_decontamination,
    "op5_nearest": op5_nearest,
    "op6_mixture": op6_mixture,
    "op7_quality": op7_quality,
    "op8_license_scan": op8_license_scan,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_language_id": op10_language_id,
    "op11_packing": op11_packing,
    "op12_filter_audit": op12_filter_audit,
    "op13_spelling_variants": op13_spelling_variants,
}

CHECKS = {
    "op3_url_filter": OP3_SQL,
    "op5_nearest": OP5_SQL,
    "op12_filter_audit": OP12_SQL,
    "op13_spelling_variants": OP13_SQL,
}
