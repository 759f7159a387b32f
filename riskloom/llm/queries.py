"""The registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from riskloom.llm.divergence import OP13_SQL, op13_source_divergence
from riskloom.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from riskloom.llm.jaccard_join import OP9_SQL, op9_jaccard_join
from riskloom.llm.langid import op8_language_id
from riskloom.llm.license_scan import op1_license_scan
from riskloom.llm.lm_scoring import op5_lm_scoring
from riskloom.llm.mixing import op3_mixing
from riskloom.llm.norm_topk import OP4_SQL, op4_norm_topk
from riskloom.llm.packing import op10_packing
from riskloom.llm.quality_classifier import op6_quality_classifier
from riskloom.llm.quality_rules import op7_quality_rules
from riskloom.llm.token_files import op12_token_files
from riskloom.llm.toxicity import op2_toxicity

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_toxicity": op2_toxicity,
    "op3_mixing": op3_mixing,
    "op4_norm_topk": op4_norm_topk,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_quality_rules": op7_quality_rules,
    "op8_language_id": op8_language_id,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_packing": op10_packing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_token_files": op12_token_files,
    "op13_source_divergence": op13_source_divergence,
}

SQL: dict[str, str] = {
    "op4_norm_topk": OP4_SQL,
    "op9_jaccard_join": OP9_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op13_source_divergence": OP13_SQL,
}
