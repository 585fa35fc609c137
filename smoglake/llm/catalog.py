"""Queries of the operators, each over its whole table, and SQL where it can express them."""

from __future__ import annotations

from .alignment import op13_token_alignment
from .class_lm import op5_class_lm
from .compression import op12_quality_classifier
from .embedding_dedup import OP10_SQL, op10_embedding_dedup
from .language import op9_language_id
from .licenses import op8_license_scan
from .mixing import OP3_SQL, op3_source_mix
from .near_dedup import OP6_SQL, op6_near_dedup
from .packing import op4_packing
from .periodicity import OP11_SQL, op11_periodic_runs
from .quality import op7_quality_rules
from .secrets import op2_secret_scan
from .toxicity import op1_toxicity

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_secret_scan": op2_secret_scan,
    "op3_source_mix": op3_source_mix,
    "op4_packing": op4_packing,
    "op5_class_lm": op5_class_lm,
    "op6_near_dedup": op6_near_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_license_scan": op8_license_scan,
    "op9_language_id": op9_language_id,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_token_alignment": op13_token_alignment,
}

SQL: dict[str, str] = {"op3_source_mix": OP3_SQL, "op6_near_dedup": OP6_SQL, "op10_embedding_dedup": OP10_SQL,
                       "op11_periodic_runs": OP11_SQL}
