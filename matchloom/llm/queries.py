"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from .bpe_transducer import op10_bpe_transducer
from .exact_topk import OP2_SQL, op2_exact_topk
from .license_scan import op9_license_scan
from .line_templates import op7_line_templates
from .minhash_dedup import op5_minhash_dedup
from .quality_rules import op8_quality_rules
from .source_mix import OP6_SQL, op6_source_mix
from .suffix_tree_lm import op3_suffix_tree_lm
from .url_filter import OP1_SQL, op1_url_filter
from .warc_fixity import OP4_SQL, op4_warc_fixity

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_exact_topk": op2_exact_topk,
    "op3_suffix_tree_lm": op3_suffix_tree_lm,
    "op4_warc_fixity": op4_warc_fixity,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_source_mix": op6_source_mix,
    "op7_line_templates": op7_line_templates,
    "op8_quality_rules": op8_quality_rules,
    "op9_license_scan": op9_license_scan,
    "op10_bpe_transducer": op10_bpe_transducer,
}

ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": OP1_SQL,
    "op2_exact_topk": OP2_SQL,
    "op4_warc_fixity": OP4_SQL,
    "op6_source_mix": OP6_SQL,
}
