"""The registered queries of this subpackage, and their SQL."""

from newszones.llm.decontaminate import op10_decontaminate
from newszones.llm.exact_dedup import OP9_SQL, op9_exact_dedup
from newszones.llm.fertility import op12_quality_rules
from newszones.llm.grades import op4_quality
from newszones.llm.html_text import op6_html_text
from newszones.llm.jaccard import op7_jaccard_join
from newszones.llm.manifest import OP11_SQL, op11_merkle_manifest
from newszones.llm.mixing import OP2_SQL, op2_mix_sources
from newszones.llm.secrets import op1_secret_scan
from newszones.llm.source_audit import OP13_SQL, op13_source_audit
from newszones.llm.suffix_dedup import op5_suffix_dedup
from newszones.llm.token_counts import op8_token_counts
from newszones.llm.token_files import op3_token_files

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_mix_sources": op2_mix_sources,
    "op3_token_files": op3_token_files,
    "op4_quality": op4_quality,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_html_text": op6_html_text,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_token_counts": op8_token_counts,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_quality_rules": op12_quality_rules,
    "op13_source_audit": op13_source_audit,
}
ORACLE = {"op2_mix_sources": OP2_SQL, "op9_exact_dedup": OP9_SQL, "op11_merkle_manifest": OP11_SQL, "op13_source_audit": OP13_SQL}
