"""The queries of this package and the SQL that checks those SQL can express."""

from __future__ import annotations

from beaconlake.llm.centroids import SQL as CLUSTER_SQL
from beaconlake.llm.centroids import op13_subvectors
from beaconlake.llm.decontaminate import op3_block_max
from beaconlake.llm.filter_audit import SQL as AUDIT_SQL
from beaconlake.llm.filter_audit import op12_counting_bloom
from beaconlake.llm.html_text import op6_page_differences
from beaconlake.llm.langid import op5_output_codes
from beaconlake.llm.mixing import op4_soft_membership
from beaconlake.llm.quality import op1_attention
from beaconlake.llm.simhash import op9_simhash
from beaconlake.llm.substrings import op10_substrings
from beaconlake.llm.suffix_tree import op11_suffix_tree
from beaconlake.llm.token_rollup import SQL as ROLLUP_SQL
from beaconlake.llm.token_rollup import op7_delta_rollup
from beaconlake.llm.warc import op2_normaliser
from beaconlake.llm.weighted_minhash import op8_weighted_sampling

QUERIES = {
    "op1_attention": op1_attention,
    "op2_normaliser": op2_normaliser,
    "op3_block_max": op3_block_max,
    "op4_soft_membership": op4_soft_membership,
    "op5_output_codes": op5_output_codes,
    "op6_page_differences": op6_page_differences,
    "op8_weighted_sampling": op8_weighted_sampling,
    "op7_delta_rollup": op7_delta_rollup,
    "op9_simhash": op9_simhash,
    "op10_substrings": op10_substrings,
    "op11_suffix_tree": op11_suffix_tree,
    "op12_counting_bloom": op12_counting_bloom,
    "op13_subvectors": op13_subvectors,
}

SQL = {"op7_delta_rollup": ROLLUP_SQL, "op12_counting_bloom": AUDIT_SQL, "op13_subvectors": CLUSTER_SQL}
